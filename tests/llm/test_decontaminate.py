from __future__ import annotations

import pytest

from paygrain.llm import decontaminate as D

from .conftest import SF

ITEMS = [
    (1, "Yesterday morning Alice bought 12 apples for 30 cents each while Bob sold 7 pears. How much more did Alice pay than Bob asked for 12 apples?"),
    (2, "The train leaves the station and crosses the long bridge before it reaches the quiet village near the mountain lake."),
    (3, "too short"),
    (None, "an item without an id is never found even if it is long enough to be cut into windows"),
    (4, None),
]
FILLER = "some quite ordinary words that have nothing to do with any question stand here and there"


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def leaks(spark, benchmark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r for r in D.find_leaks(docs, benchmark).collect()}


def test_copies_templates_and_clean_texts(spark, benchmark):
    one, two = ITEMS[0][1], ITEMS[1][1]
    other = one.replace("Alice", "Carla").replace("Bob", "Dieter").replace("12", "95").replace("30", "41").replace("7 ", "3,5 ")
    # Alice is two people here, so this is another question.
    mixed = one.replace("did Alice", "did Dora").replace("Alice", "Carla").replace("for 12", "for 44")
    found = leaks(
        spark, benchmark,
        f"{FILLER}. {one} {FILLER}",
        f"{FILLER}. {other} {FILLER}",
        f"{FILLER}. {mixed}",
        f"{FILLER}\n{two.upper()}\n{FILLER}",
        " ".join(f"{w}!!" for w in two.split()),
        f"{FILLER} {' '.join(two.split()[:6])} {FILLER}",
        FILLER, None, "", "1 2 3 4 5 6 7 8 9 10 11 12",
        "too short",
    )
    assert set(found) == {(0, 1), (1, 1), (3, 2), (4, 2)}
    assert found[0, 1]["n_changed"] == 0 and found[0, 1]["n_slots"] >= 6
    assert found[1, 1]["n_changed"] == found[1, 1]["n_slots"] - 1 >= 6  # the unit stays


def test_each_number_must_stand_for_one_number(spark, benchmark):
    """Two different values of the item may not become one, nor one become two."""
    one = ITEMS[0][1]
    merged = one.replace("12", "9").replace("30", "9")
    assert not leaks(spark, benchmark, merged)


def test_windows_without_slots_count_on_an_inconsistent_diagonal(spark):
    prose = "the old mill stands by the river and nobody remembers who built it or why the wheel stopped turning one day"
    passage = f"He paid 12 coins at the gate. {prose}. He paid 12 coins again"
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    assert set(leaks(spark, items, passage.replace("12", "15", 1))) == {(0, 1)}


def test_units_are_compared_in_one_form(spark):
    question = "a walk of 1 hour to the lake and then 3 hours back over the hill is long"
    items = spark.createDataFrame([(1, question)], "item_id bigint, text string")
    other = question.replace("3 hours", "4 hours").replace("1 hour ", "2 hours ")
    mixed = question.replace("3 hours", "4 miles").replace("1 hour ", "2 days ")
    assert set(leaks(spark, items, other, mixed)) == {(0, 1)}


def test_names_at_the_start_of_sentences(spark):
    question = (
        "Alice has 12 red apples in her old blue basket. Alice buys some more apples at the small shop."
        ' "Alice then gives 5 of them to all her friends."'
    )
    items = spark.createDataFrame([(1, question)], "item_id bigint, text string")
    mixed = question.replace("Alice has", "Carla has").replace("Alice buys", "Dora buys").replace("Alice then", "Emma then")
    found = leaks(spark, items, question.replace("Alice", "Carla"), mixed)
    assert set(found) == {(0, 1)} and found[0, 1]["share"] > 0.8 and found[0, 1]["n_changed"] == 3


def test_copies_whatever_case_and_line_breaks(spark):
    text = "In the morning Alice met Bob, Carla and Dieter near Paris where Emma sold pears to Frank and old Greta"
    items = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    copies = [text.lower(), text.upper(), text.title(), text.replace(" ", "\n"), text.replace(" ", "  ")]
    assert set(leaks(spark, items, *copies)) == {(i, 1) for i in range(len(copies))}


def test_copies_of_short_and_slot_heavy_items(spark):
    texts = ["What is 7 times 8?", "12 34 56 78 90 11 13 17 19 23", "Guests were Anna, Bert, Carla, Dieter, Emma, Frank, Greta, Hugo, Ida and Jonas"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    others = ["What is 7 times 9?", "12 34 56 78 91 11 13 17 19 23", "What is 7 times"]
    found = leaks(spark, items, *[f"{FILLER} {t} {FILLER}" for t in texts], *others, *[t.upper() for t in texts])
    assert set(found) == {(0, 0), (1, 1), (2, 2), (6, 0), (7, 1), (8, 2)}
    assert all(r["share"] == 1 for r in found.values())


def test_passage_in_the_middle_of_a_long_text(spark, benchmark):
    assert set(leaks(spark, benchmark, f"{'word filler ' * 3000}. {ITEMS[1][1]}")) == {(0, 2)}


def test_shuffled_join_gives_the_same(spark, benchmark, monkeypatch):
    text = f"{FILLER}. {ITEMS[0][1]}"
    want = leaks(spark, benchmark, text)
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert leaks(spark, benchmark, text) == want != {}


def brute(documents, benchmark):
    """All eight-word windows of lower-case letters and digits, in dictionaries. The given items have no slots."""
    def words(text):
        return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()

    out = set()
    items = {i: words(t) for i, t in benchmark}
    own = {i: {" ".join(w[k : k + 8]) for k in range(len(w) - 7)} for i, w in items.items()}
    for doc, text in documents:
        w = words(text)
        here = {" ".join(w[k : k + 8]) for k in range(len(w) - 7)}
        for i, windows in own.items():
            n = len(here & windows)
            if windows and (n / len(windows) >= 0.5 or n >= 8):
                out.add((doc, i))
    return out


def test_query_by_brute_force(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in items])
    assert {(r["doc_id"], r["item_id"]) for r in D.op7_decontaminate(spark, SF).collect()} == want


def test_messy(spark, messy, none, benchmark):
    assert D.find_leaks(messy, benchmark).count() == 0 and D.find_leaks(none, benchmark).count() == 0
    assert D.find_leaks(messy, benchmark.where("false")).count() == 0
    kept = D.drop_leaks(messy, benchmark)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    planted = spark.createDataFrame([(1, "ten words: one two three four five six seven eight nine ten")], "item_id bigint, text string")
    assert D.drop_leaks(messy, planted).count() == messy.count() - messy.where("text like 'one two%'").count()


def test_plan_stays_in_the_jvm(spark, documents, benchmark):
    plan = D.find_leaks(documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
