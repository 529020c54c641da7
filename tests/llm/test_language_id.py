from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paygrain.llm import language_id as L


def trained(texts):
    """A model from {language: [texts]}, with the grams counted one by one."""
    grams = Counter()
    for lang, many in texts.items():
        for t in many:
            data = b"\n\n\n" + t.encode()
            grams.update((lang, int.from_bytes(data[i : i + 4], "big")) for i in range(len(data) - 3))
    return pd.DataFrame([(a, g, n) for (a, g), n in grams.items()], columns=["lang", "gram", "n"])


def brute_bits(frame, lang, text):
    """Code length by definition: escape method C with exclusion, byte by byte, with dictionaries."""
    counts = defaultdict(Counter)
    for a, g, n in frame.itertuples(index=False):
        if a == lang:
            w = int(g).to_bytes(4, "big")
            for k in range(4):
                counts[w[3 - k : 3]][w[3]] += n
    used = {b for g in frame["gram"] for b in int(g).to_bytes(4, "big")} | {10}
    data = b"\n\n\n" + text.encode()
    bits = 0.0
    for i in range(3, len(data)):
        gone = set()
        for k in (3, 2, 1, 0):
            context = data[i - k : i]
            here = counts.get(context, Counter())
            if k and sum(here.values()) < 2:
                continue
            here = {b: n for b, n in here.items() if b not in gone}
            total, kinds = sum(here.values()), len(here)
            if not kinds:
                continue
            if data[i] in here:
                bits += log2((total + kinds) / here[data[i]])
                break
            bits += log2((total + kinds) / kinds)
            gone |= set(here)
        else:
            bits += log2(256 - len(gone)) if data[i] in used or len(used) < 256 else 8
    return bits


def test_code_lengths_follow_the_definition():
    rnd = random.Random(5)
    texts = {a: ["".join(rnd.choice(letters) for _ in range(200)) for _ in range(3)] for a, letters in (("aa", "abcab "), ("bb", "xyzab."))}
    frame = trained(texts)
    model = L.build_model(frame)
    for text in ("abcabc", "xyz. zzz", "q", "ab é ab", "x" * 50, "a"):
        got = L.total_bits(model, pa.array([text.encode()], pa.large_binary()))[0]
        np.testing.assert_allclose(got, [brute_bits(frame, a, text) for a in model.languages], rtol=1e-5)


def test_texts_in_one_batch_do_not_see_each_other(monkeypatch):
    model = L.build_model(trained({"aa": ["abc abc abd"], "bb": ["xyz xzy"]}))
    texts = ["", "a", "ab", "", "abc abd " * 30, "xyz", "b"]
    alone = [L.total_bits(model, pa.array([t.encode()], pa.large_binary()))[0] for t in texts]
    monkeypatch.setattr(L, "_STEP", 7)  # stretches that begin inside texts
    np.testing.assert_allclose(L.total_bits(model, pa.array([t.encode() for t in texts], pa.large_binary())), alone, rtol=1e-6)


def test_many_languages_keep_their_contexts(monkeypatch):
    """By language the code lengths are those of the one table; a bound that neither fits is an error."""
    rnd = random.Random(3)
    texts = {f"l{k}": ["".join(rnd.choice("abcdefgh é."[k : k + 6]) for _ in range(300)) for _ in range(3)] for k in range(6)}
    frame = trained(texts)
    wide = L.build_model(frame)
    asked = pa.array([t.encode() for t in ("abc abd", "", "é.é hg", "xyz q", "ü", "fedcba" * 40)], pa.large_binary())
    want = L.total_bits(wide, asked)
    monkeypatch.setattr(L, "MODEL_BYTES", wide.costs.nbytes - 1)
    narrow = L.build_model(frame)
    assert narrow.leaves is not None
    np.testing.assert_allclose(L.total_bits(narrow, asked), want, rtol=1e-5)
    monkeypatch.setattr(L, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError, match="MODEL_BYTES"):
        L.build_model(frame)


def test_lengths_form_a_code():
    rng = np.random.default_rng(1)
    chain = [rng.integers(0, 2, 9).astype(float) * rng.integers(1, 9, 9) for _ in range(3)]
    for c in chain:
        c[-1] = 0
    bits = L.code_lengths(chain, 248)
    assert np.exp2(-bits[:-1]).sum() + 248 * np.exp2(-bits[-1]) <= 1 + 1e-9


def test_held_out_accuracy(documents):
    found = L.identify(documents, L.train(documents)).join(documents.select("doc_id", "lang"), "doc_id").where(L.held_out(F.col("doc_id")))
    right, all_ = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 20 and right > 0.97


def test_held_out_labels_are_not_learned(documents):
    swapped = documents.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in L.train(swapped).languages


def test_sample_is_bounded_and_whole(documents):
    sample = L.training_sample(documents, 5)
    assert max(n for _, n in sample.groupBy("lang").count().collect()) <= 5
    assert sample.join(documents, "text", "left_anti").count() == 0


def test_unlabelled_texts_are_kept(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !?", None), (3, None, None)], "doc_id bigint, text string, lang string")
    assert [r["doc_id"] for r in L.keep_languages(docs, L.train(docs)).collect()] == [1]


def test_messy_rows(messy, documents, none):
    model = L.train(documents)
    found = L.identify(messy, model)
    assert found.count() == messy.count()
    for r in found.join(messy.select("doc_id", "text"), "doc_id").collect():
        letters = any(map(str.isalpha, r["text"] or ""))
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not letters)
    kept = L.keep_languages(messy, model)
    assert kept.columns == messy.columns and kept.where("text is null or text = ''").count() == 0
    assert L.identify(none, model).count() == 0
    untaught = L.identify(messy, L.train(none))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
