"""Benchmark decontamination by templates, slots included.

Texts are cut into words. Names (capitalised inside a sentence), numbers and units (after a number) are slots.
Windows of eight words are hashed in three ways: plain (lower-case words as they are), strict (slots become typed
placeholders) and loose (words capitalised at the start of a sentence or line are placeholders too). The hashes of
all documents meet those of the benchmark in a hash join. Matching windows of one document and one item line up on
a diagonal. A question with other numbers or names matches as well as a copy does; whether its slots are filled
consistently decides: on a diagonal, each value of the item must stand for one value of the document, and each
value of the document for one of the item; strict and loose windows are judged apart. Windows without slots count
whatever the slots of their diagonal hold, plain windows with slots unless the strict ones are inconsistent. Units
are compared without regard to number and spelling.

All of it is DataFrame operations; nothing runs in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_hash, table, written

WINDOW = 8
#: A benchmark window needs so many words that are no placeholders, or tables of numbers would match each other; one
#: with fewer is compared by its exact words. So is an item of so many words that is too short for a window.
MIN_LITERALS = 4
#: A document is contaminated by an item if this share of the item's windows match, or this many of them.
MIN_SHARE, MIN_WINDOWS = 0.5, 8
#: Benchmark windows up to this number are broadcast (at most some 150 bytes each, with slot words; a window
#: has up to three hashes, each counts); more are joined by shuffling both sides.
BROADCAST_WINDOWS = 250_000

#: Units that become placeholders after a number (fixed values).
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec min h hr hrs ms day days week weeks month months"
    " year years hour hours minute minutes second seconds meter meters metre metres mile miles foot feet inch inches"
    " gram grams kilogram kilograms pound pounds liter liters litre litres dollar dollars euro euros cent cents"
    " percent degree degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v a j kj cal kcal"
).split()

#: What stands for one unit, whatever its number or spelling.
_SAME_UNITS = (
    "m meter meters metre metres; km; g gram grams; kg kilogram kilograms; lb lbs pound pounds; l liter liters litre litres;"
    " s sec second seconds; min minute minutes; h hr hrs hour hours; day days; week weeks; month months; year years;"
    " mi mile miles; ft foot feet; in inch inches; dollar dollars; euro euros; cent cents; degree degrees"
)
_CANONICAL = {word: same.split()[0] for same in _SAME_UNITS.split(";") for word in same.split()}

# Marks put before a word that fills a slot; control characters are taken out of texts first.
_NAME, _UNIT, _FIRST = "\x01", "\x02", "\x03"
NAME, UNIT, NUMBER = -1, -2, -3
# The ways a window of a document is hashed, in the order of the arrays of hashes; windows of short items' lengths follow.
_STRICT, _LOOSE, _PLAIN = 0, 1, 2


def template(text: Column) -> Column:
    """The text's words, slot words marked: a name with \\x01, a unit with \\x02, a number by its first digit. Other
    capitalised words, which may be names at the start of a sentence, are marked with \\x03.

    Words are runs of letters and digits; points and commas inside a number belong to it. The patterns start
    with what is rare, so that most places of a text are passed at once.
    """
    plain = F.coalesce(text, F.lit(""))
    for mark in (_NAME, _UNIT, _FIRST):
        plain = F.replace(plain, F.lit(mark), F.lit(""))
    names = F.regexp_replace(plain, r"(?=\p{Lu})(?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}+)", _NAME + "$1")
    first = F.regexp_replace(names, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}{_NAME}])(\p{{Lu}}\p{{Ll}}+)", _FIRST + "$1")
    whole = F.regexp_replace(first, r"([0-9])[.,](?=[0-9])", "$1")
    units = F.regexp_replace(whole, rf"([0-9] )({'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])", "$1" + _UNIT + "$2")
    marked = F.when(first.rlike("[0-9]"), units).otherwise(first)
    return F.array_remove(F.split(F.lower(marked), rf"[^\p{{L}}\p{{N}}{_NAME}{_UNIT}{_FIRST}]+"), "")


def _once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns computed once each, behind a generator of one row."""
    made = F.array(F.struct(*[F.expr(c).alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(made))


def _is_slot(word: str, loose: bool = False) -> str:
    return f"(ascii({word}) IN ({'1, 2, 3' if loose else '1, 2'}) OR ascii({word}) BETWEEN 48 AND 57)"


def _bare(word: str) -> str:
    return f"if(ascii({word}) < 4, substring({word}, 2), {word})"


def _value(word: str) -> Column:
    """What fills a slot, as it is compared: units in one form each, names wherever they stand."""
    forms = F.create_map(*[F.lit(x) for one in _CANONICAL.items() for x in one])
    bare, kind = F.expr(_bare(word)), F.ascii(word)
    unit = F.concat(F.lit(_UNIT), F.coalesce(F.try_element_at(forms, bare), bare))
    return F.when(kind == 2, unit).when(kind < 4, F.concat(F.lit(_NAME), bare)).otherwise(bare)


def _hashes(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys``, the words, their hashes (``exact``), and the strict, loose and plain hashes of every window (``s8``, ``l8``, ``p8``).

    A hash of eight is made by doubling. Loose and plain hashes are an empty array where the whole text has the strict ones.
    """
    coded = _once(
        df.select(*keys, template(F.col(text)).alias("words")),
        exact=f"transform(words, w -> xxhash64({_bare('w')}))",
        slots=f"exists(words, w -> {_is_slot('w')})",
        firsts="exists(words, w -> ascii(w) = 3)",
    )
    coded = _once(
        coded,
        s1=f"if(slots, zip_with(words, exact, (w, p) -> CASE WHEN ascii(w) = 1 THEN {NAME}L WHEN ascii(w) = 2 THEN {UNIT}L"
        f" WHEN ascii(w) BETWEEN 48 AND 57 THEN {NUMBER}L ELSE p END), exact)",
    )
    coded = _once(
        coded,
        l1=f"if(firsts, zip_with(words, s1, (w, s) -> if(ascii(w) = 3, {NAME}L, s)), array())",
        p1="if(slots, exact, array())",
    ).drop("slots", "firsts")
    pair = "if(size({a}) <= {k}, array(), zip_with(slice({a}, 1, size({a}) - {k}), slice({a}, {k} + 1, size({a}) - {k}), (x, y) -> xxhash64(x, y)))"
    for n in (1, 2, 4):
        coded = _once(coded, **{f"{x}{2 * n}": pair.format(a=f"{x}{n}", k=n) for x in "slp"}).drop(f"s{n}", f"l{n}", f"p{n}")
    return coded


def _windows(docs: DataFrame, keys: Sequence[str], text: str, lengths: Sequence[int]) -> DataFrame:
    """``keys``, all words, kind, position and hash of every window of a document; a loose or plain hash is null where
    it is the strict one. Windows of ``lengths`` words, fewer than eight, are hashed plain.

    The last step is the bare generator: what is selected of ``words`` behind a broadcast join is then only
    taken for windows that match.
    """
    differ = "if(size({a}) = 0, array(), zip_with({a}, s8, (x, s) -> nullif(x, s)))"
    short = "if(size(exact) < {n}, array(), transform(sequence(0, size(exact) - {n}), i -> xxhash64(slice(exact, i + 1, {n}))))"
    every = ["s8", differ.format(a="l8"), differ.format(a="p8"), *[short.format(n=n) for n in lengths]]
    parts = _hashes(docs, keys, text).select(*keys, "words", F.array(*map(F.expr, every)).alias("all"))
    return parts.select(*keys, "words", F.posexplode("all").alias("kind", "some")).select(*keys, "words", "kind", F.posexplode("some").alias("pos", "hash"))


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """A row for each different hash of each window: item_id, item_pos, hash, ``strict``, ``loose`` and ``plain`` (which
    ways lead to it), ``free`` (no slot in the window), ``base`` (enough words that are none), words where slots are compared, ``short`` (words of an item that is one window)."""
    hashed = _hashes(benchmark, ["item_id"], "text")
    full = hashed.withColumns({x: F.expr(f"if(size({x}) = 0, s8, {x})") for x in ("l8", "p8")})
    every = full.select("item_id", "words", F.posexplode(F.arrays_zip("s8", "l8", "p8")).alias("item_pos", "w"))
    own = every.withColumn("own", F.slice("words", F.col("item_pos") + 1, WINDOW))
    for name, loose in (("n_strict", False), ("n_loose", True)):
        own = own.withColumn(name, F.expr(f"size(filter(own, w -> {_is_slot('w', loose)}))"))
    own = own.withColumns({"base": F.expr(f"{WINDOW} - n_strict >= {MIN_LITERALS}"), "lax": F.expr(f"{WINDOW} - n_loose >= {MIN_LITERALS}")})
    rows = own.select(
        "item_id", "item_pos", "own", "n_strict", "n_loose", "base",
        F.expr(
            "stack(3, w.s8, base, w.l8 = w.s8 AND lax, w.p8 = w.s8, w.p8 = w.s8,"
            " w.l8, false, w.l8 <> w.s8 AND lax, false, false,"
            " w.p8, false, false, w.p8 <> w.s8, false) AS (hash, strict, loose, plain, free)"
        ),
    )
    long = rows.where("strict OR loose OR plain").select(
        "item_id", "item_pos", "hash", "strict", "loose", "plain", "free", "base",
        F.expr("CASE WHEN strict AND n_strict > 0 OR loose AND n_loose > 0 THEN own END").alias("item_words"), F.lit(None).cast("int").alias("short"),
    )
    whole = hashed.where(F.size("words").between(MIN_LITERALS, WINDOW - 1)).select(
        "item_id", F.lit(0).alias("item_pos"), F.xxhash64("exact").alias("hash"), F.lit(False).alias("strict"), F.lit(False).alias("loose"),
        F.lit(True).alias("plain"), F.lit(True).alias("free"), F.lit(False).alias("base"), F.lit(None).cast("array<string>").alias("item_words"),
        F.size("words").alias("short"),
    )
    return long.unionByName(whole)


def _matches(docs: DataFrame, keys: Sequence[str], text: str, items: DataFrame, small: bool, lengths: Sequence[int]) -> DataFrame:
    """``keys``, item_id, item_pos and shift of every matching window, how it matches, and both sides' words where it has slots."""
    windows, own = _windows(docs, keys, text, lengths), F.slice("words", F.col("pos") + 1, WINDOW)
    if small:
        met = windows.join(F.broadcast(items), "hash").withColumn("own", F.when(F.col("item_words").isNotNull(), own))
    else:
        met = windows.select(*keys, "kind", "pos", "hash", own.alias("own")).join(items, "hash")
    how = met.withColumns({"strict": F.expr(f"strict AND kind = {_STRICT}"), "loose": F.expr(f"loose AND kind <= {_LOOSE}")})
    return how.where("strict OR loose OR plain").select(
        *keys, "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "strict", "loose", "plain", "free", "base", "own", "item_words"
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row for each document and benchmark item it contains: ``keys``, ``item_id``, ``n_windows`` (matching
    windows of the item), ``share`` of the item's windows, ``n_slots`` compared and ``n_changed`` of them (words at the
    start of a sentence are slots if they changed).

    No text is shuffled: the documents' windows stream through the join with the benchmark's (broadcast while their
    counted number is at most ``BROADCAST_WINDOWS``). Only matches are grouped, by document and item. The share is
    that of all windows, or of those with enough words that are no slots, whichever is greater. Items of four to seven
    words are one window and searched for as they are; items of fewer words are not searched for. Null texts and keys
    match nothing; repeated rows are one document. An empty benchmark or table gives an empty result.
    """
    keys = list(keys)
    docs, benchmark = docs.where(F.col(keys[0]).isNotNull()), benchmark.where(F.col("item_id").isNotNull())
    items, _ = written(_item_windows(benchmark).distinct(), "item-windows")
    sizes = items.groupBy("item_id").agg(
        F.count_distinct("item_pos").alias("n_item"), F.count_distinct(F.when(F.col("base"), F.col("item_pos"))).alias("n_base")
    )
    # At most four numbers.
    lengths = sorted(n for (n,) in items.where("short IS NOT NULL").select("short").distinct().collect())
    matches, _ = written(_matches(docs, keys, text, items, items.count() <= BROADCAST_WINDOWS, lengths), "leak-windows")

    # The values that fill the slots of one diagonal, each place once, by strict and by loose windows.
    line = [*keys, "item_id", "shift"]
    ways = F.array_compact(F.array(F.when(F.col("strict"), F.lit(_STRICT)), F.when(F.col("loose"), F.lit(_LOOSE))))
    pairs = matches.where("own IS NOT NULL").select(*line, "item_pos", F.explode(ways).alias("way"), "own", "item_words")
    pairs = pairs.select(*line, "item_pos", "way", F.posexplode(F.arrays_zip("own", "item_words")).alias("i", "p"))
    pairs = pairs.where(F.expr(f"{_is_slot('p.item_words')} OR way = {_LOOSE} AND ascii(p.item_words) = 3")).select(
        *line, "way", (F.col("item_pos") + F.col("i")).alias("place"), (F.ascii("p.item_words") == 3).alias("first"),
        _value("p.own").alias("value"), _value("p.item_words").alias("item_value"),
    )
    # A mark or digit in front tells the kinds apart, numbers by their first digit.
    changed = F.col("item_value") != F.col("value")
    filled = pairs.groupBy(*line, "way").agg(
        F.count_distinct("item_value", "value").alias("both"),
        F.count_distinct("item_value").alias("lefts"),
        F.count_distinct("value").alias("rights"),
        F.count_distinct(F.when(~F.col("first") | changed, F.col("place"))).alias("n_slots"),
        F.count_distinct(F.when(changed, F.col("place"))).alias("n_changed"),
    )
    filled = filled.withColumn("good", F.expr("both = lefts AND both = rights"))
    judged = filled.groupBy(*line).agg(
        F.bool_and(F.when(F.col("way") == _STRICT, F.col("good"))).alias("strict_good"),
        F.bool_and(F.when(F.col("way") == _LOOSE, F.col("good"))).alias("loose_good"),
        *[F.max(F.when(F.col("good"), F.col(n))).alias(n) for n in ("n_slots", "n_changed")],
    )
    place = F.struct("item_pos", "base")
    lines = matches.groupBy(*line).agg(
        F.collect_set(F.when(F.col("free"), place)).alias("hit"),
        F.collect_set(F.when(F.col("strict") | F.col("plain"), place)).alias("strict_hit"),
        F.collect_set(F.when(F.col("loose"), place)).alias("loose_hit"),
    )
    hits = [F.expr("hit"), *[F.expr(f"if(coalesce({x}_good, true), {x}_hit, array())") for x in ("strict", "loose")]]
    found = lines.join(judged, line, "left").groupBy(*keys, "item_id").agg(
        F.array_distinct(F.flatten(F.collect_list(F.concat(*hits)))).alias("hit"),
        F.coalesce(F.sum("n_slots"), F.lit(0)).alias("n_slots"),
        F.coalesce(F.sum("n_changed"), F.lit(0)).alias("n_changed"),
    )
    found = found.withColumn("n_windows", F.size("hit").cast("long"))
    of_base = F.expr("size(filter(hit, h -> h.base)) / nullif(n_base, 0)")
    share = found.join(sizes, "item_id").withColumn("share", F.greatest(F.col("n_windows") / F.col("n_item"), of_base))
    leaks = share.where((F.col("share") >= MIN_SHARE) | (F.col("n_windows") >= MIN_WINDOWS))
    return leaks.select(*keys, "item_id", "n_windows", "share", "n_slots", "n_changed")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain items of ``benchmark``, as they are or with other numbers, names and units."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain benchmark items. Rows are told apart by a hash of all their columns."""
    mark = "__leak_row"
    marked = docs.withColumn(mark, row_hash(docs))
    leaks = find_leaks(marked, benchmark, keys=[mark]).select(mark).distinct()
    return marked.join(leaks, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
