"""Quality rules whose cutoffs are chosen under a guaranteed risk of rejecting good documents.

Every rule is a share or mean that grows as a document gets worse. Labelled good documents, held out for
this purpose, are grouped into strata. The rules are tightened one cutoff at a time in an order that is
fixed beforehand (``STEPS``): all rules from off to their laxest cutoff, then all to the next, and so on. For
each stratum and step, the number of good documents that any rule rejects is tested against the allowed rate
with the exact binomial distribution: the step is accepted if so few rejections would be seen with a
probability of at most ``CONFIDENCE``, divided by the number of strata (Bonferroni), were the true rate the
allowed one or above. Within a stratum the steps are a fixed sequence that ends at the first step not
accepted, which needs no further correction. The last accepted step gives the cutoffs of the stratum; where
the first one fails, no rule rejects anything there.

All of it is DataFrame operations; nothing runs in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written

#: White space and symbols of the contract (fixed values).
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Share of good documents of a stratum that all rules together may reject, and the probability of exceeding it.
RISK, CONFIDENCE = 0.02, 0.05


@dataclass(frozen=True)
class Rule:
    """A document whose ``value`` lies above the cutoff is rejected."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / word_chars", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    Rule("lines", "n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7)),
    Rule("repeats", "n_repeat_words / n_words", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4)),
    Rule("word_length", "word_chars / n_words", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
)

#: The order in which the rules are tightened: each step gives one rule its next cutoff.
STEPS = tuple((r.name, r.cutoffs[-1 - d]) for d in range(max(len(r.cutoffs) for r in RULES)) for r in RULES if d < len(r.cutoffs))


def vectors() -> list[dict[str, float]]:
    """The cutoffs in force after each step; a rule that is still off is missing."""
    return [dict(STEPS[: i + 1]) for i in range(len(STEPS))]


# --- what is measured -------------------------------------------------------------------------


def _once(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Add columns, each computed once: a generator of one row keeps them from being copied into later expressions."""
    made = F.array(F.struct(*[(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(made))


def measures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``key``, ``stratum`` and the counts of every whole text: words, their characters, symbols, repeated lines and words.

    No shuffle. Windows of three words are compared by 64-bit hashes within one text, sorted in place, so the
    work grows as n log n of a text's length. A null text counts as empty. Null keys and repeated rows are kept.
    Ties do not arise, an empty table gives an empty one, and further columns are left out.
    """
    body = docs.select(F.col(key).alias("key"), F.coalesce(stratum, F.lit("")).alias("stratum"), F.coalesce(text, F.lit("")).alias("body"))
    inner = F.trim("body", F.lit(BLANKS))
    cut = _once(
        body,
        words=F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[ \t\n\x0B\f\r]+")),
        lines=F.filter(F.split("body", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""),
        word_chars=F.length(F.translate("body", BLANKS, "")).cast("long"),
        n_symbols=(F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long"),
    ).drop("body")
    counted = _once(
        cut.withColumns(
            {
                "n_words": F.size("words").cast("long"),
                "n_lines": F.size("lines").cast("long"),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            }
        ).drop("lines"),
        windows="if(size(words) < 3, array(), transform(sequence(0, size(words) - 3),"
        " i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))))",
    ).drop("words")
    in_order = _once(
        counted,
        sorted="if(size(array_distinct(windows)) = size(windows), array(),"
        " sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i))))",
    ).drop("windows")
    repeated = _once(
        in_order,
        places="sort_array(transform(filter(sorted, (x, i) ->"
        " get(sorted, i - 1).h <=> x.h OR get(sorted, i + 1).h <=> x.h), x -> x.i))",
    ).drop("sorted")
    covered = "aggregate(transform(places, (p, i) -> least(3, coalesce(get(places, i + 1) - p, 3))), 0L, (a, b) -> a + b)"
    return repeated.withColumn("n_repeat_words", F.expr(covered)).drop("places").withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    ))


def _value(rule: Rule) -> str:
    top, bottom = rule.value.split(" / ")
    return f"CASE WHEN {bottom} > 0 THEN {top} / {bottom} ELSE 0D END"


# --- which cutoffs hold -----------------------------------------------------------------------


def log_gamma(x: str) -> str:
    """ln of the gamma function of a positive number, to about twelve digits: Stirling's series eight steps up."""
    z = f"(({x}) + 8D)"
    down = " * ".join(f"(({x}) + {i}D)" for i in range(8))
    return (
        f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z}) - 1D / (360D * {z} * {z} * {z})"
        f" + 1D / (1260D * {z} * {z} * {z} * {z} * {z}) - ln({down}))"
    )


def binomial_tail(n: str, k: str, rate: float) -> str:
    """P(at most k of n) for k below n * rate.

    Terms are summed from k downwards as far as they can matter in double precision: 40 standard deviations.
    """
    first = (
        f"exp({log_gamma(f'{n} + 1D')} - {log_gamma(f'{k} + 1D')} - {log_gamma(f'{n} - {k} + 1D')}"
        f" + {k} * ln({rate}D) + ({n} - {k}) * ln({1 - rate}D))"
    )
    low = f"greatest(1L, {k} - cast(40 * sqrt({n} * {rate}D) AS bigint) - 200L)"
    sums = (
        f"aggregate(if({k} < 1, array(), sequence({k}, {low}, -1L)), struct(1D AS t, 1D AS s),"
        f" (a, i) -> struct(a.t * i * {1 - rate}D / (({n} - i + 1) * {rate}D) AS t,"
        f" a.s + a.t * i * {1 - rate}D / (({n} - i + 1) * {rate}D) AS s), a -> a.s)"
    )
    return f"{first} * {sums}"


def first_step() -> str:
    """The step at which a document is rejected first, one more than there are if none rejects it."""
    number = {step: i + 1 for i, step in enumerate(STEPS)}
    each = [
        "CASE " + " ".join(f"WHEN {_value(r)} > {c}D THEN {number[r.name, c]}" for c in reversed(r.cutoffs)) + f" ELSE {len(STEPS) + 1} END"
        for r in RULES
    ]
    return f"least({', '.join(each)})"


def cutoffs(measured: DataFrame, labels: DataFrame, *, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per stratum with an accepted step: the cutoff of each rule there (null: the rule rejects nothing).

    ``labels`` has ``doc_id`` and ``quality``; of several labels of one document the worst counts. Good documents
    that the base rules reject anyway take no part. The counts are partial sums: one row per task and stratum.
    ``n`` and ``k`` are the good documents of the stratum and how many of them the cutoffs reject. A stratum
    without good labels, or an empty table, has no row.
    """
    good = labels.groupBy(F.col("doc_id").alias("key")).agg(F.min("quality").alias("quality")).where("quality = 1").select("key")
    held = measured.where(~F.col("base_failed")).join(good, "key").select("stratum", F.expr(first_step()).alias("first"))
    sums = [F.sum((F.col("first") <= i + 1).cast("long")).alias(f"k_{i}") for i in range(len(STEPS))]
    seen = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *sums)
    # One row per stratum from here on.
    made = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.col(f"k_{i}").alias("k"),
                *[F.lit(cuts.get(r.name)).cast("double").alias(f"cut_{r.name}") for r in RULES],
            )
            for i, cuts in enumerate(vectors())
        ]
    )
    tests = seen.withColumn("made", made).select("stratum", "n", "made", F.inline(steps))
    allowed = tests.where(F.col("k") < F.col("n") * risk).withColumn("p", F.expr(binomial_tail("n", "k", risk)))
    # k never falls from one step to the next, nor does p: the last accepted step has none before it that fails.
    accepted = allowed.where(F.col("p") <= confidence / F.col("made"))
    last = F.max(F.struct("step", "k", *[f"cut_{r.name}" for r in RULES])).alias("last")
    return accepted.groupBy("stratum", "n").agg(last).select("stratum", "n", "last.*")


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: false where the base rules or an accepted cutoff of the stratum reject."""
    met = measured.join(cuts.drop("n", "k", "step"), "stratum", "left")
    beyond = " OR ".join(f"coalesce({_value(r)} > cut_{r.name}, false)" for r in RULES)
    return met.withColumn("kept", F.expr(f"NOT base_failed AND NOT ({beyond})"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, with cutoffs from ``labels`` per language."""
    measured, _ = written(measures(table(spark, sf_dir, "documents")), "measures")
    kept = judge(measured, cutoffs(measured, table(spark, sf_dir, "labels")))
    return kept.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    def row(i: int, cuts: dict[str, float]) -> str:
        return f"({i}, " + ", ".join(f"CAST({cuts.get(r.name, 'NULL')} AS DOUBLE)" for r in RULES) + ")"

    steps = ", ".join(row(i + 1, cuts) for i, cuts in enumerate(vectors()))
    names = ", ".join(f"cut_{r.name}" for r in RULES)
    beyond = " OR ".join(f"coalesce({_value(r).replace('0D', '0')} > cut_{r.name}, false)" for r in RULES)
    return f"""
WITH body AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS body FROM documents
), cut AS (
  SELECT rn, doc_id, stratum, body,
         CASE WHEN trim(body, {blank}) = '' THEN [] ELSE string_split_regex(trim(body, {blank}), '[ \\t\\n\\x0B\\f\\r]+') END AS words,
         list_filter(string_split(body, chr(10)), lambda x: trim(x, {blank}) <> '') AS lines
  FROM body
), counted AS (
  SELECT rn, doc_id, stratum, words, len(words) AS n_words, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(length(regexp_replace(body, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(translate(body, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols
  FROM cut
), windows AS (
  SELECT rn, unnest(range(1, n_words - 1)) AS i,
         unnest(list_transform(range(1, n_words - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS w
  FROM counted WHERE n_words > 2
), repeated AS (
  SELECT rn, i FROM windows QUALIFY count(*) OVER (PARTITION BY rn, w) > 1
), covered AS (
  SELECT rn, count(*) AS n FROM (SELECT DISTINCT rn, unnest([i, i + 1, i + 2]) AS i FROM repeated) GROUP BY rn
), measured AS (
  SELECT c.* EXCLUDE (words), coalesce(v.n, 0) AS n_repeat_words,
         c.n_words < {MIN_WORDS} OR 100 * coalesce(v.n, 0) > {MAX_REPEAT_PERCENT} * c.n_words AS base_failed
  FROM counted c LEFT JOIN covered v USING (rn)
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), steps(step, {names}) AS (VALUES {steps}
), seen AS (
  SELECT stratum, step, count(*) AS n, count(*) FILTER (WHERE {beyond}) AS k
  FROM measured m SEMI JOIN good USING (doc_id), steps WHERE NOT base_failed GROUP BY ALL
), tested AS (
  SELECT *, k < n * {RISK} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
         - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln({1 - RISK})))) <= {CONFIDENCE} / (SELECT count(DISTINCT stratum) FROM seen) AS holds
  FROM seen
), cuts AS (
  SELECT stratum, max(step) AS step
  FROM (SELECT *, bool_and(holds) OVER (PARTITION BY stratum ORDER BY step) AS so_far FROM tested) WHERE so_far GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({beyond}) AS kept
FROM measured LEFT JOIN cuts USING (stratum) LEFT JOIN steps USING (step)
"""


SQL = _sql()
