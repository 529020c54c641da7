"""Language identification by prediction by partial matching over bytes, with frozen statistics.

Every language gets a context tree: how often each byte followed each of the contexts of up to three
bytes in its training texts. A byte costs its exact code length under escape method C with exclusion:
the longest known context either codes the byte or escapes to the next shorter one, in which the bytes
already ruled out no longer count, down to an even choice among the bytes left over. The statistics stay
as trained while texts are scored, so the code length of a byte depends only on the three bytes before
it. That lets all trees be laid over one another into a single table: the longest context known to any
language, times the byte, gives one code length per language. That table grows with the square of the number of
languages; where it would be too large, each language keeps its own contexts and symbols, sparsely, with the
same code lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import binary, pieces, sliced, table

if TYPE_CHECKING:
    import pandas as pd

ORDER = 3
#: At most so many labelled documents of each language are learned from: a sample by a hash of the id.
TRAIN_DOCS = 1500
#: Contexts kept of each language, the most frequent first. A model that would outgrow MODEL_BYTES as one table is kept
#: by language; one that outgrows it even then is an error.
MAX_CONTEXTS, MODEL_BYTES = 6000, 128 << 20
UNKNOWN = "und"
#: A text no language codes in fewer bits than it has is rejected.
REJECT_BITS = 8.0
_PAD = 10  # a line feed stands before each text
_STEP = 1 << 19  # bytes scored at once


def held_out(doc_id: Column) -> Column:
    """True for the documents nothing is learned from; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Leaf:
    """One language's tree. Bits of a symbol seen in a context or one of its suffixes are listed; others follow from
    the empty context: ``lead`` of the context and ``first`` of the symbol, or ``rest`` where it was never seen."""

    contexts: np.ndarray  # codes of the contexts, sorted
    cells: np.ndarray  # (context, symbol), sorted
    bits: np.ndarray
    lead: np.ndarray
    rest: np.ndarray
    first: np.ndarray  # infinite for a symbol never seen

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.contexts, self.cells, self.bits, self.lead, self.rest, self.first))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    symbols: np.ndarray  # byte -> symbol; unseen bytes share the last symbol
    states: np.ndarray  # three symbols -> longest known context
    costs: np.ndarray  # (context, symbol) x language -> bits
    leaves: list[Leaf] | None = None  # instead of states and costs, one per language


# --- training ---------------------------------------------------------------------------------


def training_sample(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """lang and text of at most ``per_language`` labelled documents of each language that are not held out.

    A threshold from the counts (one number per language comes to the driver, as the model will) thins every
    language to about twice the bound where the texts are read, so that the ranking shuffles a bounded number
    of texts however many documents there are and however unevenly the languages are spread.
    """
    place = F.pmod(F.xxhash64("doc_id", F.lit("language id")), F.lit(1 << 31))
    labelled = (
        docs.select("doc_id", "text", "lang")
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .withColumn("place", place)
    )
    counts = labelled.groupBy("lang").count().collect()
    below = [F.lit(x) for lang, n in counts for x in (lang, (2 * per_language + 100) / n * (1 << 31))]
    thin = labelled.where(F.col("place") < F.element_at(F.create_map(*below), F.col("lang"))) if counts else labelled
    by_place = Window.partitionBy("lang").orderBy("place", "doc_id")
    ranked = thin.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= per_language)
    return ranked.select("lang", "text")


def _contexts(data: np.ndarray, starts: np.ndarray, fill: int) -> list[np.ndarray]:
    """The symbols one, two and three places back; ``fill`` before the start of each text."""
    out = []
    for back in range(1, ORDER + 1):
        moved = np.empty_like(data)
        moved[back:], moved[:back] = data[:-back], fill
        for i in range(back):
            at = starts + i
            moved[at[at < len(moved)]] = fill
        out.append(moved)
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its texts, without copying."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


def count_grams(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): how often four bytes follow each other, three of context and one coded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = binary(batch.column(1))
            for lang in dict.fromkeys(langs):
                data, at = _bytes_of(pa.compute.filter(texts, pa.array(langs == lang)))
                one, two, three = (c.astype(np.int64) for c in _contexts(data, at[:-1], _PAD))
                grams, n = np.unique(three << 24 | two << 16 | one << 8 | data, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    grams = sample.mapInArrow(work, "lang string, gram bigint, n bigint")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _tree(grams: np.ndarray, n: np.ndarray, size: int, keep: int) -> dict[tuple[int, ...], np.ndarray]:
    """Context -> counts of the symbol that follows; contexts seen once are cut, then the rarest beyond ``keep``."""
    tree = {(): np.bincount(grams[:, 3], n, size)}
    found: list[tuple[float, tuple[int, ...], np.ndarray]] = []
    for order in range(1, ORDER + 1):
        code = np.zeros(len(grams), np.int64)
        for i in range(3 - order, 4):
            code = code * size + grams[:, i]
        cells, where = np.unique(code, return_inverse=True)
        counts = np.bincount(where, n)
        heads, first = np.unique(cells // size, return_index=True)
        for head, cell, count in zip(heads, np.split(cells, first[1:]), np.split(counts, first[1:]), strict=True):
            if count.sum() > 1:
                context = tuple(int(head // size**k % size) for k in reversed(range(order)))
                row = np.zeros(size)
                row[cell % size] = count
                found.append((float(count.sum()), context, row))
    # A context is at most as frequent as its own suffix, which stands before it in this order and so is kept too.
    found.sort(key=lambda x: (-x[0], len(x[1]), x[1]))
    return tree | {context: row for _, context, row in found[:keep]}


def code_lengths(chain: list[np.ndarray], left_over: int) -> np.ndarray:
    """Bits of each symbol, given the counts under the contexts from the longest to the empty one.

    ``left_over`` bytes have no symbol of their own; the last symbol stands for each of them.
    """
    size = len(chain[0])
    bits, gone, spent = np.zeros(size), np.zeros(size, bool), 0.0
    for counts in chain:
        counts = np.where(gone, 0.0, counts)
        here = counts > 0
        total, kinds = counts.sum(), here.sum()
        if kinds:
            bits[here] = spent + np.log2((total + kinds) / counts[here])
            spent += np.log2((total + kinds) / kinds)
            gone |= here
    rest = size - 1 - gone[:-1].sum() + left_over
    bits[~gone] = spent + np.log2(max(rest, 1))
    return bits


def _code(context: tuple[int, ...], size: int) -> int:
    """A number for a context of any length: its symbols, plus one, as digits."""
    out = 0
    for x in context:
        out = out * (size + 1) + x + 1
    return out


def _leaf(tree: dict[tuple[int, ...], np.ndarray], size: int, left_over: int) -> Leaf:
    contexts = sorted(tree, key=lambda c: _code(c, size))
    with np.errstate(divide="ignore"):
        first = -np.log2(tree[()]).astype(np.float32)
    cells, bits, lead, rest = [], [], np.zeros(len(contexts), np.float32), np.zeros(len(contexts), np.float32)
    for i, c in enumerate(contexts):
        chain = [tree[c[k:]] for k in range(len(c) + 1)]
        own = code_lengths(chain, left_over)
        listed = np.any([x > 0 for x in chain[:-1]], axis=0) if c else np.zeros(size, bool)
        cells.append(i * size + np.flatnonzero(listed))
        bits.append(own[listed].astype(np.float32))
        plain = np.flatnonzero(~listed & np.isfinite(first))
        unseen = np.flatnonzero(~listed & ~np.isfinite(first))
        if len(plain):
            lead[i] = own[plain[0]] - first[plain[0]]
        if len(unseen):
            rest[i] = own[unseen[0]]
    codes = np.array([_code(c, size) for c in contexts], np.int64)
    return Leaf(codes, np.concatenate(cells).astype(np.int32), np.concatenate(bits), lead, rest, first)


def _found(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in a sorted array, and whether they are there."""
    at = np.minimum(np.searchsorted(sorted_, wanted), max(len(sorted_) - 1, 0))
    return at, sorted_[at] == wanted if len(sorted_) else np.zeros(len(wanted), bool)


def _leaf_bits(leaf: Leaf, grams: np.ndarray) -> np.ndarray:
    """Bits of the last symbol of each row (three, two, one back, and the symbol)."""
    size = len(leaf.first)
    code = np.zeros(len(grams), np.int64)
    state = np.zeros(len(grams), np.int64)  # the empty context has the lowest code
    for back in range(1, ORDER + 1):
        code += (grams[:, ORDER - back] + 1) * (size + 1) ** (back - 1)
        at, known = _found(leaf.contexts, code)
        state[known] = at[known]
    symbol = grams[:, ORDER]
    at, listed = _found(leaf.cells, state * size + symbol)
    first = leaf.first[symbol]
    out = np.where(np.isfinite(first), leaf.lead[state] + first, leaf.rest[state])
    out[listed] = leaf.bits[at[listed]]
    return out


def build_model(grams: pd.DataFrame, max_contexts: int = MAX_CONTEXTS) -> Model:
    """Freeze the statistics. ``grams`` is bounded by the training sample, not by the documents."""
    languages = sorted(grams["lang"].unique())
    raw = grams["gram"].to_numpy(np.int64)
    parts = np.stack([raw >> s & 255 for s in (24, 16, 8, 0)], axis=1)
    used = np.unique(np.append(parts, _PAD))
    size = len(used) + 1
    symbols = np.full(256, size - 1, np.int64)
    symbols[used] = np.arange(len(used))
    parts, n = symbols[parts], grams["n"].to_numpy(float)
    trees = []
    for lang in languages:
        own = (grams["lang"] == lang).to_numpy()
        trees.append(_tree(parts[own], n[own], size, max_contexts))
    contexts = sorted({c for t in trees for c in t}, key=lambda c: (len(c), c)) or [()]
    if 4 * len(contexts) * size * len(languages) > MODEL_BYTES:
        leaves = [_leaf(t, size, 256 - len(used)) for t in trees]
        if (taken := sum(x.nbytes() for x in leaves)) > MODEL_BYTES:
            raise ValueError(f"the contexts of {len(languages)} languages take {taken} bytes, more than MODEL_BYTES")
        return Model(languages, symbols, np.empty(0, np.int32), np.empty((0, len(languages)), np.float32), leaves)
    states = np.zeros((size,) * ORDER, np.int32)
    for i, c in enumerate(contexts):
        states[(..., *c)] = i
    costs = np.zeros((len(contexts), size, len(languages)), np.float32)
    for j, tree in enumerate(trees):
        known: dict[tuple[int, ...], np.ndarray] = {}
        for i, c in enumerate(contexts):
            while c not in tree:
                c = c[1:]
            if c not in known:
                known[c] = code_lengths([tree[c[k:]] for k in range(len(c) + 1)], 256 - len(used))
            costs[i, :, j] = known[c]
    return Model(languages, symbols, states.ravel(), costs.reshape(len(contexts) * size, len(languages)))


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    return build_model(count_grams(training_sample(docs, per_language)).toPandas())


# --- scoring ----------------------------------------------------------------------------------


def total_bits(model: Model, texts: pa.Array) -> np.ndarray:
    """Code length of each whole text under each language, in bits."""
    data, at = _bytes_of(texts)
    size = round(len(model.states) ** (1 / ORDER)) if model.leaves is None else len(model.leaves[0].first)
    out = np.zeros((len(texts), len(model.languages)))
    starts = at[:-1]
    for low in range(0, len(data), _STEP):
        high = min(low + _STEP, len(data))
        lead = min(low, ORDER)
        own = model.symbols[data[low - lead : high]]
        first = np.searchsorted(starts, low - lead)
        inside = starts[first : np.searchsorted(starts, high)] - (low - lead)
        one, two, three = (c[lead:] for c in _contexts(own, inside, model.symbols[_PAD]))
        # Texts that have bytes in this stretch, and where they begin in it.
        doc = np.searchsorted(at, low, "right") - 1
        last = np.searchsorted(at, high - 1, "right") - 1
        every = np.arange(doc, last + 1)
        every = every[at[every + 1] > at[every]]
        begin = np.maximum(at[every] - low, 0)
        if model.leaves is None:
            cell = model.states[(three * size + two) * size + one].astype(np.int64) * size + own[lead:]
            out[every] += np.add.reduceat(model.costs[cell], begin, axis=0, dtype=np.float64)
            continue
        # Each different run of four symbols is looked up once.
        codes, where = np.unique(((three * size + two) * size + one) * size + own[lead:], return_inverse=True)
        grams = np.stack([codes // size**k % size for k in (3, 2, 1, 0)], axis=1)
        for j, leaf in enumerate(model.leaves):
            out[every, j] += np.add.reduceat(_leaf_bits(leaf, grams)[where], begin, dtype=np.float64)
    return out


def has_letter(texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        out[i] = any(map(str.isalpha, t.as_py().decode("utf-8", "replace")))
    return out


def predict(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior probability under equal priors, and bits per byte, of each text of a column."""
    texts = binary(column)
    known = has_letter(texts)
    if not model.languages:
        known[:] = False
    langs, score, bits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if known.any():
        cost = total_bits(model, texts)
        best = cost.argmin(axis=1)  # of equal ones the first in the order of the names
        lowest = cost.min(axis=1)
        score = np.where(known, 1 / np.exp2(np.maximum(lowest[:, None] - cost, -1000)).sum(axis=1), 0.0)
        length = np.array([max(1, len(t.as_py())) for t in texts])
        bits = np.where(known, lowest / length, 0.0)
        langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return langs, score, bits


def identify(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` (0 to 1) and ``bits_per_byte`` of every whole text; no shuffle.

    A null text, one without a letter, and any text if there was nothing to learn from, is ``und`` with
    score 0. Null keys and repeated rows are kept. Only ``key`` and ``text`` are read. The model is
    broadcast; its size is bounded by ``MODEL_BYTES``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            langs, score, bits = predict(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(bits)],
                ["key", "lang_pred", "score", "bits_per_byte"],
            )

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(work, f"key {kind}, lang_pred string, score double, bits_per_byte double")
    return out.withColumnRenamed("key", key)


def keep_languages(docs: DataFrame, model: Model, max_bits: float = REJECT_BITS) -> DataFrame:
    """The rows whose text is in some learned language: not ``und``, and fewer than ``max_bits`` bits a byte.

    If there was nothing to learn from, the rows whose text has a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def verdict(texts: pa.Array) -> np.ndarray:
        if not shared.value.languages:
            return has_letter(binary(texts))
        langs, _, bits = predict(shared.value, texts)
        return (np.array(langs, object) != UNKNOWN) & (bits < max_bits)

    # Only texts go to Python and only verdicts come back; the rows stay where they are.
    @F.arrow_udf("boolean")
    def stays(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([verdict(x) for x in pieces(texts)]) if len(texts) else np.zeros(0, bool))

    return docs.where(stays("text"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose id's checksum is no multiple of five."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
