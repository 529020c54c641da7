"""Byte-level BPE of a tokenizer file as a streaming transducer with bounded lookahead, and back.

Encoding. Two runs of the merge procedure, over a text and over the same text with more behind it, can only
differ near the end. From the merge list alone follows how near (``lookahead``): a boundary between tokens that
has more bytes than that behind it is there, or not, whatever follows. The transducer therefore keeps a window
of bytes, merges it, emits every token that ends at a stable boundary, and goes on from there. Its state is a
window, however long the pre-token. All pre-tokens of a block run as transducers in step, in numpy: the short
ones, which are nearly all, end within their first window.

Pre-tokens are found from the classes of the few characters around a place, so texts are read in blocks, too.

Decoding. Token ids become bytes by a table; bytes become text in a state machine whose state is the beginning
of a character that is not complete yet. What no character can begin with, or can be continued by, becomes
U+FFFD, one for every maximal part of a character.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pretokens
from .common import binary, sliced, table
from .merges import byte_letters, merger_of_merges, read_vocabulary
from .pretokens import spread
from .token_count import LETTER, OTHER, QUOTE, CharClasses, char_classes

#: Bytes of a pre-token that are merged at once; more if twice the lookahead and the longest token take more.
WINDOW = 2048
#: Windows up to this length are merged in step with others, longer ones (few) one by one.
IN_STEP = 64
#: Bytes of text whose pre-tokens are found and merged at once, and ids that are decoded at once.
BLOCK, IDS = 1 << 21, 1 << 20
_NONE = np.int32(1 << 30)  # the rank of a pair that does not merge


# --- the merge list ---------------------------------------------------------------------------


def lookahead(merges: Sequence[tuple[str, str]], size: dict[str, int]) -> int:
    """Bytes of lookahead that settle a boundary under this merge list; ``size`` has the bytes of every token.

    Let the merges run rank by rank over a text and over the same text continued. Follow the leftmost boundary at
    which the runs have ever differed. It moves left only when a rule (a, b) merges over a new boundary in one run
    and not in the other. Up to then both runs agree on everything left of the previous such boundary, so that one
    lies inside b or at its end, and was removed by a rule that has as its left side the very node of b's own merge
    tree that ends there, before that node was itself merged further. (Or there was none, and b reaches over the
    end of the shorter text.) The distance from the end is hence at most the sum of steps along a chain of rules of
    rising rank, each tied to a node of the next one's b; the longest chain is found in one pass over the ranks.

    Needs a proper list: one rule makes a token, and rules that use it come later. Others raise an error.
    """
    rank: dict[str, int] = {}
    ranks_of: dict[str, list[int]] = {}  # by left side, in order
    reach_of: dict[str, list[int]] = {}  # the farthest reach of any of these so far
    farthest = 0

    def nodes(token: str, end: int, until: int) -> Iterator[tuple[str, int, int]]:
        """Every node of the token's merge tree, where it ends, and the first rank that can no longer use it."""
        pending = [(token, end, until)]
        while pending:
            token, end, until = pending.pop()
            yield token, end, until
            if token in rank:
                own = rank[token]
                left, right = merges[own]
                pending += [(left, end - size[right], own + 1), (right, end, own)]

    for r, (a, b) in enumerate(merges):
        if a + b in rank or any(size[x] > 1 and x not in rank for x in (a, b)):
            raise ValueError(f"merge {r} uses a token before its own rule, or makes one a second time")
        reach = size[b] - 1
        for token, end, until in nodes(b, size[b], r):
            below = bisect_left(ranks_of.get(token, []), until)
            if below:
                reach = max(reach, end + reach_of[token][below - 1])
        rank[a + b] = r
        before = reach_of.setdefault(a, [])
        before.append(max(reach, before[-1]) if before else reach)
        ranks_of.setdefault(a, []).append(r)
        farthest = max(farthest, reach)
    return farthest


class Vocabulary:
    """A byte-level BPE tokenizer file: merges as arrays, the bytes of every token, special strings, lookahead."""

    def __init__(self, path: str) -> None:
        vocab, merges, special, suffix = read_vocabulary(path)
        _refuse_unknown(path, suffix)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.special = {s.encode(): i for s, i in special.items()}
        tokens = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in special.items()}}
        self.bytes_of = [b""] * (max(tokens, default=-1) + 1)
        for i, t in tokens.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        self.byte_ids = np.array([vocab[x] for x in byte_letters()], np.int32)
        self.merger = merger_of_merges(vocab, merges)
        self.lookahead = lookahead(merges, {t: len(t) for t in vocab})
        longest = max((len(a) + len(b) for a, b in merges), default=1)
        self.window = max(WINDOW, 2 * (self.lookahead + longest))
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.byte_ranks = self.rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or ``_NONE``."""
        if not len(self.pairs):
            return np.full(len(left), _NONE, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], _NONE)


def _refuse_unknown(path: str, suffix: str) -> None:
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    model, pre = content["model"], content["pre_tokenizer"] or {}
    added = content["added_tokens"]
    plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
    known = (
        model["type"] == "BPE" and content["normalizer"] is None and pre.get("type") == "ByteLevel" and plain and not suffix
        and pre["use_regex"] and not pre["add_prefix_space"] and not model["continuing_subword_prefix"] and not model["dropout"]
        and not model["ignore_merges"] and content["decoder"]["type"] == "ByteLevel"
    )
    if not known:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer, which alone is understood here")


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per process and file."""
    return Vocabulary(path)


# --- merging windows in step ------------------------------------------------------------------


def _merge_in_step(v: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge stretches of ``data``, each by its own ranks, all at once; returns a padded row of ids each, and counts.

    In every step each row that can still merge merges its lowest-ranked pair, the leftmost of equals.
    """
    width, n = int(sizes.max()), len(sizes)
    columns = np.arange(width)
    raw = data[np.minimum(starts[:, None] + columns, len(data) - 1)]
    rows = v.byte_ids[raw]
    ranks = np.full((n, width), _NONE, np.int32)
    if width > 1:
        ranks[:, :-1] = v.byte_ranks[raw[:, :-1], raw[:, 1:]]
        ranks[columns[None, :] >= (sizes - 1)[:, None]] = _NONE
    left = sizes.astype(np.int64)
    out = np.zeros((n, width), np.int32)
    live = np.arange(n)
    while len(live):
        at = ranks.argmin(axis=1)
        own = np.arange(len(live))
        lowest = ranks[own, at]
        done = lowest == _NONE
        if done.any():
            out[live[done], : rows.shape[1]] = rows[done]
            more = ~done
            live, rows, ranks, at, lowest = live[more], rows[more], ranks[more], at[more], lowest[more]
            if not len(live):
                break
            width = int(left[live].max())
            rows, ranks = rows[:, :width], ranks[:, :width]
            own = np.arange(len(live))
        rows[own, at] = v.made[lowest]
        # The pair's right side goes: what stands behind it moves up by one.
        moved = np.minimum(columns[:width] + (columns[:width] > at[:, None]), width - 1)
        rows = np.take_along_axis(rows, moved, axis=1)
        ranks = np.take_along_axis(ranks, moved, axis=1)
        left[live] -= 1
        size = left[live]
        ranks[own, size - 1] = _NONE
        inner = np.flatnonzero(at < size - 1)
        ranks[inner, at[inner]] = v.rank(rows[inner, at[inner]], rows[inner, at[inner] + 1])
        outer = np.flatnonzero(at > 0)
        ranks[outer, at[outer] - 1] = v.rank(rows[outer, at[outer] - 1], rows[outer, at[outer]])
    return out, left


class Transducer:
    """The encoder of one pre-token that arrives in pieces: ids leave it once no continuation can change them."""

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.window = v, b""

    def _merged(self) -> list[int]:
        return self.v.merger.merge(self.v.byte_ids[np.frombuffer(self.window, np.uint8)].tolist())

    def feed(self, piece: bytes) -> list[int]:
        """Take more bytes; returns the ids that have become stable."""
        out: list[int] = []
        step = self.v.window
        for at in range(0, len(piece), step):
            self.window += piece[at : at + step]
            if len(self.window) >= step:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        out, end, until = [], 0, len(self.window) - self.v.lookahead
        for i in self._merged():
            size = len(self.v.bytes_of[i])
            if end + size >= until:
                break
            out.append(i)
            end += size
        self.window = self.window[end:]
        return out

    def close(self) -> list[int]:
        """The ids of what is left at the end."""
        out, self.window = self._merged() if self.window else [], b""
        return out


def encode_pieces(v: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pre-tokens at [start, start + size) of ``data``: all ids in a row, and how many each has."""
    counts = np.zeros(len(sizes), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []  # pre-tokens, and their ids one after the other
    low = 0
    for high in (2, 4, 6, 8, 10, 12, 16, 24, 32, 48, IN_STEP):
        here = np.flatnonzero((sizes > low) & (sizes <= high))
        low = high
        for part in np.array_split(here, max(1, len(here) * high >> 21)):
            if len(part):
                rows, n = _merge_in_step(v, data, starts[part], sizes[part])
                counts[part] = n
                found.append((part, rows[np.arange(rows.shape[1]) < n[:, None]]))
    for i in np.flatnonzero(sizes > IN_STEP):
        one, begin, end = Transducer(v), int(starts[i]), int(starts[i] + sizes[i])
        ids = [np.array(one.feed(data[at : min(at + v.window, end)].tobytes()), np.int32) for at in range(begin, end, v.window)]
        every = np.concatenate([*ids, np.array(one.close(), np.int32)])
        counts[i] = len(every)
        found.append((np.array([i]), every))
    out = np.empty(int(counts.sum()), np.int32)
    place = np.cumsum(counts) - counts
    for part, ids in found:
        out[spread(place[part], counts[part])] = ids
    return out, counts


# --- texts ------------------------------------------------------------------------------------


def encode_texts(v: Vocabulary, texts: pa.Array, found: CharClasses | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a large_binary array of UTF-8 texts, one text after the other, and where each text's ids end."""
    return pretokens.coded(texts, _classes(found), lambda data, edges: _encode_block(v, data, edges), v.special, BLOCK)


@cache
def _classes(found: CharClasses | None = None) -> np.ndarray:
    """Letter, number, white space or other, of every code point, as the library's pattern engine has them."""
    out = np.frombuffer((found or char_classes()).table, np.uint8).copy()
    out[out > QUOTE] = LETTER
    out[out == QUOTE] = OTHER
    return out


def _encode_block(v: Vocabulary, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pre-tokens between neighbouring edges; each different one is merged once."""
    sizes = np.diff(edges)
    which, stand = pretokens.distinct(data, edges, v.window)  # longer ones are streamed, and not compared
    flat, counts = encode_pieces(v, data, edges[:-1][stand], sizes[stand])
    if v.special:
        flat, counts = _with_special(v, data, edges[:-1][stand], sizes[stand], flat, counts)
    place = np.cumsum(counts) - counts
    return flat[spread(place[which], counts[which])], counts[which]


def _with_special(
    v: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """A pre-token that is a special string is that string's id; pre-tokens of the pattern never are one."""
    named = np.full(len(sizes), -1, np.int64)
    for i in np.flatnonzero(np.isin(sizes, [len(s) for s in v.special])):
        named[i] = v.special.get(data[starts[i] : starts[i] + sizes[i]].tobytes(), -1)
    if (named < 0).all():
        return flat, counts
    after = np.where(named >= 0, 1, counts)
    out = np.empty(int(after.sum()), np.int32)
    place = np.cumsum(after) - after
    out[place[named >= 0]] = named[named >= 0]
    plain = np.flatnonzero(named < 0)
    out[spread(place[plain], counts[plain])] = flat[spread((np.cumsum(counts) - counts)[plain], counts[plain])]
    return out, after


# --- decoding ---------------------------------------------------------------------------------


class TextMachine:
    """Bytes to text in pieces. The state is what has arrived of a character, at most three bytes."""

    def __init__(self) -> None:
        self.begun = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and do not complete it."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80:
                return 0
            if lead >= 0xC0:
                size = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
                # Fixed by the encoding: the second byte is narrower after these leads.
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
                return back if back < size and (back == 1 or low <= data[1 - back] <= high) else 0
        return 0

    def feed(self, piece: bytes) -> str:
        data = self.begun + piece if self.begun else piece
        keep = self._unfinished(data)
        self.begun = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.begun = self.begun.decode("utf-8", "replace"), b""
        return out


@cache
def _byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, where each token's begin, and how many it has; an unknown id has none."""
    tokens = [*vocabulary(path).bytes_of, b""]
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(path: str, ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The text of each stretch of ``ids``; ids outside the vocabulary are left out, as the library leaves them out."""
    flat, begins, sizes = _byte_table(path)
    out: list[str] = []
    machine, parts = TextMachine(), []
    low, doc = 0, 0
    while doc < len(ends):
        high = int(min(max(low, ends[-1]), low + IDS))
        part = ids[low:high].astype(np.int64)
        part = np.where((part < 0) | (part >= len(sizes) - 1), len(sizes) - 1, part)
        taken = flat[spread(begins[part], sizes[part])].tobytes()
        edge = np.concatenate(([0], np.cumsum(sizes[part])))
        at = 0
        while doc < len(ends) and ends[doc] <= high:
            end = int(edge[ends[doc] - low])
            parts += [machine.feed(taken[at:end]), machine.close()]
            out.append("".join(parts))
            parts, at, doc = [], end, doc + 1
        parts.append(machine.feed(taken[at:]))
        low = high
    return out


# --- tables -----------------------------------------------------------------------------------


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text, special strings inside it included; no shuffle.

    A null or empty text has no ids. A text of any length is read in blocks; beside the text and its ids a task
    holds the arrays of one block. The class table (one byte a code point) is broadcast. Null keys and repeated rows are kept, row by row; an empty table gives an empty
    one; other columns, whatever their names, are not read.
    """
    path = path or default_path()
    shared = docs.sparkSession.sparkContext.broadcast(char_classes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, found = vocabulary(path), shared.value
        for batch in sliced(batches, 1, BLOCK):
            ids, ends = encode_texts(v, binary(batch.column(1)), found)
            edges = pa.array(np.concatenate(([0], ends)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(edges, pa.array(ids))], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, *, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ``ids`` in a column ``decoded``; null ids give an empty text.

    Ids outside the vocabulary are left out; bytes that are no UTF-8 become U+FFFD. Rows and columns stay.
    """
    path = path or default_path()
    at = encoded.columns.index("ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_ids(whole, at):
                lists = batch.column(at)
                sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = decode_ids(path, ids, np.cumsum(sizes.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in encoded.dtypes)
    return encoded.mapInArrow(work, f"{fields}, decoded string")


def _by_ids(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``IDS`` ids, or one row if it has more."""
    start, held = 0, 0
    for i, n in enumerate(pa.compute.list_value_length(batch.column(at)).fill_null(0).to_pylist()):
        if held and held + n > IDS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def op11_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded as the library would, and decoded again from its ids."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
