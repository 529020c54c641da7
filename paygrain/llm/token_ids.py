"""Documents as token ids in a binary format of its own, in the order of their ids, and back.

The format is a table of segments (see ``id_coder``): each row holds one self-contained, checksummed byte
string with the ids of consecutive documents. Spark's committer publishes the table, so a lost task leaves
nothing behind, and any store will do.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from paygrain.session import scratch_path

from .common import binary, sliced, table
from .id_coder import BLOCK, LANES, decode_segment, encode_segment
from .pretokens import spread

END = 0
#: A segment is closed by the document that brings it to so many ids.
SEGMENT_IDS = BLOCK * LANES
#: Pieces a worker remembers, and up to which length. Results do not depend on it.
PIECES, LONGEST_REMEMBERED = 900_000, 40
#: Bytes of text whose pieces are compared at once, unless they are longer than that each; new pieces a call of the library gets.
TEXT_BLOCK, _LONGEST_COMPARED, _TOGETHER = 1 << 23, 1 << 12, 256


def _kinds() -> tuple[bytes, bytes, bytes]:
    """By byte: 1, 2, 3 for a letter, number or sign of ASCII, apart from the apostrophe; is it ASCII white space; does it begin a visible character?"""
    signs = np.zeros(256, np.uint8)
    signs[0x21:0x7F] = 3
    signs[ord("0") : ord("9") + 1] = 2
    for first, last in ("AZ", "az"):
        signs[ord(first) : ord(last) + 1] = 1
    visible = signs > 0
    signs[ord("'")] = 0
    # Of the characters beyond ASCII, those of these lead bytes hold no white space.
    for low, high in ((0xC3, 0xE0), (0xE4, 0xEF), (0xF0, 0xF5)):
        visible[low:high] = True
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return signs.tobytes(), blank.tobytes(), visible.tobytes()


_SIGNS, _BLANK, _VISIBLE = _kinds()  # for bytes.translate


def _piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces start in ``data``, whose texts lie between neighbours of ``at``.

    At each such place the byte-level pre-tokenizer starts a pre-token whatever stands farther off: at white space
    before a visible character, behind it if it is no plain space, and where ASCII letters, numbers and signs meet.
    """
    starts = np.zeros(len(data) + 1, bool)
    starts[at] = True
    for low in range(0, len(data), TEXT_BLOCK):
        high = min(low + TEXT_BLOCK, len(data))
        around = np.zeros(high - low + 2, np.uint8)
        around[low == 0 : high - low + 1 + (high < len(data))] = data[max(0, low - 1) : high + 1]
        raw = around.tobytes()
        kind, blank, visible = (np.frombuffer(raw.translate(x), t) for x, t in ((_SIGNS, np.uint8), (_BLANK, bool), (_VISIBLE, bool)))
        found = (kind[1:-1] != kind[:-2]) & (kind[1:-1] > 0) & (kind[:-2] > 0)
        found |= blank[:-2] & (around[:-2] != 32) & visible[1:-1]
        found |= blank[1:-1] & visible[2:] & ~starts[low + 1 : high + 1]
        starts[low:high] |= found
    return np.flatnonzero(starts[:-1])


def _stretches(data: np.ndarray, edges: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """What lies between neighbouring edges of ``data``; nulls where not ``known``."""
    base = int(edges[0])
    bits = None if known is None else pa.py_buffer(np.packbits(known, bitorder="little").tobytes())
    offsets = np.ascontiguousarray(edges - base, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [bits, pa.py_buffer(offsets), pa.py_buffer(data[base : int(edges[-1])])])


def _members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and edges of a large_binary array."""
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), edges


def _different(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Which different piece each one between neighbouring edges is, and these. Very long ones are not compared, each counts as different."""
    long = np.diff(edges) > _LONGEST_COMPARED
    if not long.any():
        found = _stretches(data, edges).dictionary_encode()
        return found.indices.to_numpy(), found.dictionary
    every = _stretches(data, edges)
    found = _stretches(data, edges, ~long).dictionary_encode()
    which = found.indices.fill_null(0).to_numpy(zero_copy_only=False).copy()
    which[long] = len(found.dictionary) + np.arange(int(long.sum()))
    return which, pa.concat_arrays([found.dictionary, every.filter(pa.array(long))])


class LibraryEncoder:
    """Ids as the tokenizers library gives them, special strings in texts included.

    Texts are cut where the byte-level pre-tokenizer starts a pre-token in any case. Each different piece of a
    block that is not remembered goes through the library once, with others in one text; a text is the sum of
    its pieces. Texts of other tokenizers go through the library whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        rules = json.loads(tokenizer.to_str())
        pre, model = rules["pre_tokenizer"] or {}, rules["model"]
        self.plain = (
            rules["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
        )
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        vocab = tokenizer.get_vocab()
        self.size = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # bytes, as every letter of a token stands for one
        for token, i in vocab.items():
            self.size[i] = len(token)
        #: What is remembered: pieces, their ids in a row, how many each has, and whether they were asked for lately.
        self.pieces, self.ids = pa.array([], pa.large_binary()), np.empty(0, "<u4")
        self.counts, self.asked = np.empty(0, np.int64), np.empty(0, bool)

    def _has_special(self, text: bytes) -> bool:
        return any(x in text for x in self.special)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _together(self, text: bytes, ends: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the pieces that end at ``ends`` of a text, without the line feeds before those that are ``apart``; and their counts."""
        if self._has_special(text):
            return None
        ids = np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")
        until = np.cumsum(self.size[ids])
        stops = np.searchsorted(until, ends) + 1
        if stops[-1] != len(ids) or (until[stops - 1] != ends).any():
            return None
        begins = np.concatenate(([0], stops[:-1]))
        return np.delete(ids, begins[apart]), stops - begins - apart

    def _encoded(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces between neighbouring edges and how many each has, from the library.

        Pieces that begin with a visible character, or with one behind a plain space, are read as one text. A line feed
        parts those without a space: before a visible character it is a pre-token of its own.
        """
        sizes, first = np.diff(edges), data[edges[:-1]]
        behind = data[edges[:-1] + ((first == 32) & (sizes > 1))]
        joined = np.frombuffer(behind.tobytes().translate(_VISIBLE), bool) & (sizes <= _LONGEST_COMPARED) & self.plain
        counts, found = np.zeros(len(sizes), np.int64), []
        alone = np.flatnonzero(~joined).tolist()
        joined = np.flatnonzero(joined)
        for low in range(0, len(joined), _TOGETHER):
            some = joined[low : low + _TOGETHER]
            apart = first[some] != 32
            text = data[spread(edges[some], sizes[some])]
            ends = np.cumsum(sizes[some])
            text = np.insert(text, (ends - sizes[some])[apart], 10).tobytes()
            made = self._together(text, ends + np.cumsum(apart), apart)
            if made is None:
                alone += some.tolist()
            else:
                found.append((some, made[0]))
                counts[some] = made[1]
        for i in alone:
            ids = self._whole(data[edges[i] : edges[i + 1]].tobytes())
            found.append((np.array([i]), ids))
            counts[i] = len(ids)
        out, place = np.empty(int(counts.sum()), "<u4"), np.cumsum(counts) - counts
        for part, ids in found:
            out[spread(place[part], counts[part])] = ids
        return out, counts

    def _block(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces between neighbouring edges, and where the ids of each end."""
        which, pieces = _different(data, edges)
        at = pa.compute.index_in(pieces, value_set=self.pieces).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        self.asked[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        at[new] = len(self.counts) + np.arange(len(new))
        made = pieces.take(pa.array(new))
        ids, counts = self._encoded(*_members(made))
        ids, counts = np.concatenate((self.ids, ids)), np.concatenate((self.counts, counts))
        places = 4 * np.concatenate(([0], np.cumsum(counts)))
        taken, ends = _members(_stretches(ids.view(np.uint8), places).take(pa.array(at[which])))
        self._remember(made, ids, counts)
        return taken[: ends[-1]].view("<u4"), ends[1:] >> 2

    def _remember(self, new: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep short ones of the ``new`` pieces, whose ids and counts come after those that are remembered."""
        old = len(self.counts)
        kept, begins = np.arange(old), np.cumsum(counts) - counts
        short = np.flatnonzero(np.diff(_members(new)[1]) <= LONGEST_REMEMBERED)
        if old + len(short) > PIECES:
            # What was not asked for since the last time goes, and the older ones of the others, if those are many.
            kept = np.flatnonzero(self.asked)[-(PIECES // 2) :]
            self.asked = np.zeros(old, bool)
            short = short[: PIECES - len(kept)]
        own = np.concatenate((kept, old + short))
        self.pieces = pa.concat_arrays([self.pieces.take(pa.array(kept)) if len(kept) < old else self.pieces, new.take(pa.array(short))])
        self.ids = ids[spread(begins[own], counts[own])] if len(own) < len(counts) else ids
        self.counts, self.asked = counts[own], np.concatenate((self.asked[kept], np.ones(len(short), bool)))

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a large_binary array of UTF-8 texts, one text after the other, and where each text's ids end."""
        _, offsets, raw = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.empty(0, np.uint8)
        at = at - at[0]
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        edges = np.append(_piece_starts(data, at) if self.plain else np.unique(at[:-1][at[:-1] < len(data)]), len(data))
        if self._has_special(data.tobytes()):
            edges = self._uncut(data, at, edges)
        ids, running = [], [np.zeros(1, np.int64)]
        low = 0
        while low < len(edges) - 1:
            high = max(low + 1, int(np.searchsorted(edges, edges[low] + TEXT_BLOCK, "right")) - 1)
            found = self._block(data, edges[low : high + 1])
            ids.append(found[0])
            running.append(found[1] + running[-1][-1])
            low = high
        return np.concatenate(ids), np.concatenate(running)[np.searchsorted(edges, at[1:])]

    def _uncut(self, data: np.ndarray, at: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The edges without those inside texts that have a special string, which is matched across pieces."""
        raw = data.tobytes()
        special = [any(raw.find(x, a, b) >= 0 for x in self.special) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        text = np.searchsorted(at, edges, "right") - 1
        return edges[~np.append(special, False)[text] | (edges == at[text])]

    def encode(self, text: str) -> bytes:
        return self.encode_texts(pa.array([text.encode()], pa.large_binary()))[0].tobytes()


@cache
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def write_ids(
    docs: DataFrame, out: str, *, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every whole text, append ``end``, and write segments in ascending order of ``key`` below ``out``.

    One shuffle, by ranges of ``key`` and a hash of the text, which also splits a key that very many rows share.
    Null keys come first. A null text counts as empty. Other columns are not read.
    """
    path = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = _encoder(path)
        keys: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        size = seq = 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(keys, lengths, np.concatenate(parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(keys)], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                ["part", "seq", "n_docs", "n_ids", "data"],
            )

        for batch in sliced(batches, 1, TEXT_BLOCK):
            ids, ends = encoder.encode_texts(binary(batch.column(1)))
            ids = np.insert(ids, ends, end)
            ends = ends + np.arange(1, len(ends) + 1)
            own, low, taken = batch.column(0).to_pylist(), 0, 0  # documents and ids that are in segments
            while low < len(own):
                # Up to the document that fills the segment.
                high = min(int(np.searchsorted(ends, taken + segment_ids - size)) + 1, len(own))
                until = int(ends[high - 1])
                keys += own[low:high]
                lengths += np.diff(ends[low:high], prepend=taken).tolist()
                parts.append(ids[taken:until])
                size += until - taken
                low, taken = high, until
                if size >= segment_ids:
                    yield segment()
                    keys, lengths, parts, size, seq = [], [], [], 0, seq + 1
        if keys:
            yield segment()

    tie = "__ids_tie"
    rows = docs.select(F.col(key).cast("long").alias(key), text, F.xxhash64(text).alias(tie))
    ordered = rows.repartitionByRange(key, tie).sortWithinPartitions(key, tie).select(key, text)
    ordered.mapInArrow(work, "part int, seq int, n_docs bigint, n_ids bigint, data binary").write.parquet(out)


def starts(spark: SparkSession, out: str) -> DataFrame:
    """(part, seq, start): ids before each segment. Sums within a part, then over the parts, of which there is one per task."""
    sizes = spark.read.parquet(out).select("part", "seq", "n_ids")
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = sizes.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside"))
    return inside.join(base, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("start"))


def read_documents(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` (ids of all documents before it), ``n_tokens`` and the packed ``ids`` of every document."""
    return _read(spark, out, key, "ids binary", lambda ids: pa.array([x.tobytes() for x in ids], pa.binary()))


def read_checksums(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """As ``read_documents``, with the CRC32 of each document's packed ids in place of the ids."""
    return _read(spark, out, key, "ids_crc32 bigint", lambda ids: pa.array([zlib.crc32(x) for x in ids], pa.int64()))


def _read(spark: SparkSession, out: str, key: str, field: str, made) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, lengths, ids = decode_segment(batch.column(2)[i].as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                begins = ends - lengths.astype(np.int64)
                n = len(keys)
                for low in range(0, n, 4096):
                    high = min(low + 4096, n)
                    own = [ids[b:e] for b, e in zip(begins[low:high].tolist(), ends[low:high].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[i].as_py()] * (high - low), pa.int32()),
                         pa.array([batch.column(1)[i].as_py()] * (high - low), pa.int32()),
                         pa.array(keys[low:high], pa.int64()), pa.array(begins[low:high]),
                         pa.array(lengths[low:high].astype(np.int64)), made(own)],
                        ["part", "seq", "key", "begin", "n_tokens", field.split()[0]],
                    )

    rows = spark.read.parquet(out).select("part", "seq", "data")
    rows = rows.mapInArrow(work, f"part int, seq int, key bigint, begin bigint, n_tokens bigint, {field}")
    placed = rows.join(starts(spark, out), ["part", "seq"])
    return placed.select(F.col("key").alias(key), (F.col("start") + F.col("begin")).alias("start"), "n_tokens", field.split()[0])


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as ids and read back."""
    out = scratch_path(spark, "llm-token-ids")
    write_ids(table(spark, sf_dir, "documents"), out)
    return read_checksums(spark, out)
