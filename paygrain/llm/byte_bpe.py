"""Byte-level BPE: texts to token ids and back.

Pre-tokens are found in blocks of texts (``pretokens``). Each different one of a block is looked up among those
merged before; one that is met for the first time is merged through the rank queue of ``merges``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, sliced, table
from .merges import Merger, merger_of_ranks, read_ranks
from .pretokens import LETTER, NUMBER, OTHER, SPACE, coded, distinct, spread

#: The pre-token pattern of the rank files that is understood here; others are refused.
PATTERN = public_tokenizers.PATTERN
#: Pre-tokens a worker remembers, twice over (recent ones and older ones). Results do not depend on it.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 40
#: Longer pre-tokens are not compared with others. Bytes of text that are looked at together.
LONGEST_COMPARED, BLOCK = 1 << 12, 1 << 20
_IDS = 1 << 18  # ids decoded at once


@dataclass(frozen=True)
class Classes:
    """Letters, numbers and white space as bodies of a character class."""

    letters: str
    numbers: str
    spaces: str


def _body(members: str) -> str:
    """Ranges of consecutive code points, for use between square brackets."""
    points = np.unique(np.frombuffer(members.encode("utf-32-le"), "<u4").astype(np.int64))
    cuts = np.flatnonzero(np.diff(points) > 1)
    first, last = points[np.append(0, cuts + 1)], points[np.append(cuts, len(points) - 1)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))


def every_character() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))


@cache
def tiktoken_classes() -> Classes:
    """The classes as the library's own pattern engine has them, whatever Unicode version that is of."""
    every, ranks = every_character(), {bytes([b]): b for b in range(256)}

    def members(pattern: str) -> str:
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return bytes(probe.encode_ordinary(every)).decode()

    return Classes(*(_body(members(p)) for p in (r"\p{L}", r"\p{N}", r"\s")))


class Memory(dict):
    """Results by text, made when first asked for. When full, what was not asked for since the last time is forgotten."""

    def __init__(self, make: Callable[[str], bytes], size: int = REMEMBERED) -> None:
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= self.size:
                self.older = {}  # before the copy, to hold two generations at most
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def class_table(classes: Classes) -> np.ndarray:
    """Class of every code point, for ``pretokens``."""
    out = np.full(0x110000, OTHER, np.uint8)
    for members, name in ((classes.letters, LETTER), (classes.numbers, NUMBER), (classes.spaces, SPACE)):
        for low, high in re.findall(r"\\U([0-9a-f]{8})-\\U([0-9a-f]{8})", members):
            out[int(low, 16) : int(high, 16) + 1] = name
    return out


class Encoder:
    """Token ids of whole texts, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, merger: Merger, byte_ids: list[int], classes: Classes) -> None:
        self.merger, self.byte_ids, self.classes = merger, byte_ids, class_table(classes)
        self.plain = Memory(self._merge, REMEMBERED // 4)
        self.spaced = Memory(self._merge)  # pre-tokens with a leading space

    def _merge(self, word: bytes) -> bytes:
        ids = self.byte_ids
        return np.array(self.merger.merge([ids[b] for b in word]), "<u4").tobytes()

    def _block(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which, stand = distinct(data, edges, LONGEST_COMPARED)
        raw, base, plain, spaced = data[edges[0] : edges[-1]].tobytes(), int(edges[0]), self.plain, self.spaced
        begins, ends = (edges[:-1][stand] - base).tolist(), (edges[1:][stand] - base).tolist()
        packed = [(spaced if raw[a] == 32 else plain)[raw[a:b]] for a, b in zip(begins, ends, strict=True)]
        counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        every, place = np.frombuffer(b"".join(packed), "<u4"), np.cumsum(counts) - counts
        return every[spread(place[which], counts[which])], counts[which]

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a large_binary array of texts, and where each text's ids end."""
        return coded(texts, self.classes, self._block, block=BLOCK)

    def encode(self, text: str) -> bytes:
        return self.encode_texts(pa.array([text.encode()], pa.large_binary()))[0].astype("<u4").tobytes()


@cache
def _encoder(path: str, pattern: str, classes: Classes) -> Encoder:
    """One per worker process and vocabulary."""
    if pattern != PATTERN:
        raise ValueError("only the pattern of the public byte-level rank files is understood")
    ranks = read_ranks(path)
    return Encoder(merger_of_ranks(ranks), [ranks[bytes([b])] for b in range(256)], classes)


@cache
def _tokens(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, where each token's begin, and how many it has."""
    ranks = read_ranks(path)
    by_id = dict(zip(ranks.values(), ranks, strict=True))
    tokens = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> list[pa.Array]:
    """Keys, counts and packed ids of a batch of keys and texts."""
    ids, ends = encoder.encode_texts(binary(batch.column(1)))
    edges = np.concatenate(([0], ends))
    packed = pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer((4 * edges).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())]
    )
    return [batch.column(0), pa.array(np.diff(edges)), packed]


def _decoded(path: str, packed: pa.Array) -> pa.Array:
    """The bytes of each row's packed ids."""
    flat, begins, sizes = _tokens(path)
    texts = []
    for row in packed:
        ids = np.frombuffer(row.as_buffer(), "<u4")
        texts.append(b"".join(flat[spread(begins[x], sizes[x])].tobytes() for x in np.split(ids, range(_IDS, len(ids), _IDS))))
    return pa.array(texts, pa.binary())


def encode(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN
) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (packed little-endian unsigned 32-bit integers) of every whole text.

    No shuffle and no special tokens. A null text counts as empty and has no ids. Null keys and repeated rows
    are kept; an empty table gives an empty one; a very long text is read in blocks; other columns are not read.
    """
    return _mapped(docs, key, text, path, pattern, back=False)


def round_trip(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN
) -> DataFrame:
    """As ``encode``, with the bytes that the ids decode to in a column ``decoded``: both in one pass through Python."""
    return _mapped(docs, key, text, path, pattern, back=True)


def _mapped(docs: DataFrame, key: str, text: str, path: str | None, pattern: str, back: bool) -> DataFrame:
    path, classes = path or default_path(), tiktoken_classes()
    names = ["key", "n_tokens", "ids", *(["decoded"] if back else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern, classes)
        for batch in sliced(batches, 1):
            columns = _encoded(encoder, batch)
            yield pa.RecordBatch.from_arrays([*columns, _decoded(path, columns[2])] if back else columns, names)

    kind = docs.schema[key].dataType.simpleString()
    fields = f"key {kind}, n_tokens bigint, ids binary" + (", decoded binary" if back else "")
    return docs.select(key, text).mapInArrow(work, fields).withColumnRenamed("key", key)


def decode(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """``encoded`` with the bytes of its ``ids`` in a column ``decoded``; null ids decode to nothing."""
    path = path or default_path()
    at = encoded.columns.index("ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            decoded = _decoded(path, binary(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in encoded.dtypes)
    return encoded.mapInArrow(work, f"{fields}, decoded binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again from its ids."""
    both = round_trip(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
