"""Token ids as compressed binary segments: an adaptive context-mixing range coder over blocks.

A segment holds the ids of consecutive documents. Its head has the document table and the frequencies of its
ids (order 0). The ids are cut into blocks of ``BLOCK``; each block starts from the same fresh state, has a
CRC32 of its ids and can be decoded alone. Inside a block two tables, indexed by the last id (order 1) and the
last two ids (order 2), predict the next id with a confidence. How far either prediction is trusted is learned
as the block goes on, from hits and misses per pair of confidences; what is left of the probability goes to
order 0. One step of a carry-free range coder with 64-bit bounds codes the id under that mixture.

Blocks do not depend on each other, so all blocks of a segment are coded in step: position t of every block
at once, in numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np

BLOCK = 2048
LANES = 2048  # blocks coded together
MAGIC = b"PGID\x02"
_TABLE = 512  # entries of either prediction table of a block
#: Trust in a prediction is a 12-bit probability, kept between 31 and 4,032, so that what is left of a span never vanishes.
_HALF, _BITS, _RATE = 2048, np.uint64(12), np.uint64(5)
#: Two trusts in one number: the bits of both and what a right prediction adds.
_FIELD, _LOWER = np.uint64(16), np.uint64(0xFFFF)
_OF_TWO, _OF_BOTH = np.uint64(0x7F << 16), np.uint64(0x7F << 16 | 0x7F)
_GAIN_TWO, _GAIN_ONE, _ONE = np.uint64(126 << 16), np.uint64(126), np.uint64(1)
_BOTTOM, _U32, _HALF_WORD = np.uint64(1 << 32), np.uint64(32), np.uint64((1 << 32) - 1)


class Damaged(ValueError):
    """A segment that is cut off or whose checksum does not fit."""


def _frequencies(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Counts scaled to a power of two, at least 1 each; and that power."""
    scale = max(18, int(len(counts)).bit_length() + 1)
    if scale > 20:
        raise ValueError("too many different ids in one segment")
    room = (1 << scale) - len(counts)
    out = counts.astype(np.int64) * room // int(counts.sum()) + 1
    out[np.argmax(counts)] += (1 << scale) - int(out.sum())
    return out, scale


class _Table:
    """Per block the last id after each context, and how often it came in a row: the predictions of one order."""

    def __init__(self, lanes: int, n_symbols: int) -> None:
        self.lane = np.arange(lanes) * _TABLE
        self.entries = np.full(lanes * _TABLE, n_symbols << 2, np.int32)
        self.at = self.lane.copy()
        self.entry, self.predicted, self.fresh = (np.empty(lanes, np.int32) for _ in range(3))

    def look(self) -> np.ndarray:
        """The predicted symbols."""
        self.entries.take(self.at, out=self.entry, mode="clip")
        return np.right_shift(self.entry, 2, out=self.predicted)

    def learn(self, symbol: np.ndarray, right: np.ndarray, context: np.ndarray) -> None:
        """Note what came; ``right``: blocks where it was predicted. Then go to the next context (a hash)."""
        fresh = np.left_shift(symbol, 2, out=self.fresh)
        known = self.entry[right]
        fresh[right] = known + ((known & 3) < 3)
        self.entries[self.at] = fresh
        np.bitwise_and(context, _TABLE - 1, out=self.at)
        self.at += self.lane


def _orders(lanes: int, n_symbols: int) -> tuple[_Table, _Table, np.ndarray, np.ndarray]:
    return _Table(lanes, n_symbols), _Table(lanes, n_symbols), np.zeros(lanes, np.int64), np.empty(lanes, np.int64)


def _contexts(symbol: np.ndarray, before: np.ndarray, hashed: np.ndarray) -> None:
    """The hash of the last id into ``hashed``, that of the last two into ``before``, which held that of the one before."""
    np.multiply(symbol, 40503, out=hashed, dtype=np.int64)
    hashed >>= 4
    before *= 29
    before ^= hashed


class _Trust:
    """How far either prediction is trusted, learned per block and pair of confidences."""

    def __init__(self, lanes: int) -> None:
        self.lane = np.arange(lanes) * 16
        #: Trust in order 2 (upper half) and, where that is wrong, in order 1.
        self.states = np.full(lanes * 16, _HALF >> 1 << 16 | _HALF >> 1, np.uint64)
        self.row = np.empty(lanes, np.int64)
        self.t, self.u, self.first, self.second = (np.empty(lanes, np.uint64) for _ in range(4))

    def cut(self, span: np.ndarray, confidence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cut the span: below the first bound lies the prediction of order 2, up to the second that of order 1."""
        t, u, first, second = self.t, self.u, self.first, self.second
        np.add(self.lane, confidence, out=self.row)
        self.states.take(self.row, out=t, mode="clip")
        np.right_shift(span, _BITS, out=first)
        first *= np.right_shift(t, _FIELD, out=u)
        np.subtract(span, first, out=second)
        second >>= _BITS
        second *= np.bitwise_and(t, _LOWER, out=u)
        second += first
        return first, second

    def learn(self, two: np.ndarray, one: np.ndarray) -> None:
        """Blocks where order 2 was right, and where order 1 was.

        Each trust loses a part of itself, and gains as much of the whole if right. Order 1 is not asked where order 2 is right.
        """
        t, u = self.t, self.u
        np.right_shift(t, _RATE, out=u)
        u &= _OF_BOTH
        u[one] -= _GAIN_ONE
        u[two] = (t[two] >> _RATE & _OF_TWO) - _GAIN_TWO
        t -= u
        self.states[self.row] = t


def _places(freq: np.ndarray) -> np.ndarray:
    """Per symbol the sum of the frequencies before it (upper half) and its own."""
    return ((np.cumsum(freq) - freq) << 32 | freq).astype(np.uint64)


def _encode_lanes(grid: np.ndarray, freq: np.ndarray, scale: int) -> list[bytes]:
    """Code the rows of ``grid`` (symbols), one byte string each."""
    lanes, steps = grid.shape
    rows = np.ascontiguousarray(grid.T)
    # The predictions do not depend on the code: first what all of them are worth.
    order_1, order_2, before, hashed = _orders(lanes, len(freq))
    confidence, hits = np.empty((steps, lanes), np.uint8), []
    for symbol, mixed in zip(rows, confidence, strict=True):
        two, one = np.flatnonzero(order_2.look() == symbol), np.flatnonzero(order_1.look() == symbol)
        np.bitwise_or((order_2.entry & 3) << 2, order_1.entry & 3, out=mixed, casting="unsafe")
        _contexts(symbol, before, hashed)
        order_2.learn(symbol, two, before)
        order_1.learn(symbol, one, hashed)
        before, hashed = hashed, before
        hits.append((two.astype(np.int32), one.astype(np.int32)))
    shift, place = np.uint64(scale), _places(freq)
    trust = _Trust(lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words = np.zeros((lanes, steps // 2 + 64), np.uint64)  # of 32 bits, and what was carried into them
    flat, row_at, used = words.ravel(), np.arange(lanes) * words.shape[1], np.zeros(lanes, np.int64)
    from_, part, own = (np.empty(lanes, np.uint64) for _ in range(3))

    def move(at: np.ndarray) -> None:
        nonlocal words, flat, row_at
        here = used[at]
        if len(here) and here.max() >= words.shape[1]:
            words = np.concatenate((words, np.zeros_like(words)), axis=1)
            flat, row_at = words.ravel(), np.arange(lanes) * words.shape[1]
        lo = low[at]
        flat[row_at[at] + here] = lo >> _U32
        used[at] = here + 1
        low[at] = lo << _U32

    for symbol, mixed, (two, one) in zip(rows, confidence, hits, strict=True):
        first, second = trust.cut(span, mixed)
        np.subtract(span, second, out=part)
        part >>= shift
        place.take(symbol, out=own, mode="clip")
        np.right_shift(own, _U32, out=from_)
        from_ *= part
        from_ += second
        own &= _HALF_WORD
        part *= own
        from_[one] = first[one]
        part[one] = second[one] - first[one]
        from_[two] = 0
        part[two] = first[two]
        part, span = span, part
        low += from_
        over = np.flatnonzero(low < from_)
        if len(over):
            flat[row_at[over] + used[over] - 1] += _ONE
        trust.learn(two, one)
        at = np.flatnonzero(span < _BOTTOM)
        if len(at):
            move(at)
            span[at] <<= _U32
    every = np.arange(lanes)
    for _ in range(2):
        move(every)
    for i in range(int(used.max()) - 1, 0, -1):
        words[:, i - 1] += words[:, i] >> _U32
    return [words[i, : used[i]].astype(np.uint32).astype(">u4").tobytes() for i in range(lanes)]


def _decode_lanes(coded: Sequence[bytes], steps: int, freq: np.ndarray, scale: int) -> np.ndarray:
    lanes = len(coded)
    shift, place = np.uint64(scale), _places(freq)
    symbol_of = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
    last_part = np.uint64((1 << scale) - 1)
    order_1, order_2, before, hashed = _orders(lanes, len(freq))
    trust = _Trust(lanes)
    sizes = np.array([len(c) // 4 for c in coded]) + 2  # zeros behind each, for what is damaged
    words = np.frombuffer(b"".join(x for c in coded for x in (c[: len(c) // 4 * 4], bytes(8))), ">u4").astype(np.uint64)
    limit = np.cumsum(sizes) - 1
    at_word = limit + 1 - sizes
    span = np.full(lanes, (1 << 64) - 1, np.uint64)
    ahead = words[at_word] << _U32 | words[at_word + 1]  # how far the code is above the low end of the span
    at_word += 2
    from_, part, own = (np.empty(lanes, np.uint64) for _ in range(3))
    mixed = np.empty(lanes, np.int32)
    grid = np.empty((steps, lanes), np.int32)
    for symbol in grid:
        order_2.look()
        order_1.look()
        np.bitwise_and(order_2.entry, 3, out=mixed)
        mixed <<= 2
        mixed |= order_1.entry & 3
        first, second = trust.cut(span, mixed)
        two, hit = np.flatnonzero(ahead < first), np.flatnonzero(ahead < second)
        np.subtract(span, second, out=part)
        part >>= shift
        np.subtract(ahead, second, out=own)
        own //= part
        np.minimum(own, last_part, out=own)
        symbol_of.take(own.view(np.int64), out=symbol, mode="clip")
        place.take(symbol, out=own, mode="clip")
        np.right_shift(own, _U32, out=from_)
        from_ *= part
        from_ += second
        own &= _HALF_WORD
        part *= own
        symbol[hit] = order_1.predicted[hit]
        from_[hit] = first[hit]
        part[hit] = second[hit] - first[hit]
        symbol[two] = order_2.predicted[two]
        from_[two] = 0
        part[two] = first[two]
        part, span = span, part
        ahead -= from_
        one = np.flatnonzero(order_1.predicted == symbol)
        two = np.flatnonzero(order_2.predicted == symbol)
        trust.learn(two, one)
        _contexts(symbol, before, hashed)
        order_2.learn(symbol, two, before)
        order_1.learn(symbol, one, hashed)
        before, hashed = hashed, before
        at = np.flatnonzero(span < _BOTTOM)
        if len(at):
            span[at] <<= _U32
            here = at_word[at]
            ahead[at] = ahead[at] << _U32 | words[np.minimum(here, limit[at])]
            at_word[at] = here + 1
    return np.minimum(grid.T, len(freq) - 1)  # beyond that only if the input is damaged


def _packed(values: np.ndarray, kind: str) -> bytes:
    body = zlib.compress(np.ascontiguousarray(values, kind).tobytes(), 6)
    return struct.pack("<Q", len(body)) + body


def _symbols(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ids in order, the place of each id among them, and how often each occurs."""
    if len(ids) and ids.max() < 1 << 22:
        counts = np.bincount(ids)
        known = np.flatnonzero(counts)
        place = np.zeros(len(counts), np.int32)
        place[known] = np.arange(len(known))
        return known, place[ids], counts[known]
    return np.unique(ids, return_inverse=True, return_counts=True)


def encode_segment(keys: Sequence[int | None], lengths: Sequence[int], ids: np.ndarray) -> bytes:
    """One segment: keys and numbers of ids of its documents, and all their ids one after the other."""
    ids = np.ascontiguousarray(ids, "<u4")
    known, symbols, counts = _symbols(ids)
    blocks = -(-len(ids) // BLOCK)
    checks = [zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK]) for i in range(blocks)]
    coded: list[bytes] = []
    if blocks:
        grid = np.zeros(blocks * BLOCK, np.int32)
        grid[: len(ids)] = symbols
        grid = grid.reshape(blocks, BLOCK)
        freq, scale = _frequencies(counts)
        # A single short block need not be filled up.
        grid = grid[:, : len(ids)] if blocks == 1 else grid
        for start in range(0, blocks, LANES):
            coded += _encode_lanes(grid[start : start + LANES], freq, scale)
    head = b"".join(
        (
            struct.pack("<QQ", len(lengths), len(ids)),
            _packed(np.array([0 if k is None else k for k in keys]), "<i8"),
            _packed(np.array([k is None for k in keys]), "u1"),
            _packed(np.array(lengths), "<u8"),
            _packed(np.diff(known.astype(np.int64), prepend=0), "<u4"),
            _packed(counts, "<u4"),
            _packed(np.array(checks), "<u4"),
            _packed(np.array([len(c) for c in coded]), "<u4"),
        )
    )
    return MAGIC + struct.pack("<QI", len(head), zlib.crc32(head)) + head + b"".join(coded)


def decode_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, numbers of ids, and ids. Every checksum is compared; ``Damaged`` if one does not fit."""
    if data[: len(MAGIC)] != MAGIC:
        raise Damaged("this is no segment of ids")
    size, check = struct.unpack_from("<QI", data, len(MAGIC))
    begin = len(MAGIC) + 12
    head = data[begin : begin + size]
    if len(head) != size or zlib.crc32(head) != check:
        raise Damaged("the head of the segment is damaged")
    n_docs, n_ids = struct.unpack_from("<QQ", head)
    at, fields = 16, []
    for kind in ("<i8", "u1", "<u8", "<u4", "<u4", "<u4", "<u4"):
        (n,) = struct.unpack_from("<Q", head, at)
        fields.append(np.frombuffer(zlib.decompress(head[at + 8 : at + 8 + n]), kind))
        at += 8 + n
    keys, none, lengths, steps, counts, checks, sizes = fields
    known = np.cumsum(steps.astype(np.int64)).astype("<u4")
    ids = np.empty(0, "<u4")
    if len(sizes):
        ends = begin + size + np.cumsum(sizes.astype(np.int64))
        coded = [data[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        if ends[-1] != len(data):
            raise Damaged("the segment breaks off")
        freq, scale = _frequencies(counts)
        length = n_ids if len(sizes) == 1 else BLOCK
        parts = [_decode_lanes(coded[i : i + LANES], length, freq, scale) for i in range(0, len(coded), LANES)]
        ids = known[np.concatenate(parts).ravel()[:n_ids]]
    for i, check in enumerate(checks.tolist()):
        if zlib.crc32(np.ascontiguousarray(ids[i * BLOCK : (i + 1) * BLOCK])) != check:
            raise Damaged(f"block {i} does not match its checksum")
    return [None if z else int(k) for k, z in zip(keys, none, strict=True)], lengths, ids
