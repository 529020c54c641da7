"""Pre-tokens of the byte-level pattern in whole blocks of texts, found from neighbouring characters.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?O+|\\s+(?!\\S)|\\s+`` with letters L, numbers N and other signs O; which
characters are which is the caller's, as engines differ in that.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection

import numpy as np
import pyarrow as pa

#: Classes of characters.
SPACE, LETTER, NUMBER, OTHER = range(4)
_AROUND = 16  # bytes on either side of a block that its first and last characters depend on


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all members of the stretches [start, start + size), one stretch after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def pre_token_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where a pre-token starts. ``points`` are characters, ``first`` is true where a text of its own begins.

    The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?O+|\\s+(?!\\S)|\\s+`` as rules on neighbours: a run of one
    class starts one, unless a plain space before it does; the last white space before another character starts
    one, and a contraction starts and ends one where no space or sign stands before its apostrophe.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = classes[points]
    blank, plain = kind == SPACE, points == 32
    before = np.concatenate(([SPACE], kind[:-1])).astype(np.uint8)
    after_plain = np.concatenate(([False], plain[:-1])) & ~first
    start = first | ((kind != before) & ~after_plain)
    # The last of some white space, where something other than white space follows in the same text.
    last = blank[:-1] & ~blank[1:] & ~first[1:]
    start[:-1] |= last
    quotes = np.flatnonzero((points == 39) & (first | ((before != OTHER) & ~after_plain)))
    if len(quotes):
        padded, closed = np.append(points, [0, 0]), np.append(first, [True, True])
        one, two = padded[quotes + 1], padded[quotes + 2]
        one = np.where(closed[quotes + 1], 0, one)
        two = np.where(closed[quotes + 1] | closed[quotes + 2], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[quotes[short | long] + 1] = False
        ends = np.concatenate((quotes[short] + 2, quotes[long] + 3))
        start[ends[ends < n]] = True
    return start


def _char_edge(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where a character begins."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def _special_places(special: Collection[bytes], data: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """Where special strings stand inside a text, leftmost first, the longest of those that start together."""
    if not special:
        return []
    find = re.compile(b"|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)))
    raw = memoryview(data)
    if not find.search(raw):
        return []
    return [(m.start() + a, m.end() + a) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) for m in find.finditer(raw[a:b])]


def coded(
    texts: pa.Array, classes: np.ndarray, code: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    special: Collection[bytes] = (), block: int = 1 << 22,
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a large_binary array of UTF-8 texts, one text after the other, and where each text's ids end.

    ``code`` gets the bytes and the edges of neighbouring pre-tokens, a block at a time, and returns their ids in a row
    and how many each has. A special string is a pre-token, and what stands beside it a text of its own.
    """
    _, offsets, raw = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.empty(0, np.uint8)
    at = at - at[0]
    places = _special_places(special, data, at)
    own = np.unique(np.concatenate((at[:-1], np.array(places, np.int64).ravel())))
    ids: list[np.ndarray] = []
    ends = np.zeros(len(at) - 1, np.int64)
    total, open_at, low = 0, 0, 0  # open_at: where the pre-token starts that the next block may continue
    while low < len(data):
        high = _char_edge(data, min(low + block, len(data)))
        begin = _char_edge(data, max(0, low - _AROUND))
        end = _char_edge(data, min(len(data), high + _AROUND))
        chars = np.frombuffer(data[begin:end].tobytes().decode().encode("utf-32-le"), "<u4")
        place = begin + np.cumsum(1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))
        place = np.concatenate(([begin], place[:-1]))
        first = np.zeros(len(chars), bool)
        mine = own[(own >= begin) & (own < end)]
        first[np.searchsorted(place, mine)] = True
        here = place[pre_token_starts(chars, first, classes)]
        here = here[(here >= low) & (here < high)]
        for a, b in places:
            if a < high and b > low:
                here = here[(here <= a) | (here >= b)]
        starts = here if not len(here) or here[0] == open_at else np.append(open_at, here)
        if high == len(data):
            edges = np.append(starts if len(starts) else [open_at], high)
        elif len(starts) < 2:  # still inside one long pre-token
            low = high
            continue
        else:
            edges = starts
        found, counts = code(data, edges)
        running = total + np.concatenate(([0], np.cumsum(counts)))
        done = np.flatnonzero((at[1:] > edges[0]) & (at[1:] <= edges[-1]))
        ends[done] = running[np.searchsorted(edges, at[1:][done])]
        ids.append(found)
        total, open_at, low = int(running[-1]), int(edges[-1]), high
    # An empty text ends where the one before it does.
    return np.concatenate(ids) if ids else np.empty(0, np.int32), np.maximum.accumulate(ends)


def distinct(data: np.ndarray, edges: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Which different pre-token each one between neighbouring edges is, and the first place of each different one.

    Those of more than ``longest`` bytes are not compared, each counts as different.
    """
    sizes, base = np.diff(edges), int(edges[0])
    long = sizes > longest
    known = np.packbits(~long, bitorder="little")
    plain = pa.Array.from_buffers(
        pa.large_binary(), len(sizes),
        [pa.py_buffer(known.tobytes()), pa.py_buffer((edges - base).astype(np.int64).tobytes()), pa.py_buffer(data[base : int(edges[-1])])],
        null_count=int(long.sum()),
    )
    indices = plain.dictionary_encode()
    which = indices.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    different = len(indices.dictionary)
    which[long] = different + np.arange(int(long.sum()))
    stand = np.empty(different + int(long.sum()), np.int64)
    stand[which[::-1]] = np.arange(len(which))[::-1]
    return which, stand
