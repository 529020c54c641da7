"""Token counts by a finite-state transducer over whole texts and remembered merges.

A deterministic transducer is compiled for the pre-tokenizer of a tokenizer file. It reads the class of each
character and marks where pre-tokens start; where a start is known only later (after an apostrophe, which
may open a contraction), the transition marks the earlier place. How many
tokens the vocabulary's merges leave of a pre-token is found by merging when it is first met, and remembered.

The transducer does not run from the left. Texts are cut into chunks; for each chunk the state map
(start state to end state) is built by all chunks at once, neighbouring maps are composed by a parallel
prefix scan, and with every chunk's start state known all chunks emit their marks at once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .byte_bpe import every_character
from .common import sliced, strings, table
from .merges import Merger, byte_letters, merger_of_merges, read_vocabulary

#: The normaliser and pre-tokenizer that are compiled here; a file with others is refused.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LIMIT = 2048
CHUNK = 256
#: Pre-tokens whose transitions a worker keeps; when full, it starts afresh. Counts do not depend on it.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 48

# Character classes. The letters that occur in contractions have their own.
SPACE, LETTER, NUMBER, OTHER, QUOTE, ONE, R, V, L, E = range(10)
#: States: between pre-tokens, in letters, in other signs, after an opening apostrophe, and after '\''r, '\''v, '\''l.
FRESH, WORD, SIGNS, OPEN, OPEN_R, OPEN_V, OPEN_L = range(7)
#: Marks of a transition: a pre-token starts here, one started a character earlier.
HERE, BEFORE = 1, 2


def _compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """next state and marks, by state and class."""
    follow = np.zeros((7, 10), np.uint8)
    marks = np.zeros((7, 10), np.uint8)
    letters = (LETTER, ONE, R, V, L, E)
    for state in range(7):
        for char in range(10):
            if char == SPACE:
                follow[state, char] = FRESH
            elif char == NUMBER:  # each number is a pre-token of its own
                follow[state, char], marks[state, char] = FRESH, HERE
            elif char in letters:
                follow[state, char], marks[state, char] = WORD, 0 if state == WORD else HERE
            elif char == OTHER:
                follow[state, char], marks[state, char] = SIGNS, 0 if state in (SIGNS, OPEN) else HERE
            else:  # an apostrophe: inside signs it is one more sign
                follow[state, char], marks[state, char] = (SIGNS, 0) if state in (SIGNS, OPEN) else (OPEN, HERE)
    follow[OPEN, ONE], marks[OPEN, ONE] = FRESH, 0  # 's 't 'm 'd
    for char, state, end in ((R, OPEN_R, E), (V, OPEN_V, E), (L, OPEN_L, L)):
        follow[OPEN, char], marks[OPEN, char] = state, 0  # may become 're 've 'll
        for then in range(10):
            # The letter turns out to open a word of its own ...
            follow[state, then] = follow[WORD, then]
            marks[state, then] = marks[WORD, then] | BEFORE
        follow[state, end], marks[state, end] = FRESH, 0  # ... or the contraction is complete
    return follow, marks


FOLLOW, MARKS = _compile_splitter()


def state_maps(classes: np.ndarray) -> np.ndarray:
    """For each row of ``classes`` (one chunk), the end state of every start state."""
    maps = np.tile(np.arange(7, dtype=np.uint8), (len(classes), 1))
    flat = FOLLOW.ravel()
    for column in classes.T:
        maps = flat[maps * np.uint8(10) + column[:, None]]
    return maps


def scan(maps: np.ndarray) -> np.ndarray:
    """Start state of each chunk, from ``FRESH``: inclusive prefix compositions by doubling, then moved by one."""
    maps = maps.copy()
    step = 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        step *= 2
    return np.concatenate(([FRESH], maps[:-1, FRESH])).astype(np.uint8)


def pre_token_starts(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Places where pre-tokens start in a text given by the classes of its characters."""
    n = len(classes)
    chunks = -(-n // chunk)
    padded = np.full(chunks * chunk + 1, SPACE, np.uint8)  # one space more closes what is open at the end
    padded[:n] = classes
    grid = padded[:-1].reshape(chunks, chunk)
    state = scan(state_maps(grid)) if chunks else np.empty(0, np.uint8)
    marks = np.empty((chunk, chunks), np.uint8)
    follow, emit = FOLLOW.ravel(), MARKS.ravel()
    for i, column in enumerate(np.ascontiguousarray(grid.T)):
        at = state * np.uint8(10) + column
        marks[i] = emit[at]
        state = follow[at]
    flat = np.zeros(chunks * chunk + 1, np.uint8)
    flat[:-1] = marks.T.ravel()
    if chunks and state[-1] >= OPEN_R:
        flat[-1] = BEFORE
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return np.flatnonzero(begins[:n])


@dataclass(frozen=True)
class CharClasses:
    """Class of every code point."""

    table: bytes


@cache
def char_classes() -> CharClasses:
    """Letters, numbers and white space as the library's pattern engine has them."""
    every = every_character()
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, name in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        probe = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        members = "".join(part for part, _ in probe.pre_tokenize_str(every))
        out[np.frombuffer(members.encode("utf-32-le"), "<u4")] = name
    out[ord("'")] = QUOTE
    for letters, name in (("stmd", ONE), ("r", R), ("v", V), ("l", L), ("e", E)):
        for letter in letters:
            out[ord(letter)] = name
    return CharClasses(out.tobytes())


class Lexicon(dict):
    """Pre-token -> number of tokens its merges leave; filled when asked."""

    def __init__(self, merger: Merger, inner: list[int], final: list[int]) -> None:
        self.merger, self.inner, self.final = merger, inner, final

    def __missing__(self, word: str) -> int:
        letters = word.encode()
        ids = [self.inner[b] for b in letters]
        ids[-1] = self.final[letters[-1]]
        count = len(self.merger.merge(ids))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count


def is_understood(path: str) -> bool:
    """NFC, white space to spaces, lower case; the pattern above; byte letters without a further split."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    steps = [x["type"] for x in (content["normalizer"] or {}).get("normalizers", [])]
    parts = (content["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    pattern = parts[0].get("pattern", {}).get("Regex")
    return steps == ["NFC", "Replace", "Lowercase"] and pattern == SPLIT and not parts[-1].get("use_regex", True)


class Counter:
    """Token counts of texts under one tokenizer file."""

    def __init__(self, path: str, classes: CharClasses) -> None:
        vocab, merges, special, suffix = read_vocabulary(path)
        if not is_understood(path):
            raise ValueError(f"{path} has a normaliser or pre-tokenizer that is not compiled here")
        letters = byte_letters()
        self.lexicon = Lexicon(
            merger_of_merges(vocab, merges), [vocab[x] for x in letters], [vocab[x + suffix] for x in letters]
        )
        self.classes = np.frombuffer(classes.table, np.uint8)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _normal(self, text: str) -> tuple[str, int]:
        """The text in the tokenizer's normal form, special strings as spaces, and their number.

        NFC and lower case character by character; white space only separates and needs no change.
        """
        found = 0
        if self.special is not None and "<|" in text:
            parts = self.special.split(text)
            found = len(parts) - 1
            text = " ".join(unicodedata.normalize("NFC", p) for p in parts)
        elif not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # str.lower alone would look at a final sigma's neighbours.
        return text.replace("Σ", "σ").lower(), found

    def count(self, texts: list[str]) -> np.ndarray:
        normal = [self._normal(t) for t in texts]
        total = np.array([n for _, n in normal], np.int64)
        every = " ".join(t for t, _ in normal)  # a space leads any state back to the fresh one
        points = np.frombuffer(every.encode("utf-32-le", "surrogatepass"), "<u4")
        classes = self.classes[points]
        starts = pre_token_starts(classes)
        if not len(starts):
            return total
        # A pre-token ends where the next starts or at the first white space.
        ends = np.append(starts[1:], len(classes))
        blank = np.append(np.flatnonzero(classes == SPACE), len(classes))
        ends = np.minimum(ends, blank[np.searchsorted(blank, starts)])
        words = [every[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        counts = np.fromiter(map(self.lexicon.__getitem__, words), np.int64, len(words))
        begin = np.cumsum([0, *(len(t) + 1 for t, _ in normal)])[:-1]
        edges = np.searchsorted(starts, np.append(begin, len(classes) + 1))
        sums = np.append(0, np.cumsum(counts))
        return total + sums[edges[1:]] - sums[edges[:-1]]


@cache
def _counter(path: str, classes: CharClasses) -> Counter:
    return Counter(path, classes)


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def count_tokens(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, as the tokenizer file gives them.

    Special strings inside a text count as one token each. No shuffle. A null text counts as empty. Null keys
    and repeated rows are kept; other columns are not read. The class table (one byte a code point) is broadcast.
    """
    path = path or default_path()
    shared = docs.sparkSession.sparkContext.broadcast(char_classes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, shared.value)
        for batch in sliced(batches, 1, 4 << 20):
            column = batch.column(1)
            counts = counter.count(strings(column))
            size = pa.compute.binary_length(column).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(counts)], ["key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(work, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumnRenamed("key", key)


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds the context length."""
    counts = count_tokens(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
