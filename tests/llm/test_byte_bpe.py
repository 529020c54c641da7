from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from paygrain.llm import byte_bpe as B
from paygrain.llm.merges import Merger, read_ranks

from .conftest import SF

PARTS = [" ", "  ", "\n", "\t", "a", "ing", "the", "'s", "'re", "'", "!", "1", "²", "é", "İ", "\xa0", "\x1c", "\x85", "漢", "😀", "՘", "Ⅷ", "_", "\r\n", "'ll"]


@pytest.fixture(scope="module")
def ours():
    return B._encoder(B.default_path(), B.PATTERN, B.tiktoken_classes())


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=read_ranks(B.default_path()), special_tokens={})


def packed(encoding, text):
    return np.array(encoding.encode_ordinary(text), "<u4").tobytes()


def test_same_ids_as_the_library(ours, theirs):
    rnd = random.Random(2)
    for _ in range(4000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 12)))
        assert ours.encode(text) == packed(theirs, text), repr(text)
    for text in ("ab" * 4000, "a" * 3000, "<|endoftext|> x", "".join(rnd.choice("abcdeinrst") for _ in range(6000))):
        assert ours.encode(text) == packed(theirs, text)


def test_memory_does_not_change_results(theirs):
    ranks = read_ranks(B.default_path())
    small = B.Encoder(B.merger_of_ranks(ranks), [ranks[bytes([b])] for b in range(256)], B.tiktoken_classes())
    small.spaced.size = small.plain.size = 2
    for text in ("the cat, the dog, the cat.", "a b c d a b c d", "x, y, x, y"):
        assert small.encode(text) == packed(theirs, text)


def brute_merge(pairs, made, ids):
    ids = list(ids)
    while True:
        ranks = [(pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in pairs]
        if not ranks:
            return ids
        rank, i = min(ranks)
        ids[i : i + 2] = [made[rank]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.randoms(use_true_random=False))
def test_queue_merges_as_by_definition(ids, rnd):
    """Random merge tables, equal ranks of different pairs and rank groups beyond the first included."""
    pairs, made = {}, {}
    for rank in rnd.sample(range(1000), 12):
        made[rank] = rnd.randint(0, 9)
        for _ in range(rnd.randint(1, 2)):
            pairs[rnd.randint(0, 9) << 32 | rnd.randint(0, 9)] = rank
    assert Merger(pairs, made).merge(ids) == brute_merge(pairs, made, ids)


def test_messy_round_trip(messy, none, theirs):
    both = B.decode(B.encode(messy)).join(messy.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(both) == messy.where("doc_id is not null").count()
    for r in both:
        assert bytes(r["ids"]) == packed(theirs, r["text"] or "") and r["n_tokens"] == len(r["ids"]) // 4
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert B.encode(messy).count() == messy.count() and B.decode(B.encode(none)).count() == 0


def test_round_trip_is_encode_and_decode(messy, none):
    def found(df):
        return sorted(map(str, df.collect()))

    assert found(B.round_trip(messy)) == found(B.decode(B.encode(messy)))
    assert B.round_trip(none).count() == 0


def test_query_by_the_library(spark, documents, theirs):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    got = B.op2_byte_bpe(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == documents.count()
    for r in got:
        ids, text = packed(theirs, texts[r["doc_id"]]), texts[r["doc_id"]].encode()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text).hexdigest()


def test_ten_megabytes(ours, theirs):
    """With spaces; and a word of one megabyte, in two orders of blocks."""
    rnd = random.Random(6)
    prose = "".join(rnd.choice(["word", " other", " é", "\n", " 12", "x"]) for _ in range(3_500_000))
    word = "".join(rnd.choice("etaoin") for _ in range(1 << 20))
    for text in (prose, word):
        ids = ours.encode(text)
        assert B._decoded(B.default_path(), pa.array([ids], pa.binary()))[0].as_py() == text.encode()
    assert ours.encode(prose) == packed(theirs, prose)


def test_other_patterns_are_refused():
    with pytest.raises(ValueError, match="pattern"):
        B._encoder(B.default_path(), r"\S+", B.tiktoken_classes())
