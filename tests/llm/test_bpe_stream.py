from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paygrain.llm import bpe_stream as B

from .conftest import SF

PARTS = [
    " ", "  ", "\n", "\t", "a", "ing", "the", "'s", "'re", "'", "!", "1", "²", "é", "İ", "\xa0", "\x1c", "\x85", "漢", "😀", "՘", "Ⅷ",
    "_", "\r\n", "'ll", "<|endoftext|>", "<|", "'d", "'v", "e", "l",
]


@pytest.fixture(scope="module")
def ours():
    return B.vocabulary(B.default_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.default_path())


def assert_same(ours, library, texts):
    ids, ends = B.encode_texts(ours, pa.array([t.encode() for t in texts], pa.large_binary()))
    back = B.decode_ids(B.default_path(), ids, ends)
    begin = 0
    for text, end, other, again in zip(texts, ends.tolist(), library.encode_batch(texts, add_special_tokens=False), back, strict=True):
        assert ids[begin:end].tolist() == other.ids, repr(text[:80])
        assert again == library.decode(other.ids, skip_special_tokens=False)
        begin = end


def test_same_ids_as_the_library(ours, library):
    rnd = random.Random(11)
    assert_same(ours, library, ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(6000)])


@pytest.mark.parametrize("block", [1, 7, 40])
def test_blocks_do_not_change_results(ours, library, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    rnd = random.Random(block)
    assert_same(ours, library, ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(200)])


def test_long_pre_tokens(ours, library):
    rnd = random.Random(3)
    texts = ["ab" * 4000, "a" * 30000, "".join(rnd.choice("abcdeinrstoulhm") for _ in range(60000))]
    texts += ["".join(rnd.choice("eéinrst漢") for _ in range(9000)), " " * 5000 + "x", "!" * 9999, "don't" * 3000]
    assert_same(ours, library, texts)


def test_ten_megabytes(ours):
    """With spaces, and one word of four megabytes: exact round trips, and the ids do not depend on what follows."""
    rnd = random.Random(4)
    prose = "".join(rnd.choice(["word", " other", " é", "\n", " 12", "x"]) for _ in range(3_500_000))
    word = "".join(rnd.choice("etaoin") for _ in range(1 << 22))
    texts = [prose, word, word[: 1 << 21], ""]
    ids, ends = B.encode_texts(ours, pa.array([t.encode() for t in texts], pa.large_binary()))
    assert B.decode_ids(B.default_path(), ids, ends) == texts
    whole, half = ids[ends[0] : ends[1]], ids[ends[1] : ends[2]]
    assert (whole[: len(half) - ours.lookahead] == half[: -ours.lookahead]).all()


# --- the lookahead by brute force -------------------------------------------------------------


def merged(merges, text):
    tokens = list(text)
    for a, b in merges:
        i = 0
        while i + 1 < len(tokens):
            if tokens[i] == a and tokens[i + 1] == b:
                tokens[i : i + 2] = [a + b]
            i += 1
    return tokens


def edges(tokens):
    at, out = 0, set()
    for t in tokens:
        at += len(t)
        out.add(at)
    return out


@settings(max_examples=300, deadline=None)
@given(st.randoms(use_true_random=False))
def test_no_boundary_before_the_lookahead_ever_changes(rnd):
    known, merges = list("ab"), []
    for _ in range(rnd.randint(1, 14)):
        a, b = rnd.choice(known), rnd.choice(known)
        if a + b not in known and len(a + b) < 12:
            merges.append((a, b))
            known.append(a + b)
    reach = B.lookahead(merges, {t: len(t) for t in known})
    for _ in range(40):
        text = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40)))
        more = text + "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12)))
        settled = range(1, len(text) - reach)
        short, long = edges(merged(merges, text)), edges(merged(merges, more))
        assert [i in short for i in settled] == [i in long for i in settled]


def test_improper_merge_lists_are_refused():
    with pytest.raises(ValueError, match="own rule"):
        B.lookahead([("ab", "c"), ("a", "b")], {"a": 1, "b": 1, "c": 1, "ab": 2, "abc": 3})


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        B.vocabulary(B.public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abeinrst"), max_size=80), st.randoms(use_true_random=False))
def test_transducer_fed_piece_by_piece(text, rnd):
    v = B.vocabulary(B.default_path())
    one, data, out, at = B.Transducer(v), (text * 60).encode(), [], 0
    while at < len(data):
        n = rnd.randint(1, 900)
        out += one.feed(data[at : at + n])
        at += n
    assert len(one.window) <= v.window + 900
    assert out + one.close() == v.merger.merge(v.byte_ids[list(data)].tolist())


# --- decoding ---------------------------------------------------------------------------------


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([0x41, 0x80, 0xBF, 0xC1, 0xC2, 0xE0, 0xA0, 0x9F, 0xED, 0xE4, 0xF0, 0x90, 0xF4, 0x8F, 0xF5, 0xFF]), max_size=20), st.integers(1, 4))
def test_bytes_to_text_in_pieces(data, step):
    machine, data = B.TextMachine(), bytes(data)
    parts = []
    for i in range(0, len(data), step):
        parts.append(machine.feed(data[i : i + step]))
        assert len(machine.begun) <= 3
    assert "".join(parts) + machine.close() == data.decode("utf-8", "replace")


def test_any_ids_decode_as_in_the_library(ours, library):
    rnd = random.Random(5)
    lists = [[rnd.choice([rnd.randrange(50257), rnd.randrange(256)]) for _ in range(rnd.randint(0, 30))] for _ in range(1500)]
    import numpy as np

    flat = np.array([i for x in lists for i in x], np.int32)
    ends = np.cumsum([len(x) for x in lists])
    assert B.decode_ids(B.default_path(), flat, ends) == [library.decode(x, skip_special_tokens=False) for x in lists]
    assert B.decode_ids(B.default_path(), np.array([-1, 65, 60000], np.int32), np.array([3])) == ["b"]


# --- tables -----------------------------------------------------------------------------------


def test_messy_round_trip(messy, none, library):
    got = B.decode(B.encode(messy)).join(messy.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(got) == messy.where("doc_id is not null").count()
    for r in got:
        assert list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    assert B.encode(messy).count() == messy.count() and B.decode(B.encode(none)).count() == 0


def test_query_by_the_library(spark, documents, library):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    got = B.op11_bpe_stream(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == documents.count()
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
