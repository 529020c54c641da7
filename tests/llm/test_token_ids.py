from __future__ import annotations

import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from paygrain.llm import id_coder as C
from paygrain.llm import token_ids as I

from .conftest import SF


@pytest.mark.parametrize("n", [0, 1, 2, 7, C.BLOCK - 1, C.BLOCK, C.BLOCK + 1, 3 * C.BLOCK + 5])
@pytest.mark.parametrize("kinds", [1, 2, 60, 50_000, 2**32 - 1])
def test_segments_round_trip(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = rng.integers(0, kinds, n).astype("<u4")
    keys, lengths, back = C.decode_segment(C.encode_segment([3, None, -1], [n, 0, 0], ids))
    assert keys == [3, None, -1] and lengths.tolist() == [n, 0, 0] and (back == ids).all()


def test_lanes_are_independent(monkeypatch):
    ids = np.random.default_rng(0).integers(0, 40, 5 * C.BLOCK + 9).astype("<u4")
    whole = C.encode_segment([1], [len(ids)], ids)
    monkeypatch.setattr(C, "LANES", 2)
    assert C.encode_segment([1], [len(ids)], ids) == whole
    assert (C.decode_segment(whole)[2] == ids).all()


def test_predictable_ids_are_short():
    """Orders 1 and 2 pay: a sequence fixed by its last two ids costs far less than its order-0 entropy."""
    ids = np.tile(np.array([5, 6, 5, 7, 8, 9, 5, 6], "<u4"), 4096)
    assert len(C.encode_segment([1], [len(ids)], ids)) * 8 / len(ids) < 1  # order 0 alone: 2.2


def test_damage_is_noticed():
    ids = np.random.default_rng(0).integers(0, 1000, 3 * C.BLOCK).astype("<u4")
    data = bytearray(C.encode_segment([1], [len(ids)], ids))
    rnd = random.Random(1)
    for _ in range(25):
        bad = bytearray(data)
        bad[rnd.randrange(len(bad))] ^= 1 << rnd.randrange(8)
        try:
            back = C.decode_segment(bytes(bad))[2]
        except C.Damaged:
            continue
        assert (back == ids).all()  # a bit behind the last one that counts
    with pytest.raises(C.Damaged):
        C.decode_segment(bytes(data[:-400]))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(I.default_path())


def test_pieces_give_the_ids_of_whole_texts(library):
    rnd = random.Random(3)
    ours = I.LibraryEncoder(I.default_path())
    parts = [" ", "  ", "\n", "\t", "a", "ing", "'s", "'re", "'", "!", "1", "é", "\xa0", "\x1c", "\x85", "漢", "<|endoftext|>", "<|", "\r\n", " ", "​"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        assert ours.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


class Counted:
    """The library's tokenizer, with the number of its calls."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, 0

    def __getattr__(self, name):
        if name.startswith("encode"):
            self.calls += 1
        return getattr(self.tokenizer, name)


def test_new_pieces_go_through_the_library_together(library, monkeypatch):
    counted = Counted(Tokenizer.from_file(I.default_path()))
    monkeypatch.setattr(I, "Tokenizer", type("One", (), {"from_file": staticmethod(lambda path: counted)}))
    ours, text = I.LibraryEncoder(I.default_path()), " ".join(f"ab{i:x}, {i}" for i in range(3000))
    ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ours.encode(text) == ids
    assert 0 < counted.calls < 100  # some 6,000 if each piece takes a call
    before = counted.calls
    assert ours.encode(text) == ids and counted.calls == before


PARTS = [
    " ", "  ", "\n", "\t", "\r\n", "\v", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\ufeff", "a", "B", "ing",
    "'", "'s", "'ll", "'S", "-", "--", "!?", "$", "0", "12", "é", "ß", "²", "e\u0301", "\u0660", "漢字", "\u2019", "\u2014", "\U0001f600", "<|endoftext|>", "<|", "|>",
    "x" * 50, "y " * 9,
]


@pytest.mark.parametrize("pieces, block, together", [(600_000, 1 << 23, 256), (20, 64, 3), (1, 1, 1)])
def test_batches_give_the_ids_of_whole_texts(library, monkeypatch, pieces, block, together):
    """Whatever is remembered, however the blocks are cut, and with whatever else a piece is read."""
    monkeypatch.setattr(I, "PIECES", pieces)
    monkeypatch.setattr(I, "TEXT_BLOCK", block)
    monkeypatch.setattr(I, "_TOGETHER", together)
    rnd, ours = random.Random(pieces), I.LibraryEncoder(I.default_path())
    for n in [0, 1, 2, *[40] * 50]:
        texts = ["".join(rnd.choices(PARTS, k=rnd.choice([0, 1, 2, 5, 30]))) for _ in range(n)]
        if rnd.random() < 0.7:
            texts = [t.replace("<|endoftext|>", "") for t in texts]
        column = pa.array(["left out", *(t.encode() for t in texts)], pa.large_binary()).slice(1)
        ids, ends = ours.encode_texts(column)
        assert len(ends) == n and len(ids) == (ends[-1] if n else 0)
        for text, own in zip(texts, np.split(ids, ends[:-1]) if n else [], strict=True):
            assert own.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("change", [{"add_prefix_space": True}, {"use_regex": False}])
def test_other_pre_tokenizers_get_whole_texts(tmp_path, change):
    rules = json.loads(Path(I.default_path()).read_text())
    rules["pre_tokenizer"] |= change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(rules))
    other, texts = Tokenizer.from_file(str(path)), ["", "a b.c 12\n\nd", " a", "it's <|endoftext|> b", ""]
    ids, ends = I.LibraryEncoder(str(path)).encode_texts(pa.array([t.encode() for t in texts], pa.large_binary()))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_carries_and_surprises_round_trip():
    """Blocks that are predicted well up to a rare id, beside blocks of very many different ids."""
    rng = np.random.default_rng(5)
    calm = np.tile(np.array([1, 1, 2, 3], "<u4"), C.BLOCK * 4)
    calm[rng.integers(0, len(calm), 300)] = rng.integers(10**6, 2 * 10**6, 300)
    ids = np.concatenate((calm, rng.permutation(200_000).astype("<u4"), calm[::-1]))
    assert (C.decode_segment(C.encode_segment([1], [len(ids)], ids))[2] == ids).all()


def test_query(spark, documents, library):
    start = 0
    got = {r["doc_id"]: r for r in I.op6_token_ids(spark, SF).collect()}
    for r in documents.orderBy("doc_id").collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        own = got.pop(r["doc_id"])
        assert (own["start"], own["n_tokens"], own["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_messy_with_small_segments(spark, messy, none, library, tmp_path):
    I.write_ids(messy, str(tmp_path / "ids"), segment_ids=50)
    rows = sorted(I.read_documents(spark, str(tmp_path / "ids")).collect(), key=lambda r: r["start"])
    assert len(rows) == messy.count()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in messy.collect()), key=lambda i: (i is not None, i))
    at = 0
    texts = {r["doc_id"]: r["text"] for r in messy.collect()}
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
        if r["doc_id"] is not None:
            ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == [*ids, 0]
    I.write_ids(none, str(tmp_path / "none"))
    assert I.read_documents(spark, str(tmp_path / "none")).count() == 0
