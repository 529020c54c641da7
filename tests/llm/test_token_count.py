from __future__ import annotations

import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from paygrain.llm import token_count as T

from .conftest import SF

PARTS = [" ", "\n", "a", "ing", "'s", "'re", "'r", "'l", "'ll", "'v", "'", "''", "!", "1", "²", "é", "İ", "Σ", "ΑΣ", "\xa0", "\x1c", "漢", "😀", "_", "'LL", "<|endoftext|>", "<|", "s", "re", "l", "v", "m", "\x00", "ß"]


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.default_path(), T.char_classes())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.default_path())


def test_same_counts_as_the_library(counter, library):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    texts += ["x" * 3000, "ab'" * 999, "".join(rnd.choice("abcdeinrst") for _ in range(4000))]
    assert counter.count(texts).tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_chunks_compose_to_the_same_marks():
    """Any chunk length gives the starts that the pattern itself gives."""
    rnd = random.Random(8)
    classes = np.frombuffer(T.char_classes().table, np.uint8)
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
    for _ in range(300):
        text = "".join(rnd.choice("abrelvst'1! ") for _ in range(rnd.randint(0, 60)))
        want = [m.start() for m in pattern.finditer(text)]
        own = classes[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        for chunk in (1, 2, 3, 7, 64):
            assert T.pre_token_starts(own, chunk).tolist() == want, (text, chunk)


def test_prefix_scan_is_left_to_right_composition():
    rng = np.random.default_rng(3)
    maps = rng.integers(0, 7, (37, 7)).astype(np.uint8)
    state, want = T.FRESH, []
    for m in maps:
        want.append(state)
        state = m[state]
    assert T.scan(maps).tolist() == want


def test_messy(messy, none, library):
    found = T.count_tokens(messy).join(messy.select("doc_id", "text").distinct(), "doc_id").collect()
    for r in found:
        text = r["text"] or ""
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids) and r["n_bytes"] == len(text.encode())
    assert T.count_tokens(messy).count() == messy.count() and T.count_tokens(none).count() == 0


def test_query(spark, documents, library):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in T.op4_token_count(spark, SF).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 2048)


def test_other_files_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="not compiled"):
        T.Counter(public_tokenizers.path("byte_bpe_50k.json"), T.char_classes())
