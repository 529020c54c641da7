from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from paygrain.llm import byte_bpe, language_id, pii  # noqa: E402
from paygrain.llm.merges import read_ranks  # noqa: E402

from .conftest import SF  # noqa: E402
from .test_decontaminate import brute as brute_leaks  # noqa: E402
from .test_simhash_dedup import brute_components, brute_print  # noqa: E402


def test_run_by_brute_force(spark, documents):
    """Each stage again, one row at a time and over all pairs."""
    model = language_id.train(documents)
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    bits = {i: language_id.total_bits(model, pa.array([(t or "").encode()], pa.large_binary()))[0].min() for i, t in rows.items()}
    rows = {i: t for i, t in rows.items() if any(map(str.isalpha, t or "")) and bits[i] < 8 * len(t.encode())}
    prints = {i: brute_print(t) for i, t in rows.items()}
    root = brute_components(prints.values())
    lowest = {}
    for i, p in prints.items():
        lowest[root[p]] = min(i, lowest.get(root[p], i))
    rows = {i: rows[i] for i in lowest.values()}
    leaked = {i for i, _ in brute_leaks(list(rows.items()), items)}
    rows = {i: pii.redact(t) for i, t in rows.items() if i not in leaked}
    encoding = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=read_ranks(byte_bpe.default_path()), special_tokens={})
    want = {i: (np.array(encoding.encode_ordinary(t), "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows.items()}

    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: (bytes(r["ids"]), r["decoded_sha256"]) for r in got} == want and len(got) == len(want)
    assert leaked and len(want) < documents.count()


def test_stages_keep_the_columns(spark, messy, none):
    for docs in (messy, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns
            after.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "pii", "byte_bpe"]
