from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from paygrain.llm import simhash_dedup as S

from .conftest import SF


def brute_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    """Root (smallest) of every fingerprint, over all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def clustered(seed, spots=25, size=30):
    """Fingerprints in chains and clouds, so that links run through many and sit at distances 1 to 6."""
    rnd = random.Random(seed)
    out = set()
    for _ in range(spots):
        p = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, size)):
            out.add(p)
            for _ in range(rnd.randint(1, 4)):
                p ^= 1 << rnd.choice([rnd.randrange(64), rnd.randrange(8)])
    return sorted(out)


def parts_of(spark, prints, **how):
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    found = S.components(S.links(frame, **how)).collect()
    groups = defaultdict(set)
    for node, root in found:
        groups[root].add(node)
    return {frozenset(g) for g in groups.values()}


def brute_parts(prints):
    groups = defaultdict(set)
    for p, r in brute_components(prints).items():
        groups[r].add(signed(p))
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_fingerprints_by_definition(messy):
    found = S.with_fingerprints(messy, ["doc_id"]).join(messy.select("doc_id", "text").distinct(), "doc_id")
    for r in found.collect():
        assert r["fp"] == signed(brute_print(r["text"])), r["text"]


def test_blocks_of_shingles_add_up(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    want = brute_print(text)
    monkeypatch.setattr(S, "_BLOCK", 7)
    assert S.fingerprint(text.encode()) == want


def test_links_lose_no_component(spark):
    prints = clustered(1)
    assert parts_of(spark, prints) == brute_parts(prints)


def test_large_postings_are_split_without_loss(spark):
    prints = clustered(2)
    assert parts_of(spark, prints, large=3) == brute_parts(prints)


def test_every_posting_family_covers_every_link():
    """Whatever three bytes differ, some posting has none of them; so for the finer keys."""
    for gone in __import__("itertools").combinations(range(8), 3):
        whole = [p for p in S.POSTINGS if not set(p) & set(gone)]
        assert whole and all(len(set(range(8)) - set(p) - set(gone)) >= 2 for p in whole)


def test_both_ways_to_search_a_run_agree():
    rng = np.random.default_rng(4)
    near = np.unique(np.uint64(0xABCDEF) << np.uint64(24) | rng.integers(0, 1 << 8, 400).astype(np.uint64))
    spread = np.unique(rng.integers(0, 1 << 62, 500).astype(np.uint64))
    for prints in (near, spread):
        for n in (len(prints), 40):
            own = prints[:n]
            root = S._large_run(own, 3)
            want = brute_components([int(p) for p in own])
            groups = defaultdict(set)
            for p, r in zip(own.tolist(), root.tolist(), strict=True):
                groups[r].add(p)
            other = defaultdict(set)
            for p, r in want.items():
                other[r].add(p)
            assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in other.values()}


def test_long_chain(spark):
    """Two hundred links one after the other: the smallest reaches all."""
    n = 200
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)], "u bigint, v bigint")
    found = S.components(edges)
    assert found.count() == n + 1 and found.where("root <> 0").count() == 0


def test_query_by_brute_force(spark, documents):
    rows = {r["doc_id"]: brute_print(r["text"]) for r in documents.collect()}
    root = brute_components(rows.values())
    lowest = {}
    for i, p in rows.items():
        lowest[root[p]] = min(i, lowest.get(root[p], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.op5_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", lowest[root[p]]) for i, p in rows.items()}


def test_messy(messy, none):
    found = S.near_duplicates(messy, ["doc_id"], F.col("doc_id"))
    assert found.count() == messy.count()
    zero = [r for r in found.collect() if r["fp"] == 0]
    assert {r["best"] for r in zero} == {0} and any(r["doc_id"] is None for r in zero)
    assert S.near_duplicates(none, ["doc_id"], F.col("doc_id")).count() == 0


def test_one_of_each_group_stays(messy, none):
    kept = S.keep_one(messy)
    assert kept.columns == messy.columns and S.keep_one(none).count() == 0
    prints = [brute_print(r["text"]) for r in messy.collect()]
    root = brute_components(prints)
    assert kept.count() == len(set(root.values()))
    left = [root[brute_print(r["text"])] for r in kept.collect()]
    assert len(left) == len(set(left))
