from __future__ import annotations

import random

import duckdb
import pytest

from paygrain.llm import url_filter as U

from .conftest import SF


def brute(rules, url):
    """The contract, over all rules."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((len(r.text) for r in fits), default=None), fits


URLS = [None, "", "nothing", "://", "http://", "http://EXAMPLE.com", "http://example.com/", "http://www.example.com/en/x", "http://x.www.example.com/en/",
        "http://example.com/english", "http://example.com/en", "http://net/es/", "http://a.net?x=/es/", "http://a.net#/fr/", "http://notexample.com/en/",
        "http://example.com:80/en/", "http://u@example.com/en/?q://z.net/es/", "http://a..net/es/", "http://ÉXAMPLE.net/fr/é", "x" * 9000 + "://a.com/" + "p/" * 5000]


def test_contract_rules():
    trie = U.build_trie(U.RULES)
    for url in URLS:
        host, path, longest, _ = brute(U.RULES, url)
        assert U.split_url(url) == (host, path)
        found = U.match(trie, host, path)
        assert (found and len(found.text)) == longest


def test_random_rules():
    rnd = random.Random(6)
    for _ in range(300):
        rules = [
            U.Rule(rnd.choice(["allow", "block"]), ".".join(rnd.choices("abc", k=rnd.randint(1, 3))), rnd.choice(["/", "/x", "/x/", "/x/y", "", "/xy/"]))
            for _ in range(rnd.randint(0, 8))
        ]
        trie = U.build_trie(rules)
        for _ in range(20):
            url = "s://" + ".".join(rnd.choices("abcd", k=rnd.randint(1, 4))) + rnd.choice(["", "/", "/x", "/xy", "/x/y", "/x/yz/w", "/xy/"])
            host, path, longest, fits = brute(rules, url)
            found = U.match(trie, host, path)
            assert (found and len(found.text)) == longest
            if found:  # of equally long ones: the longer host, then block
                best = [r for r in fits if len(r.text) == longest]
                best = [r for r in best if len(r.host) == max(len(b.host) for b in best)]
                assert found.verdict == ("block" if any(r.verdict == "block" for r in best) else "allow")


def test_messy(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, None, None, None), (0, URLS[7], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    assert U.judge_urls(pages, U.RULES).count() == len(rows)
    assert U.judge_urls(pages.where("false"), U.RULES).count() == 0
    assert {r["verdict"] for r in U.judge_urls(pages, [], default="block").collect()} == {"block"}


def test_lists_without_bound_are_refused(monkeypatch):
    monkeypatch.setattr(U, "MAX_RULES", 3)
    with pytest.raises(ValueError, match="entries"):
        U.build_trie(U.RULES)


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = U.op10_url_filter(spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({U.SQL})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_many_entries_on_one_host():
    """100,000 entries below one host: some microseconds a URL, and the same entries as by trying all."""
    import random
    import time

    rnd = random.Random(7)
    rules = [U.Rule(rnd.choice(["allow", "block"]), "example.com", "/p/" + "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))) for _ in range(100_000)]
    trie, first = U.build_trie(rules), {}
    for r in rules:
        if r.text not in first or r.verdict == "block":
            first[r.text] = r
    paths = ["/p/" + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 20))) for _ in range(20_000)]
    started = time.perf_counter()
    found = [U.match(trie, "www.example.com", p) for p in paths]
    assert (time.perf_counter() - started) / len(paths) < 100e-6
    for path, rule in zip(paths[:2000], found):
        fits = [r for n in range(len(path), 2, -1) if (r := first.get("example.com" + path[:n]))]
        assert rule == (fits[0] if fits else None)
