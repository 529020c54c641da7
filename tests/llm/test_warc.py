from __future__ import annotations

import gzip
import hashlib
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from paygrain.llm import warc as W

from .conftest import SF

LONG = "<html>" + "payload " * 40 + "</html>"
PAGES = [
    (5, "http://a.example.com/x?q=1", LONG),
    (3, "http://b.example.com/y", LONG),
    (3, "http://b.example.com/y", LONG),
    (7, None, LONG),
    (None, "http://c.example.org/", LONG),
    (8, "ftp:nothing", "short"),
    (9, "http://a.example.com/x?q=1", "short"),
    (10, "http://a.example.com/\r\nWARC-Type: forged", None),
    (11, "http://a.example.com/nested", f"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n{LONG}\r\n\r\n"),
    (12, "http://ü.example.com/é", "ü" * 200),
    (None, None, None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in PAGES], "page_id bigint, url string, html string, digest string, size string")


def seconds(of="page_id"):
    return F.timestamp_seconds(F.coalesce(F.col(of), F.lit(0)) % 4)


def test_round_trip(spark, pages, tmp_path):
    out = str(tmp_path / "archives")
    W.write_archives(pages, out, seconds(), records_per_file=3)
    found = W.capture_histories(spark, out).collect()
    assert len(found) == len(PAGES)
    rows = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=str)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = min((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        to = first if len(body) >= 100 and i != first else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if to is not None else "response", to))
    assert rows == sorted(want, key=str)
    order = [(r["url_key"], r["captured"], r["page_id"] is None, r["page_id"] or 0) for r in found]
    assert order == sorted(order)


def test_offsets_lead_to_records(spark, pages, tmp_path):
    W.write_archives(pages, str(tmp_path / "a"), seconds())
    for r in W.capture_histories(spark, str(tmp_path / "a")).collect():
        with gzip.open(tmp_path / "a" / r["archive"]) as f:
            f.seek(r["offset"])
            fields, block, _, length = next(W.parse(io.BufferedReader(io.BytesIO(f.read(r["length"])))))
        assert length == r["length"] and fields["WARC-Type"] == r["record_type"]
        assert fields.get("WARC-Target-URI") == r["url"]


def test_one_payload_for_a_third_of_all_pages(spark, tmp_path):
    many = spark.range(300).select(
        F.col("id").alias("page_id"), F.lit("http://a.b/").alias("url"),
        F.when(F.col("id") % 3 == 0, LONG).otherwise(F.concat(F.lit(LONG), F.col("id").cast("string"))).alias("html"),
    )
    W.write_archives(many, str(tmp_path / "m"), seconds())
    found = W.capture_histories(spark, str(tmp_path / "m"))
    assert found.where("record_type = 'revisit' and refers_to = 0 and page_id % 3 = 0").count() == 99
    assert found.where("record_type = 'response'").count() == 201


def test_empty_table(spark, pages, tmp_path):
    W.write_archives(pages.where("false"), str(tmp_path / "e"), seconds())
    assert W.capture_histories(spark, str(tmp_path / "e")).count() == 0


def test_loser_tree_merges():
    rnd = random.Random(2)
    for k in range(12):
        for _ in range(60):
            runs = [sorted(rnd.randint(0, 20) for _ in range(rnd.randint(0, 6))) for _ in range(k)]
            assert list(W.LoserTree(map(iter, runs))) == sorted(x for r in runs for x in r)


def test_merge_does_not_need_the_shuffle_to_keep_order(spark):
    rows = [(f"k{random.Random(i).randint(0, 9)}", i % 5, i) for i in range(200)]
    index = spark.createDataFrame(rows, "url_key string, t int, page_id bigint").select(
        "url_key", F.timestamp_seconds("t").alias("captured"), "page_id", F.lit("response").alias("record_type"),
        F.lit(1).cast("long").alias("payload_bytes"), F.lit("").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"),
        F.lit("").alias("url"), F.lit("f").alias("archive"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("length"),
    )
    got = [(r["url_key"], r["captured"], r["page_id"]) for r in W.merge_runs(index).collect()]
    assert got == sorted(got) and len(got) == 200


def test_damage_is_noticed():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    assert len(list(W.parse(io.BufferedReader(io.BytesIO(record * 2))))) == 2
    for bad in (record[:-1], record[:-6], b"x" + record, record + b"WARC/1.1\r\nContent-"):
        with pytest.raises(ValueError):
            list(W.parse(io.BufferedReader(io.BytesIO(bad))))


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = W.op9_warc(spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({W.SQL})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
