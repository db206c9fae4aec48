from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from martflow.llm import warc_index as w
from martflow.llm.common import with_group

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, key string, n string, first string, run string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def pages(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        host = rng.choice(["http://a.example.com", "https://user@B.example.com:443", "//c.org:8080", "http://hot.org"])
        path = rng.choice(["", "/", "/x?q=1#f", "?only=query", f"/p/{rng.randrange(30)}"])
        html = "one and the same" if i % 3 == 0 else f"<p>Ünï {rng.randrange(150)}\r\n\r\n\x00\U0001F600</p>"
        rows.append((i, host + path, html))
    return rows


ODD = [(None, "http://a.example.com/", "one and the same"), (None, None, "alone"), (1000, None, None), (1001, "", ""),
       (7, "http://a.example.com/", "one and the same"), (1002, "http://é.org/ä b\r\nX: y", "x"),
       (1002, "http://é.org/ä b\r\nX: y", "x"), (1003, "mailto:A@b", "long " * 100_000)]


def expected(rows, least=0):
    smallest = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= least:
            smallest[html or ""] = min(page_id, smallest.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = smallest.get(html or "") if len(body) >= least else None
        revisit = first is not None and first != page_id
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def made(spark, rows, path, **kw):
    fan_in = kw.pop("fan_in", w.FAN_IN)
    df = frame(spark, rows).repartition(5)
    w.write_archives(df, path, F.lit(w.FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0)), **kw)
    return w.capture_index(spark, path, fan_in)


def told(index):
    return [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in index.collect()]


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip_equals_brute_force(spark, tmp_path, least):
    rows = pages() + ODD
    index = made(spark, rows, f"{tmp_path}/a", segment=100_000, archive_bytes=4000, least=least)
    assert ordered(told(index)) == ordered(expected(rows, least))


@pytest.mark.parametrize("fan_in,range_rows", [(64, 65_536), (2, 40)])
def test_merged_histories_are_in_order(spark, tmp_path, monkeypatch, fan_in, range_rows):
    monkeypatch.setattr(w, "RANGE_ROWS", range_rows)
    rows = pages()
    index = made(spark, rows, f"{tmp_path}/a", archive_bytes=2000, fan_in=fan_in).orderBy("index_position").collect()
    assert [r["index_position"] for r in index] == list(range(1, len(rows) + 1))
    keys = [(r["url_key"], r["date"], r["page_id"]) for r in index]
    assert keys == sorted(keys)
    assert {r["url_key"]: None for r in index}.keys() == {w.url_key(u) for _, u, _ in rows}


def test_archives_are_plain_warc_files(spark, tmp_path):
    """Read without this module: gzip members, headers, lengths, segments."""
    rows = pages(60) + ODD
    index = made(spark, rows, f"{tmp_path}/a", segment=200_000)
    found = {}
    for r in index.where("record_type = 'response'").collect():
        folder, name = r["archive"].split("/")
        with open(f"{tmp_path}/a/{folder}/{name}", "rb") as fh:
            raw = fh.read()[r["offset"]:r["offset"] + r["length"]]
        out, stream = [], io.BytesIO(gzip.decompress(raw))
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                k, v = line.rstrip(b"\r\n").split(b": ", 1)
                fields[k] = v
            out.append(stream.read(int(fields[b"Content-Length"])))
            assert stream.read(4) == b"\r\n\r\n"
        body = b"".join(out).split(b"\r\n\r\n", 1)[1]
        found[base64.b32encode(hashlib.sha1(body).digest()).decode()] = r["payload_digest"]
    assert set(found) == {e[2] for e in expected(rows)} and all(k == v for k, v in found.items())


def test_empty_table(spark, tmp_path):
    index = made(spark, [], f"{tmp_path}/a")
    assert index.count() == 0 and "index_position" in index.columns


def test_damage_is_noticed():
    member = next(w.members(1, "http://a/", b"payload", "2024-01-01T00:00:00Z", None))
    raw = gzip.decompress(member).replace(b"payload", b"pAyload")
    fields, block = w.parse(raw)
    with pytest.raises(ValueError):
        w.entry("a", 0, 1, fields, block)
    with pytest.raises(EOFError):
        list(w.read_members(memoryview(member[:-20])))


def test_loser_tree_equals_sorting():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 64):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(40))) for _ in range(k)]
        assert list(w.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_groups_beyond_a_broadcast(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.when(
        F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 101))).alias("key"))
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    plain = with_group(rows, groups, "key", "n", ["least"])
    spread = with_group(rows, groups, "key", "n", ["least"], small=3)
    want = {r["key"]: r["least"] for r in groups.where("key IS NOT NULL").collect()}
    for got in (plain, spread):
        assert sorted((r["id"], r["least"]) for r in got.collect()) == \
            sorted((r["id"], want.get(r["key"])) for r in rows.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want, got = con.execute(w.OP11_SQL).df(), w.op11_warc_index(spark, SF).toPandas()
    cols = sorted(got.columns)
    a, b = (x[cols].sort_values("index_position").reset_index(drop=True) for x in (got, want))
    assert sorted(want.columns) == cols and len(a) == len(b)
    for c in cols:
        assert a[c].astype(str).replace("<NA>", "nan").tolist() == b[c].astype(str).replace("<NA>", "nan").tolist(), c
    assert all(re.fullmatch("[A-Z2-7]{32}", d) for d in a["payload_digest"])
