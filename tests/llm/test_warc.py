import hashlib
import random

import duckdb
import pytest

from opinia.llm import catalogue, warc
from opinia.llm.common import Scratch

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 20\r\n\r\n01234567890123456789\r\n\r\n"
LONG = "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"
BIG = "x" * 1500
SCHEMA = "page_id long, url string, html string, digest string, payload string, file string"


def pages():
    rng = random.Random(3)
    html = [None, "", "a", BIG, BIG, BIG, INNER, INNER * 40, "WARC/1." * 500, "é" * 3000 + INNER + "z" * 4000, "\r\n\r\n" * 100, LONG, LONG * 30 + INNER]
    parts = ["WARC/1.1\r\n", "Content-Length: 12\r\n", "\r\n\r\n", "abc", INNER]
    html += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    rows = [(i, f"http://h/{i}\nWARC/1.0" if i % 2 else None, h) for i, h in enumerate(html)]
    # Rows alike in all, in id only, and without an id.
    return rows + [(500, "u", BIG), (None, "n", "q" * 1200), (500, "u", BIG), (500, "t", BIG), (None, None, BIG), (None, None, BIG)]


def named(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def expected(rows):
    out, first = [], True
    for page_id, _, html in rows:
        kind, refers, text = "response", "", html or ""
        if text == BIG:
            if page_id == 500 and first:
                first = False
            else:
                kind, refers = "revisit", named(500)
        out.append((named(page_id), kind, len(text.encode()), hashlib.sha1(text.encode()).hexdigest(), refers))
    return sorted(out)


def test_payloads_of_no_page_id(spark):
    """Equal payloads whose ids are all null: one is the response."""
    df = spark.createDataFrame([(None, f"http://{i % 3}", BIG, "x", "x", "x") for i in range(50)], SCHEMA)
    scratch = Scratch(spark, "test")
    folder = scratch.path("archives")
    warc.write_warc(df, folder, scratch)
    found = warc.read_warc(spark, folder, scratch).groupBy("type").count().collect()
    assert {r["type"]: r["count"] for r in found} == {"response": 1, "revisit": 49}


@pytest.mark.parametrize("split, most", [(20_000, 1 << 20), (20_000, 2), (1 << 27, 1 << 20)])
def test_round_trip(spark, split, most, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SPLITS", most)
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    scratch = Scratch(spark, "test")
    folder = scratch.path("archives")
    warc.write_warc(df.coalesce(2), folder, scratch)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = warc.read_warc(spark, folder, scratch).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = []
    for r in found:
        digest = r["digest"].removeprefix("sha1:")
        assert r["payload"] is None or hashlib.sha1(r["payload"]).hexdigest() == digest
        got.append((r["record_id"], r["type"], r["payload_length"], digest, r["refers_to"] or ""))
    assert sorted(got) == expected(rows)


def test_nothing_and_broken_archives(spark, tmp_path):
    scratch = Scratch(spark, "test")
    folder = scratch.path("archives")
    warc.write_warc(spark.createDataFrame([], SCHEMA), folder, scratch)
    assert warc.read_warc(spark, folder, scratch).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.warc").write_bytes(INNER.encode() + b"trailing")
    with pytest.raises(ValueError):
        warc.read_warc(spark, str(bad), scratch)


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert {tuple(r) for r in catalogue.op4_warc(spark, folder).collect()} == set(con.execute(catalogue.SQL["op4_warc"]).fetchall())
