import hashlib

import pytest

from tidemark.llm import queries, warc
from tidemark.sources.shared import fresh_path

BIG, OTHER = "x" * 100, "é" * 50


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def expected(rows):
    first = {}
    for i, _, h, _ in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        target = first.get(h)
        revisit = target is not None and target != i
        out.append((
            i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
            target if revisit else None,
        ))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/b c\r\nX: y", BIG, 1), (3, "u3", BIG, 1), (9, None, BIG, 1), (4, "u4", OTHER, 1),
    (1, "u1", None, 1), (2, "u2", "", 1), (7, "u7", "short", 1), (8, "u8", "short", 1),
    (3, "u3", BIG, 1), (None, "n", OTHER, 1), (None, "n", "z" * 200, 1), (None, "n", "z" * 200, 1),
    (10, "u", "a\r\n\r\nWARC/1.1\r\n" * 20, 1), (11, "u", "y" * 300000, 1),
]


def test_report(spark):
    out = warc.report(pages_of(spark, ROWS), fresh_path(spark, "warc"))
    assert sorted([tuple(r) for r in out.collect()], key=str) == expected(ROWS)
    empty = warc.report(pages_of(spark, []), fresh_path(spark, "warc"))
    assert empty.count() == 0


def test_payloads_are_stored_once_and_checked(spark):
    folder = warc.write_archive(pages_of(spark, ROWS), fresh_path(spark, "warc"))
    assert spark.read.parquet(f"{folder}/payloads").count() == len({r[2] or "" for r in ROWS})
    assert spark.read.parquet(f"{folder}/records").count() == len(ROWS)
    heads = [bytes(r["header"]) for r in warc.read_archive(spark, folder).collect()]
    assert any(b"http://a/b%20c%0D%0AX:%20y\r\n" in h for h in heads)
    broken = spark.read.parquet(f"{folder}/payloads").selectExpr(
        "digest", "first_value(packed) over (partition by 1 order by digest) as packed"
    )
    other = fresh_path(spark, "warc")
    broken.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{other}/records")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, other).collect()


def test_files_round_trip(spark):
    folder = warc.write_archive(pages_of(spark, ROWS), fresh_path(spark, "warc"))
    records = warc.read_archive(spark, folder)
    files = warc.export_warc(records, fresh_path(spark, "files"))
    back = [(bytes(r["header"]), bytes(r["block"])) for r in warc.import_warc(spark, files).collect()]
    want = []
    for r in records.collect():
        whole = bytes(r["header"])
        cut = whole.index(b"\r\n\r\n") + 4
        body = b"" if b"WARC-Type: revisit" in whole else bytes(r["payload"])
        want.append((whole[:cut], whole[cut:] + body))
    assert sorted(back) == sorted(want)


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/pages.parquet").selectExpr("page_id", "url", "html", "0")
    out = queries.queries()["op4_warc"](spark, folder).collect()
    assert sorted([tuple(r) for r in out], key=str) == expected([tuple(r) for r in rows.collect()])
