import pytest
from pyspark.sql import functions as F

from tidemark.llm import lines


def brute(rows, least=lines.LEAST):
    """(id, text) rows to their kept texts and merged cuts."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    first, cuts = {}, {}
    occurrences = []
    for order, (i, t) in enumerate(docs):
        for a, b, key in lines.units(t, least):
            occurrences.append((key, i is None, i or 0, t, a, b))
    by_key = {}
    for o in occurrences:
        by_key.setdefault(o[0], set()).add(o[1:])
    import xxhash

    for found in by_key.values():
        ranked = sorted(found, key=lambda o: (
            o[0], o[1], _signed(xxhash.xxh64_intdigest(o[2].encode(), 42)), o[3]
        ))
        for o in ranked[1:]:
            if o[:4] != ranked[0][:4]:
                cuts.setdefault((None if o[0] else o[1], o[2]), []).append((o[3], o[4]))
    out = []
    for i, t in rows:
        gone = [False] * len(t or "")
        for a, b in cuts.get((i, t), []):
            gone[a:b] = [True] * (b - a)
        out.append((i, t and "".join(c for c, g in zip(t, gone) if not g), sum(gone)))
    return sorted(out, key=str)


def _signed(x):
    return x - (1 << 64) * (x >> 63)


def got(docs):
    return sorted(
        [(r["doc_id"], r["text"], r["n_removed"]) for r in lines.report(docs).collect()], key=str
    )


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert got(docs) == brute([tuple(r) for r in docs.collect()])


PASSAGE = "this long sentence stands in many texts. Short. And here is one more of them, really!"
ROWS = [
    (3, f"before {PASSAGE} after words that are only here."), (2, f"{PASSAGE}\nother line"),
    (1, f"a line\n{PASSAGE}\nb line"), (5, None), (6, ""), (7, PASSAGE), (7, PASSAGE),
    (None, PASSAGE), (8, "Short. Short. Short."), (9, "One two three four five. " * 2000),
    (4, "Same id, one text of many words."), (4, "Same id, one text of many words. But more."),
    (10, "  This  LONG sentence\tstands in many texts.\r\nx"),
]


def test_edges(spark, documents):
    assert got(documents(ROWS)) == brute(ROWS)
    assert lines.report(documents([])).count() == 0
    texts = {r["doc_id"]: r["text"] for r in lines.report(documents(ROWS)).collect()}
    assert "long sentence" in texts[1] and "long" not in texts[2] and "Short" not in texts[2]
    assert texts[8] == ROWS[8][1] and texts[5] is None and texts[9] == "One two three four five. "


def test_one_row_batches_give_the_same(spark, documents):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert got(documents(ROWS).repartition(3)) == brute(ROWS)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_offsets_rebuild_the_original_and_columns_stay(spark, documents):
    docs = documents(ROWS).withColumn("_key", F.lit(1)).withColumn("spans", F.lit("x"))
    out = lines.deduplicate(docs, removed="cut")
    assert out.columns == [*docs.columns, "cut"]
    whole = dict(r for r in ROWS if r[0] in (1, 2, 3, 10))
    for r in out.where("doc_id in (1, 2, 3, 10)").collect():
        text, at, kept = whole[r["doc_id"]], 0, ""
        for s in r["cut"]:
            kept += text[at:s["start"]]
            at = s["stop"]
        assert kept + text[at:] == r["text"] and r["spans"] == "x"


@pytest.mark.parametrize("text", ["", "\n\n", "a. b. c.", "x" * 100000, "no end", ". . .\n.!?"])
def test_units_stay_inside_the_text(text):
    for a, b, _ in lines.units(text, 1):
        assert 0 <= a < b <= len(text)


def test_short_lines_and_scripts_without_blanks(documents):
    long = "这是一个没有空格的很长的段落它在许多文件里重复出现"
    rows = [
        (1, f"first start of it\nAll rights reserved.\n{long}\nใช้ภาษาไทยที่ไม่มีช่องว่าง\nOnly one"),
        (2, f"another start\nall  rights reserved.\nuse\n{long}\nx\nใช้ภาษาไทยที่ไม่มีช่องว่าง"),
        (3, f"前文在此处不同。{long}。后面也不同的文字"), (4, f"别的开头文字！{long}。还有其他的结尾"),
    ]
    texts = {r["doc_id"]: r["text"] for r in lines.report(documents(rows)).collect()}
    assert texts[1] == rows[0][1]
    assert texts[2] == "another start\nuse\nx\n"
    assert texts[3] == rows[2][1] and texts[4] == "别的开头文字！还有其他的结尾"
