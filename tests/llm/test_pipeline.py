import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_lines import brute as line_brute
from tests.llm.test_simhash import brute as groups_of, plain
from tidemark.llm import packing, pii
from tidemark.sources.shared import fresh_path

FOLDER = "/root/testdata/sf0.001"


def stages(spark, docs):
    """Every stage's output, each reread from Parquet."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


@pytest.fixture(scope="module")
def table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, stages(spark, docs)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(table):
    docs, out = table
    for df in out[:4]:
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    for df in out[2:4]:
        assert df.where("n_chars <> length(text)").isEmpty()


def test_language_keeps_texts_with_words(table):
    docs, out = table
    kept = {i for i, _ in pairs(out[0])}
    lost = [t for i, t in pairs(docs) if i not in kept]
    assert len(lost) <= 0.02 * docs.count()


def test_one_of_each_group_stays(table):
    _, out = table
    rows = pairs(out[0])
    roots = groups_of([(i, plain(t)) for i, t in rows])
    assert {i for i, _ in pairs(out[1])} == set(roots)
    assert out[1].count() == len(set(roots))


def test_repeats_are_cut(table):
    _, out = table
    want = [(i, t) for i, t, _ in line_brute(pairs(out[1]))]
    assert sorted(pairs(out[2]), key=str) == sorted(want, key=str)


def test_personal_data_is_masked(spark, table):
    _, out = table
    before, after = dict(pairs(out[2])), dict(pairs(out[3]))
    spans = {r["doc_id"]: r["spans"] for r in pii.report(out[2]).collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        cuts = sorted(
            (int(a), int(b), k) for k, a, b in (s.split(":") for s in spans[i].split(",") if s)
        )
        at, parts = 0, []
        for a, b, k in cuts:
            if a >= at:
                parts += [text[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        assert after[i] == "".join(parts) + text[at:]


def test_all_tokens_are_packed(table):
    _, out = table
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = {
        i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs(out[3])
    }
    got = {}
    for r in out[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_edges(spark, documents):
    text = "the dog and the cat are in the house with many other words of this kind, said he. "
    rows = [(i, f"{text} number {i} {i * 7}" * 3, "en") for i in range(12)]
    rows += [(20, None), (21, ""), (22, "123"), (23, rows[0][1]), (23, rows[0][1]), (None, text * 2)]
    rows += [(25, None), (26, rows[0][1]), (26, rows[0][1] + " x" * 9), (27, text * 9), (27, text * 9)]
    rows += [(24, "".join(f"{text} part {i} " for i in range(2500)))]
    docs = documents(rows).selectExpr("*", "1 as _tag", "0.5 as score", "'x' as lang_pred")
    out = stages(spark, docs)
    assert out[0].columns == docs.columns
    assert not {20, 21, 22} & {i for i, _ in pairs(out[0])}
    assert len(pairs(out[1])) == len(set(groups_of([(i, plain(t)) for i, t in pairs(out[0])])))
    assert np.unique([r["sequence_id"] for r in out[4].collect()]).size >= 1
    assert stages(spark, documents([]))[4].count() == 0
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


@pytest.mark.parametrize("few", [corpus_pipeline.FEW, 0])
def test_rows_that_share_an_id_or_everything(spark, documents, monkeypatch, few):
    monkeypatch.setattr(corpus_pipeline, "FEW", few)
    a, b, c = ("one two three four", "five six seven eight", "nine ten eleven twelve")
    rows = [(5, a), (5, b), (5, b), (9, a), (None, a), (None, c), (None, c), (7, c), (0, None), (None, None)]
    out = corpus_pipeline.keep_one_of_each_group(spark, documents(rows), "")
    assert sorted(pairs(out), key=str) == sorted([(5, a), (5, b), (7, c), (0, None)], key=str)
