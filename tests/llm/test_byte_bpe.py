import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe

TEXTS = [
    None, "", " ", "  a  b\n\n c\t", "it's  they'll 's", "naïve Σ 漢字 👩‍👩‍👧 \x1c x\x85y", "<|endoftext|> a",
    "é" * 3000, "x" * 20000, "1234 5,6.7 --  end ​", "a\r\n\r\nb ", "\n", "it's  they'll 's",
]


@pytest.fixture(scope="module")
def exact():
    import public_tokenizers as P
    import tiktoken

    lines = open(P.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_decoding_match_the_other_library(documents, exact):
    rows = byte_bpe.digests(documents(list(enumerate(TEXTS)))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        ids = exact.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_every_row_of_the_table(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = byte_bpe.digests(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = exact.encode_ordinary(r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_offsets_point_at_characters(documents):
    text = "a naïve 漢字"
    row = byte_bpe.encode(
        documents([(1, text)]), ["doc_id", "ids.x"], offsets="starts"
    ).first()
    table = byte_bpe.token_bytes(byte_bpe.vocabulary_path())
    ids = np.frombuffer(row["ids"], "<u4")
    assert row["ids.x"] == 7 and len(ids) == len(row["starts"])
    at = 0
    for i, start in zip(ids, row["starts"]):
        assert len(text.encode()[:at].decode(errors="ignore")) == start
        at += len(table[i])


def test_decoding_a_cut_character_and_an_empty_table(spark, documents):
    encoded = byte_bpe.encode(documents([(1, "漢")]), ["doc_id"])
    cut = encoded.withColumn("ids", F.substring("ids", 1, 4))
    got = byte_bpe.decode(cut, ["doc_id"]).first()["decoded"]
    assert "漢".encode().startswith(bytes(got)) and got
    assert byte_bpe.digests(documents([])).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bytes(byte_bpe.decode(nothing, ["doc_id"]).first()["decoded"]) == b""
