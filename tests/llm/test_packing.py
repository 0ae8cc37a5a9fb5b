import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())  # as the contract has it, no flags
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, out, exact):
    """Every id of every row in one piece; sequences gapless, and padded nowhere or to a power."""
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(np.array(exact(t), "<u4"))
    pieces, places = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for i, own in pieces.items():
        assert sum(p["length"] for p in own) == sum(map(len, ids[i]))
        for p in own:
            a, b = p["start"], p["start"] + p["length"]
            fits = [d for d in ids[i] if len(d) == p["doc_tokens"]]
            assert any(zlib.crc32(d[a:b].tobytes()) == p["ids_crc32"] for d in fits)
        covered = sorted((p["start"], p["length"]) for p in own)
        assert len(ids[i]) > 1 or [a for a, _ in covered] == list(
            np.cumsum([0, *[n for _, n in covered]])[:-1]
        )
    padding = 0
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_table(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, packing.report(docs).collect(), exact)


def test_edges(spark, documents, exact):
    rows = [
        (1, None), (2, ""), (3, "One two, THREE!"), (3, "One two, THREE!"), (None, "no id"),
        (4, "word " * 9000), (5, "İstanbul ŒUVRE ǅ x\x1cy a\tb  c\r\nd \xa0e"), (6, "é Å Σς ΑΣ 漢字 😀"),
        (7, "it's don't 's ''s x's. 1234 5, --- <|endoftext|> a-b ...wow?!"), (8, "y" * 5000),
        (9, "ªº ß ẞ ŉ ½ ² _x_ ,"), (10, "a <|endoftext|> b<|startoftext|>C <|ENDOFTEXT|> <|endoftext|"),
        (11, "<|endoftext|>"), (12, "e<|endoftext|>\u0301 <|endof\ntext|>"),
    ]
    check(rows, packing.report(documents(rows)).collect(), exact)
    assert packing.report(documents([])).count() == 0


def test_sequences_hold_the_ids(documents, exact):
    rows = [(i, f"text number {i} " * 40 * i) for i in range(30)]
    pieces = packing.pack(documents(rows))
    found = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces).collect()}
    for p in pieces.collect():
        at = 4 * p["offset"]
        assert found[p["sequence_id"]][at:at + 4 * p["length"]] == bytes(p["ids"])
    assert sum(map(len, found.values())) == 4 * sum(len(exact(t)) for _, t in rows)


def test_curve_visits_every_cell_in_unit_steps():
    side = 8
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert(cells, 3)
    assert sorted(keys) == list(range(side ** 3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
