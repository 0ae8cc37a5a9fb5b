import zlib

import numpy as np
import pytest

from tidemark.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, {r["doc_id"]: r for r in language.predictions(docs).collect()}


def test_held_out_accuracy(predicted):
    docs, rows = predicted
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] == (i in set(held)) for i in truth)
    right = np.mean([rows[i]["lang_pred"] == truth[i] for i in held])
    assert right >= 0.97, right
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_predictions_equal_sets_of_trigrams(predicted):
    """The same rule on plain sets: shares agree but for the filter's noise, and so do the languages."""
    docs, rows = predicted
    given = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]

    def trigrams(text):
        plain = "".join(c if c.isalpha() else "\0" for c in f"\n\n{text.lower()}\n\n")
        return [plain[i:i + 3] for i in range(len(plain) - 2) if plain[i + 1] != "\0"]

    count, total = {}, {}
    for i, text, lang in given:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            total[lang] = total.get(lang, 0) + 1
            for g in set(trigrams(text)):
                count[lang, g] = count.get((lang, g), 0) + 1
    known = {l: {g for (k, g), n in count.items() if k == l and n >= max(2, 0.01 * total[l])} for l in total}
    compared = 0
    for i, text, _ in given:
        grams = trigrams(text or "")
        if not grams:
            assert (rows[i]["lang_pred"], rows[i]["score"]) == (language.UNKNOWN, 0.0)
            continue
        shares = sorted(((sum(g in known[l] for g in grams) / len(grams), l) for l in known), reverse=True)
        if len(grams) >= 50:
            assert abs(rows[i]["score"] - shares[0][0]) < 0.05, i
            if shares[0][0] - shares[1][0] > 0.05:
                assert rows[i]["lang_pred"] == shares[0][1], i
                compared += 1
    assert compared > 0.8 * len(given)


def test_languages_of_one_document_and_too_many(spark, documents, monkeypatch):
    docs = documents([(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, "die katze", None)])
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, language.fit(docs), ["doc_id"]).collect()}
    assert got == {1: "de", 2: "en", 3: "de"}
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError):
        language.fit(docs)


def test_filter_agrees_with_sets():
    texts = ["abc abd", "xyz xyw", "abc xyz"]
    grams = []
    for t in texts[:2]:
        h, letter = language._grams(language._codes(language._framed(t)))
        grams.append(np.unique(h[letter]).view(np.int64))
    model = language.Filter.build(["a", "b"], grams)
    h, letter = language._grams(language._codes(language._framed(texts[2])))
    masks = model.masks(h)[0]
    for value, mask, counts in zip(h, masks, letter):
        if counts:
            for i in range(2):
                if np.int64(value.view(np.int64)) in grams[i]:
                    assert mask >> np.uint64(i) & np.uint64(1)
    shares = model.shares(texts)
    assert shares[0].argmax() == 0 and shares[1].argmax() == 1


def test_edges(spark, documents):
    rows = [(i, "der hund und die katze " * 3, "de") for i in range(8)]
    rows += [(i, "the dog and the cat " * 3, "en") for i in range(8, 16)]
    rows += [(20, None, "en"), (21, "", "en"), (22, "123 !?", None), (23, "die katze " * 5000, None),
             (None, "the cat", "en"), (9, rows[9][1], "en"), (24, "ßß", None)]
    out = {r["doc_id"]: r for r in language.predictions(documents(rows)).collect()}
    assert [out[i]["lang_pred"] for i in (20, 21, 22)] == ["und"] * 3
    assert out[23]["lang_pred"] == "de" and out[9]["lang_pred"] == "en"
    assert out[None]["held_out"] is False and out[24]["lang_pred"] in ("de", "en")
    assert language.predictions(documents(rows)).count() == len(rows)
    assert language.predictions(documents([])).count() == 0
    only_null = documents([(1, "some words"), (2, None)])
    assert {r["lang_pred"] for r in language.predictions(only_null).collect()} == {"und"}


def test_more_languages_than_bits_in_a_word():
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + i * 7 % 26)}" for i in range(70)]
    grams = []
    for w in words:
        h, letter = language._grams(language._codes(language._framed(w)))
        grams.append(np.unique(h[letter]).view(np.int64))
    model = language.Filter.build([f"l{i:02d}" for i in range(70)], grams)
    assert (model.shares(words).argmax(axis=1) == np.arange(70)).mean() > 0.95
