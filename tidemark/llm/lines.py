"""Line and sentence deduplication by global digests.

A text is cut into units: its lines, and within them its sentences. Units are normalised (lower
case, single blanks) and hashed to 128 bits. Of every digest the earliest occurrence stays, by
document id, then text hash, then place; all later ones are removed from their texts, and what was
removed is reported with its offsets in the original text. A whole line is a unit whatever its
length. A sentence of fewer than ``least`` words inside a line is hashed together with the
sentences before it until the count is reached, so short sentences go only where their context
repeats too. Every letter of a script written without blanks counts as a word, and the full stops
of other scripts end sentences too.

Each Arrow batch settles repeats of its own first: only a digest's first occurrence per batch goes
to the global grouping, the others are spread by document. However frequent a unit is, no task
gets more than one row of it per batch. The grouping is a sort inside hash partitions, read as a
stream that remembers one row.

Defined cases: NULL texts stay NULL and have no units; texts without repeats come back unchanged;
removed texts may become empty but their rows stay; NULL ids rank last; rows equal in id and text
are one document that comes back repeated; all other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrow import free_name, named

LEAST = 5
_STOPS = "。！？｡．؟۔।॥።፧၊။។"
_CUT = re.compile(rf"[.!?]+[ \t]+|[.!?{_STOPS}]*\r?\n\s*|[{_STOPS}]+[.!?{_STOPS}]*[ \t]*")
# Thai to Myanmar, Khmer, kana and ideographs: scripts without blanks between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_SCHEMA = (
    "known boolean, route long, h1 long, h2 long, id long, hash long, start long, stop long"
)
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _size(words: list[str]) -> int:
    """Number of words, letters of scripts without blanks counted one by one."""
    n = len(words)
    for w in words:
        if not w.isascii():
            n += max(0, len(_UNSPACED.findall(w)) - 1)
    return n


def units(text: str, least: int = LEAST) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of the lines and sentences that can be compared."""
    cuts = [0]
    line_ends = []
    for m in _CUT.finditer(text):
        cuts.append(m.end())
        if "\n" in m[0]:
            line_ends.append(len(cuts) - 1)
    if cuts[-1] < len(text):
        cuts.append(len(text))
    if not line_ends or line_ends[-1] != len(cuts) - 1:
        line_ends.append(len(cuts) - 1)
    words = [text[a:b].lower().split() for a, b in zip(cuts, cuts[1:])]
    sizes = list(map(_size, words))
    alone = {b - 1 for a, b in zip([0, *line_ends], line_ends) if b - a == 1}
    for i, own in enumerate(words):
        if not own:
            continue
        if sizes[i] >= least or i in alone:
            yield cuts[i], cuts[i + 1], " ".join(own)
            continue
        first, n = i, sizes[i]
        while first and n < least:
            first -= 1
            n += sizes[first]
        if n >= least:
            yield cuts[i], cuts[i + 1], " ".join(w for s in words[first:i + 1] for w in s)
    begin = 0
    for end in line_ends:
        if end - begin > 1:
            line = [w for s in words[begin:end] for w in s]
            if line:
                yield cuts[begin], cuts[end], " ".join(line)
        begin = end


def _unit_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            row, start, stop, digests = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for a, b, key in units(text or "", least):
                    row.append(i)
                    start.append(a)
                    stop.append(b)
                    digests.append(digest(key.encode("utf-8", "surrogatepass")))
            if not row:
                continue
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row, start, stop = (np.array(x, np.int64) for x in (row, start, stop))
            own = ids.take(pa.array(row))
            order = own.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            missing = own.is_null().to_numpy(zero_copy_only=False)
            text_hash = hashes[row]
            # By digest, then rank; NULL ids last.
            by = np.lexsort((stop, start, text_hash, order, missing, h[:, 1], h[:, 0]))
            same = np.zeros(len(by), bool)
            s = h[by]
            same[1:] = (s[1:] == s[:-1]).all(axis=1)
            # Where a document's row repeats, so do its units: those are equal, not later.
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
            rank = np.stack([missing, order, text_hash, start], axis=1)[by]
            known = np.zeros(len(by), bool)
            known[by] = same & (rank != rank[first]).any(axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(known), pa.array(np.where(known, text_hash, h[:, 0])),
                pa.array(h[:, 0]), pa.array(h[:, 1]), own,
                pa.array(text_hash), pa.array(start), pa.array(stop),
            ], names=_NAMES)
    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest and rank: those that are not of the first rank of their digest."""
    last = None  # digest and rank of the current first occurrence
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        known = batch.column(0).to_numpy(zero_copy_only=False)
        ids = batch.column(4)
        rank = np.stack([
            batch.column(2).to_numpy(), batch.column(3).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
            ids.fill_null(0).to_numpy(zero_copy_only=False),
            batch.column(5).to_numpy(), batch.column(6).to_numpy(),
        ], axis=1)
        fresh = np.ones(n, bool)  # begins a digest
        fresh[1:] = (rank[1:, :2] != rank[:-1, :2]).any(axis=1)
        fresh[1:] |= known[1:] != known[:-1]
        if last is not None and not known[0] and (rank[0, :2] == last[:2]).all():
            fresh[0] = False
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        base = np.where((first >= 0)[:, None], rank[np.maximum(first, 0)], 0 if last is None else last)
        remove = known | (rank != base).any(axis=1)
        if not known[-1]:
            last = base[-1]
        keep = pa.array(remove)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(keep) for i in (4, 5, 6, 7)],
            names=["id", "hash", "start", "stop"],
        )


def repeats(
    docs: DataFrame, by: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """Removed units: id, hash of the whole text, start and stop (characters)."""
    source = docs.where(named(text).isNotNull()).select(
        named(by).cast("long").alias("id"), F.xxhash64(named(text)).alias("hash"),
        named(text).alias("text"),
    )
    rows = source.mapInArrow(_unit_rows(least), _SCHEMA)
    ordered = rows.repartition("known", "route").sortWithinPartitions(
        "known", "h1", "h2", F.col("id").asc_nulls_last(), "hash", "start"
    )
    return ordered.mapInArrow(_later, "id long, hash long, start long, stop long").distinct()


def deduplicate(
    docs: DataFrame, by: str = "doc_id", text: str = "text", least: int = LEAST,
    removed: str | None = None,
) -> DataFrame:
    """``docs`` with repeats cut from ``text``; all columns stay.

    With ``removed``, one more column of that name lists the cut stretches (start, stop) of the
    original text, merged where they touch.
    """
    spans = repeats(docs, by, text, least).groupBy("id", "hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")
    ).select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "spans")
    key, hashed, cuts, kept = (free_name(docs, c) for c in ("_key", "_text_hash", "_cuts", "_kept"))
    spans = spans.toDF(key, hashed, cuts)
    marked = docs.join(
        spans, named(by).cast("long").eqNullSafe(F.col(key))
        & (F.xxhash64(named(text)) == F.col(hashed)) & named(text).isNotNull(), "left",
    )
    out = marked.withColumn(kept, _cut(named(text), F.col(cuts)))
    columns = [
        F.col(kept)["text"].alias(c) if c == text else named(c) for c in docs.columns
    ]
    if removed:
        columns.append(F.coalesce(F.col(kept)["spans"], F.array().cast(
            "array<struct<start:bigint,stop:bigint>>"
        )).alias(removed))
    return out.select(*columns)


def _cut(text, spans):
    @F.pandas_udf("text string, spans array<struct<start:bigint,stop:bigint>>")
    def cut(texts, cuts):
        import pandas as pd

        kept, merged = [], []
        for value, found in zip(texts, cuts):
            if value is None or found is None:
                kept.append(value)
                merged.append([])
                continue
            parts, gone, at = [], [], 0
            for s in found:
                a, b = int(s["start"]), int(s["stop"])
                if gone and a <= gone[-1]["stop"]:
                    gone[-1]["stop"] = max(b, gone[-1]["stop"])
                else:
                    gone.append({"start": a, "stop": b})
            for s in gone:
                parts.append(value[at:s["start"]])
                at = s["stop"]
            parts.append(value[at:])
            kept.append("".join(parts))
            merged.append(gone)
        return pd.DataFrame({"text": kept, "spans": merged})

    return cut(text, spans)


def report(docs: DataFrame) -> DataFrame:
    """Per document: kept text, number of removed stretches and characters, and their offsets."""
    plain = docs.select("doc_id", "text")
    out = deduplicate(plain, removed="removed")
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    shown = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"]))
    return out.select(
        "doc_id", "text", F.size("removed").cast("long").alias("n_spans"),
        size.alias("n_removed"), F.array_join(shown, ",").alias("removed"),
    )
