"""Language identification with language-bitmask n-gram filters.

Fitting counts, per language, in how many documents each character n-gram occurs, and keeps the
n-grams found in at least ``least_share`` of a language's documents, and in two where it has two. They go into one bit-sliced
Bloom filter: every slot holds a bitmask with one bit per language, an n-gram sets its languages'
bits in ``HASHES`` slots, and one lookup (the AND of the slots) returns all languages that contain
it. Prediction counts, per language, the n-grams whose mask has its bit; the share is corrected for
the filter's false positives, and the largest share decides.

An n-gram is three characters of the lower-cased text around a letter, everything but letters being
one blank symbol, so single letters and word ends count too.

The sample for fitting is bounded by ``rows_per_language`` (documented parameter; rows are chosen by
a hash of their id), and more than ``MOST_LANGUAGES`` languages are an error. Everything else covers all rows and whole texts.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, and so is every text
when nothing was learned. Equal shares go to the smaller language code; a text of unseen n-grams
gets the first code with score 0. Rows without language or id are not learned from. Repeated rows
are predicted alike. Other columns pass through if named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.arrow import named, with_arrow

HASHES = 3
MOST_LANGUAGES = 4096
CHUNK = 2_000_000  # characters looked up at once
UNKNOWN = "und"
_MIX = tuple(np.uint64(c) for c in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
))
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letter_table()[codes], codes, 0).astype(np.uint64)


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the three codes at each place, and whether the middle one is a letter."""
    h = codes[:-2] * _MIX[0] + codes[1:-1] * _MIX[1] + codes[2:] * _MIX[2]
    h ^= h >> np.uint64(29)
    h *= _MIX[3]
    h ^= h >> np.uint64(32)
    return h, codes[1:-1] != 0


def _framed(text: str) -> str:
    return f"\n\n{text.lower()}\n\n"


@dataclass
class Filter:
    """``words`` x slots bitmasks; language i is bit i % 64 of word i // 64."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def build(cls, languages: list[str], grams: list[np.ndarray]) -> "Filter":
        most = sum(map(len, grams))
        bits = max(12, int(np.ceil(np.log2(max(1, most) * 8))))
        words = max(1, -(-len(languages) // 64))
        table = np.zeros((words, 1 << bits), np.uint64)
        for i, own in enumerate(grams):
            bit = np.uint64(1) << np.uint64(i % 64)
            for slots in _slots(own.view(np.uint64), bits):
                # Slots repeat, and all of them set the same bit.
                table[i // 64, np.unique(slots)] |= bit
        filled = [
            ((table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
            for i in range(len(languages))
        ]
        return cls(languages, table, np.array(filled, float) ** HASHES)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        bits = int(self.table.shape[1]).bit_length() - 1
        first, *rest = _slots(hashes, bits)
        found = self.table[:, first]
        for slots in rest:
            found &= self.table[:, slots]
        return found

    def shares(self, texts: list[str]) -> np.ndarray:
        """Per text the corrected share of n-grams of each language; NaN without letters."""
        codes = [_codes(_framed(t)) for t in texts]
        starts = np.cumsum([0, *map(len, codes)])[:-1]
        hashes, letter = _grams(np.concatenate([*codes, np.zeros(2, np.uint64)]))
        n = np.add.reduceat(letter.astype(np.int64), starts)
        found = self.masks(hashes)
        out = np.zeros((len(texts), len(self.languages)))
        for i, rate in enumerate(self.false_rate):
            has = ((found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(bool) & letter
            with np.errstate(all="ignore"):
                seen = np.add.reduceat(has.astype(np.int64), starts) / n
            out[:, i] = np.clip((seen - rate) / (1 - rate), 0, 1) if rate < 1 else 0
        out[n == 0] = np.nan
        return out


def _slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Double hashing: HASHES slot numbers per n-gram."""
    low, step = hashes, (hashes >> np.uint64(32)) | np.uint64(1)
    last = np.uint64((1 << bits) - 1)
    return [((low + np.uint64(i) * step) & last).astype(np.int64) for i in range(HASHES)]


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", by: str = "doc_id",
    rows_per_language: int = 5000, least_share: float = 0.01,
) -> Filter:
    """Learn from rows with text and language; about ``rows_per_language`` of each at most.

    What comes back is bounded: at most (letters of a text / ``least_share``) n-grams a language.
    """
    usable = docs.where(
        named(lang).isNotNull() & named(text).isNotNull() & named(by).isNotNull()
    ).select(named(by).alias("by"), named(text).alias("text"), named(lang).alias("lang"))
    counted = usable.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: clean the column first")
    sizes = {r["lang"]: r["n"] for r in counted}
    languages = sorted(sizes)
    if not languages:
        return Filter.build([], [])
    places = 1_000_000
    limit = F.create_map(*[
        F.lit(x) for name in languages
        for x in (name, min(places, -(-rows_per_language * places // sizes[name])))
    ])
    drawn = F.pmod(F.xxhash64("by"), F.lit(places)) < limit[F.col("lang")]
    sample = usable.where(drawn).select("lang", "text")
    index = {name: i for i, name in enumerate(languages)}

    def count(batches):
        for batch in batches:
            found: dict[int, list[np.ndarray]] = {}
            docs_of: dict[int, int] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes, letter = _grams(_codes(_framed(value)))
                found.setdefault(index[name], []).append(np.unique(hashes[letter]))
                docs_of[index[name]] = docs_of.get(index[name], 0) + 1
            for i, parts in found.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                # The number of documents travels as the count of a marker row.
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(grams) + 1, i, np.int32)),
                    pa.array([*[None], *grams.view(np.int64).tolist()], pa.int64()),
                    pa.array(np.concatenate([[docs_of[i]], n]).astype(np.int64)),
                ], names=["l", "gram", "n"])

    counts = sample.mapInArrow(count, "l int, gram long, n long").groupBy("l", "gram").agg(
        F.sum("n").alias("n")
    )
    totals = counts.where(F.col("gram").isNull()).select("l", F.col("n").alias("docs"))
    frequent = counts.where(F.col("gram").isNotNull()).join(F.broadcast(totals), "l").where(
        F.col("n") >= F.greatest(F.least(F.lit(2), F.col("docs")), F.col("docs") * least_share)
    ).select("l", "gram").toPandas()
    parts = dict(list(frequent.groupby("l")["gram"]))
    grams = [
        parts[i].to_numpy(np.int64) if i in parts else np.zeros(0, np.int64)
        for i in range(len(languages))
    ]
    return Filter.build(languages, grams)


def predict(
    docs: DataFrame, model: Filter, keep: list[str], text: str = "text",
    out: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """``keep``, the language and its corrected share of the text's n-grams (0 to 1)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shipped.value

        def step(texts):
            names: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            rows: list[int] = []
            size = 0

            def flush():
                shares = model.shares([texts[i] for i in rows])
                for i, row in zip(rows, shares):
                    if not np.isnan(row[0]):
                        best = int(row.argmax())
                        names[i], scores[i] = model.languages[best], row[best]
                rows.clear()

            if model.languages:
                for i, value in enumerate(texts):
                    if value:
                        rows.append(i)
                        size += len(value)
                        if size >= CHUNK:
                            flush()
                            size = 0
                if rows:
                    flush()
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return step

    fields = [T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())]
    return with_arrow(docs, keep, [named(text)], fields, make)


def held_out(by: str = "doc_id") -> Column:
    """Whether a row belongs to the fold that is never learned from; rows without id do not."""
    return F.coalesce(F.crc32(F.col(by).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """Per document: fold, predicted language and score."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
