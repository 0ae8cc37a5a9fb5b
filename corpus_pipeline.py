"""The corpus pipeline: stages over ``documents``, each written before the next one reads it.

1. language: documents without letters, or of whose n-grams fewer than ``LEAST_SCORE`` belong to any
   learned language, go.
2. near_dedup: fingerprints of 3-word shingles link at two differing bits or fewer; of every linked
   group the row with the smallest id stays (NULL after all others); of rows that share it, one.
3. repeats: lines and sentences that an earlier document holds are cut from the texts.
4. personal_data: spans are replaced by their kind in brackets.
5. packing: pieces of token sequences along the Hilbert curve.

Stages 1 to 4 return the columns of what they are given; where ``n_chars`` is among them it follows
the text. NULL texts go at stage 1; empty tables pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language, lines, packing, pii, simhash
from tidemark.llm.arrow import free_name, named
from tidemark.llm.graph import stored
from tidemark.sources.shared import fresh_path

#: Rows of two longs: about 16 MB when broadcast.
FEW = 1_000_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_SCORE = 0.2


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` but for the stored keys; few keys go to the texts, many meet them in a shuffle."""
    few = gone.count() <= FEW
    return docs.join(F.broadcast(gone) if few else gone, keys, "left_anti")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = language.predict(docs, model, docs.columns, out=lang, score=score)
    known = (F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return found.where(known).select(*map(named, docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by id and text, so no text is copied or moved but that of dropped rows."""
    key, hashed = free_name(docs, "_key"), free_name(docs, "_hash")
    marked = docs.withColumn(key, F.coalesce("doc_id", F.lit(0))).withColumn(
        hashed, F.xxhash64("text", F.col("doc_id").isNull())
    )
    prints = stored(simhash.fingerprints(marked, ["doc_id", key, hashed]), "prints")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), key, hashed)
    # Copies collapse before anything is joined, so groups of any size are one row here.
    texts = stored(prints.groupBy("fingerprint", key, hashed).agg(
        F.min(order).alias("own"), F.count("*").alias("n")
    ), "texts")
    # Ids may repeat, so a component is named by its smallest fingerprint.
    groups = simhash.classes(prints, "fingerprint")
    firsts = texts.groupBy("fingerprint").agg(F.min("own").alias("first"))
    chosen = firsts.join(groups, F.col("fingerprint") == F.col("fp")).groupBy("component").agg(
        F.min("first").alias("first")
    ).select(F.col("first")[key].alias(key), F.col("first")[hashed].alias(hashed))
    stays = stored(texts.select(key, hashed, "n").join(chosen, [key, hashed], "left_semi"), "stays")
    single = stays.where("n = 1").select(key, hashed)
    gone = texts.select(key, hashed).join(single, [key, hashed], "left_anti")
    repeated = stays.where("n > 1").select(key, hashed)
    rest = _without(marked, stored(gone, "gone"), [key, hashed])
    if not repeated.isEmpty():
        rest = rest.unionByName(
            marked.join(repeated, [key, hashed], "left_semi").dropDuplicates([key, hashed])
        )
    return rest.select(*map(named, docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(lines.deduplicate(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_dedup", keep_one_of_each_group),
    ("repeats", cut_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL has neither the fingerprints nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every hand-over is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
