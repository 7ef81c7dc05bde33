"""The corpus pipeline: from ``documents`` to cleaned, deduplicated and
tokenised documents, one operator of ``tillcube.llm`` a stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps;
``run`` writes its result as Parquet in the shared folder and reads it again
as the next stage's input, so a lost executor never replays an earlier stage.
All stages but the last return the columns of ``documents`` (``n_chars``
follows the text); the last adds ``ids``, ``n_tokens`` and ``round_trip``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillcube.llm import decontaminate, near_dedup, quality, sentencepiece_fst, substring_dedup
from tillcube.session import new_table_path

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8) the document
    with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs, size=5)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of 20 words that stand earlier too go; a document
    that loses all of its words goes."""
    return _counted(substring_dedup.remove_repeats(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark passages go; a document that holds nothing else goes."""
    others = F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("others")     # their names may be the operator's
    got = decontaminate.decontaminate(docs.select(others, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    kept = got.filter("n_hit = 0 OR n_hit < n_words")
    return _counted(kept.select(*[F.col("cleaned").alias("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns]))


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids, checked by decoding them."""
    return sentencepiece_fst.encode(docs, MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding", sentencepiece_ids),
]

ORACLE_SQL = None       # tested against a brute-force version in tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_path(spark, f"pipeline-{name.replace(' ', '-').lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
