"""Corpus cleaning and packing: five stages, each one operator of ``brisa.llm``.

Documents that the toxicity model rejects go; of equal texts one stays; of
every group of near duplicates one stays; personal data is replaced by marks;
what is left is packed into sequences. Each stage is written as Parquet under
the shared folder and read back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import cost_packing, heavy_dedup, jaccard_tiles, store, subword_toxicity, weak_pii
from brisa.llm.queries import vocabulary_path

REJECT_FROM = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``REJECT_FROM``; the model learns from the labelled ones among them."""
    store.prepare(spark)
    model = subword_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return subword_toxicity.drop_toxic(docs, model, REJECT_FROM)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    store.prepare(spark)
    return heavy_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by five-word shingles at 0.8."""
    store.prepare(spark)
    return jaccard_tiles.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the new text."""
    store.prepare(spark)
    clean = weak_pii.redact(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(store.as_text("text"))).cast(docs.schema["n_chars"].dataType))
    return clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    store.prepare(spark)
    return cost_packing.pack(docs, vocabulary_path("word_bpe_49k.json"), small_cache=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]

# A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
