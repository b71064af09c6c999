"""Registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import (
    backtrack_bpe,
    collision_dedup,
    cost_packing,
    heavy_dedup,
    jaccard_tiles,
    prefix_targets,
    reversed_search,
    simple8b,
    store,
    stratified_shards,
    subword_toxicity,
    suffix_dedup,
    token_alignment,
    weak_pii,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    store.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; the package that names it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.find(_table(spark, sf_dir, "documents")).drop("found")


def op2_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cost_packing.pack(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_heavy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_dedup.assign(_table(spark, sf_dir, "documents"))


SQL_OP3 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
), w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM w
"""


def op4_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = subword_toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = subword_toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        subword_toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_dedup.link(_table(spark, sf_dir, "embeddings"))


def op6_backtrack_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtrack_bpe.encode_decode(
        _table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), digests=True
    )


def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = stratified_shards.shard(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), digests=True)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), digests=True)


def op10_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.link(_table(spark, sf_dir, "documents"))


PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op11_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, k, role, PROBE_TEXT) for k, role in enumerate(("user", "assistant"))], turns.schema)
    return prefix_targets.round_trip(turns.unionByName(probe))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(
        _table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    )


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL_OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents
), sizes AS (
  SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), wanted AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, docs
), scores AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total))))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (r), totals
  GROUP BY item_id, r
), ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# name -> (query, DuckDB SQL or None)
QUERIES = {
    "op1_weak_pii": (op1_weak_pii, None),
    "op2_cost_packing": (op2_cost_packing, None),
    "op3_heavy_dedup": (op3_heavy_dedup, SQL_OP3),
    "op4_subword_toxicity": (op4_subword_toxicity, None),
    "op5_collision_dedup": (op5_collision_dedup, None),
    "op6_backtrack_bpe": (op6_backtrack_bpe, None),
    "op7_stratified_shards": (op7_stratified_shards, None),
    "op8_simple8b": (op8_simple8b, None),
    "op9_suffix_dedup": (op9_suffix_dedup, None),
    "op10_jaccard_tiles": (op10_jaccard_tiles, None),
    "op11_prefix_targets": (op11_prefix_targets, None),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_reversed_search": (op13_reversed_search, SQL_OP13),
}
