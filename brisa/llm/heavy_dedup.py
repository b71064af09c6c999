"""Exact deduplication that splits off frequent digests before the shuffle.

Texts are equal when they agree after deleting ASCII white space; the SHA-256
of that form is the digest. One pass over the texts writes a narrow table
(row, doc_id, digest, length). Then:

1. a Misra-Gries summary of the digests (Spark's frequent-items sketch, which
   keeps a fixed number of counters and merges over tasks) names every digest
   that holds more than about ``1 / tracked`` of the rows;
2. one map-side-combined aggregate verifies the named digests exactly and finds
   the winner (longest original text, then smallest id) and size of each group;
3. these verified winners, at most ``k`` rows, are broadcast: rows of frequent
   digests get their answer inside the scan and never enter a shuffle;
4. the other rows meet by digest in an ordinary shuffle, where no group exceeds
   the sketch's bound.

Everything is DataFrame and SQL functions. A wrong or missing candidate costs
only speed: each row is answered by exactly one of steps 3 and 4.

Edge cases: null text counts as empty and empty texts form one group; rows that
repeat id and text are separate rows of which one stays; null ids sort first;
empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm import store

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of a text without its ASCII white space."""
    return F.sha2(F.regexp_replace(store.as_text(text), WHITE_SPACE, ""), 256)


def frequent_digests(narrow: DataFrame, k: int, tracked: int) -> DataFrame:
    """At most ``k`` digest hashes named by the summary."""
    top = narrow.select(F.expr(f"approx_top_k(xxhash64(digest), {k}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("hash"))


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 1000, tracked: int = 4096, least: int = 32
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``least``: a named digest counts as frequent from this many verified rows on.
    """
    narrow = store.materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.unhex(digest(F.col(text_col))).alias("digest"),
            F.length(store.as_text(text_col)).alias("n"),
        ),
        "digests",
    )
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    named = frequent_digests(narrow, k, tracked)
    winners = store.materialise(
        narrow.withColumn("hash", F.xxhash64("digest"))
        .join(F.broadcast(named), "hash", "left_semi")
        .groupBy("digest")
        .agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") >= least),
        "frequent_digests",
    )
    heavy = narrow.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    light = narrow.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "*", F.min(order).over(same).alias("best"), F.count("*").over(same).alias("group_size")
    )
    columns = [
        F.col("doc_id"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ]
    return heavy.select(*columns).unionByName(light.select(*columns))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat both id and text one stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    text = F.col(names[docs.columns.index(text_col)])
    # A null id is a value like any other; spelled out, the join and the window below share one exchange of the rows.
    plain = [F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("none"), "digest"]
    number = F.col(names[docs.columns.index(id_col)]).cast("long")
    keyed = inner.withColumns(
        {"id": F.coalesce(number, F.lit(0)), "none": number.isNull(), "digest": F.unhex(digest(text)), "n": F.length(store.as_text(text))}
    )
    stay = assign(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("digest"))
    joined = keyed.join(stay.select(*plain), ["id", "none", "digest"], "left_semi")
    # Several rows with the id and digest that stay are repeats; the longest original is the one.
    rank = F.row_number().over(Window.partitionBy("id", "none", "digest").orderBy(F.col("n").desc()))
    return joined.withColumn("rank", rank).filter("rank = 1").select(*names).toDF(*docs.columns)
