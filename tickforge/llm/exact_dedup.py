"""Exact duplicates by a content sort.

Normalised texts are range-partitioned by sampled splitters, sorted externally inside each range,
and equal neighbours are compared in full. Only DataFrame functions are used.

The sort key is (first 64 characters, 64-bit hash, run, whole normalised text): splitters stay small
however long texts are, documents that share a long beginning are told apart by the hash, and two rows
count as equal only when their whole normalised texts are equal.

A group of copies may hold a third of all rows. Groups above ``max(RUN_ROWS, rows / MAX_RUNS)`` are cut
by identifier into runs of about that size that spread over the ranges; their smallest identifiers and
sizes come from a full comparison with sums before the shuffle, and at most MAX_RUNS such groups exist.

Defined results: null text counts as empty; null identifiers come last, so they are kept only if the whole
group has none; of repeated rows (same identifier and text) exactly one is kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN_ROWS = 64
MAX_RUNS = 4096
LEAD = 64
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """One row per input row: ``row`` (a struct of ``carry``, by default all columns), keep_id, group_size, kept, text_sha256.

    The answer columns stand beside the struct, so input columns of any name are safe.
    """
    carry = docs.columns if carry is None else carry
    norm = normalised(docs[text_col])
    rows = docs.select(
        F.struct(*(docs[c] for c in carry)).alias("row"),
        docs[id_col].alias("id"),
        F.xxhash64(norm).alias("h"),
        F.substring(norm, 1, LEAD).alias("lead"),
        norm.alias("norm"),
    )
    limit = max(RUN_ROWS, docs.count() // MAX_RUNS)
    hot = (
        rows.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .select("h", F.ceil(F.col("n") / limit).cast("int").alias("runs"))
    )
    hot = F.broadcast(hot)  # at most MAX_RUNS rows of two numbers
    # Large groups, compared in full and summed before the shuffle; at most MAX_RUNS rows without their texts.
    large = rows.join(hot, "h").groupBy("h", "norm").agg(F.min("id").alias("group_id"), F.count(F.lit(1)).alias("n"))
    large = large.select(F.sha2("norm", 256).alias("sha"), "group_id", "n")

    salt = F.when(F.col("runs").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("runs"))).cast("int")
    ranged = rows.join(hot, "h", "left").withColumn("salt", salt)
    if text_col in carry:  # the text travels once, inside the row
        ranged = ranged.drop("norm").repartitionByRange("lead", "h", "salt")
        ranged = ranged.withColumn("norm", normalised(F.col("row").getField(text_col)))
    else:
        ranged = ranged.repartitionByRange("lead", "h", "salt")
    run = Window.partitionBy("lead", "h", "salt", "norm").orderBy(F.col("id").asc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sorted_rows = ranged.select(
        "row",
        "id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.first("id").over(whole).alias("run_id"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
        F.row_number().over(run).alias("place"),
    )
    joined = sorted_rows.join(F.broadcast(large), F.col("text_sha256") == F.col("sha"), "left")
    keep = F.when(F.col("sha").isNull(), F.col("run_id")).otherwise(F.col("group_id"))
    return joined.select(
        "row",
        keep.alias("keep_id"),
        F.coalesce("n", "run_size").alias("group_size"),
        # In a cut group only the run that holds the smallest identifier has a row to keep.
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with the input's columns: of equal texts the row with the smallest identifier."""
    classes = duplicate_classes(docs, id_col, text_col)
    return classes.where("kept").select("row.*")


ORACLE = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n
"""


def query(docs: DataFrame) -> DataFrame:
    classes = duplicate_classes(docs, carry=["doc_id"])
    return classes.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")
