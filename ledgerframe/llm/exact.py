"""Exact duplicates by progressive refinement: length, then head hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, keep

HEAD_CHARS = 256
# a filter has at most so many rows, whatever the size of the input
FILTER_BUCKETS = 1 << 18


def _bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(FILTER_BUCKETS)).cast("int")


def _flagged(rows: DataFrame, value: Column, twice: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``, true where the bucket of ``value`` is one of ``twice``; false
    where ``value`` is NULL. ``twice`` has a fixed number of buckets, so it is broadcast."""
    found = twice.select(F.col("bucket").alias("__bucket"), F.lit(True).alias("__found"))
    return (
        rows.withColumn("__bucket", _bucket(value))
        .join(F.broadcast(found), "__bucket", "left")
        .withColumn(name, F.coalesce("__found", F.lit(False)))
        .drop("__bucket", "__found")
    )


def _twice(rows: DataFrame, value: Column, *within: Column) -> DataFrame:
    """Buckets of the values that occur more than once, together with ``within``."""
    counted = rows.groupBy(value.alias("value"), *within).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keep(counted.select(_bucket(F.col("value")).alias("bucket")).distinct())


def _refined(docs: DataFrame, text: str) -> DataFrame:
    """The rows with ``__same``, true where the head had to be hashed, and ``__hit``, true
    where the full content has to be.

    First lengths are counted, and nothing else is computed of the texts. Texts whose
    length occurs once are done; of the others the first characters are hashed, and what
    occurs twice with its length survives. Values are folded into buckets for the filters:
    two that share a bucket by chance only cost a hash that was not needed. That also holds
    where survivors are so many that all buckets are taken: a hash of a text costs less
    than the shuffle that an exact filter would need.
    """
    size = F.octet_length(body(text))
    head = F.xxhash64(size, F.substring(body(text), 1, HEAD_CHARS))
    same = _flagged(docs, size, _twice(docs.select(text), size), "__same")
    read = same.filter("__same").select(size.alias("n_bytes"), head.alias("head"))
    survivors = _twice(read, F.col("head"), F.col("n_bytes"))
    return _flagged(same, F.when(F.col("__same"), head), survivors, "__hit")


def refinement(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row ``(n_rows, n_heads, n_contents)``: how many texts each level had to read."""
    return _refined(docs.select(text), text).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("__same").alias("n_heads"), F.count_if("__hit").alias("n_contents")
    )


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hash_all: bool = False
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; NULL counts as empty. Of equal texts the row
    with the largest key stays; of rows that repeat key and text every copy is counted,
    has the same ``keep_id`` and is marked kept (``exact_dedup`` leaves one). A NULL key
    never stays beside another key. ``text_sha256`` is NULL where the full content was
    not needed, unless ``hash_all``. Other columns are ignored; an empty table gives no
    rows.

    Full content is hashed for texts only whose length and head occur more than once;
    texts are never shuffled, and a group with a third of all rows arrives as one row per
    task at the count and is split at the join.
    """
    digest = F.unhex(F.sha2(body(text), 256))
    rows = keep(
        _refined(docs.select(key, text), text).select(
            F.col(key).alias("id"),
            "__hit",
            digest.alias("digest") if hash_all else F.when(F.col("__hit"), digest).alias("digest"),
        )
    )
    groups = (
        rows.filter("__hit")
        .groupBy("digest", F.lit(0).alias("level"))
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("link"), "keep_id", "n")
    )
    # a text without a copy gets a key of its own, so that they do not meet in one task
    link = F.when(F.col("__hit"), F.col("digest")).otherwise(F.unhex(F.hex(F.col("id"))))
    joined = rows.withColumn("link", link).join(groups, "link", "left")
    keep_id = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(key),
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each distinct text: the row with the largest key.

    The columns stay as they are, NULL texts too, which count as empty. Rows without a
    survivor's length and head pass straight through; the others meet in one aggregate
    that keeps the best row per digest and combines before its shuffle. Rows that agree
    in key and text are settled by a hash of all columns.
    """
    cols = docs.columns
    marked = _refined(docs, text)
    order = F.struct(F.col(key), F.xxhash64(*[F.col(c) for c in cols]))
    best = (
        marked.filter("__hit")
        .groupBy(F.sha2(body(text), 256).alias("__digest"))
        .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("__row"))
    )
    return marked.filter("NOT __hit").select(*cols).unionAll(best.select("__row.*"))
