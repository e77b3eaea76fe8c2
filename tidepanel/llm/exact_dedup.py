"""Exact dedup: skew-safe combining with full content at every stage.

Texts are equal when identical after every run of `[\\x20\\x09-\\x0D]` became one
space. Three groupings, each of them on digest *and* content, so that a digest
shared by different texts never merges them:

1. local: Spark's partial aggregation on (digest, salt, content) inside a task;
2. salted: the same grouping after the exchange, so that a group of copies that
   holds a third of all rows is dealt over `salts` keys;
3. global: the salt winners on (digest, content).

The way back goes over the same tree, on narrow keys: winners are handed to
their salts, and the salts to the rows. A digest that stands for one content
(all of them, unless the digest collides) needs no content on this way;
colliding ones are told apart by `variant`, a second hash of the content.

Defined cases: null counts as empty; rows that repeat a doc_id with an equal
text are one document and are all marked kept; where every doc_id of a group
is null, keep_id is null and its rows are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import text_or_empty

SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(col), SPACE_RUN, " ")


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def winners(rows: DataFrame, salts: int, digest=sha256) -> DataFrame:
    """(digest, variant, salt, keep_id, group_size) for every salt of every group.

    rows: doc_id, content. digest: Column -> Column; tests pass one that collides.
    """
    keyed = rows.select(
        "doc_id", "content", digest(F.col("content")).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts).cast("long")).cast("int").alias("salt"))
    salted = (keyed.groupBy("digest", "salt", "content")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    merged = (salted.groupBy("digest", "content")
              .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
                   F.collect_set("salt").alias("held")))  # at most `salts` numbers
    return merged.select("digest", variant(F.col("content")).alias("variant"),
                         F.explode("held").alias("salt"), "keep_id", "group_size")


def variant(content: Column) -> Column:
    """Tells contents of one digest apart: an independent hash and the length."""
    return F.struct(F.xxhash64(content).alias("h"), F.octet_length(content).alias("n"))


def mark_copies(docs: DataFrame, salts: int = 32, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select("doc_id", normalised().alias("content"))
    found = winners(rows, salts, digest)
    keys = rows.select(
        "doc_id", digest(F.col("content")).alias("digest"),
        variant(F.col("content")).alias("variant"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts).cast("long")).cast("int").alias("salt"),
        sha256(F.col("content")).alias("text_sha256"))
    return (keys.join(found, ["digest", "variant", "salt"])
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce(F.col("doc_id") == F.col("keep_id"),
                               F.col("keep_id").isNull()).alias("kept"),
                    "text_sha256"))


def drop_copies(docs: DataFrame, salts: int = 32) -> DataFrame:
    """`docs` with its own columns, one document of every group of equal texts.

    The way back joins on doc_id and digest, which no group of copies makes hot.
    """
    found = winners(docs.select("doc_id", normalised().alias("content")), salts)
    kept = found.select(F.col("keep_id").alias("_keep_id"), F.col("digest").alias("_digest"),
                        F.col("variant").alias("_variant")).distinct()
    content = normalised()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"),
                        sha256(content).alias("_own_digest"),
                        variant(content).alias("_own_variant"))
    return keyed.join(
        kept, F.col("_id").eqNullSafe(F.col("_keep_id"))
        & (F.col("_own_digest") == F.col("_digest"))
        & (F.col("_own_variant") == F.col("_variant")), "left_semi").select("row.*")
