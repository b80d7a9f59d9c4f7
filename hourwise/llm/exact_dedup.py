"""Exact deduplication by progressive refinement, in DataFrame operations only.

1. group by length of the normalised text; a length seen once has no copies;
2. of the rest, group by (length, hash of a prefix);
3. only rows of groups that survive both are read in full, for a full hash.

Steps 1 and 2 work on a table of three numbers a row; all groupings combine
map-side, so a group of copies that holds a third of the rows costs one row a
task. Texts are equal when identical after each run of ASCII white space
becomes one space. Null texts count as empty, and empty texts equal one another. Among
equal texts the smallest id stays (a null id only if all are null); the report
marks every row with that id as kept, ``drop_exact_duplicates`` keeps one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, semi_by_id, sized, text_or_empty, unused

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; texts that have none but single spaces pass untouched."""
    odd = text.rlike(r"[\x09-\x0D]|\x20\x20")
    return F.when(odd, F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).otherwise(text)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, keep_id, group_size) of the documents that have copies, one row per distinct (id, text)."""
    norm = normalised(text_or_empty(text_col))
    outline = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(norm).alias("len"),
        F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("head")), "exact-outline")
    lengths = outline.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len")
    heads = (outline.join(lengths, "len", "left_semi")
             .groupBy("len", "head").agg(F.count("*").alias("n")).where("n > 1").select("len", "head"))
    survivors = materialize(outline.join(heads, ["len", "head"], "left_semi").select("doc_id").distinct(), "exact-survivors")
    full = materialize(
        semi_by_id(docs.select(F.col(id_col).alias("doc_id"), norm.alias("t")), survivors, "doc_id")
        .select("doc_id", F.octet_length("t").alias("len"), F.sha2("t", 256).alias("sha")), "exact-full")
    groups = (full.groupBy("len", "sha")
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))
    return full.join(groups, ["len", "sha"]).select("doc_id", "sha", "keep_id", "group_size").distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    groups = duplicate_groups(docs, id_col, text_col).withColumnRenamed("doc_id", "__id")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.sha2(normalised(text_or_empty(text_col)), 256).alias("text_sha256"))
    return (rows.join(groups, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_sha256") == F.col("sha")), "left")
            .select("doc_id",
                    F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.when(F.col("sha").isNull(), F.lit(True))
                    .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest id; all columns stay. Where
    several rows share that id, one of them stays."""
    own_id, own_sha, own_keep = (unused(docs, c) for c in ("__id", "__sha", "__keep"))
    groups = materialize(duplicate_groups(docs, id_col, text_col).select(
        F.col("doc_id").alias(own_id), F.col("sha").alias(own_sha),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias(own_keep)), "exact-groups")
    digest = F.sha2(normalised(text_or_empty(text_col)), 256)
    match = docs[id_col].eqNullSafe(F.col(own_id)) & (digest == F.col(own_sha))
    alone = docs.join(sized(groups), match, "left_anti")
    keepers = (docs.join(sized(groups.where(own_keep)), match, "inner")
               .dropDuplicates([own_sha]).select(*[docs[c] for c in docs.columns]))
    return alone.unionByName(keepers)
