"""The relational core: canonical paths, duplicates, and what a full reconcile does to each path.

Everything is a join or an aggregate on small rows (paths and hashes). A content hash that a third of all files share
does no harm: its smallest path is a minimum, combined on the map side, and it is joined back, which AQE splits
where one hash is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmark.functions.ids import content_hash
from siltmark.functions.paths import indexable, under


def disk_hashes(files: DataFrame, path_col: str = "rel_path", content_col: str = "content", allowed=()) -> DataFrame:
    """(rel_path, file_hash) of the indexable files."""
    return files.filter(indexable(F.col(path_col), allowed)).select(F.col(path_col).alias("rel_path"), content_hash(F.col(content_col)).alias("file_hash"))


def canonical(disk: DataFrame) -> DataFrame:
    """(file_hash, canon): the smallest path of each content, by code points."""
    return disk.groupBy("file_hash").agg(F.min("rel_path").alias("canon"))


def with_canonical(disk: DataFrame) -> DataFrame:
    """disk with each path's canon."""
    return disk.join(canonical(disk), "file_hash").select("rel_path", "file_hash", "canon")


def duplicates(disk: DataFrame) -> DataFrame:
    return with_canonical(disk).filter("rel_path <> canon")


def indexed_paths(points: DataFrame) -> DataFrame:
    """(source_path, file_hash): of each source the hash of its first point; blank sources don't count, a missing hash is empty."""
    return points.filter("source_path <> ''").groupBy("source_path").agg(F.min_by(F.coalesce("file_hash", F.lit("")), "id").alias("file_hash"))


def indexed_hash(points: DataFrame, source_path: str) -> DataFrame:
    """The hash of one source, as a row or none; the filter reaches the scan."""
    return indexed_paths(points.filter(F.col("source_path") == source_path)).filter("file_hash <> ''").select("file_hash")


def reconcile(disk: DataFrame, indexed: DataFrame) -> DataFrame:
    """(rel_path, file_hash, indexed_hash, canon, action) for each path on disk or in the index.

    Actions: stale_removed (gone from disk), dup_removed and dup_ignored (a smaller path has the content; indexed or
    not), skipped (indexed with this content), upserted.
    """
    known = indexed.select(F.col("source_path").alias("rel_path"), F.col("file_hash").alias("indexed_hash"))
    both = with_canonical(disk).join(known, "rel_path", "full_outer")
    is_dup = F.col("rel_path") != F.col("canon")
    action = (
        F.when(F.col("file_hash").isNull(), "stale_removed")
        .when(is_dup & F.col("indexed_hash").isNotNull(), "dup_removed")
        .when(is_dup, "dup_ignored")
        .when(F.col("indexed_hash") == F.col("file_hash"), "skipped")
        .otherwise("upserted")
    )
    return both.select("rel_path", "file_hash", "indexed_hash", "canon", action.alias("action"))


def reconcile_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def stale(disk: DataFrame, indexed: DataFrame) -> DataFrame:
    return indexed.join(disk, F.col("source_path") == F.col("rel_path"), "left_anti")


def delete_sources(points: DataFrame, sources: DataFrame) -> DataFrame:
    """The points whose source isn't among (source_path)."""
    return points.join(sources.select(F.col("source_path").alias("gone")), F.col("source_path") == F.col("gone"), "left_anti")


def delete_prefixes(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The points outside all prefixes (path). Each point's ancestors are looked up by equality, so many prefixes cost one hash join, not a comparison of all with all."""
    clean = prefixes.select(F.regexp_replace("path", "^/+|/+$", "").alias("gone")).filter("gone <> ''").distinct()
    sources = points.select("source_path").distinct()
    parts = F.split("source_path", "/")
    above = sources.select("source_path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("above"))
    hit = above.join(clean, F.col("above") == F.col("gone"), "left_semi").select("source_path").distinct()
    return delete_sources(points, hit)


def delete_prefix(points: DataFrame, prefix: str) -> DataFrame:
    """As delete_prefixes for one prefix: a filter."""
    return points.filter(~F.coalesce(under(F.col("source_path"), F.lit(prefix)), F.lit(False)))


def merge(points: DataFrame, touched: DataFrame, new_points: DataFrame) -> DataFrame:
    """The index after the touched sources (source_path) were replaced by what new_points has of them."""
    return delete_sources(points, touched).unionByName(new_points)
