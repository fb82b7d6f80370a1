"""File system events, changes and snapshots, as set operations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmark.functions.paths import indexable, relative
from siltmark.operators.reconcile import canonical, with_canonical

EVENT_TYPES = ("created", "deleted", "modified", "moved")


def relevant(events: DataFrame) -> DataFrame:
    """Created, deleted, modified and moved; of directories only deleted and moved."""
    return events.filter(F.col("event_type").isin(*EVENT_TYPES) & ~(F.col("is_directory") & F.col("event_type").isin("created", "modified")))


def _change(op: str, path: Column, prefix: bool) -> Column:
    return F.struct(F.lit(op).alias("op"), path.alias("path"), F.lit(prefix).alias("is_prefix"))


def event_changes(events: DataFrame, root: str, listing: DataFrame | None = None) -> DataFrame:
    """(seq, op, path, is_prefix) of events (seq, event_type, src_path, dest_path, is_directory).

    Moves delete what they leave and upsert what they reach; of a move over the root's border only the half
    inside counts. A moved directory upserts each file that is now below it, for which listing (rel_path) is
    looked up.
    """
    src, dest = relative(F.col("src_path"), root), relative(F.col("dest_path"), root)
    is_dir = F.col("is_directory")
    parts = F.array(
        F.when(~is_dir & F.col("event_type").isin("deleted", "moved"), _change("delete", src, False)),
        F.when(is_dir & F.col("event_type").isin("deleted", "moved"), _change("delete", src, True)),
        F.when(~is_dir & F.col("event_type").isin("created", "modified"), _change("upsert", src, False)),
        F.when(~is_dir & (F.col("event_type") == "moved"), _change("upsert", dest, False)),
    )
    inside = lambda a: F.filter(a, lambda c: c.isNotNull() & c["path"].isNotNull())
    found = relevant(events).select("seq", F.explode(inside(parts)).alias("c")).select("seq", "c.*")
    if listing is None:
        return found
    moved = relevant(events).filter(is_dir & (F.col("event_type") == "moved")).select("seq", dest.alias("top")).filter("top IS NOT NULL")
    steps = F.split("rel_path", "/")
    above = listing.select("rel_path", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))).alias("above"))
    below = above.filter("size(split(rel_path, '/')) > 1").join(moved, F.col("above") == F.col("top")).select("seq", F.lit("upsert").alias("op"), F.col("rel_path").alias("path"), F.lit(False).alias("is_prefix"))
    return found.unionByName(below)


def coalesce_changes(changes: DataFrame) -> DataFrame:
    """The last op of each (path, is_prefix); seq is that of its first mention, which orders the batch."""
    return changes.groupBy("path", "is_prefix").agg(F.min("seq").alias("seq"), F.max_by("op", "seq").alias("op")).select("seq", "op", "path", "is_prefix")


def quiet_batches(events: DataFrame, gap_seconds: float, ts: str = "ts") -> DataFrame:
    """Batches (start, end, n) between quiet periods of at least gap_seconds.

    One global session. Events are first thinned to one row per gap-long slot and then strung together, so that what
    meets in one task is a row per slot in which anything happened.
    """
    slot = F.floor(F.col(ts).cast("double") / gap_seconds)
    slots = events.groupBy(slot.alias("slot")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("slot")
    apart = (F.col("lo").cast("double") - F.lag("hi").over(order).cast("double")) >= gap_seconds
    marked = slots.withColumn("batch", F.sum(F.when(apart, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("batch").agg(F.min("lo").alias("start"), F.max("hi").alias("end"), F.sum("n").alias("n"))


def snapshot_delta(before: DataFrame, listed: DataFrame, stable: DataFrame | None = None) -> DataFrame:
    """(rel_path, op) that leads from the mirrored snapshot to the listing, both (rel_path, size, mtime).

    Files that are new or differ in size or time are upserted, if stable (rel_path) names them or isn't given; files that
    are no longer listed are deleted.
    """
    old = before.select("rel_path", F.struct("size", "mtime").alias("old"))
    new = listed.select("rel_path", F.struct("size", "mtime").alias("new"))
    both = old.join(new, "rel_path", "full_outer")
    delta = both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("rel_path", F.when(F.col("new").isNull(), "delete").otherwise("upsert").alias("op"))
    if stable is None:
        return delta
    kept = delta.filter("op = 'upsert'").join(stable.select("rel_path"), "rel_path", "left_semi")
    return delta.filter("op = 'delete'").unionByName(kept)


def stable_files(listed: DataFrame, again: DataFrame) -> DataFrame:
    """The listed files that a second look finds unchanged."""
    same = again.select(F.col("rel_path").alias("p"), F.col("size").alias("s"), F.col("mtime").alias("m"))
    return listed.join(same, (F.col("rel_path") == F.col("p")) & (F.col("size") == F.col("s")) & (F.col("mtime") == F.col("m")), "left_semi")


def next_mirror(before: DataFrame, listed: DataFrame, stable: DataFrame) -> DataFrame:
    """The mirrored snapshot after a sync: unstable files keep what they had, so that they are tried again."""
    fresh = listed.join(stable.select("rel_path"), "rel_path", "left_semi")
    waiting = before.join(listed.select("rel_path"), "rel_path", "left_semi").join(stable.select("rel_path"), "rel_path", "left_anti")
    return fresh.select("rel_path", "size", "mtime").unionByName(waiting.select("rel_path", "size", "mtime"))


def backoff(failures: Column, base: float, most: float) -> Column:
    """Seconds to wait after so many failures in a row."""
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(failures - 1, F.lit(0))))


def promotions(deletes: DataFrame, disk: DataFrame, indexed: DataFrame) -> DataFrame:
    """(seq, path, target): file deletes of an indexed path that was canonical, and the smallest path left on disk with its content."""
    known = indexed.select(F.col("source_path").alias("path"), "file_hash").filter("file_hash <> ''")
    held = deletes.filter(~F.col("is_prefix")).join(known, "path").join(canonical(disk), "file_hash")
    return held.filter("path < canon").select("seq", "path", F.col("canon").alias("target"))


def apply_changes(changes: DataFrame, disk: DataFrame, indexed: DataFrame, allowed=()) -> DataFrame:
    """(source_path, file_hash, action) of each source after a batch: action is kept, upserted or deleted.

    All deletes come first, in order, then all upserts, each on its own: a file that is on disk and the smallest path
    with its content is indexed with it, another is dropped. A file delete of a canonical path promotes the
    smallest other path with its content, unless a later delete covers that or the deleted path was itself
    just promoted. Prefix deletes promote nothing. Changes are a batch, which one machine can hold; the index
    and the disk stay distributed.
    """
    batch = coalesce_changes(changes)
    deletes = batch.filter("op = 'delete'")
    removed = _covered(indexed, deletes)

    first = promotions(deletes, disk, indexed)
    # a promotion happens if no earlier delete covers its path, and stays if no later one covers its target
    promoted = _ordered_targets(_uncovered(first, deletes, "path", F.col("dseq") < F.col("seq")))
    promoted = _uncovered(promoted, deletes, "target", F.col("dseq") > F.col("seq")).select(F.col("target").alias("source_path")).distinct()

    upserts = batch.filter((F.col("op") == "upsert") & ~F.col("is_prefix") & indexable(F.col("path"), allowed)).select(F.col("path").alias("source_path")).distinct()
    on_disk = with_canonical(disk).select(F.col("rel_path").alias("source_path"), F.col("file_hash").alias("disk_hash"), "canon")
    tried = upserts.join(on_disk, "source_path", "left")
    up = tried.filter("canon = source_path").select("source_path", "disk_hash")
    down = tried.filter("canon IS NULL OR canon <> source_path").select("source_path")
    forced = promoted.join(on_disk, "source_path").select("source_path", "disk_hash")

    new = up.unionByName(forced.join(upserts, "source_path", "left_anti")).withColumnRenamed("disk_hash", "new_hash")
    state = indexed.select("source_path", "file_hash").join(removed.select("source_path", F.lit(True).alias("hit")), "source_path", "left")
    state = state.join(down.select("source_path", F.lit(True).alias("dropped")), "source_path", "left").join(new, "source_path", "full_outer")
    action = (
        F.when(F.col("new_hash").isNotNull() & F.col("new_hash").eqNullSafe(F.col("file_hash")) & F.col("hit").isNull(), "kept")
        .when(F.col("new_hash").isNotNull(), "upserted")
        .when(F.col("hit").isNotNull() | F.col("dropped").isNotNull(), "deleted")
        .otherwise("kept")
    )
    return state.select("source_path", F.coalesce("new_hash", "file_hash").alias("file_hash"), action.alias("action"))


def _above(rows: DataFrame, path: str) -> DataFrame:
    """The rows once for each directory above their path and for the path itself, as (above, itself): prefixes can so be looked up by equality."""
    steps = F.split(path, "/")
    each = rows.select("*", F.explode(F.sequence(F.lit(1), F.size(steps))).alias("n"))
    return each.withColumn("above", F.array_join(F.slice(steps, F.lit(1), F.col("n")), "/")).withColumn("itself", F.col("n") == F.size(steps)).drop("n")


def _clean(deletes: DataFrame) -> DataFrame:
    path = F.when(F.col("is_prefix"), F.regexp_replace("path", "^/+|/+$", "")).otherwise(F.col("path"))
    return deletes.select(F.col("seq").alias("dseq"), path.alias("dpath"), "is_prefix").filter("dpath <> ''")


def _uncovered(rows: DataFrame, deletes: DataFrame, path: str, when: Column) -> DataFrame:
    """The rows (seq, path, target) whose path no delete covers at the time that ``when`` says."""
    hit = _above(rows, path).join(_clean(deletes), (F.col("above") == F.col("dpath")) & (F.col("itself") | F.col("is_prefix")) & when, "left_semi")
    return rows.join(hit.select("seq", "path").distinct(), ["seq", "path"], "left_anti")


def _covered(indexed: DataFrame, deletes: DataFrame) -> DataFrame:
    """(source_path) of the indexed sources that a delete covers."""
    rows = _above(indexed.select("source_path"), "source_path")
    return rows.join(_clean(deletes), (F.col("above") == F.col("dpath")) & (F.col("itself") | F.col("is_prefix")), "left_semi").select("source_path").distinct()


def _ordered_targets(valid: DataFrame) -> DataFrame:
    """Without the promotions whose path an earlier one, itself valid, had promoted.

    Only chains need an order: promotions of a path that an earlier one targets, and those that target a later one's path. They
    arise only where a delete names a file that is still there; one task follows them all, in order, and holds no more
    than their targets. All others are kept as they are.
    """
    first = valid.groupBy("target").agg(F.min("seq").alias("first")).withColumnRenamed("target", "t")
    last = valid.groupBy("path").agg(F.max("seq").alias("last")).withColumnRenamed("path", "p")
    marked = valid.join(first, F.col("path") == F.col("t"), "left").join(last, F.col("target") == F.col("p"), "left")
    chained = F.coalesce(F.col("first") < F.col("seq"), F.lit(False)) | F.coalesce(F.col("last") > F.col("seq"), F.lit(False))
    marked = marked.select("seq", "path", "target", chained.alias("chained"))

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        targets = set()
        for batch in batches:
            kept = []
            for path, target in zip(batch["path"], batch["target"], strict=True):
                kept.append(path not in targets)
                if kept[-1]:
                    targets.add(target)
            yield batch[pd.Series(kept, index=batch.index, dtype=bool)]

    chains = marked.filter("chained").drop("chained").repartition(1).sortWithinPartitions("seq", "path")
    return marked.filter("NOT chained").drop("chained").unionByName(chains.mapInPandas(follow, "seq bigint, path string, target string"))
