"""Exact de-duplication by sorting content.

A row's place is its normalised text: the leading characters, then a hash of the whole text where many texts share those,
then a hash of the row's other columns, which only matters within a run of equal texts. Splitters from a sample cut
these places into as many ranges as there are shuffle partitions; each range is sorted externally by the whole normalised
text, so that equal texts are adjacent, and neighbours whose *whole* texts compare equal are one run.

A run that is longer than a range is cut by more than one splitter and so lies in several ranges. The splitters name
these texts, fewer than there are ranges; their runs are added up across the borders, by whole text, in one pass with
map-side combination, and the sums go to all ranges. Every row takes the same road, whatever the size of its run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmark.llm._common import ascii_lower, cut, let, parquet, partitions

PREFIX = 64
#: Bytes of text that a range should hold, and the most ranges; beyond that they grow, and their sorts spill.
RANGE_BYTES, MOST_RANGES = 1 << 26, 20_000
#: Sampled rows for each range; the driver holds so many places of 100 characters or so.
SAMPLED = 32
_HASHED = ("tinyint", "smallint", "int", "bigint", "float", "double", "string", "binary", "boolean", "date", "timestamp", "timestamp_ntz", "decimal")


def content_place(norm: Column) -> Column:
    """Equal for equal texts, and ordered as their leading characters; what follows a text's end sorts below all characters."""
    return F.concat(F.substring(norm, 1, PREFIX), F.lit("\0"), F.hex(F.xxhash64(norm)), F.lit("\0"))


def splitters(places: list[str], ranges: int) -> tuple[list[str], list[str]]:
    """Of a sample's places: the lower bounds of all ranges but the first, and the contents that several ranges share.

    A bound is a whole place only where its neighbour has the same content; elsewhere it is the beginning of a content,
    which then isn't cut.
    """
    places = sorted(places)
    content = lambda x: x[: x.rindex("\0") + 1]
    bounds = [places[i * len(places) // ranges] for i in range(1, ranges)] if places else []
    shared = {content(a) for a, b in zip(bounds, bounds[1:], strict=False) if content(a) == content(b)}
    return sorted({b if content(b) in shared else content(b) for b in bounds}), sorted(shared)


def range_of(place: Column, bounds: list[str]) -> Column:
    """How many of the sorted bounds aren't above the place: a look at each block's first bound, then at one block."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda xs, at: F.size(F.filter(xs, lambda x: x <= at))
    within = lambda at, n: F.when(n == 0, F.lit(0)).otherwise((n - 1) * step + below(F.get(F.array(*[F.lit(b) for b in blocks]), n - 1), at))
    return let(place, lambda at: let(below(F.lit([b[0] for b in blocks]), at), lambda n: within(at, n)))


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", ranges: int | None = None, seed: int = 11) -> DataFrame:
    """Input rows as the struct ``row``, with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. ``keep`` says whether the
    smallest or the largest identifier stays. Null identifiers stay only where a group has no other. Of repeated
    rows with the same identifier and text one stays. An empty table gives no rows. Other columns, whatever
    their names, travel inside ``row``. If not given, there are as many
    ranges as shuffle partitions, and more where they would be long.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    others = [F.col(c) for c, kind in docs.dtypes if c != text_col and kind.split("(")[0] in _HASHED]
    place = F.concat(content_place(norm), F.hex(F.xxhash64(*others) if others else F.lit(0)))
    rows = max(1, docs.count())
    sampled = lambda n: docs.sample(False, min(1.0, SAMPLED * n / rows), seed).select(place.alias("place"), F.octet_length(norm).alias("bytes")).collect()
    sample = sampled(ranges or partitions(docs.sparkSession))
    if not ranges:
        ranges = max(partitions(docs.sparkSession), min(MOST_RANGES, rows * sum(r.bytes for r in sample) // max(1, len(sample)) // RANGE_BYTES))
        if ranges > partitions(docs.sparkSession):
            sample = sampled(ranges)
    bounds, shared = splitters([r.place for r in sample], ranges)

    near = F.substring(norm, 1, PREFIX).isin(sorted({c[: c.index("\0")] for c in shared})) if shared else F.lit(False)
    long_runs = docs.filter(near).filter(content_place(norm).isin(shared) if shared else F.lit(False))
    long_runs = long_runs.select(norm.alias("norm"), F.col(id_col).alias("id"), range_of(place, bounds).alias("range")).groupBy("norm")
    if keep == "min":
        best = F.min(F.struct(F.col("id").isNull(), "id", "range"))
    else:
        best = F.max(F.struct(F.col("id").isNotNull(), "id", (-F.col("range")).alias("range")))
    long_runs = long_runs.agg(best.alias("best"), F.count(F.lit(1)).alias("rows"))
    long_runs = cut(long_runs.select(F.sha2("norm", 256).alias("sha"), F.col("best.id").alias("keep"), F.abs("best.range").alias("at"), "rows"))

    id_ = F.col("row")[id_col]
    rank = id_.asc_nulls_last() if keep == "min" else id_.desc_nulls_last()
    run = Window.partitionBy("range", "norm").orderBy(rank)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = docs.select(F.struct(*docs.columns).alias("row"), range_of(place, bounds).alias("range")).repartitionById(ranges, F.col("range"))
    dealt = dealt.withColumn("norm", ascii_lower(F.coalesce(F.col("row")[text_col], F.lit(""))))
    runs = dealt.select("row", "range", F.sha2("norm", 256).alias("text_sha256"), F.first(id_).over(whole).alias("run_keep"), F.count(F.lit(1)).over(whole).alias("run_rows"), F.row_number().over(run).alias("nth"))
    runs = runs.join(F.broadcast(long_runs), F.col("text_sha256") == F.col("sha"), "left")  # fewer rows than ranges
    whole_run = F.col("sha").isNull()
    keep_id = F.when(whole_run, F.col("run_keep")).otherwise(F.col("keep"))
    kept = (F.col("nth") == 1) & (whole_run | (F.col("range") == F.col("at")))
    return runs.select("row", keep_id.alias("keep_id"), F.coalesce("rows", "run_rows").alias("group_size"), kept.alias("kept"), "text_sha256")


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = content_sort_dedup(parquet(spark, sf_dir, "documents").select("doc_id", "text"), keep="max")
    return found.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
