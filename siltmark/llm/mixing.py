"""Mixing sources to target weights, cut at each source's exact budget.

Each document gets a random key from a hash of its identifier. Keys are uniform, so the splitters that divide
a source's key order into ranges are known beforehand: range b of G holds the keys from b/G to (b+1)/G. Word
counts are summed per (source, range), these sums are accumulated over the ranges of a source, and a running
sum within each range completes the prefix sum. A source that holds most rows is spread over all its ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmark.llm._common import BLANKS, cut, parquet, partitions, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) with each source's target: share of all sizes dealt by weight, at most ``most`` times its size.

    Weights go to the sources by code point, null last, and repeat. The excess of a source at its limit goes to
    the others by weight until none is above: with sources ordered by limit / weight, a source is at its limit
    exactly if the level that the rest would get exceeds its own ratio. The table has a row for each source.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", pick)
    ranked = ranked.withColumn("most", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * float(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    free = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), "nth", "level"))).over(whole)["level"]
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * free))
    return leveled.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, carry: list[str] | None = None) -> DataFrame:
    """Input rows (of the columns in ``carry``, by default all) as the struct ``row``, with size, source_size, target and taken (words the mix takes of the row).

    A source's budget is its target, rounded down to whole words. Whole epochs take every document; what is left
    takes documents in the order of their keys, and of the one at the cut only as many words as fit. Null texts
    have no words; null sources are one source, the last; null identifiers share one key and are ordered by
    text. Rows that are equal in identifier and text are interchangeable. An empty table gives no rows. Reruns
    agree, whatever the partitioning.
    """
    ranges = max(1, partitions(docs.sparkSession))
    id_, text, source = F.col(id_col), F.col(text_col), F.col(source_col)
    key = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    range_ = F.floor(F.conv(F.substring(F.col("key"), 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(float(1 << 32))).cast("long")
    sized = docs.select(F.struct(*(carry or docs.columns)).alias("row"), source.alias("source"), F.size(words(text)).cast("long").alias("size"), key.alias("key"), id_.alias("id"), F.xxhash64(text).alias("tie")).withColumn("range", range_)

    sums = cut(sized.groupBy("source", "range").agg(F.sum("size").alias("range_size")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    starts = starts.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(F.col("source").alias("s"), F.col("range").alias("r"), "start", "source_size", "target")

    within = Window.partitionBy("range", "source").orderBy("key", "id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(cut(starts), (F.col("range") == F.col("r")) & F.col("source").eqNullSafe(F.col("s")))
    placed = placed.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    left = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), left - F.col("before")))
    return placed.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, with the blanks between as they were."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"([{BLANKS}]*[^{BLANKS}]+)"), F.lit(1)), F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself, in the columns of docs: a row for each whole epoch of a document, and of one at the cut the words that fit."""
    mixed = mix_sources(docs, text_col=text_col, **options).filter("taken > 0")
    each = mixed.select("row", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("size"))), lambda e: F.least(F.col("size"), F.col("taken") - e * F.col("size")))).alias("words"), "size")
    cut_text = F.when(F.col("words") < F.col("size"), first_words(F.col("row")[text_col], F.col("words"))).otherwise(F.col("row")[text_col])
    return each.select(*[(cut_text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(parquet(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=["doc_id"])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':17') AS key FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s GROUP BY source),
w AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (nth - 1) % 3] AS weight, source_size * 2.0::DOUBLE AS most FROM t),
l AS (
  SELECT *, most / weight AS ratio,
    (sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (ORDER BY most / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (SELECT *, most <= level * weight AS at_most, (SELECT arg_min(l2.level, (l2.ratio, l2.nth)) FROM l l2 WHERE NOT l2.most <= l2.level * l2.weight) AS free FROM l),
g AS (SELECT source, source_size, CASE WHEN at_most THEN most ELSE least(most, weight * free) END AS target FROM f),
p AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
   + least(size, greatest(0, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before)))::BIGINT AS taken
FROM p
"""
