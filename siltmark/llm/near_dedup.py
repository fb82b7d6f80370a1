"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard verification.

Shingles are compared by their 64-bit hashes, so two different ones of a pair of documents are taken for one about once in
10^13 pairs of documents with a thousand shingles each.

Two permutations make all coordinates: sigma places a shingle on a circle of 2^32 points, and coordinate k is
the least pi(point + k) over a document's shingles, that is pi shifted circularly by k.

Documents with the same shingle set are one node, named by their smallest identifier. In each bucket of a band the
members are compared with a hub, the bucket's smallest identifier; this links almost all of a group with as many
comparisons as members. The members that this leaves outside the hub's component are then compared with all
members of their bucket in other components. So every pair of a bucket is compared, or known to be in one
component, without listing the pairs of a large group.

A comparison first looks at parity sketches: bit i says whether an odd number of shingles hash to i. The bits in
which two sketches differ are at most the shingles in which the sets differ, so this bound drops no link; only pairs
that pass it become rows, and their full sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import cut, parquet, release, small_batches

#: With 32 bands of 5 coordinates a pair of similarity 0.85 is missed once in 10^8 times, one of 0.8 once in 3 * 10^5.
BANDS, ROWS = 32, 5
#: 64-bit words of a parity sketch.
WORDS = 16
#: Identifiers that are broadcast to fetch their documents; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles; of fewer words, the whole sequence is one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and U+0009 to U+000D, U+0020 only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=n)], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    s = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        s = (s ^ w[i : n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return np.unique(s)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of coordinates for each set; none of the sets is empty."""
    flat = np.concatenate(sets)
    flat = (flat ^ (flat >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    point = (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), coordinates), np.uint32)
    x, y = np.empty_like(point), np.empty_like(point)
    for k in range(coordinates):
        np.add(point, np.uint32(k), out=x)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), (b + 1) * 0xD6E8FEB86659FD93 % (1 << 64), np.uint64)
        for r in range(rows):
            h = (h ^ sig[:, b * rows + r]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        keys[:, b] = h
    return keys.view(np.int64)


def parity(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch(text: Column, width: int, bands: int, rows: int) -> Column:
    """A struct of n (shingles), digest (of the set; null where empty), keys (a key for each band) and parity (a sketch)."""

    @F.pandas_udf("n long, digest binary, keys array<long>, parity array<long>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            digests, keys, ns, odd = [None] * len(batch), [None] * len(batch), [0] * len(batch), [None] * len(batch)
            at, group, held = [], [], 0

            def close(at=at, group=group, keys=keys):
                if group:
                    for i, row in zip(at, band_keys(signatures(group, bands * rows), bands, rows), strict=True):
                        keys[i] = row
                    at.clear()
                    group.clear()

            for i, t in enumerate(batch):
                s = shingles(t, width)
                if len(s):
                    digests[i], ns[i], odd[i] = xxhash.xxh3_128_digest(s.tobytes()), len(s), parity(s)
                    at.append(i)
                    group.append(s)
                    held += len(s)
                    if held > 200_000:  # what the processor's cache holds
                        close()
                        held = 0
            close()
            yield pd.DataFrame({"n": ns, "digest": digests, "keys": keys, "parity": odd})

    return run(text)


def full_set(text: Column, width: int) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shingles(t, width).view(np.int64) for t in batch])

    return run(text)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (u, v): component is the smallest node reachable. Large-star and small-star steps, each a minimum by node and a join."""
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())

    def star(both: DataFrame) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        return both.join(least, F.col("u") == F.col("w"))

    seen = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == seen:
            break
        seen = now
        large = star(e.union(e.select("v", "u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = star(large.filter("u <> v").distinct())
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        last, e = e, cut(small.filter("u <> v").distinct())
        release(last)
    found = cut(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct()))
    release(e)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id (smallest identifier reachable) and kept (doc_id = component_id).

    Two documents are linked when 100 * shared shingles >= percent * all shingles of both. Null texts and texts
    without words have no shingles and no links. Rows that repeat an identifier are one document with
    the links of each. A row without an identifier takes the component of equal sets with one, and is kept only where
    there is none. Other columns don't matter. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = cut(own.select("id", sketch(F.col("text"), width, bands, rows).alias("s")).select("id", "s.*"))
    classes = sketched.filter("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"))
    nodes = sketched.select("id", "digest", "n", "keys", "parity").join(classes.withColumnRenamed("digest", "d"), (F.col("id") == F.col("rep")) & (F.col("digest") == F.col("d")))
    banded = nodes.select("rep", F.explode("keys").alias("key")).distinct()
    shared = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).filter("hub <> top").select(F.col("key").alias("k"), "hub")
    members = cut(banded.join(shared, F.col("key") == F.col("k")).select("key", "rep", "hub").filter("rep <> hub"))
    told = cut(nodes.join(members.select(F.explode(F.array("rep", "hub")).alias("w")).distinct(), F.col("rep") == F.col("w")).select("rep", "n", "parity"))

    def sketch_of(name: str, to: str) -> DataFrame:
        return told.select(F.col("rep").alias(name), F.col("n").alias(f"n_{to}"), F.col("parity").alias(f"p_{to}"))

    def possible() -> Column:
        """Whether the sketches a and b allow a link: sets of s elements together that differ in d have similarity (s - d) / (s + d)."""
        total = F.col("n_a") + F.col("n_b")
        differ = sum((F.bit_count(F.get("p_a", i).bitwiseXOR(F.get("p_b", i))) for i in range(WORDS)), F.lit(0))
        near_in_size = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        return near_in_size & ((total - differ) * 100 >= (total + differ) * percent)

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) that were cut, those that are linked, as (u, v); the pairs can't be read afterwards."""
        wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
        found = own.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, F.col("id") == F.col("rep"))
        sets = cut(found.select("rep", full_set(F.col("text"), width).alias("shingles")))
        left = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
        both = left.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
        shared_ = F.size(F.array_intersect("sa", "sb"))
        linked = cut(both.filter(shared_ * 100 >= (F.size("sa") + F.size("sb") - shared_) * percent).select(F.col("a").alias("u"), F.col("b").alias("v")))
        release(wanted, sets, pairs)
        return linked

    with_hub = members.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    with_hub = with_hub.join(sketch_of("a", "a"), "a").join(sketch_of("b", "b"), "b").filter(possible()).select("a", "b")
    several = sketched.filter("digest IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi").select(F.col("id").alias("i"))
    repeats = sketched.join(several, F.col("id") == F.col("i")).join(classes.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d")).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    by_hub = verified(cut(with_hub))
    links = cut(by_hub.union(repeats))
    release(by_hub)
    labels = components(links)

    def component_of(rows_: DataFrame, name: str, to: str) -> DataFrame:
        return rows_.join(labels.select(F.col("node").alias("of"), F.col("component").alias("found")), F.col(name) == F.col("of"), "left").withColumn(to, F.coalesce("found", name)).drop("of", "found")

    placed = component_of(component_of(members, "rep", "c"), "hub", "main")
    outside = F.col("c") != F.col("main")
    open_ = placed.groupBy("key").agg(F.count_if(outside).alias("out"), F.count(F.lit(1)).alias("all")).filter("out > 0 AND all > 1").select(F.col("key").alias("k"))
    rows_ = placed.join(open_, F.col("key") == F.col("k"), "left_semi").select("key", "rep", "c", outside.alias("outside"))
    rows_ = cut(rows_.join(told.withColumnRenamed("rep", "w"), F.col("rep") == F.col("w")).drop("w"))
    side = lambda x: rows_.select(F.col("key").alias(f"k_{x}"), F.col("rep").alias(x), F.col("c").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"p_{x}"), F.col("outside").alias(f"o_{x}"))
    once = ~F.col("o_b") | (F.col("a") < F.col("b"))
    across = side("a").filter("o_a").join(side("b"), (F.col("k_a") == F.col("k_b")) & (F.col("c_a") != F.col("c_b")) & once & possible())
    more = verified(cut(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
    if not more.isEmpty():
        first, labels = labels, components(links.union(more))
        release(first)
    release(members, told, links, rows_, more)

    named_classes = classes.join(labels, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("d"), F.coalesce("component", "rep").alias("c"))
    found = sketched.join(named_classes, F.col("digest") == F.col("d"), "left")
    component = F.coalesce("c", "id")
    kept = F.when(F.col("id").isNull(), component.isNull()).otherwise(F.col("id") == component)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(parquet(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=85)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2))) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * c >= 85 * (m.n + o.n - c)),
y AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a, b FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a),
l AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept FROM n LEFT JOIN l ON a = doc_id
"""
