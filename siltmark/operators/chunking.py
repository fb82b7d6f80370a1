"""From structural items to chunks: prose is gathered and split, tables stay whole and occur once.

Items are (rel_path, raw, ord, kind, self_ref, headings, text, caption): raw numbers the stretches that a reader
produced, ord the items within one, kind is prose or table. Everything happens per document: items are dealt once by
rel_path, and windows, aggregates and array expressions follow without another exchange.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmark.functions import tokenized
from siltmark.functions.ids import fallback_ref
from siltmark.functions.tables import embedding_parts, is_pure_table, row_count, split_oversized, table_text
from siltmark.functions.text import is_useful, let, normalized, strip
from siltmark.functions.tokenized import Counter

ITEMS = "rel_path string, raw int, ord int, kind string, self_ref string, headings array<string>, text string, caption string"


def clean_headings(headings: Column) -> Column:
    return F.filter(F.coalesce(headings, F.array().cast("array<string>")), lambda h: h.isNotNull() & (h != ""))


def mixed_order(items: DataFrame) -> DataFrame:
    """Items with repeats gone: (rel_path, raw, ord, kind, ref, headings, text, caption), prose between two tables in one row.

    Of a table, and of a prose item that stands beside tables, only the first mention counts; prose without a reference
    is never a repeat. A stretch without tables is one text, under its headings.
    """
    stretch = Window.partitionBy("rel_path", "raw")
    place = Window.partitionBy("rel_path", "kind", "mixed", "self_ref").orderBy("raw", "ord")
    is_table = F.col("kind") == "table"
    told = items.filter("kind IS NOT NULL").withColumn("headings", clean_headings(F.col("headings")))
    # the window with an order comes first: its sort serves the other one too
    told = told.withColumn("island", F.sum(is_table.cast("int")).over(stretch.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))).withColumn("mixed", F.max(is_table).over(stretch))
    counted = told.withColumn("nth", F.when(is_table | (F.col("mixed") & F.col("self_ref").isNotNull()), F.row_number().over(place)).otherwise(1))
    # an island is prose up to the next table, or one table; both come out of the same pass
    item = F.struct("ord", "headings", F.col("self_ref").alias("ref"), "text", "caption")
    islands = counted.filter("nth = 1").groupBy("rel_path", "raw", "island", is_table.alias("is_table"), "mixed").agg(F.array_sort(F.collect_list(item)).alias("xs"))
    first = F.get("xs", F.lit(0))
    body = F.array_join(F.filter(F.transform("xs", lambda x: strip(F.coalesce(x["text"], F.lit("")))), lambda t: t != ""), "\n\n")
    text = F.when(F.col("is_table"), strip(first["text"])).when(F.col("mixed"), body).otherwise(strip(F.concat_ws("\n", first["headings"], body)))
    none, of_table = F.lit(None).cast("string"), F.col("is_table")
    placed = islands.select(
        "rel_path", "raw", first["ord"].alias("ord"), F.when(of_table, "table").otherwise("prose").alias("kind"), F.when(of_table, first["ref"]).otherwise(none).alias("ref"),
        first["headings"].alias("headings"), text.alias("text"), F.when(of_table, first["caption"]).otherwise(none).alias("caption"),
    )
    return placed.filter("kind = 'table' OR text <> ''")


def omitted_tables(registry: DataFrame, emitted: DataFrame) -> DataFrame:
    """The tables (rel_path, ref) of the registry that no stretch mentions; they go to the document's end, without headings."""
    return registry.join(emitted.select("rel_path", "ref"), ["rel_path", "ref"], "left_anti")


def repeats(norm: Column, whole: Column) -> Column:
    """A piece only repeats a part of a table; both are normalized."""
    return (norm == "") | ((norm != whole) & F.contains(whole, norm))


def residual_fragments(pieces: DataFrame, tables: DataFrame) -> DataFrame:
    """The pieces (rel_path, pos, piece) that only repeat a part of a table rendered earlier in their document; tables are (rel_path, pos, text)."""
    fragments = pieces.filter(F.contains("piece", F.lit("|"))).withColumn("norm", normalized(F.col("piece")))
    before = tables.select(F.col("rel_path").alias("p"), F.col("pos").alias("tpos"), normalized(F.col("text")).alias("whole"))
    return fragments.join(before, (F.col("rel_path") == F.col("p")) & (F.col("tpos") < F.col("pos")) & repeats(F.col("norm"), F.col("whole")), "left_semi").drop("norm")


def without_fragments(pieces: Column) -> Column:
    """Of a document's pieces (pos, is_table, markdown), in order, those that residual_fragments leaves."""
    no = F.lit(False)
    tables = F.transform(F.filter(pieces, lambda x: x["is_table"]), lambda x: F.struct(x["pos"].alias("pos"), normalized(x["markdown"]).alias("whole")))
    told = lambda x, ts: let(normalized(x["markdown"]), lambda norm: F.coalesce(F.exists(ts, lambda t: (t["pos"] < x["pos"]) & repeats(norm, t["whole"])), no))
    gone = lambda x, ts: (F.size(ts) > 0) & ~x["is_table"] & F.contains(x["markdown"], F.lit("|")) & told(x, ts)
    return let(tables, lambda ts: F.filter(pieces, lambda x: ~gone(x, ts)))


def table_invariant(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """(rel_path, ref, n) of the references that break the rule that each occurs once and none of the registry is missing."""
    n = chunks.filter("chunk_type = 'table' AND table_ref IS NOT NULL").groupBy("rel_path", F.col("table_ref").alias("ref")).count().withColumnRenamed("count", "n")
    every = registry.select("rel_path", "ref").distinct().withColumn("known", F.lit(True)).join(n, ["rel_path", "ref"], "full_outer")
    return every.select("rel_path", "ref", F.coalesce("n", F.lit(0)).alias("n")).filter("n <> 1")


_MERGED = "struct<out:array<struct<first:int,n:int>>,first:int,n:int,len:int,raw:int,headings:array<string>,prose:boolean>"


def merge_peers(items: DataFrame, max_tokens: int) -> DataFrame:
    """Items in which neighbouring stretches of prose under the same headings are one, as long as their joined text fits the budget.

    Stretches are numbered anew from 0. A stretch with a table stays as it is. One fold over the items of each document.
    """
    others = [c for c in items.columns if c not in ("rel_path", "raw", "ord")]
    length = F.char_length(F.concat_ws("\n", clean_headings(F.col("headings")), F.coalesce("text", F.lit("")))).alias("len")
    told = items.select("rel_path", F.struct("raw", "ord", clean_headings(F.col("headings")).alias("key"), (F.col("kind") != "table").alias("prose"), length, F.struct(*others).alias("rest")).alias("x"))
    documents = told.groupBy("rel_path").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    state = lambda out, first, n, len_, x, prose: F.struct(out.alias("out"), first.alias("first"), n.alias("n"), len_.alias("len"), x["raw"].alias("raw"), x["key"].alias("headings"), prose.alias("prose")).cast(_MERGED)
    closed = lambda a: F.when(a["n"] > 0, F.array_append(a["out"], F.struct(a["first"].alias("first"), a["n"].alias("n")))).otherwise(a["out"])

    def step(a: Column, x: Column) -> Column:
        joined = a["len"] + 2 + x["len"]
        peers = a["prose"] & x["prose"] & (a["headings"] == x["key"]) & (F.floor((joined + 3) / 4) <= max_tokens)
        return F.when((a["n"] > 0) & ((a["raw"] == x["raw"]) | peers), state(a["out"], a["first"], a["n"] + 1, joined, x, a["prose"] & x["prose"])).otherwise(state(closed(a), x["i"], F.lit(1), x["len"], x, x["prose"]))

    zero = F.lit(0)
    start = F.struct(F.array().cast("array<struct<first:int,n:int>>").alias("out"), zero.alias("first"), zero.alias("n"), zero.alias("len"), zero.alias("raw"), F.array().cast("array<string>").alias("headings"), F.lit(True).alias("prose")).cast(_MERGED)
    placed = F.transform("xs", lambda x, i: F.struct(x["raw"].alias("raw"), x["key"].alias("key"), x["prose"].alias("prose"), x["len"].alias("len"), i.alias("i")))
    runs = documents.select("rel_path", "xs", F.posexplode(F.aggregate(placed, start, step, closed)).alias("stretch", "run"))
    each = runs.select("rel_path", "stretch", F.posexplode(F.slice("xs", F.col("run.first") + 1, F.col("run.n"))).alias("at", "x"))
    return each.select("rel_path", F.col("stretch").alias("raw"), F.col("at").alias("ord"), "x.rest.*").select(*items.columns)


def assemble_chunks(items: DataFrame, max_tokens: int, registry: DataFrame | None = None, tokenizer: Counter | None = None) -> DataFrame:
    """Chunks (rel_path, chunk_no, text, headings, atomic, chunk_type, table_ref, embedding_parts, row_count, error).

    registry (rel_path, ref, text, caption) names the tables that the document must show; those that no item mentions
    are added. A table without useful text, or a broken invariant, fails its document: each of its rows then has error.
    The budget counts a token for every four characters, or what the tokenizer says.
    """
    split = split_oversized if tokenizer is None else partial(tokenized.split_oversized, count=tokenizer)
    parted = embedding_parts if tokenizer is None else partial(tokenized.embedding_parts, count=tokenizer)
    placed = mixed_order(items.repartition("rel_path"))
    if registry is not None:
        last = F.lit(1 << 30)
        missing = omitted_tables(registry, placed.filter("kind = 'table'"))
        order = Window.partitionBy("rel_path").orderBy("ref")
        extra = missing.select("rel_path", last.alias("raw"), F.row_number().over(order).alias("ord"), F.lit("table").alias("kind"), "ref", F.array().cast("array<string>").alias("headings"), strip("text").alias("text"), "caption")
        placed = placed.unionByName(extra)
    is_table = F.col("kind") == "table"
    pieces = F.when(is_table, F.array("text")).otherwise(split(F.when(~is_table, F.col("text")).otherwise(F.lit("")), max_tokens))
    # outer: Spark would move a condition on what comes out below, where the pieces are cut anew for it
    cut = placed.select("rel_path", "raw", "ord", is_table.alias("is_table"), "ref", "headings", "caption", F.posexplode_outer(pieces).alias("k", "markdown"))
    cut = cut.filter(F.col("is_table") | is_useful(F.col("markdown")))
    pos = F.struct("raw", "ord", F.when(F.col("is_table"), -1).otherwise(F.col("k")).alias("k"))
    piece = F.struct(pos.alias("pos"), "is_table", "ref", "headings", "markdown", F.coalesce("caption", F.lit("")).alias("caption"))
    documents = cut.groupBy("rel_path").agg(F.array_sort(F.collect_list(piece)).alias("xs"))
    useless = F.when(F.exists("xs", lambda x: x["is_table"] & ~is_useful(x["markdown"])), "a table without useful text")
    documents = documents.select("rel_path", without_fragments(F.col("xs")).alias("xs"), useless.alias("error"))
    if registry is not None:
        broken = table_invariant(placed.filter("kind = 'table'").select("rel_path", F.lit("table").alias("chunk_type"), F.col("ref").alias("table_ref")), registry)
        broken = broken.select("rel_path", F.lit("a table that is missing or occurs twice").alias("broken")).distinct()
        documents = documents.join(broken, "rel_path", "left").select("rel_path", "xs", F.least("error", "broken").alias("error"))
    every = documents.select("rel_path", "error", F.posexplode_outer("xs").alias("chunk_no", "x")).filter("x IS NOT NULL").select("rel_path", "error", "chunk_no", "x.*")
    every = every.withColumn("is_table", F.col("is_table") | is_pure_table(F.col("markdown")))
    md, table = F.col("markdown"), F.col("is_table")
    return every.select(
        "rel_path", "chunk_no", F.when(table, table_text(md, F.col("caption"))).otherwise(md).alias("text"), "headings", table.alias("atomic"),
        F.when(table, "table").otherwise("prose").alias("chunk_type"), F.when(table, F.coalesce("ref", fallback_ref(md, F.col("chunk_no")))).alias("table_ref"),
        F.when(table, parted(md, F.col("headings"), F.col("caption"), max_tokens)).otherwise(F.array().cast("array<string>")).alias("embedding_parts"),
        F.when(table, row_count(md)).otherwise(0).alias("row_count"), "error",
    )
