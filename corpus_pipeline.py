"""The training-data pipeline: quality classifier, exact dedup, near dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the documents are
written as Parquet into the shared folder and read again, which also cuts the lineage.
"""

from itertools import accumulate

from pyspark.sql import functions as F

from siltmark.llm._common import cut, delete_folder, new_folder, parquet, scratch
from siltmark.llm.bpe import encode_documents, tokenizer_path
from siltmark.llm.exact_dedup import content_sort_dedup
from siltmark.llm.mixing import mixed_documents
from siltmark.llm.near_dedup import near_duplicates
from siltmark.llm.quality_classifier import good_documents


def quality(spark, docs, sf_dir):
    """Documents that score as low quality go."""
    return good_documents(docs, parquet(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """Of equal documents the one with the smallest identifier stays."""
    return content_sort_dedup(docs).filter("kept").select("row.*")


def near(spark, docs, sf_dir):
    """Of near-duplicates (five words, 0.8) the one with the smallest identifier stays; a row without one is a document of its own and comes last."""
    lone, shift = numbered(spark, docs)
    rows = docs.filter("doc_id IS NOT NULL").select(F.struct(*docs.columns).alias("row"), (F.col("doc_id") - shift).alias("node"))
    if lone is not None:
        rows = rows.union(lone)
    gone = near_duplicates(rows.select(F.col("node").alias("doc_id"), "row.text")).filter(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    return rows.join(gone, F.col("node") == F.col("gone"), "left_anti").select("row.*")


def numbered(spark, docs):
    """The rows without an identifier as (row, node), None if there are none, and what to take off all identifiers so that the nodes have room above them."""
    lone = cut(docs.filter("doc_id IS NULL").select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)  # of the identifiers that Spark gives: the partition, and below it the row
    sizes = sorted(map(tuple, lone.groupBy(part).count().collect()))
    if not sizes:
        return None, 0
    top = docs.agg(F.max("doc_id")).first()[0]
    first, n = 0 if top is None else top + 1, sum(k for _, k in sizes)
    shift = max(0, first + n - 2**63)
    starts = accumulate((k for _, k in sizes), initial=first - shift)
    offsets = spark.createDataFrame([(p, start) for (p, _), start in zip(sizes, starts)], "part long, start long")
    within = F.col("at").bitwiseAND(F.lit(2**33 - 1))
    return cut(lone.join(F.broadcast(offsets), part == F.col("part")).select("row", (F.col("start") + within).alias("node"))), shift


def mix(spark, docs, sf_dir):
    """A row for each time that the mix takes a document; the one at a source's cut is shortened to the words that fit."""
    return mixed_documents(docs)


def tokens(spark, docs, sf_dir):
    """A row for each of the mix: doc_id, n_tokens and the digests of its ids and of their decoding; a text's ids are those of the whole text as the mix left it."""
    return encode_documents(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("near_dedup", near), ("source_mixing", mix), ("bpe", tokens)]
#: A trained classifier isn't SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows. Of the folders between the stages the last is left, as the result reads it."""
    docs, before = parquet(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = new_folder(spark, "stage")
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
