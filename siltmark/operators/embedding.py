"""From chunks to points: what is embedded, what becomes of the vectors, and the points' payload."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmark.functions.ids import point_id
from siltmark.functions.text import is_useful, let, strip
from siltmark.functions.vectors import stub_vector, vector_mean
from siltmark.schema import INDEX_VERSION


def embedding_inputs(text: Column, parts: Column) -> Column:
    """The stripped parts that aren't blank; without any, the stripped text."""
    kept = F.filter(F.transform(F.coalesce(parts, F.array().cast("array<string>")), strip), lambda p: p != "")
    return let(kept, lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.array(strip(text))))


def useful_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.filter((strip("text") != "") & is_useful(F.col("text")))


def stub_embedder(inputs: Column) -> Column:
    return F.transform(inputs, stub_vector)


def python_embedder(embed: Callable[[list[str]], list[list[float]]], most: int | None = None) -> Callable[[Column], Column]:
    """An embedder from a function of texts to vectors, called once for a document, or for each ``most`` of its texts; what it raises fails the document, not the job."""

    @F.pandas_udf("array<array<double>>")
    def run(inputs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in inputs:
            out = []
            for texts in rows:
                try:
                    vectors, step = [], most or max(1, len(texts))
                    for i in range(0, len(texts), step):
                        vectors += embed(list(texts[i : i + step]))
                    out.append([[float(x) for x in v] for v in vectors])
                except Exception:  # noqa: BLE001  the document keeps its old points
                    out.append(None)
            yield pd.Series(out)

    return run.asNondeterministic()  # so that no request is made twice for one place in a plan


def embed_chunks(chunks: DataFrame, embedder: Callable[[Column], Column] = stub_embedder) -> DataFrame:
    """chunks (rel_path, chunk_no, text, embedding_parts, ...) with chunk_index, vector and failed.

    The embedder gets all texts of a document at once. chunk_index counts a document's useful chunks from 0. A document fails as a
    whole when the embedder fails, when it returns another number of vectors than it got texts, or when a chunk's vectors have
    no mean.

    What is computed for a document comes out of the explode, failed too, and the explode is an outer one, though no document
    lacks chunks: a condition on it, asked for or inferred, would be moved below and compute all for each chunk again.
    """
    names = [c for c in chunks.columns if c != "rel_path"]
    useful = useful_chunks(chunks).select("rel_path", F.struct("chunk_no", F.struct(*names).alias("chunk")).alias("c"))
    documents = useful.groupBy("rel_path").agg(F.array_sort(F.collect_list("c")).alias("cs"))  # a document's own chunks
    documents = documents.withColumn("inputs", F.transform("cs", lambda c: embedding_inputs(c["chunk"]["text"], c["chunk"]["embedding_parts"])))
    firsts = F.flatten(F.transform("inputs", lambda ts: F.transform(ts, lambda _, k: k == 0)))  # every chunk has a text
    starts = F.filter(F.transform(firsts, lambda first, i: F.when(first, i)), lambda i: i.isNotNull())
    documents = documents.withColumn("texts", F.flatten("inputs")).withColumn("starts", starts)
    documents = documents.withColumn("vectors", embedder(F.col("texts"))).withColumn("complete", F.size("vectors") == F.size("texts"))
    part = lambda i: F.slice("vectors", F.get("starts", i) + 1, F.size(F.get("inputs", i)))
    vector = lambda i: F.when(F.col("complete"), let(part(i), vector_mean))
    means = documents.select("rel_path", "cs", F.transform("cs", lambda _, i: vector(i)).alias("means"))
    told = means.withColumn("failed", F.exists("means", lambda v: v.isNull()))
    made = F.transform("cs", lambda c, i: F.struct(i.alias("chunk_index"), c["chunk"].alias("chunk"), F.get("means", i).alias("vector"), F.col("failed").alias("failed")))
    return told.select("rel_path", F.explode_outer(made).alias("m")).select("rel_path", *[F.col(f"m.chunk.{c}").alias(c) for c in names], "m.chunk_index", "m.vector", "m.failed")


def same_dimension(embedded: DataFrame) -> DataFrame:
    """Without the chunks whose vector differs in length from their document's first; their numbers stay unused."""
    first = F.first(F.size("vector")).over(Window.partitionBy("rel_path").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return embedded.withColumn("dim", first).filter(F.size("vector") == F.col("dim")).drop("dim")


def points(embedded: DataFrame) -> DataFrame:
    """The points of the documents that didn't fail. What is empty or zero in an optional field is null."""
    ok = same_dimension(embedded.filter(~F.col("failed")))
    return ok.select(
        point_id(F.col("rel_path"), F.col("chunk_index")).alias("id"), "vector", F.col("rel_path").alias("source_path"), "chunk_index", "text", "file_hash",
        F.lit(INDEX_VERSION).alias("index_version"), "chunk_type", F.when(F.size("headings") > 0, F.col("headings")).alias("headings"),
        F.when(F.col("table_ref") != "", F.col("table_ref")).alias("table_ref"), F.when(F.col("row_count") != 0, F.col("row_count")).alias("row_count"),
    )


def parse_embeddings(body: Column, expected: Column) -> Column:
    """The vectors in a model server's JSON answer: ``embeddings`` of the expected number; for one text also ``embedding``, or the first of more; null otherwise."""
    many = F.from_json(body, "struct<embeddings:array<array<double>>>", {"mode": "PERMISSIVE"})["embeddings"]
    one = F.from_json(body, "struct<embedding:array<double>>", {"mode": "PERMISSIVE"})["embedding"]
    numeric = lambda vs: vs.isNotNull() & F.forall(vs, lambda v: v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull()))
    single = F.when(numeric(F.array(one)), F.array(one)).when((F.size(many) > 1) & numeric(F.slice(many, 1, 1)), F.slice(many, 1, 1))
    return F.when(numeric(many) & (F.size(many) == expected), many).when(expected == 1, single)


def nearest(points_: DataFrame, query: list[float], k: int) -> DataFrame:
    """An extension: the k points with the largest cosine to the query."""
    from siltmark.functions.vectors import cosine

    scored = points_.select("id", "source_path", "chunk_index", cosine(F.col("vector"), F.array(*[F.lit(float(x)) for x in query])).alias("score"))
    return scored.orderBy(F.col("score").desc(), "id").limit(k)
