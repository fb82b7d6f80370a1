"""Token counts as rollups that are maintained by deltas.

A batch of changes becomes additive deltas (documents, tokens) by source, language and tokenizer version: an insert
adds, a delete subtracts, a revised count subtracts what was counted and adds what is counted now, under whichever
tokenizer version. Deltas are pre-aggregated and written first; then the batch is committed by a file under its name, which
appears whole and succeeds once. A batch that is sent again, or whose first attempt was lost at any point, so counts exactly
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.llm._common import cut, delete_folder, new_folder, parquet, release, words
from siltmark.operators.store import publish

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Of changes (op, source, lang, tokenizer, n_tokens, old_tokenizer, old_tokens) the signed sums by key; op is insert, delete or revise.

    A delete takes back old_tokens under old_tokenizer. Null sources and languages are keys of their own, null
    counts are 0, other ops count nothing. Other columns don't matter.
    """
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    plus = F.struct(F.col("tokenizer").alias("tokenizer"), F.lit(1).cast("long").alias("n_docs"), n("n_tokens").alias("n_tokens"))
    minus = F.struct(F.col("old_tokenizer").alias("tokenizer"), F.lit(-1).cast("long").alias("n_docs"), (-n("old_tokens")).alias("n_tokens"))
    signed = F.when(F.col("op") == "insert", F.array(plus)).when(F.col("op") == "delete", F.array(minus)).when(F.col("op") == "revise", F.array(minus, plus))
    rows = changes.select("source", "lang", F.explode(signed).alias("d")).select("source", "lang", "d.*")
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenRollup:
    """A rollup in a folder that all executors reach; several writers may commit to it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in ("data", "commits"):
            self._fs.mkdirs(self._path(f"{self.folder}/{name}"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Counts the batch once; False if it was counted before."""
        if not batch or "/" in batch or batch.startswith((".", "_")):
            raise ValueError("a batch's name is a file name")
        if self._fs.exists(self._path(f"{self.folder}/commits/{batch}")):
            return False
        data = new_folder(self.spark, "x").rpartition("/")[2]
        deltas(changes).write.parquet(f"{self.folder}/data/{data}")
        return self._publish(batch, data)

    def _publish(self, batch: str, data: str) -> bool:
        if publish(self.spark, f"{self.folder}/commits/{batch}", data):
            return True
        self._fs.delete(self._path(f"{self.folder}/data/{data}"), True)
        return False

    def batches(self) -> dict[str, str]:
        """Name -> folder of each committed batch."""
        found = {}
        for status in self._fs.listStatus(self._path(f"{self.folder}/commits")):
            name = status.getPath().getName()
            if not name.startswith("."):
                stream = self._fs.open(status.getPath())
                found[name] = bytes(stream.readAllBytes()).decode()
                stream.close()
        return found

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs and n_tokens of the keys that have documents or tokens."""
        paths = [f"{self.folder}/data/{d}" for d in self.batches().values()]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def count_pieces(text: Column) -> Column:
    """Runs of letters and digits, and single other characters that are no blanks."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"), F.lit(0))).cast("long")


def op6_token_rollup(spark, sf_dir: str) -> DataFrame:
    """All documents are inserted; the toxic ones are deleted, which is sent twice; those of low quality are counted anew by the second tokenizer."""
    docs, labels = parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "labels")
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    none = F.lit(None).cast("string")
    # one pass over the texts for all batches, before any join, so that no text is shuffled
    sized = cut(docs.select("doc_id", "source", "lang", count_words(F.col("text")).alias("first"), count_pieces(F.col("text")).alias("second")))
    rollup.commit("inserts", sized.select(F.lit("insert").alias("op"), "source", "lang", F.lit("words-1").alias("tokenizer"), F.col("first").alias("n_tokens"), none.alias("old_tokenizer"), F.lit(0).alias("old_tokens")))
    told = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality")).filter("toxic = 1 OR quality = 0")
    counted = sized.join(told, "doc_id")
    deletes = counted.filter("toxic = 1").select(F.lit("delete").alias("op"), "source", "lang", none.alias("tokenizer"), F.lit(0).alias("n_tokens"), F.lit("words-1").alias("old_tokenizer"), F.col("first").alias("old_tokens"))
    rollup.commit("deletes", deletes)
    revised = counted.filter("quality = 0 AND coalesce(toxic, 0) <> 1")
    rollup.commit("revised", revised.select(F.lit("revise").alias("op"), "source", "lang", F.lit("pieces-2").alias("tokenizer"), F.col("second").alias("n_tokens"), F.lit("words-1").alias("old_tokenizer"), F.col("first").alias("old_tokens")))
    rollup.commit("deletes", deletes)
    release(sized)
    totals = cut(rollup.totals())
    delete_folder(spark, rollup.folder)  # a rollup of its own for this query
    return totals


OP6_SQL = r"""
WITH l AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
d AS (
  SELECT source, lang, text, CASE WHEN quality = 0 THEN 'pieces-2' ELSE 'words-1' END AS tokenizer
  FROM documents LEFT JOIN l USING (doc_id) WHERE coalesce(toxic, 0) <> 1)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs,
  sum(CASE WHEN tokenizer = 'words-1' THEN len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
      ELSE len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]')) END)::BIGINT AS n_tokens
FROM d GROUP BY ALL
"""
