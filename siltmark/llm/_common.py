"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Characters between words: U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset (local runs)."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="siltmark-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint; later reads survive lost executors."""
    shared_dir(df.sparkSession)
    found = df.checkpoint(eager=True)
    if (made := _made.get()) is not None:
        made.append(found)
    return found


_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """What is cut within is released at the end; results must have been written by then."""
    token = _made.set([])
    try:
        yield
    finally:
        release(*_made.get())
        _made.reset(token)


def release(*cuts: DataFrame) -> None:
    """Deletes the checkpoints of what cut() gave, once all that is made from them has been cut or written itself."""
    for df in cuts:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            delete_folder(df.sparkSession, file.get())


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Python workers get batches of so many rows at most, as whole texts can be long; for the session's later jobs too, as plans are made when they run. A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; all else stays. Texts of ASCII alone take the engine's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The array of maximal runs of other characters than BLANKS; null gives an empty array."""
    flat = F.coalesce(text, F.lit(""))
    for c in BLANKS[1:]:
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of the text are among chars, as long."""
    left = text
    for c in chars:
        left = F.replace(left, F.lit(c), F.lit(""))
    return (F.char_length(text) - F.char_length(left)).cast("long")


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
