"""The index as versioned Parquet: a commit writes beside what is there and then names it in a small file, so that readers see all of it or nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.operators.reconcile import delete_sources
from siltmark.schema import POINTS


def publish(spark: SparkSession, path: str, content: str) -> bool:
    """Writes a small file that appears whole or not at all; False, and nothing done, where the path exists already."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, _, name = path.rpartition("/")
    final, part = hadoop.Path(path), hadoop.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    context = hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(part, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    try:
        context.rename(part, final, spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Exception as error:  # of the JVM; a file that exists isn't overwritten
        files.delete(part, False)
        if "FileAlreadyExists" not in str(error):
            raise
        return False
    return True


class IndexStore:
    """A table of points in a folder that all executors reach, in any store that Hadoop can rename in.

    Points lie in buckets by a hash of their source. A version is a small file that names each bucket's folder, and the
    index's vector length; it appears whole, after all that it names was written. A commit writes the buckets anew that it
    touches and takes the others over.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 256):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at = self._path(f"{self.folder}/versions")
        return sorted(int(x.getPath().getName()) for x in self._fs.listStatus(at) if x.getPath().getName().isdigit()) if self._fs.exists(at) else []

    def _version(self, number: int) -> dict:
        """buckets (how many), dimension, and folders by bucket; version 0 is the empty index."""
        if not number:
            return {"buckets": self.buckets, "dimension": None, "folders": {}}
        stream = self._fs.open(self._path(f"{self.folder}/versions/{number:010d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _latest(self) -> int:
        return (self.versions() or [0])[-1]

    def _read(self, version: dict, wanted=None) -> DataFrame:
        paths = [f"{self.folder}/{data}/bucket={b}" for b, data in version["folders"].items() if wanted is None or int(b) in wanted]
        return self.spark.read.schema(POINTS).parquet(*paths) if paths else self.spark.createDataFrame([], POINTS)

    def read(self, version: int | None = None) -> DataFrame:
        """The points; none where nothing was committed yet. Filters and columns reach the scan."""
        return self._read(self._version(self._latest() if version is None else version))

    def drop(self, folder: str) -> None:
        """Deletes a folder beside the index's data."""
        self._fs.delete(self._path(folder), True)

    def dimension(self) -> int | None:
        return self._version(self._latest())["dimension"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("source_path"), F.lit(buckets)).cast("int")

    def _write(self, base: int, version: dict, points: DataFrame, touched: set[int] | None) -> int:
        """Version base + 1: the points in the touched buckets (None: in all), the base's in the others."""
        data, names = f"data/{uuid.uuid4().hex}", [x.split()[0] for x in POINTS.split(", ")]
        rows = points.select(*names, self._bucket(version["buckets"]).alias("bucket"))
        rows.repartitionByRange("bucket", "source_path", "id").sortWithinPartitions("bucket", "source_path").write.partitionBy("bucket").option("parquet.bloom.filter.enabled#source_path", "true").parquet(f"{self.folder}/{data}")
        written = [int(x.getPath().getName().partition("=")[2]) for x in self._fs.listStatus(self._path(f"{self.folder}/{data}")) if x.getPath().getName().startswith("bucket=")]
        kept = {} if touched is None else {b: d for b, d in version["folders"].items() if int(b) not in touched}
        some = self._read({"folders": {str(b): data for b in written[:1]}}).select(F.size("vector").alias("n")).first() if written else None
        dimension = some.n if some else version["dimension"] if kept else None
        fresh = {"buckets": version["buckets"], "dimension": dimension, "folders": kept | {str(b): data for b in written}}
        if not publish(self.spark, f"{self.folder}/versions/{base + 1:010d}", json.dumps(fresh)):
            self._fs.delete(self._path(f"{self.folder}/{data}"), True)
            raise RuntimeError(f"another writer has committed version {base + 1}")
        return base + 1

    def commit(self, points: DataFrame) -> int:
        """A new version with these points alone. Of two writers from the same version one fails, and the index stays as the other left it."""
        base = self._latest()
        return self._write(base, self._version(0), points, None)

    def replace(self, touched: DataFrame, new_points: DataFrame) -> int:
        """Commits the index without the touched sources (source_path) and with the new points. Vectors of another length than the index holds are refused.

        Only the buckets of these sources are read and written; a row for each of them comes to the driver.
        """
        base = self._latest()
        version = self._version(base)
        have = version["dimension"]
        if have is not None and not new_points.filter(F.size("vector") != have).isEmpty():
            raise ValueError(f"the index holds vectors of length {have}")
        sources = touched.select("source_path").union(new_points.select("source_path"))
        buckets = {r.b for r in sources.select(self._bucket(version["buckets"]).alias("b")).distinct().collect()}
        old = delete_sources(self._read(version, buckets), touched)
        return self._write(base, version, old.unionByName(new_points), buckets)

    def vacuum(self, keep: int = 2) -> None:
        """Drops all but the newest versions, and the buckets that none of the others names."""
        numbers = self.versions()
        names = lambda number: {(b, d) for b, d in self._version(number)["folders"].items()}
        old, held = numbers[:-keep], set().union(*map(names, numbers[-keep:]))
        gone = set().union(*map(names, old)) - held if old else set()
        for number in old:
            self._fs.delete(self._path(f"{self.folder}/versions/{number:010d}"), False)
        for bucket, data in sorted(gone):
            self._fs.delete(self._path(f"{self.folder}/{data}/bucket={bucket}"), True)
        for data in {d for _, d in gone} - {d for _, d in held}:
            self._fs.delete(self._path(f"{self.folder}/{data}"), True)


HASHES = "rel_path string, size bigint, mtime double, file_hash string"


class HashStore:
    """What a tree's files hashed to when they were last looked at: (rel_path, size, mtime, file_hash). Losing it costs time only."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _all(self) -> list[str]:
        at = self._path(self.folder)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at) if self._fs.exists(self._path(f"{self.folder}/{x.getPath().getName()}/_SUCCESS"))) if self._fs.exists(at) else []

    def read(self) -> DataFrame:
        found = self._all()
        return self.spark.read.schema(HASHES).parquet(f"{self.folder}/{found[-1]}") if found else self.spark.createDataFrame([], HASHES)

    def write(self, hashes: DataFrame) -> DataFrame:
        """Keeps these instead, and gives them as they were written."""
        before = self._all()
        name = f"{int(before[-1].partition('-')[0]) + 1 if before else 1:010d}-{uuid.uuid4().hex}"
        hashes.select(*[x.split()[0] for x in HASHES.split(", ")]).write.parquet(f"{self.folder}/{name}")
        for old in before[:-1]:  # the newest of them may still be read
            self._fs.delete(self._path(f"{self.folder}/{old}"), True)
        return self.spark.read.schema(HASHES).parquet(f"{self.folder}/{name}")
