"""WARC archives: a writer of one gzip member per record, and a sequential reader.

The reader decompresses member by member in bounded pieces, frames each record's block by its Content-Length, and
verifies the digest of what it read. It never seeks and never holds more than a piece of a block, unless payloads
are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.llm._common import cut, new_folder, parquet, small_batches

PIECE = 1 << 16
#: Bytes of a record's header, which is held whole; a record with a longer one is reported as an error.
HEADER = 1 << 26
#: Parts that rows with equal payloads are dealt into, to be joined apart.
SALTS = 16
_NAMES = uuid.UUID("5f0c1a52-7d0e-4e1c-9a55-0d6c2b1f7e31")


def digest_name(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_urn(id_: int | None, salt: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{id_}{salt}')}>"


def record(id_: int | None, uri: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z", salt: str = "") -> bytes:
    """One record as a gzip member: a response with the payload, or, with refers_to, a revisit without it."""
    digest, head = digest_name(hashlib.sha1(payload).digest()), b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        block = head + b"\r\n"
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_urn(id_, salt), "WARC-Date": date}
    if uri is not None:
        fields["WARC-Target-URI"] = uri.replace("\r", "%0D").replace("\n", "%0A")
    if refers_to is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_urn(refers_to), "X-Refers-To-Row": str(refers_to)}
    if id_ is not None:
        fields["X-Row"] = str(id_)
    fields |= {"WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": str(len(payload)), "WARC-Block-Digest": f"sha1:{digest_name(hashlib.sha1(block).digest())}", "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


class Members:
    """The decompressed content of consecutive gzip members, read in bounded pieces."""

    def __init__(self, stream):
        self.stream, self.rest, self.inflate, self.held = stream, b"", None, b""

    def open_member(self) -> bool:
        if not self.rest:
            self.rest = self.stream.read(PIECE)
        self.inflate, self.held = zlib.decompressobj(31), b""
        return bool(self.rest)

    def more(self) -> bool:
        """Some more of this member into held, if there is any."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.rest or self.stream.read(PIECE)
            if not data:
                raise EOFError("the archive ends within a member")
            if not self.inflate.unconsumed_tail:
                self.rest = b""
            got = self.inflate.decompress(data, PIECE)
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
            if got:
                self.held += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        found, at = bytearray(self.held), 0
        while (end := found.find(mark, max(0, at - len(mark) + 1))) < 0:
            at, self.held = len(found), b""
            if at > HEADER:
                raise ValueError(f"a header of more than {HEADER} bytes")
            if not self.more():
                raise ValueError("no end of a header")
            found += self.held
        self.held = bytes(found[end + len(mark) :])
        return bytes(found[:end])

    def pieces(self, n: int) -> Iterator[bytes]:
        if n < 0:
            raise ValueError("a negative Content-Length")
        while n:
            if not self.held and not self.more():
                raise ValueError("a block is shorter than its Content-Length")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece

    def close_member(self) -> bytes:
        """What is left of the member, a piece at most; all of it is passed over, so that the next member can be opened."""
        while len(self.held) < PIECE and self.more():
            pass
        left = self.held
        while self.more():
            self.held = b""
        self.held = b""
        return left


def framed(members: Members, with_payload: bool) -> dict:
    """The record of the member that is open, to the member's end."""
    lines = members.until(b"\r\n\r\n").decode("utf-8", "surrogatepass").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block, body, size, tail, kept = hashlib.sha1(), hashlib.sha1(), 0, b"", []
    in_head = fields.get("content-type", "").startswith("application/http")
    for piece in members.pieces(int(fields["content-length"])):
        block.update(piece)
        if in_head:
            piece = tail + piece
            end = piece.find(b"\r\n\r\n")
            if end < 0:
                tail = piece[-3:]
                continue
            piece, in_head = piece[end + 4 :], False
        body.update(piece)
        size += len(piece)
        if with_payload:
            kept.append(piece)
    valid = lines[0].startswith("WARC/1.") and members.close_member() == b"\r\n\r\n"
    valid &= fields.get("warc-block-digest") in (None, f"sha1:{digest_name(block.digest())}")
    found = {"fields": fields, "payload_bytes": size, "payload_digest": digest_name(body.digest())}
    if fields.get("warc-type") == "revisit":
        found |= {"payload_bytes": int(fields["x-payload-length"]) if "x-payload-length" in fields else None, "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
    else:
        valid &= fields.get("warc-payload-digest") in (None, f"sha1:{found['payload_digest']}")
    return found | {"valid": valid, "payload": b"".join(kept) if with_payload else None}


def unread(error: Exception) -> dict:
    return {"fields": {}, "payload_bytes": None, "payload_digest": None, "valid": False, "payload": None, "error": str(error)}


def records(stream, with_payload: bool = False) -> Iterator[dict]:
    """A dict per record, in the archive's order: fields (names in lower case), payload_bytes, payload_digest, valid and, if asked for, payload.

    valid is False where a digest or the framing doesn't hold. A member whose header or framing can't be read gives a
    dict that says so in ``error``, and the next member is read; after broken compression or the archive's end within a
    member nothing more can be read, and the last dict says so.
    """
    members = Members(stream)
    while members.open_member():
        found, lost = None, False
        try:
            try:
                found = framed(members, with_payload)
            except (ValueError, KeyError) as error:
                found = unread(error)
            members.close_member()
        except (zlib.error, EOFError) as error:
            found, lost = found or unread(error), True
        yield found
        if lost:
            return


def with_responses(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """The rows as the struct row, with refers_to: the largest identifier of equal payloads of at least so many bytes, null for itself."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    keyed = pages.select(F.struct(*pages.columns).alias("row"), F.sha2(payload, 256).alias("key"), F.col(id_col).alias("id"), F.octet_length(payload).alias("bytes"))
    shared = keyed.groupBy("key").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = shared.select(F.col("key").alias("k"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    others = [F.col("row")[c] for c, kind in pages.dtypes if c != payload_col and kind in ("bigint", "int", "string")]
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int"))
    own = (F.col("bytes") < least_bytes) | F.col("id").eqNullSafe(F.col("first"))
    return salted.join(first, (F.col("key") == F.col("k")) & (F.col("salt") == F.col("s")), "left").select("row", F.when(~own, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes an archive per partition into the folder, a URI that all executors reach; returns (archive, records), written when it returns.

    Null payloads count as empty, null URIs are left out. Of records with equal payloads of at least
    ``least_bytes`` the one with the largest identifier is the response that the others, rows without an identifier
    among them, revisit; rows that repeat that identifier are responses too. A task that is tried again writes
    its archive anew under another name and renames it when complete.
    """
    small_batches(pages.sparkSession)
    rows = with_responses(pages, id_col, payload_col, least_bytes)
    rows = rows.select(F.col("row")[id_col].alias("id"), F.col("row")[uri_col].alias("uri"), F.coalesce(F.col("row")[payload_col].cast("binary"), F.lit("").cast("binary")).alias("payload"), "refers_to")
    base, root = fs.FileSystem.from_uri(folder)
    base.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task, n, out, name = TaskContext.get(), 0, None, f"part-{uuid.uuid4().hex}"
        final = f"{root}/part-{task.partitionId():06d}.warc.gz"
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                out = out or store.open_output_stream(f"{root}/.{name}.tmp", compression=None)
                out.write(record(*row, salt="" if row[0] is not None else f"{task.partitionId()}:{n}"))
                n += 1
        if out:
            out.close()
            store.move(f"{root}/.{name}.tmp", final)
            yield pa.RecordBatch.from_pydict({"archive": [final], "records": [n]})

    return cut(rows.mapInArrow(write, "archive string, records long"))


_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, valid boolean, error string, payload binary"


def _rows(stream, with_payload: bool) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("valid", pa.bool_()), ("error", pa.string()), ("payload", pa.binary())])
    rows, size = [], 0
    whole = lambda x: None if x is None else int(x)
    for r in records(stream, with_payload):
        f = r["fields"]
        rows.append({"page_id": whole(f.get("x-row")), "url": f.get("warc-target-uri"), "record_type": f.get("warc-type"), "refers_to": whole(f.get("x-refers-to-row")), "error": r.get("error")} | {k: r[k] for k in ("payload_bytes", "payload_digest", "valid", "payload")})
        size += len(r["payload"] or b"") + 200
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
            rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=kinds)


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives of write_archives: read where they lie, as streams."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None, buffer_size=PIECE) as stream:
                    yield from _rows(stream, with_payload)

    return archives.select("archive").mapInArrow(read, _SCHEMA)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives at a path that Spark reads, a task per archive.

    Archives in a store that the workers can open too (local paths that all share, and what Arrow knows) are read as streams of any
    length. Those that only Spark reaches are fetched whole, which its binaryFile source does up to 2 GiB.
    """
    names = spark.read.format("binaryFile").load(path).select("path")
    scheme = path.partition(":")[0] if "://" in path or path.startswith("file:") else "file"
    if scheme in STREAMED:

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    store, at = opened(name)
                    with store.open_input_stream(at, compression=None, buffer_size=PIECE) as archive:
                        yield from _rows(archive, with_payload)

        return names.repartition(max(1, names.count())).mapInArrow(stream, _SCHEMA)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _rows(pa.BufferReader(content.as_buffer()), with_payload)

    return spark.read.format("binaryFile").load(path).select("content").repartition(max(1, names.count())).mapInArrow(read, _SCHEMA)


#: Schemes that Arrow opens without Hadoop's libraries.
STREAMED = ("file", "s3", "s3a", "gs")


def opened(name: str):
    """Arrow's file system for one of Spark's file names, and the path in it."""
    scheme, _, rest = name.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    return fs.FileSystem.from_uri(name.replace("s3a:", "s3:", 1))


def op1_warc(spark, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    archives = write_archives(parquet(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    found = cut(read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid"))
    store, root = fs.FileSystem.from_uri(folder)
    store.delete_dir(root)  # read back; what it held is in ``found``
    return found


#: sha1 of DuckDB is hexadecimal; base 32 takes its bits by fives.
OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS x, max(page_id) OVER (PARTITION BY body) AS top FROM p),
d AS (SELECT *, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
          (('0x' || substr(x || '00', 1 + ((i * 5) // 4), 3))::INT >> (7 - ((i * 5) % 4))) & 31)::INT, 1)), '') AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to, true AS valid
FROM d
"""
