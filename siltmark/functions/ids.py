"""Hashes and identifiers as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmark.functions.text import let, strip
from siltmark.schema import INDEX_VERSION, POINT_NAMESPACE


def content_hash(content: Column, version: str = INDEX_VERSION) -> Column:
    """SHA-256 of the index version, a zero byte and the content, in hex: a new version re-indexes everything."""
    return F.sha2(F.concat(F.encode(F.lit(version), "UTF-8"), F.unhex(F.lit("00")), content.cast("binary")), 256)


def point_id(source_path: Column, chunk_index: Column) -> Column:
    """UUID version 5 of "path::index"."""
    name = F.concat(source_path, F.lit("::"), chunk_index.cast("string"))
    hash_ = F.sha1(F.concat(F.unhex(F.lit(POINT_NAMESPACE)), F.encode(name, "UTF-8")))
    part = lambda h, a, n: F.substring(h, a, n)
    variant = lambda h: F.lower(F.hex(F.conv(part(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return let(hash_, lambda h: F.concat_ws("-", part(h, 1, 8), part(h, 9, 4), F.concat(F.lit("5"), part(h, 14, 3)), F.concat(variant(h), part(h, 19, 2)), part(h, 21, 12)))


def fallback_ref(text: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("markdown:"), ordinal.cast("string"), F.lit(":"), F.substring(F.sha2(strip(text), 256), 1, 16))
