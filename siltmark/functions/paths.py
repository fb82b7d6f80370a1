"""Path and suffix functions, as expressions and for the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmark.schema import SUPPORTED


def parse_extensions(raw: str | None) -> frozenset[str]:
    """Of a list separated by commas, semicolons or blanks: lower-case suffixes with their dot."""
    return frozenset(("" if x.startswith(".") else ".") + x for x in re.split(r"[,;\s]+", (raw or "").lower()) if x)


def resolve_extensions(raw: str | None, readable: Iterable[str] = SUPPORTED) -> frozenset[str]:
    """The suffixes to index; all readable ones where none are given."""
    asked, known = parse_extensions(raw), frozenset(readable)
    if unknown := sorted(asked - known):
        raise ValueError(f"unsupported extensions: {', '.join(unknown)}; supported: {', '.join(sorted(known))}")
    return asked or known


def extensions(raw: Column) -> Column:
    """parse_extensions as an array, in the order of first mention."""
    parts = F.filter(F.split(F.lower(raw), r"[,;\s]+"), lambda x: x != "")
    return F.array_distinct(F.transform(parts, lambda x: F.when(x.startswith("."), x).otherwise(F.concat(F.lit("."), x))))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-case, with its dot; empty for a name without one, and for a name that only begins with one."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def indexable(path: Column, allowed: Iterable[str] = SUPPORTED) -> Column:
    """The file's own name isn't hidden and its suffix is allowed; directories may be hidden."""
    return ~base_name(path).startswith(".") & suffix(path).isin(*sorted(set(allowed) or SUPPORTED))


def is_indexable(path: str, allowed: Iterable[str] = SUPPORTED) -> bool:
    name = path.rpartition("/")[2]
    m = re.search(r"[^/](\.[^./]+)$", path)
    return not name.startswith(".") and bool(m) and m[1].lower() in (set(allowed) or SUPPORTED)


def relative(path: Column, root: str) -> Column:
    """Below root, with / between parts; null outside and for the root itself."""
    root = root.rstrip("/")
    return F.when(path.startswith(root + "/") & (F.char_length(path) > len(root) + 1), F.substring(path, len(root) + 2, 1 << 30))


def under(path: Column, prefix: Column) -> Column:
    """The path is the prefix or lies below it; nothing lies below an empty one."""
    p = F.regexp_replace(prefix, "^/+|/+$", "")
    return (p != "") & ((path == p) | F.startswith(path, F.concat(p, F.lit("/"))))


def unc(server: str, share: str, *parts: str) -> str:
    return "\\".join(["", "", server.strip("\\"), share.strip("\\/"), *[x for p in parts for x in re.split(r"[\\/]+", p) if x]])


def unc_relative(full: Column, root: str) -> Column:
    """Below a share's root, whose case doesn't count, with / between parts; null outside and for the root itself."""
    slashes = lambda x: F.regexp_replace(F.replace(x, F.lit("/"), F.lit("\\")), r"\\+$", "")
    whole, top = slashes(full), root.replace("/", "\\").rstrip("\\")
    rest = F.replace(F.regexp_replace(F.substring(whole, len(top) + 1, 1 << 30), r"^\\+", ""), F.lit("\\"), F.lit("/"))
    return F.when(F.startswith(F.lower(whole), F.lit(top.lower())) & (rest != ""), rest)
