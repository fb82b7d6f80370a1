"""Budgets in the tokens of a plugged-in tokenizer: the packing of prose and tables where lengths alone don't tell the count.

A counter is any function of a text that can be shipped to the workers. As it has to run in Python, so does all that
leads up to it: these functions say for one text what the expressions of the same names say for a column.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmark.functions import tables, text

Counter = Callable[[str], int]


class FileCounter:
    """Counts the tokens of a tokenizer file, by the tokenizers library. The file is read on the driver and goes along with the job."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.content = f.read()
        self._own = None

    def __getstate__(self):
        return {"content": self.content, "_own": None}

    def __call__(self, part: str) -> int:
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_str(self.content)
            self._own.no_truncation()
            self._own.no_padding()
        return len(self._own.encode(part, add_special_tokens=False).ids)


_LINE_ENDS = re.compile(tables.LINE_ENDS)
_HTML = re.compile(r"(<table\b.*?</table>)", re.IGNORECASE | re.DOTALL)
_ONE_HTML = re.compile(r"<table\b(?:(?!</table>).)*+</table>", re.IGNORECASE | re.DOTALL)


def flagged(lines: list[str]) -> list[tuple[bool, bool, bool]]:
    """(row, separator, opens) of each line."""
    kinds = [(tables.row_line(x), tables.separator_line(x)) for x in lines] + [(False, False)]
    return [(row, rule, row and not rule and kinds[i + 1][1]) for i, (row, rule) in enumerate(kinds[:-1])]


def segments(part: str) -> list[tuple[str, str]]:
    lines = _LINE_ENDS.split(part)
    out, table, first = [], False, 0
    for i, (row, rule, opens) in enumerate(flagged(lines)):
        if not (row or rule if table else not opens):
            out.append((table, first, i))
            table, first = opens, i
    return [("table" if t else "prose", "\n".join(lines[a:b]).strip(text.BLANKS)) for t, a, b in [*out, (table, first, len(lines))]]


def content_blocks(value: str) -> list[tuple[str, str]]:
    found = []
    for i, part in enumerate(_HTML.split(value.strip(text.BLANKS))):
        found += [("table", part)] if i % 2 else segments(part)
    return [b for b in found if b[1]]


def parse_table(value: str) -> tuple[str, str | None, list[str]] | None:
    lines = [s for x in _LINE_ENDS.split(value) if (s := x.strip(text.BLANKS))]
    if len(lines) < 2:
        return None
    flags = flagged(lines)
    rows = lambda first: [x for x, (row, _, _) in zip(lines[first:], flags[first:], strict=True) if row]
    at = next((i for i, f in enumerate(flags) if f[2]), None)
    if at is not None:
        return lines[at], lines[at + 1], rows(at + 2)
    if rows(1) and all(row or rule for row, rule, _ in flags):
        return lines[0], None, rows(1)
    whole = value.strip(text.BLANKS)
    return (whole, None, []) if _ONE_HTML.fullmatch(whole) else None


def windows(part: str, size: int, overlap: int) -> list[str]:
    """As text.char_windows."""
    part = part.replace("\r\n", "\n").replace("\r", "\n").strip(text.BLANKS)
    if len(part) <= size:
        return [part] if part else []
    starts = range(0, len(part) - overlap, size - overlap)
    return [w for at in starts if (w := part[at : at + size].strip(text.BLANKS))]


def packed(parts: list[str], sep: str, max_tokens: int, count: Counter, fixed: str = "") -> list[str]:
    """As text.pack; each run begins with ``fixed``, which counts too, and so do the pieces of a part that is too long."""
    out: list[str] = []
    held: list[str] = []
    close = lambda: out.append(fixed + sep.join(held)) if held else None
    for part in parts:
        if held and count(fixed + sep.join([*held, part])) <= max_tokens:
            held.append(part)
            continue
        close()
        held = []
        if count(fixed + part) > max_tokens:
            out += [fixed + w for w in windows(part, *text.split_limits(max_tokens))]
        else:
            held = [part]
    close()
    return out


def prose_pieces(part: str, max_tokens: int, count: Counter) -> list[str]:
    """As text.split_prose."""
    sep = "\n\n" if "\n\n" in part else "\n"
    parts = [p for x in part.split(sep) if (p := x.strip(text.BLANKS))]
    return packed(parts, sep, max_tokens, count) if len(parts) > 1 else windows(part, *text.split_limits(max_tokens))


def token_count(value: Column, count: Counter) -> Column:
    @F.pandas_udf("int")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else int(count(t)) for t in batch], dtype="Int32")

    return run(value)


def pieces(value: str, max_tokens: int, count: Counter) -> list[str]:
    out: list[str] = []
    for kind, block in content_blocks(value):
        out += [block] if kind == "table" or count(block) <= max_tokens else prose_pieces(block, max_tokens, count)
    return out


def split_oversized(value: Column, max_tokens: int, count: Counter) -> Column:
    """As tables.split_oversized."""
    if max_tokens <= 0:
        raise ValueError("max_tokens must be positive")

    @F.pandas_udf("array<string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else pieces(t, max_tokens, count) for t in batch])

    return run(value)


def parts(markdown: str, headings: list[str], caption: str, max_tokens: int, count: Counter) -> list[str]:
    prefix = "\n".join(["[Таблица]", *(["Раздел: " + " / ".join(headings)] if headings else []), *(["Подпись: " + caption] if caption else [])])
    body, table = markdown.strip(text.BLANKS), parse_table(markdown)
    full = f"{prefix}\n\n{body}"
    if count(full) <= max_tokens:
        return [full]
    if table is None:
        return [f"{prefix}\n\n{w}" for w in windows(body, *text.split_limits(max_tokens))]
    head = "\n".join(x for x in table[:2] if x is not None)
    return packed(table[2], "\n", max_tokens, count, f"{prefix}\n\n{head}".strip(text.BLANKS) + "\n") or [full]


def embedding_parts(markdown: Column, headings: Column, caption: Column, max_tokens: int, count: Counter) -> Column:
    """As tables.embedding_parts."""

    @F.pandas_udf("array<string>")
    def run(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, heads, captions in rows:
            yield pd.Series([None if t is None else parts(t, [] if h is None else list(h), c or "", max_tokens, count) for t, h, c in zip(texts, heads, captions, strict=True)])

    return run(markdown, headings, caption)
