"""Readers that turn a file's bytes into structural items, by suffix.

Text and Markdown are split at headings and blank lines, pipe tables become table items, a CSV file is one table,
HTML is parsed for headings, paragraphs, lists, tables and pictures that it holds itself. Word, Excel, PowerPoint and PDF files are
read by the modules beside this one. Other formats, the old binary .xls among them, need a reader that is registered; without one
they fail with an error rather than give nothing.
"""

from __future__ import annotations

import csv
import io
import re
from base64 import b64decode
from collections import Counter
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from siltmark.functions.tables import row_line, separator_line
from siltmark.schema import RICH_SUFFIXES, TEXT_SUFFIXES
from siltmark.sources.office import Picture, read_docx, read_pptx, read_xlsx
from siltmark.sources.pdf import read_pdf
from siltmark.sources.pictures import PictureOptions

ITEMS = "rel_path string, raw int, ord int, kind string, self_ref string, headings array<string>, text string, caption string, error string"

#: Gives (kind, headings, text); of kind picture the text is a Picture.
Reader = Callable[[bytes], Iterator[tuple[str, list[str], str | Picture]]]
_registered: dict[str, Reader] = {}


def register(suffix: str, reader: Reader) -> None:
    """For files of this suffix, in the jobs that are set up from now on; on a cluster the function must be importable on the executors."""
    _registered[suffix.lower()] = reader


def decoded(data: bytes) -> str:
    return data.decode("utf-8-sig", "replace").replace("\r\n", "\n").replace("\r", "\n")


_HEADING = re.compile(r"^(#{1,6})\s+(.*?)\s*#*$")


def read_markdown(data: bytes):
    levels: dict[int, str] = {}
    held: list[str] = []

    def flush():
        text, kind = "\n".join(held).strip(), "prose"
        if len(held) > 1 and row_line(held[0]) and separator_line(held[1]):
            kind = "table"
        held.clear()
        if text:
            yield kind, [levels[k] for k in sorted(levels)], text

    all_lines = decoded(data).split("\n")
    for i, line in enumerate(all_lines):
        heading = _HEADING.match(line)
        in_table = len(held) > 1 and row_line(held[0]) and separator_line(held[1])
        opens = row_line(line) and not separator_line(line) and i + 1 < len(all_lines) and separator_line(all_lines[i + 1])
        if heading or not line.strip() or (in_table and not row_line(line)) or (opens and held and not in_table):
            yield from flush()
        if heading:
            level = len(heading[1])
            for k in [k for k in levels if k >= level]:
                del levels[k]
            levels[level] = heading[2]
        elif line.strip():
            held.append(line)
    yield from flush()


def read_text(data: bytes):
    for part in re.split(r"\n\s*\n", decoded(data)):
        if part.strip():
            yield "prose", [], part.strip()


def pipe_table(rows: list[list[str]]) -> str:
    clean = [[c.replace("|", "\\|").replace("\n", " ").strip() for c in r] for r in rows]
    width = max(map(len, clean), default=0)
    line = lambda r: "| " + " | ".join([*r, *[""] * (width - len(r))]) + " |"
    return "\n".join([line(clean[0]), "|" + "---|" * width, *map(line, clean[1:])])


def csv_rows(text: str, delimiter: str) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(text), delimiter=delimiter) if any(c.strip() for c in r)]


def csv_delimiter(text: str) -> str:
    """Of comma, semicolon, tab and pipe the one by which most rows of the whole text have the same number of cells, two at least; a comma where none does."""

    def agreed(delimiter: str) -> int:
        widths = Counter(len(r) for r in csv_rows(text, delimiter) if len(r) > 1)
        return max(widths.values(), default=0)

    return max(",;\t|", key=agreed)


def read_csv(data: bytes):
    text = decoded(data)
    if rows := csv_rows(text, csv_delimiter(text)):
        yield "table", [], pipe_table(rows)


class Table:
    """A table that is open: its rows, whether the last one is open, the text of the open cell, and how many silent elements were open before it and before the cell."""

    def __init__(self, silent: int):
        self.rows, self.in_row, self.cell, self.silent, self.silent_in_cell = [], False, None, silent, silent


#: The spaces of Unicode; they are taken off both ends of a text.
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


class Outline(HTMLParser):
    """Collects (kind, headings, text) of a page. Tags that HTML lets a page omit are taken as given."""

    SILENT = {"script", "style", "nav", "head", "template", "noscript"}
    #: What a head can hold; any other tag, and text of its own, ends it.
    HEAD = {"html", "head", "title", "base", "basefont", "bgsound", "link", "meta", "noframes", "script", "style", "noscript", "template"}
    BLOCKS = {"p", "li", "div", "article", "section", "footer", "header", "main", "ul", "ol", "br", "blockquote", "pre", "body", "figcaption", "dd", "dt"}

    def __init__(self, blanks: str = r"\s+"):
        super().__init__(convert_charrefs=True)
        self.blanks = re.compile(blanks)
        self.found, self.levels, self.held, self.heading = [], {}, [], 0
        self.silent: list[str] = []  # the silent elements that are open; a head's title is one
        self.tables: list[Table] = []

    @property
    def cell(self):
        return self.tables[-1].cell if self.tables else None

    def flush(self):
        text = self.blanks.sub(" ", "".join(self.held)).strip(SPACES)
        self.held = []
        if text and self.heading:
            for k in [k for k in self.levels if k >= self.heading]:
                del self.levels[k]
            self.levels[self.heading] = text
        elif text:
            self.found.append(("prose", [self.levels[k] for k in sorted(self.levels)], text))

    def end_cell(self, row: bool = False):
        """Ends the open cell of the innermost table, if there is one, and the row too if asked for."""
        table = self.tables[-1]
        if table.cell is not None:
            table.rows[-1].append(self.blanks.sub(" ", "".join(table.cell)).strip(SPACES))
            table.cell = None
            del self.silent[table.silent_in_cell :]
        table.in_row &= not row

    def end_table(self):
        self.end_cell()
        table = self.tables.pop()
        del self.silent[table.silent :]
        rows = [r for r in table.rows if any(r)]
        if rows:
            self.found.append(("table", [self.levels[k] for k in sorted(self.levels)], pipe_table(rows)))

    def finish(self):
        while self.tables:
            self.end_table()
        self.flush()

    def handle_starttag(self, tag, attrs):
        if self.silent and self.silent[-1] == "template" and tag != "template":
            return  # its content is no part of the page
        if tag == "body" and "head" in self.silent:
            del self.silent[self.silent.index("head") :]
        elif self.silent and self.silent[-1] == "head" and tag not in self.HEAD:
            self.silent.pop()
        if tag in self.SILENT or (tag == "title" and self.silent and self.silent[-1] == "head"):
            self.silent.append(tag)
        elif tag == "table":
            self.flush()
            self.tables.append(Table(len(self.silent)))
        elif tag in ("tr", "thead", "tbody", "tfoot") and self.tables:
            self.end_cell(row=True)
            if tag == "tr":
                self.tables[-1].rows.append([])
                self.tables[-1].in_row = True
        elif tag in ("td", "th") and self.tables:
            self.end_cell()
            table = self.tables[-1]
            if not table.in_row:
                table.rows.append([])
            table.in_row, table.cell, table.silent_in_cell = True, [], len(self.silent)
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.heading = int(tag[1])
        elif tag == "img" and not self.silent:
            self.picture(dict(attrs))
        elif tag in self.BLOCKS and self.cell is None:
            self.flush()

    def picture(self, attrs):
        """A picture that the page holds itself; others aren't fetched."""
        m = re.match(r"data:image/[\w.+-]+(;base64)?,", attrs.get("src") or "")
        if m:
            body = attrs["src"][m.end() :]
            try:
                data = b64decode(body) if m[1] else unquote_to_bytes(body)
            except ValueError:
                return
            if not self.tables and not self.heading:
                self.flush()
            self.found.append(("picture", [self.levels[k] for k in sorted(self.levels)], Picture(data, (attrs.get("alt") or "").strip())))

    def handle_endtag(self, tag):
        if self.silent and self.silent[-1] == "template" and tag != "template":
            return
        if tag in self.SILENT or tag == "title":
            if tag in self.silent:
                at = len(self.silent) - 1 - self.silent[::-1].index(tag)
                while self.tables and self.tables[-1].silent > at:
                    self.end_table()
                del self.silent[at:]
        elif tag in ("td", "th") and self.tables:
            self.end_cell()
        elif tag in ("tr", "thead", "tbody", "tfoot") and self.tables:
            self.end_cell(row=True)
        elif tag == "table" and self.tables:
            self.end_table()
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.heading = 0
        elif tag in self.BLOCKS and self.cell is None:
            self.flush()

    def handle_data(self, data):
        if self.silent and self.silent[-1] == "head" and data.strip():
            self.silent.pop()
        if not self.silent:
            (self.held if self.cell is None else self.cell).append(data)


_REFERENCE = re.compile(r"&(?:(#[0-9]+;|#[xX][0-9a-fA-F]+;)|([A-Za-z][A-Za-z0-9]*;))?")


def closed_references(page: str) -> str:
    """The page with each ampersand escaped that begins no known character reference with a semicolon."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] or m[2] in html5 else "&amp;" + m[0][1:], page)


def read_html(data: bytes, closed: bool = False):
    """As HTML has it, some references count without their semicolon, ``&amp`` for one; if closed, only those with it do, so that a title that was cut within one stays as it is, and only HTML's own white space is squeezed within a text, not the other of Unicode."""
    page = Outline(r"[ \t\n\f\r]+") if closed else Outline()
    page.feed(closed_references(decoded(data)) if closed else decoded(data))
    page.close()
    page.finish()
    yield from page.found


def reader_for(suffix: str, registered: dict[str, Reader] | None = None) -> Reader:
    own = {".docx": read_docx, ".xlsx": read_xlsx, ".pptx": read_pptx, ".pdf": read_pdf, ".md": read_markdown, ".markdown": read_markdown, ".csv": read_csv, ".html": read_html, ".htm": read_html} | dict.fromkeys((".txt", ".rst", ".log"), read_text)
    found = (_registered if registered is None else registered).get(suffix) or own.get(suffix)
    if found is None:
        known = suffix in RICH_SUFFIXES + TEXT_SUFFIXES
        raise ValueError(f"no reader is registered for {suffix}" if known else f"unsupported document type: {suffix or 'none'}")
    return found


def read_items(rel_path: str, data: bytes | None, registered: dict[str, Reader] | None = None, pictures: PictureOptions | None = None) -> list[tuple]:
    """A file's items; a file that can't be read is one row with the error. registered are readers by suffix, those of this process if not given.

    A picture that is described is prose with the description and the caption; another gives no item.
    """
    try:
        m = re.search(r"[^/](\.[^./]+)$", rel_path)
        found = list(reader_for(m[1].lower() if m else "", registered)(data or b""))
        told = iter((pictures or PictureOptions()).texts([text for kind, _, text in found if kind == "picture"]))
        n: Counter[str] = Counter()
        rows: list[tuple] = []
        for kind, headings, text in found:
            ref = f"#/{kind}s/{n[kind]}"
            n[kind] += 1
            if kind == "picture" and not (text := next(told)):
                continue
            rows.append((rel_path, len(rows), 0, "table" if kind == "table" else "prose", ref, headings, text, None, None))
        return rows
    except Exception as error:  # noqa: BLE001  one bad document doesn't fail the job
        return [(rel_path, None, None, None, None, None, None, None, f"{type(error).__name__}: {error}")]


def read_documents(files: DataFrame, pictures: PictureOptions | None = None, readers: dict[str, Reader] | None = None) -> DataFrame:
    """The items of files (rel_path, content), a task per group of files. The readers that are registered by now go along to the workers, after those by suffix that are given; without options pictures are left out."""
    registered = _registered | (readers or {})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in ITEMS.split(", ")]
        for batch in batches:
            rows = [r for p, c in zip(batch["rel_path"], batch["content"], strict=True) for r in read_items(p, c, registered, pictures)]
            yield pd.DataFrame(rows, columns=names).astype({"raw": "Int32", "ord": "Int32"})

    return files.select("rel_path", "content").mapInPandas(read, ITEMS)
