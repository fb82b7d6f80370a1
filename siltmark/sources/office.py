"""Word, Excel and PowerPoint files: what of them is text, by the packages' XML parts.

Each reader yields items (kind, headings, text) in the order of the document; pictures are Picture values in place of a text.
Nothing is fetched, macros and embedded objects are passed over.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from typing import NamedTuple
from xml.etree import ElementTree

#: Bytes that one part of a package may have when unpacked, so that a small file can't fill a worker.
MOST = 1 << 29


class Picture(NamedTuple):
    """An image's bytes, its caption, and the share of its page that it covers (None: unknown)."""

    data: bytes
    caption: str = ""
    area: float | None = None


class Package:
    """The parts of a zipped document and the relations between them."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        self.names = {n.lower(): n for n in self.zip.namelist()}

    def part(self, name: str) -> bytes:
        info = self.zip.getinfo(self.names[name.lower()])
        if info.file_size > MOST:
            raise ValueError(f"{name} is larger than {MOST} bytes")
        return self.zip.read(info)

    def xml(self, name: str) -> ElementTree.Element:
        data = self.part(name)
        if b"<!DOCTYPE" in data[:4096] or b"<!ENTITY" in data:
            raise ValueError("a document type in a package's part")
        return ElementTree.fromstring(data)

    def relations(self, name: str) -> dict[str, tuple[str, str]]:
        """id -> (last word of the type, part) of a part's relations within the package."""
        folder, base = posixpath.split(name)
        at = f"{folder}/_rels/{base}.rels".lstrip("/")
        if at.lower() not in self.names:
            return {}
        found = {}
        for r in self.xml(at):
            if r.get("TargetMode") != "External":
                target = r.get("Target", "")
                found[r.get("Id")] = (r.get("Type", "").rpartition("/")[2], target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target)))
        return found

    def start(self) -> str:
        return next(part for kind, part in self.relations("").values() if kind == "officeDocument")

    def image(self, relations: dict, id_: str | None) -> bytes | None:
        kind, part = relations.get(id_, ("", ""))
        return self.part(part) if kind == "image" and part.lower() in self.names else None


def local(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def value(element: ElementTree.Element | None, name: str) -> str | None:
    """An attribute by its name without a namespace."""
    return next((v for k, v in element.attrib.items() if k.rpartition("}")[2] == name), None) if element is not None else None


def child(element: ElementTree.Element | None, *path: str) -> ElementTree.Element | None:
    for name in path:
        element = next((e for e in element if local(e) == name), None) if element is not None else None
    return element


def children(element: ElementTree.Element | None) -> list[ElementTree.Element]:
    return [] if element is None else list(element)


def pipe(rows: list[list[str]]) -> str:
    from siltmark.sources.readers import pipe_table

    return pipe_table(rows)


class Outline:
    """The headings that are open, by level."""

    def __init__(self):
        self.levels: dict[int, str] = {}

    def open(self, level: int, text: str) -> None:
        self.levels = {k: v for k, v in self.levels.items() if k < level} | {level: text}

    def now(self) -> list[str]:
        return [self.levels[k] for k in sorted(self.levels)]


# --- Word ---------------------------------------------------------------------------------------------------


def word_text(paragraph: ElementTree.Element) -> str:
    """Its runs, with tabs and breaks; deleted text and field codes don't count."""
    out: list[str] = []

    def walk(e):
        for x in e:
            name = local(x)
            if name == "t":
                out.append(x.text or "")
            elif name in ("tab", "ptab"):
                out.append("\t")
            elif name in ("br", "cr"):
                out.append("\n")
            elif name == "noBreakHyphen":
                out.append("-")
            elif name not in ("del", "moveFrom", "instrText", "pPr", "rPr", "txbxContent", "Fallback", "tbl"):
                walk(x)

    walk(paragraph)
    return "".join(out).strip()


def word_levels(package: Package, start: str) -> dict[str, int]:
    """Style -> heading level, from 1: by the outline level that the style or one that it is based on has, else by its name."""
    part = next((p for k, p in package.relations(start).values() if k == "styles"), None)
    own: dict[str, int | None] = {}
    based: dict[str, str | None] = {}
    for s in package.xml(part) if part else ():
        if local(s) == "style" and value(s, "type") == "paragraph":
            id_, name = value(s, "styleId"), (value(child(s, "name"), "val") or "").lower()
            level = value(child(s, "pPr", "outlineLvl"), "val")
            named = re.fullmatch(r"heading ([1-9])", name)
            own[id_] = int(level) + 1 if level and int(level) < 9 else int(named[1]) if named else 1 if name == "title" else None
            based[id_] = value(child(s, "basedOn"), "val")
    found = {}
    for id_ in own:
        at, seen = id_, set()
        while at in own and at not in seen:
            seen.add(at)
            if own[at]:
                found[id_] = own[at]
                break
            at = based[at]
    return found


def read_docx(data: bytes) -> Iterator[tuple]:
    package = Package(data)
    start = package.start()
    body, relations, levels, outline = child(package.xml(start), "body"), package.relations(start), word_levels(package, start), Outline()
    size = next((e for e in body.iter() if local(e) == "pgSz"), None)
    page = float(value(size, "w") or 0) * 635 * float(value(size, "h") or 0) * 635 if size is not None else 0.0  # a twentieth of a point is 635 of the unit of pictures

    def style_of(p) -> str:
        return value(child(p, "pPr", "pStyle"), "val") or ""

    def blocks(parent) -> Iterator[ElementTree.Element]:
        for e in parent:
            if local(e) in ("p", "tbl"):
                yield e
            elif local(e) in ("sdt", "sdtContent", "customXml", "ins", "smartTag"):
                yield from blocks(e)

    def pictures(p) -> Iterator[tuple[bytes, float | None]]:
        for drawing in (e for e in p.iter() if local(e) in ("drawing", "pict")):
            blip = next((e for e in drawing.iter() if local(e) in ("blip", "imagedata")), None)
            image = package.image(relations, value(blip, "embed") or value(blip, "id"))
            extent = next((e for e in drawing.iter() if local(e) == "extent"), None)
            if image:
                yield image, int(extent.get("cx", 0)) * int(extent.get("cy", 0)) / page if extent is not None and page else None

    def cells(row) -> Iterator[str]:
        for e in row:
            if local(e) == "tc":
                span = int(value(child(e, "tcPr", "gridSpan"), "val") or 1)
                yield " ".join(t for p in e.iter() if local(p) == "p" and (t := word_text(p)))
                yield from [""] * (span - 1)
            elif local(e) in ("sdt", "sdtContent"):
                yield from cells(e)

    every = list(blocks(body))
    for i, e in enumerate(every):
        if local(e) == "tbl":
            rows = [r for x in e if local(x) == "tr" and any(r := list(cells(x)))]
            if rows:
                yield "table", outline.now(), pipe(rows)
            continue
        text, level = word_text(e), value(child(e, "pPr", "outlineLvl"), "val")
        level = int(level) + 1 if level and int(level) < 9 else levels.get(style_of(e), 0)
        after = every[i + 1] if i + 1 < len(every) else None
        caption = word_text(after) if after is not None and local(after) == "p" and style_of(after).lower() == "caption" else ""
        for image, area in pictures(e):
            yield "picture", outline.now(), Picture(image, caption, area)
        if text and level:
            outline.open(level, text)
        elif text:
            yield "prose", outline.now(), text


# --- Excel --------------------------------------------------------------------------------------------------


def column_of(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def islands(cells: dict[tuple[int, int], str]) -> Iterator[list[list[str]]]:
    """The cells by blocks of rows between empty rows; each without its empty columns."""
    rows: dict[int, dict[int, str]] = {}
    for (r, c), text in sorted(cells.items()):
        rows.setdefault(r, {})[c] = text
    block: list[dict[int, str]] = []
    last = None
    for r in [*rows, None]:
        if block and (r is None or r != last + 1):
            used = sorted({c for row in block for c in row})
            yield [[row.get(c, "") for c in used] for row in block]
            block = []
        if r is not None:
            block.append(rows[r])
            last = r


def read_xlsx(data: bytes) -> Iterator[tuple]:
    """Each block of rows of each visible sheet is a table under the sheet's name. Numbers are as they are stored."""
    package = Package(data)
    start = package.start()
    relations = package.relations(start)
    strings: list[str] = []
    if part := next((p for k, p in relations.values() if k == "sharedStrings"), None):
        strings = ["".join(t.text or "" for t in s.iter() if local(t) == "t") for s in package.xml(part) if local(s) == "si"]
    for sheet in children(child(package.xml(start), "sheets")):
        kind, part = relations.get(value(sheet, "id"), ("", ""))
        if kind != "worksheet" or sheet.get("state") in ("hidden", "veryHidden"):
            continue
        cells: dict[tuple[int, int], str] = {}
        r = -1
        for row in children(child(package.xml(part), "sheetData")):
            r = int(row.get("r")) - 1 if row.get("r") else r + 1
            c = -1
            for cell in row:
                c = column_of(cell.get("r")) if cell.get("r") else c + 1
                v = child(cell, "v")
                text = (v.text if v is not None else None) or ""
                if cell.get("t") == "s" and text:
                    text = strings[int(text)]
                elif cell.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter() if local(t) == "t")
                elif cell.get("t") == "b" and text:
                    text = "TRUE" if text == "1" else "FALSE"
                if text.strip():
                    cells[r, c] = text.strip()
        for rows in islands(cells):
            yield "table", [sheet.get("name", "")], pipe(rows)


# --- PowerPoint ---------------------------------------------------------------------------------------------


def read_pptx(data: bytes) -> Iterator[tuple]:
    """Slide by slide in their order: its title is the heading, then its texts, tables and pictures."""
    package = Package(data)
    start = package.start()
    relations, root = package.relations(start), package.xml(start)
    size = child(root, "sldSz")
    page = int(size.get("cx", 0)) * int(size.get("cy", 0)) if size is not None else 0
    lines = lambda body: "\n".join(t for p in body.iter() if local(p) == "p" and (t := "".join("\n" if local(x) == "br" else x.text or "" for x in p.iter() if local(x) in ("t", "br")).strip()))

    def shapes(tree):
        for e in tree:
            if local(e) == "grpSp":
                yield from shapes(e)
            elif local(e) in ("sp", "graphicFrame", "pic"):
                yield e

    for slide in children(child(root, "sldIdLst")):
        kind, part = relations.get(next((v for k, v in slide.attrib.items() if k.endswith("}id")), None), ("", ""))
        if kind != "slide":
            continue
        content = package.xml(part)
        if content.get("show") == "0":
            continue
        own, found, title = package.relations(part), [], ""
        for e in shapes(children(child(content, "cSld", "spTree"))):
            if local(e) == "sp" and (body := child(e, "txBody")) is not None and (text := lines(body)):
                holder = next((x for x in e.iter() if local(x) == "ph"), None)
                if not title and value(holder, "type") in ("title", "ctrTitle"):
                    title = " ".join(text.split("\n"))
                elif value(holder, "type") not in ("dt", "ftr", "sldNum"):
                    found.append(("prose", text))
            elif local(e) == "graphicFrame" and (table := next((x for x in e.iter() if local(x) == "tbl"), None)) is not None:
                rows = [r for x in table if local(x) == "tr" and any(r := [" ".join(lines(c).split("\n")) for c in x if local(c) == "tc"])]
                if rows:
                    found.append(("table", pipe(rows)))
            elif local(e) == "pic":
                image = package.image(own, value(next((x for x in e.iter() if local(x) == "blip"), None), "embed"))
                extent = next((x for x in e.iter() if local(x) == "ext" and x.get("cx")), None)
                area = int(extent.get("cx")) * int(extent.get("cy", 0)) / page if extent is not None and page else None
                if image:
                    found.append(("picture", Picture(image, "", area)))
        for kind, text in found:
            yield kind, [title] if title else [], text
        if title and not found:
            yield "prose", [], title
