"""Word, Excel, PowerPoint and PDF files made here, pictures, and delimiters."""

import base64
import io
import json
import threading
import zipfile
import zlib
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from siltmark.sources import office, pdf, readers
from siltmark.sources.office import Picture
from siltmark.sources.pictures import HttpDescriber, PictureOptions, answer_text, picture_text

OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def package(parts, start, relations=()):
    """A zipped document: parts by name, and relations (part, id, type, target)."""
    rels = {}
    for part, id_, kind, target in [("", "r0", "officeDocument", start), *relations]:
        rels.setdefault(part, []).append(f'<Relationship Id="{id_}" Type="{OFFICE}/{kind}" Target="{target}"/>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in parts.items():
            z.writestr(name, data)
        for part, found in rels.items():
            folder, _, base = part.rpartition("/")
            z.writestr(f"{folder}/_rels/{base}.rels".lstrip("/"), "<Relationships>" + "".join(found) + "</Relationships>")
    return out.getvalue()


def word(body, styles="", relations=(), parts=None):
    document = f'<w:document xmlns:w="w" xmlns:r="r" xmlns:a="a" xmlns:wp="wp"><w:body>{body}<w:sectPr><w:pgSz w:w="10000" w:h="10000"/></w:sectPr></w:body></w:document>'
    files = {"word/document.xml": document, "word/styles.xml": f'<w:styles xmlns:w="w">{styles}</w:styles>'} | (parts or {})
    return package(files, "word/document.xml", [("word/document.xml", "rs", "styles", "styles.xml"), *relations])


def p(text, style=""):
    return f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'


def test_docx():
    cell = lambda *x, span="": f"<w:tc><w:tcPr>{span}</w:tcPr>{''.join(map(p, x))}</w:tc>"
    table = f"<w:tbl><w:tr>{cell('a')}{cell('b|c')}</w:tr><w:tr>{cell('1', '2', span='<w:gridSpan w:val=' + chr(34) + '2' + chr(34) + '/>')}</w:tr></w:tbl>"
    drawing = '<w:p><w:r><w:drawing><wp:inline><wp:extent cx="635000" cy="635000"/><a:blip r:embed="ri"/></wp:inline></w:drawing></w:r></w:p>'
    styles = '<w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/></w:style><w:style w:type="paragraph" w:styleId="My"><w:name w:val="mine"/><w:basedOn w:val="H1"/></w:style><w:style w:type="paragraph" w:styleId="H2"><w:name w:val="x"/><w:pPr><w:outlineLvl w:val="1"/></w:pPr></w:style>'
    mixed = "<w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t></w:r><w:del><w:r><w:t>gone</w:t></w:r></w:del><w:ins><w:r><w:t> new</w:t></w:r></w:ins></w:p>"
    data = word(p("intro") + p("Top", "H1") + mixed + p("Sub", "H2") + table + drawing + p("A cat", "Caption") + p("Next", "My") + p("end"), styles, [("word/document.xml", "ri", "image", "media/i.png")], {"word/media/i.png": b"PNG"})
    assert list(readers.read_docx(data)) == [
        ("prose", [], "intro"), ("prose", ["Top"], "one\ttwo new"), ("table", ["Top", "Sub"], "| a | b\\|c |\n|---|---|\n| 1 2 |  |"),
        ("picture", ["Top", "Sub"], Picture(b"PNG", "A cat", 0.01)), ("prose", ["Top", "Sub"], "A cat"), ("prose", ["Next"], "end"),
    ]
    assert list(readers.read_docx(word(""))) == []
    for bad in (b"", b"PK", word("")[:-30], package({"x": "<!DOCTYPE a [<!ENTITY b 'c'>]><a/>"}, "x")):
        assert readers.read_items("a.docx", bad)[0][-1]


def test_xlsx():
    sheet = '<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>in</t><t>line</t></is></c></row><row r="2"><c r="A2"><v>1.50</v></c><c r="C2" t="b"><v>1</v></c></row><row r="3"/><row r="5"><c r="B5" t="str"><v>alone</v></c></row></sheetData></worksheet>'
    book = '<workbook xmlns:r="r"><sheets><sheet name="S1" r:id="a"/><sheet name="S2" r:id="b" state="hidden"/><sheet name="S3" r:id="c"/></sheets></workbook>'
    strings = "<sst><si><r><t>he</t></r><r><t>llo</t></r></si></sst>"
    relations = [("xl/workbook.xml", i, "worksheet", f"sheets/{i}.xml") for i in "abc"] + [("xl/workbook.xml", "s", "sharedStrings", "/xl/strings.xml")]
    data = package({"xl/workbook.xml": book, "xl/strings.xml": strings, "xl/sheets/a.xml": sheet, "xl/sheets/b.xml": sheet, "xl/sheets/c.xml": "<worksheet><sheetData/></worksheet>"}, "xl/workbook.xml", relations)
    assert list(readers.read_xlsx(data)) == [("table", ["S1"], "| hello | inline |\n|---|---|\n| 1.50 | TRUE |"), ("table", ["S1"], "| alone |\n|---|")]
    assert office.column_of("AB12") == 27 and "no reader" in readers.read_items("x.xls", b"")[0][-1]


def test_pptx():
    shape = lambda text, kind="": f'<p:sp><p:nvSpPr><p:nvPr>{f"<p:ph type={chr(34)}{kind}{chr(34)}/>" if kind else ""}</p:nvPr></p:nvSpPr><p:txBody>' + "".join(f"<a:p><a:r><a:t>{t}</a:t></a:r></a:p>" for t in text.split("\n")) + "</p:txBody></p:sp>"
    table = "<p:graphicFrame><a:tbl><a:tr>" + "".join(f"<a:tc><a:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></a:txBody></a:tc>" for t in "xy") + "</a:tr></a:tbl></p:graphicFrame>"
    picture = '<p:pic><p:blipFill><a:blip r:embed="i"/></p:blipFill><p:spPr><a:xfrm><a:ext cx="50" cy="50"/></a:xfrm></p:spPr></p:pic>'
    slide = lambda content: f'<p:sld xmlns:p="p" xmlns:a="a" xmlns:r="r"><p:cSld><p:spTree>{content}</p:spTree></p:cSld></p:sld>'
    deck = '<p:presentation xmlns:p="p" xmlns:r="r"><p:sldSz cx="100" cy="100"/><p:sldIdLst><p:sldId id="2" r:id="b"/><p:sldId id="1" r:id="a"/></p:sldIdLst></p:presentation>'
    parts = {"ppt/p.xml": deck, "ppt/slides/a.xml": slide(shape("Only title", "title")), "ppt/slides/b.xml": slide(shape("T\nitle", "ctrTitle") + f"<p:grpSp>{shape('one' + chr(10) + 'two')}</p:grpSp>" + shape("7", "sldNum") + table + picture), "ppt/media/i.png": b"IMG"}
    data = package(parts, "ppt/p.xml", [("ppt/p.xml", "a", "slide", "slides/a.xml"), ("ppt/p.xml", "b", "slide", "slides/b.xml"), ("ppt/slides/b.xml", "i", "image", "../media/i.png")])
    assert list(readers.read_pptx(data)) == [("prose", ["T itle"], "one\ntwo"), ("table", ["T itle"], "| x | y |\n|---|---|"), ("picture", ["T itle"], Picture(b"IMG", "", 0.25)), ("prose", [], "Only title")]


def pdf_file(content, fonts="/F1 5 0 R", more=(), packed=False, extra=b"", trailer=b"/Root 1 0 R"):
    """A page with this content; more are further objects by number."""
    body = zlib.compress(content) if packed else content
    objects = {1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Type/Pages/Kids[3 0 R]/Count 1/Resources<</Font<<" + fonts.encode() + b">>/XObject<</I1 8 0 R/X1 9 0 R>>>>/MediaBox[0 0 200 100]>>", 3: b"<</Type/Page/Parent 2 0 R/Contents 4 0 R>>", 4: b"<</Length %d%s>>stream\n%s\nendstream" % (len(body), b"/Filter/FlateDecode" if packed else b"", body), 5: b"<</Type/Font/Subtype/Type1/Encoding/WinAnsiEncoding>>"} | dict(more)
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in objects.items()) + extra + b"trailer<<" + trailer + b">>\n%%EOF"


def test_pdf():
    text = b"BT /F1 20 Tf 10 90 Td (Big title) Tj ET BT /F1 10 Tf 12 TL 10 70 Td (First \\(line\\) of) Tj T* [(te) -50 (xt,) -400 (caf\\351 and hy-)] TJ T* (phenated) Tj 0 -30 Td (Another) Tj ET"
    want = [("prose", ["Big title"], "First (line) of text, café and hyphenated"), ("prose", ["Big title"], "Another")]
    for packed in (False, True):
        assert list(pdf.read_pdf(pdf_file(text, packed=packed))) == want
    cmap = b"begincmap 1 begincodespacerange <0000> <ffff> endcodespacerange 1 beginbfchar <0001> <04160438> endbfchar 2 beginbfrange <0002> <0004> <0061> <0005> <0006> [<0058> <0059>] endbfrange endcmap"
    wide = {6: b"<</Type/Font/Subtype/Type0/Encoding/Identity-H/ToUnicode 7 0 R>>", 7: b"<</Length %d>>stream\n%s\nendstream" % (len(cmap), cmap)}
    assert list(pdf.read_pdf(pdf_file(b"BT /F2 9 Tf <00010002000300040005 0006> Tj ET", "/F2 6 0 R", wide))) == [("prose", [], "ЖиabcXY")]
    named = {6: b"<</Subtype/Type1/Encoding<</Differences[65/eacute/one/uni0416/fi]>>>>"}
    assert list(pdf.read_pdf(pdf_file(b"BT /F2 9 Tf (ABCD) Tj ET", "/F2 6 0 R", named))) == [("prose", [], "é1Жﬁ")]
    drawn = {8: b"<</Subtype/Image/Filter/DCTDecode/Length 4>>stream\n\xff\xd8\xff\xd9\nendstream", 9: b"<</Subtype/Form/Matrix[1 0 0 1 0 0]/Length 31>>stream\nBT /F1 9 Tf (within form) Tj ET \nendstream"}
    found = list(pdf.read_pdf(pdf_file(b"q 100 0 0 50 0 0 cm /I1 Do Q /X1 Do", more=drawn)))
    assert found == [("picture", [], Picture(b"\xff\xd8\xff\xd9", "", 0.25)), ("prose", [], "within form")]
    catalog = b"<</Type/Catalog/Pages 2 0 R>>  "
    inner = b"1 0 3 %d " % len(catalog) + catalog + b"<</Type/Page/Parent 2 0 R/Contents 4 0 R>>"
    first = inner.index(b"<<")
    held = {1: b"null", 3: b"null", 20: b"<</Type/ObjStm/N 2/First %d/Length %d>>stream\n%s\nendstream" % (first, len(inner), inner)}
    assert list(pdf.read_pdf(pdf_file(text, more=held)))[0][2].startswith("First")
    for bad in (b"", b"%PDF-1.4", pdf_file(text, trailer=b"/Root 1 0 R/Encrypt<</V 1>>"), b"%PDF-1.4 1 0 obj " + b"[" * 5000):
        rows = readers.read_items("a.pdf", bad)
        assert not rows or rows[0][-1]
    assert "encrypted" in readers.read_items("a.pdf", pdf_file(text, trailer=b"/Root 1 0 R/Encrypt<</V 1>>"))[0][-1]


def test_pictures_are_described():
    url = "data:image/png;base64," + base64.b64encode(b"\x89PNG123").decode()
    page = f'<h1>H</h1>before<img src="{url}" alt=" A dog ">after<img src="http://e/x.png"><nav><img src="{url}"></nav>'.encode()
    described = readers.read_items("a.html", page, pictures=PictureOptions(lambda data: f" {len(data)} bytes "))
    assert [(r[3], r[4], r[5], r[6]) for r in described] == [("prose", "#/proses/0", ["H"], "before"), ("prose", "#/pictures/0", ["H"], "[Изображение]\nОписание: 7 bytes\nПодпись: A dog"), ("prose", "#/proses/1", ["H"], "after")]
    assert [r[1] for r in described] == [0, 1, 2] and [r[6] for r in readers.read_items("a.html", page)] == ["before", "after"]

    def fails(data):
        if data == b"bad":
            raise OSError
        return data.decode()

    options = PictureOptions(fails, 0.1, 3)
    assert options.texts([Picture(b"one", "c", 0.5), Picture(b"small", "", 0.05), Picture(b"bad"), Picture(b"  "), Picture(b"two")]) == [picture_text("one", "c"), "", "", "", picture_text("two")]
    assert PictureOptions().texts([Picture(b"one")]) == [""]
    assert [answer_text(x) for x in ({"choices": [{"message": {"content": "x"}}]}, {"choices": []}, [], None, {"choices": [{"message": {"content": None}}]})] == ["x", "", "", "", ""]


def test_description_requests():
    asked = []

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            asked.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": "a form"}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        assert HttpDescriber(f"http://127.0.0.1:{server.server_port}/", "m", "what?", 10)(b"\x89PNGx") == "a form"
    finally:
        server.shutdown()
        server.server_close()
    path, body = asked[0]
    image, words = body["messages"][0]["content"]
    assert path == "/v1/chat/completions" and body["model"] == "m" and body["max_completion_tokens"] == 400 and words["text"] == "what?"
    assert image["image_url"]["url"] == "data:image/png;base64," + base64.b64encode(b"\x89PNGx").decode()


@pytest.mark.parametrize(("text", "delimiter"), [("a,b\n1,2", ","), ("a;b\n1;2,5\n3;4,5", ";"), ("a\tb, c\n1\t2", "\t"), ("a|b\n1|2", "|"), ("one", ","), ("", ","), ("note\n" + "x" * 9000 + "\n" + "1;2;3\n" * 500, ";")])
def test_csv_delimiters(text, delimiter):
    assert readers.csv_delimiter(text) == delimiter
