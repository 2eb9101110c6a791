"""Readers and writers of files that are made here."""

import io
import json
import zipfile
import zlib

import pytest

from graphloom.sources import files

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math"'


def packed(**parts) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


def docx(body: str, **parts) -> bytes:
    return packed(word__document_dot_xml=f"<w:document {W}><w:body>{body}</w:body></w:document>", **parts)


def par(text: str, props: str = "", run: str = "") -> str:
    return f"<w:p><w:pPr>{props}</w:pPr><w:r><w:rPr>{run}</w:rPr><w:t>{text}</w:t></w:r></w:p>"


def test_lists_headings_and_formulas_of_documents():
    levels = "".join(f'<w:lvl w:ilvl="{i}"><w:start w:val="1"/><w:numFmt w:val="{k}"/><w:lvlText w:val="{t}"/></w:lvl>' for i, (k, t) in enumerate((("decimal", "%1."), ("lowerLetter", "%1.%2)"))))
    numbering = f'<w:numbering {W}><w:abstractNum w:abstractNumId="0">{levels}</w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="0"/></w:num></w:numbering>'
    styles = f'<w:styles {W}><w:style w:styleId="Titre2"><w:name w:val="heading 2"/></w:style></w:styles>'
    item = lambda t, level: par(t, f'<w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="5"/></w:numPr>')
    math = "<w:p><m:oMath><m:f><m:num><m:r><m:t>a</m:t></m:r></m:num><m:den><m:sSup><m:e><m:r><m:t>b</m:t></m:r></m:e><m:sup><m:r><m:t>2</m:t></m:r></m:sup></m:sSup></m:den></m:f></m:oMath></w:p>"
    body = par("Part", '<w:pStyle w:val="Titre2"/>') + item("one", 0) + item("under", 1) + item("under two", 1) + item("two", 0) + item("again", 1) + math
    got = files.docx_text(docx(body, word__numbering_dot_xml=numbering, word__styles_dot_xml=styles)).split("\n\n")
    assert got == ["## Part", "1. one", "  1.a) under", "  1.b) under two", "2. two", "  2.a) again", "$\\frac{a}{b^{2}}$"]
    plain = docx(par("1 Start", run="<w:b/>") + par("Text that is bold but long enough to go on. " * 4, run="<w:b/>") + par("1.1 Part", run="<w:b/>") + par("2 not bold"))
    assert [x[:9] for x in files.docx_text(plain).split("\n\n")] == ["# 1 Start", "Text that", "## 1.1 Pa", "2 not bol"]


def test_numbers_and_dates_of_sheets():
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    book = packed(
        xl__workbook_dot_xml=f'<workbook {s}><sheets><sheet name="Second" sheetId="1" r:id="b"/><sheet name="First" sheetId="2" r:id="a"/></sheets></workbook>',
        xl___rels__workbook_dot_xml_dot_rels='<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="worksheets/sheet2.xml"/></Relationships>',
        xl__sharedStrings_dot_xml=f"<sst {s}><si><t>reef</t></si><si><r><t>ti</t></r><r><t>de</t></r></si></sst>",
        xl__styles_dot_xml=f'<styleSheet {s}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        xl__worksheets__sheet1_dot_xml=f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>4.5</v></c></row><row><c r="A2" s="1"><v>45292</v></c><c r="B2" t="b"><v>1</v></c></row></sheetData></worksheet>',
        xl__worksheets__sheet2_dot_xml=f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>1</v></c></row></sheetData></worksheet>',
    )
    assert files.extract("a.xlsx", book) == "## Second\n\ntide\n\n## First\n\nreef |  | 4.5\n2024-01-01 | TRUE"
    mine = files.xlsx_bytes(["name", "n"], [("a & b", 1), (None, 2.5)])
    assert files.extract("x.xlsx", mine) == "## Sheet1\n\nname | n\na & b | 1\n | 2.5"


def test_slides_in_order():
    slide = lambda t: f'<s xmlns:a="x"><a:p><a:r><a:t>{t}</a:t></a:r></a:p></s>'
    assert files.extract("a.pptx", packed(ppt__slides__slide10_dot_xml=slide("ten"), ppt__slides__slide2_dot_xml=slide("two"))) == "two\n\nten"


def test_plain_pdfs():
    page = b"BT /F1 12 Tf 72 700 Td (The \\(wet\\) reef) Tj 0 -14 Td [(gro) -20 (ws) -300 (here)] TJ T* <48692E> Tj ET"
    stream = lambda body, head: b"4 0 obj << /Length 9 " + head + b">>\nstream\n" + body + b"\nendstream endobj\n"
    for data in (stream(page, b""), stream(zlib.compress(page), b"/Filter /FlateDecode ")):
        assert files.extract("a.pdf", b"%PDF-1.4\n" + data) == "The (wet) reef\ngrows here\nHi."
    coded = stream(b"1 beginbfrange <0001> <0003> <0061> endbfrange", b"") + stream(b"BT <000300010002> Tj ET", b"")
    assert files.extract("a.pdf", b"%PDF-1.4\n" + coded) == "cab"
    for bad in (b"no", b"%PDF-1.4", b"%PDF-1.4 << /Encrypt 5 0 R >>"):
        with pytest.raises(ValueError):
            files.extract("a.pdf", bad)


def test_text_packs_links_and_tables(spark, tmp_path):
    text = "# Top\n\nSee [the reef][r] and ![map][m].\n\n| a | b\\|c |\n|---|:-:|\n| 1 | 2 |\n\n[r]: http://x.y/z\n[m]: <assets/m.png> 'Map'\n"
    pack = packed(**{"a.textbundle__text_dot_md": text, "a.textbundle__assets__m_dot_png": "png"})
    (tmp_path / "a.textpack").write_bytes(pack)
    got = files.read_texts(spark, str(tmp_path)).first()
    assert "[the reef](http://x.y/z) and ![map](assets/m.png)" in got.text and "[r]:" not in got.text and got.error is None
    assert [(r.name, bytes(r.content)) for r in files.assets(spark, str(tmp_path)).collect()] == [("a.textbundle/assets/m.png", b"png")]
    assert [(t["heading"], t["header"], t["rows"]) for t in files.markdown_tables(got.text)] == [("Top", ["a", "b|c"], [["1", "2"]])]
    d = spark.createDataFrame([("d", got.text + "\n$$x = 1$$"), ("e", None)], "id string, text string")
    parts = {k: v.collect() for k, v in files.sidecar(d, "id", "text").items()}
    assert [len(parts[k]) for k in ("blocks", "tables", "drawings", "equations")] == [1, 1, 1, 1] and parts["drawings"][0]["path"] == "assets/m.png" and parts["tables"][0].dimension == [1, 2]
    assert json.loads(parts["tables"][0].table_header) == ["a", "b|c"] and parts["equations"][0].content == "x = 1"
    files.write_sidecar(files.sidecar(d, "id", "text"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "tables")).count() == 1


def test_engines_by_rules(spark):
    d = spark.createDataFrame([("a.pdf",), ("b.[native].md",), ("c.docx",), ("d.png",), ("e.zip",)], "p string")
    one = lambda *a: [r[0] for r in d.select(files.engine(d.p, *a)).collect()]
    assert one() == ["legacy", "native", "native", None, None]
    assert one("pdf:mineru;*:docling", ("native", "legacy", "mineru", "docling")) == ["mineru", "native", "docling", "docling", None]
    assert one("pdf:mineru") == ["legacy", "native", "native", None, None]
    with pytest.raises(ValueError):
        files.rules_of("pdf:other")


def test_tables_are_written_and_read_again(spark, tmp_path):
    rows = [["a<b", "x|y"], ["", "é"]]
    for kind in ("html", "json"):
        assert files.table_rows(files.to_markup(rows, kind, header=True)) == rows
    assert files.has_header(files.to_markup(rows, header=True)) and files.to_markup([], "md") == "" and files.to_markup(rows, "md").count("\n") == 2
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    files.export(df.coalesce(1), str(tmp_path / "x"), "xlsx")
    book = next((tmp_path / "x").glob("*.xlsx")).read_bytes()
    assert files.xlsx_text(book) == "## Sheet1\n\nk | n\na | 1\n | 2"
