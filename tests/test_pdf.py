"""PDF files made by hand: plain and compressed objects, simple and composite fonts, tolerances."""

import zlib

import pytest

from lexloom.config import DEFAULT
from lexloom.plans import pipeline
from lexloom.sources import files, pdf

LETTERS = "абвгҕдежзийклмнопрсть тыуүхца"


def stream(data, extra=b"", squeeze=True):
    if squeeze:
        data, extra = zlib.compress(data), extra + b" /Filter /FlateDecode"
    return b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(data), extra, data)


def make_pdf(contents, squeeze=True, packed=False):
    """Pages with two fonts: F1, simple and Western, and F2, composite with LETTERS as codes from 1 on."""
    chars = b"".join(b"<%04X> <%04X>\n" % (n, ord(c)) for n, c in enumerate(LETTERS, 1))
    mapping = b"/CIDInit /ProcSet findresource begin 1 begincodespacerange <0000> <FFFF> endcodespacerange %d beginbfchar\n%sendbfchar end" % (len(LETTERS), chars)
    first = 9
    plain = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>",
        2: b"<< /Type /Pages /Count %d /Kids [%s] /Resources << /Font << /F1 3 0 R /F2 4 0 R >> /XObject << /X 8 0 R >> >> /MediaBox [0 0 600 800] >>" % (len(contents), b" ".join(b"%d 0 R" % (first + 2 * n) for n in range(len(contents)))),
        3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Some /FirstChar 32 /Widths [" + b"500 " * 95 + b"] /Encoding << /Differences [ 1 /afii10065 /uni0495 /one 65 /A ] >> >>",
        4: b"<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /DescendantFonts [5 0 R] /ToUnicode 7 0 R >>",
        5: b"<< /Type /Font /Subtype /CIDFontType2 /DW 500 /W [1 [500 500] 3 10 500] >>",
    } | {first + 2 * n: b"<< /Type /Page /Parent 2 0 R /Contents [%d 0 R] >>" % (first + 2 * n + 1) for n in range(len(contents))}
    streams = {7: stream(mapping, squeeze=squeeze), 8: stream(b"BT /F1 10 Tf 1 0 0 1 0 0 Tm (form) Tj ET", b" /Subtype /Form /Matrix [1 0 0 1 50 20]", squeeze)}
    streams |= {first + 2 * n + 1: stream(c, squeeze=squeeze) for n, c in enumerate(contents)}
    if packed:
        bodies, index, at = b"", b"", 0
        for number, body in plain.items():
            index += b"%d %d " % (number, at)
            bodies += body + b" "
            at = len(bodies)
        streams[100] = stream(index + bodies, b" /Type /ObjStm /N %d /First %d" % (len(plain), len(index)))
        plain = {}
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, body) for n, body in (plain | streams).items()) + b"trailer << /Root 1 0 R >>\n%%EOF"


def coded(text):
    return "".join(f"{LETTERS.index(c) + 1:04X}" for c in text).encode()


CONTENT = b"""%% a comment
q 1 0 0 1 72 700 cm BT /F1 10 Tf 12 TL (Hello \\(the\\) w\\157rld) Tj T* [(sec) -20 (ond) -400 (line)] TJ ET Q
BT /F2 10 Tf 1 0 0 1 72 600 Tm <%s> Tj 0 -14 Td <%s> Tj ET
BT /F1 10 Tf 1 0 0 1 72 500 Tm (\001\002\003A) Tj ET /X Do""" % (coded("баҕар тыл"), coded("саха"))


@pytest.mark.parametrize("squeeze, packed", [(True, False), (False, False), (True, True)])
def test_pages_become_text(squeeze, packed):
    found = pdf.pdf_pages(make_pdf([CONTENT, b"BT /F1 9 Tf (two) Tj ET"], squeeze, packed), [(1, 3, 3)])
    assert found == [(1, 1, "Hello (the) world\nsecond line\nбаҕар тыл\nсаха\nаҕ1A\nform"), (2, 1, "two")]


def test_tolerances_part_words_and_lines():
    loose = b"BT /F2 10 Tf 2 Tc 1 0 0 1 72 600 Tm <%s> Tj 1 0 0 1 200 598 Tm <%s> Tj ET" % (coded("баҕар"), coded("саха"))
    got = {level: text for _, level, text in pdf.pdf_pages(make_pdf([loose]), [(0, 1, 1), (1, 3, 3), (2, 3, 1)])}
    assert got == {0: "б а ҕ а р\nс а х а", 1: "баҕар саха", 2: "баҕар\nсаха"}


def test_layout_keeps_columns_and_distances():
    content = b"BT /F1 10 Tf 1 0 0 1 72 600 Tm (left) Tj 1 0 0 1 217 600 Tm (right) Tj 1 0 0 1 72 561 Tm (below) Tj ET"
    assert pdf.pdf_pages(make_pdf([content]), [(1, 3, 3)], True)[0][2] == "left" + " " * 16 + "right\n\n\nbelow"


def test_broken_files_are_errors_and_odd_ones_have_no_text():
    with pytest.raises(pdf.PdfError):
        pdf.pdf_pages(b"no such file", [(1, 3, 3)])
    with pytest.raises(pdf.PdfError):
        pdf.pdf_pages(make_pdf([b""]).replace(b"/Root 1 0 R", b"/Encrypt 9 0 R"), [(1, 3, 3)])
    with pytest.raises(pdf.PdfError):
        pdf.pdf_pages(make_pdf([CONTENT]).replace(b"FlateDecode", b"LZWDecode"), [(1, 3, 3)])
    assert pdf.pdf_pages(make_pdf([b"(no font) Tj Td Tf q Q Q [ ( ET 1 0 0"]), [(1, 3, 3)]) == [(1, 1, "")]
    assert pdf.pdf_pages(b"%PDF-1.4 1 0 obj << /Type /Catalog /Pages 1 0 R >> endobj", [(1, 3, 3)]) == [(1, 1, "")]


def test_run_reads_pdf_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    spaced = b"BT /F2 10 Tf 2 Tc 1 0 0 1 72 600 Tm <%s> Tj ET" % coded("баҕар тыл")
    (source / "one.pdf").write_bytes(make_pdf([spaced, CONTENT]))
    pages = files.read_pdf_pages(spark, str(source))
    assert {(r.page, r.level) for r in pages.collect()} == {(p, n) for p in (1, 2) for n in (0, 1, 2)}
    texts = {r.page: r.text for r in pipeline.pdf_texts(pages).collect()}
    assert texts[1] == "баҕар тыл" and "саха" in texts[2]
    done = pipeline.run(spark, DEFAULT.with_(input_folder=str(source), results_folder=str(tmp_path / "out"), archive_folder=str(tmp_path / "old")))
    assert any("баҕар" in r.text for r in spark.read.parquet(done["cleaned"]).collect())
