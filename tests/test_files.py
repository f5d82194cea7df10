import json
import sys

import pytest
from pyspark.sql import functions as F

from lexloom.operators import reconcile, segment
from lexloom.sources import files, recordio, sinks, tools
from lexloom.streaming import numerals as streaming


def test_pdf_listing_and_pages(spark, tmp_path, rows):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "UU 1.PDF").write_bytes(b"x")
    (tmp_path / "b.pdf").write_bytes(b"")
    (tmp_path / "c.txt").write_text("no")
    got = {r.doc_id: r.error for r in files.pdf_files(spark, str(tmp_path)).collect()}
    assert got == {"UU_1": None, "b": "zero-byte file"}
    assert files.pdf_files(spark, str(tmp_path), "uu").count() == 1
    pages = files.layer_pages(rows([("D", "one\ftwo\f \n"), ("E", "x")], "doc_id string, text string"))
    assert {(r.doc_id, r.page, r.text) for r in pages.collect()} == {("D", 1, "one"), ("D", 2, "two"), ("E", 1, "x")}


def test_provider_errors_are_rows(spark, rows):
    def reader(content):
        if content == b"bad":
            raise ValueError("broken")
        return [content.decode()]

    got = files.provided(rows([("a", bytearray(b"ok"), None), ("b", bytearray(b"bad"), None)], "doc_id string, content binary, error string"), reader, "ocr").collect()
    assert {(r.doc_id, r.text, r.error) for r in got} == {("a", "ok", None), ("b", None, "ValueError: broken")}


def test_gold_files(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"instruments": {"U": {"title": "t", "rank": 3}}, "norms": [{"id": "n", "instrument": "U", "applies_to": ["*"], "bounds": [{"op": "<=", "value": 0.1, "unit": "fraction"}]}]}))
    norms = files.gold_norms(spark, str(tmp_path / "g.json"))
    assert [(r.norm, r["rank"]) for r in norms.collect()] == [("n", 3)]
    assert [(r.op, r.value) for r in files.norm_bounds(norms).collect()] == [("<=", 0.1)]


def test_stream_finds_the_same_figures(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"doc_id": "D", "text": "Tarif 10% (sepuluh persen)"}))
    q = streaming.figures(streaming.arriving(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("figures").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.value for r in spark.table("figures").collect()] == [0.1]


def test_listing_is_ordered_and_any_case(spark, tmp_path):
    for name in ("b.Pdf", "a.pDf", "sub/c.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name.startswith("b") else b"x")
    got = [(r.doc_id, r.error) for r in files.listing(files.pdf_files(spark, str(tmp_path))).collect()]
    assert got == [("a", None), ("b", "zero-byte file"), ("c", None)]


def test_tools_have_a_time_limit():
    python = sys.executable
    assert tools.run([python, "-c", "print('hi')"]).strip() == b"hi"
    with pytest.raises(tools.ToolError, match="took more"):
        tools.run([python, "-c", "import time; time.sleep(30)"], seconds=0.5)
    with pytest.raises(tools.ToolError, match="failed: bad"):
        tools.run([python, "-c", "import sys; sys.exit('bad')"])
    with pytest.raises(tools.ToolError, match="not installed"):
        tools.run(["no-such-tool-here"])
    said = tools.versions({"here": [python, "--version"], "gone": ["no-such-tool-here"]})
    assert said["here"].startswith("Python 3") and said["gone"] == "unknown"


def test_layer_and_ocr_by_any_command(spark, rows):
    layer = (sys.executable, "-c", "import sys; sys.stdout.write(open(sys.argv[1]).read())")
    assert tools.text_layer(b"one\ftwo\f \n", layer) == ["one", "two"]
    render = (sys.executable, "-c", "import sys; open(sys.argv[-1] + '-1.png', 'w').write('page ' + sys.argv[2])")
    read = (sys.executable, "-c", "import sys; sys.stdout.write(open(sys.argv[1]).read())")
    assert tools.ocr_page(b"x", 7, render, read) == "page 7"
    with pytest.raises(tools.ToolError, match="not rendered"):
        tools.ocr_page(b"x", 7, (sys.executable, "-c", ""), read)

    def reader(content, page):
        if page == 2:
            raise ValueError("broken")
        return f"{content.decode()} {page}"

    got = tools.ocr_pages(rows([("a", 1, bytearray(b"p")), ("a", 2, bytearray(b"p"))], "doc_id string, page int, content binary"), reader).collect()
    assert {(r.page, r.text, r.error) for r in got} == {(1, "p 1", None), (2, None, "ValueError: broken")}


def test_manifest_names_failures(spark, rows, tmp_path):
    pages = rows([("a", 1, "clean", "t"), ("b", 1, "clean", "u")], "doc_id string, page int, classification string, text string")
    tallies = rows([("b", 1), ("a", 1)], "doc_id string, n_pages int")
    failed = rows([("c", "zero-byte file"), ("d", None)], "doc_id string, error string")
    got = files.write_records(pages, tallies, str(tmp_path / "r"), failed).collect()
    assert [(r.doc_id, r.n_pages, r.error) for r in got] == [("a", 1, None), ("b", 1, None), ("c", None, "zero-byte file")]
    assert sorted(p.name for p in (tmp_path / "r").iterdir()) == ["a.json", "b.json", "manifest.json"]


def test_documents_from_pages(rows):
    pages = rows([("D", 1, "text_layer", "HEAD\nPasal 1\n(1) Satu dan\n- 1 -"), ("D", 2, "ocr", "HEAD\nlagi satu.\n(2) Dua.\n- 2 -")], "doc_id string, page int, method string, text string")
    got = {r.citation: (r.pages, r.methods) for r in segment.segment_pages(pages).collect()}
    assert got == {"Pasal 1": ([1, 2], ["ocr", "text_layer"]), "Pasal 1 ayat (1)": ([1, 2], ["ocr", "text_layer"]), "Pasal 1 ayat (2)": ([2], ["ocr"])}


def test_pages_against_a_second_reading(rows):
    pages = rows([("D", 1, "text_layer", "Tarif l0% (sepuluh persen)"), ("D", 2, "text_layer", "Tarif 10% (sepuluh persen)"), ("D", 3, "ocr", "Tarif l0% (sepuluh persen)"), ("D", 4, "text_layer", "Tarif 20% (lima persen)")], "doc_id string, page int, method string, text string")
    second = rows([("D", 1, "Tarif 10% (sepuluh persen)"), ("D", 2, "Tarif 10% (sepuluh persen)"), ("D", 4, None)], "doc_id string, page int, text string")
    found = reconcile.reconcile_pages(pages, second)
    assert [(r.page, r.status, r.value) for r in found.collect()] == [(1, "sources_agree_after_repair", 0.1)]
    assert [r.line for r in sinks.reconcile_report(found).collect()] == ["sources_agree_after_repair | fraction | l0% (sepuluh persen) | 10% (sepuluh persen) | 0.1"]
    assert sinks.reconcile_report(found, "sources_disagree").collect() == []


def test_prefilter_report(rows):
    share = rows([(4, 1, 0.25)], "body_pasal long, extract long, share double")
    reasons = rows([("numeral_pair", 3), ("bound_marker", 2)], "reason string, n long")
    sole = rows([("numeral_pair", 1)], "reason string, n long")
    assert [r.line for r in sinks.prefilter_report(share, reasons, sole).collect()] == ["1 of 4 articles to extract (25%)", "bound_marker: 2, alone 0", "numeral_pair: 3, alone 1"]


def _record_rows(rows, ids):
    pages = rows([(d, n, "clean", f"text {d} {n}") for d in ids for n in (2, 1)], "doc_id string, page int, classification string, text string")
    return pages, rows([(d, 2, {"ocr": 2}) for d in ids], "doc_id string, n_pages int, methods map<string,int>")


def test_records_are_read_back(spark, rows, tmp_path):
    folder, ids = str(tmp_path / "r"), [f"d{i}" for i in range(20)]
    pages, tallies = _record_rows(rows, ids)
    files.write_records(pages, tallies, folder, rows([("z", "zero-byte file")], "doc_id string, error string"))
    back = files.records(spark, folder)
    assert {(r.doc_id, r.page, r.text) for r in files.record_pages(back).select("doc_id", "page", "text").collect()} == {tuple(r) for r in pages.select("doc_id", "page", "text").collect()}
    assert {(r.doc_id, r.n_pages, r.methods["ocr"]) for r in back.collect()} == {(d, 2, 2) for d in ids}
    said = json.loads((tmp_path / "r" / "manifest.json").read_text())["documents"]
    assert said == [*({"doc_id": d, "n_pages": 2, "methods": {"ocr": 2}} for d in sorted(ids)), {"doc_id": "z", "error": "zero-byte file"}]
    pages, tallies = _record_rows(rows, ["d1"])
    files.write_records(pages.withColumn("text", F.lit("again")), tallies, folder)
    assert {r.text for r in files.record_pages(files.records(spark, folder, "d1")).where("doc_id = 'd1'").collect()} == {"again"}


def test_a_failed_write_leaves_nothing(rows, tmp_path):
    folder = tmp_path / "r"
    files.write_records(*_record_rows(rows, ["old"]), str(folder))
    before = {p.name: p.read_bytes() for p in folder.iterdir()}
    pages, tallies = _record_rows(rows, [*(f"d{i}" for i in range(20)), "no/such/folder"])
    with pytest.raises(Exception, match="no/such/folder"):
        files.write_records(pages, tallies, str(folder))
    assert {p.name: p.read_bytes() for p in folder.iterdir()} == before


def test_subtrees_are_listed_in_tasks(spark, tmp_path):
    for name in ("x.pdf", "a/y.PDF", "a/b/z.pdf", "a/b/z.pdf:Zone.Identifier.pdf", "c/w.txt", "c d/ü.pdf"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode() if "z" not in name else b"")
    found = files.pdf_files(spark, f"file://{tmp_path}")
    assert {(r.doc_id, bytes(r.content), r.error) for r in found.collect()} == {("x", b"x.pdf", None), ("y", b"a/y.PDF", None), ("z", b"", "zero-byte file"), ("ü", "c d/ü.pdf".encode(), None)}
    names = recordio.PdfReader(str(tmp_path), True).partitions()
    assert {(p.path, p.deep) for p in names} == {(str(tmp_path), False), *((str(tmp_path / d), True) for d in ("a", "c", "c d"))}
    bare = recordio.registered(spark).read.format("pdf_folder").option("content", "false").load(str(tmp_path))
    assert bare.where("content is not null").count() == 0 and bare.count() == 4
