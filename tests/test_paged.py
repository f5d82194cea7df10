"""Linear runs of markers, and segmentation over rows of pages."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lexloom.operators import paged, segment
from lexloom.plans import catalog, derived  # noqa: F401  # derived registers more queries

GLYPHS = str.maketrans("lIOoSB", "110058")


def plain_ayat(text):
    """Paragraph marks by walking over them one by one."""
    run, out = [], []

    def flush():
        if len(run) > 1 or run and run[0][3]:
            out.extend(r[:3] for r in run)
        run.clear()

    for m in re.finditer(r"(?m)^[ \t]*\(([0-9lIOoSB]{1,3})([)1lI\]}])?[ \t]+", text):
        digits = m[1].translate(GLYPHS)
        readings = {int(digits)} | ({int(digits[:-1])} if not m[2] and len(digits) > 1 else set())
        if run and run[-1][2] + 1 in readings:
            run.append((m.start(), m.end(), run[-1][2] + 1, False))
        else:
            flush()
            if 1 in readings:
                run.append((m.start(), m.end(), 1, digits == m[1]))
    flush()
    return [(a, b, str(n)) for a, b, n in out]


def plain_run(text, pattern, first, following):
    label, out = None, []
    for m in re.finditer(pattern, text):
        on = label is not None and m[1] == following(label) or m[1] == first
        label = m[1] if on else None
        if on:
            out.append((m.start(), m.end(), m[1]))
    return out


def _found(df, marks):
    return [[tuple(m) for m in r["m"]] for r in df.select(marks(F.col("text")).alias("m")).collect()]


def _marked(rng, n):
    lines, k = [], 0
    for _ in range(n):
        k = rng.choice([k + 1] * 8 + [1, 11, rng.randint(0, 30)])
        body = "".join(rng.choice([c, c, c, *[g for g in "lIOoSB" if g.translate(GLYPHS) == c]]) for c in str(k))
        lines.append(rng.choice(["", " "]) + "(" + body + rng.choice([")", ")", ")", "1", "l", "]", "", ""]) + " x")
    return "\n".join(lines)


def test_paragraph_runs_equal_a_walk(rows):
    rng = random.Random(3)
    texts = [_marked(rng, rng.randint(0, 60)) for _ in range(150)] + ["", "none", "(11 x\n(12 y", "\n".join(f"({i}) x" for i in range(1, 11)) + "\n(11 x\n(2) y\n(12) z", "\n".join(f"(1{'0' if i == 9 else i} x" for i in range(10))]
    assert _found(rows([(t,) for t in texts], "text string"), segment.ayat_marks) == [plain_ayat(t) for t in texts]


def test_letter_and_number_runs_equal_a_walk(rows):
    rng = random.Random(4)
    texts = ["\n".join(f"{rng.choice('aabcdez')}. x" for _ in range(rng.randint(0, 40))) for _ in range(80)]
    assert _found(rows([(t,) for t in texts], "text string"), segment.huruf_marks) == [plain_run(t, r"(?m)^[ \t]*([a-z])[.)][ \t]+", "a", lambda x: chr(ord(x) + 1)) for t in texts]
    texts = ["\n".join(f"{rng.choice([1, 1, 2, 3, 4, '01', 12])}. x" for _ in range(rng.randint(0, 40))) for _ in range(80)]
    assert _found(rows([(t,) for t in texts], "text string"), segment.angka_marks) == [plain_run(t, r"(?m)^[ \t]*([0-9]+)[.)][ \t]+", "1", lambda x: str(int(x) + 1)) for t in texts]


def test_many_markers_take_linear_time(rows):
    def seconds(n):
        text = "\n".join(f"({i % 90 + 1}) x\n{chr(97 + i % 26)}. y" for i in range(n))
        df = rows([(text,)], "text string").select(F.size(segment.ayat_marks(F.col("text"))), F.size(segment.huruf_marks(F.col("text"))))
        df.collect()
        began = time.time()
        assert df.first() == (n, n)
        return time.time() - began

    few, many = seconds(12_500), seconds(100_000)
    assert many < 24 * max(few, 0.5)


def _document(rng, articles):
    """Lines of a document in which numbers go on, back, are damaged or start again."""
    out, k = [], 0
    for _ in range(articles):
        k = rng.choice([k + 1] * 9 + [1, 2, max(k - 3, 0), max(k - 12, 0)])
        shown = str(k).replace("5", rng.choice("5S")) if rng.random() < 0.2 and str(k)[0] != "5" else str(k)
        out.append(rng.choice(["", " "]) + f"Pasal {shown}{rng.choice(['', '', '', 'A'])}")
        out += [rng.choice(["(1) Isi satu.", "(2) Isi dua.", "a. hal;", "b. lain.", "1. ini;", "Teks.", ""]) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.06:
            out.append(rng.choice(["PENJELASAN", "LAMPIRAN I", " PENJELASAN ATAS", "LAMPIRAN"]))
            out += ["Umum " + "x" * rng.choice([0, 10, 4100])] * rng.randint(0, 2)
    return out


def _paged(rng, lines):
    out, at = [], 0
    while at < len(lines):
        n = rng.randint(1, 12)
        out.append("\n".join(lines[at : at + n]))
        at += n
    return out or [""]


@pytest.mark.parametrize("chunk", [2, 512])
def test_pages_give_the_units_of_the_whole(rows, monkeypatch, chunk):
    monkeypatch.setattr(paged, "CHUNK_PAGES", chunk)
    monkeypatch.setattr(paged, "CHUNK_OFFSETS", 97 if chunk == 2 else paged.CHUNK_OFFSETS)
    rng = random.Random(chunk)
    docs = {f"d{i}": _paged(rng, _document(rng, rng.randint(0, 40))) for i in range(25)}
    docs |= {"none": ["Tanpa pasal.", "PENJELASAN"], "empty": ["", ""], "head": ["PENJELASAN", "Pasal 1", "Isi."], "end": ["Pasal 1\nx", "Pasal 2"]}
    pages = rows([(d, 3 * i + 1, t, i) for d, ts in docs.items() for i, t in enumerate(ts)], "doc_id string, page int, text string, chunk int")
    whole = rows([(d, "\n".join(ts)) for d, ts in docs.items()], "doc_id string, text string")

    def said(df):
        return sorted(map(str, (tuple(r.asDict().values()) for r in df.collect())))

    assert said(paged.pasals(pages)) == said(segment.pasals(whole))
    assert said(paged.units(pages)) == said(segment.units(whole))
    assert said(paged.anomalies(pages)) == said(segment.section_anomalies(whole))


def test_null_pages_and_no_rows(rows):
    schema = "doc_id string, page int, text string"
    assert paged.units(rows([], schema)).collect() == []
    got = paged.pasals(rows([("d", 1, "Pasal 1"), ("d", 2, None), ("d", 3, "Isi.")], schema)).collect()
    assert [(r["pasal"], r["text"]) for r in got] == [("1", "\n\nIsi.")]


def test_a_long_document_is_dealt_over_tasks(spark):
    """20,000 articles on as many pages; no task sees the document."""
    pages = spark.range(20_000).selectExpr("'d' AS doc_id", "id AS page", "concat('Pasal ', id + 1, '\n(1) Isi.\n(2) ', repeat('kata ', 40)) AS text").repartition(8)
    found = paged.units(pages)
    assert found.groupBy("level").count().sort("level").collect() == [("ayat", 40_000), ("pasal", 20_000)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "join_pages" not in plan and "NestedLoop" not in plan


def test_pages_are_read_once(spark):
    """Markers, pieces and lengths of pages come from one kept table, not from the corpus again."""
    assert "lineitem" not in catalog.QUERIES["paged_citations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_states_are_not_worked_out_for_each_element(rows):
    """A list that only a lambda reads is put into it, which makes the work quadratic."""
    headers = "array<struct<start:int,end:int,label:string,number:int,repaired:int>>"
    plan = paged.numbered(rows([], f"doc_id string, page int, headers {headers}"))._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "before, aggregate(" not in plan
