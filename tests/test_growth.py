"""Work that must not grow: what plans leave out, and what short inputs skip."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from lexloom.functions import numerals
from lexloom.operators import layout, prefilter, segment, slots
from lexloom.plans import catalog, derived, storage  # noqa: F401  # derived registers more queries

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


def test_figures_are_numbered_without_parsing_them(spark):
    """Only where a figure is counts here; repairing its words costs most."""
    assert "levenshtein" not in plan(catalog.QUERIES["annotated_slots"](spark, SF))


def test_figures_are_counted_without_parsing_them(rows):
    df = rows([("Tarif 5% (lima persen).",)], "text string")
    assert "levenshtein" not in plan(df.select(prefilter.bucket(F.col("text"))))


@pytest.mark.parametrize("text", ["", "x", "Tarif 5% (lima persen), 30 (tiga puluh) hari; 6% (enam persen).", "30 (tiga puluh) hari, 20 (dua puluh) hari", "Tarif 5 7o (lima persen) hari kerja.", "a\x01b\x025% (lima persen)" + " 5% (lima persen)" * 300])
def test_figures_are_those_of_a_scan(rows, text):
    got = rows([(text,)], "text string").select(numerals.figures(F.col("text")).alias("f"), numerals.scan(F.col("text")).alias("s"), slots.annotate(F.col("text")).alias("a")).first()
    assert [(f.start, f.end, f.text) for f in got.f] == [(s.start, s.end, s.matched_text) for s in got.s]
    assert [text.replace("\x01", "�").replace("\x02", "�")[f.start : f.end] for f in got.f] == [f.text for f in got.f]
    assert got.a.count("[N") == len(got.f)


@pytest.mark.parametrize("name,step", [("page_segments", "regexp_replace"), ("slots_reused", "levenshtein"), ("crossref_resolved", "levenshtein")])
def test_shared_steps_are_worked_out_once(spark, name, step):
    """What several branches need is read back, not found again in each."""
    assert step not in plan(catalog.QUERIES[name](spark, SF)).lower()


@pytest.mark.parametrize("text,labels", [("(1) a\n(2) b\n", ["1", "2"]), ("(l) a\n(2) b\n", ["1", "2"]), ("(l) a\n", []), ("(1) a\n", ["1"]), ("(1) a\n(3) b\n", ["1"]), ("x", []), ("(2) a\n", [])])
def test_short_runs_of_paragraphs(rows, text, labels):
    got = rows([(text,)], "text string").select(segment.ayat_marks(F.col("text")).alias("m")).first().m
    assert [m.label for m in got] == labels and [text[m["at"]] for m in got] == ["("] * len(got)


def test_known_phrases_spell_what_their_words_do(spark, rows, monkeypatch):
    """Phrases of one word are looked up; the lookup agrees with the long way."""
    text = F.col("t")
    phrases = sorted({*numerals._RATES, *numerals._COUNTS, "LIMA persen", "lima  persen", "seribu persen", "lmia persen", "nol"})
    texts = [*phrases, "5%", "301%", "300o/o", "07%", "S%", "5 %", "999%", "a. 5%", "7", "1000", "07", "l5", ""]
    df = rows([(t,) for t in texts], "t string")
    read = lambda: df.select("t", numerals.parse_words(text).alias("w"), numerals.parse_words_count(text).alias("c"), numerals.parse_digits(text).alias("d"), numerals.parse_digits_count(text).alias("n"))
    quick = read().collect()
    monkeypatch.setattr(numerals, "_known", lambda phrases, raw, otherwise: otherwise)
    assert [(r.t, r.w, r.c) for r in quick] == [(r.t, r.w, r.c) for r in read().collect()]
    by = {r.t: r for r in quick}
    assert [tuple(by[t].d) for t in ("5%", "301%", "300o/o", "07%", "S%", "999%", "a. 5%", "")] == [(0.05, False), (None, True), (3.0, False), (0.07, False), (0.05, True), (None, True), (0.05, False), (None, False)]
    assert [tuple(by[t].n) for t in ("7", "07", "l5", "1000")] == [(7.0, False), (7.0, False), (15.0, True), (1000.0, False)]


def test_kept_tables_are_columns(spark, rows):
    """What is kept comes back as it was, nested and null values included, from files of columns."""
    df = rows([("a", [(1, "x"), (2, None)]), (None, [])], "k string, l array<struct<i:int,s:string>>")
    again = storage.kept(df)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect())) and again.columns == df.columns
    assert "FileScan parquet" in plan(again)


def test_pages_to_read_again_are_chosen_once(spark):
    """The choice parses every figure; both readings take its rows from where they are kept."""
    assert "THEN ocr" not in plan(catalog.QUERIES["reconciled_pages"](spark, SF))


def test_pages_are_read_once(spark):
    """Stripped pages carry their methods; the corpus isn't put together again for them."""
    assert "lineitem" not in catalog.QUERIES["page_segments"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_zones_equal_a_walk(rows):
    """Pages with and without blank lines, with every kind of line break."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "b c", " ", "\t", "\u00a0", "", "x"]) + rng.choice(["\n", "\n", "\r\n", "\r", "\x0b", "\x1c", "\x85"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    texts += ["", "\n", " ", "a", "a\n", "a\n\n", "\na", "a\n \nb", *("\n".join("abcdefghij"[:n]) for n in range(1, 11))]

    def walk(text):
        each = re.split(layout.LINE_BREAK, re.sub(rf"(?:{layout.LINE_BREAK})\Z", "", text))
        solid = [i for i, x in enumerate(each) if x.strip()]
        zone = min(layout.ZONE_LINES, max(1, len(solid) // 3))
        edge = {i: k < zone or k >= len(solid) - zone for k, i in enumerate(solid)}
        return [(i, x, edge.get(i)) for i, x in enumerate(each)]

    got = layout.lines(rows([("d", k, t) for k, t in enumerate([*texts, None])], "doc_id string, page int, text string"))
    found = {}
    for r in got.collect():
        found.setdefault(r.page, []).append((r.line_no, r.line, r.edge))
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in found.items()} == {k: walk(t) for k, t in enumerate(texts)}
