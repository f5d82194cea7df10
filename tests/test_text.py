from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions.matchers import find_all


def test_canonical_keeps_hyphens_at_line_ends(rows):
    t = rows([("perundang-\n   undangan  ber\u00adlaku\u00a0ini \n",)], "t string").select(T.canonical(F.col("t")).alias("c")).first().c
    assert t == "perundang-undangan berlaku ini"


def test_page_classes(rows):
    data = [(None, "empty"), ("short", "empty"), ("x" * 100, "clean"), ("x" * 97 + "\ufffd" * 3, "corrupted"), ("x" * 98 + "\ufffd" * 2, "clean")]
    got = rows(data, "t string, e string").select("e", T.page_class(F.col("t")).alias("c")).collect()
    assert [r.c.classification for r in got] == [r.e for r in got]


def test_identifiers(rows):
    r = rows([("Mandi Uap/Spa, dll.", "Perda Kota 7/2023 tentang Pajak", "Pasal 5 ayat (1)")], "l string, d string, c string").select(T.slug(F.col("l")).alias("s"), T.citation_slug(F.col("d"), F.col("c")).alias("c"), T.instrument_rank(F.col("d")).alias("r"), T.file_slug(F.col("d")).alias("f")).first()
    assert r.s == "mandi_uap_spa_dll" and r.r == "perda"
    assert r.c == "perda_kota_7_2023_tentan__pasal_5_ayat_1"
    assert r.f == "Perda_Kota_7_2023_tentang_Pajak"


def test_matches_equal_python(rows):
    import re

    texts = ["", "a1b22c333", "no match", "12", "🙂1🙂22", "x\x011\x02"]
    got = rows([(t,) for t in texts], "t string").select("t", find_all(F.col("t"), "[0-9]+").alias("m")).collect()
    for r in got:
        assert [(m.start, m.end, m.text) for m in r.m] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", r.t)]
