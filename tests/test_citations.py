"""Citations that are read without the fold agree with it."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexloom.functions import rows_of
from lexloom.functions.matchers import find_all, rows_of_all
from lexloom.operators import crossref, segment
from lexloom.plans import storage

WORDS = ("pasal", "ayat", "huruf", "dan", "atau", "pada", "dalam", "angka", "3", "12", "(1)", "(2", "( 1 )", "(1 )", "(l)", "(a)", "a", "b", "ayal", "pasl", "hurut", "dn", "pda", "atat", "dam", "di", "atas", "Undang-Undang", "K", ",", "dalan", "apasal")


def test_one_place_is_what_the_fold_reads(rows):
    pick = random.Random(7)
    spans = ["", "pada ayat (1)", "dalam Pasal 4 ayal (2)", "dalam Pasal 4", "Pasal 4 ayat (1) huruf b", "di atas sana", "pasal pasal 3", "dan dan pasal 3 dan", "ayat ayat (1)", "angka angka pasal 3", "pasal 3 ayat (1) huruf", "Pasal 3 huruf a", "ayat (12\n)", "ayat (1) pasal 3"]
    spans += [" ".join(pick.choices(WORDS, k=pick.randint(1, 7))) for _ in range(1500)]
    df = rows([(i, s, "9", "dimaksud") for i, s in enumerate(spans)], "i int, span string, pasal string, verb string")
    got = crossref.with_targets(df).select("i", "span", "targets", crossref.read_targets(F.col("span"), F.col("pasal")).alias("fold")).collect()
    assert [r.span for r in got if r.targets != r.fold] == [] and len(got) == len(spans)
    assert sum(len(r.targets) == 1 for r in got) > 40


def test_citations_of_one_place_need_no_fold(rows, monkeypatch):
    """The fold and the lists of matches are interpreted; most citations get to neither."""
    for name in ("lexloom.operators.crossref.read_targets", "lexloom.functions.matchers.find_all"):
        monkeypatch.setattr(name, lambda *_: F.raise_error(F.lit("interpreted")))
    texts = ["Hal sebagaimana dimaksud pada ayat (1).", "Hal sebagaimana diatur dalam Pasal 4 ayal (2).", "Hal sebagaimana dimaksud dalam Pasal 4.", "Hal sebagaimana dimaksud di atas sana.", "Hal sebagaimana telah diubah dengan Pasal 3 dan Pasal 4.", "Hal lain."]
    df = rows([("d", str(i), t) for i, t in enumerate(texts)], "doc_id string, pasal string, text string")
    got = {r.pasal: [tuple(t) for t in r.targets] for r in crossref.references(df).collect()}
    assert got == {"0": [("0", "1", None)], "1": [("4", "2", None)], "2": [("4", None, None)], "3": [], "4": []}


@pytest.mark.parametrize("text", ["", "x", "b", "abab", "\x01a\x02b", "aaé€b\U0001f600b", None])
def test_rows_of_all_matches(rows, text):
    df = rows([(1, text), (2, "b")], "k int, text string")
    want = rows_of(df, find_all(F.col("text"), "(?<=a?)b"), "k").orderBy("k", "i").collect()
    assert rows_of_all(df, F.col("text"), "(?<=a?)b", "k").orderBy("k", "i").collect() == want


def test_lookups_move_keys_once_and_in_portions(spark, rows, monkeypatch, tmp_path):
    """One shuffle, by article, whose portions grow in number with the input."""
    keys = rows([("d", "1", "1", None), ("d", "1", None, None), ("d", "2", None, None)], "doc_id string, pasal string, ayat string, huruf string")
    keys.write.parquet(f"{tmp_path}/keys")
    read = spark.read.parquet(f"{tmp_path}/keys")
    targets = read.selectExpr("doc_id", "pasal", "coalesce(ayat, '1') AS ayat", "huruf")
    plan = crossref.deepest(targets, read)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bExchange ", plan)) == 1 and "Join" not in plan
    size = sum(f.stat().st_size for f in (tmp_path / "keys").glob("*.parquet"))
    few, many = (storage.portioned(read, "doc_id", size=max(1, size // n)).rdd.getNumPartitions() for n in (1, 50))
    assert few <= int(spark.conf.get("spark.sql.shuffle.partitions")) < 50 <= many


def _index(rows, text):
    got = crossref.strict_index(rows([("d", text)], "doc_id string, text string")).collect()
    assert all(text[r.start : r.end] == r.text for r in got)
    return {(r.pasal, r.ayat, r.huruf): r.text for r in got}


def test_articles_of_one_paragraph_need_no_lambda(rows, monkeypatch):
    monkeypatch.setattr(crossref, "_labelled", lambda text, _: F.when(F.raise_error(F.lit("interpreted")).isNull(), F.array(F.struct(*(F.lit(x).alias(n) for x, n in (("1", "label"), (1, "from"), (1, "to"), ("x", "text")))))))
    got = _index(rows, "Pasal 1\n(1) Satu €\U0001f600.\nPasal 2\nTanpa (1) ayat.\nPasal 3\nKata (1) dan\n  (1)  Isi.\n")
    assert got == {("1", None, None): "\n(1) Satu €\U0001f600.\n", ("1", "1", None): "Satu €\U0001f600.\n", ("2", None, None): "\nTanpa (1) ayat.\n", ("3", None, None): "\nKata (1) dan\n  (1)  Isi.\n", ("3", "1", None): "Isi.\n"}


def test_letters_behind_a_paragraph_are_found(rows):
    """A letter right after its paragraph's number stands at no line's start."""
    got = _index(rows, "Pasal 1\n(1) a. x;\nPasal 2\n(1) Dua:\na. p;\nb. q.\nPasal 3\na. y.\nPasal 4\n(1) A\n(2) B\n")
    assert {k[1:]: v for k, v in got.items() if k[0] == "1"} == {(None, None): "\n(1) a. x;\n", ("1", None): "a. x;\n", ("1", "a"): "x;\n"}
    assert {k for k in got if k[0] != "1"} == {("2", None, None), ("2", "1", None), ("2", "1", "a"), ("2", "1", "b"), ("3", None, None), ("3", None, "a"), ("4", None, None), ("4", "1", None), ("4", "2", None)}


def test_the_strict_index_moves_lines_once(spark):
    from lexloom.plans import catalog

    plan = catalog.QUERIES["crossref_index"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bExchange ", plan)) == 1


def test_gold_is_counted_in_one_shuffle(rows):
    units = rows([("d", "Pasal 1"), ("d", "Pasal 2"), ("d", "Pasal 2"), ("e", "Pasal 1"), ("d", None), (None, "Pasal 1")], "doc_id string, citation string")
    norms = rows([("a", "d", "Pasal 1"), ("a", "d", "Pasal 1"), ("b", "d", "Pasal 2"), ("c", "e", "Pasal 2"), ("n", "d", None), ("m", None, "Pasal 1"), (None, "d", "Pasal 1")], "norm string, doc_id string, citation string")
    got = crossref.gold_resolution(norms, units)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [("a", 1, "ok"), ("a", 1, "ok"), ("b", 2, "AMBIG"), ("c", 0, "MISSING"), ("n", 0, "MISSING"), ("m", 0, "MISSING"), (None, 1, "ok")]))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bExchange ", plan)) == 1 and "Join" not in plan


def test_one_mark_at_the_first_line_is_not_split_off(rows):
    """Splitting compiles its pattern for every text."""
    text = ["\n(1) x", "\n (1) x", "y (1) z\n(1) w", "\n\n(1) x"]
    got = rows([(t,) for t in text], "t string").select("t", segment.ayat_marks(F.col("t")).alias("m")).collect()
    assert [[r.t[m["at"] : m["from"]] for m in r.m] for r in got] == [["(1) "], [" (1) "], ["(1) "], ["(1) "]]
