import random

import pytest
from pyspark.sql import functions as F

from lexloom.operators import calibrate, conflict, crossref, ontology, prefilter, reconcile, slots


@pytest.mark.parametrize("text,n", [("setiap orang wajib melapor", 1), ("wajib pajak membayar", 0), ("Wajib Retribusi dan wajib pungut", 0), ("kontribusi wajib kepada negara", 0), ("orang wajib, membayar", 0), ("ia wajib dan wajib lapor", 2)])
def test_modal(rows, text, n):
    assert rows([(text,)], "t string").select(prefilter.modal_wajib(F.col("t")).alias("n")).first().n == n


@pytest.mark.parametrize(
    "text,bucket,why",
    [
        ("Tarif ditetapkan paling tinggi 10% (sepuluh persen).", "extract", ["bound_marker", "numeral_pair"]),
        ("Setiap orang dilarang merokok.", "extract", ["modal_dilarang"]),
        ("Diatur 5 % dari nilai.", "skip", "unexplained_numeral"),
        ("Dalam 5 (lima puluh satu) hari xx", "extract", ["numeral_pair"]),
        ("Cukup jelas.", "skip", "no_normative_marker"),
    ],
)
def test_buckets(rows, text, bucket, why):
    b = rows([("D", "body", "1", 1, "Pasal 1", text)], "doc_id string, section string, pasal string, occurrence int, citation string, text string")
    r = prefilter.prefilter(b).first()
    assert r.bucket == bucket and (r.selected_by if bucket == "extract" else r.skip_reason) == why


def test_slots_annotate_and_resolve(rows):
    text = "(1) Tarif paling rendah 40% (empat puluh persen) dan paling tinggi 10% (sepuluh persen). (2) Lain 3% (lima persen)."
    art = rows([("D", "k", text)], "doc_id string, pasal_key string, text string")
    assert art.select(slots.annotate(F.col("text")).alias("a")).first().a == "(1) Tarif paling rendah 40% (empat puluh persen) [N1] dan paling tinggi 10% (sepuluh persen) [N2]. (2) Lain 3% (lima persen) [N3]."
    table = slots.slot_table(art).withColumnRenamed("pasal_key", "call")
    ops = table.crossJoin(art.select("text")).select(slots.operator_before(F.col("text"), F.col("start")).alias("op"), "slot_no").orderBy("slot_no").collect()
    assert [o.op for o in ops][:2] == [">=", "<="]
    units = rows([("k", "ayat 1", 0, 90), ("k", "ayat 2", 90, 200)], "call string, citation string, start int, end int")
    norms = rows([("k", "A", 0, "ayat 1"), ("k", "B", 1, "ayat 9"), ("k", "C", 2, "ayat 1")], "call string, norm string, norm_ord int, citation string")
    bounds = rows([("k", "A", 0, 0, ">=", "N1"), ("k", "A", 0, 1, "<=", "N2"), ("k", "B", 1, 0, "<=", "N7"), ("k", "C", 2, 0, "<=", "N1"), ("k", "C", 2, 1, "==", "N3")], "call string, norm string, norm_ord int, bound_ord int, op string, slot string")
    kept, errors, orphans = slots.resolve(norms, bounds, table, units)
    assert {(e.norm, e.error) for e in errors.collect()} == {("A", "floor_above_ceiling"), ("B", "citation_not_in_pasal"), ("B", "unknown_slot"), ("C", "slot_reused"), ("C", "slot_outside_cited_unit"), ("C", "slot_needs_review"), ("C", "slot_unresolved")}
    assert kept.count() == 5 and orphans.count() == 0


def test_two_readings(rows):
    a = rows([("p", "Tarif lO% (sepuluh persen), 5% (lima persen), 5% (lima persen), 7% (delapan persen)")], "page string, text string")
    b = rows([("p", "Tarif 10% (sepuluh persen), 5% (lima persen), 7% (delapan persen)")], "page string, text string")
    got = reconcile.reconcile(reconcile.readings(a, ["page"]), reconcile.readings(b, ["page"]), ["page"])
    assert {r.status: r.n for r in reconcile.summary(got).collect()} == {"sources_agree_after_repair": 1, "sources_agree": 1, "single_source": 1, "sources_disagree": 1}


def test_lists(rows):
    def split(t):
        return rows([(t,)], "t string").select(ontology.split_services(F.col("t")).alias("s")).first().s

    invented = [f"jasa{i} x{i}" if i % 2 else f"jasa{i}" for i in range(6)]
    for n in range(2, 7):
        for last in (" dan ", ", dan ", ", serta ", ", "):
            found = split(", ".join(invented[: n - 1]) + last + invented[n - 1] + ";")
            assert found.members == invented[:n] or last == ", serta ", (n, last)
    assert split("jasa1 yang dijual").reason == "qualified_by_subordinate_clause"
    assert split("jasa1").reason == "single_member" and split(" ; ").reason == "empty"
    heads = rows([(["p1 p2", "q", "r"],), (["p", "q", "r"],), (["p1 p2", "q"],)], "m array<string>").select(ontology.distributive_head(F.col("m")).alias("h")).collect()
    assert [h.h for h in heads] == ["p1", None, None]


def test_harvest(rows):
    from lexloom.operators import segment

    text = "Pasal 55\n(1) Objek pajak jasa hiburan meliputi:\na. diskotek, karaoke, dan bar;\nb. panti pijat;\n(2) Yang dikecualikan adalah:\na. amal;\nb. ibadah;\n"
    cats, notes = ontology.harvest(segment.units(rows([("UU_1", text)], "doc_id string, text string")))
    got = {(c.level, c.id) for c in cats.collect()}
    assert ("subject", "objek_pajak_jasa_hiburan") in got and ("huruf", "panti_pijat") in got and {("service", "diskotek"), ("service", "karaoke"), ("service", "bar")} <= got
    assert {n.reason for n in notes.collect()} == {"exclusion_list_not_a_category", "huruf_not_split:single_member"}
    assert cats.where("rank <> 'national' or not taxable_subject").count() == 0


def test_alignments(rows):
    schema = "ord int, id string, label string, doc_id string, origin_citation string, taxable_subject boolean"
    live = rows([(0, "karaoke", "Karaoke", "u", "c", True), (1, "bar", "bar", "u", "c", True), (2, "k2", "karaoke keluarga besar", "u", "c", True)], schema)
    local = rows([(0, "a", "karaoke keluarga", "l", "c", True), (1, "b", "Bar", "l", "c", True), (2, "c", "barang", "l", "c", True), (3, "d", "karaoke", "l", "c", False)], schema)
    assert {(r.local_id, r.proposed_relation, r.statutory_id) for r in ontology.alignments(live, local).collect()} == {("a", "subclass_of", "karaoke"), ("b", "same_as", "bar")}


def test_citation_targets(rows):
    """Targets said in words read as the triples that they were made of."""
    rng = random.Random(5)
    cases = [("", []), ("angka 3", [])]
    for _ in range(150):
        wanted, parts, home = [], [], "9"
        for k in range(rng.randint(1, 4)):
            article, paragraph, letter = rng.random() < 0.4, rng.random() < 0.7, rng.random() < 0.3
            said = []
            if article:
                home = str(rng.randint(1, 99))
                said.append(f"{rng.choice(['Pasal', 'Pasal Pasal', 'Pasai'])} {home}")
            number, item = str(rng.randint(1, 30)), rng.choice("bcdefg")
            if paragraph or not article:
                said.append(f"{rng.choice(['ayat', 'ayal', 'ayat ayat'])} ({number.replace('1', 'l') if rng.random() < 0.3 else number})")
                if letter:
                    said.append(f"huruf {item}")
                wanted.append((home, number, item if letter else None))
            parts.append(" ".join(said))
            if article and not paragraph:
                wanted.append((home, None, None))
                break  # an article alone is one only where the chain ends
        cases.append(("dalam " + rng.choice([" dan ", " atau "]).join(parts), wanted))
    got = rows([(i, s, "9") for i, (s, _) in enumerate(cases)], "i int, s string, c string").select("i", crossref.read_targets(F.col("s"), F.col("c")).alias("t")).sort("i").collect()
    for r, (span, wanted) in zip(got, cases, strict=True):
        assert [(t.pasal, t.ayat, t.huruf) for t in r["t"]] == wanted, span


def _plain_lookup(units, key):
    """The text of the deepest unit that is there, and whether it is the one asked for."""
    doc, pasal, ayat, huruf = key
    own, para = units.get((doc, pasal, None, None)), units.get((doc, pasal, ayat, None)) if ayat else None
    if own is None:
        return None, False
    letter = units.get((doc, pasal, ayat, huruf)) if huruf and (ayat is None or para is not None) else None
    text = letter or para or own
    return text, (ayat is None or para is not None) and (huruf is None or letter is not None)


def test_lookup_fetches_texts_last(spark, rows):
    rng = random.Random(2)
    key = lambda: (rng.choice("de"), str(rng.randint(1, 4)), rng.choice([None, "1", "2", "3"]), rng.choice([None, "a", "b"]))
    units = {k: f"text of {k}" for k in (key() for _ in range(60))}
    asked = [key() for _ in range(200)] + [(None, "1", None, None), ("d", None, None, None)]
    schema = "doc_id string, pasal string, ayat string, huruf string"
    targets = rows([(*k, i) for i, k in enumerate(asked)], f"{schema}, found_ayat int").withColumnRenamed("found_ayat", "n")
    found = crossref.lookup(targets, rows([(*k, t) for k, t in units.items()], f"{schema}, text string"))
    assert {r["n"]: (r["found_text"], r["exact"]) for r in found.collect()} == {i: _plain_lookup(units, k) for i, k in enumerate(asked)}
    plan = crossref.deepest(targets, rows([(*k, t) for k, t in units.items()], f"{schema}, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.replace("[doc_id", "").split("LogicalRDD")[0]


def test_references_resolve(rows):
    units = rows([("D", "5", None, None, "lima"), ("D", "5", "1", None, "lima satu"), ("D", "5", "1", "a", "lima satu a")], "doc_id string, pasal string, ayat string, huruf string, text string")
    text = "Hal sebagaimana dimaksud dalam Pasal 5 ayat (1) huruf a. Hal sebagaimana diatur dalam Pasal 5 ayat (7). Hal sebagaimana dimaksud pada ayat (2). Hal sebagaimana dimaksud dalam undang-undang mengenai pajak. Hal sebagaimana telah diubah dengan X. Hal sebagaimana dimaksud di sana."
    got = crossref.resolve(rows([("D", "9", text)], "doc_id string, pasal string, text string"), units).orderBy("ref_no").collect()
    assert [r.status for r in got] == ["cross_pasal", "cross_pasal", "same_pasal", "external", "amendment_history", "unresolved"]
    assert [r.needs_review for r in got] == [False, True, False, False, False, True]
    assert got[0].targets[0].text == "lima satu a" and got[1].targets[0].text == "lima"
    assert all(text[r.start : r.end] == r.phrase for r in got)


def test_verdicts(rows):
    cats = rows([("hiburan", "Hiburan", None), ("bar", "Bar", "hiburan"), ("spa", "Spa", "hiburan"), ("pijat", "Pijat", None), ("listrik", "Listrik", None)], "id string, label string, parent string")
    norms = rows(
        [
            ("U1", 0, "U", 3, "rate_constraint", ["*"], True, None, None), ("U2", 1, "U", 3, "rate_constraint", ["hiburan"], False, None, None), ("U4", 2, "U", 3, "delegation", ["*"], None, ["U1", "U2"], None),
            ("L1", 3, "L", 7, "rate_constraint", ["bar", "pijat"], False, None, ["dll"]), ("L2", 4, "L", 7, "rate_constraint", ["listrik"], False, None, []),
        ],
        "norm string, ord int, instrument string, rank int, norm_type string, applies_to array<string>, is_residual boolean, delegated_scope array<string>, open_textured_terms array<string>",
    )
    bounds = rows([("U1", 0, "<=", 0.1), ("U2", 0, ">=", 0.4), ("U2", 1, "<=", 0.75), ("L1", 0, "==", 0.5), ("L2", 0, "==", 0.03)], "norm string, ord int, op string, value double")
    got = conflict.verdicts(norms, bounds, cats, rows([("dll", "x")], "id string, label string"), "U", "L")
    assert {r.category: (r.verdict, r.witness, r.resolution, r.authorised_by, r.national_via_residual) for r in got.collect()} == {
        "bar": ("COMPLIANT", 0.5, None, "U4", False),
        "pijat": ("CONFLICT", None, "lex_superior", None, True),
        "listrik": ("COMPLIANT", 0.03, None, "U4", True),
    }
    assert {r.category: r.caveat for r in got.collect()} == {"bar": ["dll"], "pijat": ["dll"], "listrik": None}
    assert {r.verdict: r.n for r in conflict.tally(got, rows([("dll",)], "id string")).collect()} == {"COMPLIANT": 2, "CONFLICT": 1, "ABSTAIN": 1}


def test_closure_ends_on_cycles(rows):
    got = conflict.closure(rows([("a", "b"), ("b", "a"), ("c", "b"), ("d", "gone")], "id string, parent string"))
    assert {(r.id, r.ancestor) for r in got.collect()} == {("a", "a"), ("a", "b"), ("b", "b"), ("b", "a"), ("c", "c"), ("c", "b"), ("c", "a"), ("d", "d")}


def test_open_interval(rows):
    b = rows([("x", "n", 0, "<", 0.4), ("x", "m", 1, ">=", 0.4), ("y", "n", 0, ">", 0.2)], "k string, norm string, ord int, op string, value double")
    assert {r.k: (r.sat, r.witness) for r in conflict.interval(b, ["k"]).collect()} == {"x": (False, None), "y": (True, pytest.approx(0.6))}


def test_gate(rows):
    c = rows([("a", "sepuluh", "agree", 0.1, None, "10% (sepuluh persen)"), ("b", "lima", None, 0.5, 0.05, "5% (lima persen)"), ("c", "tiga", None, None, None, "kosong")], "case_id string, match_words string, expect_status string, expect_value double, wrong_value double, text string")
    assert {r.case_id: r.verdict for r in calibrate.gate(c).collect()} == {"a": "PASS", "b": "SMOOTHED", "c": "NOT_FOUND"}


def test_open_terms_override_and_no_pair(rows):
    cats = rows([("bar", "Bar", None), ("karaoke", "Karaoke", "bar")], "id string, label string, parent string")
    schema = "norm string, ord int, instrument string, rank int, norm_type string, applies_to array<string>, is_residual boolean, delegated_scope array<string>, open_textured_terms array<string>"
    local = [("L1", 1, "L", 7, "rate_constraint", ["bar"], False, None, ["dll"]), ("L2", 2, "L", 7, "rate_constraint", ["karaoke"], False, None, [])]
    norms = rows([("U1", 0, "U", 3, "rate_constraint", ["bar"], False, None, None), *local], schema)
    bounds = rows([("U1", 0, "<=", 0.1), ("L1", 0, "==", 0.1), ("L2", 0, "==", 0.1)], "norm string, ord int, op string, value double")
    terms = rows([("dll",)], "id string")
    got = {r.category: (r.verdict, r.abstained_on) for r in conflict.verdicts(norms, bounds, cats, terms, "U", "L").collect()}
    assert got == {"bar": ("COMPLIANT", None), "karaoke": ("ABSTAIN", ["dll"])}
    alone = conflict.verdicts(norms.where("instrument = 'L'"), bounds, cats, terms, "U", "L").collect()
    assert {(r.category, r.verdict, r.label) for r in alone} == {("bar", "NO_PAIR", "Bar"), ("karaoke", "NO_PAIR", "Karaoke")}
