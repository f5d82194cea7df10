from pyspark.sql import functions as F

from lexloom.operators import conflict, ontology, prefilter, segment, slots
from lexloom.sources import sinks

TEXT = "Pasal 1\n(1) Objek pajak jasa hiburan meliputi:\na. diskotek dan bar;\nb. panti pijat;\n(2) Tarif paling tinggi 10% (sepuluh persen).\nPasal 2\n(1) Khusus bar paling tinggi 5% (lima persen).\n"


def test_stage_outputs(spark, rows, tmp_path):
    docs = rows([("UU_1", TEXT), ("PERDA_2", TEXT)], "doc_id string, text string")
    units = segment.units(docs).cache()
    totals = sinks.write_structure(units, segment.level_counts(units), segment.unit_warnings(units), str(tmp_path / "s")).first()
    assert (totals.documents, totals.pasal, totals.ayat, totals.warnings) == (2, 4, 6, 0)
    back = sinks.structure_records(spark, str(tmp_path / "s")).collect()
    assert {r.doc_id: [(u.citation, u.text) for u in r.units] for r in back} == {d: [tuple(u) for u in units.where(F.col("doc_id") == d).sort("start").select("citation", "text").collect()] for d in ("UU_1", "PERDA_2")}
    assert {p.name for p in (tmp_path / "s").iterdir()} == {"UU_1.json", "PERDA_2.json", "manifest.json"} and back[0].counts["ayat"] == 3
    cats, notes = ontology.harvest(units)
    got = {r.scope: (r.categories, r.ids) for r in sinks.ontology_totals(cats, notes).collect()}
    assert got["national"] == got["local"] == (5, 5)
    live, local = sinks.live_and_local(cats)
    assert live.count() == local.count() == 5
    b = prefilter.prefilter(segment.pasals(docs))
    sinks.write_prefilter(b, prefilter.per_document(b), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p" / "per_document")).where("extract = 2").count() == 2
    assert [r.citation for r in slots.residual_hints(units.where("doc_id = 'UU_1' and level = 'ayat'")).collect()] == ["Pasal 1 ayat (2)"]


def test_report_lines(rows):
    found = rows([("pijat", "CONFLICT", ["A", "B"]), ("bar", "COMPLIANT", None)], "category string, verdict string, core array<string>")
    norms = rows([("A", "UU 1 tentang X", "Pasal 5", 3), ("B", "Perda 2 tentang Y", "Pasal 7", 7)], "norm string, title string, citation string, rank int")
    bounds = rows([("A", "<=", 0.1), ("B", "==", 0.5)], "norm string, op string, value double")
    assert {r.line for r in conflict.core_lines(found, norms, bounds).collect()} == {"UU 1 Pasal 5 tarif <= 10%", "Perda 2 Pasal 7 tarif == 50%"}


def test_closed_reasons(rows):
    assert slots.unknown_reasons(rows([("procedural",), ("other",), (None,)], "reason string")).count() == 2
