from lexloom.operators import layout as L
from lexloom.operators import segment as S

TEXT = """UNDANG-UNDANG
Pasal 1
Dalam aturan ini:
1. satu hal;
2. dua hal.
Pasal 2
(1) Pertama:
a. alpha;
b. beta:
1. x;
2. y;
(2l Kedua.
(3) Ketiga.
Pasal 20
a. aa;
b. bb;
Pasal 18
isi
PENJELASAN
I. UMUM
Pasal 1
Cukup jelas.
LAMPIRAN I
tabel
"""


def _units(rows, text):
    return S.units(rows([("D", text)], "doc_id string, text string")).orderBy("start", "end").collect()


def test_tree_and_offsets(rows):
    got = _units(rows, TEXT)
    assert all(TEXT[u.start : u.end] == u.text for u in got)
    cites = [u.citation for u in got]
    assert cites[:5] == ["Pasal 1", "Pasal 1 angka 1", "Pasal 1 angka 2", "Pasal 2", "Pasal 2 ayat (1)"]
    assert "Pasal 2 ayat (1) huruf b angka 2" in cites and "Pasal 2 ayat (2)" in cites and cites[-1] == "Penjelasan Pasal 1"
    assert {u.citation for u in got if not u.leaf} == {"Pasal 1", "Pasal 2", "Pasal 2 ayat (1)", "Pasal 2 ayat (1) huruf b", "Pasal 20"}


def test_sections_and_numbering_defects(rows):
    d = rows([("D", TEXT), ("E", "tanpa judul"), ("F", ""), ("G", None)], "doc_id string, text string")
    got = {(s.doc_id, s.section) for s in S.sections(d).collect()}
    assert {("D", "body"), ("D", "penjelasan"), ("D", "lampiran"), ("E", "body"), ("F", "body")} <= got
    a = S.section_anomalies(d).collect()
    assert [(x.from_num, x.to_num) for x in a] == [(20, 18)]


def test_restart_without_heading_is_unlabelled(rows):
    text = "\n".join(f"Pasal {i}\nisi" for i in (1, 2, 30, 1, 2))
    d = rows([("D", text)], "doc_id string, text string")
    assert [s.section for s in S.sections(d).orderBy("start").collect()] == ["body", "unlabelled_restart"]
    assert "[bagian tak berlabel] Pasal 1" in [u.citation for u in _units(rows, text)]


def test_runs(rows):
    text = "Pasal 1\n(1) satu\n(2) dua\n(4) empat\n(1) lagi\nPasal 2\n(l) huruf saja\nPasal 3\n(1) a:\na. x\nb. y\na. z\nb. w\nPasal 3\nulang\n"
    got = [u.citation for u in _units(rows, text)]
    assert got.count("Pasal 1 ayat (1)") == 2 and "Pasal 1 ayat (4)" not in got
    assert "Pasal 2 ayat (1)" not in got  # a run of one that needed repair
    assert "Pasal 3 #2" in got
    w = S.unit_warnings(S.units(rows([("D", text)], "doc_id string, text string"))).collect()
    assert {x.warning for x in w} == {"duplicate_pasal_in_section", "multiple_huruf_runs_in_ayat"}


def test_glyph_number_orders_only(rows):
    assert [u.citation for u in _units(rows, "Pasal 69\nx\nPasal 7O\ny\nPasal 71\nz\n")] == ["Pasal 69", "Pasal 7O", "Pasal 71"]


def test_furniture_goes_and_offsets_stay(rows):
    body = lambda i: f"LEMBARAN NEGARA\nisi {i} a\nisi {i} b\nisi {i} c\nisi {i} d\n- {i} -\n"
    pages = rows([("D", i, body(i)) for i in range(1, 5)], "doc_id string, page int, text string")
    got = L.strip_furniture(pages).orderBy("page").collect()
    assert [r.removed for r in got] == [2] * 4
    assert got[0].text == " " * 15 + "\nisi 1 a\nisi 1 b\nisi 1 c\nisi 1 d\n     "
    spans = L.page_spans(L.strip_furniture(pages)).orderBy("page").collect()
    whole = L.join_pages(L.strip_furniture(pages)).first().text
    assert all(whole[s.start : s.end] == r.text for s, r in zip(spans, got, strict=True))


def test_extraction_prefers_a_clean_layer(rows):
    layer = rows([("D", 1, "x" * 40), ("D", 2, "y" * 30 + "\ufffd" * 9), ("D", 3, "")], "doc_id string, page int, text string")
    ocr = rows([("D", 2, "z" * 40)], "doc_id string, page int, text string")
    got = L.extracted_pages(layer, ocr).orderBy("page").collect()
    assert [(r.method, r.classification) for r in got] == [("text_layer", "clean"), ("ocr", "clean"), ("ocr_failed", "empty")]
    assert got[1].replaced_text_layer and not got[0].replaced_text_layer
    t = L.page_tallies(L.extracted_pages(layer, ocr)).first()
    assert t.methods == {"text_layer": 1, "ocr": 1, "ocr_failed": 1} and t.n_pages == 3
