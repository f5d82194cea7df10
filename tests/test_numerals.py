import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions import numerals as N

def spelled(n):
    """The words of a whole number up to 300."""
    ones = {v: k for k, v in N.UNITS.items()}
    if n < 10:
        return [ones[n]]
    if n < 20:
        return ["sepuluh"] if n == 10 else ["sebelas"] if n == 11 else [ones[n - 10], "belas"]
    if n < 100:
        return [ones[n // 10], "puluh", *([ones[n % 10]] if n % 10 else [])]
    head = ["seratus"] if n < 200 else [ones[n // 100], "ratus"]
    return [*head, *(spelled(n % 100) if n % 100 else [])]


def figures(seed, many):
    """(numeral, words, value, status): figures that are built from a value, and
    damaged so that what can be recovered is known: digits by look-alikes, by
    another figure, or by a percent sign that a scan misread (a decimal comma counts
    as a repair), words by lost spaces or a wrong letter."""
    rng = random.Random(seed)
    glyph = dict(zip(N.GLYPH_TO, N.GLYPH_FROM, strict=True))
    out = []
    for _ in range(many):
        whole, part = rng.randint(0, 130), rng.choice((None, None, rng.randint(1, 9)))
        digits = f"{whole}" + (f",{part}" if part else "")
        words = spelled(whole) + (["koma", *spelled(part)] if part else []) + ["persen"]
        other = rng.randint(0, 130)
        hurt_digits, hurt_words = rng.choice(("", "", "glyph", "other")), rng.choice(("", "", "glued", "letter"))
        if hurt_digits == "glyph":
            changed = "".join(glyph.get(c, c) for c in digits)
            hurt_digits = "glyph" if changed != digits else ""
            digits = changed
        elif hurt_digits == "other" and (other != whole or part):
            digits = f"{other}"
        else:
            hurt_digits = ""
        if hurt_words == "glued" and len(words) > 1:
            k = rng.randrange(len(words) - 1)
            words[k : k + 2] = [words[k] + words[k + 1]]
        elif hurt_words == "letter":
            words[rng.randrange(len(words))] = "xqzxqz"
        else:
            hurt_words = ""
        value = whole / 100 + (part or 0) / 1000
        sign = rng.choice(("%", "o/o", "%o", "Zo"))
        d, w = None if hurt_digits == "other" else value, None if hurt_words == "letter" else value
        if hurt_digits == "other":
            d = other / 100
        if d is not None and w is not None:
            same, d_fixed, w_fixed = abs(d - w) < 1e-9, hurt_digits == "glyph" or "," in digits, hurt_words == "glued"
            status = "agree" if same and not d_fixed and not w_fixed else "recovered" if same or d_fixed != w_fixed else "disagree"
            got = d if same else w if d_fixed and not w_fixed else d if w_fixed and not d_fixed else None
        else:
            status, got = "single_channel", d if w is None else w
        out.append((digits + sign, " ".join(words), got, status))
    return out


def test_recover(rows):
    made = figures(5, 400)
    assert {s for *_, s in made} == {"agree", "recovered", "disagree", "single_channel"}
    table = rows([(i, n, w) for i, (n, w, _, _) in enumerate(made)], "i int, n string, w string")
    for r in table.select("i", N.recover(F.col("n"), F.col("w")).alias("r")).collect():
        _, _, value, status = made[r.i]
        assert r.r.status == status, made[r.i]
        assert r.r.value == (None if value is None else pytest.approx(value)), made[r.i]
        assert r.r.ocr_recovered == (status in ("recovered", "single_channel"))
        assert r.r.needs_review == (status == "disagree")


def test_neither_reading_parses(rows):
    r = rows([("?", "kata")], "n string, w string").select(N.recover(F.col("n"), F.col("w")).alias("r")).first().r
    assert (r.status, r.value, r.needs_review) == ("unparsed", None, True)


def test_durations_keep_their_day_type(rows):
    data = [("l2", "dua belas", "bulan", 12, "bulan"), ("15", "lima belas", "hari  kalender", 15, "hari_kalender"), ("7", "tujuh", "Hari Kerja", 7, "hari_kerja"), ("1001", "seribu", "hari", None, "hari")]
    out = rows(data, "n string, w string, u string, v int, e string").select("v", "e", N.recover_duration(F.col("n"), F.col("w"), F.col("u")).alias("r")).collect()
    assert [(r.r.value, r.r.unit) for r in out] == [(r.v, r.e) for r in out]


def test_scan_gives_offsets_in_order(rows):
    t = "Tarif 10% (sepuluh persen), 4Oo/o (empat puluh persen) dalam 12 (dua belas) bulan; 1,500,000\n (lima) hari; 7\n (tujuh) Hari kerja."
    found = rows([(t,), ("",), (None,)], "t string").select(N.scan(F.col("t")).alias("s")).collect()
    assert [(m.value, m.unit) for m in found[0].s] == [(0.1, "fraction"), (0.4, "fraction"), (12.0, "bulan"), (7.0, "hari_kerja")]
    assert all(t[m.start : m.end] == m.matched_text for m in found[0].s)
    assert found[1].s == [] and found[2].s is None


def _plain_int(tokens):
    total = now = 0
    for t in tokens:
        if t in N.UNITS:
            now = N.UNITS[t]
        elif t in ("sepuluh", "sebelas"):
            now = {"sepuluh": 10, "sebelas": 11}[t]
        elif t == "belas":
            now += 10
        elif t in ("seratus", "puluh", "ratus"):
            total += 100 if t == "seratus" else (now or 1) * {"puluh": 10, "ratus": 100}[t]
            now = 0
    return total + now


def test_number_words_against_a_plain_fold(rows):
    rng = random.Random(3)
    words = [w for w in N.VOCABULARY if w not in ("koma", "persen")]
    data = [[rng.choice(words) for _ in range(rng.randint(0, 5))] for _ in range(200)]
    got = rows([(d,) for d in data], "t array<string>").select(N.int_from(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [_plain_int(d) for d in data]


def test_single_character_damage_never_makes_another_word(rows):
    data = [(w, w[:i] + c + w[i + 1 :]) for w in N.VOCABULARY for i in range(len(w)) for c in "abcdefghijklmnopqrstuvwxyz" if w[i] != c]
    got = rows(data, "w string, t string").select("w", N.snap(F.col("t")).alias("s")).collect()
    wrong = [r for r in got if r.s.words and r.s.words[0] != r.w]
    assert not [r for r in wrong if N.UNITS.get(r.s.words[0], -1) != N.UNITS.get(r.w, -1)]


def _matches(rng, top):
    out, at = [], 0
    while True:
        at += rng.randint(0, 6)
        end = at + rng.randint(1, 8)
        if end > top:
            return out
        out.append((at, end, ""))
        at = end


def test_matches_that_overlap_none_of_another_list(rows):
    rng = random.Random(6)
    cases = [(_matches(rng, rng.randint(0, 80)), _matches(rng, rng.randint(0, 80))) for _ in range(150)]
    kind = "array<struct<start:int,end:int,text:string>>"
    got = rows([(i, *c) for i, c in enumerate(cases)], f"i int, a {kind}, b {kind}").select("i", N.apart(F.col("a"), F.col("b")).alias("x")).sort("i").collect()
    expected = [[m for m in a if not any(m[0] < o[1] and o[0] < m[1] for o in b)] for a, b in cases]
    assert [[tuple(m) for m in r["x"]] for r in got] == expected


def test_ten_thousand_overlaps_in_one_text(rows):
    text = "Tarif 5 7o (lima persen) hari kerja dalam 3 (tiga) bulan. " * 5000
    found = rows([(text,)], "text string").select(F.explode(N.scan(F.col("text"))).alias("m")).groupBy("m.unit").count().collect()
    assert {tuple(r) for r in found} == {("fraction", 5000), ("bulan", 5000)}


def test_snap_equals_distances_to_all_words(rows):
    rng = random.Random(9)
    letters = "abdegihklmnoprstuy"
    tokens = {t for w in N.VOCABULARY for i in range(len(w)) for t in (w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:])} | {"", "x", "kata"}
    plain = F.filter(F.array(*map(F.lit, N.VOCABULARY)), lambda w: F.levenshtein(F.col("t"), w) == 1)
    got = rows([(t,) for t in sorted(tokens)], "t string").select("t", plain.alias("near"), N.snap(F.col("t"))["words"].alias("words")).collect()
    values = {**N.UNITS, **N.SPECIAL}
    for r in got:
        assert r["words"] == (r["near"][:1] if len({values.get(w, -1) for w in r["near"]}) == 1 else []), r


def test_figures_by_row_are_those_of_scan(rows):
    texts = [
        "Tarif paling tinggi 5% (lima persen).", "\U0001f600 Tarif lO% (sepuluh persen).", "Tarif 7o/o (tujuhpersen).", "Tarif SOO% (lima persen).", "1.15 (lima) hari, 15 (lima belas) hari kerja",
        "Tarif 5% (lima persen) dan 1O% (sepuluh persen).", "Tarif 5 7o (lima persen) hari kerja.", "dalam l5 (lima belas) hari", "dalam 3 (Tiga) Hari  Kerja", "Tarif 5% (LIMA PERSEN).", "Ketentuan.", "", None,
    ]
    table = rows(list(enumerate(texts)), "k int, text string")
    listed = table.select("k", F.posexplode(N.scan(F.col("text"))).alias("i", "m")).select("k", "i", "m.*")
    by_row = N.scanned(table, "k")
    got = sorted(by_row.select("k", "i", "m.*").collect())
    assert got == sorted(listed.collect()) and len({r.k for r in got}) == 9
    # a filter on a record stays above it, and each figure is read once
    plan = by_row.where("m.status = 'recovered'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(array(") == 1 and plan.index("recovered") < plan.index("explode(array(")
