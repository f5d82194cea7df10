import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from lexloom.llm import boosting, components, decontaminate, langid, language_model, near_dup, quality
from lexloom.llm.langid import SuffixAutomaton

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, root string, list string, leaked string, kept string"


def _docs(rows, pairs):
    return rows([(i, t, "en", "s", 0, "x", "x", "x", "x", "x") for i, t in pairs], DOCS)


def _near_copies(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    out = []
    for i in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy = copy[:5] + common + copy[5:]
            out.append(" ".join(copy))
    return out + ["", None, "  \n", "one", "one", "ONE two", "one two three four", "one two three four five"] + [out[3]] * 9


def test_near_duplicates_against_all_pairs(rows):
    rng = random.Random(11)
    texts = _near_copies(rng)
    pairs = [(3 * i % 1009, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.classes(_docs(rows, pairs)).collect()}
    assert got == brute.classes(pairs)
    kept = {r.doc_id for r in near_dup.one_of_each(_docs(rows, pairs + pairs[:3])).collect()}
    assert kept == {i for i, (_, c) in brute.classes(pairs).items() if c == i}


def test_near_duplicates_of_nothing(rows):
    assert near_dup.classes(_docs(rows, [])).collect() == []
    got = near_dup.classes(_docs(rows, [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")])).collect()
    assert sorted(r.component_id for r in got) == [4, 4, 4]


def test_components(rows):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components.components(rows(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100}


def test_base_scores_and_probabilities(rows):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["The", "the", "of", "and", f"w{rng.randint(0, 60)}"]) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    pairs = [*enumerate(texts), (500, None), (501, "")]
    got = {r.doc_id: r for r in language_model.scores(_docs(rows, pairs), language_model.learnt()).collect()}
    tokens = {i: [*brute.words(t), "\n"] for i, t in pairs}
    c = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        assert got[i].n_tokens == len(ws) and got[i].n_known == sum(c[w] > 0 for w in ws) and got[i].train_tokens == n
        assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    # the model, read plainly
    teach = [ws for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    two = Counter(g for ws in teach for g in zip(["^", *ws], ws, strict=False))
    three = Counter(g for ws in teach for g in zip(["^", "^", *ws], ["^", *ws], ws, strict=False))
    c["^"] = c["\n"]

    def p1(w):
        return (c[w] - language_model.DISCOUNT) / n if c[w] else language_model.DISCOUNT * v / n

    def p2(a, w):
        mu = language_model.PRIORS[0]
        return (two[a, w] + mu * p1(w)) / (c[a] + mu)

    def p3(a, b, w):
        mu = language_model.PRIORS[1]
        return p2(b, w) if a == b == "^" else (three[a, b, w] + mu * p2(b, w)) / (two[a, b] + mu)

    vocabulary = [w for w in c if w != "^"]
    for a, b in (("^", "the"), ("the", "of"), ("of", "and")):
        assert sum(p3(a, b, w) for w in vocabulary) + p3(a, b, "unseen") == pytest.approx(1)
    for i, ws in tokens.items():
        assert got[i].score == pytest.approx(sum(math.log10(p3(a, b, w)) for a, b, w in zip(["^", "^", *ws], ["^", *ws], ws, strict=False)))
    assert language_model.scores(_docs(rows, []), language_model.learnt()).collect() == []
    alone = language_model.scores(_docs(rows, [(1, "a b"), (1, "a b"), (None, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.score) for r in alone) == [(0, 1, 0, 0.0), (1, 3, 0, 0.0), (1, 3, 0, 0.0)]


def test_lanes_of_the_traversal_join(rows, monkeypatch):
    rng = random.Random(6)
    texts = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 200)))) for i in range(60)]
    docs = _docs(rows, texts)
    whole = {r.doc_id: r.score for r in language_model.scores(docs, language_model.learnt()).collect()}
    ids, sizes = language_model._tokens([t for _, t in texts])
    words, code = np.unique(ids, return_inverse=True)
    counts = [np.unique(g, return_counts=True)[1] for g in language_model._grams(ids, sizes)]
    got = []
    for lane in (3, 256):
        monkeypatch.setattr(language_model, "LANE", lane)
        got.append(language_model._score_block([t for _, t in texts], counts, len(ids), len(words))[3])
    assert got[0] == pytest.approx(got[1]) and len(whole) == 60


def test_model_beats_the_base_on_held_out_texts(spark, small):
    got = language_model.scores(spark.read.parquet(f"{small}/documents.parquet"), language_model.learnt()).where("not learnt").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_quality_counts(spark, small, rows):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = _docs(rows, [(-1, None), (-2, ""), (-3, "a\n\n a\na\nb \nb "), (-4, "x " * 500), (-5, "a b c d e f a b c d e f")]).select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    scored, name = quality.with_quality(docs.unionByName(odd), model)
    for r in scored.select("doc_id", "text", f"{name}.*").collect():
        want = brute.quality_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored, name = quality.with_quality(docs.select("doc_id", "text"), quality.fit(docs, labels))
    got = scored.join(labels, "doc_id").select("quality", f"{name}.kept").collect()
    low, good = [r.kept for r in got if not r.quality], [r.kept for r in got if r.quality]
    assert sum(low) <= 0.05 * len(low) and sum(good) >= 0.8 * len(good)


def test_toxic_texts_are_found_in_every_language(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    model = quality.fit(docs.select("doc_id", "text"), labels.where(~held))
    got = docs.join(labels.where(held), "doc_id").select("text", "lang", "toxic").collect()
    x = quality.statistics([r.text or "" for r in got], model.markers)[1]
    toxic = model.toxic.probability(x) > 0.5
    for lang in ("en", "fr", "de", "es"):
        found = [t for t, r in zip(toxic, got, strict=True) if r.lang == lang and r.toxic]
        clean = [t for t, r in zip(toxic, got, strict=True) if r.lang == lang and not r.toxic]
        assert sum(found) >= 0.9 * len(found) > 0 and sum(clean) <= 0.01 * len(clean)


def test_verdicts_against_a_plain_reading(spark, rows, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    odd = rows([(1, "other text of the same id"), (None, "no id"), (77777, None)], "doc_id long, text string")
    some = docs.select("doc_id", "text").unionByName(odd)
    labels = labels.unionByName(rows([(1, None, 1), (None, 0, 0), (5, 0, None)], "doc_id long, quality int, toxic int"))
    model, again = quality.fit(some, labels), quality.fit(some.repartition(7).orderBy(F.rand(3)), labels)
    scored, name = quality.with_quality(some.withColumn("quality_rules", F.lit(1)), model)
    assert name == "_quality_rules"
    for r in scored.select("text", f"{name}.*").collect():
        x = brute.quality_features(r.text, model.markers)
        assert r.kept == (not r.base_failed and all(brute.tree_chance(t, x) <= 0.5 for t in (model.low, model.toxic)))
    assert all((getattr(model.low, k) == getattr(again.low, k)).all() and (getattr(model.toxic, k) == getattr(again.toxic, k)).all() for k in ("feature", "threshold", "value"))
    assert model.markers == again.markers


def test_quality_without_labels(spark, rows):
    docs = _docs(rows, [(1, " ".join(f"w{i}" for i in range(50))), (2, None)])
    model = quality.fit(docs, rows([], "doc_id long, quality int, toxic int"))
    scored, name = quality.with_quality(docs, model)
    assert {r.doc_id: r.k for r in scored.select("doc_id", F.col(f"{name}.kept").alias("k")).collect()} == {1: True, 2: False}


def test_trees_obey_their_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.2 * rng.standard_normal(2000) > 0.5).astype(float)
    trees = boosting.fit(x, y, np.array([1, -1, 0]))
    grid = np.full((50, 3), 0.5)
    grid[:, 0] = np.linspace(0, 1, 50)
    assert (np.diff(trees.probability(grid)) >= -1e-12).all()
    grid[:, 0], grid[:, 1] = 0.5, np.linspace(0, 1, 50)
    assert (np.diff(trees.probability(grid)) <= 1e-12).all()
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.75


def test_suffix_automaton_knows_all_substrings():
    rng = random.Random(4)
    s = [rng.randint(1, 3) for _ in range(60)]
    made = SuffixAutomaton(s)
    arcs = langid.Arcs(made.source * 4 + made.symbol, made.target)
    assert len(made.source) <= 3 * len(s)
    parts = {tuple(s[i:j]) for i in range(60) for j in range(i + 1, 61)}

    def known(t):
        state = 0
        for c in t:
            state = int(arcs.find(np.array([state * 4 + c]))[0])
            if state < 0:
                return False
        return True

    assert all(known(p) for p in parts)
    assert all(known(t) == (tuple(t) in parts) for t in ([rng.randint(1, 3) for _ in range(rng.randint(1, 8))] for _ in range(500)))


def test_phrases_are_the_greedy_longest_matches():
    model = langid.LanguageModel({"a": "abab cad abra", "b": "xyz zyx xyzzy"})
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdxyz q1") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += ["".join(rng.choice(("abab", " cad", "xyz", "zyx", "q", "7")) for _ in range(900)), "abab" * 2000, "q" * 3000]
    got, _ = model.phrases(texts)

    def plain(text, sample):
        t = "".join(map(chr, langid.normal([text])[0]))
        s = "".join(map(chr, langid.normal([sample])[0]))
        n = i = 0
        while i < len(t):
            k = 1
            while i + k <= len(t) and t[i : i + k] in s:
                k += 1
            i += max(1, k - 1)
            n += 1
        return n

    want = [[plain(t, model.samples[x]) for x in "ab"] for t in texts]
    assert got.tolist() == want
    # prediction and score, read plainly
    langs, score = model.predict(texts)
    for t, need, lang, p in zip(texts, want, langs, score, strict=True):
        n = len(langid.normal([t])[0])
        rate = [k * math.log2(len(langid.normal([model.samples[x]])[0])) / n for k, x in zip(need, "ab", strict=True)] if n else []
        assert lang == ("ab"[rate.index(min(rate))] if n else "und")
        assert p == pytest.approx(1 - min(rate) / max(rate) if n else 0)


def test_many_letters_take_little_memory():
    rng = random.Random(3)
    samples = {f"l{k}": "".join(chr(0x4E00 + 4000 * k + rng.randrange(4000)) for _ in range(16384)) for k in range(4)}
    model = langid.LanguageModel(samples)
    arcs = model.automata[2]
    assert arcs.keys.nbytes + arcs.targets.nbytes < 64 << 20
    assert model.predict([samples[f"l{k}"][99:300] for k in range(4)])[0] == ["l0", "l1", "l2", "l3"]


def test_equal_shares():
    assert langid.equal_shares([5, 100, 100], 65) == [5, 30, 30]
    assert langid.equal_shares([5, 7], 65) == [5, 7] and langid.equal_shares([], 5) == []


def test_language_with_a_column_of_its_name(rows):
    docs = rows([(1, "hello there", "en", "mine"), (None, None, None, None), (1, "hello there", "en", "mine")], "doc_id long, text string, lang string, language string")
    scored, name = langid.with_language(docs, langid.fit(docs))
    assert name != "language" and scored.columns == [*docs.columns, name]
    assert sorted((r.language or "", r[name].lang_pred) for r in scored.collect()) == [("", "und"), ("mine", "en"), ("mine", "en")]


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored, name = langid.with_language(docs.select("doc_id", "text", "lang"), langid.fit(docs, langid.held_out()))
    got = scored.where(langid.held_out()).select("lang", f"{name}.*").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_language_of_nothing(rows):
    docs = _docs(rows, [(1, None), (2, "12 %"), (3, "hello")])
    scored, name = langid.with_language(docs, langid.LanguageModel({}))
    assert {r.p for r in scored.select(F.col(f"{name}.lang_pred").alias("p")).collect()} == {"und"}
    scored, name = langid.with_language(docs, langid.fit(docs))
    assert {r.doc_id: r.p for r in scored.select("doc_id", F.col(f"{name}.lang_pred").alias("p")).collect()} == {1: "und", 2: "und", 3: "en"}


QUESTION = "Alice Brown bought 12 apples for 30 dollars and then gave 4 apples to Robert before she went home on Monday"


def test_reparameterised_questions(rows):
    docs = _docs(
        rows,
        [
            (1, "intro here. Carol Smith bought 15 apples for 45 dollars and then gave 6 apples to Peter before she went home on Friday. more"),
            (2, QUESTION), (3, "something else entirely " * 20), (4, None), (5, ""),
            (6, "Alice Brown bought 12 apples for 30 dollars today"),
            (7, QUESTION.upper()), (2, QUESTION),
        ],
    )
    bench = rows([(7, QUESTION, "x"), (8, None, "x"), (9, "too short", "x"), (7, QUESTION, "x"), (None, QUESTION, "x")], "item_id long, text string, h string")
    for limit in (decontaminate.SENT_HASHES, 0):
        got = {(r.doc_id, r.item_id): r.renamed for r in decontaminate.matches(docs, bench, limit).collect()}
        assert got[1, 7] and not got[2, 7] and {k[0] for k in got} <= {1, 2, 7}
    assert {r.doc_id for r in decontaminate.without_matches(docs, bench).collect()} >= {3, 4, 5, 6}
    assert decontaminate.matches(_docs(rows, []), bench).collect() == []
    assert decontaminate.matches(docs, bench.limit(0)).collect() == []


def test_inconsistent_renaming_is_no_match(rows):
    item = "Anna has 5 coins and Ben takes 5 coins then Anna has 5 coins fewer than Ben who has 5 coins"
    doc = "Anna has 1 coins and Ben takes 2 coins then Anna has 3 coins fewer than Ben who has 4 coins"
    assert decontaminate.matches(_docs(rows, [(1, doc)]), rows([(1, item)], "item_id long, text string")).collect() == []


def test_each_occurrence_is_judged_alone(rows):
    first = "Carol Smith bought 15 apples for 45 dollars and then gave 6 apples to Peter before she went home on Friday"
    second = "Dora Jones bought 17 apples for 51 dollars and then gave 8 apples to Oscar before she went home on Sunday"
    start, end = "so bought 1 apples for 2 dollars and then gave 3 apples", "filler words stand here " * 30
    docs = [
        (1, f"first, {QUESTION}. then, {first}."), (2, f"first, {first}. then, {second}. last, {first.replace('15', '99')}."),
        (3, f"first, {QUESTION}. " + "".join(f"{end} so x bought {i} apples for {i + 1} dollars and then gave {i} apples. " for i in range(40))),
        (4, f"so 9 apples for 2 dollars and then gave 3 apples {end} to Peter before she went home on Friday"),
    ]
    bench = rows([(7, QUESTION)], "item_id long, text string")
    for limit in (decontaminate.SENT_HASHES, 0):
        got = {r.doc_id: r.renamed for r in decontaminate.matches(_docs(rows, docs), bench, limit).collect()}
        assert got == {1: False, 2: True, 3: False}


def test_verbatim_parts_and_short_items_match(rows):
    long = QUESTION + " and the shop that sold them had closed early because of heavy snow in the valley while nobody was looking at all"
    dense = "On 3 May 1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    docs = [
        (1, "so " + " ".join(long.split()[-13:]) + " end"), (2, "so " + " ".join(long.split()[-12:]) + " end"), (3, f"see. {dense} there"),
        (4, "what is the Capital of France, asked she"), (5, "what is the capital of Spain"), (6, "x " + " ".join(QUESTION.split()[:13])),
    ]
    bench = rows([(7, long), (8, dense), (9, "Capital of France?"), (10, "..."), (11, "")], "item_id long, text string")
    for limit in (decontaminate.SENT_HASHES, 0):
        got = decontaminate.matches(_docs(rows, docs), bench, limit).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (3, 8), (4, 9), (6, 7)] and not any(r.renamed for r in got)


def test_rows_and_items_are_told_apart_by_their_texts(rows):
    other = "Which of the seven hills of the old town is the highest above the river that runs below the walls"
    docs = _docs(rows, [(1, f"a {QUESTION} b"), (1, f"a {QUESTION} b"), (1, "clean text of the same id"), (1, f"x {other}"), (None, f"c {QUESTION}"), (None, "clean text without an id"), (2, None)])
    bench = rows([(7, QUESTION), (7, other), (7, other), (None, "an item that has no id, called Zanzibar Quokka")], "item_id long, text string")
    more = _docs(rows, [(3, "this is an item that has no id, called Zanzibar Quokka, here")])
    for limit in (decontaminate.SENT_HASHES, 0):
        got = [(r.doc_id, r.item_id) for r in decontaminate.matches(docs.union(more), bench, limit).collect()]
        assert sorted(got, key=str) == sorted([(1, 7), (1, 7), (1, 7), (None, 7), (3, None)], key=str)
        left = decontaminate.without_matches(docs.union(more), bench, limit)
        assert left.columns == docs.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "clean text without an id"), (1, "clean text of the same id"), (2, "")]


def test_both_joins_find_the_planted_passages(spark):
    d = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    held = [(r.doc_id, b.item_id) for r in docs.select("doc_id", "text").collect() for b in bench.collect() if b.text in r.text]
    for limit in (decontaminate.SENT_HASHES, 0):
        assert sorted((r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, limit).collect()) == sorted(held)


def _questions(rng, n):
    """Question templates with slots, each with two fillings."""
    vocabulary = [f"{a}{b}" for a in ("ba", "ko", "mi", "ren", "sul", "tor") for b in ("lim", "dar", "ven", "sop", "ket", "nu")]
    out = []
    for _ in range(n):
        parts = [rng.choice(("number", "unit", "name", "word", "word", "word")) for _ in range(rng.randint(9, 24))]
        said = [rng.choice(vocabulary) for _ in parts]
        fill = []
        for _ in range(2):
            numbers = rng.sample(range(2, 99), len(parts))
            names = rng.sample(["Anna", "Bela", "Carl", "Dora", "Emil", "Fred", "Gina", "Hans", "Iris", "Jana", "Karl", "Lena", "Mark", "Nora", "Otto", "Paul", "Rosa", "Sven", "Tina", "Udo", "Vera", "Willi", "Xenia", "Yann"], len(parts))
            words = [str(numbers[i]) if p == "number" else f"{numbers[i]} km" if p == "unit" else names[i] if p == "name" else said[i] for i, p in enumerate(parts)]
            fill.append("What " + " ".join(words) + "?")
        out.append(fill)
    return out


@pytest.mark.parametrize("text", ["the " * 3000, "abab" * 4000 + " x", "ab cad " * 2500, "xyzzy" * 3000 + "the a" * 900, "a" * 9000])
def test_repetitive_texts_in_lanes(monkeypatch, text):
    """A text in lanes needs the phrases of one lane."""
    samples = {"a": "abab cad abra the other the then", "b": "xyz zyx xyzzy", "c": "the the the the a a a"}
    in_lanes = langid.LanguageModel(samples).phrases([text, "the cad", text[5:]])
    monkeypatch.setattr(langid, "LANE", 1 << 20)
    whole = langid.LanguageModel(samples).phrases([text, "the cad", text[5:]])
    assert in_lanes[0].tolist() == whole[0].tolist()


def test_megabytes_of_one_word_take_seconds():
    model = langid.LanguageModel({"a": "the other then this and that " * 500, "b": "le la les et que " * 500})
    began = time.time()
    assert model.predict(["the " * 1_250_000])[0] == ["a"]
    assert time.time() - began < 60


def test_decontamination_against_a_plain_reading(rows):
    rng = random.Random(31)
    asked = _questions(rng, 25)
    filler = lambda: " ".join(rng.choice(("stone", "river", "lamp", "Oslo", "7", "green", "and", "km", "went.")) for _ in range(rng.randint(0, 25)))
    docs = [(i, f"{filler()} {rng.choice(rng.choice(asked))} {filler()} {' '.join(rng.choice(rng.choice(asked)).split()[3:12])}") for i in range(60)]
    docs += [(7, docs[7][1]), (None, docs[3][1]), (99, None), (98, "")]
    items = [(i, q[0]) for i, q in enumerate(asked)] + [(40, "How far is it to Rome?"), (41, "What?"), (42, "A train goes 60 km in 2 hours and 90 km in 3 hours"), (43, None)]
    docs += [(50, "So: A train goes 60 km in 2 hours and 90 km in 3 hours."), (51, "ask. A train goes 50 km in 4 hours and 80 km in 5 hours. yes"), (52, "how far is it to Rome"), (53, "how far is it to Bonn")]
    want = sorted(brute.leaks(docs, items, decontaminate), key=str)
    assert {(50, 42), (51, 42), (52, 40)} <= {w[:2] for w in want}
    bench = rows(items, "item_id long, text string")
    for limit in (decontaminate.SENT_HASHES, 0):
        got = [(r.doc_id, r.item_id, r.covered, r.renamed) for r in decontaminate.matches(_docs(rows, docs), bench, limit).collect()]
        assert sorted(got, key=str) == want


def test_recall_of_reparameterised_items(rows):
    rng = random.Random(5)
    asked = _questions(rng, 200)
    docs = _docs(rows, [(i, f"Some text before it. {q[1]} And some after.") for i, q in enumerate(asked)])
    bench = rows([(i, q[0]) for i, q in enumerate(asked)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert sum((i, i) in got for i in range(200)) >= 0.9 * 200
    assert sum(a != b for a, b in got) <= 2


# Sentences that open with a name, in four languages: what stands around names and numbers.
_SENTENCES = (
    ("has {} red pens.", "gave {} of them away.", "bought {} more in town.", "How many are there?"),
    ("a {} stylos rouges.", "en donne {} aux autres.", "en prend {} de plus.", "Combien y en a-t-il?"),
    ("hat {} rote Stifte.", "gibt {} davon weg.", "kauft {} mehr dazu.", "Wie viele sind es?"),
    ("tiene {} plumas rojas.", "regala {} de ellas.", "compra {} en la plaza.", "Cuantas hay ahora?"),
)


def test_recall_of_items_that_open_with_names(rows):
    """Short sentences with a name at their start, asked again with others."""
    rng = random.Random(8)
    names = [a + b for a in ("An", "Be", "Ka", "Lo", "Mi", "Ro", "So", "Ти", "Но", "Λυ") for b in ("ra", "lf", "sel", "no")]
    asked = []
    for n in range(200):
        said = _SENTENCES[n % 4]
        shape = [rng.randrange(3) for _ in range(rng.randint(3, 5))]
        things = ["th" + "".join(chr(97 + int(x)) for x in f"{n:03}{k}") for k in range(len(shape))]
        fill = []
        for _ in range(2):
            who, many = rng.sample(names, len(shape)), rng.sample(range(2, 99), len(shape))
            fill.append(" ".join(f"{w} {said[k].format(m)[:-1]} {t}." for w, m, k, t in zip(who, many, shape, things, strict=True)) + " " + said[3])
        asked.append(fill)
    docs = _docs(rows, [(i, f"Some text before it. {q[1]} And some after.") for i, q in enumerate(asked)])
    bench = rows([(i, q[0]) for i, q in enumerate(asked)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert sum((i, i) in got for i in range(200)) >= 0.9 * 200
    assert sum(a != b for a, b in got) <= 2
    one = "Tom has 5 red pens. Ann has 7 red pens. Bob has 9 red pens. How many are there?"
    again = "So. Eva has 3 red pens. Udo has 8 red pens. Kim has 2 red pens. How many are there?"
    assert [(r.item_id, r.renamed) for r in decontaminate.matches(_docs(rows, [(1, again)]), rows([(1, one)], "item_id long, text string")).collect()] == [(1, True)]


def test_different_texts_of_one_id_stay(rows):
    text = lambda k: " ".join(f"{k}{i}" for i in range(30))
    docs = [(1, text("a")), (1, text("b")), (1, text("b")), (2, text("c")), (3, text("c"))]
    assert sorted(tuple(r)[:2] for r in near_dup.one_of_each(_docs(rows, docs)).collect()) == [(1, text("a")), (1, text("b")), (2, text("c"))]


def test_renaming_is_one_to_one(rows):
    item = "Anna has 5 coins and Ben has 6 coins then Carl has 7 coins fewer than Dora who has 8 coins"
    doc = "Anna has 4 coins and Ben has 4 coins then Carl has 4 coins fewer than Dora who has 4 coins"
    assert decontaminate.matches(_docs(rows, [(1, doc)]), rows([(1, item)], "item_id long, text string")).collect() == []
