import base64
import random
import zlib

import numpy as np
import pytest

from lexloom.llm import bpe, packing
from lexloom.llm import token_counts as counting
from lexloom.llm.token_counts import StateMaps, TokenCounter, scanned, token_counts

SCHEMA = "doc_id long, text string, n_tokens string"


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def _texts():
    rng = random.Random(5)
    letters = "abcdeghij'' \n\t  stmdrvel.,!?#$&0123456789éñ漢字🙂 　ǅ²½"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    out += ["".join(rng.choice("aaab ") for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    return out + ["", "a" * 20000, "ab" * 9000, " " * 5000, "\n" * 700 + "x", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "漢" * 4000, "!?" * 3000, "\x00\x01", "it's we'll they've I'd x'smith '' 's"]


def test_counts_equal_the_library(vocabulary, library):
    texts = _texts()
    assert TokenCounter(vocabulary).count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def _long_texts():
    rng = random.Random(9)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    return [" " * 5_000_000 + "x", "\n" * 5_000_000, "a" * 1_200_000, letters, base64.b64encode(rng.randbytes(900_000)).decode(), "word text \n" * 250_000, "ab" * 5000 + " " + letters[:70_000]]


def test_long_texts_and_a_bounded_machine(vocabulary, library, monkeypatch):
    monkeypatch.setattr(counting, "STATES", 20_000)
    counter = TokenCounter(vocabulary)
    for text in _long_texts():
        assert counter.count([text, "x"]).tolist() == [len(library.encode(text, add_special_tokens=False).ids), 1]
        assert len(counter.machine.states) <= 20_000


def _maps(rng, n, states):
    """Random maps that know every state, in random order and with padding."""
    entry, exit_, count = (np.full((n, states + 2), v) for v in (-1, -1, 0))
    for k in range(n):
        entry[k, :states] = rng.permutation(states)
        exit_[k, :states] = rng.integers(0, states, states)
        count[k, :states] = rng.integers(0, 9, states)
    return StateMaps(entry, exit_, count)


def test_state_maps_compose():
    rng = np.random.default_rng(4)
    a, b, c = (_maps(rng, 7, 5) for _ in range(3))
    left, right = a.then(b).then(c), a.then(b.then(c))
    assert all((getattr(left, x) == getattr(right, x)).all() for x in ("entry", "exit", "count"))
    maps = _maps(rng, 40, 5)
    first = rng.random(40) < 0.2
    first[0] = True
    whole = scanned(maps, first)
    for k in range(40):
        start = max(i for i in range(k + 1) if first[i])
        for j in range(5):
            state, total = int(whole.entry[k, j]), 0
            for i in range(start, k + 1):
                at = maps.entry[i].tolist().index(state)
                state, total = int(maps.exit[i, at]), total + int(maps.count[i, at])
            assert (whole.exit[k, j], whole.count[k, j]) == (state, total)
    with pytest.raises(ValueError):
        a.then(StateMaps(np.full((7, 1), 99), np.zeros((7, 1), int), np.zeros((7, 1), int)))


def test_other_vocabularies_fall_back_on_the_library(vocabulary, library, monkeypatch):
    def never(*_):
        raise bpe.NotFromTheLeft

    counter = TokenCounter(vocabulary)
    monkeypatch.setattr(counter.machine, "move", never)
    assert counter.count(["some words", ""]).tolist() == [len(library.encode("some words").ids), 0]


def test_every_code_point_splits_as_the_library_does(vocabulary, library):
    points = [chr(c) for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}!{c} " for c in points[k : k + 50]) for k in range(0, len(points), 50)]
    assert TokenCounter(vocabulary).count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packed_ids_are_those_of_the_library(vocabulary, library):
    points = [chr(c) for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = _texts() + ["".join(f"a{c}1{c}!{c} " for c in points[k : k + 50]) for k in range(0, len(points), 50)]
    encode = packing.encoder(vocabulary)
    assert [list(encode(t)) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\u3000"])
def test_packing_takes_millions_of_white_space(rows, vocabulary, library, run):
    text = "a" + run * (3_000_000 // len(run)) + "x<|endoftext|> b"
    ids = library.encode(text, add_special_tokens=False).ids
    assert list(packing.encoder(vocabulary)(text)) == ids
    if run == " ":
        _check_packing(packing.pack(rows([(1, text, "x"), (2, "one", "x")], SCHEMA), vocabulary).collect(), {1: [*ids, 2], 2: [*library.encode("one").ids, 2]})


def test_operator_on_odd_rows(rows, vocabulary):
    data = [(1, None, "x"), (2, "", "x"), (None, "one two", "x"), (3, "ä " * 600, None), (3, "ä " * 600, None)]
    got = token_counts(rows(data, SCHEMA), vocabulary).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.over_limit) for r in got) == [(0, 7, False), (1, 0, False), (2, 0, False), (3, 1800, True), (3, 1800, True)]
    assert token_counts(rows([], SCHEMA), vocabulary).collect() == []


def _check_packing(got, ids):
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, want in ids.items():
        parts = sorted(by_doc.pop(doc), key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        at = 0
        for p in parts:
            part = want[at : at + p.length]
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p.length
        assert at == len(want) and all(p.length == 1024 for p in parts[1:])
    assert not by_doc
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    return len(by_seq)


def test_packing(spark, small, vocabulary, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.select("doc_id", "text").collect()}
    n = _check_packing(packing.pack(docs, vocabulary).collect(), ids)
    assert n <= 1.03 * -(-sum(map(len, ids.values())) // 1024) + 1


def test_packing_odd_rows(rows, vocabulary):
    got = packing.pack(rows([(1, None, "x"), (2, "", "x"), (3, "word " * 5000, None)], SCHEMA), vocabulary).collect()
    assert {(r.doc_id, r.piece): r.length for r in got}[(1, 0)] == 1
    assert packing.pack(rows([], SCHEMA), vocabulary).collect() == []


def test_packing_replaces_columns_of_its_names_and_deals_equal_rows(rows):
    items = rows([(1, 0, 600, "x", 5)] * 400 + [(None, 0, 400, "y", 6)] * 400, "doc_id long, piece int, length long, sequence_id string, offset int")
    got = packing.best_fit(items).collect()
    assert len(got) == 800 and got[0].__fields__ == ["doc_id", "piece", "length", "sequence_id", "offset"]
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 1024 for x in used.values())


def test_bins_take_the_best_fit_and_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # fits bin 1 exactly, though bin 0 has room
    assert bins.place(5) == (2, 0) and bins.open == 2
    assert bins.place(9) == (3, 0)  # bin 0, the fullest, has closed
    assert bins.place(4) == (2, 5)
