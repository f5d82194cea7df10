import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexloom.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain(docs, target, buckets, percent, least):
    """(key, n_features, weight, score, rank) by their definitions."""
    held = [(k, len(features(t)[0]), Counter(zlib.crc32(f.encode()) % buckets for f in features(t)[1])) for k, t in docs]
    s = sum((c for _, _, c in held), Counter())
    t = Counter(zlib.crc32(f.encode()) % buckets for x in target for f in features(x)[1])
    sn, tn = sum(s.values()), sum(t.values())
    out = []
    for k, n, c in held:
        weight = sum(m * math.floor(1000 * math.log((t[b] + 1) * (sn + buckets) / ((s[b] + 1) * (tn + buckets)))) for b, m in c.items())
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return [(r[0], *r[2:], rank.get(id(r))) for r in out]


def _texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abC9é漢 .\n'") for _ in range(rng.randint(0, 400))) for _ in range(n)]


def test_streams_are_checksums_of_runs():
    texts = [*_texts(1, 80), "", " . ", "x" * 300 + " " + "y" * 70 + " z", "é" * 100 + " B", "q" * 64 + " " + "r" * 65 + " " + "s" * 1000, "one"]
    stream, words, total = importance.bucket_stream(texts, 10_000)
    at = 0
    for text, n, m in zip(texts, words, total, strict=True):
        w, f = features(text)
        assert (n, m) == (len(w), len(f))
        assert stream[at : at + m].tolist() == [zlib.crc32(x.encode()) % 10_000 for x in f]
        at += m
    assert at == len(stream)


def test_run_lengths():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        x = rng.integers(0, 1 << 16, n, dtype=np.uint16) % 50
        values, counts = importance.run_lengths(x)
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == Counter(x.tolist())


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_equals_definitions(rows, percent):
    docs = [(i % 90, t, "x") for i, t in enumerate(_texts(3, 120))] + [(200, None, ""), (201, "", None), (None, "a b c " * 30, ""), (300, "w " * 30_000, "")]
    target = [(t, 1) for t in _texts(4, 10)] + [(None, 1)]
    got = importance.resampled(rows(docs, "doc_id long, text string, row string"), rows(target, "text string, doc_id int"), percent=percent)
    odd = lambda r: tuple((x is not None, x or 0) for x in r)
    expected = plain([d[:2] for d in docs], [t[0] for t in target], 10_000, percent, 20)
    # rows of one key share their noise, so equal ones may swap ranks
    assert sorted(map(odd, map(tuple, got.collect()))) == sorted(map(odd, expected))


def test_ties_and_repeated_rows(rows):
    docs = [(k, "one two " * 20) for k in [5] * 40 + list(range(6, 26))]
    got = importance.resampled(rows(docs, "doc_id long, text string"), rows([("two three",)], "text string"), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31))
    by_rank = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in by_rank] == sorted((-r["score"], r["doc_id"]) for r in by_rank)


def test_empty_tables(rows):
    none, some = rows([], "doc_id long, text string"), rows([(1, "a b " * 15)], "doc_id long, text string")
    assert importance.resampled(none, some.select("text")).collect() == []
    got = importance.resampled(some, none.select("text"), percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in got] == [(1, 87, 1)]


def test_buckets_must_fit(rows):
    with pytest.raises(ValueError):
        importance.streams(rows([(1, "a")], "doc_id long, text string"), 1 << 17)
