import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import recompression
from lexloom.llm.recompression import parsed, removed, repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """(key, words, spans, kept) of rows in order of their keys, window by window."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            had = tuple(words[i : i + window])
            if had in seen:
                gone[i : i + window] = [True] * window
            seen.add(had)
        spans, start = [], None
        for i, g in enumerate([*gone, False]):
            if g and start is None:
                start = i
            elif not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((key, len(words), spans, " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def found(spark, tmp_path, rows, window, parts=3):
    spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "block": F.lit("x")}).repartition(parts).write.parquet(f"{tmp_path}/rows")
    got = repeats(spark.read.parquet(f"{tmp_path}/rows"), window=window)
    return sorted(((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["kept"]) for r in got.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def _passages(rng, words, n):
    shared = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for k in range(n):
        out = []
        for _ in range(rng.randint(0, 6)):
            out += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(0, 30))]
        rows.append((k * 7 % 1000, rng.choice((" ", "  \n", "\t")).join(out)))
    return rows


@pytest.mark.parametrize("seed,letters,window", [(1, 2, 20), (2, 3, 5), (3, 40, 20), (4, 1, 20), (5, 2, 1), (6, 500, 3)])
def test_equals_windows_one_by_one(spark, tmp_path, seed, letters, window):
    rng = random.Random(seed)
    rows = _passages(rng, [f"w{i}é" if i % 3 else f"w{i}" for i in range(letters)], 60)
    assert found(spark, tmp_path, rows, window) == plain(rows, window)


def test_runs_copies_and_odd_texts(spark, tmp_path):
    a, b = " ".join(f"a{i}" for i in range(50)), "x " * 45
    rows = [(1, a), (2, None), (3, ""), (4, " \n "), (5, b), (6, "y " * 10 + "x " * 10 + "z " * 30), (7, a + " end"), (8, "y " * 10 + "x " * 10), (9, a), (None, a), (10, b + a), (11, "A" + a[1:])]
    assert found(spark, tmp_path, rows, 20) == plain(rows, 20)


def test_equal_ids_keep_one_copy(spark, tmp_path):
    """Rows of one id count in the order of their blocks: one keeps its words."""
    text = " ".join(f"t{i}" for i in range(200))
    got = found(spark, tmp_path, [(4, text)] * 5 + [(9, text)], 20, parts=4)
    assert sorted(len(g[3]) for g in got) == [0] * 5 + [len(text)]
    assert got[-1][0] == 9 and got[-1][3] == ""


def test_long_text(spark, tmp_path):
    rng = random.Random(8)
    half = " ".join(rng.choice(("u", "v", "w")) for _ in range(60_000))
    rows = [(1, half + " m " + half), (2, half[1000:9000])]
    assert found(spark, tmp_path, rows, 20) == plain(rows, 20)


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, [], 20) == []


@pytest.mark.parametrize("letters", [1, 2, 30])
def test_symbols_follow_from_their_extent(letters):
    """A stretch has the same symbols wherever all of an extent is the same."""
    rng = np.random.default_rng(letters)
    words = recompression.mix(rng.integers(1, letters + 1, 400).astype(np.uint64))
    alone = parsed(words, np.zeros(400, np.int64), 4)
    around = np.concatenate([recompression.mix(rng.integers(1, letters + 1, 50).astype(np.uint64)) for _ in range(2)])
    inside = np.concatenate([around[:50], words, around[50:]])
    whole = parsed(inside, np.zeros(500, np.int64), 4)
    there = {(int(n), int(b) - 50, int(x) - 50, int(y) - 50) for n, b, x, y in zip(whole.names, whole.begin, whole.lo, whole.hi, strict=True)}
    own = [(int(n), int(b), int(x), int(y)) for n, b, x, y in zip(alone.names, alone.begin, alone.lo, alone.hi, strict=True) if x >= 0 and y <= 400]
    assert set(own) <= there
    assert letters == 1 or len(own) > 20


def test_removed_counts_words(spark):
    spans = "array<struct<start:long,stop:long>>"
    assert spark.createDataFrame([([(1, 4), (6, 7)],), ([],)], f"s {spans}").select(removed(F.col("s")).alias("n")).collect() == [(4,), (0,)]
