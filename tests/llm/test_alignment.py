import hashlib
import random
from collections import Counter

import pytest

from lexloom.llm import alignment
from lexloom.llm.bpe import Vocabulary

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    """ids and bytes of the tokens of either side, from the libraries."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path(BYTES))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=P.path(PIECES))
    plain = Vocabulary(BYTES).bytes_of

    def piece(i):
        return bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    return lambda t: ([(i, plain[i]) for i in first.encode(" " + t, add_special_tokens=False).ids], [(i, piece(i)) for i in second.encode(t)])


def _spans(tokens):
    out, at = [], 0
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def plain(docs, libraries):
    """The summary of every document, pair by pair."""
    held = {}
    for key, text in docs:
        sides = libraries(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(b for _, b in s) != whole for s in sides):
            held[key] = None
            continue
        a, b = map(_spans, sides)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        groups, begin = [], 0
        for end in sorted({x[2] for x in a} & {y[2] for y in b}):
            groups.append("|".join(",".join(str(t[0]) for t in s if begin < t[2] <= end) for s in (a, b)))
            begin = end
        held[key] = (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = Counter(p for h in held.values() if h for p in set(h[3]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    zero = (0, 0, 0, 0, 0, 0, "")
    return {k: zero if h is None else (*h[:3], len(h[3]), sum(count[p] == best[p[0]] for p in h[3]), sum(count[p] for p in h[3]), h[4]) for k, h in held.items()}


def _texts():
    rng = random.Random(11)
    letters = "aabcdehilnorst   .,'-#0123456789\n\té漢字🙂 　ß"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    words = ("unbelievable", "tokenization", "the", "of", "internationalisation", "=====", "    ", "don't", "<s>", "<|endoftext|>", "a\x00b", "ﬁ", "Straße", "1234567")
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    return [*out, None, "", " ", "  ", " x", "x ", "a  b", "▁", "a ▁b", "\n", "tab\t x", "<unk> </s>", "a" * 500, "=" * 333, "x " * 300]


@pytest.mark.parametrize("sent", [True, False])
def test_equals_pairs_one_by_one(spark, rows, libraries, monkeypatch, sent):
    monkeypatch.setattr(alignment, "SENT_PAIRS", alignment.SENT_PAIRS if sent else 0)
    docs = list(enumerate(_texts()))
    table = rows([(k, t, 0, []) for k, t in docs], "doc_id long, text string, links int, a array<int>")
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.summary(table, BYTES, PIECES).collect()}
    assert got == plain(docs, libraries)


def test_pieces_are_forgotten(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "PIECES", 40)
    known = alignment.Pieces(BYTES, PIECES)
    for text in _texts():
        sides = libraries(text) if text else ([], [])
        same = bool(text) and all(b"".join(b for _, b in s) == (" " + text).encode() for s in sides)
        for (n, ids, ends), side in zip(known.encode([text or "", "x"]), sides, strict=True):
            expected = _spans(side) if same else []
            assert n.tolist()[0] == len(expected)
            assert list(zip(ids.tolist(), ends.tolist(), strict=True))[: len(expected)] == [(i, e) for i, _, e in expected]


def test_repeated_rows_null_keys_and_no_rows(rows):
    table = rows([(1, "one two"), (1, "one two"), (None, "one"), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_links"] > 0, r["count_sum"]) for r in alignment.summary(table, BYTES, PIECES).collect())
    assert [g[:2] for g in got] == [(0, True), (1, True), (1, True), (2, False)]
    assert got[1] == got[2]
    assert alignment.summary(rows([], "doc_id long, text string"), BYTES, PIECES).collect() == []


def test_groups_and_links_are_kept_beside_other_columns(rows):
    table = rows([([1, 2, 3], [2, 4, 9], [7, 8], [4, 9], "x", "y"), ([], [], [], [], "x", "y"), ([1, 2, 3], [2, 5, 9], [6, 7, 8], [1, 7, 9], "x", "y")], "a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>, merged string, a string")
    got = [(r["groups"], [(x // alignment.SIDE, x % alignment.SIDE) for x in r["links"]], r["merged"], r["a"]) for r in alignment.aligned(table).collect()]
    assert got == [(["1,2|7", "3|8"], [(1, 7), (2, 7), (3, 8)], "x", "y"), ([], [], "x", "y"), (["1,2,3|6,7,8"], [(1, 6), (1, 7), (2, 7), (3, 7), (3, 8)], "x", "y")]
