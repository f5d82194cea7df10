import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from lexloom.llm import chat, registry

pieces = st.text(st.sampled_from(list("<>/[]\\sINSTYROLE ab%\n")), max_size=25)
control = st.sampled_from(["<s>", "</s>", "[INST] ", " [/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE x>>", "<</ROLE>>", "\\", "<\\/s>", "[\\\\INST]"])
texts = st.lists(st.one_of(pieces, control), max_size=5).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), pieces)


@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_template_reads_back(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_best_branches(rows):
    # 1 - 2 - 4, 1 - 3 - 5 - 6, 1 - 3 - 7; 8 and 9 are a cycle, 10 an orphan
    edges = [(1, None, 1.0), (2, 1, 5.0), (4, 2, 0.0), (3, 1, 1.0), (5, 3, 1.0), (6, 5, 1.0), (7, 3, 3.0), (8, 9, 1.0), (9, 8, 1.0), (10, 99, 0.5)]
    nodes = rows([(1, n, p, s, "user", f"t{n}") for n, p, s in edges], "tree long, node long, parent long, score double, role string, text string")

    def best(k):
        found = {}
        for r in chat.paths(nodes, k).collect():
            found.setdefault(r.leaf, []).append((r.depth, r.node))
        return {leaf: [n for _, n in sorted(p)] for leaf, p in found.items()}

    assert best(1) == {4: [1, 2, 4]}
    assert best(9) == {4: [1, 2, 4], 6: [1, 3, 5, 6], 7: [1, 3, 7], 10: [10]}


def test_conversations(spark, rows):
    data = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, 1, "user", None), (2, 1, "user", None), (None, 0, "tool", "x"), (3, None, None, "n"), *((4, i, "user" if i % 2 else "assistant", f"</s>{i}") for i in range(300))]
    nodes = chat.stored(chat.conversation_nodes(rows(data, "conv_id long, turn long, role string, text string")), "t")
    got = {r.conv_id: r for r in chat.digests(chat.format_trees(nodes)).collect()}
    whole = "".join(f"{'user' if i % 2 else 'assistant'}\n</s>{i}\n" for i in range(300))
    assert got[4].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and got[4].n_turns == 300
    assert got[1].loss_sha256 == hashlib.sha256(b"b").hexdigest() and got[2].n_turns == 2 and got[3].n_turns == 1
    assert got[None].n_turns == 1 and got[None].turns_sha256 == hashlib.sha256(b"tool\nx\n").hexdigest() and len(got) == 5
    assert chat.digests(chat.format_trees(nodes.limit(0))).collect() == []


def _best_paths(edges, best):
    """{(tree, leaf): nodes from the root}, by walking up from every leaf."""
    up = {(t, n): (p, s) for t, n, p, s in edges}
    parents = {(t, p) for t, n, p, s in edges if (t, p) in up}
    found = {}
    for t, n in up:
        if (t, n) in parents:
            continue
        way, total, at = [], 0.0, n
        while (t, at) in up and at not in way:
            way.append(at)
            total, at = total + (up[t, at][1] or 0.0), up[t, at][0]
        if at not in way:
            found.setdefault(t, []).append((-total, n, way[::-1]))
    return {(t, n): way for t, each in found.items() for _, n, way in sorted(each)[:best]}


def test_random_trees_against_walking_up(rows):
    rng = random.Random(17)
    edges = []
    for tree in [None, *range(12)]:
        size = rng.choice((1, 3, 30, 120))
        for n in range(size):
            wild = rng.random()
            parent = None if n == 0 or wild < 0.03 else 999 if wild < 0.05 else rng.randrange(size) if wild < 0.07 else rng.randrange(max(0, n - 4), n)
            edges.append((tree, n, parent, rng.choice((None, 0.0, 0.5, 1.0, 2.0))))
    table = rows([(t, n, p, s, "user" if n % 2 else "assistant", f"</s>{t} {n}") for t, n, p, s in edges], "tree long, node long, parent long, score double, role string, text string")
    for best in (1, 3):
        got = {}
        for r in chat.paths(table, best).collect():
            got.setdefault((r.tree, r.leaf), []).append((r.depth, r.node))
        want = _best_paths(edges, best)
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    told = {(r.tree, r.leaf): chat.read_turns(r.formatted) for r in chat.format_trees(table, 3).collect()}
    assert told == {(t, leaf): [("user" if n % 2 else "assistant", f"</s>{t} {n}") for n in way] for (t, leaf), way in want.items()}


def test_sql_agrees_on_odd_rows(spark, rows, tmp_path):
    import duckdb

    data = [(1, 1, "tool<%>", "[INST] a"), (1, 2, "assistant", "b </s> <\\/s>"), (2, 1, None, None), (None, 1, "system", "x"), (None, 2, "assistant", "y"), (3, None, "user", "<<ROLE q>>")]
    rows(data, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = registry.op5_chat_reply_trees(spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = db.sql(registry.CHAT_SQL).df()
    order = ["turns_sha256"]
    assert got.sort_values(order)[list(want.columns)].fillna(-9).astype(str).values.tolist() == want.sort_values(order).fillna(-9).astype({"conv_id": got.conv_id.dtype}).astype(str).values.tolist()
