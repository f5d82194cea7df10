"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, importance, langid, language_model, near_dup, quality, recompression
from .chat import conversation_nodes, digests, format_trees
from .html_text import extract
from .packing import pack
from .runtime import stored, table
from .token_counts import token_counts
from .warc import round_trip

#: A public vocabulary by name; each machine finds its own file of it.
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, capacity=1024)


def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives."""
    return round_trip(spark, table(spark, sf_dir, "pages"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains a benchmark item, with the item."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted and read back."""
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*(F.col(c).cast(t).alias(c) for c, t in added.dtypes)).unionByName(added)
    return digests(stored(format_trees(stored(conversation_nodes(rows), "replies")), "chats"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dup.classes(table(spark, sf_dir, "documents"), width=5, percent=80)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    scored = language_model.scores(table(spark, sf_dir, "documents"), language_model.learnt())
    return scored.withColumn("held_out", ~F.col("learnt")).drop("learnt")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, name = quality.with_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", f"{name}.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, langid.held_out())
    scored, name = langid.with_language(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", langid.held_out().alias("held_out"), f"{name}.*")


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark."""
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), buckets=10_000, percent=5, least_words=20, seed=42)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that came before."""
    found = recompression.repeats(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", recompression.removed(F.col("spans")).alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document line up."""
    return alignment.summary(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_best_fit_packing, op3_warc_dictionary, op4_benchmark_decontamination, op5_chat_reply_trees, op6_ngram_jaccard_join, op7_lm_scoring, op8_quality_rules, op9_language_id, op10_html_main_text, op11_importance_resampling, op12_substring_dedup, op13_tokenizer_alignment)}


#: Every page's payload, and for repeats of a large one the page that holds it.
WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT payload_digest, max(page_id) AS holder FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h ON p.payload_digest = h.payload_digest
"""

#: Turns, loss text and formatted length; every control string in a text gains a backslash.
CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|</?SYS>>|<ROLE [^<>]*>>|</ROLE>>)'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
          ELSE 18 + coalesce(length(role) + 2 * len(regexp_extract_all(role, '[%<>]')), 0) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

#: All pairs that share a shingle, and what links reach.
NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT w.doc_id, count(sh) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON p.x = a.doc_id JOIN n b ON p.y = b.doc_id WHERE 100 * i >= 80 * (a.n + b.n - i)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT c.doc_id, e.y FROM c JOIN e ON c.r = e.x)
SELECT c.doc_id, any_value(n.n) AS n_shingles, min(r) AS component_id FROM c JOIN n ON c.doc_id = n.doc_id GROUP BY 1
"""


#: Runs of words with their crc32 from its definition, gains of buckets, ranks.
IMPORTANCE_SQL = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
w AS (SELECT doc_id, text, 0 AS kind FROM documents UNION ALL SELECT NULL, text, 1 FROM benchmark),
ws AS (SELECT doc_id, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM w),
f AS (SELECT doc_id, kind, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
             list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM ws),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)),
b AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x), 2), lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT))),
             lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b FROM h, tab),
n AS (SELECT b, count(*) FILTER (kind = 1) AS t, count(*) FILTER (kind = 0) AS s FROM f JOIN b USING (f) GROUP BY 1),
g AS (SELECT b, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM n) + 10000) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM n) + 10000)))) AS BIGINT) AS g FROM n),
d AS (SELECT doc_id, count(*) AS n_features, sum(g) AS weight FROM f JOIN b USING (f) JOIN g USING (b) WHERE kind = 0 GROUP BY 1),
z AS (SELECT ws.doc_id, len(ws) AS n, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || sha256('42:' || ws.doc_id)[1:8] AS BIGINT) AS h FROM ws LEFT JOIN d ON ws.doc_id = d.doc_id WHERE kind = 0),
s AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM s WHERE n >= 20)
SELECT s.doc_id, n_features, weight, score, rank FROM s LEFT JOIN (SELECT * FROM r WHERE rank <= (SELECT 5 * count(*) // 100 FROM r)) r ON s.doc_id = r.doc_id
"""


#: Every window with the first place of its words, and the words that others cover.
REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) AS h FROM w),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM x),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE k > 1),
a AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS v FROM w),
s AS (SELECT a.doc_id, count(*) FILTER (g.i IS NOT NULL) AS n, string_agg(v, ' ' ORDER BY a.i) FILTER (g.i IS NULL) AS kept
      FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.i = g.i GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN s ON w.doc_id = s.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others need a tokenizer,
    trees, automata or markup, and are tested against brute force."""
    return {"op3_warc_dictionary": WARC_SQL, "op5_chat_reply_trees": CHAT_SQL, "op6_ngram_jaccard_join": NEAR_SQL, "op11_importance_resampling": IMPORTANCE_SQL, "op12_substring_dedup": REPEATS_SQL}
