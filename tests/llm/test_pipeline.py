import zlib

import numpy as np
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from lexloom.llm import decontaminate, langid, packing, quality, registry
from lexloom.llm.runtime import stored


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    last = docs
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small), name)
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        assert docs.columns == columns and after.items() <= before.items()
        if name == "quality_rules":
            labels = spark.read.parquet(f"{small}/labels.parquet")
            model = quality.fit(spark.read.parquet(f"{small}/documents.parquet"), labels)
            base = {i: brute.quality_counts(t) for i, t in before.items()}
            good = {i for i, c in base.items() if c[0] >= 10 and 100 * c[4] <= 20 * c[0]}
            assert set(after) == {i for i in good if all(brute.tree_chance(t, brute.quality_features(before[i], model.markers)) <= 0.5 for t in (model.low, model.toxic))}
            clean = [r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()]
            assert sum(i in after for i in clean) >= 0.95 * len(clean)
        if name == "language_id":
            samples = langid.fit(last, langid.held_out()).samples
            assert set(after) == {i for i, t in before.items() if brute.language(t, samples) != "und"}
            told = {r.doc_id: r.lang for r in docs.collect()}
            assert sum(brute.language(t[:400], samples) == told[i] for i, t in after.items()) >= 0.97 * len(after)
        if name == "ngram_jaccard_join":
            assert set(after) == {i for i, (_, c) in brute.classes(before.items()).items() if c == i}
        if name == "benchmark_decontamination":
            items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            assert not any(b in t for t in after.values() for b in items)
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            found = {r.doc_id for r in decontaminate.matches(last, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
            assert set(before) - set(after) == found and all(any(b in before[i] for _, b in bench) for i in found)
        before, last = after, docs
    encode = packing.encoder(registry.BYTE_BPE)
    ids = {i: [*encode(t), 2] for i, t in before.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in packed} == set(before)
    for r in packed:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))


def test_run_equals_the_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        docs = stored(docs, "stage")
    key = lambda rows: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert key(corpus_pipeline.run(spark, small).collect()) == key(docs.collect())


def test_stages_take_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_language_stage_names_what_it_found(spark, rows, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    some = docs.where("text is not null and lang is not null").limit(40)
    odd = some.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).unionByName(rows([(-1, "12 34", None, "s", 5), (-2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
    kept = corpus_pipeline.language_id(spark, odd, small)
    assert kept.columns == docs.columns and kept.where("lang is null or doc_id < 0").count() == 0 and kept.count() == 40


def test_every_operator_is_registered():
    names = registry.queries()
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
