from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from loomstream.llm import quality
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as classes
from tests.llm.test_secrets import plain_spans


def mask(text, spans):
    out, at = "", 0
    for s, _, e in spans:
        if s >= at:
            out, at = out + text[at:s] + "[secret]", e
        else:
            at = max(at, e)
    return out + text[at:]


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    trees = quality.fit(docs, labels)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    keep = trees.probability(quality.statistics([t for _, t in rows])) >= 0.3
    rows = [r for r, k in zip(rows, keep, strict=True) if k]
    assert 0 < len(rows) < docs.count()
    rows = [r for r, (d, c) in zip(rows, classes(rows), strict=True) if d == c]
    bad = {d for d, *_ in contaminated(rows, items)}
    rows = [(d, t) for d, t in rows if d not in bad]
    spans = plain_spans([t for _, t in rows])  # those of the patterns and of the battery
    rows = [(d, mask(t, spans[t])) for d, t in rows]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, text in rows:
        ids = t.encode(text, add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_columns_and_stand_nulls(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(20).union(docs.limit(3).withColumn("text", F.lit(None).cast("string"))).union(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    for frame in (odd, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, sf_dir)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()
