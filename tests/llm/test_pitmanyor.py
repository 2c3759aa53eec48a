from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np

from loomstream.llm import pitmanyor as py

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), b"\n"]


def brute(rows):
    train = Counter(t for d, x in rows if d is None or zlib.crc32(str(d).encode()) % 10 for t in tokens(x))
    n, v = sum(train.values()), len(train)
    out = []
    for d, x in rows:
        w = tokens(x)
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 10 == 0, len(w), sum(t in train for t in w), n, sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)))
    return out


def same(got, want):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    want = sorted(want, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])


def test_counts_and_base_on_edges(spark):
    rows = [(i, t) for i, t in enumerate(["The cat\tsat", "the  CAT\x0bsat \n", None, "", "É é É x", "a" * 70_000 + " b", " ".join(["w"] * 50_000), "\x1c x", "z"] * 4)] + [(None, "the cat"), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = py.language_model_scores(df).collect()
    same(got, brute(rows))
    assert all(r.score < 0 for r in got)
    assert py.language_model_scores(df.limit(0)).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    lone = py.language_model_scores(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all(r.n_known == 0 and abs(r.score) < 1e-9 for r in lone)


def test_beats_the_unigram_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = py.language_model_scores(docs).toPandas()
    same([r for r in rows.itertuples()], brute([(r.doc_id, r.text) for r in docs.collect()]))
    for part in (rows, rows[rows.held_out]):
        assert part.score.sum() > part.base_score.sum()


def test_same_word_same_hash():
    table = py.powers(1000)
    h, n = py.token_hashes(["Word x word", " word\n", "", "WORD"], table)
    assert n.tolist() == [4, 2, 1, 2] and len({int(h[i]) for i in (0, 2, 4, 7)}) == 1 and (h[[3, 5, 6, 8]] == py.END).all()


def partitions(n):
    """Sizes of the tables of every way to seat n customers."""
    if n == 0:
        yield ()
        return
    for sizes in partitions(n - 1):
        yield (*sizes, 1)
        for i, k in enumerate(sizes):
            yield (*sizes[:i], k + 1, *sizes[i + 1 :])


def test_seating_against_all_arrangements():
    """Drawn numbers of tables have the distribution that the weights of all arrangements give."""
    rng = np.random.default_rng(1)
    for count, others, parent, d in ((2, 5, 0.3, 0.6), (5, 0, 0.2, 0.3), (8, 40, 0.05, 0.8), (10, 3, 0.9, 0.9)):
        want = np.zeros(count + 1)
        for sizes in partitions(count):
            t = len(sizes)
            want[t] += math.prod(math.prod(j - d for j in range(1, k)) for k in sizes) * math.prod((1 + d * (others + i)) * parent for i in range(t))
        want /= want.sum()
        n = 40_000
        got = py.seat(np.full(n, count), np.full(n, float(others)), np.full(n, parent), d, 1.0, py.log_arrangements(count, d), rng)
        assert np.allclose(np.bincount(got.astype(int), minlength=count + 1) / n, want, atol=0.012)


def test_seating_of_many_customers_against_sequential_process():
    """Beyond EXACT, means of the tables agree with a customer-by-customer simulation."""
    rng, n, count = np.random.default_rng(1), 2000, py.EXACT + 400
    got = py.seat(np.full(n, count), np.full(n, 5.0), np.full(n, 0.02), 0.6, 1.0, py.log_arrangements(1, 0.6), rng)
    want = []
    for _ in range(400):
        t = 1
        for i in range(1, count):
            new = (1 + 0.6 * (5 + t)) * 0.02
            t += rng.random() < new / (new + i - 0.6 * t)
        want.append(t)
    assert abs(got.mean() - np.mean(want)) < 0.06 * np.mean(want) + 0.03


def test_probabilities_of_all_texts_sum_to_one(spark):
    """Over five known words and an unknown one, the probabilities of texts of any length add up to 1, in one shard and in many."""
    words = ["ash", "bay", "cod", "dew", "elm", "zzz"]
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(words[(i * k) % 5 if k % 3 else 0] for k in range(1, 2 + i % 6))) for i in range(700) if i not in held]
    asked = ["", *words, *(f"{a} {b}" for a in words for b in words)]
    assert len(held) >= len(asked)
    df = spark.createDataFrame([*rows, *zip(held, asked)], "doc_id long, text string").repartition(4)
    for size in (1 << 20, 800):
        p = {r.doc_id: 10**r.score for r in py.language_model_scores(df, py.Params(group_bytes=size)).collect()}
        p = dict(zip(asked, (p[i] for i in held)))
        ends = np.array([p[w] for w in words])
        steps = np.array([[p[f"{a} {b}"] / p[b] for b in words] for a in words])  # up to factors that cancel over a whole text
        assert abs(p[""] + np.linalg.solve(np.eye(6) - steps, ends).sum() - 1) < 1e-4


def test_planes():
    x = np.array([0, 1, 255, 256, 2**40 - 1], np.uint64)
    assert (py.unpack(py.pack(x, 5), 5) == x).all() and len(py.unpack(b"", 5)) == 0
    f = np.array([0.5, -1.25, 3e7])
    assert (py.from_float_planes(py.float_planes(f)) == f).all()


def test_counts_beyond_float_precision():
    """A word's count travels as an integer, also above 2**24."""
    n = np.array([0, 1, (1 << 24) + 1, (1 << 40) + 3])
    assert (py.unpack(py.pack(n, py.COUNT_BYTES), py.COUNT_BYTES).astype(np.int64) == n).all()


def test_rows_of_one_id_are_spread_and_settings_do_not_matter(spark):
    """Rows without an id are dealt like others; the number of shuffle partitions changes no score."""
    df = spark.createDataFrame([(None, "the same words here")] * 300 + [(i, f"other words {i % 7}") for i in range(50)], "doc_id long, text string").repartition(4)
    params = py.Params(group_bytes=1500)
    base = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        runs = []
        for n in (3, 11):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            runs.append(sorted(((r.doc_id, r.n_tokens, round(r.score, 9), round(r.base_score, 9)) for r in py.language_model_scores(df, params).collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", base)
    assert len(runs[0]) == 350 and [r[:2] for r in runs[0]] == [r[:2] for r in runs[1]] and np.allclose([r[3] for r in runs[0]], [r[3] for r in runs[1]])
    assert np.allclose([r[2] for r in runs[0]], [r[2] for r in runs[1]])


def test_requests_are_seated_once(spark):
    """One stage samples the seating of a shard; what answers the requests takes it from there."""
    df = spark.createDataFrame([(i, f"some words {i % 7}") for i in range(50)], "doc_id long, text string")
    plan = py.language_model_scores(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 3 and "tables(" in plan and "cells(" not in plan  # requests for both, and the seating


def test_groups_do_not_depend_on_the_order_of_documents():
    """A group asks and scores in the same order of words and cells, whichever order its documents come in."""
    rng = np.random.default_rng(3)
    text = [" ".join(f"w{k}" for k in rng.zipf(1.3, 40) % 500) for _ in range(60)] + [""]
    train = rng.random(len(text)) < 0.8
    hot = np.unique(py.token_hashes(["w1 w2"], py.powers(100))[0])
    back = np.arange(len(text))[::-1]
    a, b = py.grouped(text, train, 5, hot, py.powers(100)), py.grouped([text[i] for i in back], train[back], 5, hot, py.powers(100))
    for k in ("words", "word_count", "context", "context_place", "dish", "dish_place", "cell_count"):
        assert (getattr(a, k) == getattr(b, k)).all()
    for k in ("cell_order", "word_order"):
        parts = getattr(a, k)
        assert all((x == y).all() for x, y in zip(parts, getattr(b, k), strict=True))
        assert (np.sort(np.concatenate(parts)) == np.arange(sum(map(len, parts)))).all()
    assert (a.dish_place[a.cell_of] == a.word_of).all() and (a.dish == a.words[a.dish_place] & py.MASK40).all() and (a.context == a.words[a.context_place] & py.MASK40).all()
    cells = {(int(c), int(d)) for c, d in zip(a.context, a.dish)}
    assert len(cells) == len(a.dish)
    for part in a.cell_order:
        assert (np.diff(a.context[part].astype(np.int64)) >= 0).all()


def test_distinct_and_dealt():
    rng = np.random.default_rng(4)
    for values in (np.zeros(0, np.int64), np.array([5]), rng.integers(0, 50, 400), rng.integers(0, 1 << 40, 400), rng.integers((1 << 62), (1 << 63) - 1, 400)):
        got, want = py.distinct(values), np.unique(values, return_inverse=True)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    home = rng.integers(0, 6, 100)
    order, at = py.dealt(home, 8)
    assert all((order[at[s] : at[s + 1]] == np.flatnonzero(home == s)).all() for s in range(8))


def test_weights_beyond_float_range():
    """Weights that rise by more than floating point holds give the distribution that their logarithms give."""
    rng, count, others, parent, d = np.random.default_rng(5), 900, 1e7, 0.9, 0.9
    logs = py.log_arrangements(count, d)
    t = np.arange(1, count + 1)
    want = logs[count, 1:] + np.cumsum(np.log((1 + d * (others + t - 1)) * parent))
    p = np.exp(want - want.max())
    got = py.seat(np.full(3000, count), np.full(3000, others), np.full(3000, parent), d, 1.0, logs, rng)
    assert abs(got.mean() - (p / p.sum()) @ t) < 0.2 and want.max() - want[0] > 1500
