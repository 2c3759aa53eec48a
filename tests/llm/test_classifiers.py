from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from loomstream.llm import quality, toxicity
from loomstream.llm.queries import op6_toxicity, op7_quality


def test_trees_against_node_by_node_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < 0)).astype(float)
    trees = quality.grow(x, y, quality.Params(rounds=20))
    for row in x[:50]:
        total = trees.prior
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += v[node - len(f)]
        assert np.isclose(total, trees.margin(row[None])[0])
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.95


def accuracy(spark, rows, label):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    m = rows.merge(labels, on="doc_id")
    m = m[m.held_out]
    return (m.predicted == m[label]).mean()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    assert accuracy(spark, op7_quality(spark, d).toPandas(), "quality") > 0.95
    assert accuracy(spark, op6_toxicity(spark, d).toPandas(), "toxic") > 0.93


def test_neighbours_and_scores_against_brute_force(spark):
    """On the whole small table: all terms of all examples, cosines against every example, votes and curve."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    index = toxicity.fit(docs, labels, toxicity.Params(block=8))
    rows = docs.select("doc_id", "text").toPandas()
    known = labels.where("toxic is not null and doc_id is not null").toPandas().groupby("doc_id")["toxic"].max()
    learnt = [(i, t or "", known[i]) for i, t in zip(rows["doc_id"], rows["text"], strict=True) if i in known.index and zlib.crc32(str(i).encode()) % 3 != 1]
    assert index.n.sum() == len(learnt) and index.pos.sum() == sum(x for _, _, x in learnt)
    words = {w for _, t, _ in learnt for w in toxicity.WORD.findall(t.lower())}
    assert {t for t in index.place if t[0] != "^"} == words
    df = {w: 0 for w in index.place}
    for t in rows["text"]:
        for w in toxicity.terms_of(t or "").keys() & df.keys():
            df[w] += 1
    idf = np.array([np.log((len(rows) + 1) / (df[t] + 1)) + 1 for t in index.place])
    ratio = index.scale / idf
    assert ratio.min() > 0.1 - 1e-9 and ratio.max() < 1 + 1e-9

    def dense(text):
        v = np.zeros(len(index.place))
        for t, n in toxicity.terms_of(text).items():
            if t in index.place:
                v[index.place[t]] = np.log1p(n) * index.scale[index.place[t]]
        return v / (np.sqrt(v @ v) or 1)

    first = {}
    for i, t, _ in sorted(learnt):
        first.setdefault(dense(t).round(6).tobytes(), i)
    matrix = {i: dense(t) for i, t, _ in learnt}
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels, toxicity.Params(block=8)).collect()}
    for i, text in zip(rows["doc_id"], rows["text"], strict=True):
        q = dense(text or "")
        want = sorted((round(float(q @ matrix[e]), 5) for e in set(first.values())), reverse=True)[:15]
        want = [c for c in want if c > 0]
        assert np.allclose(sorted(got[i].cosines, reverse=True)[: len(want)], want, atol=2e-5), i
        who = np.array([int(np.flatnonzero(index.ids == e)[0]) for e in got[i].evidence], np.int64)
        weights = np.minimum(index.n[who], 15) / (1.02 - np.array(got[i].cosines))
        vote = (weights @ (index.pos[who] / index.n[who]) + 0.5 * index.prior) / (weights.sum() + 0.5)
        a, b = index.curve
        assert abs(got[i].score - 1 / (1 + np.exp(-(a + b * np.log(vote / (1 - vote)))))) < 1e-6


def test_copy_of_an_example_finds_it(spark):
    """A copy of a labelled row of rare words only has that row as its nearest, at cosine 1."""
    rows = [(i, " ".join(f"w{i}.{k}x{(i * 7 + k) % 50}" for k in range(12))) for i in range(60)]
    docs = spark.createDataFrame([*rows, (1000, rows[7][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i in (5, 7, 11))) for i in range(60)], "doc_id long, quality int, toxic int")
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 7 in learnt
    r = toxicity.toxicity_scores(docs, labels).where("doc_id = 1000").head()
    assert r.evidence[0] == 7 and r.cosines[0] > 1 - 1e-5


def test_sample_is_bounded_and_ordered(spark):
    """More labelled rows than the sample holds, ids that several documents share, and labels without a document."""
    docs = spark.createDataFrame([(i % 500, f"text {i}") for i in range(1500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(2000)], "doc_id long, quality int, toxic int")
    runs = [sorted(map(tuple, quality.labelled_sample(docs.repartition(n), labels, "toxic", F.lit(True), 100).collect())) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 100 and all(i < 500 and t == min(f"text {i + 500 * k}" for k in range(3)) for i, t, _ in runs[0])


def test_edges(spark):
    docs = spark.createDataFrame([(i, f"nice text {i}" if i % 2 else f"scum scum trash {i}", 0.5) for i in range(40)] + [(90, None, 0.1), (91, "", 0.1), (None, "scum", 0.1), (92, "x" * 100_000, 0.1), (92, "again", 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2, "c") for i in range(40)] + [(None, 1, 0, "c"), (5, None, None, "c"), (3, 1, 0, "c")], "doc_id long, quality int, toxic int, text string")
    for run in (quality.quality_scores, toxicity.toxicity_scores):
        got = run(docs, labels).collect()
        assert len(got) == 45 and all(0 <= r.score <= 1 for r in got)
        assert len(run(docs, labels.limit(0)).collect()) == 45 and run(docs.limit(0), labels).count() == 0
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels, toxicity.Params(significance=(0.0, 2.0))).collect()}
    assert got[2] == 1 and got[3] == 0 and got[91] == 0


def test_toxic_rows_that_are_found(spark):
    """Of the held-out toxic rows at least four fifths are at the threshold, and hardly any other row is."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    own = toxicity.toxicity_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    toxic, clean = ([r.predicted for r in own if r.toxic == t] for t in (1, 0))
    assert len(toxic) > 100 and sum(toxic) >= 0.82 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_words_and_terms_found():
    """Words by tables are those of the pattern, and the terms found those that are counted, whatever texts stand beside."""
    given = ["Ab_c d-e  É\xa0ß ½ \x85x\x1cy", "", "çà et LÀ, là", "Ωmega 数据 a_1 İI", "K2 — “quoted” words", "".join(map(chr, range(1, 700))), "trash trashes Trashing trash"]
    assert all(toxicity.words_of(t) == toxicity.WORD.findall(t.lower()) for t in given)
    place = {t: i for i, t in enumerate(sorted({t for x in given[::2] for t in toxicity.terms_of(x)}))}
    finder = toxicity.Finder(place)
    for _ in range(2):
        owner, dims, n = finder.found(given)
        for i, x in enumerate(given):
            want = {place[t]: k for t, k in toxicity.terms_of(x).items() if t in place}
            own = owner == i
            assert dict(zip(dims[own].tolist(), n[own].tolist())) == want and (np.diff(dims[own]) > 0).all()
        finder.forget()
    assert [len(x) for x in finder.found([])] == [0, 0, 0]


def test_block_is_compared_once_with_the_queries_together(monkeypatch):
    """Queries that promise different blocks most share each block's comparison, and find the nearest of all examples."""
    rng = np.random.default_rng(2)
    index = toxicity.Index(place={f"w{i}": i for i in range(400)}, block=16, frequent=20, together=128)

    def vector():
        dims = np.unique(rng.zipf(1.2, 30) % 400)
        w = rng.random(len(dims)) + 0.1
        return dims, (w / np.sqrt(w @ w)).round(6)

    examples, queries = [vector() for _ in range(200)], [vector() for _ in range(100)]
    index.build(examples)
    calls, plain = [], index.cosines
    monkeypatch.setattr(index, "cosines", lambda *a: calls.append(1) or plain(*a))
    got = list(index.nearest(queries, 5))
    assert len(calls) <= len(index.blocks)
    matrix = np.zeros((200, 400))
    for row, (d, w) in zip(matrix, examples, strict=True):
        row[d] = w
    for (d, w), (who, cos) in zip(queries, got, strict=True):
        all_cos = np.rint(matrix[:, d] @ w * 1e6)
        want = np.lexsort((np.arange(200), -all_cos))[:5]
        assert (who == want).all() and np.allclose(cos, all_cos[want] / 1e6)
