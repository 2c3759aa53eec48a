from __future__ import annotations

import random

from loomstream.llm import neardup as nd


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_against_full_table():
    rng = random.Random(5)
    near = 0
    for _ in range(300):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 70))]
        other = list(words)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(other) + 1)
            other[i : i + rng.randint(0, 2)] = [f"x{rng.randrange(9)}"] * rng.randint(0, 2)
        a, b = nd.labelled_shingles(words, {}), nd.labelled_shingles(other, {})
        m = lcs(a.tolist(), b.tolist())
        j = m / (len(a) + len(b) - m)
        got = nd.aligned(a, b, 0.8)
        near += j >= 0.8
        assert got == j if j >= 0.8 else got < 0.8, (words, other)
    assert near > 50


def brute(rows):
    """Class by all pairs of texts."""
    seqs = [nd.labelled_shingles(nd.words_of(t or ""), {}) for _, t in rows]
    keys = [nd.text_key(nd.words_of(t or "")) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and (keys[i] == keys[j] or nd.aligned(seqs[i], seqs[j], 0.8) >= 0.8):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, least.get(find(i))) for i, (d, _) in enumerate(rows)]


def test_edges(spark):
    base = [f"w{i}" for i in range(120)]
    one = base[:60] + ["zz"] + base[61:]
    two = one[:10] + ["yy"] + one[11:]
    rows = [
        (5, " ".join(base)), (3, " ".join(one)), (9, " ".join(two)), (4, None), (6, ""), (None, "  "), (7, "a b"), (8, "A  b"), (10, "a c"), (11, " ".join(reversed(base))), (None, "only here"), (None, "only here"),
        (3, "another text under the same id as above"), (12, "long " * 50_000), (13, "long " * 50_001), (13, "long " * 50_001),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class_id string")
    got = nd.classes(df).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == sorted(brute(rows), key=str)
    kept = nd.first_of_each(df).collect()
    assert sorted((str(r.doc_id), len(r.text or "")) for r in kept) == sorted((str(d), len(t or "")) for d, t in [rows[1], rows[3], rows[6], rows[8], rows[9], rows[10], rows[11], rows[12], rows[13]])
    assert nd.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_recall_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in nd.classes(docs).collect()}
    assert got == dict(brute(rows)) and len(set(got.values())) < len(got)


def test_hub_of_unlike_copies(spark):
    """Edited copies that are near the same text, and none near another, are one class; so are short texts."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(204)]
    rows = [(1000, " ".join(base))]
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(0, 204, 6), 4):
            words[at + rng.randrange(5)] = f"x{i}.{at}"
        rows.append((i, " ".join(words)))
    licence = [f"l{i}" for i in range(300)]
    rows += [(2000 + i, " ".join(licence[: 250 + i % 3] + [f"y{i // 2}.{k}" for k in range(90 + i % 2)])) for i in range(60)]
    short = [[f"s{g}.{k}" for k in range(9)] for g in range(400)]
    rows += [(3000 + 2 * g + k, " ".join(w[: 9 - k])) for g, w in enumerate(short) for k in range(2)]
    got = {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"), nd.Params(block=64)).collect()}
    hub = [r for r in rows if r[0] < 2000]
    assert got == dict(brute(hub) + brute([r for r in rows if 2000 <= r[0] < 3000]) + [(3000 + 2 * g + k, 3000 + 2 * g) for g in range(400) for k in range(2)])
    seqs = [nd.labelled_shingles(nd.words_of(t), {}) for _, t in hub]
    assert sum(nd.aligned(seqs[1], s, 0.8) > 0 for s in seqs[2:]) < 30 and {got[d] for d, _ in hub} == {0}


def test_form_letters(spark):
    """Letters of one form whose other words differ: only those of a pair are near each other, just above the threshold."""
    rng = random.Random(3)
    form = [[f"f{k}" for k in range(at, at + 20)] for at in range(0, 160, 20)]
    rows = []
    for g in range(250):
        own = [[f"n{g}.{i}.{k}" for k in range(3)] for i in range(8)]
        for k in range(2):
            parts = [list(o) for o in own]
            for i in rng.sample(range(8), 2):
                parts[i][1] = f"d{g}.{k}.{i}"
            rows.append((2 * g + k, " ".join(w for f, o in zip(form, parts, strict=True) for w in f + o)))
    got = {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"), nd.Params(block=64)).collect()}
    assert got == dict(brute(rows))
    assert 100 < len(set(got.values())) < 500


def test_heavy_keys_are_dealt(spark, monkeypatch):
    from loomstream.llm import common

    monkeypatch.setattr(common, "FEW_ROWS", 10)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, "hot", 1), (5, None, 2)], "doc_id long, key string, row int")
    one = spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(0, 300, 3))], "key string, v int")
    heavy = common.heavy_keys(rows, "key").collect()
    assert [(r.key, r.parts) for r in heavy] == [("hot", 21)]
    got = sorted((str(r.doc_id), r.key, r.row, r.v) for r in common.spread_join(rows, one, "key", ["doc_id", "row"]).collect())
    assert got == sorted((str(r.doc_id), r.key, r.row, r.v) for r in rows.join(one, "key").collect()) and len(got) == 301
