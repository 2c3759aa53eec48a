from __future__ import annotations

import re

import duckdb

from loomstream.llm import decontaminate as dc
from loomstream.llm.queries import op3_decontaminate


def grams(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = []
    for d, t in docs:
        for i, b in items:
            g = grams(b)
            if g and len(g & grams(t)) >= 0.8 * len(g) - 1e-9:
                out.append((d, i, len(g), len(g & grams(t))))
    return sorted(out, key=str)


def test_against_oracle(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = sorted(con.sql(dc.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in op3_decontaminate(spark, sf_dir).collect())
    assert got == want and want


def test_edges_against_brute_force(spark):
    item = " ".join(f"w{i}" for i in range(24))
    words = item.split()
    worse = " ".join([*words[:4], "x", *words[5:]])  # 5 of 20 shingles lost
    edge = " ".join([*words[:-4], "a", "b", "c", "d"])  # 4 lost: exactly 0.8
    items = [(1, item), (2, "too short item"), (3, None), (4, ""), (5, "one two three four five"), (6, item), (None, "six seven eight nine ten eleven"), (7, "a a a a a a a")]
    docs = [
        (1, "start " + item.upper() + " end"), (2, worse), (3, edge), (4, None), (5, ""), (6, "pad " * 30_000 + item), (7, "one, two; three: four\nfive"), (8, item), (8, item), (None, "x six seven eight nine ten eleven"),
        (9, "a a a a a"), (10, "one two three four"),
    ]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in dc.contaminated(d, b).collect()), key=str)
    assert got == brute(docs, items)
    kept = dc.decontaminated(d, b)
    bad = {t for (i, t) in docs for r in brute([(i, t)], items)}
    assert sorted(((r.doc_id, r.item_id) for r in kept.collect()), key=str) == sorted(((i, "clash") for i, t in docs if t not in bad), key=str)


def test_without_broadcast(spark, sf_dir, monkeypatch):
    want = sorted(tuple(r) for r in op3_decontaminate(spark, sf_dir).collect())
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 1)
    assert sorted(tuple(r) for r in op3_decontaminate(spark, sf_dir).collect()) == want


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert dc.contaminated(d, b).count() == 0 and dc.contaminated(full, b).count() == 0 and dc.decontaminated(full, b).count() == 1


def test_main_path_is_native(spark, sf_dir):
    assert not re.search("Python|Pandas|Arrow", op3_decontaminate(spark, sf_dir)._jdf.queryExecution().toString())
