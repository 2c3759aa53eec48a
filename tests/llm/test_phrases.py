"""Phrases against DuckDB and a plain count, with tries that burst and spill all the time."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loomstream.llm import phrases
from loomstream.llm.phrases import Params

TINY = Params(trie_entries=200, burst=40, task_words=100, filter_bits=1 << 9)
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, params=Params()):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, params.max_words + 1):
                f.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    found = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= params.least}
    out = {}
    for (lang, w), a in found.items():
        if any(len(v) > len(w) and o == lang and 100 * b >= params.held_pct * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (o, v), b in found.items()):
            continue
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, total[lang], -s) for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[: params.top], 1))


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_same_as_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({phrases.ORACLE_SQL})").fetchall())
    assert len(want) > 100 and result(phrases.collocations(docs)) == want
    assert result(phrases.collocations(docs, TINY)) == want  # tries that burst and spill, and a bitmap that is nearly full


def test_edges(spark):
    rows = [(None, None), ("en", None), ("en", ""), ("en", " \t\n.,"), (None, "Ein ÄPFEL x; a\tb. " * 7), ("und", "ein ÄPFEL x! A b\x0b" * 7), ("en", "to be or not to be, " * 12), ("en", "to be or not to be, " * 12), ("de", "x y " * 9), ("fr", "z " * 4000)]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("CAST(NULL AS LONG) AS doc_id", "*", "1 AS n", "'p' AS phrase")
    for params in (Params(), TINY, Params(top=1), Params(max_words=2), Params(least=3, held_pct=100)):
        assert result(phrases.collocations(df, params)) == plain(rows, params), params
    assert phrases.collocations(df.limit(0)).count() == 0
    assert any("Äpfel" in r[2] for r in plain(rows))  # only A-Z are lower-cased, and only blanks and tabs part words


def test_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, big + 1, big)], "a long, l long, r long").select(phrases.score("a", "l", "r").alias("s")).head()
    assert row.s == 10**6 * big * big // ((big + 1) * big)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=300), st.integers(1, 40), st.booleans())
def test_trie_counts(triples, burst, pairs):
    """Bursting and spilling in between change no count, for phrases of two words and of three."""
    far = 1 << 31 if pairs else 1
    packed = [(a, b * far + c) for a, b, c in triples]
    trie, want, got = phrases.HatTrie(3 if pairs else 2, burst), Counter(packed), Counter()
    for part in (packed[::3], packed[1::3], packed[2::3]):
        ids = np.array(part, np.int64).reshape(-1, 2)
        trie.add(ids[:, 0], ids[:, 1])
        before = trie.entries()
        taken = trie.take(0.5)  # half of it leaves early
        assert trie.entries() + len(taken[0]) == before and 2 * len(taken[0]) >= before
        for a, t, n in zip(*map(np.ndarray.tolist, taken), strict=True):
            got[a, t] += n
    for a, t, n in zip(*map(np.ndarray.tolist, trie.take(1)), strict=True):
        got[a, t] += n
    assert trie.entries() == 0 and got == want


def test_words_are_counted_by_number():
    trie = phrases.HatTrie(1, 5)
    for part in ([3, 1, 3], [0, 7], []):
        trie.add(np.array(part, np.int64), np.zeros(len(part), np.int64))
    assert trie.entries() == 4 and [x.tolist() for x in trie.take(1)] == [[0, 1, 3, 7], [0] * 4, [1, 1, 2, 1]] and trie.entries() == 0


def test_runs_are_sorted(spark):
    c = phrases.Task("en", 2, Params(), None)
    c.add(["b a b c a b".encode(), "zz é a".encode()])
    rows = [x for b in c.spill(True) for x in b.column("phrase").to_pylist()]
    assert rows == sorted(rows, key=str.encode) and set(rows) == {"b a", "a b", "b c", "c a", "zz é", "é a"}
