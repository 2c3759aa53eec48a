"""The field against enumeration of all chains, counts against plain Python, and verdicts on held-out labels."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomstream.llm import linecrf
from loomstream.llm.linecrf import Chains, Params
from loomstream.llm.queries import op12_line_crf


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + j for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()


@pytest.fixture
def case():
    rng = np.random.default_rng(4)
    sizes = np.array([3, 0, 1, 5, 2])
    return rng.normal(size=(11, 4)), sizes, rng.normal(size=(4, 2)), rng.normal(size=(2, 2))


def paths(scores, move, a, n):
    for p in itertools.product((0, 1), repeat=n):
        yield p, sum(scores[a + i, s] for i, s in enumerate(p)) + sum(move[s, t] for s, t in itertools.pairwise(p))


def test_decoding_and_sums_by_enumeration(case):
    x, sizes, emit, move = case
    scores, chains = x @ emit, Chains(sizes)
    got, (z, p, pairs) = linecrf.viterbi(scores, move, chains), linecrf.marginals(scores, move, chains)
    want_z, want_p, want_pairs, a = 0.0, np.zeros((11, 2)), np.zeros((2, 2)), 0
    for n in sizes:
        all_ = list(paths(scores, move, a, n))
        if n:
            assert tuple(got[a : a + n]) == max(all_, key=lambda r: r[1])[0]
            total = np.logaddexp.reduce([v for _, v in all_])
            want_z += total
            for path, v in all_:
                for i, s in enumerate(path):
                    want_p[a + i, s] += np.exp(v - total)
                for s, t in itertools.pairwise(path):
                    want_pairs[s, t] += np.exp(v - total)
        a += n
    assert np.isclose(z, want_z) and np.allclose(p, want_p) and np.allclose(pairs, want_pairs)


def test_gradient_by_differences(case):
    x, sizes, emit, move = case
    states, chains = np.array([0, 1, 1, 0, 1, 1, 0, 0, 1, 0, 0]), Chains(sizes)
    f = lambda e, m: linecrf.likelihood(linecrf.Field(e, m), x, states, chains)
    _, by_emit, by_move = f(emit, move)
    for weights, gradient, at in ((emit, by_emit, 0), (move, by_move, 1)):
        for i in np.ndindex(weights.shape):
            step = np.zeros(weights.shape)
            step[i] = 1e-5
            up, down = ((f(emit + s, move) if at == 0 else f(emit, move + s))[0] for s in (step, -step))
            assert np.isclose((up - down) / 2e-5, gradient[i], atol=1e-5)


def test_neighbours_decide():
    """A line that says nothing is taken for what stands around it."""
    field = linecrf.Field(np.array([[2.0, 0.0], [0.0, 2.0]]), np.array([[1.0, -1.0], [-1.0, 1.0]]))
    x = np.array([[1, 0], [0, 0], [1, 0], [0, 1], [0, 0], [0, 1]], float)
    assert linecrf.viterbi(x @ field.emit, field.move, Chains(np.array([3, 3]))).tolist() == [0, 0, 0, 1, 1, 1]


words = st.lists(st.sampled_from(["a", "b", "c", "é", "a b", "#", "<x>"]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(words, st.sampled_from([" ", "\n", "\t", "\r\n", "\x0b", "\n \n"])), max_size=6), max_size=5))
def test_counts(batch):
    batch = ["".join(s.join(w) + s for w, s in t) for t in batch]
    raw = [linecrf.words_of(t.encode()) for t in batch]
    repeats = linecrf.repeat_counts(raw)
    for t, w, n in zip(batch, raw, repeats, strict=True):
        lines = linecrf.lines_of(t)
        assert (len(w), *linecrf.plain_counts(t, lines), n) == plain_counts(t)[:5]


def test_query_of_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_line_crf(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == plain_counts(docs[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed and r.content_words >= 0.5 * r.n_words) and r.content_words <= r.n_words and r.n_content_lines <= r.n_lines


def test_held_out_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    own = op12_line_crf(spark, sf).join(labels, "doc_id").where("not base_failed").selectExpr("kept", "quality = 1 AS good", "crc32(CAST(doc_id AS STRING)) % 5 = 0 AS held_out").collect()
    held = [r for r in own if r.held_out]
    assert len(held) > 40
    for rows in (held, own):
        good, bad = [r for r in rows if r.good], [r for r in rows if not r.good]
        assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(not r.kept for r in bad) >= 0.9 * len(bad)


CLEAN = "The harbour was quiet that morning, and the boats lay still along the wall. Nobody had come down yet except the man who sold bread from a cart."
JUNK = "thar&&& of%%% erhe*** and### inthe$$$ onre*** the&&& was%%% ering*** thion### outh$$$"


def test_edges(spark):
    long = "\n".join([CLEAN.replace("quiet", f"quiet{i}").replace("boats", f"boats{i}") for i in range(3000)])
    rows = [(None, CLEAN + "\n" + CLEAN[::-1] + "\n" + " ".join(f"w{i}" for i in range(30))), (1, None), (1, ""), (2, " \n\t\n"), (3, JUNK), (3, JUNK), (4, " "), (5, long), (6, "\n".join(f"{JUNK} x{i}" for i in range(9)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "'x' AS n_words", "2 AS label")
    labels = spark.createDataFrame([(10 + i, i % 2) for i in range(40)] + [(7, None), (None, 1)], "doc_id long, quality int")
    sample = spark.createDataFrame([(10 + i, (CLEAN if i % 2 else JUNK) + f"\nline {i}.\n" + (CLEAN if i % 2 else JUNK)) for i in range(40)], "doc_id long, text string")
    field = linecrf.fit(sample, labels)
    got = linecrf.with_verdict(linecrf.judged(docs, field)).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(plain_counts(t))
    for r in got:
        assert tuple(r[c] for c in COLUMNS) in want[r.doc_id]
    kept = {r.doc_id: r.kept for r in got}
    assert kept[None] and not any(kept[d] for d in (1, 2, 3, 4, 6))
    assert linecrf.line_quality(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):  # nothing to learn from
        assert sum(r.kept for r in linecrf.line_quality(sample.unionByName(docs.select("doc_id", "text")), none).collect()) >= 1


def test_marked_lines(spark):
    docs = spark.createDataFrame([(1, f"{CLEAN}\n\nAll rights reserved."), (2, None)], "doc_id long, text string")
    field = linecrf.learnt([], np.zeros(0), Params())
    assert [(r.line, r.text, r.content) for r in linecrf.marked_lines(docs, field).orderBy("line").collect()] == [(0, CLEAN, True), (1, "All rights reserved.", False)]
