"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The most frequent words of all documents (at most ``Params.words``, which bounds what
is broadcast) are compiled into a minimal acyclic automaton with shared suffixes.
Arcs carry additive outputs whose sum along a word is the word's number; a table
gives the number's ids. The automaton is a flat file that every Python worker
memory-maps. A batch's distinct words walk it together, one byte a step; words
that it lacks are merged exactly, all of a length together, by the lowest rank
first and the leftmost of equals.

Defined results: a null or empty text has no ids and decodes to the empty text;
special tokens inside a text are single ids; rows repeat as often as they come
in; extra columns are neither read nor returned by ``encoded``, and kept by
``with_token_counts``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved, texts

FORMAT = np.dtype("<i4")


@dataclass(frozen=True)
class Params:
    path: str = ""  # of the tokenizer file; empty: public_tokenizers' word_bpe_49k.json
    words: int = 1 << 16  # of the lexicon
    resolved: int = 400_000  # words that a worker keeps resolved


def tokenizer_path(params: Params) -> str:
    if params.path:
        return params.path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and the splitting rules of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        ids = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], FORMAT)
        self.final = np.array([ids[c + end] for c in letters], FORMAT)
        left = np.array([ids[a] for a, _ in model["merges"]], np.int64)
        right = np.array([ids[b] for _, b in model["merges"]], np.int64)
        made = np.array([ids[a + b] for a, b in model["merges"]], FORMAT)
        self.base = 1 << 17
        key = left * self.base + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(FORMAT), made
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        (pattern,) = (p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.latin_words, self.not_latin = latin_pattern(pattern)

    NEVER = np.iinfo(FORMAT).max

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NEVER)


def latin_pattern(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    r"""The pattern with \p{L}, \p{N} and \s spelt out for code points below U+0250, and what finds others."""
    spans = {"L": [], "N": [], "s": []}
    for c in map(chr, range(0x250)):
        for kind, hit in (("L", unicodedata.category(c)[0] == "L"), ("N", unicodedata.category(c)[0] == "N"), ("s", bool(regex.match(r"\s", c)))):
            if hit:
                spans[kind].append(re.escape(c))
    plain = pattern.replace(r"[\p{L}]", "[" + "".join(spans["L"]) + "]").replace(r"[\p{N}]", "[" + "".join(spans["N"]) + "]")
    plain = plain.replace(r"\s", "".join(spans["s"])).replace(r"\p{L}", "".join(spans["L"])).replace(r"\p{N}", "".join(spans["N"]))
    return re.compile(plain), re.compile("[^\x00-ɏ]")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def split_words(text: str, v: Vocabulary) -> list[str]:
    """Words of a text in order: normalised, lower case; special tokens as they are."""
    if v.special and "<|" in text:
        out: list[str] = []
        for piece in v.special.split(text):
            out += [piece] if piece in v.added else plain_words(piece, v)
        return out
    return plain_words(text, v)


def plain_words(text: str, v: Vocabulary) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a final sigma is not lowered by its place
    text = text.lower()
    return (v.words if v.not_latin.search(text) else v.latin_words).findall(text)


def merge_long(symbols: list[int], v: Vocabulary) -> list[int]:
    """Merges one long word: a heap of pairs by rank and place."""
    n = len(symbols)
    after, before, live = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (r := v.rank_of.get(symbols[i] * v.base + symbols[j])) is not None:
            heapq.heappush(heap, (r, i, symbols[i], symbols[j]))

    for i in range(n):
        offer(i)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not live[i] or j < 0 or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i], live[j] = int(v.made[r]), False
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s, alive in zip(symbols, live, strict=True) if alive]


LONG = 40


def merge_words(words: list[str], v: Vocabulary) -> list[list[int]]:
    """Ids of each word by its merges: words of one length are merged together."""
    out: list = [None] * len(words)
    raw = [w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        if size > LONG:
            for i in rows:
                b = np.frombuffer(raw[i], np.uint8)
                out[i] = merge_long([*v.inner[b[:-1]].tolist(), int(v.final[b[-1]])], v)
            continue
        b = np.frombuffer(b"".join(raw[i] for i in rows), np.uint8).reshape(-1, size)
        ids = v.inner[b]
        ids[:, -1] = v.final[b[:, -1]]
        ranks = np.full(ids.shape, v.NEVER, FORMAT)  # of the pair that begins here
        if size > 1:
            ranks[:, :-1] = v.rank(ids[:, :-1], ids[:, 1:])
        at, length = np.arange(len(rows)), np.full(len(rows), size)
        lane = np.arange(size)
        while len(at):
            r = ranks[at]
            place = r.argmin(1)
            best = r[np.arange(len(at)), place]
            more = best < v.NEVER
            at, place, best = at[more], place[more], best[more]
            if not len(at):
                break
            row = ids[at]
            moved = np.minimum(lane + (lane > place[:, None]), size - 1)  # what is right of the pair moves one to the left
            row, r = np.take_along_axis(row, moved, 1), np.take_along_axis(ranks[at], moved, 1)
            k = np.arange(len(at))
            row[k, place] = v.made[best]
            length[at] -= 1
            r[k, length[at] - 1] = v.NEVER
            r[lane >= length[at][:, None]] = v.NEVER
            for near in (place - 1, place):
                ok = (near >= 0) & (near + 1 < length[at])
                a = np.maximum(near, 0)
                new = v.rank(row[k, a], row[k, np.minimum(a + 1, size - 1)])
                r[k[ok], near[ok]] = new[ok]
            ids[at], ranks[at] = row, r
        for i, x, n in zip(rows.tolist(), ids.tolist(), length.tolist(), strict=True):
            out[i] = x[:n]
    return out


def compile_lexicon(words: list[str], ids: list[list[int]]) -> bytes:
    """A minimal acyclic transducer of sorted distinct words, as the bytes of a file.

    States with the same finality and arcs are one state. An arc's output is the
    number of words that come before it in its state, so outputs add up to the
    word's rank. Sections: counts, arc keys (state * 256 + byte, ascending), arc
    targets, arc outputs, final flags, starts of ids, ids.
    """
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    final_of: list[bool] = []
    size_of: list[int] = []

    def freeze(node: list) -> int:
        final, arcs = node
        key = (final, tuple(arcs))
        if (state := register.get(key)) is None:
            state = register[key] = len(arcs_of)
            arcs_of.append(key[1])
            final_of.append(final)
            size_of.append(final + sum(size_of[t] for _, t in arcs))
        return state

    order = sorted(range(len(words)), key=lambda i: words[i].encode())
    path: list[list] = [[False, []]]
    last = b""
    for i in order:
        word = words[i].encode()
        common = len(os.path.commonprefix([last, word]))
        while len(path) - 1 > common:
            byte = last[len(path) - 2]
            node = path.pop()
            path[-1][1].append((byte, freeze(node)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        byte = last[len(path) - 2]
        node = path.pop()
        path[-1][1].append((byte, freeze(node)))
    root = freeze(path[0])
    keys, targets, outputs = [], [], []
    for state, arcs in enumerate(arcs_of):
        before = int(final_of[state])
        for byte, target in arcs:
            keys.append(state * 256 + byte)
            targets.append(target)
            outputs.append(before)
            before += size_of[target]
    starts = np.cumsum([0, *(len(ids[i]) for i in order)])
    flat = [x for i in order for x in ids[i]]
    head = [len(keys), len(arcs_of), len(order), len(flat), root, 0]
    return b"".join(np.asarray(x, FORMAT).tobytes() for x in (head, keys, targets, outputs, final_of, starts, flat))


class Lexicon:
    """A compiled lexicon, mapped from a file that has no name any more once it is open."""

    def __init__(self, data: bytes):
        with tempfile.NamedTemporaryFile(delete=False) as f:
            f.write(data)
        self.map = np.memmap(f.name, FORMAT, "r")
        os.unlink(f.name)
        arcs, states, words, total, self.root, _ = map(int, self.map[:6])
        at = np.cumsum([6, arcs, arcs, arcs, states, words + 1, total])
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = (np.asarray(self.map[a:b]) for a, b in zip(at[:-1], at[1:], strict=True))

    def number(self, words: list[str]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.cumsum(sizes) - sizes
        state, number = np.full(len(raw), self.root, np.int64), np.zeros(len(raw), np.int64)
        out = np.full(len(raw), -1, np.int64)
        live, step = np.arange(len(raw)), 0
        if not len(self.keys):
            return out
        while len(live):
            done = sizes[live] == step
            hit = live[done]
            hit = hit[self.final[state[hit]] == 1]
            out[hit] = number[hit]
            live = live[~done]
            key = state[live] * 256 + flat[begin[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            live, at = live[there], at[there]
            state[live] = self.targets[at]
            number[live] += self.outputs[at]
            step += 1
        return out


#: Characters whose new words are resolved together.
CHUNK_CHARS = 2_000_000


class Encoder:
    """Ids of words: from the lexicon, or by merges; a bounded number stays resolved."""

    def __init__(self, lexicon: bytes, path: str, keep: int):
        self.lexicon, self.v, self.keep = Lexicon(lexicon), vocabulary(path), keep
        self.place: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.place.clear()
        self.ids: list[list[int]] = []
        self.id_text: list[str] = []
        self.token_text: list[str] = []
        self.sizes: list[int] = []

    def resolve(self, words: list[str]) -> None:
        number = self.lexicon.number(words)
        fresh = [w for w, n in zip(words, number.tolist(), strict=True) if n < 0]
        merged = iter(merge_words([w for w in fresh if w not in self.v.added], self.v))
        starts, ids, tokens = self.lexicon.starts, self.lexicon.ids, self.v.tokens
        for w, n in zip(words, number.tolist(), strict=True):
            own = ids[starts[n] : starts[n + 1]].tolist() if n >= 0 else [self.v.added[w]] if w in self.v.added else next(merged)
            self.place[w] = len(self.ids)
            self.ids.append(own)
            self.id_text.append(" ".join(map(str, own)))
            self.token_text.append(" ".join(map(tokens.__getitem__, own)))
            self.sizes.append(len(own))

    def batch(self, batch: list[str]) -> Iterator[list[int]]:
        """For each text the places of its words in ``ids``, ``id_text``, ``token_text`` and ``sizes``."""
        i = 0
        while i < len(batch):
            split, size = [], 0
            while i < len(batch) and size < CHUNK_CHARS:
                split.append(split_words(batch[i], self.v))
                size += len(batch[i])
                i += 1
            if len(self.place) > self.keep:
                self.forget()
            new = set().union(*split).difference(self.place)
            if new:
                self.resolve(list(new))
            for words in split:
                yield list(map(self.place.__getitem__, words))


def word_counts(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``word``, ``n``: how often each word occurs in all documents."""
    path = tokenizer_path(params)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, seen = vocabulary(path), Counter()
        for b in batches:
            for text in b["text"]:
                seen.update(split_words(text, v))
                if len(seen) > 1_000_000:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())}).astype({"word": object, "n": "int64"})

    partial = texts(docs).select("text").mapInPandas(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def frequency_class(n):
    """Counts below 1024 as they are, larger ones in 64ths of a doubling: few classes whatever the corpus."""
    return F.when(n < 1024, n).otherwise(F.floor(64 * F.log2(n)) + 384).cast("long")


def frequent_lexicon(docs: DataFrame, params: Params = Params()) -> bytes:
    """The compiled lexicon of the most frequent words, those that occur once left out.

    Whole frequency classes are taken from the top while they fit the bound, so no
    more rows than the bound reach the driver, from however many partitions.
    """
    v = vocabulary(tokenizer_path(params))
    counts = saved(word_counts(docs, params).where("n > 1").withColumn("class", frequency_class(F.col("n"))))
    least, room = None, params.words
    for r in sorted(counts.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["class"]
    top = [] if least is None else [r["word"] for r in counts.where(F.col("class") >= least).select("word").collect()]
    words = sorted(w for w in top if w not in v.added)
    return compile_lexicon(words, merge_words(words, v))


def encoded(docs: DataFrame, params: Params = Params(), lexicon: bytes | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every document."""
    return _encoded(docs, params, lexicon, "doc_id long, ids array<int>, decoded string", lambda e, at: (np.concatenate([e.ids[i] for i in at]).astype(np.int32) if at else np.zeros(0, np.int32), " ".join([e.token_text[i] for i in at])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded_digests(docs: DataFrame, params: Params = Params(), lexicon: bytes | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text of every document."""

    def row(e: Encoder, at: list[int]) -> tuple:
        return sum(map(e.sizes.__getitem__, at)), digest(" ".join(map(e.id_text.__getitem__, at))), digest(" ".join(map(e.token_text.__getitem__, at)))

    return _encoded(docs, params, lexicon, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row)


def _encoded(docs: DataFrame, params: Params, lexicon: bytes | None, schema: str, row) -> DataFrame:
    spark = prepare(docs.sparkSession)
    path, keep = tokenizer_path(params), params.resolved
    shared = spark.sparkContext.broadcast(frequent_lexicon(docs, params) if lexicon is None else lexicon)
    names = [c.split()[0] for c in schema.split(", ")]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = Encoder(shared.value, path, keep)
        for b in batches:
            rows = [row(e, at) for at in e.batch(b["text"].tolist())]
            yield pd.DataFrame([(d, *r) for d, r in zip(b["doc_id"], rows, strict=True)], columns=names)

    return texts(docs).mapInPandas(apply, schema)
