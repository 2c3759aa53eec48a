"""LM scoring: a hierarchical Pitman-Yor model of words given the word before.

Each context word has a restaurant; all of them share one parent restaurant, whose
base is uniform over the V training words and one type for all others. Seating
follows the Chinese restaurant process with discounts and is sampled by Gibbs:
in a sweep the customers of each dish stand up and are seated again, given where
all others sit. The number of their tables is drawn from its exact conditional
distribution for up to ``EXACT`` customers; more are seated in batches. The dishes
of a shard take turns in ``BLOCKS`` blocks, those of one block at the same time.
Each sweep after the first ones gives predictive probabilities, from the tables of
that sweep in context and parent; their average is a token's probability, and a
text's score is the sum of its base-10 logarithms over its words and its end.

Spark deals the work twice by key, numpy does the arithmetic of a share:

* Documents are dealt into groups of some megabytes. A group sends each of its
  distinct (context, word) cells once, with the count in training documents, to
  the context's shard, and each distinct word to the word's shard. Cells of
  frequent contexts are dealt by their word as well, so that no shard holds more
  than its share; what such a shard needs of the others (tables of the context and
  of the parent) it estimates by the part it sees of them, as approximate
  distributed Gibbs sampling does.
* Context shards seat their customers and send the tables to the word shards,
  where they are the customers of the parent. Both reply to the groups in the
  order of the request, and the groups score their documents.

Words are cut at ASCII white space and lowered in A-Z only; they stand as 56-bit
hashes, and within a shard's restaurants as 40-bit ones. ``base_score`` is the smoothed unigram
model of all training tokens.

Defined results: a null or empty text is its end alone; a null doc_id counts as
training text; without training documents all words are unknown and have the
probability 1 / (V + 1) = 1. Rows repeat as often as they come in; extra columns
are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, prepare, texts

FOLDS = 10


@dataclass(frozen=True)
class Params:
    group_bytes: int = 12 << 20  # of text that a task scores together
    strength: float = 1.0  # of every restaurant
    burn: int = 2  # sweeps that are not averaged
    samples: int = 4  # sweeps that are
    seed: int = 20


U8, U1 = np.dtype("<u8"), np.uint64(1)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
MASK40 = np.uint64((1 << 40) - 1)
RADIX = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


#: Stands for the end of a text, and as a context for what is before its first word.
END = np.uint64(0xE0D0E0D0E0D0E0D1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of RADIX and of its inverse, modulo 2**64."""
    up, down = np.full(n + 1, RADIX, np.uint64), np.full(n + 1, pow(RADIX, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def token_hashes(batch: list[str], table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text's end included, and how many each text has."""
    hashes, counts = [], np.zeros(len(batch), np.int64)
    i = 0
    raw = [t.encode("utf-8", "replace") for t in batch]
    while i < len(raw):
        j, size = i, 0
        while j < len(raw) and (j == i or size + len(raw[j]) < CHUNK):
            size += len(raw[j]) + 1
            j += 1
        data = np.frombuffer(b"\n".join(raw[i:j]) + b"\n", np.uint8)
        up, down = table if len(data) < len(table[0]) else powers(len(data))
        low = np.where((data >= 65) & (data <= 90), data + 32, data)
        inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + U1) * up[: len(low)], dtype=np.uint64)])
        h = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * M1)
        stops = np.cumsum([len(r) + 1 for r in raw[i:j]])  # where texts end in the buffer
        n = np.searchsorted(begin, stops)
        hashes.append(np.insert(h, n, END))
        counts[i:j] = np.diff(np.concatenate([[0], n])) + 1
        i = j
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, 1) if data else b""


def whole(data: bytes) -> bytes:
    return zstandard.decompress(data) if data else b""


def pack(values: np.ndarray, width: int) -> bytes:
    """The low bytes of integers, byte plane by byte plane, compressed."""
    return squeezed(values.astype(U8).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def unpack(data: bytes, width: int) -> np.ndarray:
    data = whole(data)
    n = len(data) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view(U8).ravel()


def float_planes(values: np.ndarray) -> bytes:
    return squeezed(values.astype("<f4").view(np.uint8).reshape(-1, 4).T.tobytes())


def from_float_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(whole(data), np.uint8).reshape(4, -1).T).view("<f4").ravel().astype(np.float64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of integers (0 or more), rising, and the place of each integer among them."""
    values = values.astype(np.int64, copy=False)
    bits = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 63:
        return np.unique(values, return_inverse=True)
    both = np.sort((values << bits) | np.arange(len(values)))  # value and index as one number, which sorts faster than indices by value
    at = both & ((1 << bits) - 1)
    both >>= bits
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    place = np.empty(len(both), np.int32)
    place[at] = np.cumsum(new, dtype=np.int32) - 1
    return both[new], place


def dealt(home: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The indices by shard, in their order within each, and where each shard's begin."""
    bits = len(home).bit_length()
    order = np.sort((home << bits) | np.arange(len(home))) & ((1 << bits) - 1)
    return order, np.concatenate([[0], np.cumsum(np.bincount(home, minlength=shards))])


@dataclass
class Group:
    """The distinct words and cells of a group of documents, in the order in which shards see them."""

    counts: np.ndarray  # tokens of each document
    word_of: np.ndarray  # of each token, its place in words
    cell_of: np.ndarray  # of each token, its place in the cells
    words: np.ndarray  # hashes, sorted by their low 40 bits, then whole
    word_count: np.ndarray  # in training documents
    context: np.ndarray  # of each cell, a 40-bit hash
    context_place: np.ndarray  # place of a cell's context in words
    dish: np.ndarray  # 40-bit hash
    dish_place: np.ndarray
    cell_count: np.ndarray
    cell_order: list[np.ndarray]  # of each shard, its cells by context and dish
    word_order: list[np.ndarray]


def word_shard(dish: np.ndarray, shards: int) -> np.ndarray:
    return (mix(dish & MASK40) % np.uint64(shards)).astype(np.int64)


def grouped(text: list[str], train: np.ndarray, shards: int, hot: np.ndarray, table: tuple) -> Group:
    w, counts = token_hashes(text, table)
    met, words = pd.factorize(w)
    by_low = np.lexsort((words, words & MASK40))  # whatever the order of the documents
    words, rank = words[by_low], np.empty(len(words), np.int64)
    rank[by_low] = np.arange(len(words))
    word_of = rank[met]
    learnt = np.repeat(train, counts).astype(np.float64)
    before = np.empty(len(w), np.int64)
    before[1:] = word_of[:-1]
    before[np.cumsum(counts) - counts] = np.flatnonzero(words == END)[0]  # a text begins
    del w, met
    bits = len(words).bit_length()
    cells, cell_of = distinct((before << bits) | word_of)
    del before
    word_of, cell_of = word_of.astype(np.int32), cell_of.astype(np.int32)  # a group has fewer tokens than that
    place, dish_place = cells >> bits, cells & ((1 << bits) - 1)
    del cells
    low = words & MASK40
    dish = low[dish_place]
    shard = (mix(words) % np.uint64(shards)).astype(np.int64)[place]
    spread = np.flatnonzero(np.isin(words, hot)[place])
    shard[spread] = (mix(words[place[spread]] ^ (dish[spread] * M2)) % np.uint64(shards)).astype(np.int64)
    order, at = dealt(shard, shards)
    by_home, wat = dealt(word_shard(words, shards), shards)
    return Group(
        counts, word_of, cell_of, words, np.bincount(word_of, learnt, len(words)).astype(np.int64), low[place], place, dish, dish_place, np.bincount(cell_of, learnt, len(place)).astype(np.int64),
        [order[at[s] : at[s + 1]] for s in range(shards)], [by_home[wat[s] : wat[s + 1]] for s in range(shards)],
    )


EXACT = 1024  # customers of a dish up to which the number of its tables has its exact distribution
NEGLIGIBLE = np.exp(-40.0)  # ratio of weights below which a number of tables is not drawn
BLOCKS = 8


def log_arrangements(most: int, discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t): ways to seat c customers at t tables, each weighted by its discounted seats."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for c in range(1, most + 1):
        t = np.arange(1, c)
        out[c, 1:c] = out[c - 1, 1:c] + np.log(c - 1 - discount * t)  # the last customer joins a table
        out[c, 1 : c + 1] = np.logaddexp(out[c, 1 : c + 1], out[c - 1, :c])  # or opens one
    return np.asfortranarray(out)  # read by t


def seat(count: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float, arrangements: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Seats the customers of each dish again: new numbers of tables.

    ``others``: tables of other dishes in the restaurant; ``parent``: the dish's probability there.
    t tables of c customers have the weight S(c, t) times the product over i < t of
    (strength + discount * (others + i)) * parent. Weights are made from t to t + 1, and t takes the
    place of what was drawn so far with the chance of its share in the sum up to it. Of dishes with more
    than EXACT customers the first 32 come one at a time, later ones in batches of an eighth of those seated.
    """
    tables = np.minimum(count, 1).astype(np.float64)
    two = np.flatnonzero(count == 2)
    apart = (strength + discount * (others[two] + 1)) * parent[two]  # to 1 - discount at one table
    tables[two] += rng.random(len(two)) * (1 - discount + apart) < apart
    few = np.flatnonzero((count > 2) & (count <= EXACT))
    c, rest, p = count[few], strength + discount * others[few], parent[few]
    weight, total, drawn = np.ones(len(few)), np.ones(len(few)), np.ones(len(few))
    step, t = np.zeros(arrangements.shape[0]), 1
    while len(few):
        step[: t + 1] = 0  # so that c customers have no weight of more than c tables
        step[t + 1 :] = np.exp(arrangements[t + 1 :, t + 1] - arrangements[t + 1 :, t])
        weight *= step[c] * p * (rest + discount * t)
        total += weight
        t += 1
        drawn[rng.random(len(few)) * total < weight] = t
        if total.max() > 1e150:  # only ratios count; a step is far from the 1e150 that are left
            scale = np.where(total > 1e100, 1e-100, 1.0)
            weight, total = weight * scale, total * scale
        if t < 8 or t % 8 == 0 or t == arrangements.shape[1] - 1:
            # weights are log-concave in t, so from here on all are below a 10**17th of the largest, which is a t-th of the sum at least
            more = (c > t) & (weight * t > total * NEGLIGIBLE)
            tables[few[~more]] = drawn[~more]
            few, c, rest, p, weight, total, drawn = (x[more] for x in (few, c, rest, p, weight, total, drawn))
    live = np.flatnonzero(count > EXACT)
    i = np.ones(len(live))
    while len(live):
        step = np.minimum(np.where(i < 32, 1, np.floor(i / 8)), count[live] - i)
        new = (strength + discount * (others[live] + tables[live])) * parent[live]
        chance = np.clip(new / (new + np.maximum(i - discount * tables[live], 1e-9)), 0, 1)
        tables[live] += rng.binomial(step.astype(np.int64), chance)
        i = i + step
        more = i < count[live]
        live, i = live[more], i[more]
    return tables


def discount_of(count: np.ndarray) -> float:
    ones, twos = int((count == 1).sum()), int((count == 2).sum())
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.9))


REQUEST = "shard int, gid int, u binary, nu binary, w binary, c binary, words binary, wc binary"
TABLES = "shard int, words binary, customers binary, contexts binary, context_tables binary, seats binary"
REPLY = "gid int, shard int, kind int, a binary, b binary, c binary, totals array<double>"


@dataclass
class Merged:
    """The cells of all requests of a context shard."""

    contexts: np.ndarray
    dishes: np.ndarray
    context_of: np.ndarray  # of each cell, its place in contexts
    dish_of: np.ndarray
    count: np.ndarray
    cell: np.ndarray  # of each cell of each request, its place
    bounds: np.ndarray  # where each request's begin


def merged(rows: pd.DataFrame) -> Merged:
    """rows: the requests by gid."""
    dish = [unpack(x, 5) for x in rows["w"]]
    bounds = np.cumsum([0, *(len(x) for x in dish)])
    contexts, context = distinct(np.concatenate([unpack(x, 5) for x in rows["u"]]))
    context = np.repeat(context, np.concatenate([unpack(x, 4) for x in rows["nu"]]).astype(np.int64))
    dishes, dish = distinct(np.concatenate(dish))
    bits = len(dishes).bit_length()
    cells, cell = distinct((context.astype(np.int64) << bits) | dish)
    count = np.bincount(cell, np.concatenate([unpack(x, 4) for x in rows["c"]]).astype(np.float64), len(cells)).astype(np.int64)
    return Merged(contexts.astype(np.uint64), dishes.astype(np.uint64), cells >> bits, cells & ((1 << bits) - 1), count, cell, bounds)


def seated(m: Merged, shard: int, shards: int, hot: np.ndarray, params: Params):
    """Samples the seating of a context shard.

    Returns the tables of each context and dish in every sampled sweep, of each cell
    the sum of its tables over those sweeps, and the discount.

    A dish's probability in the parent is, as far as this shard sees, the share of the tables that
    serve it elsewhere, and that of a dish with one table where there are none.
    """
    contexts, dishes, iu, iw, count = m.contexts, m.dishes, m.context_of, m.dish_of, m.count
    discount = discount_of(count)
    rng = np.random.default_rng([params.seed, shard])
    t = np.minimum(count, 1).astype(np.float64)
    of_context, of_dish, total = np.bincount(iu, t, len(contexts)), np.bincount(iw, t, len(dishes)), t.sum()
    scale = np.where(np.isin(contexts, hot & MASK40), float(shards), 1.0)  # a frequent context sits in all shards
    lone = discount_of(of_dish)
    live = np.flatnonzero(count > 1)  # all other customers sit alone
    blocks = np.array_split(rng.permutation(live), BLOCKS)
    arrangements = log_arrangements(int(min(EXACT, count.max(initial=1))), discount)
    by_context, by_dish, summed = [], [], np.zeros(len(t))
    for sweep in range(params.burn + params.samples):
        for k in blocks:
            u, w = iu[k], iw[k]
            rest = shards * (of_dish[w] - t[k])
            parent = np.where(rest > 0, rest, lone) / (params.strength + shards * (total - t[k]))
            new = seat(count[k], scale[u] * (of_context[u] - t[k]), np.minimum(parent, 1.0), discount, params.strength, arrangements, rng)
            change = new - t[k]
            of_context, of_dish, total = of_context + np.bincount(u, change, len(contexts)), of_dish + np.bincount(w, change, len(dishes)), total + change.sum()
            t[k] = new
        if sweep >= params.burn:
            by_context.append(of_context)
            by_dish.append(of_dish)
            summed += t
    return np.stack(by_context), np.stack(by_dish), summed, discount


COUNT_BYTES = 6  # of a word's count in all training documents; its high planes are zeros, which shuffles compress away


def scored(rows: DataFrame, shards: int, hot: np.ndarray, params: Params) -> DataFrame:
    """rows: gid, doc_id, held_out, text."""
    table_size = CHUNK * 2

    def ask(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        g = grouped(docs["text"].tolist(), ~docs["held_out"].to_numpy(bool), shards, hot, powers(table_size))
        out = []
        for s in range(shards):
            at, wat = g.cell_order[s], g.word_order[s]
            if not len(at) and not len(wat):
                continue  # so a group sends no more requests than it has words and contexts
            u, starts = (np.zeros(0, np.uint64), np.zeros(0, np.int64)) if not len(at) else _runs(g.context[at])
            out.append((s, key[0], pack(u, 5), pack(np.diff(np.append(starts, len(at))), 4), pack(g.dish[at], 5), pack(g.cell_count[at], 4), pack(g.words[wat], 7), pack(g.word_count[wat], 4)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in REQUEST.split(", ")])

    def tables(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        m = merged(asked.sort_values("gid", kind="stable"))
        of_context, of_dish, summed, discount = seated(m, int(key[0]), shards, hot, params)
        known, opened = np.flatnonzero(of_dish[0] > 0), np.flatnonzero(of_context[0] > 0)
        order, bounds = dealt(word_shard(m.dishes[known], shards), shards)
        known = known[order]
        order, cbounds = dealt(word_shard(m.contexts[opened], shards), shards)
        opened = opened[order]
        out = [(int(key[0]), b"", b"", b"", b"", pack(summed[m.count > 1], COUNT_BYTES))]  # kept for answers(); all other customers sit alone
        for s in np.flatnonzero((np.diff(bounds) > 0) | (np.diff(cbounds) > 0)).tolist():
            k, c = known[bounds[s] : bounds[s + 1]], opened[cbounds[s] : cbounds[s + 1]]
            out.append((s, pack(m.dishes[k], 5), pack(of_dish[:, k].ravel(), 5), pack(m.contexts[c], 5), float_planes(discount * of_context[:, c].ravel()), b""))
        return pd.DataFrame(out, columns=[c.split()[0] for c in TABLES.split(", ")])

    def cells(shard: int, asked: pd.DataFrame, seats: list[bytes]) -> list[tuple]:
        """The counts and tables of each request's cells, from the seating that tables() has sampled."""
        m = merged(asked)
        summed = params.samples * np.minimum(m.count, 1)
        summed[m.count > 1] = unpack(next(filter(len, seats)), COUNT_BYTES) if (m.count > 1).any() else 0
        discount, out = discount_of(m.count), []
        for i, gid in enumerate(asked["gid"]):
            own = m.cell[m.bounds[i] : m.bounds[i + 1]]
            out.append((gid, shard, 0, pack(m.count[own], COUNT_BYTES), pack(summed[own], COUNT_BYTES), b"", [discount]))
        return out

    def answers(key: tuple, asked: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame([], columns=[c.split()[0] for c in REPLY.split(", ")])
        asked = asked.sort_values("gid", kind="stable")
        out = [*cells(int(key[0]), asked, sent["seats"].tolist()), *parent(int(key[0]), asked[["gid", "words", "wc"]], sent)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in REPLY.split(", ")])

    def parent(shard: int, asked: pd.DataFrame, sent: pd.DataFrame) -> list[tuple]:
        """The tables and customers of each request's words; samples the seating of the parent."""
        words = [unpack(x, 7) for x in asked["words"]]
        flat = np.concatenate(words)
        names, place = np.unique(flat, return_inverse=True)
        count = np.zeros(len(names), np.int64)
        np.add.at(count, place, np.concatenate([unpack(x, 4) for x in asked["wc"]]).astype(np.int64))
        short = names & MASK40
        order = np.argsort(short, kind="stable")

        def gather(keys: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
            """Sums by word of each sampled sweep's values."""
            out = np.zeros((params.samples, len(names)))
            for k, v in zip(keys, values, strict=True):
                if len(names) and len(k):
                    at = np.minimum(np.searchsorted(short[order], k), len(names) - 1)
                    ok = short[order][at] == k
                    out[:, order[at[ok]]] += v.reshape(params.samples, -1)[:, ok]  # a sender names a word once
            return out

        customers = gather([unpack(x, 5) for x in sent["words"]], [unpack(x, 5).astype(np.float64) for x in sent["customers"]])
        ctables = gather([unpack(x, 5) for x in sent["contexts"]], [from_float_planes(x) for x in sent["context_tables"]])
        known = count > 0
        seats = customers.astype(np.int64)
        discount = discount_of(seats[0][known])
        rng = np.random.default_rng([params.seed, 1 << 20, shard])
        base = np.full(len(names), 1 / max(1.0, shards * known.sum() + 1))
        blocks = np.array_split(rng.permutation(len(names)), BLOCKS)
        arrangements = log_arrangements(int(min(EXACT, seats.max(initial=1))), discount)
        t, opened = np.minimum(seats[0], 1).astype(float), []
        for sweep in range(params.burn + params.samples):
            own = seats[max(0, sweep - params.burn)]
            for k in blocks:
                t[k] = seat(own[k], shards * (t.sum() - t[k]), base[k], discount, params.strength, arrangements, rng)
            if sweep >= params.burn:
                opened.append(t.copy())
        opened = np.stack(opened)
        totals = [float(count.sum()), float(known.sum()), discount, *customers.sum(axis=1), *(discount * opened.sum(axis=1))]
        out, at = [], 0
        for gid, own in zip(asked["gid"], words, strict=True):
            k = place[at : at + len(own)]
            at += len(own)
            both = np.concatenate([customers[:, k].ravel(), opened[:, k].ravel()])
            out.append((gid, shard, 1, pack(count[k], COUNT_BYTES), pack(both, 5), float_planes(ctables[:, k].ravel()), totals))
        return out

    def finish(key: tuple, docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame([], columns=columns)
        g = grouped(docs["text"].tolist(), ~docs["held_out"].to_numpy(bool), shards, hot, powers(table_size))
        samples = params.samples
        weight, count = np.zeros(len(g.dish)), np.zeros(len(g.words))
        number, ctables = (np.zeros((samples, len(g.words)), np.float32) for _ in range(2))
        n = v = 0.0
        customers, spare = np.zeros(samples), np.zeros(samples)
        for r in replies.itertuples(index=False):
            if r.kind == 0:
                weight[g.cell_order[r.shard]] = unpack(r.a, COUNT_BYTES) - r.totals[0] / samples * unpack(r.b, COUNT_BYTES)
            else:
                at = g.word_order[r.shard]
                seats, opened = unpack(r.b, 5).astype(np.float64).reshape(2, samples, -1)
                count[at], number[:, at], ctables[:, at] = unpack(r.a, COUNT_BYTES), seats - r.totals[2] * opened, from_float_planes(r.c).reshape(samples, -1)
                n, v, customers, spare = n + r.totals[0], v + r.totals[1], customers + r.totals[3 : 3 + samples], spare + r.totals[3 + samples :]
        at = g.context_place
        # each training token but an end precedes a token, and each end stands for the beginning of its text,
        # so a context's customers are the training tokens of its word
        denominator = params.strength + count[at]
        passed = np.zeros(len(g.dish))  # what the context leaves to its parent, averaged over the sweeps
        for s in range(samples):
            p0 = (number[s] + (params.strength + spare[s]) / (v + 1)) / (params.strength + customers[s])
            passed += (params.strength + ctables[s][at]) * p0[g.dish_place] / samples
        log_p = np.log10((weight + passed) / denominator)
        base = np.log10(count + 0.1)
        starts = np.cumsum(g.counts) - g.counts
        sums = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": g.counts, "n_known": sums((count > 0)[g.word_of].astype(np.int64)), "train_tokens": int(n),
                "base_score": sums(base[g.word_of]) - g.counts * np.log10(n + 0.1 * (v + 1)), "score": sums(log_p[g.cell_of]),
            }
        )[columns]

    asked = rows.groupBy("gid").applyInPandas(ask, REQUEST)
    sent = asked.groupBy("shard").applyInPandas(tables, TABLES)
    replies = asked.groupBy("shard").cogroup(sent.groupBy("shard")).applyInPandas(answers, REPLY)
    return rows.groupBy("gid").cogroup(replies.groupBy("gid")).applyInPandas(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and where each begins."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return sorted_values[starts], starts


def frequent_contexts(docs: DataFrame, shards: int) -> np.ndarray:
    """Every context that precedes a 4 x shards-th of all tokens; 8 x shards of them at most.

    A partition names the contexts of an 8 x shards-th of its own tokens; a context
    that is that frequent overall keeps at least half of that in what is named.
    """

    def count(batches):
        table, seen, total = powers(CHUNK * 2), {}, 0
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            h, _ = token_hashes(b["text"].tolist(), table)
            total += len(h)
            k, n = np.unique(h, return_counts=True)
            keep = n * 64 * shards >= len(h)  # rarer ones in a batch cannot add up to much
            words, place = np.unique(np.concatenate([words, k[keep]]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n[keep]]), len(words)).astype(np.int64)
        keep = counts * 16 * shards >= total
        yield pd.DataFrame({"word": words[keep].view(np.int64), "n": counts[keep], "total": 0})
        yield pd.DataFrame({"word": np.zeros(1, np.int64), "n": np.zeros(1, np.int64), "total": [total]})

    rows = docs.select("text").mapInPandas(count, "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = rows.crossJoin(F.broadcast(rows.agg(F.sum("total").alias("all")))).where(F.col("n") * 8 * shards >= F.col("all")).where("n > 0")
    found = np.array([r["word"] for r in rows.select("word").collect()], np.int64).view(np.uint64)
    return np.unique(found)


def language_model_scores(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Scores every document with a model of those outside the held-out fold."""
    spark = prepare(docs.sparkSession)
    own = texts(docs, F.coalesce(crc_mod("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"))
    size = own.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = max(1, -(-int(size) // params.group_bytes))
    hot = frequent_contexts(own, shards)
    # dealt by the row's place too, so that rows without an id or with the same one are spread
    gid = F.pmod(F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    rows = own.select(gid.alias("gid"), "doc_id", "held_out", "text")
    return scored(rows, shards, hot, params)
