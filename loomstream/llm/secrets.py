"""Secret scans: patterns, and a battery of randomness tests.

Base spans come from three patterns (``assign``, ``access``, ``hex``), leftmost
and non-overlapping per kind. The battery adds spans of kind ``random``: runs of
the base64 alphabets, of ``Params.shortest`` characters or more, that look drawn
evenly from the smallest alphabet (encoding) that holds all their characters.

Three p-values are taken for each run: chi-squared uniformity of the alphabet's
characters, the number of runs above and below the alphabet's middle, and serial
correlation of neighbours. Fisher's method joins them. Words and other text fail
these tests; the Benjamini-Hochberg rule over all runs of an encoding and length
class rejects them at a false-discovery rate, and of the others so many are taken
for random as the evenness of their p-values explains, so that what is reported
has a bounded share of text too. Where a run's length gives the battery power, that
decides: where a run of that length whose characters repeat as often as a text's
do would fail the uniformity test with a probability of ``Params.power`` at least
(``least_length``: 16 characters of base64, 31 of hexadecimal, 27 of decimals, 30
of base36, 36 of base32). Of shorter runs the same rule decides, but only in
classes of which at least ``Params.share`` is random by the same estimate: in a
class of hexadecimal keys each one is reported, in one of long words none. A run
that has both ``+`` or ``/`` and ``-`` or ``_`` is no encoding as a whole; it is cut at
``+`` and ``/``, as a path is, and its parts are tested. Runs that overlap a base
span are left to it.

All of it is DataFrame functions: a text is cut by ``split`` at the matches that
``regexp_extract_all`` returns, so a match starts where the lengths of what
stands before it add up. Runs are stored before they are tested, and one pass
over a run's characters gives all its sums, so work grows with their length.
Offsets count code points.

Defined results: a null or empty text has no spans (the digest of the empty
text); rows repeat as often as they come in; a null ``doc_id`` is kept; extra
columns are dropped by ``scan`` and kept by ``without_secrets``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, saved, texts

# The base patterns and their least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"  # written out in base_spans
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class Params:
    shortest: int = 16  # characters of a run that the battery tests
    rate: float = 0.05  # false-discovery rate of the rejections
    power: float = 0.95  # chance that a text's run fails at that rate, from which on a run is reported whatever its class holds
    share: float = 0.5  # random runs of a class in which shorter runs are reported


#: Encodings from the smallest alphabet on, with their characters.
ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("hex_upper", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36_upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Chance that two characters of a text are equal; in small alphabets, twice that of even characters.
TEXT_REPEATS = 0.065


def least_length(k: int, params: Params) -> int:
    """Characters of an alphabet of k from which the uniformity test tells text with the power asked for."""
    d, excess, normal = k - 1, max(TEXT_REPEATS, 2 / k) * k - 1, NormalDist()
    limit = d * (1 - 2 / (9 * d) + normal.inv_cdf(1 - params.rate) * math.sqrt(2 / (9 * d))) ** 3
    n = 2
    while normal.cdf((d + n * excess - limit) / math.sqrt(2 * (d + 2 * n * excess))) < params.power:
        n += 1
    return n


#: Matches whose offsets are added up together: the work is in proportion to the matches.
STRIDE = 256


def located(text: Column, pattern: str, matched: Column) -> Column:
    """Array of (start, end) of the matches in order; ``matched`` is the array of matched texts."""
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(matched, gaps, lambda m, g: F.struct(F.length(g).alias("g"), F.coalesce(F.length(m), F.lit(0)).alias("m")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    # offsets within each stride, then where each stride begins
    strides = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(matched) - 1) / STRIDE).cast("int")),
        lambda i: F.aggregate(
            F.slice(steps, i * STRIDE + 1, F.least(F.lit(STRIDE), F.size(matched) - i * STRIDE)), zero,
            lambda acc, s: F.struct(
                (acc["at"] + s["g"] + s["m"]).alias("at"),
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["g"]).alias("start"), (acc["at"] + s["g"] + s["m"]).alias("end")))).alias("spans"),
            ),
        ),
    )
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("out"))
    moved = lambda spans, by: F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end")))
    whole = F.aggregate(strides, none, lambda acc, s: F.struct((acc["at"] + s["at"]).alias("at"), F.concat(acc["out"], F.array(moved(s["spans"], acc["at"]))).alias("out")), lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(matched) > 0, whole).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans_of(text: Column, kind: int, pattern: str, wanted) -> Column:
    """Spans of one kind; ``wanted(i, span)`` tells whether the i-th match counts."""
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.filter(located(text, pattern, matched), lambda s, i: wanted(i, s))
    made = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast(SPAN)).cast(SPAN)


def base_spans(text: Column) -> list[Column]:
    """The spans of each base kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    longer = lambda n: lambda i, s: s["end"] - s["start"] >= n
    # a run of hex digits that is long enough is the whole run either way; the longer pattern skips the others sooner
    long_hex = f"(?<![0-9a-f])[0-9a-f]{{{HEX_LENGTH},}}"
    return [
        spans_of(text, 0, ASSIGN, lambda i, s: F.length(F.get(values, i)) >= ASSIGN_VALUE),
        spans_of(text, 1, ACCESS, longer(ACCESS_LENGTH)),
        spans_of(text, 2, long_hex, longer(HEX_LENGTH)),
    ]


def rendered(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def normal_tail(z: Column) -> Column:
    """P(|Z| > |z|) of the standard normal law, by a rational form of the error function (error below 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.lit(1e-12), F.least(F.lit(1.0), poly * F.exp(-x * x)))


def with_p_values(candidates: DataFrame, params: Params = Params()) -> DataFrame:
    """Adds ``encoding``, ``n``, the joint ``p`` and whether the length gives ``power`` to rows with a ``token``; drops tokens that fit no encoding."""
    bare = F.rtrim(F.col("token"), F.lit("="))
    fits = None
    for name, letters in ENCODINGS:
        inside = F.length(F.translate(bare, letters, "")) == 0
        one = F.struct(F.lit(name).alias("encoding"), F.lit(letters).alias("letters"), F.lit(float(len(letters))).alias("k"), F.lit(least_length(len(letters), params)).alias("least"))
        fits = F.when(inside, one) if fits is None else fits.when(inside, one)
    df = candidates.select("*", bare.alias("bare"), fits.alias("fit")).where(F.col("fit").isNotNull() & (F.length("bare") > 1))
    df = df.select("*", "fit.*", F.length("bare").cast("double").alias("n"))
    count = lambda ch: (F.length("bare") - F.length(F.replace(F.col("bare"), ch, F.lit("")))).cast("double")
    squares = F.aggregate(F.transform(F.split("letters", ""), lambda ch: count(ch) * count(ch)), F.lit(0.0), lambda acc, v: acc + v)
    codes = F.transform(F.split("bare", ""), lambda ch: (F.position(ch, F.col("letters")) - 1).cast("long"))
    high = lambda x: (2 * x > F.col("k") - 1).cast("long")
    names = ("last", "first", "up", "changes", "sum", "square", "lagged")
    zero = F.struct(F.lit(-1).cast("long").alias("last"), *[F.lit(0).cast("long").alias(c) for c in names[1:]])

    def step(acc: Column, x: Column) -> Column:
        """Adds a character's code to the sums."""
        begun = acc["last"] >= 0
        values = (
            x, F.when(begun, acc["first"]).otherwise(x), acc["up"] + high(x), acc["changes"] + F.when(begun, F.abs(high(x) - high(acc["last"]))).otherwise(F.lit(0)),
            acc["sum"] + x, acc["square"] + x * x, acc["lagged"] + F.when(begun, x * acc["last"]).otherwise(F.lit(0)),
        )
        return F.struct(*[v.cast("long").alias(c) for v, c in zip(values, names, strict=True)])

    df = df.select("*", squares.alias("squares"), F.aggregate(codes, zero, step).alias("sums"))
    n, k = F.col("n"), F.col("k")
    of = lambda c: F.col("sums")[c].cast("double")
    chi = k * F.col("squares") / n - n
    cube, spread = F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1), F.lit(1 / 3)), 2 / (9 * (k - 1))
    uneven = normal_tail(F.greatest(F.lit(0.0), (cube - (1 - spread)) / F.sqrt(spread)))  # Wilson and Hilferty's approximation

    expected = 2 * of("up") * (n - of("up")) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(variance > 0, normal_tail((of("changes") + 1 - expected) / F.sqrt(variance))).otherwise(F.lit(1e-12))

    mean = of("sum") / n
    power = of("square") - n * mean * mean
    lagged = of("lagged") - mean * (2 * of("sum") - of("first") - of("last")) + (n - 1) * mean * mean
    serial = F.when(power > 1e-9 * n, normal_tail(F.sqrt(n) * (lagged / power + 1 / n))).otherwise(F.lit(1e-12))

    half = -(F.log(uneven) + F.log(runs) + F.log(serial))
    return df.select(*candidates.columns, "encoding", "n", (F.exp(-half) * (1 + half + half * half / 2)).alias("p"), (n >= F.col("least")).alias("power"))


#: Width of a p-value class in tenths of a decimal logarithm, and the number of classes.
P_CLASSES = 200


def p_class(p: Column) -> Column:
    return F.least(F.lit(P_CLASSES), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-20))))).cast("int")


def length_class(n: Column) -> Column:
    """Eighths of a doubling, so that a class holds runs of like length."""
    return F.floor(F.log2(n) * 8).cast("int")


#: p-value classes of p above 0.4: there, even characters show and texts hardly do.
EVEN_CLASSES = 4


def false_discovery_limits(candidates: DataFrame, rate: float) -> DataFrame:
    """For each encoding and length class, the p-value class (counted in falling p) from which Benjamini-Hochberg rejects, ``cut``, and the ``share`` of random runs.

    Classes below ``cut`` are taken for random: those that are not rejected, as far as their number is explained by p-values
    being even for random runs (Storey's estimate from the largest p-values), up to a share ``rate`` of them.
    p-values are binned, so the table has no more rows than encodings x length classes x P_CLASSES.
    """
    binned = candidates.groupBy("encoding", "lengths", "bin").agg(F.count("*").alias("m"))
    gathered = binned.groupBy("encoding", "lengths").agg(F.sum("m").alias("total"), F.collect_list(F.struct("bin", "m")).alias("bins"))
    count = lambda test: f"aggregate(bins, 0L, (a, y) -> a + if({test}, y.m, 0L))"
    # at class b, the p-values are 10**(-b/10) at most; those of larger classes come before
    rejected = f"array_min(transform(filter(bins, x -> pow(10D, -x.bin / 10D) * total <= {rate}D * {count('y.bin >= x.bin')}), x -> x.bin))"
    even = f"(({count(f'y.bin < {EVEN_CLASSES}')} + 1) / (1 - pow(10D, -{EVEN_CLASSES} / 10D)))"
    below = count("y.bin < b")
    cut = f"array_max(filter(sequence(0, coalesce(rejected, {P_CLASSES + 1})), b -> {below} - even * (1 - pow(10D, -b / 10D)) <= {rate}D * {below}))"
    share = f"{count(f'y.bin < {EVEN_CLASSES}')} / (1 - pow(10D, -{EVEN_CLASSES} / 10D)) / total"
    return gathered.select("*", F.expr(rejected).alias("rejected"), F.expr(even).alias("even")).select("encoding", "lengths", "rejected", F.expr(cut).alias("cut"), F.expr(share).alias("share"))


def candidate_pattern(params: Params) -> str:
    """Runs of the base64 alphabets, with their padding."""
    return rf"(?<![0-9A-Za-z+/_\-])[0-9A-Za-z+/_\-]{{{params.shortest},}}={{0,2}}"


def parts_of_mixed(runs: DataFrame, params: Params) -> DataFrame:
    """``k1``, ``k2``, ``s`` and ``token`` of runs, those that mix the alphabets cut at ``+`` and ``/``."""
    token, pattern = F.col("token"), rf"(?<![0-9A-Za-z_\-])[0-9A-Za-z_\-]{{{params.shortest},}}={{0,2}}"
    matched = F.regexp_extract_all(token, F.lit(pattern), F.lit(0))
    moved = lambda x: F.struct((F.col("s.start") + x["start"]).alias("start"), F.lit(3).alias("kind"), (F.col("s.start") + x["end"]).alias("end"))
    parts = F.zip_with(located(token, pattern, matched), matched, lambda x, m: F.struct(moved(x).alias("s"), m.alias("token")))
    mixed = token.rlike("[+/]") & token.rlike("[_-]")
    return runs.select("k1", "k2", F.explode(F.when(mixed, parts).otherwise(F.array(F.struct("s", "token")))).alias("r")).select("k1", "k2", "r.s", "r.token")


def text_keys(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")


#: Texts with random runs up to which these go to every executor; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 200_000


def tested_runs(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """A row for each run of each distinct text: keys of the text, span, token, encoding, n, p, power, whether it is rejected, and whether it is taken for random."""
    pattern = candidate_pattern(params)
    text = F.col("text")
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.zip_with(located(text, pattern, matched), matched, lambda s, m: F.struct(F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")).alias("s"), m.alias("token")))
    rows = texts(docs).where(text.rlike(pattern)).select(*text_keys(text), F.explode(found).alias("r"))
    runs = saved(parts_of_mixed(rows.select("k1", "k2", "r.s", "r.token").dropDuplicates(["k1", "k2", "s"]), params))
    tested = saved(with_p_values(runs, params).withColumn("lengths", length_class(F.col("n"))).withColumn("bin", p_class(F.col("p"))))
    limits = F.broadcast(false_discovery_limits(tested, params.rate))  # a row for each encoding and length class
    return tested.join(limits, ["encoding", "lengths"]).withColumns({"rejected": F.coalesce(F.col("bin") >= F.col("rejected"), F.lit(False)), "random": (F.col("power") | (F.col("share") >= params.share)) & (F.col("bin") < F.col("cut"))})


def random_spans(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """A row for each distinct text with runs that pass the battery: its keys and the runs' spans."""
    return tested_runs(docs, params).where("random").groupBy("k1", "k2").agg(F.collect_list("s").alias("random"))


def with_spans(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents with ``base`` (spans of the patterns) and ``spans`` (all of them); ``text`` must not be null."""
    found, _ = bounded_broadcast(saved(random_spans(docs, params)), BROADCAST_ROWS)
    text = F.col("text")
    one, two, three = base_spans(text)
    own = docs.withColumns({"base": F.concat(one, two, three), "k1": text_keys(text)[0], "k2": text_keys(text)[1]})
    apart = F.filter(F.coalesce("random", F.array().cast(SPAN)), lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return own.join(found, ["k1", "k2"], "left").withColumn("spans", F.array_sort(F.concat("base", apart))).withColumn("base", F.array_sort("base")).drop("k1", "k2", "random")


def scan(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id``, the number of spans of each kind, and the spans of every document."""
    found = with_spans(texts(docs), params)
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(rendered(F.col("base")), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"))


MASK = "[secret]"


def without_secrets(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents with their columns; each secret in a text is replaced by a mask, and ``n_chars`` follows the text."""
    found = with_spans(docs.withColumn("text", F.coalesce("text", F.lit(""))), params)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        "spans", start,
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)).alias("out"))
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    has = F.size("spans") > 0
    clean = found.withColumn("text", F.when(has, masked).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(has, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)
