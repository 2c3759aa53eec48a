"""HTML extraction by a site style tree.

The pages of a host are merged into one style tree. A node is the path of container
styles (tag and class) from the root; running text (paragraphs, headings, lists and
tables without a class) belongs to the container that it stands in. Each node gets
two kinds of importance from all pages of the host that have it:

* content: one minus the mean entropy of the text blocks that stand in it, a
  block's entropy being 0 on one page and 1 evenly on all of them;
* presentation: the entropy of its child sequences, 0 where all pages lay the node
  out alike and 1 where no two do.

Content is combined upwards as the mean over a branch's blocks, and joined with the
presentation of the branch's root, whose weight grows with the number of its
children; a node's own text counts by itself where that is more. Few pages are weak evidence, so a node counts as if it stood on
``Params.doubt`` more pages on which it is important: nothing is dropped from the
first pages of a host, and no count of pages switches the tree on. A branch all of
whose nodes are of low importance is template and goes from every page.

Beside the tree stand what HTML itself says: scripts, styles, hidden parts, forms,
menus, page headers and footers, asides are never text; where a page marks an article
or main part, the text is in it, and its header belongs to it; containers whose class
or id is exactly one of the parts' names go too, unless they hold such a mark or
half of the text. If the tree would leave nothing of a page, the page stays.

Pages of one host with equal text count as one page, so that copies of an article do
not make it a template. Two passes: the first sends hashes of each page's nodes,
layouts and blocks, leaves one page of each content, and sums per host, node and value
(sums that are combined before the shuffle, so that a host of any size is spread);
the second gets only the list of template nodes of each host, and cleans each page
where it is. Html is not shuffled.

Defined results: a null or empty html has an empty text; a page without a host
belongs to the host ''; unclosed and stray tags are closed or skipped; comments
and declarations are dropped; what follows an unclosed script or comment is part
of it. Rows repeat as often as they come in; extra columns are neither read nor
returned.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, prepare, saved

# What HTML defines, and names that sites give to parts that are not content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas audio video".split())
NEVER = RAW | frozenset("head title nav footer header aside form button select textarea input label fieldset dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frame h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Block tags that end an open p.
CLOSES_P = BLOCKS - frozenset("br button caption frame head html legend option select tbody td tfoot th thead textarea title tr body".split())
SAME_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body article main section div td th blockquote".split())
#: Names of the parts that are not text, as a class or id of a container.
NAMES = frozenset("ad ads advert adverts advertisement menu nav navigation header footer sidebar notice cookie-notice comments".split())
NAMED = frozenset("div section ul ol dl table td details".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
LANDMARK_ROLES = frozenset(["main", "article"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class Params:
    doubt: float = 3.0  # pages that are added to those that have a node, as if it were important there
    low: float = 0.3  # importance below which a node is template
    decay: float = 0.9  # of the weight of content with each child, as against presentation


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(next((v for v in m.groups()[1:] if v is not None), "")) for m in ATTRIBUTE.finditer(raw)} if raw.strip(" /\n\t\r") else {}


#: How little a part counts as text: not at all by its tag or role, or only by its name.
TEXT, NAMED_NOISE, NOISE, UNSEEN = range(4)


def noise_of(tag: str, attrs: dict[str, str], marked: bool) -> int:
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return UNSEEN
    if "style" in attrs and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs["style"], re.I):
        return UNSEEN
    if tag in ("html", "body", "article", "main") or (tag == "header" and marked):
        return TEXT
    if tag in NEVER or attrs.get("role", "").lower() in NOISE_ROLES:
        return NOISE
    if tag in NAMED and not NAMES.isdisjoint(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()):
        return NAMED_NOISE
    return TEXT


#: Running text, and what is so unless it has a class: parts of the container that they stand in.
RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote li dt dd caption thead tbody tfoot th figure figcaption address hr".split())
RUNNING_BARE = frozenset("ul ol dl table tr td".split())


@dataclass
class Page:
    """A page's blocks in order (node, text, noise, in an article or main part) and its nodes' child sequences."""

    blocks: list[tuple[str, str, int, bool]]
    layout: dict[str, list[str]]

    def text_blocks(self) -> list[tuple[str, str]]:
        """Node and text of the blocks that are text as far as the page itself tells."""
        own = [b for b in self.blocks if b[2] < NOISE]
        if any(b[3] for b in own):
            own = [b for b in own if b[3]]
        plain = [b for b in own if b[2] == TEXT]
        if sum(len(b[1]) for b in plain) * 2 < sum(len(b[1]) for b in own):
            plain = own
        return [(b[0], b[1]) for b in plain]


def page_of(html: str) -> Page:
    out: list[tuple[str, str, int, bool]] = []
    layout: dict[str, list[str]] = {"": []}
    stack: list[tuple[str, str, int, bool]] = []  # tag, node, noise, in a landmark
    text: list[str] = []
    path, noise, mark, block_path = "", TEXT, False, ""

    def flush() -> None:
        if text:
            joined = SPACE.sub(" ", "".join(text)).strip()
            text.clear()
            if joined:
                out.append((block_path, joined, noise, mark))

    def top() -> tuple[str, int, bool]:
        return stack[-1][1:] if stack else ("", TEXT, False)

    def close(names: set[str], scopes: frozenset[str]) -> None:
        nonlocal path, noise, mark
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                flush()
                del stack[i:]
                path, noise, mark = top()
                return
            if stack[i][0] in scopes:
                return

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        piece = html[at : m.start() if m else end]
        if piece and noise < UNSEEN:
            if not text:
                block_path = path
            text.append(entities.unescape(piece))
        if not m:
            break
        at = max(m.end(), at + 1)
        if m[1]:
            tag = m[1].lower()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag in BLOCKS or any(s[0] in BLOCKS for s in stack[i:]):
                        flush()
                    if tag not in BLOCKS and any(s[0] in SCOPES for s in stack[i + 1 :]):
                        break  # a stray end of an inline tag does not end blocks
                    if stack[i][2] != (stack[i - 1][2] if i else TEXT):
                        flush()
                    del stack[i:]
                    path, noise, mark = top()
                    break
            else:
                if tag in ("p", "br"):
                    flush()
        elif m[2]:
            tag, raw = m[2].lower(), m[3]
            if tag in BLOCKS:
                flush()
            if tag in CLOSES_P:
                close({"p"}, SCOPES - {"p"})
            if tag in SAME_END:
                close(SAME_END[tag], frozenset(["ul", "ol", "dl", "table", "select"]) - {tag})
            if tag in RAW or tag in ("textarea", "title"):
                if not raw.rstrip().endswith("/") or tag in ("script", "style", "title", "textarea"):
                    stop = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(html, at)
                    at = stop.end() if stop else end
                continue
            if tag in VOID:
                continue
            attrs = attributes(raw)
            own, here = noise_of(tag, attrs, mark), path
            if tag in BLOCKS:
                style = tag.replace("/", "|") + ("." + ".".join(sorted(attrs["class"].replace("/", "|").split())) if attrs.get("class") else "")
                layout[path].append(style)
                node = not (tag in RUNNING or (tag in RUNNING_BARE and style == tag))
                if node and not path.endswith(f"/{style}"):  # a chain of one style is one node
                    here = f"{path}/{style}"
                    layout.setdefault(here, [])
            if own != TEXT and own > noise:
                flush()
            landmark = tag in ("article", "main") or attrs.get("role", "").lower() in LANDMARK_ROLES
            # an article is text, whatever the name of the container that it stands in
            path, noise, mark = here, TEXT if landmark and max(noise, own) == NAMED_NOISE else max(noise, own), mark or landmark
            stack.append((tag, path, noise, mark))
    flush()
    return Page(out, layout)


def node_key(path: str) -> int:
    return int.from_bytes(hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))


def pages_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))


FEATURES = "host string, content string, node array<long>, above array<array<long>>, kind array<int>, value array<long>, n array<long>"
PRESENT, LAYOUT, BLOCK = range(3)


def page_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each page the hash of its text, and rows of its nodes: their places in the tree, layouts and blocks."""
    keys: dict[str, int] = {}
    places: dict[str, list[int]] = {}

    def key(x: str) -> int:
        if x not in keys:
            keys[x] = node_key(x)
        return keys[x]

    for b in batches:
        keys.clear()
        places.clear()
        seen: dict[tuple[str, str], list[tuple]] = {}
        for host, html in zip(b["host"], b["html"], strict=True):
            page = page_of(html)
            content = hashlib.blake2b("\n".join(f"{p}\t{t}" for p, t in page.text_blocks()).encode("utf-8", "replace"), digest_size=16).hexdigest()
            if (host, content) in seen:
                continue
            rows: dict[tuple[str, int, int], int] = {}
            for path, children in page.layout.items():
                rows[path, PRESENT, len(children)] = 1
                rows[path, LAYOUT, node_key(" ".join(children))] = 1
            for path, text, _, _ in page.blocks:
                at = path, BLOCK, node_key(text)
                rows[at] = rows.get(at, 0) + 1
            for path in page.layout:
                if path not in places:
                    parts = path.split("/")
                    places[path] = [key("/".join(parts[:i])) for i in range(1, len(parts) + 1)]
            seen[host, content] = [(key(p), places[p], k, v, n) for (p, k, v), n in rows.items()]
        columns = [[[r[i] for r in v] for v in seen.values()] for i in range(5)]
        yield pd.DataFrame({"host": [h for h, _ in seen], "content": [c for _, c in seen], "node": columns[0], "above": columns[1], "kind": columns[2], "value": columns[3], "n": columns[4]})


def style_tree(pages: DataFrame, params: Params = Params()) -> DataFrame:
    """The nodes of each host's tree: ``host``, ``node``, ``above`` (the nodes from the root to it), ``m`` (pages), ``content``, ``presentation``, ``importance``."""
    # equal contents count once; it does not matter for what which page of them is left
    distinct = pages.select("host", "html").mapInPandas(page_features, FEATURES).dropDuplicates(["host", "content"])
    rows = distinct.select("host", F.explode(F.arrays_zip("node", "above", "kind", "value", "n")).alias("r")).select("host", "r.node", "r.above", "r.kind", F.when(F.col("r.kind") != PRESENT, F.col("r.value")).alias("value"), F.when(F.col("r.kind") == PRESENT, F.col("r.value")).alias("children"), F.col("r.n").cast("double").alias("n"))
    sums = rows.groupBy("host", "node", "kind", "value").agg(F.first("above").alias("above"), F.sum("n").alias("f"), F.sum(F.col("n") * F.log("n")).alias("flogf"), F.sum("children").alias("children"), F.count("*").alias("pages"))
    f = F.col("f")
    spread = F.when(F.col("kind") == BLOCK, F.log("f") - F.col("flogf") / f)  # entropy of a block's pages
    nodes = sums.groupBy("host", "node").agg(
        F.first("above").alias("above"), F.max(F.when(F.col("kind") == PRESENT, F.col("pages"))).cast("double").alias("m"), F.sum(spread).alias("spread"), F.count(spread).alias("blocks"),
        F.sum(F.when(F.col("kind") == LAYOUT, f * F.log(f))).alias("layouts"), F.sum("children").alias("children"),
    )
    m, even = F.col("m"), F.greatest(F.log("m"), F.lit(1e-9))
    alone = F.col("m") <= 1
    nodes = nodes.select(
        "host", "node", "above", "m", "blocks", (F.col("children") / m).alias("children"),
        F.when(alone, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("spread") / F.greatest(F.col("blocks"), F.lit(1)) / even)).alias("content"),
        F.when(alone, 1.0).otherwise((F.log("m") - F.col("layouts") / m) / even).alias("presentation"),
    )
    # content goes upwards: each node's blocks count for every branch that it is in
    below = nodes.where("blocks > 0").select("host", F.explode("above").alias("node"), "content", "blocks").groupBy("host", "node").agg((F.sum(F.col("content") * F.col("blocks")) / F.sum("blocks")).alias("below"))
    weight = F.pow(F.lit(params.decay), F.least("children", F.lit(100.0)))
    own = F.when(F.col("blocks") > 0, F.col("content")).otherwise(0.0)
    raw = F.greatest(own, (1 - weight) * F.col("presentation") + weight * F.coalesce("below", F.lit(0.0)))
    return nodes.join(below, ["host", "node"], "left").withColumn("importance", (m * raw + params.doubt) / (m + params.doubt))


def template_nodes(pages: DataFrame, params: Params = Params()) -> DataFrame:
    """``host`` and ``low``: the nodes of each host whose whole branch is of low importance, for hosts that have any."""
    tree = saved(style_tree(pages, params))
    branch = tree.select("host", F.explode("above").alias("node"), "importance").groupBy("host", "node").agg(F.max("importance").alias("best"))
    return branch.where(F.col("best") < params.low).groupBy("host").agg(F.collect_list("node").alias("low"))


def main_text(html: str, low: set[int]) -> str:
    blocks = page_of(html).text_blocks()
    if low:
        known = {p: node_key(p) in low for p in {p for p, _ in blocks}}
        kept = [t for p, t in blocks if not known[p]]
        if kept:
            return " ".join(kept)
    return " ".join(t for _, t in blocks)


#: Hosts up to which the list of low nodes goes to every executor; beyond, it is joined by host.
BROADCAST_ROWS = 50_000
SALTS = 16


def extracted(pages: DataFrame, params: Params = Params()) -> DataFrame:
    """``page_id``, ``url``, ``text`` (the main text) and ``n_chars`` of every page."""
    prepare(pages.sparkSession)
    own = pages_of(pages)
    lists, n = bounded_broadcast(saved(template_nodes(own, params)), BROADCAST_ROWS)
    if n <= BROADCAST_ROWS:
        joined = own.join(lists, "host", "left")
    else:  # a host may hold a large part of all pages, so its pages are dealt by a salt as well
        salted = lists.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        joined = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(h, set() if low is None else set(low)) for h, low in zip(b["html"], b["low"], strict=True)]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    return joined.select("page_id", "url", "html", "low").mapInPandas(run, "page_id long, url string, text string, n_chars long")
