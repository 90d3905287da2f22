"""Main text of web pages by host suffix arrays, with the markup's hints for what doesn't repeat.

Each page is parsed once into its visible blocks: those inside an article or main element, those
that elements or class names mark as something else (menus, adverts, reader comments), and the rest. The
token streams of all of them are concatenated over a host's pages and their suffixes sorted; a run of RUN
or more tokens that distinct pages share is evidence of boilerplate, wherever it stands:

- Outside articles, runs on PAGES or more pages are covered.
- Inside articles, which also share passages that are text, runs on PAGES or more pages and at least half
  of the host's are covered. A page whose article would lose more than half of its tokens is a copy of
  others and stays whole.

Covered tokens go and unique runs stay. A run that goes on over a block's edge covers of a block all or
nothing: the few words that it shares with the next block by chance stay. What is left of the article's
blocks is the page's text; a page without one gives what is left of its unmarked blocks. Pages of a host
whose blocks are all equal are one page to the arrays; without an article and from PAGES on, only the one
of least id keeps its text.

A host's pages are dealt by hash to shards of about SHARD pages, so a host that holds a third of all
pages is many groups. Shards give the pages of their runs, which are summed over the host by the runs'
hashes before anything is covered. For articles a shard leaves out runs on under a quarter of its pages:
a run on half of the host's pages is on so few of a shard of 128 or more with a chance of 1e-7.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, shuffle_partitions
from .shingles import _JOIN, _words, mix

RUN = 8
PAGES = 3
SHARD = 256
#: The shards are sorted in so many waves: the blocks of one wave at a time are on the way to their shards.
WAVES = 3

#: Kinds of blocks.
ARTICLE, OTHER, MARKED = 0, 1, 2

#: Element names of HTML, by role.
SKIP = frozenset("nav header footer aside form button dialog menu".split())
UNSEEN = frozenset("head object canvas select input audio video map datalist noscript template".split())
RAW = frozenset("script style noscript template iframe textarea title svg math xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "option", "caption", "html", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class names, ids and roles that mark what isn't the article: reader comments, adverts and the like, parts of the page.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adbox adslot banner banners billboard sponsor sponsored sponsors promo promos promotion outbrain taboola cookie cookies consent gdpr paywall newsletter share sharing social".split())
PARTS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer foot copyright colophon sidebar sidebars aside rail widget widgets "
    "related recommended recommendations trending popular notice notices notification notifications alert alerts disclaimer modal popup overlay reviews subscribe subscription signup login search searchbox form skip promoted".split()
)
#: Words that say nothing beside these.
PLAIN = frozenset("slot box wrap wrapper container list item items area block section inner content unit bar link links top bottom left right site page global main primary secondary mobile desktop".split())
#: A name that begins so tells of the page's layout.
LAYOUT = frozenset("has with no without is not".split())
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def marks(name: str) -> frozenset[str]:
    """The words of one class name or id that mark what isn't the article; none where the name tells of something else."""
    words = WORD.findall(CAMEL.sub(" ", name).lower())
    if not words or words[0] in LAYOUT:
        return frozenset()
    found = (COMMENTS | ADVERTS | PARTS).intersection(words)
    if words[-1] in COMMENTS | ADVERTS or found and all(w in found or w in PLAIN for w in words):
        return found
    return frozenset()


def hints(element: str, attributes: str) -> tuple[bool, frozenset[str]]:
    """(whether the element is hidden, the words that mark it)."""
    words: frozenset[str] = frozenset()
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            return True, words
        if element in HEADINGS:
            continue
        if name in ("class", "role"):
            words = words.union(*map(marks, value.split()))
        elif name == "id":
            found = marks(value)
            words |= found if element != "section" or value.lower() in COMMENTS - {"discussion"} else frozenset()
    return False, words


def blocks(page: str) -> list[tuple[int, str]]:
    """The page's visible blocks as (kind, text), in page order.

    White space inside a block is one space; empty blocks are left out. Marks of an element don't reach an
    article or main element inside it, unless they are those of comments or that article has another one around or before it.
    """
    out: list[tuple[int, str]] = []
    text: list[str] = []
    plain = (False, False, False, False)
    stack: list[tuple[str, tuple[bool, bool, bool, bool]]] = []  # name, (unseen, marked, marked for good, in the article)
    state, found = plain, False
    at, n = 0, len(page)

    def flush() -> None:
        if text:
            if body := " ".join("".join(text).split()):
                out.append((MARKED if state[1] else ARTICLE if state[3] else OTHER, body))
            text.clear()

    def enter(new: tuple[bool, bool, bool, bool]) -> None:
        nonlocal state
        if new != state:
            flush()
            state = new

    while at < n:
        m = MARK.search(page, at)
        end = m.start() if m else n
        if end > at and not state[0]:
            piece = page[at:end]
            text.append(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        if m[1]:
            name = m[1].lower()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if any(s[0] in BLOCK for s in stack[k:]):
                        flush()
                    del stack[k:]
                    enter(stack[-1][1] if stack else plain)
                    break
            continue
        if not (name := (m[2] or m[4] or "").lower()):
            continue
        attributes = m[3] if m[2] else m[5]
        if name in BLOCK:
            flush()
            if name in CLOSES_P and stack:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        enter(stack[-1][1] if stack else plain)
                        break
                    if stack[k][0] in BLOCK:
                        break
        if name in VOID or attributes.endswith("/"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?![a-zA-Z0-9])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else n
            continue
        unseen, marked, good, inside = state
        hidden, words = hints(name, attributes) if attributes and name not in ("html", "body") else (False, frozenset())
        unseen = unseen or hidden or name in UNSEEN
        if name in ("article", "main"):
            if not inside and not good and not (found and marked) and not (found and words & COMMENTS):
                marked, inside = False, not unseen
            elif words:
                marked = True
            found = found or inside and not marked
        else:
            marked = marked or name in SKIP or bool(words)
            good = good or name in SKIP - {"form"} or bool(words & COMMENTS)
        stack.append((name, (unseen, marked, good, inside)))
        enter(stack[-1][1])
    flush()
    return out


def host_of(url: str | None) -> str:
    rest = (url or "").partition("//")[2] or url or ""
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].lower()


PARSED = "page_id long, url string, host string, article boolean, kinds array<byte>, blocks array<string>, content long, fresh boolean"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PARSED: content is a hash of the page's blocks; fresh pages are the first of theirs in this task, so copies travel once from a task."""
    import xxhash

    names = [x.split()[0] for x in PARSED.split(", ")]
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            urls = part["url"].to_pylist()
            hosts = [host_of(u) for u in urls]
            found = [blocks(page or "") for page in part["html"].to_pylist()]
            kinds = [[k for k, _ in x] for x in found]
            content = [xxhash.xxh64_intdigest("\0".join(f"{k}{t}" for k, t in x).encode("utf-8", "surrogatepass")) - 2**63 for x in found]
            fresh = []
            for key in zip(hosts, content, strict=True):
                fresh.append(key not in seen)
                seen.add(key)
            columns = [part["page_id"], part["url"], pa.array(hosts, pa.string()), pa.array([ARTICLE in k for k in kinds]), pa.array(kinds, pa.list_(pa.int8())), pa.array([[t for _, t in x] for x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(content, pa.int64()), pa.array(fresh)], names)


# --- suffix arrays ----------------------------------------------------------------------------


def suffix_ranks(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) by prefix doubling, to a depth that `depth` tokens decide: equal ranks share them."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        step = min(k, depth - k)
        after = np.full(len(rank), -1, np.int64)
        after[: len(rank) - step] = rank[step:]
        pair = rank * (len(rank) + 1) + after + 1
        order = np.argsort(pair, kind="stable")
        new = np.zeros(len(rank), np.int64)
        new[order[1:]] = np.cumsum(pair[order[1:]] != pair[order[:-1]])
        rank, k = new, k + step
    return order, rank


def runs_of(tokens: np.ndarray, pages: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all runs of `run` tokens of one page, in the order of the suffix array; group of equal runs of each)."""
    none = np.zeros(0, np.int64)
    if len(tokens) < run:
        return none, none
    order, rank = suffix_ranks(tokens, run)
    whole = np.zeros(len(tokens), bool)
    whole[: len(tokens) - run + 1] = pages[: len(tokens) - run + 1] == pages[run - 1 :]
    order = order[whole[order]]
    if not len(order):
        return none, none
    of = np.cumsum(np.diff(rank[order], prepend=rank[order[0]]) != 0)
    return order, of


def pages_of(of: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """Distinct pages of each group; of and pages: those of each run."""
    if not len(of):
        return np.zeros(0, np.int64)
    most = int(pages.max()) + 1
    return np.bincount(np.unique(of * most + pages) // most, minlength=int(of.max()) + 1)


def spread(starts: np.ndarray, n: int, run: int = RUN) -> np.ndarray:
    """Whether each of n tokens lies in a run that starts at one of `starts`."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + run, -1)
    return np.cumsum(depth[:-1]) > 0


def covered(tokens: np.ndarray, pages: np.ndarray, run: int = RUN, least: int = PAGES) -> np.ndarray:
    """Whether each token lies in a run of `run` tokens that `least` distinct pages hold."""
    starts, of = runs_of(tokens, pages, run)
    return spread(starts[pages_of(of, pages[starts])[of] >= least], len(tokens), run)


class Streams:
    """The token streams of some pages, one after another: tokens' hashes, their pages and blocks."""

    def __init__(self, texts: pa.ListArray, kinds: pa.ListArray):
        flat = [t.encode("utf-8", "surrogatepass") for page in texts.to_pylist() for t in page]
        sizes = np.diff(texts.offsets.to_numpy()).astype(np.int64)
        #: Of each block: its page, kind, first token and the one after its last.
        self.page = np.repeat(np.arange(len(sizes)), sizes)
        self.kind = np.array([k for page in kinds.to_pylist() for k in page], np.int64)
        counts = np.array([t.count(b" ") + 1 for t in flat], np.int64)
        self.end = np.cumsum(counts)
        self.first = self.end - counts
        self.words = [t.split(b" ") for t in flat]
        self.tokens = _words(np.frombuffer(b" ".join(flat) + b" ", np.uint8))[1].view(np.int64) if flat else np.zeros(0, np.int64)
        self.block = np.repeat(np.arange(len(flat)), counts)
        self.pages = self.page[self.block] if len(flat) else self.block

    def names(self, starts: np.ndarray) -> np.ndarray:
        """64-bit hash of the run at each start, the same in every shard."""
        t = self.tokens.view(np.uint64)
        h = t[starts]
        for k in range(1, RUN):
            h = h * np.uint64(_JOIN) + t[starts + k]
        return mix(h).view(np.int64)


RUNS = "host string, run long, outer long, inner long"


def _evidence(key: tuple, t: pa.Table) -> pa.Table:
    """RUNS of a shard: the pages that have a run outside articles, and those that have it anywhere if they are a quarter of the shard's."""
    t = t.combine_chunks()
    t = t.take(np.sort(np.unique(t["content"].to_numpy(), return_index=True)[1]))  # copies of other tasks
    with np.errstate(over="ignore"):
        s = Streams(*(t[c].combine_chunks() for c in ("blocks", "kinds")))
        starts, of = runs_of(s.tokens, s.pages)
        one = starts[np.unique(of, return_index=True)[1]] if len(of) else starts
        inner = pages_of(of, s.pages[starts])
        inner[4 * inner < t.num_rows] = 0
        outer = np.zeros(len(inner), np.int64)
        if t["bare"][0].as_py():  # the host has pages without an article
            out = (s.kind[s.block[starts]] != ARTICLE) & (s.kind[s.block[starts + RUN - 1]] != ARTICLE)
            outer[: of[out].max(initial=-1) + 1] = pages_of(of[out], s.pages[starts[out]])
        use = (inner > 0) | (outer > 0)
        names = s.names(one[use])
    return pa.table({"host": pa.array([key[0].as_py()] * len(names), pa.string()), "run": names, "outer": outer[use], "inner": inner[use]})


TEXTS = "page_id long, url string, text string"


def _unique_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """TEXTS: the pages' blocks without the tokens that the host's known runs cover."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            article, gone, outer, inner = (part[c].to_pylist() for c in ("article", "gone", "outer", "inner"))
            texts = []
            for k, (page, kinds) in enumerate(zip(part["blocks"].to_pylist(), part["kinds"].to_pylist(), strict=True)):
                known = inner[k] if article[k] else outer[k]
                kind = ARTICLE if article[k] else OTHER
                if gone[k]:
                    texts.append("")
                elif known:
                    texts.append(_uncovered(page, kinds, kind, np.array(known, np.int64)))
                else:
                    texts.append(" ".join(t for t, x in zip(page, kinds, strict=True) if x == kind))
            yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _uncovered(page: list[str], kinds: list[int], kind: int, known: np.ndarray) -> str:
    """The text of a page's blocks of one kind without what the known runs cover."""
    with np.errstate(over="ignore"):
        s = Streams(pa.array([page], pa.list_(pa.string())), pa.array([kinds], pa.list_(pa.int8())))
        starts = np.arange(max(len(s.tokens) - RUN + 1, 0))
        starts = starts[np.isin(s.names(starts), known)]
    anywhere = spread(starts, len(s.tokens))
    within = spread(starts[starts + RUN <= s.end[s.block[starts]]], len(s.tokens))
    mine = s.kind == kind
    kept, cut, total = [], 0, 0
    for b in np.flatnonzero(mine).tolist():
        lo, hi = s.first[b], s.end[b]
        gone = anywhere[lo:hi] if anywhere[lo:hi].all() else within[lo:hi]
        total, cut = total + hi - lo, cut + int(gone.sum())
        if not gone.all():
            kept.append(b" ".join(w for w, g in zip(s.words[b], gone.tolist(), strict=True) if not g).decode("utf-8", "surrogatepass"))
    if kind == ARTICLE and 2 * cut > total:  # a copy
        return " ".join(page[b] for b in np.flatnonzero(mine).tolist())
    return " ".join(kept)


def main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per row of pages (page_id, url, html; others are ignored): page_id, url, text.

    Null or empty html: empty text. A null url is host ''. Very long pages are parsed whole. Repeated
    rows are repeated in the result and count as one page; without an article, one row of PAGES or more
    such copies keeps the text (the least page_id; of equal ones the first row). Blocks of equal text all
    stay inside an article. An empty table gives an empty result.
    """
    ws, n = Workspace(spark), shuffle_partitions(spark)
    parsed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_parse, PARSED)
    parsed = ws.write(parsed.withColumn("line", F.monotonically_increasing_id()), "blocks", codec="zstd")
    # Which pages are copies, and how many pages each host has: narrow rows, combined before the shuffle.
    holder = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "line"))
    contents = ws.write(parsed.groupBy("host", "content").agg(holder.alias("holder"), F.count("*").alias("copies"), F.max(~F.col("article")).alias("bare")), "contents")
    hosts = ws.write(contents.groupBy("host").agg(F.count("*").alias("pages"), F.max("bare").alias("bare")), "hosts")
    shard = F.pmod(F.xxhash64("content"), F.ceil(F.col("pages") / SHARD)).alias("shard")
    dealt = parsed.where("fresh").join(hosts.where(f"pages >= {PAGES}"), "host").select("host", shard, "bare", "content", "kinds", "blocks")
    waves = [ws.write(dealt.where(F.pmod(F.xxhash64("host", "shard"), F.lit(WAVES)) == k).repartition(n, "host", "shard").groupBy("host", "shard").applyInArrow(_evidence, RUNS), "runs") for k in range(WAVES)]
    runs = waves[0]
    for w in waves[1:]:
        runs = runs.unionByName(w)
    often = runs.groupBy("host", "run").agg(F.sum("outer").alias("outer"), F.sum("inner").alias("inner")).join(hosts, "host")
    out, within = F.col("outer") >= PAGES, F.col("inner") >= F.greatest(F.lit(PAGES), F.col("pages") / 2)
    known = often.where(out | within).groupBy("host").agg(F.collect_list(F.when(out, F.col("run"))).alias("outer"), F.collect_list(F.when(within, F.col("run"))).alias("inner"))
    known = ws.write(known, "known")
    ws.done(*waves, hosts)
    # Texts stay where they are as long as what they meet is small: hosts with boilerplate, and copies without an article.
    twins = ws.write(contents.where(f"bare and copies >= {PAGES}").select("host", "content", F.col("holder.line").alias("keeps")), "twins")
    ws.done(contents)
    found = parsed.join(twins, ["host", "content"], "left").withColumn("gone", F.coalesce(F.col("line") != F.col("keeps"), F.lit(False))).join(known, "host", "left")
    return found.select("page_id", "url", "article", "gone", "kinds", "blocks", "outer", "inner").mapInArrow(_unique_runs, TEXTS)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
