"""Main text of web pages: markup names what it can, a suffix array of each host decides the rest.

A page is read into blocks.  What an article (else a main element, else an
element of such a class) holds is the main text; what stands in menus, headers,
footers, sidebars, forms and elements named as notices, adverts or comments is
not.  The token streams of all blocks but those of a page's largest main element
are concatenated by host and sorted as a suffix array; a substring of ``RUN``
tokens or more that distinct pages of the host share is boilerplate.  It decides

* where the markup names no main text: the unique runs of the blocks that it
  leaves open are the main text;
* where several elements claim to be the main text, as articles that advertise
  other articles do: claims whose words are all repeats go, unless they have more
  words than those that stay.  So a claim with more than half of the words stays
  in any case and is not looked up.  For these claims alone, a repeat may also lie in
  the largest main element of another page: the article that a teaser is taken from.

Repetition alone cannot give the right text: passages and whole articles that
several pages carry are to be kept, and menus go on a host's only page too.  So
a page's only article stays whole, and nothing within a claim goes alone.

A suffix order by the first ``RUN`` tokens is enough, as longer repeats are
unions of these, so prefix doubling stops there.

Plan: one scan for the size of each host, then one exchange of the blocks.  Small
hosts share a cell; a host of more than ``CELL`` characters is dealt over several
cells by page.  The hosts of some size are told to the scan by a broadcast if they
are ``FEW_HOSTS`` or fewer, else by a join.  Substrings that only pages of different cells of a host share
are found by the hashes of their windows (64 bits), counted over the cluster and
sent to the cells that hold them, so a repeat is found wherever its pages are.
Where pages have such claims, a second scan hashes the windows of largest main
elements and sends those that claims have, too.

Edge cases: a null or empty html has no text; a null or odd url belongs to the
host ``""``; pages with equal html are one page in what counts as repeated, and
each gets its text; broken markup closes where its surrounding element does;
pages of any length are read whole; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import membership, read, saved
from .language_id import address_parts
from .textcore import mix, slices, span_hash, text_bytes, windows, words

RUN = 8
CELL = 1 << 24
FEW_HOSTS = 100_000

#: Element names of HTML and the roles and class words that name a part of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre script search section "
    "select style summary table tbody td template textarea tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body br button caption head html iframe legend noscript optgroup option script select style tbody td template textarea tfoot th thead title tr".split())
ASIDE = frozenset("aside button canvas datalist dialog footer form head header iframe menu nav noscript object script search select style svg template textarea".split())
UNSEEN = frozenset("datalist noscript script style svg template title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promos promotion "
    "recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
MAIN_NAMES = frozenset(
    "article article-body article-content content entry entry-content main main-content post post-body post-content story story-body".split()
)
OWN_HEADER = frozenset("article content entry post story".split())
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NAME = re.compile(r"[a-z0-9]+")

MAIN, OPEN, NAMED, CLAIM = range(4)


class _Reader(HTMLParser):
    """Collects (level, element, tag, text) blocks.

    The level is -1 in a part named as no main text, -2 where nothing is text, else 0 to 3 by the main element around it.
    The element is the number of that main element on the page; one within another of its level or a higher one is a part of it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, int, str, str]] = []
        self.open: list[tuple[str, int, int]] = []
        self.parts: dict[tuple[int, int], list[str]] = {}
        self.tag, self.most, self.elements = "", 0, 0

    def flush(self) -> None:
        for (level, element), parts in self.parts.items():
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                self.blocks.append((level, element, self.tag, text))
        self.parts = {}

    def place(self) -> tuple[int, int]:
        return self.open[-1][1:] if self.open else (0, 0)

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        """Close the innermost such element, and those in it, if no element of ``within`` is in between."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            self.tag = tag
            if tag in CLOSES_P:
                self._close("p", BLOCK - {"p"})
            if tag in ("li", "dd", "dt", "option", "tr", "td", "th"):
                self._close(tag, frozenset(("ul", "ol", "dl", "table", "select")))
        if tag in VOID:
            return
        level, element = self.place()
        if tag in UNSEEN:
            level = -2
        elif level >= 0:
            if tag in ASIDE or tag not in ("html", "body", "main") and attrs and self._aside(tag, attrs):
                level, element = -1, 0
            else:
                own = 3 if tag == "article" else 2 if tag == "main" else self._main(attrs) if attrs else 0
                if own > level:
                    level = own
                    if tag in BLOCK:  # what inline elements hold stays one block
                        self.elements += 1
                        element = self.elements
                self.most = max(self.most, level)
        self.open.append((tag, level, element))

    handle_startendtag = handle_starttag

    @staticmethod
    def _aside(tag: str, attrs: list) -> bool:
        for name, value in attrs:
            if name == "hidden" or name == "role" and value and value.strip().lower() in ROLES:
                return True
            if name in ("class", "id") and value:
                for one in value.lower().split():
                    parts = set(_NAME.findall(one))
                    if parts & ASIDE_WORDS and not (parts & ASIDE_WORDS == {"header"} and parts & OWN_HEADER):
                        return True
        return False

    @staticmethod
    def _main(attrs: list) -> int:
        for name, value in attrs:
            if name == "role" and value and value.strip().lower() in ("main", "article"):
                return 2
            if name in ("class", "id") and value and MAIN_NAMES & set(value.lower().replace("_", "-").split()):
                return 1
        return 0

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
            self._close(tag, frozenset() if tag != "p" else BLOCK - {"p"})
        else:
            self._close(tag, BLOCK)

    def handle_data(self, data):
        place = self.place()
        if place[0] != -2:
            self.parts.setdefault(place, []).append(data)


def page_blocks(html: str, whole: bool = False) -> tuple[str | None, list[tuple[int, int, str, str, int]]]:
    """The main text that the markup names (None if it names none), and blocks as (segment, kind, tag, text, element).

    Kinds are OPEN and NAMED.  Where several elements claim to be the main text, their blocks are among these: MAIN in
    the one that has more than half of the words, if one has, else CLAIM.  A segment ends where what is surely main text stands in between.
    With ``whole``, the blocks of an only main element are given too.
    """
    reader = _Reader()
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # marked sections that the parser does not know
        reader = _Reader()
        reader.feed(html.replace("<![", "<! ["))
        reader.close()
    reader.flush()
    size: dict[int, int] = {}
    for level, element, _, text in reader.blocks:
        if level == reader.most > 0:
            size[element] = size.get(element, 0) + text.count(" ") + 1
    sure = {element for element in size if 2 * size[element] > sum(size.values())}
    main, rest, segment = [], [], 0
    for level, element, tag, text in reader.blocks:
        kind = NAMED if level < 0 or reader.most else OPEN
        if level == reader.most > 0:
            main.append(text)
            kind = MAIN if element in sure else CLAIM
            segment += element in sure
        if kind != MAIN or len(size) > 1 or whole:
            rest.append((segment, kind, f"<{tag}", text, element))
    return (" ".join(main) if reader.most else None), rest


def repeated_tokens(token: np.ndarray, segment: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which tokens lie in a substring of ``run`` tokens of one segment that stands on two distinct pages.

    ``segment`` rises with the tokens.  The suffixes are ordered by their first ``run`` tokens by prefix doubling.
    """
    n = len(token)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n < run:
        return covered[:n] > 0
    _, rank = np.unique(token, return_inverse=True)
    order, length = np.argsort(rank, kind="stable"), 1
    while length < run:
        step = min(length, run - length)
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:]
        after[: n - step][segment[step:] != segment[: n - step]] = -1
        key = rank.astype(np.int64) * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
        rank, length = new, length + step
    whole = np.zeros(n, dtype=bool)
    whole[: n - run + 1] = segment[run - 1 :] == segment[: n - run + 1]
    order = order[whole[order]]
    if not len(order):
        return covered[:n] > 0
    first = np.flatnonzero(np.concatenate(([True], rank[order][1:] != rank[order][:-1])))
    pages = page[order]
    shared = np.minimum.reduceat(pages, first) != np.maximum.reduceat(pages, first)
    found = order[np.repeat(shared, np.diff(np.append(first, len(order))))]
    np.add.at(covered, found, 1)
    np.subtract.at(covered, found + run, 1)
    return np.cumsum(covered)[:n] > 0


def _tokens(blocks: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, block, page and segment of each token of the pages' blocks but those surely of the main text; a block's first token is its tag."""
    page = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    flat = [x for b in blocks for x in b]
    raw, offsets = text_bytes(pa.array(["" if x["kind"] == MAIN else f"{x['tag']} {x['text']}" for x in flat], pa.string()))
    w = words(raw, offsets)
    part = np.array([x["segment"] for x in flat], dtype=np.int64)
    new = np.concatenate(([False], (page[1:] != page[:-1]) | (part[1:] != part[:-1]))) if len(flat) else np.zeros(0, bool)
    return span_hash(raw, w.start, w.end), w.row, page[w.row], np.cumsum(new)[w.row]


BLOCK_FIELDS = ("segment", "kind", "tag", "text", "element")
BLOCKS = "array<struct<segment: int, kind: int, tag: string, text: string, element: int>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds main and blocks to rows whose last column is the html, which goes; main is null where blocks are to decide."""
    kind = pa.list_(pa.struct([(name, pa.string() if name in ("tag", "text") else pa.int32()) for name in BLOCK_FIELDS]))
    with np.errstate(over="ignore"):
        for batch in slices(batches, "html"):
            read = [page_blocks(x or "") for x in batch.column("html").to_pylist()]
            blocks = [[dict(zip(BLOCK_FIELDS, b, strict=True)) for b in rest] for _, rest in read]
            main = pa.array([None if any(b[1] in (MAIN, CLAIM) for b in rest) else m for m, rest in read], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], main, pa.array(blocks, kind)], names=[*batch.schema.names[:-1], "main", "blocks"])


def _distinct_windows(batch: pa.RecordBatch, page: np.ndarray, value: np.ndarray, *more: np.ndarray) -> tuple[pa.Array, list[pa.Array]]:
    """The rows, and the windows with what belongs to them, of the distinct windows of each page."""
    found = np.unique(np.stack([page, value, *more], axis=1), axis=0) if len(page) else np.zeros((0, 2 + len(more)), np.int64)
    return pa.array(found[:, 0]), [pa.array(found[:, k]) for k in range(1, 2 + len(more))]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (host, cell, copy, parts, window, claim) of the blocks that the suffix array reads; of hosts in one cell those of claims.

    claim is 1 where the window has a word of a block that claims to be main text.
    """
    with np.errstate(over="ignore"):
        for batch in _read(batches):
            blocks = batch.column("blocks").to_pylist()
            token, block, page, segment = _tokens(blocks)
            value, at = windows(token, segment, RUN)
            claims = np.array([b["kind"] == CLAIM for own in blocks for b in own], dtype=bool)
            total = np.concatenate(([0], np.cumsum(claims[block] if len(block) else np.zeros(0, bool))))
            claim = total[at + RUN] > total[at] if len(at) else np.zeros(0, bool)
            keep = claim | (batch.column("parts").to_numpy()[page[at]] > 1) if len(at) else claim
            take, columns = _distinct_windows(batch, page[at][keep], value.view(np.int64)[keep], claim[keep].astype(np.int64))
            names = ("host", "cell", "copy", "parts")
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in names), *columns], names=[*names, "window", "claim"])


def _main_windows(bits: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct (host, copy, window) of pages' largest main elements, where the window's bit is set."""
    packed, size = (None, 0) if bits is None else (np.packbits(bits), len(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if packed is None else np.unpackbits(packed).astype(bool)
        with np.errstate(over="ignore"):
            for batch in slices(batches, "html"):
                pages = []
                for html in batch.column("html").to_pylist():
                    others, own = 0, []
                    for _, kind, tag, text, _ in page_blocks(html or "", whole=True)[1]:
                        others += kind != MAIN  # a segment ends where something else stands in between
                        if kind == MAIN:
                            own.append({"segment": others, "kind": OPEN, "tag": tag, "text": text})
                    pages.append(own)
                token, _, page, segment = _tokens(pages)
                value, at = windows(token, segment, RUN)
                value = value.view(np.int64)
                keep = np.ones(len(value), bool) if wanted is None else wanted[value & (size - 1)]
                take, columns = _distinct_windows(batch, page[at][keep], value[keep])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("host", "copy")), *columns], names=["host", "copy", "window"])

    return run


def repeated_claims(blocks: list[dict], gone: list[np.ndarray]) -> set[int]:
    """The elements among those that claim a page's main text that go, as all their words are repeats (``gone``, by block).

    None goes if they have more words than those that stay.
    """
    size, own = {}, {}
    for b, g in zip(blocks, gone, strict=True):
        if b["kind"] in (MAIN, CLAIM):
            size[b["element"]] = size.get(b["element"], 0) + b["text"].count(" ") + 1
            own[b["element"]] = own.get(b["element"], False) or b["kind"] == MAIN or not g.all()
    out = {e for e in size if not own[e]}
    return out if 2 * sum(size[e] for e in out) <= sum(size.values()) else set()


def _decide(pages: pa.Table, shared: pa.Table) -> pa.Table:
    """The text of each page of a cell, of one part of a host or of whole hosts."""
    with np.errstate(over="ignore"):
        blocks, main = pages.column("blocks").to_pylist(), pages.column("main").to_pylist()
        token, block, page, segment = _tokens(blocks)
        _, host = np.unique(np.array(pages.column("host").to_pylist(), dtype=object).astype(str), return_inverse=True)
        _, copy = np.unique(pages.column("copy").to_numpy(), return_inverse=True)
        own = mix(token + host[page].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # a host's tokens are its own
        covered = repeated_tokens(own, segment, copy[page])
        if shared.num_rows:
            value, at = windows(token, segment, RUN)
            salted = value.view(np.int64) ^ pages.column("salt").to_numpy()[page[at]]
            told, main_only = shared.column("window").to_numpy(), shared.column("claim").to_numpy() > 0
            claims = np.array([b["kind"] == CLAIM for own in blocks for b in own], dtype=bool)[block]
            for some, where in ((told[~main_only], True), (told[main_only], claims)):
                met = at[np.isin(salted, some)]
                more = np.zeros(len(token) + 1, dtype=np.int64)
                np.add.at(more, met, 1)
                np.subtract.at(more, met + RUN, 1)
                covered |= (np.cumsum(more)[:-1] > 0) & where
    starts = np.searchsorted(block, np.arange(sum(map(len, blocks)) + 1))
    out, at = [], 0
    for text, own_blocks in zip(main, blocks, strict=True):
        kept, repeated, named = [], 0, 0
        hits = [covered[starts[k] + 1 : starts[k + 1]] for k in range(at, at + len(own_blocks))]  # the first token is the tag
        at += len(own_blocks)
        others = repeated_claims(own_blocks, hits)
        for b, gone in zip(own_blocks, hits, strict=True):
            if b["kind"] in (MAIN, CLAIM) and b["element"] not in others:
                kept.append(b["text"])
                continue
            repeated += int(gone.sum())
            if b["kind"] == NAMED:
                named += int((~gone).sum())
            elif not gone.all():
                kept.append(" ".join(w for w, g in zip(b["text"].split(" "), gone, strict=True) if not g) if gone.any() else b["text"])
        text = " ".join(kept) if text is None else text
        out.append((text, len(text), repeated, named))
    names = ("text", "n_chars", "n_repeated", "n_named")
    columns = [pa.array([r[k] for r in out], pa.string() if k == 0 else pa.int64()) for k in range(4)]
    return pa.table([pages.column("page_id"), pages.column("url"), *columns], names=["page_id", "url", *names])


def extract(pages: DataFrame, cell: int = CELL) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated, n_named) of every page.

    The last two count words outside the main text: those in repeats of the host, and the others.
    """
    html = F.col("html").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("host", address_parts(F.col("url"))[0])
    sizes = saved(rows.groupBy("host").agg(F.sum(F.coalesce(F.length("html"), F.lit(0)) + 100).alias("size")))
    large = F.col("size") > cell // 4
    cells = -(-(sizes.agg(F.sum("size")).first()[0] or 0) // cell)
    parts = saved(sizes.filter(large).select(F.col("host").alias("h"), F.ceil(F.col("size") / cell).alias("parts")))
    few = F.broadcast(parts) if parts.count() <= FEW_HOSTS else parts
    copy = F.xxhash64("html").alias("copy")
    placed = rows.join(few, F.col("host") == F.col("h"), "left").select("page_id", "url", "host", F.coalesce("parts", F.lit(0)).alias("parts"), copy, "html")
    alone = F.xxhash64("host", F.pmod(F.xxhash64("copy", "page_id"), F.greatest("parts", F.lit(1))))
    placed = placed.select("page_id", "url", "host", "parts", F.when(F.col("parts") > 0, alone).otherwise(F.pmod(F.xxhash64("host"), F.lit(max(1, cells)))).alias("cell"), "copy", "html")
    # what only pages in different cells of a host share
    dealt = placed.select("host", "cell", "copy", F.col("parts").cast("long").alias("parts"), "html")
    dealt = dealt.mapInArrow(_windows, "host string, cell long, copy long, parts long, window long, claim long")
    ends = [f(c).alias(name) for name, f, c in (("a", F.min, F.col("copy")), ("z", F.max, F.col("copy")), ("parts", F.max, F.col("parts")))]
    own = F.when(F.col("claim") > 0, F.col("copy"))
    dealt = saved(dealt.groupBy("host", "cell", "window").agg(*ends, F.min(own).alias("ca"), F.max(own).alias("cz")))
    salt = F.xxhash64("host")
    window = F.col("window").bitwiseXOR(salt).alias("window")  # hosts may share a cell
    large = dealt.filter("parts > 1")
    across = large.groupBy("host", "window").agg(F.min("a").alias("a"), F.max("z").alias("z"), F.count("*").alias("n")).filter("n > 1 AND a <> z")
    shared = large.select("host", "cell", "window").join(across.select("host", "window"), ["host", "window"]).select("cell", window, F.lit(0).cast("long").alias("claim"))
    # what claims have of the largest main elements of other pages
    claims = dealt.filter("ca IS NOT NULL")
    if not claims.isEmpty():
        mains = placed.select("host", "copy", "html").mapInArrow(_main_windows(membership(claims, "window", hashed=True)), "host string, copy long, window long")
        mains = mains.groupBy("host", "window").agg(F.min("copy").alias("ma"), F.max("copy").alias("mz"))
        told = claims.join(mains, ["host", "window"]).filter("ca <> cz OR ma <> mz OR ca <> ma")
        shared = shared.unionByName(told.select("cell", window, F.lit(1).cast("long").alias("claim")))
    split = placed.select("page_id", "url", "host", "cell", "copy", salt.alias("salt"), "html")
    split = split.mapInArrow(_read, f"page_id long, url string, host string, cell long, copy long, salt long, main string, blocks {BLOCKS}")
    columns = "page_id long, url string, text string, n_chars long, n_repeated long, n_named long"
    return split.groupBy("cell").cogroup(shared.groupBy("cell")).applyInArrow(_decide, columns)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
