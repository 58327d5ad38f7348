"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

A document's set holds its distinct word shingles; two documents link when
their Jaccard similarity reaches the bound.  The result names, for every
document, the least document it is linked with through any chain.  Equal sets
are one node.

Order.  Shingles have one order: how often they stand in a sample of the
documents (the ``heavy`` most frequent ones, a parameter; all others count as
rare), then their hash.  Any order gives the same result; this one puts a set's
rare shingles first.

Inverted lists.  A set is posted under its p + k first shingles, p = n - T + 1, T
being the least overlap with any set it may link with.  A linked pair meets in
k + 1 of these lists (k of the smaller set), each so far in front that what
follows can still reach the overlap.  Postings that can reach it with no set of
their list are dropped, and so are sets left in k lists or fewer.  A copy changed
too much to link is posted under its own shingles, where it is alone.

Search.  Lists are gathered in cells of bounded size: many short lists in one, a
long list in a grid of several.  In a cell, every query's inverted lists are
taken by length: the short ones are merged with a heap, and what they give is
looked up in the long ones by binary search (DivideSkip).  Sets that reach the
required overlap link.

Groups of copies.  First each set is searched by one hub of its lists, the set
with the most frequent shingles, in later turns by any other.  The links make components;
lists that hold one component only are closed, and in what stays open the
largest component of a list sends no queries.  So a group of copies costs
about its size, not its square, and no link between components is left out.

Shuffles carry hashes (p + k of a set) once; texts travel to the cells they are
needed in.  Shingles and sets are compared by 64-bit hash.

Edge cases: no words, or null text: empty set, linked with nothing; fewer than
``width`` words: the whole sequence is one shingle; repeated rows and equal sets
are linked; rows of one doc_id may hold different texts, each row has its own
result; a null doc_id takes part and is never the name of a component that has
others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, fresh, membership, saved, split, stored
from .textcore import BYTE_KEY_LOWER, mix, powers, slices, span_hash, text_bytes, windows, words

#: Shingles of a cell, as queries and as lists.
CELL = 400_000
#: One document of so many is in the sample that orders the shingles.
SAMPLE = 16


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first index of each row): sorted distinct shingles of each row."""
    rows = len(offsets) - 1
    w = words(raw, offsets)
    h = span_hash(raw, w.start, w.end, BYTE_KEY_LOWER)
    key, at = windows(h, w.row, width)
    row = w.row[at]
    n = np.bincount(w.row, minlength=rows)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.cumsum(n) - n
        p = powers(width + 1)
        extra = np.array([mix(np.array([sum((h[first[r] + k] * p[k + 1] for k in range(n[r])), np.uint64(n[r]))], dtype=np.uint64))[0] for r in short], dtype=np.uint64)
        key, row = np.concatenate([key, extra]), np.concatenate([row, short])
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    if len(key):
        fresh = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))
        key, row = key[fresh], row[fresh]
    return key, np.searchsorted(row, np.arange(rows + 1))


def least_overlap(n, bound: Fraction):
    """Shingles that a set of ``n`` shares at least with any set it links with."""
    return np.maximum(1, -(-n * bound.numerator // bound.denominator))


def posted_shingles(n, bound: Fraction):
    """(p, k); both grow with n, so the k of a pair is that of its smaller set."""
    p = n - least_overlap(n, bound) + 1
    return p, np.minimum(p // 3, n - p)


def frequent(docs: DataFrame, width: int, heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, levels): at most ``heavy`` shingles that stand most often in the sample, sorted by hash.

    A level is eight times the binary logarithm of the count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text"):
                key, _ = shingle_sets(*text_bytes(batch.column(1)), width)
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["token", "n"])

    sample = docs.filter(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = saved(counts.select("token", F.floor(F.log2("n") * 8).cast("int").alias("level")))
    left, least = heavy, 0
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"]):
        left -= r["n"]
        if left < 0:
            least = r["level"] + 1
            break
    found = counts.filter(F.col("level") >= least).toArrow()
    token = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], found.column("level").to_numpy().astype(np.int32)[order]


def _postings(width: int, bound: Fraction, hashes: np.ndarray, levels: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text"):
                key, first = shingle_sets(*text_bytes(batch.column(1)), width)
                n = np.diff(first)
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(key * np.uint64(3)), dtype=np.uint64)])
                sig = mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64))
                row = np.repeat(np.arange(len(n)), n)
                level = np.zeros(len(key), dtype=np.int32)
                if len(hashes) and len(key):
                    at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
                    level = np.where(hashes[at] == key, levels[at], 0)
                score = np.bincount(row, level, minlength=len(n)) // np.maximum(n, 1)
                p, k = posted_shingles(n, bound)
                length = np.where(n > 0, p + k, 0)
                ends = np.cumsum(length)
                pick = np.arange(int(ends[-1])) - np.repeat(ends - length, length) + np.repeat(first[:-1], length)
                # hashes are sorted, so a stable sort by level leaves them so among equals
                tokens = key[np.lexsort((level, row))][pick]
                tokens = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), tokens.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n), pa.array(sig.view(np.int64)), pa.array(score.astype(np.int32)), tokens],
                    names=["key", "doc_id", "n_shingles", "sig", "score", "tokens"],
                )

    return run


class Index:
    """Inverted lists of some sets.  Sets are numbered by size, so that a list is sorted by size too."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.tokens, at = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(at, kind="stable")
        self.owner = owner[order]
        self.entry = at[order] * len(sets) + self.owner
        self.first = np.searchsorted(at[order], np.arange(len(self.tokens) + 1))

    def search(self, query: np.ndarray, bound: Fraction, skip) -> list[int]:
        """Sets that reach ``bound`` with ``query``; those for which ``skip`` is true are left out.

        DivideSkip: of the query's lists the longest, all that the least overlap
        allows, are set aside; the short ones are merged with a heap and give
        the candidates with their counts; the long ones are probed.
        """
        n, count = len(query), len(self.sizes)
        num, den = bound.numerator, bound.numerator + bound.denominator
        low = int(np.searchsorted(self.sizes, -(-n * bound.numerator // bound.denominator)))
        high = int(np.searchsorted(self.sizes, n * bound.denominator // bound.numerator, "right"))
        if not n or low >= high:
            return []
        least = -(-num * (n + int(self.sizes[low])) // den)
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if len(at) < least:
            return []
        length = self.first[at + 1] - self.first[at]
        at = at[np.argsort(length, kind="stable")]
        short, long = at[: len(at) - least + 1], at[len(at) - least + 1 :]
        merged: dict[int, int] = {}
        lists = (self.owner[self.first[t] : self.first[t + 1]].tolist() for t in short)
        for k in heapq.merge(*lists):
            if low <= k < high:
                merged[k] = merged.get(k, 0) + 1
        out = []
        for k, hits in merged.items():
            need = -(-num * (n + int(self.sizes[k])) // den)
            if hits + len(long) < need or skip(k):
                continue
            if hits < need:
                probe = long * count + k
                place = np.searchsorted(self.entry, probe)
                hits += int((self.entry[np.minimum(place, len(self.entry) - 1)] == probe).sum())
            if hits >= need:
                out.append(k)
        return out


def links_of(names: list, sets: list[np.ndarray], labels: list, queries: Iterable[bool], listed: Iterable[bool], bound: Fraction) -> list[tuple]:
    """(x, y): links between sets of different labels, as many as join what these links join at all."""
    order = sorted((k for k, yes in enumerate(listed) if yes), key=lambda k: len(sets[k]))
    index = Index([sets[k] for k in order])
    root = {x: x for x in labels}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for q, yes in enumerate(queries):
        if yes:
            for y in index.search(sets[q], bound, lambda k, q=q: find(labels[order[k]]) == find(labels[q])):
                a, b = find(labels[q]), find(labels[order[y]])
                if a != b:
                    root[a] = b
                    out.append((names[q], names[order[y]]))
    return out


def _search(bound: Fraction, width: int):
    def run(cell: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            key, first = shingle_sets(*text_bytes(cell.column("text")), width)
        sets = [key[a:z] for a, z in zip(first[:-1], first[1:], strict=True)]
        node, label, queries, listed = (cell.column(c).to_pylist() for c in ("node", "component", "asks", "listed"))
        links = links_of(node, sets, label, queries, listed, bound)
        return pa.table({"x": pa.array([a for a, _ in links], pa.int64()), "y": pa.array([b for _, b in links], pa.int64())})

    return run


def search(members: DataFrame, texts: DataFrame, bound: Fraction, width: int) -> DataFrame:
    """The links (x, y) inside groups; ``members`` is (group, anchor, node, component, n, asks).

    Members that ask are queries, the group's lists are of all members.  Small
    groups share a cell, those of one anchor, which mostly have the same
    members, the same few; a group of more than CELL shingles has a grid of
    cells, so that each has a bounded part of the lists and of the queries.
    """
    size = members.groupBy("anchor", "group").agg(F.sum("n").alias("w"), F.sum(F.when(F.col("asks"), F.col("n")).otherwise(0)).alias("v"))
    size = size.withColumns({"parts": F.ceil(F.col("w") / CELL), "turns": F.greatest(F.ceil(F.col("v") / CELL), F.lit(1))})
    size = size.withColumn("w", F.when(F.col("parts") * F.col("turns") == 1, F.col("w")).otherwise(0))
    size = saved(size)
    anchors = size.groupBy("anchor").agg(F.sum("w").alias("w"))
    total = size.agg(F.sum("w")).first()[0] or 0
    anchors = anchors.select("anchor", F.greatest(F.ceil(F.col("w") / (4 * CELL)), F.lit(1)).alias("shares"))
    size = size.join(anchors, "anchor").select("group", "parts", "turns", F.xxhash64("anchor", F.pmod(F.xxhash64("group"), "shares")).alias("shared"))
    dealt = members.join(size, "group")
    own, turn = F.pmod(F.xxhash64("node"), "parts"), F.pmod(F.xxhash64("node", F.lit(1)), "turns")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    listed = dealt.select("*", F.lit(True).alias("listed"), F.lit(False).alias("query"), own.alias("part"), spread("turns").alias("turn"))
    asking = dealt.filter("asks").select("*", F.lit(False).alias("listed"), F.lit(True).alias("query"), turn.alias("turn"), spread("parts").alias("part"))
    cells = listed.unionByName(asking)
    shared = F.pmod("shared", F.lit(max(1, -(-total // CELL))))
    cell = F.when(F.col("parts") * F.col("turns") == 1, shared).otherwise(F.xxhash64("group", "part", "turn"))
    cells = cells.groupBy(cell.alias("cell"), "node", "component").agg(F.max("query").alias("asks"), F.max("listed").alias("listed"))
    cells = saved(cells)
    wanted = split(texts, "node", membership(cells.select("node"), "node")).dropDuplicates(["node"])
    return cells.join(wanted, "node").groupBy("cell").applyInArrow(_search(bound, width), "x long, y long")


def ngram_join(docs: DataFrame, width: int = 4, bound: Fraction = Fraction(85, 100), hubs: int = 1, heavy: int = 1 << 18) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return grouped(docs, width, bound, hubs, heavy).select("doc_id", "n_shingles", "component_id")


def without_copies(docs: DataFrame, width: int = 5, bound: Fraction = Fraction(8, 10)) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that of the least doc_id (null last), then of the least row key.

    Rows are told apart by the 64-bit hash of doc_id and text, not by doc_id: rows of one doc_id with different texts
    belong to the groups of their texts.  Of rows equal in both, one stays, and which one is open.  Rows without a
    word are linked with nothing and all stay.
    """
    own = fresh(docs, "key")
    member = saved(grouped(docs, width, bound).filter("group IS NOT NULL").select("key", "doc_id", "group"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    best = member.groupBy("group").agg(first.alias("best"))
    keys = member.groupBy("key", "group").agg(F.count("*").alias("n"))
    verdict = keys.join(best, "group").filter("key <> best OR n > 1").select("key", (F.col("key") == F.col("best")).alias("stays"))
    verdict = saved(verdict)
    bits = membership(verdict, "key", hashed=True)
    keyed = docs.withColumn(own, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    rest = split(keyed, own, bits, inside=False, hashed=True).drop(own)
    met = split(keyed, own, bits, hashed=True)
    untouched = met.join(verdict.select(F.col("key").alias(own)), own, "left_anti").drop(own)
    repeated = met.join(verdict.filter("stays").select(F.col("key").alias(own)), own, "left_semi").dropDuplicates([own]).drop(own)
    return rest.unionByName(untouched).unionByName(repeated)


def grouped(docs: DataFrame, width: int, bound: Fraction, hubs: int = 1, heavy: int = 1 << 18) -> DataFrame:
    """(key, doc_id, n_shingles, group, component_id) of every row.

    ``key`` is the hash of doc_id and text; ``group`` names the group of linked or equal sets, null where a set is
    alone; ``component_id`` is the least doc_id of the group, which several groups can share where doc_ids repeat.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = narrow.select(F.xxhash64("doc_id", "text").alias("key"), "text", "doc_id")
    texts = narrow.select(F.col("key").alias("node"), "text")
    hashes, levels = frequent(narrow, width, heavy)
    schema = "key long, doc_id long, n_shingles long, sig long, score int, tokens array<long>"
    rows = stored(narrow.mapInArrow(_postings(width, bound, hashes, levels), schema))
    filled = rows.filter("n_shingles > 0")
    # equal sets are one node, named by the key of one of their rows
    named = saved(filled.groupBy("sig", "n_shingles").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("r"), F.count("*").alias("rows")))
    named = named.select("sig", F.col("n_shingles").alias("n"), F.col("r.doc_id").alias("least"), F.col("r.key").alias("node"), "rows")
    of = None

    num, den = bound.numerator, bound.numerator + bound.denominator
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sets = filled.select(F.col("key").alias("node"), F.col("n_shingles").cast("int").alias("n"), "sig", "score", "tokens")
    several = membership(named.filter("rows > 1").select("sig"), "sig")  # only equal sets need the join
    sets = split(sets, "sig", several, inside=False).unionByName(split(sets, "sig", several).join(named.select("node"), "node").dropDuplicates(["node"]))
    posted = sets.select("node", "n", "score", F.posexplode("tokens").alias("place", "token"))
    posted = posted.select("node", "n", "score", "token", (F.col("n") - F.col("place")).alias("rest")).repartition(parts, "token")
    lists = stored(_often(_alive(posted.withColumn("component", F.col("node")), bound), bound).drop("component"))

    links = None
    for turn in range(hubs + 1):
        member = lists.withColumn("component", F.col("node")) if of is None else lists.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if turn:
            member = _often(_alive(member, bound), bound)
            member = saved(member if turn < hubs else _alive(member, bound, strict=True))
        if turn < hubs:
            order = F.struct(F.lit(0) if turn else -F.col("score"), F.xxhash64("component", F.lit(turn)), F.xxhash64("node", F.lit(turn)), "component", "node", "n", "rest")
            hub = member.groupBy("token").agg(F.min(order).alias("h"))
            hub = hub.select("token", F.col("h.node").alias("hub"), F.col("h.component").alias("c"), F.col("h.n").alias("m"), F.col("h.rest").alias("far"))
            k = _posted_sql(F.least("n", "m"), bound)
            pairs = member.join(hub, "token").filter("component <> c").filter((F.least("rest", "far") + k) * den >= (F.col("n").cast("long") + F.col("m")) * num)
            pairs = pairs.groupBy("node", "component", "n", "hub", "c", "m").agg(F.count("*").alias("shared")).filter(F.col("shared") > k)
            best = pairs.groupBy("node").agg(F.max(F.struct("shared", "hub", "c", "m", "component", "n")).alias("p")).select("node", "p.*")
            best = saved(best)
            groups = best.select(F.col("hub").alias("group"), F.col("hub").alias("anchor"), "node", "component", "n", F.lit(False).alias("asks"))
            groups = groups.unionByName(best.select(F.col("hub").alias("group"), F.col("hub").alias("anchor"), F.col("hub").alias("node"), F.col("c").alias("component"), F.col("m").alias("n"), F.lit(True).alias("asks")).distinct())
        else:
            # of lists with the same members one is enough; the largest component of a list need not ask
            same = member.groupBy("token").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.count("*").alias("k"))
            same = same.groupBy("s", "k").agg(F.min("token").alias("token")).select("token")
            weight = member.groupBy("token", "component").agg(F.sum("n").alias("w"))
            largest = weight.groupBy("token").agg(F.max(F.struct("w", "component"))["component"].alias("c"))
            groups = member.join(same, "token").join(largest, "token")
            groups = groups.select(F.col("token").alias("group"), F.col("c").alias("anchor"), "node", "component", "n", (F.col("component") != F.col("c")).alias("asks"))
        found = saved(search(saved(groups), texts, bound, width))
        links = found if links is None else links.unionByName(found)
        of = saved(components(links, "x", "y") if turn == hubs else components(links, "x", "y", rounds=1, settle=False))

    # a component is named by its least document
    linked = named.join(of, "node").select("sig", "n", "least", "component")
    name = linked.groupBy("component").agg(F.min("least").alias("name"))
    linked = linked.join(name, "component").select("sig", "n", "component", "name")
    alone = named.filter("rows > 1").join(of, "node", "left_anti").select("sig", "n", "node", F.col("least").alias("name"))
    label = linked.union(alone).toDF("s", "m", "group", "name")
    return rows.select("key", "doc_id", "n_shingles", "sig").join(label, (F.col("sig") == F.col("s")) & (F.col("n_shingles") == F.col("m")), "left").select(
        "key", "doc_id", "n_shingles", "group", F.coalesce("name", "doc_id").alias("component_id")
    )


def _posted_sql(n: Column, bound: Fraction) -> Column:
    """The k of ``posted_shingles``."""
    n = n.cast("long")
    rest = (n * bound.numerator + (bound.denominator - 1)) / bound.denominator
    least = F.greatest(F.floor(rest), F.lit(1))
    p = n - least + 1
    return F.least(F.floor(p / 3), n - p)


def _alive(lists: DataFrame, bound: Fraction, strict: bool = False) -> DataFrame:
    """Postings of lists with two components or more that can reach the overlap with the smallest set of their list.

    Up to k shingles that a pair shares may stand before them; before the first one, which is ``strict``, none.
    """
    num, den = bound.numerator, bound.numerator + bound.denominator
    seen = lists.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("z"), F.min("n").alias("m"))
    before = F.lit(0) if strict else _posted_sql(F.col("n"), bound)
    reach = (F.col("rest").cast("long") + before) * den >= (F.col("n").cast("long") + F.col("m")) * num
    return lists.join(seen.filter("a <> z").select("token", "m"), "token").filter(reach).drop("m")


def _often(lists: DataFrame, bound: Fraction) -> DataFrame:
    """Postings of sets that are in more lists than the k of the smallest set they may link with."""
    least = F.floor((F.col("n").cast("long") * bound.numerator + (bound.denominator - 1)) / bound.denominator)
    return lists.withColumn("c", F.count("*").over(Window.partitionBy("node"))).filter(F.col("c") > _posted_sql(least, bound)).drop("c")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return ngram_join(read(spark, sf_dir, "documents"))
