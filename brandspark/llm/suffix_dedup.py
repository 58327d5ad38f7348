"""Exact substring deduplication by a Burrows-Wheeler transform.

Every byte covered by a string of ``WIDTH`` bytes that also starts anywhere else
goes.  Matches never cross documents; strings are judged on the input.

Dealing out.  Each window of WIDTH bytes has an anchor, the leftmost of its
k-mers of least hash, so equal windows have equal anchors at equal places.  The
consecutive windows of one anchor form a segment; every window is in exactly one
segment, and windows can only be equal inside the group of one anchor hash.
Segments whose anchor is found once have no repeats.  Equal segments are counted
before any bytes travel.

Transform.  The distinct segments of whole groups are put together in blocks of
bounded size.  A block's suffixes are sorted, and from its transform common
prefixes are derived by increasing value: breadth-first backward extension of
the intervals of all strings of length 0, 1, 2, ...; an interval goes on only
where it sets a new value, and the expansion stops at WIDTH.  Neighbours whose
value is not set by then share WIDTH bytes or more.

Hot groups.  A group of more than ``GROUP`` distinct segments is dealt out anew:
each segment is cut into the windows left and right of the middle of the
anchor's range, and the bytes that all windows of a part have in common name its
new group.  Parts that are equal are settled by count; the rest is cut again
until groups are small.  No group is held by one task, and no segment is lost.

What is shuffled: a hash and a number for each segment; places of segments whose
anchor repeats; texts of documents that hold such segments.  Equal anchors and
segments are told by 64-bit hash; windows inside a block by their bytes.

Edge cases: null is empty; documents shorter than WIDTH keep all; a long run of
one byte is one place with a count; repeated rows are copies of each other;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import membership, read, saved, split, stored
from .line_dedup import _inverses
from .textcore import BYTE_KEY, mix, powers, slices, text_bytes

WIDTH = 200
KMER = 40
SPAN = WIDTH - KMER + 1  # places of the anchor in a window
GROUP = 256
BLOCK_BYTES = 1 << 19
STRIDE = 1 << 14
PLACE = np.uint64(0xFFFF)


class Segments:
    """The segments of the rows of a slice."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        empty = np.zeros(0, dtype=np.int64)
        self.row = self.first = self.last = self.anchor = empty
        self.hash = np.zeros(0, dtype=np.uint64)
        rows = np.flatnonzero(np.diff(offsets) >= WIDTH)
        if not len(rows):
            return
        self._total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_KEY[raw] * powers(n), dtype=np.uint64)])
        self._inverse = _inverses(n + 1)
        change, at, hashes = self._anchor_runs(n - WIDTH + 1)
        # segments end where the anchor changes and where a row's windows begin or end
        begin, end = offsets[rows], offsets[rows + 1] - WIDTH + 1
        edge = np.unique(np.concatenate([change, begin, end]))
        row = np.searchsorted(begin, edge, "right") - 1
        use = np.flatnonzero((row >= 0) & (edge < end[row]))
        run = np.searchsorted(change, edge[use], "right") - 1
        self.row, self.first, self.last = rows[row[use]], edge[use], edge[use + 1] - 1
        self.anchor, self.hash = at[run], hashes[run]

    def _anchor_runs(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, place of the anchor, its hash) of each run of windows with one anchor, rows not looked at."""
        found = []
        for low in range(0, count, STRIDE):  # so many windows at once that the arrays stay in the processor's cache
            here = min(STRIDE, count - low)
            m = here + SPAN - 1
            h = mix((self._total[low + KMER : low + KMER + m] - self._total[low : low + m]) * self._inverse[low : low + m])
            # leftmost least of SPAN values, by doubling; the low 16 bits are the place, the others those of the hash
            least, size = (h & ~PLACE) | np.arange(m, dtype=np.uint64), 1
            while 2 * size <= SPAN:
                least = np.minimum(least[size:], least[:-size])
                size *= 2
            shift = SPAN - size
            at = (np.minimum(least[shift : shift + here], least[:here]) & PLACE).astype(np.int64)
            change = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
            found.append((change + low, at[change] + low, h[at[change]]))
        change, at, hashes = (np.concatenate(c) for c in zip(*found, strict=True))
        fresh = np.append(True, at[1:] != at[:-1])
        return change[fresh], at[fresh], hashes[fresh]

    @property
    def sid(self) -> np.ndarray:
        """Hash of each segment: its bytes, its windows and the place of its anchor."""
        if not len(self.first):
            return np.zeros(0, dtype=np.uint64)
        place = (self.last - self.first) * 512 + self.anchor - self.first
        body = (self._total[self.last + WIDTH] - self._total[self.first]) * self._inverse[self.first]
        return mix(body + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def runs(self, sid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first of each run, length): equal segments of a row at places one byte apart are one run."""
        if not len(sid):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = (sid[1:] == sid[:-1]) & (self.first[1:] == self.first[:-1] + 1) & (self.row[1:] == self.row[:-1])
        first = np.flatnonzero(np.append(True, ~same))
        return first, np.diff(np.append(first, len(sid)))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n): the anchors of each slice, counted."""
    with np.errstate(over="ignore"):
        for batch in slices(batches, "text"):
            h, n = np.unique(Segments(*text_bytes(batch.column(0))).hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))], names=["h", "n"])


def _places(packed: np.ndarray, bits: int):
    """Places of the segments whose anchor may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed).astype(bool)
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text"):
                raw, offsets = text_bytes(batch.column(1))
                s = Segments(raw, offsets)
                sid = s.sid
                first, length = s.runs(sid)
                keep = table[(s.hash[first] & np.uint64(bits - 1)).astype(np.int64)]
                first, length = first[keep], length[keep]
                row = s.row[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)),
                        pa.array(s.hash[first].view(np.int64)),
                        pa.array(sid[first].view(np.int64)),
                        pa.array(s.first[first] - offsets[row]),
                        pa.array((s.last[first] - s.first[first] + 1).astype(np.int16)),
                        pa.array((s.anchor[first] - s.first[first]).astype(np.int16)),
                        pa.array(length.astype(np.int32)),
                    ],
                    names=["dk", "h", "sid", "start", "nw", "ao", "rep"],
                )

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode()
            out += [(w["h"], w["sid"], w["nw"], w["ao"], data[w["start"] : w["start"] + w["nw"] + WIDTH - 1]) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["gid", "sid", "nw", "ao", "bytes"])


def _ordered(key: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys in order) of keys below ``bound``; a sort of key and index in one number where both fit."""
    bits = len(key).bit_length()
    if bound.bit_length() + bits > 63:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort((key << bits) | np.arange(len(key)))
    return both & ((1 << bits) - 1), both >> bits


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more (ties in any order)."""
    n = len(symbols)
    base = int(symbols.max()) + 1 if n else 1
    key, d = symbols.astype(np.int64), 1
    while d < depth and base ** (d + 1) * (n + 1) < 2**62:
        key *= base
        key[: max(0, n - d)] += symbols[d:]
        d += 1
    bound = base**d
    while True:
        order, ordered = _ordered(key, bound)
        if d >= depth:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1]))
        key, bound = rank * (n + 1), (n + 1) ** 2
        key[: max(0, n - d)] += rank[d:]
        d *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """True at i where the suffixes i - 1 and i of the order share ``least`` symbols or more.

    Values are derived from the transform by increasing value and the expansion
    stops at ``least``; places without a value by then are the answer.  Intervals
    stand in ascending order, so their rows, taken one symbol back, come in the
    order of symbol and interval: many rows are put in place, few are sorted.
    """
    n = len(symbols)
    bwt = symbols[order - 1]
    bwt[order == 0] = 0
    head = symbols[order]
    step = np.empty(n, dtype=np.int64)  # from a row to the row of the suffix one symbol longer
    step[np.argsort(bwt, kind="stable")] = np.arange(n)
    unset = np.ones(n + 1, dtype=bool)
    unset[0] = unset[n] = False
    low, high = np.zeros(1, dtype=np.int64), np.full(1, n, dtype=np.int64)
    for _ in range(least):  # strings of length 0, 1, ..., least - 1
        if not len(low):
            break
        size = high - low
        end = np.cumsum(size)
        of = np.repeat(np.arange(len(low)), size)
        at = step[np.arange(int(end[-1])) + np.repeat(low - end + size, size)]
        if 8 * len(at) > n:
            owner = np.full(n, -1, dtype=np.int64)
            owner[at] = of
            at = np.flatnonzero(owner >= 0)
            of = owner[at]
        else:
            by_place = np.argsort(at)
            at, of = at[by_place], of[by_place]
        symbol = head[at]
        edge = np.flatnonzero((of[1:] != of[:-1]) | (symbol[1:] != symbol[:-1]))
        low, high = at[np.append(0, edge + 1)], at[np.append(edge, len(at) - 1)] + 1
        fresh = unset[high]
        low, high = low[fresh], high[fresh]
        unset[high] = False
    return unset[:n]


def repeated_windows(pieces: list[bytes]) -> list[np.ndarray]:
    """For each piece, which of its windows occur again in these pieces."""
    raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    length = np.array([len(p) for p in pieces])
    used = np.flatnonzero(np.bincount(raw, minlength=256))
    code = np.zeros(256, dtype=np.uint16)
    code[used] = 1 + np.arange(len(used))
    start = np.concatenate([[0], np.cumsum(length + 1)])
    symbols = np.zeros(int(start[-1]), dtype=np.uint16)  # a separator, 0, ends each piece
    inside = np.ones(len(symbols), dtype=bool)
    inside[start[1:] - 1] = False
    symbols[inside] = code[raw]
    order = suffix_array(symbols, WIDTH + 1)
    share = common_prefixes(symbols, order, WIDTH)
    mark = np.zeros(len(symbols), dtype=bool)
    at = np.flatnonzero(share)
    mark[order[at]] = True
    mark[order[at - 1]] = True
    return [mark[start[k] : start[k] + max(0, length[k] - WIDTH + 1)] for k in range(len(pieces))]


def _ranges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group -> (sid, f, t): ranges of windows that repeat."""
    sid: list = []
    off: list = []
    pieces: list[bytes] = []
    size, group = 0, None

    def flush() -> pa.RecordBatch:
        rows = []
        for s, o, mask in zip(sid, off, repeated_windows(pieces), strict=True):
            rows += [(s, o + a, o + z) for a, z in zip(*(x.tolist() for x in _ranges(mask)), strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["sid", "f", "t"])

    for batch in batches:
        for g, s, o, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if g != group and size > BLOCK_BYTES:  # a group is never cut
                yield flush()
                sid, off, pieces, size = [], [], [], 0
            group = g
            sid.append(s)
            off.append(o)
            pieces.append(data)
            size += len(data)
    if pieces:
        yield flush()


def _halves(level: int):
    """Cut pieces at the middle of the anchor's range; the bytes that all windows of a part share name its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        number = lambda *x: int.from_bytes(hashlib.blake2b(b"".join(x), digest_size=8).digest(), "little", signed=True)
        width = -(-SPAN // 2**level)
        for batch in batches:
            out = []
            for gid, sid, off, nw, ao, data in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                at = 0
                while at < nw:
                    # windows from ``at`` on whose anchor place is in one aligned range [low, low + width)
                    low = (ao - at) // width * width
                    end = min(nw, ao - low + 1)
                    core = data[ao - low : ao - min(low + width, SPAN) + 1 + WIDTH]
                    part = data[at : end + WIDTH - 1]
                    tag = gid.to_bytes(8, "little", signed=True) + bytes([low])
                    out.append((number(tag, core), number(tag, (ao - at).to_bytes(2, "little"), part), sid, off + at, end - at, ao - at, part))
                    at = end
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["gid", "ph", "sid", "off", "nw", "ao", "bytes"])

    return run


def _bits(h: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size over the low bits of anchor hashes."""
    word = h.select(F.col("h").bitwiseAND(bits - 1).alias("b")).groupBy(F.shiftright("b", 5).alias("w"))
    table = word.agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("v"))
    out = np.zeros(bits // 32, dtype=np.uint32)
    pdf = table.toPandas()
    out[pdf["w"].to_numpy()] = pdf["v"].to_numpy().astype(np.uint32)
    return np.packbits(np.unpackbits(out.view(np.uint8), bitorder="little"))


def removed_ranges(docs: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """(dk, ranges) of each document with any: byte ranges that go; dk is the hash of doc_id and text."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("dk"), F.col("text").cast("string"))
    anchors = keyed.select("text").mapInArrow(_anchors, "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    places = stored(keyed.mapInArrow(_places(_bits(anchors, bits), bits), "dk long, h long, sid long, start long, nw short, ao short, rep int"))
    one = F.struct("dk", "start", "nw", "ao")
    distinct = places.groupBy("h", "sid").agg(F.sum("rep").alias("n"), F.min(one).alias("p"))
    groups = distinct.groupBy("h").agg(F.count("*").alias("nd")).filter("nd > 1")
    whole = distinct.filter("n > 1").select("sid", F.lit(0).alias("f"), F.lit(WIDTH).alias("t"))
    wanted = distinct.join(groups, "h").select("p.dk", F.struct("h", "sid", "p.start", "p.nw", "p.ao").alias("w")).groupBy("dk").agg(F.collect_list("w").alias("wanted"))
    wanted = saved(wanted)
    texts = split(keyed, "dk", membership(wanted, "dk")).dropDuplicates(["dk"])
    pieces = wanted.join(texts, "dk").select("wanted", "text").mapInArrow(_cut_out, "gid long, sid long, nw short, ao short, bytes binary")
    pieces = stored(pieces.select("gid", F.col("sid").alias("ph"), "sid", F.lit(0).alias("off"), "nw", "ao", "bytes"))
    marks, level = [whole], 0
    while True:
        size = pieces.groupBy("gid", "ph").agg(F.min("sid").alias("sid"), F.count("*").alias("n"))
        group = size.groupBy("gid").agg(F.count("*").alias("nd")).filter("nd > 1")
        if level:  # equal parts of different segments repeat as they are
            equal = pieces.join(size.filter("n > 1").select("gid", "ph"), ["gid", "ph"])
            marks.append(equal.select("sid", F.col("off").alias("f"), (F.col("off") + F.col("nw") - 1).alias("t")))
        single = pieces.join(size.select("gid", "ph", "sid"), ["gid", "ph", "sid"]).join(group, "gid")
        small = single.filter(F.col("nd") <= GROUP).select("gid", "sid", "off", "bytes")
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        small = small.repartition(parts, "gid").sortWithinPartitions("gid")
        marks.append(saved(small.mapInArrow(_transform, "sid long, f int, t int")))
        big = single.filter(F.col("nd") > GROUP).select("gid", "sid", "off", "nw", "ao", "bytes")
        level += 1
        pieces = stored(big.mapInArrow(_halves(level), "gid long, ph long, sid long, off int, nw short, ao short, bytes binary"))
        if pieces.isEmpty():
            break
    found = marks[0]
    for more in marks[1:]:
        found = found.unionByName(more)
    found = found.select("sid", "f", "t")
    ranges = places.join(found, "sid").select(
        "dk",
        F.struct((F.col("start") + F.col("f")).alias("b"), (F.col("start") + F.least(F.col("t"), F.col("nw") - 1) + F.col("rep") - 1 + WIDTH).alias("e")).alias("r"),
    )
    return ranges.groupBy("dk").agg(F.collect_list("r").alias("ranges"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, ranges in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            data = (text or "").encode()
            kept, at, removed, spans = [], 0, 0, 0
            last = -1
            for r in sorted((r["b"], r["e"]) for r in ranges or ()):
                if r[0] > last:
                    spans += 1
                    kept.append(data[at : r[0]])
                    removed += r[1] - r[0]
                    last = at = r[1]
                elif r[1] > last:
                    removed += r[1] - last
                    last = at = r[1]
            kept.append(data[at:])
            out.append((doc, len(data), removed, spans, b"".join(kept)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept are the bytes that stay."""
    gone = saved(removed_ranges(docs))
    bits = membership(gone, "dk")
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("doc_id", "text").alias("__dk"))
    touched = split(keyed, "__dk", bits).join(gone, F.col("__dk") == F.col("dk"), "left").select("doc_id", "text", "ranges")
    touched = touched.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    data = F.coalesce("text", F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    rest = split(keyed, "__dk", bits, inside=False).select(
        "doc_id", F.length(data).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), data.alias("kept")
    )
    return touched.unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    result = suffix_dedup(read(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
