"""Line deduplication by a deletion-neighbourhood join.

Lines are stripped; those of ``min_chars`` characters or more take part, and
those of ``exact_chars`` or more where lines are equal.  Of
equal lines the earliest occurrence (by doc_id, then line number) stays.  Of
distinct lines within one edit (a character inserted, deleted or replaced) the
one whose first occurrence is earlier stays; a line goes when any earlier line
is within the bound, kept or not.

Search.  Each candidate line emits all its variants with one character deleted
as hashed keys: with the position, so that equal variants are one replacement
apart; and without, to meet a whole line that is one character shorter.  The
earliest line of a key flags the others, and each flagged pair is verified by
its exact edit distance.  Only lines that can have a partner emit variants: one
edit leaves one half of a line as it was, so lines whose half-keys are all
their own have none.

Shuffles carry a narrow row for each line; a bitmap keeps the
texts of documents without such lines from being shuffled.  Equal lines are
told by 64-bit hash, near lines by distance.

Edge cases: null texts stay null, empty ones empty; shorter lines always stay;
ties cannot occur between different places; rows of equal doc_id and text count
as one document, so their lines are not copies of each other; extra columns
stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import membership, read, saved, split, stored
from .textcore import MULTIPLIER, Powers, lines, mix, powers, slices, text_bytes, words

MIN_CHARS = 20
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
_inverses = Powers(INVERSE)


class Chars:
    """Code points of a slice, its stripped lines, and hashes of any part in constant time."""

    def __init__(self, array: pa.Array):
        raw, offsets = text_bytes(array)
        self.point = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        offsets = before[offsets]
        narrow = np.minimum(self.point, 255).astype(np.uint8)
        found, w = lines(narrow, offsets), words(narrow, offsets)
        self.row = found.row
        self.number = np.arange(len(found.row)) - np.searchsorted(found.row, found.row)
        first, last = np.searchsorted(w.start, found.start), np.searchsorted(w.start, found.end)
        some = last > first
        self.start, self.end = found.start.copy(), found.start.copy()
        self.start[some], self.end[some] = w.start[first[some]], w.end[last[some] - 1]
        value = mix(self.point.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)) * powers(len(self.point))
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
        self.value = value

    def raw_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * _inverses(len(self.total))[start]


def _finish(h: np.ndarray, length: np.ndarray, salt: int) -> np.ndarray:
    return mix(h + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt)).view(np.int64)


def _line_rows(min_chars: int, exact_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text"):
                c = Chars(batch.column(2))
                n = c.end - c.start
                use = np.flatnonzero(n >= min(min_chars, exact_chars))
                a, z, n = c.start[use], c.end[use], n[use]
                row = pa.array(c.row[use])
                halves = []
                for m in (n, n - 1):
                    h = m // 2
                    halves += [_finish(c.raw_hash(a, a + h), m, 1), _finish(c.raw_hash(z - (m - h), z), m, 2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(c.number[use].astype(np.int32)), pa.array(_finish(c.raw_hash(a, z), n, 0)), *(pa.array(h, mask=n < min_chars) for h in halves)],
                    names=["doc_id", "dk", "line", "lid", "k1", "k2", "k3", "k4"],
                )

    return run


def _candidate_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dk, numbers of lines, text) -> the stripped lines of those numbers."""
    for batch in batches:
        out = []
        for dk, wanted, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            parts = text.split("\n")
            out += [(w["lid"], w["doc_id"], w["line"], parts[w["line"]].strip(" \t\n\x0b\x0c\r")) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["lid", "doc_id", "line", "text"])


def _variants(packed: np.ndarray | None = None):
    """Hashed keys of each line: kind 0, a variant with its position; 1, a variant; 2, the line itself.

    With the bitmap of ``membership``, only keys whose bit is set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if packed is None else np.unpackbits(packed).astype(bool)
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 1 << 17):
                c = Chars(batch.column(3))
                a, z = c.start, c.end
                n = z - a
                which = np.repeat(np.arange(len(n)), n)
                at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
                # the characters behind the deleted one move one place down
                h = c.raw_hash(a[which], at) + (c.total[z[which]] - c.total[at + 1]) * _inverses(len(c.total) + 1)[a[which] + 1]
                length = n[which] - 1
                key = [_finish(h + mix((at - a[which]).astype(np.uint64)), length, 3), _finish(h, length, 4), _finish(c.raw_hash(a, z), n, 4)]
                # equal characters in a row give equal variants; one of each is enough for kind 1
                again = np.zeros(len(at), dtype=bool)
                inner = np.flatnonzero(at > a[which])
                again[inner] = c.point[at[inner]] == c.point[at[inner] - 1]
                take = [which, which[~again], np.arange(len(n))]
                key[1] = key[1][~again]
                of, keys = np.concatenate(take), np.concatenate(key)
                kind = np.repeat(np.array([0, 1, 2], dtype=np.int8), [len(t) for t in take])
                if table is not None:
                    may = np.flatnonzero(table[keys & (len(table) - 1)])
                    of, keys, kind = of[may], keys[may], kind[may]
                row = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(kind), *(batch.column(k).take(row) for k in range(3))], names=["key", "kind", "lid", "doc_id", "line"]
                )

    return run


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int = MIN_CHARS) -> DataFrame:
    """(dk, removed): the numbers of the lines that go, for each document with any; dk is the hash of doc_id and text."""
    keyed = docs.select(F.col("doc_id").cast("long"), _document_key(), F.col("text").cast("string"))
    rows = stored(
        keyed.mapInArrow(_line_rows(min_chars, exact_chars), "doc_id long, dk long, line int, lid long, k1 long, k2 long, k3 long, k4 long")
    )
    place = F.struct("doc_id", "line", "dk")
    half_keys = ["k1", "k2", "k3", "k4"]  # the same for all rows of a line
    distinct = rows.groupBy("lid").agg(F.min(place).alias("first"), F.max(place).alias("last"), *[F.min(k).alias(k) for k in half_keys])
    distinct = stored(distinct.select("lid", "first", (F.col("first") < F.col("last")).alias("again"), *half_keys))
    keys = distinct.filter("k1 IS NOT NULL").select("lid", F.explode(F.array(*half_keys)).alias("key"))
    shared = keys.groupBy("key").agg(F.min("lid").alias("a"), F.max("lid").alias("z")).filter("a <> z").select("key")
    found = keys.join(shared, "key").select("lid").distinct()
    near = saved(distinct.select("lid", "first").join(found, "lid"))

    wanted = near.groupBy("first.dk").agg(F.collect_list(F.struct("lid", "first.doc_id", "first.line")).alias("wanted"))
    texts = split(keyed.select("dk", "text"), "dk", membership(near.select("first.dk"), "dk")).dropDuplicates(["dk"])
    candidates = stored(
        wanted.join(texts, "dk").select("dk", "wanted", "text").mapInArrow(_candidate_lines, "lid long, doc_id long, line int, text string")
    )
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    lines_of = "lid long, doc_id long, line int"
    dealt = candidates.repartition(parts)
    # which keys are met twice is told by the keys alone; only rows of such keys travel
    variants = dealt.mapInArrow(_variants(), f"key long, kind byte, {lines_of}").select("key")
    met = saved(variants.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    bits = membership(met, "key", hashed=True)
    keyed_variants = stored(dealt.mapInArrow(_variants(None if bits is None else np.packbits(bits)), f"key long, kind byte, {lines_of}"))
    spot = F.struct("doc_id", "line", "lid")
    of_kind = lambda k: F.min(F.when(F.col("kind") == k, spot))
    # the earliest line of each key; keys of kinds 1 and 2 meet each other only
    groups = keyed_variants.groupBy("key").agg(of_kind(0).alias("replaced"), of_kind(1).alias("longer"), of_kind(2).alias("shorter"), F.count("*").alias("n"))
    partner = F.when(F.col("kind") == 0, F.col("replaced")).when(F.col("kind") == 1, F.col("shorter")).otherwise(F.col("longer"))
    flagged = (
        keyed_variants.join(groups.filter("n > 1"), "key")
        .select("lid", "doc_id", "line", partner.alias("p"))
        .filter(F.col("p").isNotNull() & (F.struct("p.doc_id", "p.line") < F.struct("doc_id", "line")))
        .select("lid", F.col("p.lid").alias("earlier"))
        .distinct()
    )
    text = candidates.select("lid", "text")
    verified = (
        flagged.join(text, "lid")
        .join(text.select(F.col("lid").alias("earlier"), F.col("text").alias("other")), "earlier")
        .filter(F.levenshtein("text", "other", 1) == 1)
        .select("lid")
        .distinct()
        .withColumn("near", F.lit(True))
    )
    # lines that occur again, or are near an earlier one
    bad = distinct.filter("again").select("lid", "first").withColumn("near", F.lit(False))
    bad = bad.unionByName(near.join(verified, "lid").select("lid", "first", "near")).groupBy("lid").agg(F.min("first").alias("first"), F.max("near").alias("near"))
    bad = saved(bad)  # a line of many places can then be dealt out anew by the join
    gone = rows.select("lid", "doc_id", "line", "dk").join(bad, "lid").filter("near OR NOT (first.dk = dk AND first.line = line)")
    return gone.groupBy("dk").agg(F.array_distinct(F.collect_list("line")).alias("removed"))


def _document_key():
    return F.xxhash64("doc_id", "text").alias("dk")


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their kept lines, and ``__removed``, how many went; a column of that name gives way."""
    gone = saved(removed_lines(docs, min_chars, exact_chars))
    bits = membership(gone, "dk")
    own = [c for c in docs.columns if c != "__removed"]
    keyed = docs.select(_document_key(), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    kept = F.array_join(F.filter(F.split("row.text", "\n", -1), lambda x, k: ~F.array_contains("removed", k)), "\n")
    touched = split(keyed, "dk", bits).join(gone, "dk", "left").select(
        *[F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(kept).alias(c) if c == "text" else F.col(f"row.`{c}`") for c in own],
        F.coalesce(F.size("removed"), F.lit(0)).alias("__removed"),
    )
    rest = split(keyed, "dk", bits, inside=False).select("row.*", F.lit(0).alias("__removed"))
    return touched.unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lines_left = F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)
    return line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("__removed").cast("long").alias("n_removed"),
        F.length(text).cast("long").alias("kept_chars"),
        F.md5(text.cast("binary")).alias("kept_md5"),
    )


#: The same over the whole table: equal lines by value, near lines by the halves that one edit leaves alone.
ORACLE = """
WITH l AS (
  SELECT doc_id, text, u.i - 1 AS line, p[u.i] AS raw, trim(p[u.i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents) d, unnest(range(1, len(p) + 1)) AS u(i)
), d AS (
  SELECT x, length(x) AS n, min((doc_id, line)) AS first FROM l WHERE length(x) >= 20 GROUP BY x
), k AS (
  SELECT x, n AS m, 'p' AS part, left(x, n // 2) AS h FROM d
  UNION ALL SELECT x, n, 's', right(x, n - n // 2) FROM d
  UNION ALL SELECT x, n - 1, 'p', left(x, (n - 1) // 2) FROM d
  UNION ALL SELECT x, n - 1, 's', right(x, (n - 1) - (n - 1) // 2) FROM d
), pairs AS (
  SELECT DISTINCT a.x, b.x AS y FROM k a JOIN k b ON a.m = b.m AND a.part = b.part AND a.h = b.h AND a.x <> b.x
), near AS (
  SELECT DISTINCT p.x FROM pairs p JOIN d a ON a.x = p.x JOIN d b ON b.x = p.y
  WHERE b.first < a.first AND abs(a.n - b.n) <= 1 AND levenshtein(p.x, p.y) = 1
), marked AS (
  SELECT l.doc_id, l.text, l.line, l.raw,
         d.x IS NOT NULL AND ((l.doc_id, l.line) <> d.first OR near.x IS NOT NULL) AS gone
  FROM l LEFT JOIN d ON l.x = d.x LEFT JOIN near ON l.x = near.x
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id, text
)
SELECT d.doc_id, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars, md5(coalesce(kept, '')) AS kept_md5
FROM documents d LEFT JOIN kept USING (doc_id)
"""
