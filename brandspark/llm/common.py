"""What several operators share: column lookup, checkpoints, small helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Ask the session for Arrow batches of at most ``rows`` rows, as they hold whole texts in Python and in the JVM."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder for what jobs leave for each other: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session, as in tests, gets a temporary one; a cluster has to name one.
    """
    short_batches(spark)
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame, src: str, dst: str, rounds: int = 60, settle: bool = True) -> DataFrame:
    """(node, component) of every node of ``edges``; component is the least node.

    Alternating large-star and small-star rounds: each shrinks the forest and
    every group is handled by aggregation (least neighbour), so no node's
    neighbours are gathered.  Rounds grow with the logarithm of the diameter.
    Without ``settle`` the given rounds are all, and the component is the least
    node found so far: nodes of one component are connected, but not all
    connected nodes are of one component yet.
    """
    links = saved(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(rounds):
        # large star: neighbours above a node link to its least neighbour
        sym = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sym.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # small star: neighbours below a node, and the node, link to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        links = saved(small)
        if settle:
            now = links.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before or now[0] == 0:
                break
            before = now
    else:
        if settle:
            raise RuntimeError("components did not settle")
    ends = links.select(F.col("u").alias("node"), "v").union(links.select("v", "v"))  # roots are their own
    return ends.groupBy("node").agg(F.min("v").alias("component"))


def stored(df: DataFrame) -> DataFrame:
    """As ``saved``, but as a compressed table in the same shared folder; for wide intermediate rows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MOST_BITS = 1 << 26


def membership(keys: DataFrame, column: str, hashed: bool = False) -> np.ndarray | None:
    """A bitmap in which the bit of every key is set, of 8 to 16 bits a key; None beyond ``MOST_BITS`` (8 MB).

    A row whose bit is not set has no such key; the others still need the exact
    join.  It spares most rows that join from being shuffled.  ``keys`` is read twice.
    Where the keys are hashes already (``hashed``), their low bits name the bit.
    """
    size = 1 << max(16, (8 * keys.count()).bit_length())
    if size > MOST_BITS:
        return None
    bit = F.pmod(F.col(column) if hashed else F.xxhash64(column), F.lit(size))
    words = keys.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v")).toArrow()
    out = np.zeros(size // 64, dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def split(docs: DataFrame, column: str, bits: np.ndarray | None, inside: bool = True, hashed: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key may be (``inside``) or cannot be among the keys of the bitmap; without one, all may be.

    ``hashed`` as in ``membership``.
    """
    if bits is None:
        return docs if inside else docs.filter(F.lit(False))
    packed, size, name = np.packbits(bits), len(bits), f"__bit_{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed).astype(bool)
        for batch in batches:
            hit = table[batch.column(batch.schema.get_field_index(name)).to_numpy()]
            yield batch.filter(pa.array(hit if inside else ~hit)).drop_columns([name])

    return docs.withColumn(name, F.pmod(F.col(column) if hashed else F.xxhash64(column), F.lit(size))).mapInArrow(run, docs.schema)
