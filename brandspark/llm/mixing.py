"""Mixing sources to target weights by sampled blocks.

The words of each source, in one fixed order, are packed into blocks of
``block_words`` words.  Each output shard draws a multinomial count for every
source, with the shares that are still owed as probabilities, so that all
shards together owe nothing.  A source's slots run through one pseudorandom
permutation of its block numbers after the other (a keyed Feistel network, one
key for each pass), and blocks are joined by number.

Plan: sizes are counted in the JVM and checkpointed (narrow); offsets come from
three levels of prefix sums over chunks of about ``CHUNK`` rows, so no window
holds a whole source; rows that repeat more often than that are dealt over
several chunks.  The join key (source, block) is unique on the slot side.
What reaches the driver is one Arrow row a source, of some 100 bytes, and tasks get
two numbers a source.  Counts of a shard are drawn in its own tasks: the slots are
halved by shards over and over, the source counts of each left half are drawn by a
generator of that half, and a task goes down to its shard.

Rows are numbered by their place in the input, which is the same whenever a
stored table is read again; ``docs`` has to be one.

Edge cases: null sources form one source, last in order; a null or empty text
has size 0 and is never taken; rows that repeat are rows of their own; ties in
the order of a source go by size; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, saved
from .textcore import mix as mix64
from .textcore import slices, text_bytes, words

#: Sources up to which their table is broadcast.
FEW_SOURCES = 10_000
CHUNK = 128


def targets(sizes: list[int], factor: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), most: float = 2.0) -> list[float]:
    """Shares of ``factor`` times all sizes by repeating weights; a share stops at ``most`` times its size."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    total, fixed = factor * sum(sizes), {}
    while True:
        free = [k for k in range(len(sizes)) if k not in fixed]
        left = total - sum(fixed.values())
        unit = left / sum(weight[k] for k in free) if free else 0.0
        over = [k for k in free if unit * weight[k] > most * sizes[k]]
        if not over:
            return [fixed[k] if k in fixed else unit * weight[k] for k in range(len(sizes))]
        fixed.update((k, most * sizes[k]) for k in over)


@dataclass
class Plan:
    sources: pa.Array
    sizes: list[int]
    docs: np.ndarray
    targets: list[float]
    blocks: np.ndarray
    quotas: np.ndarray
    shards: int
    slots: int


def draw_plan(rows: pa.Table, block_words: int, shards: int, factor: float, weights: tuple[int, ...]) -> Plan:
    """Blocks and quota, in blocks, of each source of (source, size, docs)."""
    sizes = rows.column("size").to_pylist()
    target = targets(sizes, factor, weights)
    blocks = np.array([-(-n // block_words) for n in sizes], dtype=np.int64)
    mean = np.array(sizes, dtype=float) / np.maximum(blocks, 1)
    quotas = np.minimum(np.rint(np.array(target) / np.maximum(mean, 1e-9)).astype(np.int64) * (blocks > 0), 2 * blocks)
    total = int(quotas.sum())
    return Plan(rows.column("source").combine_chunks(), sizes, rows.column("docs").to_numpy(), target, blocks, quotas, max(1, min(shards, total)), total)


def drawn(owed: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Multinomial counts of ``n`` draws by what each source is owed; draws beyond that are drawn again."""
    take = np.zeros_like(owed)
    if n == int(owed.sum()):
        return owed.copy()
    while (left := n - int(take.sum())) > 0:
        rest = owed - take
        take = np.minimum(take + rng.multinomial(left, rest / rest.sum()), owed)
    return take


def shard_counts(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The draws of each source in a shard, and in all shards before it; all shards together draw the quotas."""
    total = int(quotas.sum())
    low, high, owed, before = 0, shards, quotas, np.zeros_like(quotas)
    while high - low > 1:
        middle = (low + high) // 2
        n = total * middle // shards - total * low // shards
        left = drawn(owed, n, np.random.Generator(np.random.PCG64([seed, low, high])))
        if shard < middle:
            owed, high = left, middle
        else:
            before, owed, low = before + left, owed - left, middle
    return owed, before


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(size), at each index: Feistel rounds, walked until the value is in range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix64(right * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def slots(spark, plan: Plan, seed: int, most: int = 1 << 20) -> DataFrame:
    """(shard, slot, sidx, block) of every slot of the mix, in tasks of some ``most`` slots."""
    quotas, blocks, shards, total = plan.quotas, plan.blocks, plan.shards, plan.slots

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            for shard, first, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if known != shard:
                    known, (take, before) = shard, shard_counts(quotas, shards, shard, seed)
                    ends = np.cumsum(take)
                start = total * shard // shards
                for at in range(first, first + n, 1 << 17):
                    slot = np.arange(at, min(at + (1 << 17), first + n))
                    source = np.searchsorted(ends, slot - start, "right")
                    draw = before[source] + slot - start - (ends[source] - take[source])
                    size = blocks[source]
                    key = mix64((source * 4 + draw // size + seed * 1_000_003).astype(np.uint64))
                    block = permuted(draw % size, size, key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(slot), shard, np.int32)), pa.array(slot), pa.array(source.astype(np.int32)), pa.array(block)],
                        names=["shard", "slot", "sidx", "block"],
                    )

    if not total:
        return spark.createDataFrame([], "shard int, slot long, sidx int, block long")
    bound = lambda k: F.expr(f"cast(cast({total} as decimal(38,0)) * ({k}) div {shards} as long)")
    parts = spark.range(0, shards, 1, min(shards, 4096)).select(F.col("id").cast("int").alias("shard"), bound("id").alias("a"), bound("id + 1").alias("z"))
    parts = parts.select("shard", "z", F.explode(F.sequence("a", F.greatest(F.col("a"), F.col("z") - 1), F.lit(most))).alias("first"))
    tasks = max(spark.sparkContext.defaultParallelism, total // most)
    parts = parts.select("shard", "first", F.least(F.lit(most), F.col("z") - F.col("first")).alias("n")).repartition(tasks, "first")
    return parts.mapInArrow(place, "shard int, slot long, sidx int, block long")


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the words of the source before each row, in the order (chunk, doc_id, size, digest of the text, place)."""
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = rows.groupBy("sidx", "chunk").agg(F.sum("size").alias("size")).withColumn("part", F.expr("chunk div 1024"))
    parts = chunks.groupBy("sidx", "part").agg(F.sum("size").alias("size"))
    parts = parts.select("sidx", "part", before(Window.partitionBy("sidx").orderBy("part")).alias("p"))
    chunks = chunks.withColumn("c", before(Window.partitionBy("sidx", "part").orderBy("chunk"))).join(parts, ["sidx", "part"])
    inside = before(Window.partitionBy("sidx", "chunk").orderBy("doc_id", "size", "digest", "rid"))
    return rows.withColumn("inside", inside).join(chunks.select("sidx", "chunk", (F.col("c") + F.col("p")).alias("base")), ["sidx", "chunk"]).withColumn("start", F.col("inside") + F.col("base"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    block_words: int = 32,
    shards: int = 256,
    seed: int = 17,
    factor: float = 1.5,
    weights: tuple[int, ...] = (5, 2, 1),
) -> tuple[DataFrame, DataFrame]:
    """(documents, slots).

    Documents: rid, doc_id, source, size, source_size, target, taken, and runs,
    the taken blocks as (first word in the document, words, times).
    Slots: the blocks of each output shard in its order.
    """
    spark = docs.sparkSession
    rows = saved(
        docs.select(
            F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"),
            F.xxhash64(F.col("text").cast("string")).alias("digest"),
        )
    )
    per_source = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    plan = draw_plan(per_source.orderBy(F.col("source").asc_nulls_last()).toArrow(), block_words, shards, factor, weights)
    columns = [np.arange(len(plan.sizes), dtype=np.int32), plan.sources, plan.sizes, plan.targets, -(-plan.docs // CHUNK)]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.int64()]
    table = spark.createDataFrame(
        pa.table([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["sidx", "name", "source_size", "target", "chunks"])
    )
    rows = rows.join(F.broadcast(table) if len(plan.sources) <= FEW_SOURCES else table, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    # rows that repeat more often than a chunk has rows are dealt by their place
    crowded = rows.groupBy("sidx", "doc_id", "digest").agg(F.count("*").alias("copies")).filter(F.col("copies") > CHUNK)
    crowded = crowded.select(F.col("sidx").alias("c_sidx"), F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest"), "copies")
    same = (F.col("sidx") == F.col("c_sidx")) & F.col("doc_id").eqNullSafe(F.col("c_id")) & F.col("digest").eqNullSafe(F.col("c_digest"))
    rows = rows.join(crowded, same, "left").drop("c_sidx", "c_id", "c_digest")
    turn = F.coalesce(F.pmod("rid", F.ceil(F.col("copies") / CHUNK)), F.lit(0))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "digest", turn), "chunks")).drop("chunks", "copies")
    placed = slots(spark, plan, seed)
    times = placed.groupBy("sidx", "block").agg(F.count("*").alias("times"))
    b = F.lit(block_words)
    pieces = (
        _offsets(rows.filter("size > 0"))
        .select("rid", "sidx", "start", "size", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"))
        .withColumn("first", F.greatest(F.col("block") * b - F.col("start"), F.lit(0)))
        .withColumn("words", F.least((F.col("block") + 1) * b - F.col("start"), F.col("size")) - F.col("first"))
    )
    taken = (
        pieces.join(times.hint("merge"), ["sidx", "block"])  # the planner takes what comes of a few rows of shards for small
        .groupBy("rid")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.collect_list(F.struct("first", "words", "times")).alias("runs"))
    )
    result = rows.join(taken, "rid", "left").select(
        "rid", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "runs"
    )
    return result, placed


def _texts(name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each text by its taken words, by column ``name``; white space inside a run of taken words stays."""
    for batch in slices(batches, "text"):
        at = batch.schema.get_field_index("text")
        raw, offsets = text_bytes(batch.column(at))
        w = words(raw, offsets)
        first = np.searchsorted(w.row, np.arange(batch.num_rows + 1))
        out = []
        for k, runs in enumerate(batch.column(name).to_pylist()):
            parts = []
            for turn in range(1, 1 + max((r["times"] for r in runs), default=0)):
                end = None
                for r in sorted((r for r in runs if r["times"] >= turn), key=lambda r: r["first"]):
                    if end == r["first"]:
                        parts[-1][1] = r["first"] + r["words"]
                    else:
                        parts.append([r["first"], r["first"] + r["words"]])
                    end = r["first"] + r["words"]
            n, base = first[k + 1] - first[k], first[k]
            if parts == [[0, n]]:
                out.append(raw[offsets[k] : offsets[k + 1]].tobytes())
            else:
                out.append(b"\n".join(raw[w.start[base + a] : w.end[base + z - 1]].tobytes() for a, z in parts))
        columns = [pa.array(out, pa.binary()).cast(pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
        keep = [k for k, own in enumerate(batch.schema.names) if own != name]
        yield pa.RecordBatch.from_arrays([columns[k] for k in keep], names=[batch.schema.names[k] for k in keep])


def mixed_texts(docs: DataFrame, **parameters) -> DataFrame:
    """The documents of the mix: the input's columns, each text cut to its taken words, repeats included.

    Documents of which nothing is taken go.
    """
    result, _ = mix(docs, **parameters)
    rid, runs = fresh(docs, "rid"), fresh(docs, "runs")
    taken = result.filter("taken > 0").select(F.col("rid").alias(rid), F.col("runs").alias(runs))
    joined = docs.withColumn(rid, F.monotonically_increasing_id()).join(taken, rid).drop(rid)
    return joined.mapInArrow(partial(_texts, runs), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return mix(read(spark, sf_dir, "documents"))[0].select("doc_id", "size", "source_size", "target", "taken")
