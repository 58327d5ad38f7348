"""Cosine top-k over embedding vectors.

Images are dealt over parts and stay there; blocks of queries go to every part.
A part compares a block with its images by one matrix product a batch, keeps the
k best of each query, and passes on only these, so what is merged at the end has k
rows for each part and query, however many images a part has.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
PART = 65_536
BATCH = 8192
#: A matrix product adds up in an order of its own; what comes this near to the k-th is added up again in the order of the vector.
MARGIN = 1e-9


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of products along the rows, added up from the first component to the last."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total = total + a[:, k] * b[:, k]
    return total


def _best(k: int, images: pa.Table, queries: pa.Table) -> pa.Table:
    """The k best images of a part for each query of a block; all vectors have one length."""
    names = ["query_id", "image_id", "similarity"]
    kinds = [queries.schema.field("image_id").type, images.schema.field("image_id").type, pa.float64()]
    if not images.num_rows or not queries.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names=names)
    size = queries.column("size")[0].as_py()
    q, q_id = _matrix(queries.column("embedding"), size), queries.column("image_id").to_numpy(zero_copy_only=False)
    x, x_id = _matrix(images.column("embedding"), size), images.column("image_id").to_numpy(zero_copy_only=False)
    q_norm, x_norm = np.sqrt(_in_order(q, q)), np.sqrt(_in_order(x, x))
    at_q, at_x, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for start in range(0, len(x), BATCH):
        some = x[start : start + BATCH]
        rough = (q @ some.T) / q_norm[:, None] / x_norm[start : start + BATCH]
        rough[q_id[:, None] == x_id[start : start + BATCH]] = -np.inf
        if rough.shape[1] > k:
            bound = -np.partition(-rough, k - 1, axis=1)[:, k - 1] - MARGIN
            row, column = np.nonzero(rough >= np.maximum(bound, -2.0)[:, None])
        else:
            row, column = np.nonzero(rough > -2.0)
        column = column + start
        exact = _in_order(q[row], x[column]) / (x_norm[column] * q_norm[row])
        at_q, at_x, best = np.append(at_q, row), np.append(at_x, column), np.append(best, exact)
        order = np.lexsort((x_id[at_x], -best, at_q))
        at_q, at_x, best = at_q[order], at_x[order], best[order]
        keep = np.arange(len(at_q)) - np.searchsorted(at_q, at_q) < k
        at_q, at_x, best = at_q[keep], at_x[keep], best[keep]
    return pa.table([pa.array(q_id[at_q], kinds[0]), pa.array(x_id[at_x], kinds[1]), pa.array(best)], names=names)


def similar_images(queries: DataFrame, images: DataFrame, k: int = 5, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(query_id, image_id, similarity): the k most similar other images of each query, ties by id.

    Only vectors of one length meet.  Null and zero vectors, and those that hold null or no finite numbers, are similar
    to nothing.  Ids are numbers; a query_id that repeats is one query.
    """
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    fit = F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda v: v != 0)
    of = lambda df: df.select(F.col("image_id").alias("image_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("size")).filter(fit)
    q, x = of(queries).dropDuplicates(["image_id"]), of(images)
    count = {r["size"]: r["n"] for r in q.groupBy("size").agg(F.count("*").alias("n")).collect()}  # a row for each length
    held = {r["size"]: r["n"] for r in x.groupBy("size").agg(F.count("*").alias("n")).collect()}
    plan = [(s, -(-n // block), -(-held[s] // part)) for s, n in count.items() if s in held]
    sizes = queries.sparkSession.createDataFrame(plan, "size int, blocks long, parts long")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = F.pmod(F.xxhash64("image_id"), F.col("parts"))
    x = x.join(F.broadcast(sizes), "size").select("size", "image_id", "embedding", dealt.alias("part"), spread("blocks").alias("block"))
    q = q.join(F.broadcast(sizes), "size").select("size", "image_id", "embedding", F.pmod(F.xxhash64("image_id"), "blocks").alias("block"), spread("parts").alias("part"))
    id_type = images.schema["image_id"].dataType.simpleString()
    keys = ["size", "part", "block"]
    columns = f"query_id {queries.schema['image_id'].dataType.simpleString()}, image_id {id_type}, similarity double"
    found = x.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(partial(_best, k), columns)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "image_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
