"""Daily files as a stream: each file once, in name order, replacing serial numbers.

The five tables lie in hash buckets of the serial number; a batch rewrites the
buckets that its serial numbers fall into, and its manifest makes the new version
whole.  Beside it stands the ledger of the batch's files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keys import upsert, upsert_children
from ..operators.lineage import settled
from ..operators.registry import last_records, registry_tables
from ..sources.bucketed import Bucketed, listed
from ..sources.readers import zipped_case_files

CHILDREN = ("classes", "statements", "owners", "design_codes")
TABLES = ("trademarks", *CHILDREN)
KEY = "serial_number"
LEDGER = "data_type string, source_file string, path string, status string, records_total long, records_inserted long, records_errored long, loaded_at timestamp, error_message string"


def store(spark: SparkSession, root: str, buckets: int = 256, keep: int = 2) -> Bucketed:
    return Bucketed(spark, root, KEY, buckets, keep)


def read_registry(tables: Bucketed) -> dict[str, DataFrame]:
    """The tables of the last whole version."""
    manifest = tables.manifest()
    return {name: tables.read(name, manifest) for name in TABLES} if manifest else {}


def load_batch(tables: Bucketed, raw: DataFrame, version: int) -> None:
    """Upsert the records of ``raw`` as a version on top of the one before it; only touched buckets are read and written."""
    rows = settled(last_records(raw))  # five tables read it
    base, delta = tables.manifest(version), registry_tables(rows)
    touched = tables.touched(rows)
    new = {}
    for name, df in delta.items():
        old = tables.read(name, base, touched) if base else None
        if old is None:
            new[name] = df
        elif name == "trademarks":
            new[name] = upsert(old, df, [KEY], ["source_file"])
        else:
            new[name] = upsert_children(old, delta["trademarks"], df, KEY)
    tables.commit(version, new, touched, base)


def load_archives(tables: Bucketed, paths: list[str], version: int, data_type: str = "trademark") -> DataFrame:
    """Load archives as one version; returns its ledger, one row for each file.

    One scan of the archives gives the tables and the ledger.  A broken archive is ``failed``, with the message, and none
    of its records are taken; a record without a serial number counts as an error of its file.
    """
    spark = tables.spark
    seen = Observation("archives")
    ok = F.trim("`serial-number`").try_cast("long").isNotNull()
    rows = zipped_case_files(spark, paths).withColumn("ok", ok)
    rows = settled(rows.observe(seen, F.count_if(F.col("error").isNull()).alias("total"), F.count_if(F.col("error").isNotNull()).alias("failed")))
    names = spark.createDataFrame([(p.rsplit("/", 1)[-1], p) for p in paths], "source_file string, path string").dropDuplicates(["source_file"])
    record = F.col("error").isNull()
    counts = rows.groupBy("source_file").agg(
        F.count_if(record).alias("total"), F.count_if(record & F.col("ok")).alias("good"), F.max("error").alias("error_message")
    )
    failed = F.col("error_message").isNotNull()
    total = F.coalesce("total", F.lit(0))
    good = F.when(failed, 0).otherwise(F.coalesce("good", F.lit(0)))
    ledger = names.join(counts, "source_file", "left").select(
        F.lit(data_type).alias("data_type"), "source_file", "path", F.when(failed, "failed").otherwise("completed").alias("status"),
        total.alias("records_total"), good.alias("records_inserted"), (total - good).alias("records_errored"),
        F.current_timestamp().alias("loaded_at"), "error_message",
    )
    whole = rows.drop("ok", "error")
    if seen.get["failed"]:
        whole = whole.join(rows.filter("error IS NOT NULL").select("source_file").distinct(), "source_file", "left_anti").select(*whole.columns)
    path = f"{tables.root}/ledger/v{version:06d}"
    ledger.write.mode("overwrite").parquet(path)
    load_batch(tables, whole, version)
    return spark.read.schema(LEDGER).parquet(path)


def read_ledger(tables: Bucketed) -> DataFrame:
    """All ledger rows of whole versions, with their version; the last row of a file tells its state."""
    last = max(tables.versions(), default=-1)
    folder = f"{tables.root}/ledger"
    paths = [f"{folder}/{n}" for n in listed(tables.spark, folder) if int(n[1:]) <= last]
    if not paths:
        return tables.spark.createDataFrame([], f"{LEDGER}, version long")
    rows = tables.spark.read.schema(LEDGER).parquet(*paths)
    version = F.regexp_extract(F.col("_metadata.file_path"), r"/v(\d+)/[^/]*$", 1).cast("long")
    return rows.select("*", version.alias("version"))


def failed_files(tables: Bucketed) -> list[str]:
    """Paths of the files whose last load failed."""
    last = read_ledger(tables).groupBy("source_file").agg(F.max_by(F.struct("path", "status"), "version").alias("r"))
    return sorted(r[0] for r in last.filter("r.status = 'failed'").select("r.path").collect())


def ingest_daily(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    versions: str,
    done: Callable[[dict[str, DataFrame]], None] | None = None,
    buckets: int = 256,
    retry: bool = True,
) -> StreamingQuery:
    """Take in all new archives of ``folder``; with ``retry`` also those that failed before, once there is a new one.

    ``versions`` is the root of the tables; ``done`` gets them after each batch, and the batch's ``ledger``.  The stream's checkpoint tells which files are new; a batch that was cut off is loaded again as the same version, on
    the version before it.
    """

    tables = store(spark, versions, buckets)

    def take(batch: DataFrame, number: int) -> None:
        paths = [r[0] for r in batch.select("path").collect()]  # the names of a batch's files
        again = [p for p in failed_files(tables) if p not in paths] if retry else []
        ledger = load_archives(tables, sorted(paths + again), number)
        if done:
            done({**read_registry(tables), "ledger": ledger})

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return files.select("path").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
