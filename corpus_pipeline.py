"""Corpus pipeline: five stages over documents, each written as Parquet and read again.

Language ID, line deduplication, near-copy removal, mixing to target weights,
packing.  Every stage takes the whole result of the one before it; all but the
last return the columns of documents.  A tokenizer and random draws are not
SQL, so ORACLE_SQL is None; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandspark.llm import language_id, line_dedup, mixing, ngram_join, packing
from brandspark.llm.common import WORD, fresh


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, by text, declared language and source; lang becomes what was found.

    Null and empty texts have no letters and go, as do very short ones without any; texts of any length are read
    whole.  Rows equal in doc_id and text are judged alike and all stay or go; of equal posteriors the first
    language by name wins.  An empty table gives an empty result; other columns stay, whatever their names.
    """
    model = language_id.fit(docs)
    row, found = fresh(docs, "row"), fresh(docs, "found")
    numbered = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    known = language_id.accepted(language_id.identify(numbered, model, row, "text", declared_col="lang", host_col="source"))
    known = known.groupBy(F.col("id").alias(row)).agg(F.min("lang").alias(found))
    return numbered.join(known, row).withColumn("lang", F.col(found)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _counted(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars (where there is one) of the present texts."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each line kept where it stands first, short lines too where they are equal; documents without a word left go.

    Null and empty texts lose no line and stay.  Of equal lines that of the least (doc_id, line) stays, rows equal in
    doc_id and text keep the same lines.  Texts and lines may have any length; an empty table gives an empty result;
    other columns stay (one named ``__removed`` gives way and comes back).
    """
    own = fresh(docs, "own")
    clash = [c for c in docs.columns if c.lower() == "__removed"]
    for c in clash:
        docs = docs.withColumnRenamed(c, own)
    kept = line_dedup.line_dedup(docs, exact_chars=1).filter((F.col("__removed") == 0) | F.col("text").rlike(WORD)).drop("__removed")
    kept = _counted(kept, docs)
    for c in clash:
        kept = kept.withColumnRenamed(own, c)
    return kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id (null last), of each group of near copies.

    Near copies share 0.8 of their five-word shingles or more.  Rows are told apart by doc_id and text: two texts of
    one doc_id are two documents, and of rows equal in both one stays.  Null, empty and wordless texts are copies of
    nothing and stay.  Texts may have any length; an empty table gives an empty result; other columns stay.
    """
    return ngram_join.without_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's words that the mix takes, repeats included.

    Null, empty and wordless texts have nothing to take and go, as do documents that no block takes from.  Rows that
    repeat are rows of their own; a null source is one source, last in order.  Texts may have any length; an empty
    table gives an empty result; other columns stay.
    """
    return _counted(mixing.mixed_texts(docs), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with the digest of their ids.

    A null or empty text is its end token; rows that repeat are packed each; texts of any length are cut into pieces;
    an empty table gives an empty result; other columns are left out.
    """
    return packing.digest(packing.pack(docs, *packing.default_tokenizer()))


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("mixture", mixture), ("packed", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brandspark.llm.common import stored

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
