"""Language identification by Bayesian evidence fusion.

The posterior of a language for a document multiplies
  * a text likelihood: byte trigrams of the visible text, naive Bayes;
  * how often each declared markup language stands on pages of that language;
  * the same for the address suffix (country code) and the leading path code;
  * a host prior, smoothed over host -> site -> whole table, without the
    document's own share.
The tables behind the last three come from grouped aggregations of the text
posteriors over all rows, so a lying declaration loses its weight by itself.

The trigram model alone is fitted on a bounded sample: ``per_language`` labelled
documents of each language.  Labels are language codes of two or three letters,
what follows a sign (as in ``en-GB``) is ignored, and other labels are none; so the
classes are bounded by the form, and the model has 128 KB for each that occurs.  One
more class, ``und``, spreads its likelihood evenly over all trigrams.

Plan: one vectorised scan, checkpointed narrow; map-side-combined sums by
declared code, suffix, path code (each at most a few thousand keys by their
form), by host and by site; one join of rows with host priors, which adaptive
execution may split.  Only the bounded tables reach the driver.

Edge cases: null or empty text gives no text evidence and the prior decides;
null or odd addresses and declarations count as ``none``; repeated rows are
judged alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, saved
from .textcore import LOWER, slices, text_bytes

BUCKETS = 1 << 15
OTHER = "und"
#: Labels that name a language.
LABEL = r"^\s*([A-Za-z]{2,3})(?:\s*$|[-_])"

#: Digits, signs and white space count as one space.
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LOWER[[*range(65, 91), *range(97, 123), *range(128, 256)]]
_OPEN = re.compile(r"(?i)<script\b|<style\b|<!--|<|&#?\w+;")
_ENTITY = re.compile(r"&#?\w+;")
_CLOSE = {"<script": re.compile(r"(?i)</script\s*>"), "<style": re.compile(r"(?i)</style\s*>"), "<!--": re.compile("-->"), "<": re.compile(">")}
_HTML = re.compile(r"(?i)<html\b[^>]*")
_LANG = re.compile(r"""(?i)\blang\s*=\s*(?:["']\s*)?([a-z]{2,3})\b""")


def declared_language(page: str) -> str | None:
    """The language of the first html tag that declares one; each tag is read once, so time is linear."""
    found = (_LANG.search(m[0], 5) for m in _HTML.finditer(page))
    return next((m[1].lower() for m in found if m), None)


def visible_text(page: str) -> str:
    """The page with scripts, styles, comments, tags and entities as spaces; what is never closed is searched for once."""
    out, at, unclosed = [], 0, set()
    while m := _OPEN.search(page, at):
        end = m.end() if page[m.start()] == "&" else None
        for kind in (m[0].lower(), "<"):
            if end is None and kind not in unclosed:
                close = _CLOSE[kind].search(page, m.end())
                if close:
                    end = close.end()
                else:
                    unclosed.add(kind)
        out.append(page[at : m.start()])
        if end is None:  # no tag ends from here on
            return "".join(out) + _ENTITY.sub(" ", page[m.start() :])
        out.append(" ")
        at = end
    return "".join(out) + page[at:]


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # bucket x language, the last column is OTHER


def _trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the trigrams with a letter in the middle or at two ends."""
    c = _FOLD[raw]
    n = len(c) - 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket = ((c[:n] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA6B)) ^ (c[2:] * np.uint32(0xC2B2AE35))).astype(np.uint32)
    bucket = (bucket ^ (bucket >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    bucket = bucket >> np.uint32(17)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    use = (c[1:-1] != 32) & (row[:n] == row[2:])
    return row[:n][use], bucket[use].astype(np.int64)


def fit(labelled: DataFrame, per_language: int = 400) -> Model:
    """Trigram model from ``labelled`` (doc_id, text, lang), on at most ``per_language`` documents of each language."""
    usable = labelled.filter("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.lower(F.regexp_extract("lang", LABEL, 1)).alias("lang"))
    usable = usable.filter("lang <> ''")
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    code = {name: k for k, name in enumerate(languages)}
    chosen = usable
    for part in (F.pmod(F.xxhash64("doc_id"), F.lit(64)), F.lit(0)):  # of parts of a language first, so that no task sees a whole one
        order = Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("part", part).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language).drop("part", "place")
    spark = labelled.sparkSession
    keys = spark.createDataFrame([(r["doc_id"], code[r["lang"]]) for r in chosen.select("doc_id", "lang").collect()], "doc_id long, code int")
    texts = labelled.select("doc_id", "text").join(F.broadcast(keys), "doc_id").select("code", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * BUCKETS, dtype=np.int64)
        for batch in slices(batches, "text"):
            row, bucket = _trigrams(*text_bytes(batch.column(1)))
            total += np.bincount(batch.column(0).to_numpy()[row] * BUCKETS + bucket, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    counts = np.zeros((max(1, len(languages)), BUCKETS))
    found = texts.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts.ravel()[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    counts = counts[: len(languages)] + 0.05
    likelihood = np.log(counts / counts.sum(1, keepdims=True)) if len(languages) else np.zeros((0, BUCKETS))
    other = np.full((1, BUCKETS), -np.log(BUCKETS))
    return Model(languages, np.concatenate([likelihood, other]).T.astype(np.float32).copy())


def _score(model: Model, html: bool, most: float):
    """(id, declared, address parts, text posterior) of rows; a text counts as ``most`` trigrams at most."""
    table = model.log_likelihood
    classes = table.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, declared = batch.column(1), batch.column(2)
            if html:
                pages = [x or "" for x in text.to_pylist()]
                declared = pa.array([declared_language(x) for x in pages], pa.string())
                text = pa.array([visible_text(x) for x in pages], pa.string())
            raw, offsets = text_bytes(text)
            row, bucket = _trigrams(raw, offsets)
            n = np.bincount(row, minlength=batch.num_rows)
            total = np.zeros((batch.num_rows, classes))
            full = np.flatnonzero(n)
            if len(row):
                total[full] = np.add.reduceat(table[bucket], (np.cumsum(n) - n)[full], axis=0)
            evidence = total * np.minimum(1.0, most / np.maximum(n, 1))[:, None]
            p = np.exp(evidence - evidence.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), declared, *batch.columns[3:], pa.array(n), pa.array(list(p), pa.list_(pa.float64()))],
                names=["id", "declared", "host", "suffix", "path", "n", "p"],
            )

    return run


def address_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, country suffix (or generic, none), leading path code (or none)."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    last = F.regexp_extract(host, r"\.([a-z]{2,})$", 1)
    suffix = F.when(last == "", "none").when(F.length(last) == 2, last).otherwise("generic")
    code = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/]*//[^/]*/([A-Za-z]{2})(?:[/?#_-]|$)", 1))
    return host, suffix, F.when(code == "", "none").otherwise(code)


def _site(host: Column) -> Column:
    """The last two labels of a host."""
    return F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)


def identify(
    rows: DataFrame,
    model: Model,
    id_col: str,
    text_col: str,
    html: bool = False,
    declared_col: str | None = None,
    url_col: str | None = None,
    host_col: str | None = None,
    most: float = 40.0,
    strength: float = 5.0,
) -> DataFrame:
    """(id, lang, posterior, text_lang, declared, host, n_trigrams) of every row.

    ``strength`` is the weight, in documents, of each level of the host prior
    under the level above it.
    """
    names = [*model.languages, OTHER]
    none = F.lit(None).cast("string")
    host, suffix, path = address_parts(F.col(url_col)) if url_col else (F.coalesce(F.col(host_col).cast("string"), F.lit("")) if host_col else F.lit(""), F.lit("none"), F.lit("none"))
    declared = F.lower(F.regexp_extract(F.col(declared_col).cast("string"), r"^\s*([A-Za-z]{2,3})\b", 1)) if declared_col else none
    narrow = rows.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), declared.alias("declared"), host.alias("host"), suffix.alias("suffix"), path.alias("path")
    )
    kind = narrow.schema["id"].dataType.simpleString()
    scored = saved(
        narrow.mapInArrow(_score(model, html, most), f"id {kind}, declared string, host string, suffix string, path string, n long, p array<double>")
    )
    p = [F.col("p")[k] for k in range(len(names))]
    sums = [F.sum(c).alias(f"s{k}") for k, c in enumerate(p)]
    known = F.when(F.coalesce("declared", F.lit("")) == "", "none").otherwise(F.col("declared"))
    tables = {}
    for key, column in (("declared", known), ("suffix", F.col("suffix")), ("path", F.col("path"))):
        got = scored.groupBy(column.alias("key")).agg(*sums).collect()
        tables[key] = {r["key"]: np.array([r[f"s{k}"] for k in range(len(names))]) for r in got}
    whole = sum(tables["declared"].values(), np.zeros(len(names)))
    base = (whole + 0.5) / (whole.sum() + 0.5 * len(names))
    factors = []
    for key, table in tables.items():
        for value, s in table.items():
            given = np.log((s + 0.5) / (whole + 0.5 * len(table)))
            factors.append((key, value, (given - given.max()).tolist()))
    spark = rows.sparkSession
    evidence = spark.createDataFrame(factors, "kind string, value string, e array<double>")

    by_host = scored.groupBy("host").agg(*sums).withColumn("site", _site(F.col("host")))
    by_site = by_host.groupBy("site").agg(*[F.sum(f"s{k}").alias(f"t{k}") for k in range(len(names))])
    hosts = by_host.join(by_site, "site").select(
        F.col("host").alias("h"),
        F.array(*[F.col(f"s{k}") for k in range(len(names))]).alias("hs"),
        F.array(*[F.col(f"t{k}") for k in range(len(names))]).alias("ts"),
    )
    joined = scored.withColumn("declared", known).join(hosts, F.col("host") == F.col("h"))
    for key in tables:
        part = evidence.filter(F.col("kind") == key).select(F.col("value").alias(f"v_{key}"), F.col("e").alias(f"e_{key}"))
        joined = joined.join(F.broadcast(part), F.col(key) == F.col(f"v_{key}"))
    score = []
    c = F.lit(float(strength))
    rest = lambda name: F.greatest(F.aggregate(name, F.lit(0.0), lambda a, x: a + x) - 1.0, F.lit(0.0))
    joined = joined.withColumn("hn", rest("hs")).withColumn("tn", rest("ts"))
    for k in range(len(names)):
        own = F.col("p")[k]
        site = (F.greatest(F.col("ts")[k] - own, F.lit(0.0)) + c * float(base[k])) / (F.col("tn") + c)
        prior = (F.greatest(F.col("hs")[k] - own, F.lit(0.0)) + c * site) / (F.col("hn") + c)
        text = F.log(F.greatest(own, F.lit(1e-300)))
        score.append(F.log(prior) + text + F.col("e_declared")[k] + F.col("e_suffix")[k] + F.col("e_path")[k])
    joined = joined.withColumn("score", F.array(*score))
    top = F.array_max("score")
    total = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    labels = F.array(*[F.lit(x) for x in names])
    return joined.select(
        "id",
        F.element_at(labels, F.array_position("score", top).cast("int")).alias("lang"),
        (1 / total).alias("posterior"),
        F.when(F.col("n") > 0, F.element_at(labels, F.array_position("p", F.array_max("p")).cast("int"))).alias("text_lang"),
        F.col("declared").alias("declared_lang"),
        "host",
        F.col("n").alias("n_trigrams"),
    )


def accepted(result: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose language is known: text with letters, no ``und``, and a posterior of ``least`` or more."""
    return result.filter((F.col("n_trigrams") > 0) & (F.col("lang") != OTHER) & (F.col("posterior") >= least))


def query(spark, sf_dir: str) -> DataFrame:
    """All pages, with the trigram model fitted on labelled documents."""
    model = fit(read(spark, sf_dir, "documents"))
    result = identify(read(spark, sf_dir, "pages"), model, "page_id", "html", html=True, url_col="url")
    return result.withColumnRenamed("id", "page_id")
