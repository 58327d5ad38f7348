"""Matching of plaintiff names to owners and of brands to marks.

Names are never compared pairwise: every accepted pair shares a token or a
trigram, so an equi-join on those yields all of them, and each candidate is then
verified exactly.  Frequent tokens are left out where the rest must meet anyway.
Matching runs on distinct names and is fanned out to serial numbers at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import inner_grams, jaccard, match_score, meaningful_tokens, pattern_words, token_score, trigrams, word_boundary_pattern
from ..functions.text import clean_name, flip_person_name, has_letter, two_word_like, words
from .keys import cap_per_key
from .lineage import settled

LEAST_SCORE = 0.3
CAP = 100
ROW = ("serial_number", "mark_identification", "owner_name", "status_code", "live_dead")


def live_marks(trademarks: DataFrame, owners: DataFrame, status: DataFrame) -> DataFrame:
    """Distinct live marks with their owners; the status dimension is small and fixed."""
    live = F.broadcast(status.filter("live_dead = 'LIVE'").select("status_code", "live_dead"))
    marks = trademarks.select("serial_number", "mark_identification", "status_code").join(live, "status_code")
    return marks.join(owners.select("serial_number", F.col("party_name").alias("owner_name")), "serial_number").select(*ROW).distinct()


def _rarest(rows: DataFrame, key: str, item: str, counts: DataFrame, keep: Column) -> DataFrame:
    """Of each key's items the ``keep`` rarest by ``counts``; items that the other side lacks count as rarest."""
    w = Window.partitionBy(key).orderBy(F.coalesce("__n", F.lit(0)), item)
    return rows.join(counts, item, "left").withColumn("__place", F.row_number().over(w)).filter(F.col("__place") <= keep).drop("__n", "__place")


def token_candidates(names: DataFrame, owners: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(name, owner_name, score) of all pairs with a token score of ``least`` or more.

    A name of n tokens must share k of them, so it meets the owner on its n - k + 1 rarest ones.
    """
    q = names.select("name", meaningful_tokens(F.col("name")).alias("q"))
    o = owners.select("owner_name", meaningful_tokens(F.col("owner_name")).alias("o"))
    postings = o.select("owner_name", F.explode("o").alias("token"))
    counts = postings.groupBy("token").agg(F.count("*").alias("__n"))
    n = F.size("q")
    rows = q.select("name", (n - F.ceil(n * F.lit(least) - 1e-9) + 1).alias("keep"), F.explode("q").alias("token"))
    pairs = _rarest(rows, "name", "token", counts, F.col("keep")).join(postings, "token").select("name", "owner_name").distinct()
    scored = pairs.join(q, "name").join(o, "owner_name").withColumn("score", token_score(F.col("q"), F.col("o")))
    return scored.filter(F.col("score") >= least).select("name", "owner_name", "score")


def _rarest_in_common(asked: DataFrame, held: DataFrame) -> DataFrame:
    """(key, text) of all texts that hold the rarest gram of a key; a key with a gram that no text holds meets none."""
    held = held.join(asked.select("g").distinct(), "g", "left_semi")
    counts = held.groupBy("g").agg(F.count("*").alias("__n"))
    return _rarest(asked, "key", "g", counts, F.lit(1)).join(held, "g").select("key", "text")


def _candidates(patterns: DataFrame, texts: DataFrame, pieces: Column) -> DataFrame:
    """(key, text): of each pattern the texts that hold its rarest gram; all that match it are among them.

    A text that matches has every piece, and so all grams of it.  Patterns meet texts on trigrams; those whose longest
    piece is shorter meet them on pairs or single characters, of which texts are only taken apart if there are such patterns.
    """
    patterns = patterns.withColumn("__longest", F.array_max(F.transform(pieces, F.length)))
    widths = [r[0] for r in patterns.select(F.least(F.col("__longest"), F.lit(3)).alias("w")).filter("w > 0").distinct().collect()]  # three at most
    out = None
    for width in sorted(widths):
        some = patterns.filter(F.least(F.col("__longest"), F.lit(3)) == width)
        asked = some.select("key", F.explode(F.array_distinct(F.flatten(F.transform(pieces, lambda p: inner_grams(p, width))))).alias("g"))  # noqa: B023
        met = _rarest_in_common(asked, texts.select("text", F.explode(inner_grams(F.col("text"), width)).alias("g")))
        out = met if out is None else out.unionByName(met)
    return patterns.sparkSession.createDataFrame([], "key string, text string") if out is None else out.distinct()


def contains_candidates(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text) of all texts that contain every piece of a pattern (key, pieces) behind the one before it, any case."""
    pairs = _candidates(patterns, texts, F.col("pieces")).join(patterns, "key")
    # each piece is looked for behind the first place of the one before it
    rest = F.aggregate(
        "pieces",
        F.lower("text"),
        lambda rest, p: F.when(rest.contains(F.lower(p)), F.substring(rest, F.position(F.lower(p), rest) + F.length(p), F.length(rest))),
    )
    return pairs.filter(rest.isNotNull()).select("key", "text")


def like_candidates(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text) of all texts that match a LIKE pattern (key, pattern), any case.

    ``%`` stands for any characters, ``_`` for one, a backslash takes the next character as it is.  A pattern without any
    other character would match every long enough text, and matches none here.
    """
    whole = F.regexp_replace(F.regexp_replace("pattern", r"\\([^%_\\])", "$1"), r"(?<!\\)((?:\\\\)*)\\$", "$1")
    asked = patterns.select("key", whole.alias("pattern"))
    pieces = F.filter(F.split("pattern", r"\\.|[%_]"), lambda p: p != "")
    asked = asked.withColumn("__pieces", pieces)
    pairs = _candidates(asked, texts, F.col("__pieces")).join(asked, "key")
    return pairs.filter(F.expr("text ILIKE pattern")).select("key", "text")


ORDER = ("owner_name", "serial_number", "mark_identification", "status_code")


def _match_likes(names: DataFrame, marks: DataFrame, column: str, cap: int | None) -> DataFrame:
    """The older mode of both paths: exact: the text is like the name; else fuzzy: like its first two words; no score.

    Names go into the patterns as they are, so ``%`` and ``_`` in them act as wildcards.
    """
    texts = marks.select(F.col(column).alias("text")).filter("text IS NOT NULL").distinct()
    like = lambda some, pattern: like_candidates(some.select(F.col("name").alias("key"), pattern.alias("pattern")), texts)
    found = lambda pairs, kind: pairs.select(F.col("key").alias("name"), F.col("text").alias(column), F.lit(kind).alias("match_type"))
    exact = settled(found(like(names, F.concat(F.lit("%"), "name", F.lit("%"))), "exact"))
    left = names.join(exact.select("name").distinct(), "name", "left_anti").filter(F.size(words(F.col("name"))) >= 2)
    fuzzy = found(like(left, two_word_like(F.col("name"), "v1")), "fuzzy").join(marks, column)
    some = cap_per_key(fuzzy.select("name", "match_type", *ROW).distinct(), ["name"], [F.col(c).asc_nulls_last() for c in ORDER], cap)
    return _with_misses(names, exact.join(marks, column), some)


def _names(rows: DataFrame) -> DataFrame:
    """The distinct names, settled: else Spark works out patterns and words for each row, before it makes names distinct."""
    return settled(rows.select("name").filter("name <> ''").distinct())


def _owner_pairs(names: DataFrame, owners: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(name, owner_name, score, match_type) of path A: exact, and fuzzy for names without an exact owner."""
    # both ways the owner holds the pattern's words in their order; names without such words meet owners on their tokens
    asked = names.select("name", pattern_words(F.col("name")).alias("pieces"))
    wordy = contains_candidates(asked.filter(F.size("pieces") > 0).withColumnRenamed("name", "key"), owners.withColumnRenamed("owner_name", "text"))
    score = match_score(F.col("name"), F.col("owner_name"))
    pairs = wordy.select(F.col("key").alias("name"), F.col("text").alias("owner_name")).withColumn("score", score).filter(F.col("score") >= least)
    pairs = settled(pairs.unionByName(token_candidates(asked.filter(F.size("pieces") == 0).select("name"), owners, least)))
    exact = pairs.filter(F.lower("owner_name").contains(F.lower("name"))).withColumn("match_type", F.lit("exact"))
    left = pairs.join(exact.select("name").distinct(), "name", "left_anti")
    fuzzy = left.withColumn("pattern", word_boundary_pattern(F.col("name"))).filter(F.expr("owner_name RLIKE pattern")).drop("pattern")
    return exact, fuzzy.withColumn("match_type", F.lit("fuzzy"))


def match_owners(names: DataFrame, marks: DataFrame, cap: int | None = CAP, least: float = LEAST_SCORE, mode: str = "v2") -> DataFrame:
    """Path A: (name) -> rows of ROW with match_type; exact: the owner contains the name; else fuzzy: its words; else miss."""
    names = _names(names)
    if mode == "v1":
        return _match_likes(names, marks, "owner_name", cap)
    exact, fuzzy = _owner_pairs(names, marks.select("owner_name").filter("owner_name IS NOT NULL").distinct(), least)
    rows = lambda found: found.join(marks, "owner_name")
    order = [F.col("score").desc(), *[F.col(c).asc_nulls_last() for c in ORDER]]
    return _with_misses(names, rows(exact), cap_per_key(rows(fuzzy), ["name"], order, cap))


def _mark_pairs(names: DataFrame, texts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(name, mark_identification, score, match_type) of path B: exact, and fuzzy for names without an exact mark."""
    asked = names.filter(has_letter(F.col("name")))
    equal = asked.join(texts, F.upper("name") == F.upper("mark_identification")).withColumn("score", F.lit(1.0))
    left = asked.join(equal.select("name").distinct(), "name", "left_anti")
    w = words(F.col("name"))
    pieces = F.when(F.size(w) >= 2, F.slice(w, 1, 2)).when(F.length(w[0]) >= 3, F.slice(w, 1, 1))
    patterns = left.select(F.col("name").alias("key"), pieces.alias("pieces")).filter("pieces IS NOT NULL")
    pairs = contains_candidates(patterns, texts.withColumnRenamed("mark_identification", "text"))
    pairs = pairs.select(F.col("key").alias("name"), F.col("text").alias("mark_identification"))
    score = token_score(meaningful_tokens(F.col("name")), meaningful_tokens(F.col("mark_identification")))
    a, b = F.upper("name"), F.upper("mark_identification")
    fuzzy = pairs.withColumn("score", score).filter(b.contains(a) | a.contains(b) | (score >= least))
    return equal.withColumn("match_type", F.lit("exact")), fuzzy.withColumn("match_type", F.lit("fuzzy"))


def match_marks(brands: DataFrame, marks: DataFrame, cap: int | None = CAP, least: float = 0.5, mode: str = "v2") -> DataFrame:
    """Path B: exact: the mark equals the brand; else fuzzy: the brand's first two words in the mark, and one contains the other or the score is enough."""
    names = _names(brands)
    if mode == "v1":
        return _match_likes(names, marks, "mark_identification", cap)
    exact, fuzzy = _mark_pairs(names, marks.select("mark_identification").filter("mark_identification IS NOT NULL").distinct(), least)
    rows = lambda found: found.join(marks, "mark_identification")
    order = [F.col("score").desc(), *[F.col(c).asc_nulls_last() for c in ORDER]]
    return _with_misses(names, rows(exact), cap_per_key(rows(fuzzy), ["name"], order, cap))


def mark_holders(marks: DataFrame) -> DataFrame:
    """(mark_identification, owner_name, n): how many live marks each owner has of each text."""
    return marks.groupBy("mark_identification", "owner_name").agg(F.count("*").alias("n"))


def _holders_within(found: DataFrame, cap: int | None) -> DataFrame:
    """(name, match_type, owner_name) of the rows that ``cap_per_key`` would leave, where each row of ``found`` stands for n of them.

    An owner's rows of one score follow each other, so the owner stays if fewer than ``cap`` rows come before them.
    """
    rows = found.groupBy("name", "match_type", "score", "owner_name").agg(F.sum("n").alias("n"))
    if cap is not None:
        before = Window.partitionBy("name").orderBy(F.col("score").desc(), F.col("owner_name").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("__before") < cap)
    return rows.select("name", "match_type", "owner_name")


def match_owner_names(names: DataFrame, holders: DataFrame, cap: int | None = CAP, least: float = LEAST_SCORE) -> DataFrame:
    """(name, match_type, owner_name): the distinct owners of ``match_owners``, from ``mark_holders`` and so without a row for each mark."""
    names = _names(names)
    held = holders.filter("owner_name IS NOT NULL").groupBy("owner_name").agg(F.sum("n").alias("n"))
    exact, fuzzy = _owner_pairs(names, held.select("owner_name"), least)
    return _with_misses(names, exact, _holders_within(fuzzy.join(held, "owner_name"), cap), ("owner_name",))


def match_mark_owners(brands: DataFrame, holders: DataFrame, cap: int | None = CAP, least: float = 0.5) -> DataFrame:
    """(name, match_type, owner_name): the distinct owners of ``match_marks``, from ``mark_holders`` and so without a row for each mark."""
    names = _names(brands)
    exact, fuzzy = _mark_pairs(names, holders.select("mark_identification").filter("mark_identification IS NOT NULL").distinct(), least)
    rows = lambda found: found.join(holders, "mark_identification")
    return _with_misses(names, rows(exact), _holders_within(rows(fuzzy), cap), ("owner_name",))


def _with_misses(names: DataFrame, exact: DataFrame, fuzzy: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    found = exact.select("name", "match_type", *row).unionByName(fuzzy.select("name", "match_type", *row)).distinct()
    return names.join(found, "name", "left").withColumn("match_type", F.coalesce("match_type", F.lit("miss")))


def match_path_summary(results: DataFrame) -> DataFrame:
    return results.select("name", "match_type").distinct().groupBy("match_type").agg(F.count("*").alias("names"))


def similar_names(queries: DataFrame, names: DataFrame, least: float = 0.3, top: int | None = 5) -> DataFrame:
    """(query, name, sim): trigram similarity of ``least`` or more, the best ``top`` of each query.

    Prefix filter: sets of sizes a and b that are similar share one of the a - ceil(least * a) + 1 rarest of either.
    """
    q = queries.select("query").distinct().withColumn("tq", trigrams(F.col("query")))
    n = names.select("name").distinct().withColumn("tn", trigrams(F.col("name")))
    counts = n.select(F.explode("tn").alias("g")).groupBy("g").agg(F.count("*").alias("__n"))
    prefix = lambda df, key, t: _rarest(
        df.select(key, (F.size(t) - F.ceil(F.size(t) * F.lit(least) - 1e-9) + 1).alias("keep"), F.explode(t).alias("g")), key, "g", counts, F.col("keep")
    )
    pairs = prefix(q, "query", "tq").join(prefix(n, "name", "tn").select("name", "g"), "g").select("query", "name").distinct()
    pairs = pairs.join(q, "query").join(n, "name").withColumn("sim", jaccard(F.col("tq"), F.col("tn"))).filter(F.col("sim") >= least)
    return cap_per_key(pairs.select("query", "name", "sim"), ["query"], [F.col("sim").desc(), F.col("name")], top)


def retry_owners(names: DataFrame, marks: DataFrame, accept: float = 0.4, most: int = 3) -> DataFrame:
    """(name, strategy, companies) by the first strategy that hits: equal after cleaning, flipped person name, similarity.

    Names that are left after each step are settled: they are few, and several joins read them.
    """
    owners = marks.select("owner_name").filter("owner_name IS NOT NULL").distinct()
    names = settled(names.select("name").distinct().withColumn("cleaned", clean_name(F.col("name"))))
    plain = lambda c: F.upper(F.regexp_replace(c, "[,.]", ""))
    first = names.join(owners, plain(F.col("cleaned")) == plain(F.col("owner_name"))).select("name", "owner_name", F.lit(1.0).alias("rank"), F.lit("clean_exact").alias("strategy"))
    left = names.join(first.select("name").distinct(), "name", "left_anti")
    flipped = settled(left.withColumn("flipped", flip_person_name(F.col("name"))).filter("flipped IS NOT NULL"))
    hit = contains_candidates(
        flipped.select(F.col("flipped").alias("key"), F.array("flipped").alias("pieces")).distinct(), owners.select(F.col("owner_name").alias("text"))
    )
    second = flipped.join(hit, F.col("flipped") == F.col("key")).select("name", F.col("text").alias("owner_name"), F.lit(1.0).alias("rank"), F.lit("name_flip").alias("strategy"))
    left = settled(left.join(second.select("name").distinct(), "name", "left_anti").filter(F.length("cleaned") >= 5))
    near = similar_names(left.select(F.col("name").alias("query")), owners.select(F.col("owner_name").alias("name")))
    best = near.groupBy("query").agg(F.max("sim").alias("best")).filter(F.col("best") >= accept)
    third = near.join(best, "query").select(F.col("query").alias("name"), F.col("name").alias("owner_name"), F.col("sim").alias("rank"), F.lit("trgm").alias("strategy"))
    found = first.unionByName(second).unionByName(third)
    top = cap_per_key(found, ["name"], [F.col("rank").desc(), F.col("owner_name")], most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("r"), "owner_name"))), lambda x: x["owner_name"])
    return top.groupBy("name", "strategy").agg(listed.alias("companies"))


def retry_brands(names: DataFrame, marks: DataFrame, most: int = 3) -> DataFrame:
    """(name, companies): owners of marks that equal the brand, whose signs count as spaces."""
    cleaned = names.select("name").distinct().withColumn("brand", F.upper(clean_name(F.col("name"))))
    found = cleaned.join(marks.select(F.upper("mark_identification").alias("brand"), "owner_name").distinct(), "brand")
    found = found.filter("owner_name IS NOT NULL").select("name", "owner_name").distinct()
    return found.groupBy("name").agg(F.slice(F.array_sort(F.collect_set("owner_name")), 1, most).alias("companies"))
