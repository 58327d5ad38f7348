import numpy as np
import pytest

from brandspark.llm import language_id
from brandspark.llm.common import read
from brandspark.llm.language_id import OTHER, accepted, fit, identify


@pytest.fixture(scope="module")
def model(spark):
    return fit(read(spark, "/root/testdata/sf0.01", "documents"), per_language=60)


def test_held_out_documents(spark, model):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    result = identify(docs, model, "doc_id", "text", host_col="source").join(docs.withColumnRenamed("lang", "truth"), F_eq())
    rows = result.select("lang", "truth").collect()
    assert len(rows) == docs.count()
    assert sum(r.lang == r.truth for r in rows) >= 0.99 * len(rows)


def F_eq():
    from pyspark.sql import functions as F

    return F.col("id") == F.col("doc_id")


def test_pages_follow_text_declaration_and_address(spark, sf, model):
    pages = read(spark, sf, "pages")
    rows = identify(pages, model, "page_id", "html", html=True, url_col="url").collect()
    assert len(rows) == pages.count()
    assert np.mean([r.lang == r.declared_lang for r in rows]) >= 0.99


def test_wrong_declarations_lose_their_weight(spark, model):
    docs = read(spark, "/root/testdata/sf0.01", "documents").selectExpr(
        "doc_id", "text", "lang AS truth", "CASE WHEN doc_id % 2 = 0 THEN 'fr' ELSE lang END AS declared"
    )
    rows = identify(docs, model, "doc_id", "text", declared_col="declared").join(docs, F_eq()).collect()
    assert np.mean([r.lang == r.truth for r in rows]) >= 0.99


def test_prior_decides_without_text(spark, model):
    docs = read(spark, "/root/testdata/sf0.01", "documents").filter("lang = 'de'").limit(60)
    rows = docs.selectExpr("doc_id", "text", "'https://a.x.de/1' AS url").collect()
    data = [(r.doc_id, r.text, r.url) for r in rows] + [(-1, None, "https://a.x.de/2"), (-2, "", None), (-3, "1234 ###", "::bad::")]
    table = spark.createDataFrame([(*r, 0) for r in data], "doc_id long, text string, url string, posterior int")
    got = {r.id: r for r in identify(table, model, "doc_id", "text", url_col="url").collect()}
    assert len(got) == len(data)
    assert got[-1].lang == "de" and got[-1].text_lang is None and got[-1].n_trigrams == 0
    result = identify(table, model, "doc_id", "text", url_col="url")
    assert {r.id for r in accepted(result).collect()} == {r[0] for r in data if r[0] >= 0}


def test_unknown_script_is_undetermined(spark, model):
    docs = spark.createDataFrame([(1, "これは日本語の文章です。" * 20), (1, "これは日本語の文章です。" * 20)], "doc_id long, text string")
    assert {r.lang for r in identify(docs, model, "doc_id", "text").collect()} == {OTHER}
    assert identify(docs.limit(0), model, "doc_id", "text").count() == 0


def test_declaration_behind_a_long_head(spark, model):
    page = "<html class=x lang='FR'><body>1234</body></html>"
    pages = [(1, page), (2, "<!--" + "x" * 30_000 + "-->" + page), (3, " " * 60_000 + page), (4, "<html " * 20_000), (5, "<html><p>1</p>")]
    got = {r.id: r.declared_lang for r in identify(spark.createDataFrame(pages, "page_id long, html string"), model, "page_id", "html", html=True).collect()}
    assert got == {1: "fr", 2: "fr", 3: "fr", 4: "none", 5: "none"}


def test_visible_text_equals_the_pattern_and_is_linear():
    import random
    import re
    import time

    pattern = re.compile(r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>|&#?\w+;")
    rng = random.Random(3)
    parts = ["<script", "<SCRIPT x>", "</script>", "</Script >", "<style>", "</style>", "<!--", "-->", "<p>", "<", ">", "&amp;", "&", "#1;", "a", " ", "\n", "é"]
    for _ in range(4000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert language_id.visible_text(page) == pattern.sub(" ", page), page
    start = time.time()
    for page in ("<script " * 200_000, "<" * 400_000, "<!-- " * 300_000, "&amp" * 300_000, "<p" * 200_000 + "&amp;"):
        language_id.visible_text(page)
    assert time.time() - start < 20


def test_many_languages_and_clashing_names(spark):
    rows = [(k, f"{chr(0x4E00 + k % 70) * 3} " * 20, f"l{chr(97 + k % 70 // 26)}{chr(97 + k % 70 % 26)}", "x") for k in range(280)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, code string")
    model = language_id.fit(docs)
    assert len(model.languages) == 70
    got = {r.id: r.lang for r in language_id.identify(docs, model, "doc_id", "text").collect()}
    assert sum(got[r[0]] == r[2] for r in rows) >= 0.9 * len(rows)


def test_more_languages_than_there_were_classes(spark):
    """Each of 140 languages has letters of its own; labels may name a region, and other labels are none."""
    codes = [a + b for a in "abcdefghijkl" for b in "abcdefghijkl"][:140]
    text = lambda k: " ".join(chr(0x4E00 + 40 * k + j % 40) * 2 for j in range(60))
    rows = [(2 * k + j, text(k), (code, code.upper() + "-XX")[j]) for k, code in enumerate(codes) for j in range(2)]
    rows += [(1000, text(0), "no code"), (1001, text(1), None), (1002, text(2), "q")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == sorted(codes)
    assert model.log_likelihood.shape[1] == 141
