from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from brandspark.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = ["f01_f03_clean_cases", "f24_trigram_similarity", "j2_match_owners", "j3_match_marks", "c3_resolve_companies", "c3_resolve_companies_v1", "a5_quality_by_suit", "j5_retry_brands", "j7_case_candidates", "j8_overlap", "u1_merge_blacklist", "i1_upsert_registry", "c9_category_map"]
NEW = ["f01_clean_plaintiff", "a12_registry_quality", "a16_category_stats", "a17_status_codes", "x1_load_patents", "x1_patent_children", "x1_load_errors", "x4_similar_images", "c10_retry_not_found"]


def _plain(v):
    return round(v, 7) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", NAMES + NEW)
def test_query_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    found = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == Counter(tuple(map(_plain, r)) for r in found)


def test_entry_lists_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["f01_clean_whole_plaintiff", "i4_process_pending", "i4_process_pending_details"])
def test_whole_texts_and_details_equal_sql(spark, sf, name):
    test_query_equals_sql(spark, sf, name)
