"""The jobs' steps in SQL for DuckDB, as common table expressions that build on each other."""

from __future__ import annotations

from ..functions.similarity import PATTERN_STOP, SCORE_STOP
from ..functions.text import BRAND_RUN, PLAINTIFF_ENDS
from ..sources.status import STATUS_CODES
from .analog import TABLES, VIEWS

quote = lambda s: "'" + s.replace("'", "''") + "'"
_list = lambda items: "[" + ", ".join(map(quote, items)) + "]"


def plaintiff(c: str) -> str:
    s = f"trim(split_part(trim(coalesce({c}, '')), '|', 1))"
    for pattern in PLAINTIFF_ENDS:
        s = f"trim(regexp_replace({s}, {quote('(?is)' + pattern + '.*')}, ''))"
    return f"rtrim({s}, ';,| ')"


def brand(c: str) -> str:
    s = f"trim(coalesce({c}, ''))"
    run = f"rtrim(trim(regexp_extract({s}, {quote(BRAND_RUN)}, 1)), ' .,;:-')"
    return f"CASE WHEN NOT regexp_matches({s}, '[a-zA-Z0-9]') THEN {s} WHEN length({run}) >= 2 THEN upper({run}) ELSE upper({s}) END"


def words(c: str) -> str:
    return f"list_filter(string_split_regex(trim({c}), '\\s+'), lambda w: w <> '')"


def tokens(c: str) -> str:
    low = f"list_transform(list_filter({words(c)}, lambda w: length(w) > 1), lambda w: trim(lower(w), '.,;'))"
    return f"list_distinct(list_filter({low}, lambda w: NOT list_contains({_list(SCORE_STOP)}, w)))"


def score(q: str, c: str) -> str:
    return f"CASE WHEN len({q}) > 0 THEN len(list_intersect({q}, {c})) / len({q}) ELSE 0.0 END"


def pattern(c: str) -> str:
    long = f"list_filter({words(c)}, lambda w: length(w) > 1)"
    own = f"list_filter({long}, lambda w: NOT list_contains({_list(PATTERN_STOP)}, trim(lower(w), '.,;')))"
    some = f"(CASE WHEN len({own}) > 0 THEN {own} ELSE {long} END)[1:3]"
    edge = f"list_transform({some}, lambda w: '\\b' || regexp_escape(trim(w, '.,;')) || '\\b')"
    return f"'(?is)' || array_to_string({edge}, '.*')"


def trigrams(c: str) -> str:
    parts = f"list_filter(string_split_regex(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    grams = f"list_transform({parts}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))"
    return f"list_distinct(flatten({grams}))"


#: The report's order of qualities, written out for SQL.
RANK = """CASE match_quality WHEN 'exact' THEN 1 WHEN 'a_preferred' THEN 2 WHEN 'a_only' THEN 3 WHEN 'ai_high' THEN 4 WHEN 'ai_medium' THEN 5
    WHEN 'b_only' THEN 6 WHEN 'ai_low' THEN 7 WHEN 'b_uncertain' THEN 8 ELSE 9 END"""

CTES = {
    **{name: text.format(**{t: t for t in TABLES}) for name, text in VIEWS.items()},
    "status": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in STATUS_CODES) + ") v(status_code, live_dead, category, description)",
    "cases0": f"""SELECT case_number, date_filed, trim(nature_of_suit) AS nature_of_suit, trim(plaintiff) AS plaintiff_raw, trim(brand) AS brand_raw,
        {plaintiff("plaintiff")} AS plaintiff_clean, {brand("brand")} AS brand_clean FROM v_cases_raw WHERE trim(case_number) <> ''""",
    "cases": "SELECT *, plaintiff_raw = brand_raw OR plaintiff_clean = brand_clean AS brand_eq_plaintiff FROM cases0",
    "marks": """SELECT DISTINCT t.serial_number, t.mark_identification, o.party_name AS owner_name, t.status_code, s.live_dead
        FROM v_trademarks t JOIN v_owners o USING (serial_number) JOIN status s USING (status_code) WHERE s.live_dead = 'LIVE'""",
    "names_a": f"SELECT plaintiff_clean AS name, {tokens('plaintiff_clean')} AS q FROM (SELECT DISTINCT plaintiff_clean FROM cases WHERE plaintiff_clean <> '')",
    "owners_a": f"SELECT owner_name, {tokens('owner_name')} AS o FROM (SELECT DISTINCT owner_name FROM marks)",
    "pairs_a": f"SELECT name, owner_name, {score('q', 'o')} AS score FROM names_a, owners_a WHERE {score('q', 'o')} >= 0.3",
    "exact_a": "SELECT name, owner_name, score FROM pairs_a WHERE contains(lower(owner_name), lower(name))",
    "fuzzy_a": f"SELECT name, owner_name, score FROM pairs_a WHERE name NOT IN (SELECT name FROM exact_a) AND regexp_matches(owner_name, {pattern('name')})",
    "rows_a": """SELECT name, 'exact' AS match_type, m.* FROM exact_a JOIN marks m USING (owner_name) UNION
        SELECT name, 'fuzzy', serial_number, mark_identification, owner_name, status_code, live_dead FROM (
          SELECT name, m.*, row_number() OVER (PARTITION BY name ORDER BY score DESC, owner_name, serial_number, mark_identification, status_code) AS k
          FROM fuzzy_a JOIN marks m USING (owner_name)) WHERE k <= 100""",
    "path_a": """SELECT n.name, coalesce(r.match_type, 'miss') AS match_type, r.serial_number, r.mark_identification, r.owner_name, r.status_code, r.live_dead
        FROM names_a n LEFT JOIN rows_a r USING (name)""",
    "names_b": "SELECT DISTINCT brand_clean AS name FROM cases WHERE brand_clean <> '' AND NOT brand_eq_plaintiff",
    "texts_b": "SELECT DISTINCT mark_identification FROM marks",
    "exact_b": "SELECT name, mark_identification, 1.0 AS score FROM names_b JOIN texts_b ON upper(name) = upper(mark_identification)",
    "fuzzy_b": f"""SELECT * FROM (SELECT name, mark_identification, {score(tokens("name"), tokens("mark_identification"))} AS score FROM (
          SELECT name, mark_identification, {words("name")} AS w FROM names_b, texts_b
          WHERE name NOT IN (SELECT name FROM exact_b) AND regexp_matches(name, '\\p{{L}}'))
        WHERE CASE WHEN len(w) >= 2 THEN contains(lower(mark_identification), lower(w[1]))
                AND contains(substr(lower(mark_identification), instr(lower(mark_identification), lower(w[1])) + length(w[1])), lower(w[2]))
              ELSE length(w[1]) >= 3 AND contains(lower(mark_identification), lower(w[1])) END)
        WHERE contains(upper(mark_identification), upper(name)) OR contains(upper(name), upper(mark_identification)) OR score >= 0.5""",
    "rows_b": """SELECT name, 'exact' AS match_type, m.serial_number, m.mark_identification, m.owner_name, m.status_code, m.live_dead
          FROM exact_b JOIN marks m USING (mark_identification) UNION
        SELECT name, 'fuzzy', serial_number, mark_identification, owner_name, status_code, live_dead FROM (
          SELECT name, m.*, row_number() OVER (PARTITION BY name ORDER BY score DESC, owner_name, serial_number, mark_identification, status_code) AS k
          FROM fuzzy_b JOIN marks m USING (mark_identification)) WHERE k <= 100""",
    "path_b": """SELECT n.name, coalesce(r.match_type, 'miss') AS match_type, r.serial_number, r.mark_identification, r.owner_name, r.status_code, r.live_dead
        FROM names_b n LEFT JOIN rows_b r USING (name)""",
    "cand_a": "SELECT DISTINCT case_number, owner_name FROM cases JOIN path_a ON plaintiff_clean = name WHERE plaintiff_clean <> '' AND owner_name IS NOT NULL",
    "cand_b": """SELECT DISTINCT case_number, owner_name FROM cases JOIN path_b ON brand_clean = name
        WHERE brand_clean <> '' AND NOT brand_eq_plaintiff AND owner_name IS NOT NULL""",
    "cand_ab": "SELECT * FROM cand_a INTERSECT SELECT * FROM cand_b",
    "scores": f"""SELECT plaintiff_clean, owner_name, round({score(tokens("plaintiff_clean"), tokens("owner_name"))}, 12) AS s
        FROM (SELECT DISTINCT plaintiff_clean, owner_name FROM cases JOIN (SELECT * FROM cand_a UNION SELECT * FROM cand_b) USING (case_number))""",
    **{
        f"best_{x}": f"""SELECT case_number, count(*) AS n, min(owner_name) AS first, arg_min(owner_name, (-s, owner_name)) AS owner, max(s) AS s
        FROM cand_{x} JOIN cases USING (case_number) JOIN scores USING (plaintiff_clean, owner_name) GROUP BY case_number"""
        for x in ("a", "b", "ab")
    },
    "matched": """SELECT case_number, plaintiff_clean, brand_clean,
          CASE WHEN q = 'exact' THEN x WHEN q IN ('a_preferred', 'a_only') THEN y WHEN q IN ('b_only', 'b_uncertain') THEN z END AS real_company,
          q AS match_quality, coalesce(q IN ('a_preferred', 'a_only') AND s < 0.3, false) OR q IN ('b_uncertain', 'not_found') AS needs_review,
          CASE WHEN q IN ('a_preferred', 'a_only') AND s < 0.3 THEN 'low_similarity: ' || printf('%.3f', s)
               WHEN q = 'b_uncertain' THEN 'brand ' || brand_clean || ' has ' || nb || ' owners'
               WHEN q = 'not_found' THEN 'nature=' || coalesce(nature_of_suit, '') END AS review_reason
        FROM (SELECT c.*, ab.owner AS x, a.owner AS y, b.first AS z, a.s, b.n AS nb,
            CASE WHEN ab.n > 0 THEN 'exact' WHEN a.n > 0 AND b.n > 0 THEN 'a_preferred' WHEN a.n > 0 THEN 'a_only'
                 WHEN b.n <= 5 THEN 'b_only' WHEN b.n > 5 THEN 'b_uncertain' ELSE 'not_found' END AS q
          FROM cases c LEFT JOIN best_a a USING (case_number) LEFT JOIN best_b b USING (case_number) LEFT JOIN best_ab ab USING (case_number))""",
    **{
        f"exact_{x}1": f"SELECT name, {c} FROM names_{x}, (SELECT DISTINCT {c} FROM marks) WHERE {c} ILIKE '%' || name || '%'"
        for x, c in (("a", "owner_name"), ("b", "mark_identification"))
    },
    **{
        f"path_{x}1": f"""SELECT n.name, coalesce(r.match_type, 'miss') AS match_type, r.serial_number, r.mark_identification, r.owner_name, r.status_code, r.live_dead
        FROM names_{x} n LEFT JOIN (
          SELECT name, 'exact' AS match_type, m.* FROM exact_{x}1 JOIN marks m USING ({c}) UNION
          SELECT name, 'fuzzy', serial_number, mark_identification, owner_name, status_code, live_dead FROM (
            SELECT name, m.*, row_number() OVER (PARTITION BY name ORDER BY owner_name, serial_number, mark_identification, status_code) AS k
            FROM (SELECT name, {c} FROM (SELECT name, {words("name")} AS w FROM names_{x} WHERE name NOT IN (SELECT name FROM exact_{x}1)), (SELECT DISTINCT {c} FROM marks)
                  WHERE len(w) >= 2 AND {c} ILIKE '%' || w[1] || '%' || w[2] || '%') JOIN marks m USING ({c})) WHERE k <= 100) r USING (name)"""
        for x, c in (("a", "owner_name"), ("b", "mark_identification"))
    },
    "cand_a1": "SELECT DISTINCT case_number, owner_name FROM cases JOIN path_a1 ON plaintiff_clean = name WHERE plaintiff_clean <> '' AND owner_name IS NOT NULL",
    "cand_b1": """SELECT DISTINCT case_number, owner_name FROM cases JOIN path_b1 ON brand_clean = name
        WHERE brand_clean <> '' AND NOT brand_eq_plaintiff AND owner_name IS NOT NULL""",
    "cand_ab1": "SELECT * FROM cand_a1 INTERSECT SELECT * FROM cand_b1",
    "scores1": f"""SELECT plaintiff_clean, owner_name, round({score(tokens("plaintiff_clean"), tokens("owner_name"))}, 12) AS s
        FROM (SELECT DISTINCT plaintiff_clean, owner_name FROM cases JOIN (SELECT * FROM cand_a1 UNION SELECT * FROM cand_b1) USING (case_number))""",
    **{
        f"best_{x}1": f"""SELECT case_number, count(*) AS n, arg_min(owner_name, (-s, owner_name)) AS owner, max(s) AS s
        FROM cand_{x}1 JOIN cases USING (case_number) JOIN scores1 USING (plaintiff_clean, owner_name) GROUP BY case_number"""
        for x in ("a", "b", "ab")
    },
    "matched1": """SELECT case_number, plaintiff_clean, brand_clean,
          CASE WHEN q = 'exact' THEN x WHEN q IN ('a_preferred', 'a_only') THEN y WHEN q = 'b_only' THEN z END AS real_company, q AS match_quality,
          coalesce(q IN ('a_preferred', 'a_only') AND sa < 0.3, false) OR q = 'b_only' AND nb > 1 OR q = 'not_found' AS needs_review,
          CASE WHEN q IN ('a_preferred', 'a_only') AND sa < 0.3 THEN 'low_similarity: ' || printf('%.3f', sa)
               WHEN q = 'b_only' AND nb > 1 THEN 'multiple_b_owners: ' || nb || ', best_score=' || printf('%.3f', sb)
               WHEN q = 'not_found' THEN 'nature=' || coalesce(nature_of_suit, '') END AS review_reason
        FROM (SELECT c.*, ab.owner AS x, a.owner AS y, b.owner AS z, a.s AS sa, b.s AS sb, b.n AS nb,
            CASE WHEN ab.n > 0 THEN 'exact' WHEN a.n > 0 AND b.n > 0 THEN 'a_preferred' WHEN a.n > 0 THEN 'a_only' WHEN b.n > 0 THEN 'b_only' ELSE 'not_found' END AS q
          FROM cases c LEFT JOIN best_a1 a USING (case_number) LEFT JOIN best_b1 b USING (case_number) LEFT JOIN best_ab1 ab USING (case_number))""",
    "lost": "SELECT c.* FROM cases c JOIN matched m USING (case_number) WHERE m.match_quality = 'not_found'",
    "lost_names": f"""SELECT name, trim(regexp_replace(regexp_replace(name, '[.,;:''"()\\[\\]]+', ' ', 'g'), '\\s+', ' ', 'g')) AS cleaned, {words("name")} AS w
        FROM (SELECT DISTINCT plaintiff_clean AS name FROM lost WHERE plaintiff_clean NOT IN ('', '？', '?') AND length(trim(plaintiff_clean)) >= 2)""",
    "owners_r": f"SELECT owner_name, {trigrams('owner_name')} AS h FROM (SELECT DISTINCT owner_name FROM marks WHERE owner_name IS NOT NULL)",
    "retry_1": """SELECT name, 'clean_exact' AS strategy, owner_name, 1.0 AS rank FROM lost_names JOIN owners_r
        ON upper(replace(replace(cleaned, ',', ''), '.', '')) = upper(replace(replace(owner_name, ',', ''), '.', ''))""",
    "retry_2": """SELECT name, 'name_flip' AS strategy, owner_name, 1.0 AS rank FROM (
          SELECT name, CASE len(w) WHEN 2 THEN w[2] || ', ' || w[1] WHEN 3 THEN w[3] || ', ' || w[1] || ' ' || w[2] END AS flipped FROM lost_names
          WHERE name NOT IN (SELECT name FROM retry_1)) JOIN owners_r ON contains(lower(owner_name), lower(flipped))""",
    "retry_3": f"""SELECT name, 'trgm' AS strategy, owner_name, sim AS rank FROM (
          SELECT *, max(sim) OVER (PARTITION BY name) AS best, row_number() OVER (PARTITION BY name ORDER BY sim DESC, owner_name) AS k FROM (
            SELECT name, owner_name, len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h))) AS sim
            FROM (SELECT name, {trigrams("name")} AS g FROM lost_names WHERE length(cleaned) >= 5 AND name NOT IN (SELECT name FROM retry_1) AND name NOT IN (SELECT name FROM retry_2)), owners_r)
          WHERE sim >= 0.3) WHERE best >= 0.4 AND k <= 5""",
    "retry_names": """SELECT name, strategy, list(owner_name ORDER BY rank DESC, owner_name)[1:3] AS companies
        FROM (SELECT * FROM retry_1 UNION ALL SELECT * FROM retry_2 UNION ALL SELECT * FROM retry_3) GROUP BY name, strategy""",
    "retry_brands": f"""SELECT brand_clean AS name, list(DISTINCT owner_name ORDER BY owner_name)[1:3] AS companies FROM (SELECT DISTINCT brand_clean FROM lost) JOIN marks
          ON upper(trim(regexp_replace(regexp_replace(brand_clean, '[.,;:''"()\\[\\]]+', ' ', 'g'), '\\s+', ' ', 'g'))) = upper(mark_identification)
        WHERE length(brand_clean) >= 2 AND regexp_matches(regexp_replace(brand_clean, '[一-鿿]', '', 'g'), '\\p{{L}}') AND owner_name IS NOT NULL GROUP BY 1""",
    "retried": """SELECT case_number, strategy, 'a' AS source, companies FROM lost JOIN retry_names ON plaintiff_clean = name UNION ALL
        SELECT case_number, 'brand_exact', 'b', companies FROM lost JOIN retry_brands ON brand_clean = name
        WHERE coalesce(plaintiff_clean, '') = '' OR plaintiff_clean NOT IN ('', '？', '?') AND length(trim(plaintiff_clean)) >= 2 AND plaintiff_clean NOT IN (SELECT name FROM retry_names)""",
    "companies": "SELECT DISTINCT real_company FROM matched WHERE real_company IS NOT NULL",
    "details": """SELECT DISTINCT c.real_company, t.mark_identification, t.serial_number, t.registration_number, t.status_code, s.live_dead, s.category,
          k.international_code, n.name_cn AS international_desc_cn, n.name_en AS international_desc_en, g.text AS goods_services, k.first_use_date
        FROM companies c JOIN v_owners o ON o.party_name = c.real_company JOIN v_trademarks t USING (serial_number)
        JOIN status s ON s.status_code = t.status_code AND s.live_dead = 'LIVE' LEFT JOIN v_classes k USING (serial_number)
        LEFT JOIN v_nice n ON n.code = k.international_code LEFT JOIN v_statements g ON g.serial_number = t.serial_number AND g.type_code LIKE 'GS%'""",
    "suits": """SELECT m.*, CASE WHEN coalesce(nature_of_suit, '') = '' THEN '未知' ELSE nature_of_suit END AS suit
        FROM matched m LEFT JOIN (SELECT case_number, nature_of_suit FROM cases) USING (case_number)""",
}


def with_ctes(final: str) -> str:
    """``final`` with the expressions that it needs, in order."""
    import re

    need: set[str] = set()

    def add(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                add(CTES[name])

    add(final)
    used = [f"{name} AS {'MATERIALIZED ' if name in ('pairs_a', 'marks', 'cases', 'path_a', 'path_b', 'path_a1', 'path_b1', 'exact_a1', 'exact_b1', 'matched', 'details', 'retry_1', 'retry_2', 'retry_names') else ''}({CTES[name]})" for name in CTES if name in need]
    return (f"WITH {', '.join(used)}\n" if used else "") + final
