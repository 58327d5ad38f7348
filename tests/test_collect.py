import random
from collections import Counter

from brandspark.operators import collect, incremental, matching, resolve
from brandspark.plans import queries
from brandspark.plans.analog import Analog

STATUS = [("700", "LIVE", "Registered", "d"), ("710", "DEAD", "Cancelled", "d"), ("620", "LIVE", None, "d")]
MARK = "serial_number long, mark_identification string, owner_name string, status_code string, live_dead string"


def _registry(spark, rng, serials=40):
    some = lambda n: [rng.randrange(serials + 5) for _ in range(n)]
    text = lambda values: rng.choice([*values, None])
    marks = [(s, text(["AX", "BY", ""]), text(["0000000", "1"]), rng.choice(["700", "710", "620"])) for s in [*range(serials), 3, 4]]
    rows = lambda values, schema: spark.createDataFrame([tuple(v) for v in values], schema)
    return {
        "trademarks": rows(marks + marks[:7], "serial_number long, mark_identification string, registration_number string, status_code string"),
        "owners": rows([(s, text(["A Inc.", "B Inc.", "C Inc."])) for s in some(120)], "serial_number long, party_name string"),
        "status": rows(STATUS, "status_code string, live_dead string, category string, description string"),
        "classes": rows([(s, text(["001", "002", "009"]), text([0])) for s in some(150)], "serial_number long, international_code string, first_use_date int"),
        "nice": rows([("001", "n1", "c1"), ("001", "n1", "c1"), ("002", "n2", "c2"), ("002", "other", "c2")], "code string, name_en string, name_cn string"),
        "statements": rows([(s, rng.choice(["GS1", "DS1"]), text(["goods", "more", "goods"])) for s in some(80)], "serial_number long, type_code string, text string"),
    }


def _details(registry, companies):
    """The details by loops over plain rows."""
    t = {k: [tuple(r) for r in v.collect()] for k, v in registry.items()}
    live = {r[0]: r for r in t["status"] if r[1] == "LIVE"}
    out = set()
    for serial, mark, number, code in t["trademarks"]:
        for _, owner in [o for o in t["owners"] if o[0] == serial and o[1] in companies and code in live]:
            own = [(c, d) for s, c, d in t["classes"] if s == serial] or [(None, None)]
            for c, d in own:
                for name_cn, name_en in [(n[2], n[1]) for n in t["nice"] if n[0] == c] or [(None, None)]:
                    for g in [x for s, kind, x in t["statements"] if s == serial and kind.startswith("GS")] or [None]:
                        out.add((owner, mark, serial, number, code, "LIVE", live[code][2], c, name_cn, name_en, g, d))
    return out


def test_details_are_a_product_of_distinct_parts(spark):
    registry = _registry(spark, random.Random(4))
    companies = spark.createDataFrame([("A Inc.",), ("B Inc.",), ("A Inc.",), ("Z",)], "real_company string")
    details = collect.collect_brands(companies, **registry)
    want = _details(registry, {"A Inc.", "B Inc."})
    assert Counter(map(tuple, details.collect())) == Counter(want) and len(want) > 80
    # the multiplied rows with their texts are not compared again
    assert "Aggregate" not in details._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    summary = collect.collection_summary(details).first()
    assert tuple(summary) == (len({w[0] for w in want}), len({w[1] for w in want if w[1] is not None}), len(want))


def test_refresh_counts_old_and_new_rows(spark):
    registry = _registry(spark, random.Random(6))
    matched = spark.createDataFrame([("1", "A Inc."), ("2", None), ("3", "B Inc.")], "case_number string, real_company string")
    old = collect.collect_brands(spark.createDataFrame([("A Inc.",)], "real_company string"), **registry)
    fresh, counts = incremental.refresh_brands(matched, old, registry)
    a, b = (len(_details(registry, set(c))) for c in (["A Inc."], ["A Inc.", "B Inc."]))
    assert tuple(counts.first()) == (a, b, b - a) and fresh.count() == b
    plan = counts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Aggregate" in line and "real_company" in line and "goods_services" in line]  # rows are counted, not compared


def test_details_are_not_stored_for_pending_cases(spark, sf, monkeypatch):
    written = []
    keep = type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda self, *a, **b: (written.append(self.columns), keep(self, *a, **b))[1])
    queries._pending_run(Analog(spark, sf))
    assert written and not [c for c in written if "goods_services" in c or "serial_number" in c]


def test_owners_alone_are_those_of_the_marks(spark):
    rng = random.Random(9)
    word = lambda n: " ".join(rng.choice(["red", "tin", "cup", "ox"]) for _ in range(n))
    rows = {(rng.randrange(60), word(rng.randint(1, 3)).upper(), rng.choice([None, *[f"{word(2)} {x} Inc." for x in "ab"]]), "700", "LIVE") for _ in range(500)}
    marks = spark.createDataFrame(sorted(rows, key=str), MARK)
    names = spark.createDataFrame([(word(rng.randint(1, 4)),) for _ in range(60)] + [("",), ("red cup",), ("The",), ("none such",)], "name string")
    holders = matching.mark_holders(marks)
    for cap in (1, 3, 20, 100, None):
        for path, alone in ((matching.match_owners, matching.match_owner_names), (matching.match_marks, matching.match_mark_owners)):
            want = {(r.name, r.match_type, r.owner_name) for r in path(names, marks, cap).collect()}
            got = [tuple(r) for r in alone(names, holders, cap).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_candidates_and_overlap_of_cases(spark):
    rng = random.Random(10)
    path = lambda names: spark.createDataFrame([(n, rng.choice(["exact", "fuzzy"]), f"o{rng.randrange(30)}") for n in names for _ in range(12)] + [("p1", "miss", None)], "name string, match_type string, owner_name string")
    plaintiffs, brands = ["", *[f"p{k}" for k in range(6)]], ["", *[f"b{k}" for k in range(6)]]
    a, b = path(plaintiffs), path(brands)
    rows = [(str(k), rng.choice(plaintiffs), rng.choice(brands), rng.random() < 0.2) for k in range(300)]
    cases = spark.createDataFrame(rows, "case_number string, plaintiff_clean string, brand_clean string, brand_eq_plaintiff boolean")
    held = lambda p: {(r.name, r.owner_name) for r in p.collect() if r.owner_name}
    want_a = {(n, o) for n, p, _, _ in rows for x, o in held(a) if x == p != ""}
    want_b = {(n, o) for n, _, q, same in rows for x, o in held(b) if x == q != "" and not same}
    got_a, got_b = resolve.case_candidates(cases, a, b)
    assert Counter(map(tuple, got_a.collect())) == Counter(want_a) and Counter(map(tuple, got_b.collect())) == Counter(want_b)
    assert "Aggregate" not in got_b._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]  # rows of cases are not compared again
    assert Counter(map(tuple, resolve.overlap(cases, a, b).collect())) == Counter(want_a & want_b)
