import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from brandspark.llm import conversation_repair as cr
from brandspark.llm.common import read

LEGAL = re.compile("(s?(ua)+)?")
END = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired turns) by plain dynamic programming over (row, role before): faults are the second of a row."""
    best = {0: (0, "", ())}  # state: cost, letters, turns
    step, follow, role_of = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), (2, 2, 3, 2), ("user", "user", "assistant", "user")

    def inserted(best):
        for _ in range(4):
            for q, (c, x, t) in list(best.items()):
                new = (c + 5, x + "I", (*t, (role_of[q], "")))
                if follow[q] not in best or new < best[follow[q]]:
                    best[follow[q]] = new
        return best

    for role, text, fault in rows:
        new = {}
        for q, (c, x, t) in inserted(best).items():
            more = 5 if fault == "truncated" else 0
            options = [(q, (c + 2, x + "D", t))]
            if fault not in ("blank", "duplicate"):
                if role[:1] in step[q]:
                    options.append((step[q][role[:1]], (c + more, x + "K", (*t, (role, text)))))
                options.append((follow[q], (c + 1 + more, x + "R", (*t, (role_of[q], text)))))
            for to, o in options:
                if to not in new or o[:2] < new[to][:2]:
                    new[to] = o
        best = new
    return min(v for q, v in inserted(best).items() if q in (0, 3))


def expected(rows):
    by_conv = defaultdict(list)
    for conv, *_ in rows:
        by_conv[conv]
    for conv, turn, role, text in damage(rows):
        by_conv[conv].append((turn, role, text))
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faulty, count = set(), [], defaultdict(int)
        for _, role, text in own:
            fault = "blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "truncated" if not END.search(text) else ""
            seen.add((role, text))
            count[fault] += 1
            faulty.append((role, text, fault))
        cost, audit, turns = cheapest(faulty)
        assert LEGAL.fullmatch("".join(r[0] for r, _ in turns))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(cr.query(spark, sf)) == expected(rows)


def test_odd_conversations_equal_brute_force(spark):
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "User"], ["Yes.", "No!", "cut", "", " \n", None, "Well?\t ", "ok. then", "é.", "x" * 50_000 + "."]
    rows = [(c, rng.choice([None, *range(-2, 9)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(80)] for _ in range(rng.randint(1, 12))]
    rows += [(900, t, rng.choice(roles[:4]), f"{rng.choice(['a', 'b'])} {rng.randint(0, 150)}{rng.choice(['.', ''])}") for t in range(300)]
    rows += [(901, 3, "user", "again.")] * 500 + [(902, k, "user", "the same.") for k in range(200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, n int")
    assert got(cr.repair_reports(cr.damaged(df), df)) == expected(rows)


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_dynamic_programming(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [(rng.choice("suax "), rng.random() < 0.3) for _ in range(rng.randint(0, 14))]
        want = cheapest([(r, "t", "truncated" if cut else "") for r, cut in rows])[:2]
        assert cr.search(rows) == want
        assert cr.repair_letters(rows, piece=3) == want
        assert cr.repair_letters(rows, piece=1) == want


def test_turns_are_those_of_the_report(spark, sf):
    rows = cr.damaged(read(spark, sf, "conversations"))
    turns = defaultdict(list)
    for r in sorted(cr.repaired_turns(rows).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.place == len(turns[r.conv_id])
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, row in got(cr.repair_reports(rows)).items():
        assert row[-1] == hashlib.sha256("\n".join(turns[conv]).encode()).hexdigest()


def test_empty_table(spark, sf):
    rows = read(spark, sf, "conversations").limit(0)
    assert cr.repair_reports(cr.damaged(rows), rows).collect() == []


def test_conversation_without_rows_left(spark, sf):
    ids = read(spark, sf, "conversations").limit(1)
    row = cr.repair_reports(ids.limit(0), ids).first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
