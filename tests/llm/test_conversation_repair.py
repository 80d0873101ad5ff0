import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowplan.llm import conversation_repair, edit_lattice

TURNS = "conv_id long, turn long, role string, text string"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
PUT = {0: 2, 1: 2, 2: 3, 3: 2}


def brute_way(rows, start=0, ends=(0, 3), last_put=True):
    """Cheapest edits of (initial, fault) rows: costs and whole rests from the back, so ties compare whole audits."""
    n = len(rows)
    best = {(n, q): (0, "") for q in ends}
    for i in range(n, -1, -1):
        if i < n:
            initial, fault = rows[i]
            for q in range(4):
                options = [(2, "D", q)]
                if fault in ("", "truncated"):
                    extra = 5 * (fault == "truncated")
                    options.append((1 + extra, "R", PUT[q]))
                    if (q, initial) in AFTER:
                        options.append((extra, "K", AFTER[q, initial]))
                ways = [(c + best[i + 1, q2][0], x + best[i + 1, q2][1]) for c, x, q2 in options if (i + 1, q2) in best]
                if ways:
                    best[i, q] = min(ways)
        for _ in range(6 * (i < n or last_put)):
            for q in range(4):
                if (i, PUT[q]) in best:
                    c, x = best[i, PUT[q]]
                    best[i, q] = min(best.get((i, q), (10**9, "")), (c + 5, "I" + x))
    return best.get((0, start))


def brute(conv_id, rows):
    after = []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", r[2] or " ")):
        role, text = (" " if x is None else x for x in (role, text))
        c = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if c == 0:
            continue
        text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
        role = "user" if c == 4 else role
        after += [(turn, role, text)] * (2 if c == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in after:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    cost, audit = brute_way([(r[1][:1], f) for r, f in zip(after, faults)])
    state, lines, i = 0, [], 0
    for x in audit:
        if x == "I":
            state = PUT[state]
            lines.append({2: "user", 3: "assistant"}[state] + ":")
            continue
        _, role, text = after[i]
        i += 1
        if x == "K":
            state = AFTER[state, role[:1]]
            lines.append(f"{role}:{text}")
        elif x == "R":
            state = PUT[state]
            lines.append({2: "user", 3: "assistant"}[state] + ":" + text)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for conv_id, *rest in rows:
        groups[conv_id].append(tuple(rest))
    return sorted(str(brute(k, g)) for k, g in groups.items())


def found(spark, rows, parts=4):
    frame = spark.createDataFrame(rows, TURNS).repartition(parts)
    return sorted(str(tuple(r)) for r in conversation_repair.damage_and_repair(frame).collect())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suaxs"), st.sampled_from(["", "", "truncated", "blank", "duplicate"])), max_size=9), st.integers(0, 3), st.integers(-1, 3))
def test_search_matches_exhaustive_costs(rows, entry, goal):
    items = [edit_lattice.Item(i, f == "truncated", int(f in ("blank", "duplicate"))) for i, f in rows]
    ends = (0, 3) if goal < 0 else (goal,)
    assert edit_lattice.least_repair(items, entry, goal) == brute_way(rows, entry, ends, goal < 0)


def random_rows(rng, convs, turns, spread=1):
    texts = ["Fine.", "Fine.", "Cut off", "ok!", " \n", "", "Why? ", "More words here.", "é。", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([t * spread, t, None, t // 2]), rng.choice(roles), rng.choice(texts)))
    return rows + rng.choices(rows, k=len(rows) // 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 150, 9, 3) + [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (-5, 7, "user", "x" * 70_000)]
    rows += [(10_000 + i, 0, "user", "Only.") for i in range(60)]  # some lose their only row
    got = found(spark, rows)
    assert got == expected(rows)
    assert any("e3b0c44298fc1c14" in x and ", 0, 0, 0, 0, 0, 0, ''," in x for x in got)


def test_long_conversations_are_cut_into_chunks(spark, monkeypatch):
    rng = random.Random(9)
    rows = random_rows(rng, 6, 120)
    rows += [(77, t, "user", "same text.") for t in range(150)] + [(78, 3, "assistant", "again.")] * 200
    monkeypatch.setattr(conversation_repair, "CHUNK", 7)
    assert found(spark, rows, 1) == expected(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, 5) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repaired_rows_follow_the_pattern(spark):
    rows = spark.createDataFrame(random_rows(random.Random(4), 40, 8), TURNS)
    repaired, reports = conversation_repair.repair(conversation_repair.damaged(rows))
    turns = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: (r.part, r.chunk, r.n)):
        turns[r.conv_id].append(r.role)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role in roles)) for roles in turns.values())
    assert reports.count() >= len(turns) > 10


def test_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    assert conversation_repair.damage_and_repair(spark.createDataFrame([], TURNS)).count() == 0
    frame = spark.createDataFrame([(1, 1, "user", "A."), (1, 2, "assistant", "B.")], TURNS)
    clash = frame.select("*", *[F.lit(3).alias(c) for c in ("copies", "fault", "part", "audit", "_first", "_fault")])
    assert [str(tuple(r)) for r in conversation_repair.damage_and_repair(clash).collect()] == expected([tuple(r) for r in frame.collect()])


def test_query_over_all_conversations(spark):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = registered.queries()["op11_conversation_repair"](spark, folder).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(rows)
