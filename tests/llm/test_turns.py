import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from auric.llm import turns
from auric.llm.queries import QUERIES
from conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.rstrip(SPACE)
        fault = turns.BLANK if not solid else turns.DUPLICATE if (role, text) in seen else \
            turns.CUT if solid[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit) by dynamic programming over all edits, row by row."""
    best = {"": (0, "")}                                  # last initial -> prefix

    def inserted(now):
        for _ in range(3):
            for last, (cost, audit) in list(now.items()):
                new = "a" if last == "u" else "u"
                found = (cost + 3, audit + "I")
                if new not in now or found < now[new]:
                    now[new] = found
        return now
    best = inserted(best)
    for initial, fault in rows:
        now = {}

        def put(last, found):
            if last not in now or found < now[last]:
                now[last] = found
        for last, (cost, audit) in best.items():
            put(last, (cost + 4, audit + "D"))
            if fault in (turns.BLANK, turns.DUPLICATE):
                continue
            cost += 3 * (fault == turns.CUT)
            new = "a" if last == "u" else "u"
            put(new, (cost + 3, audit + "R"))
            if initial and initial == new or (initial == "s" and last == ""):
                put(initial, (cost, audit + "K"))
        best = inserted(now)
    return min(best[x] for x in ("", "a") if x in best)


def plain_repair(original):
    """Every column of the operator for (conv, turn, role, text) rows."""
    damaged = plain_damage(original)
    out = []
    for conv in {r[0] for r in original}:
        own = [r for r in damaged if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        known = [r[1] for r in own if r[1] is not None]
        faults = plain_faults([r[2:] for r in own])
        cost, audit = cheapest([(r[2][:1], f) for r, f in zip(own, faults)])
        left, state, rest = [], "", iter(own)
        for edit in audit:
            new = "a" if state == "u" else "u"
            if edit == "I":
                left.append(("user" if new == "u" else "assistant") + ":")
                state = new
                continue
            _, _, role, text = next(rest)
            if edit == "K":
                state = role[0]
                left.append(f"{role}:{text}")
            elif edit == "R":
                left.append(("user" if new == "u" else "assistant") + ":" + text)
                state = new
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0,
                    faults.count(turns.BLANK), faults.count(turns.DUPLICATE), faults.count(turns.CUT),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
                    cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(rng, n):
    return [(rng.choice([turns.SYSTEM, turns.USER, turns.USER, turns.ASSISTANT, turns.ASSISTANT, turns.OTHER]),
             rng.choice([0, 0, 0, 0, turns.BLANK, turns.DUPLICATE, turns.CUT, turns.CUT])) for _ in range(n)]


INITIAL = {turns.SYSTEM: "s", turns.USER: "u", turns.ASSISTANT: "a", turns.OTHER: "x"}


def test_dynamic_programming_is_the_least_of_all_edits():
    rng = random.Random(1)
    legal = re.compile(r"(s?(ua)+)?")
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 3))
        found = []
        for length in range(len(rows), len(rows) + 4):
            for audit in itertools.product("DIKR", repeat=length):
                if sum(e != "I" for e in audit) != len(rows):
                    continue
                for names in itertools.product("ua", repeat=sum(e in "IR" for e in audit)):
                    rest, name, left, cost = iter(rows), iter(names), "", 0
                    for e in audit:
                        if e == "I":
                            left, cost = left + next(name), cost + 3
                            continue
                        role, fault = next(rest)
                        if e != "D" and fault in (turns.BLANK, turns.DUPLICATE):
                            cost = None
                            break
                        cost += 4 if e == "D" else 3 * (fault == turns.CUT) + 3 * (e == "R")
                        left += "" if e == "D" else INITIAL[role] if e == "K" else next(name)
                    if cost is not None and legal.fullmatch(left):
                        found.append((cost, "".join(audit)))
        assert min(found) == cheapest([(INITIAL[r], f) for r, f in rows]), rows


def test_search_is_the_optimum_and_bounds_hold():
    rng = random.Random(2)
    for k in range(400):
        rows = random_rows(rng, rng.randint(0, 12 if k % 10 else 64))
        want = cheapest([(INITIAL[r], f) for r, f in rows])
        assert turns.search(rows, turns.START, turns.DONE) == want
        for state, lower in enumerate(turns.bounds(rows)):
            for i in range(len(rows) + 1):
                for end in range(4):
                    found = turns.search(rows[i:], state, (end,))
                    assert found is None or lower[i] <= found[0], (rows, state, i)


def test_hard_spans():
    for rows in ([(turns.USER, 0)] * 64, [(turns.OTHER, turns.CUT)] * 64, [(turns.SYSTEM, 0)] * 64,
                 [(turns.USER, turns.CUT), (turns.USER, 0)] * 32):
        assert turns.search(rows, turns.START, turns.DONE) == cheapest([(INITIAL[r], f) for r, f in rows])


def test_spans_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(12):
        rows = random_rows(rng, rng.randint(65, 400))
        assert turns.solve(rows) == cheapest([(INITIAL[r], f) for r, f in rows])
        cut = rng.randint(1, len(rows) - 1)
        joined = turns._joined(turns.transfer(rows[:cut]), turns.transfer(rows[cut:]))
        assert joined == turns.transfer(rows)


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(4)
    texts = ["Yes.", "No!", "why", " \t", "", "And then?", "um ", "one. two", None]
    rows = []
    for conv in [None, *range(150)]:
        role = ["user", "assistant"]
        for turn in range(rng.randint(1, 9)):
            if rng.random() < .1:
                turn += 3
            rows.append((conv, turn, rng.choice([role[turn % 2]] * 6 + ["system", "", "tool", None]),
                         rng.choice(texts) if rng.random() < .5 else f"text {rng.random()}."))
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            out.append(r)
    out += [(7, None, "system", "First."), (900, None, None, None)]
    out += [(500, t, ["user", "assistant"][t % 2] if t % 7 else "user", f"long {t}.") for t in range(1500)]
    return out


def test_repair_like_brute_force(spark, conversations):
    docs = spark.createDataFrame(conversations, SCHEMA).repartition(5)
    found = turns.repair(turns.damaged(docs), of=docs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_repair(conversations)


def test_repaired_rows_have_the_digest(spark, conversations):
    docs = spark.createDataFrame(conversations, SCHEMA)
    left = turns.damaged(docs)
    rows = {}
    for r in turns.repaired(left).orderBy("conv_id", "place").collect():
        rows.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in turns.repair(left).collect():
        assert hashlib.sha256("\n".join(rows.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        assert r.audit.count("D") + len(rows.get(r.conv_id, [])) == len(r.audit)


def test_one_conversation_over_all_partitions(spark):
    rows = [(1, 5, "user", "same.")] * 4000 + [(1, t, "assistant", f"{t}.") for t in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    found = turns.repair(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    faults = plain_faults([r[2:] for r in ordered])
    cost, audit = cheapest([(r[2][0], f) for r, f in zip(ordered, faults)])
    assert len(found) == 1 and (found[0].cost, found[0].audit, found[0].duplicate) == (cost, audit, 3999)


def test_empty_and_clashing(spark, conversations):
    docs = spark.createDataFrame(conversations, SCHEMA)
    assert turns.repair(docs.limit(0)).count() == 0
    gone = turns.repair(docs.limit(0), of=docs.filter("conv_id = 7")).collect()
    assert [tuple(r) for r in gone] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    more = docs.withColumns({c: F.lit(1) for c in ("conv", "id", "h1", "fault", "harm", "copy", "edits", "kind")})
    assert rows_of(turns.repair(turns.damaged(more))) == rows_of(turns.repair(turns.damaged(docs)))


def test_query_is_the_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_conversation_repair"](spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_repair(rows)
