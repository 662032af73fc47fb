"""Repairs against a search over all edits, and the query against a plain reading of its rules."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pyarrow.parquet as pq
import pytest

from parcelpulse.llm import conversation_repair as cr
from parcelpulse.llm import queries

SCHEMA = "conv long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def _faults(rows):
    out, seen = [], set()
    for role, text in rows:
        written = re.findall(r"[^\x20\x09-\x0D]", text)
        if not written:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if written[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _cheapest(rows, costs=cr.Costs()):
    """Shortest path over (rows read, state), by cost and then by audit; yields the repaired rows too."""
    faults = _faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in ("user", "assistant"):
            if (state, role[0]) in step:
                heapq.heappush(heap, (cost + costs.insert, audit + "I", i, role[0], (*out, (role, ""))))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + costs.delete, audit + "D", i + 1, state, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        stays = cost + (costs.truncated if faults[i] == "truncated" else 0)
        if (state, role[:1]) in step:
            heapq.heappush(heap, (stays, audit + "K", i + 1, role[:1], (*out, (role, text))))
        for new in ("user", "assistant"):
            if (state, new[0]) in step:
                heapq.heappush(heap, (stays + costs.rerole, audit + "R", i + 1, new[0], (*out, (new, text))))
    raise AssertionError


def _digest(rows):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def _report(rows):
    """What a conversation of (turn, role, text) should come to."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {r[0] for r in rows if r[0] is not None}
    plain = [r[1:] for r in rows]
    faults, initials = _faults(plain), [r[0][:1] for r in plain]
    cost, audit, out = _cheapest(plain)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": _digest(out),
    }


def _conversation(rng, n):
    roles = ["user", "assistant", "system", "tool", "", " ", "uhu", "Su"]
    texts = ["Yes.", "No", "why?", "", " \n", "a.", "b!", "cut", "Fine. "]
    return [(rng.choice([None, *range(n)]), rng.choice(roles[: rng.choice([2, 3, 8])]), rng.choice(texts) + rng.choice(["", f"{i}."])) for i in range(n)]


def _check(spark, conversations):
    rows = [(c, *r) for c, own in conversations.items() for r in own]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cr.audit_conversations(df.withColumnRenamed("conv", "conv_id"), df).collect()
    assert len(got) == len(conversations)
    for r in got:
        row = r.asDict()
        assert {k: row[k] for k in row if k != "conv_id"} == _report(conversations[row["conv_id"]]), row["conv_id"]


def test_random_conversations(spark):
    rng = random.Random(8)
    _check(spark, {i: _conversation(rng, rng.randint(1, 12)) for i in range(150)} | {None: _conversation(rng, 6)})


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations_over_many_blocks(spark, monkeypatch, seed):
    """Blocks of four rows, combined two by two: several rounds up and down."""
    monkeypatch.setattr(cr, "BLOCK", 4)
    monkeypatch.setattr(cr, "FAN", 2)
    rng = random.Random(seed)
    _check(spark, {i: _conversation(rng, n) for i, n in enumerate([1, 3, 4, 5, 9, 17, 40, 120])} | {None: _conversation(rng, 30)})


def test_one_conversation_of_many_rows(spark):
    rng = random.Random(5)
    rows = [(t, rng.choice(["user", "assistant"]), f"Row {t // 2 if t % 9 == 0 else t}{rng.choice('..!?a')}") for t in range(5000)]
    _check(spark, {7: rows, 8: rows[:3]})


def test_repeated_rows(spark):
    _check(spark, {
        1: [(0, "user", "Hi.")] * 5 + [(1, "assistant", "Yes.")] * 3,
        2: [(0, "user", "")] * 4,
        3: [(0, "system", "Be kind.")] * 2 + [(3, "user", "Hi.")] + [(9, "user", "Hi.")] * 2,
        4: [(0, "user", "cut off")] * 2 + [(1, "assistant", "Yes.")],
    })


def test_by_enumeration():
    """The chart against all edits of short conversations, with costs under which rows are inserted too."""
    for costs in (cr.Costs(), cr.Costs(rerole=4, delete=6, insert=1, truncated=2)):
        for initials in product("suax", repeat=3):
            for fault in ("", "truncated", "blank"):
                faults = ["", fault, ""]
                best = None
                for edits in product("DIKR", repeat=3):
                    for inserts in product(range(3), repeat=4):
                        options = [("I" * n) for n in inserts]
                        if "I" in edits or sum(inserts) > 3:
                            continue
                        cost, left = costs.insert * sum(inserts), []
                        for k, e in enumerate(edits):
                            left += ["?"] * inserts[k]
                            cost += {"D": costs.delete, "K": 0, "R": costs.rerole}[e]
                            if e != "D":
                                cost += costs.truncated if faults[k] == "truncated" else 0
                                cost += 1000 if faults[k] == "blank" else 0
                                left.append(initials[k] if e == "K" else "?")
                        left += ["?"] * inserts[3]
                        if cost >= 1000 or not any(GOOD.fullmatch("".join(x)) for x in product(*[("u", "a") if c == "?" else c for c in left])):
                            continue
                        audit = "".join(o + e for o, e in zip(options, edits)) + options[3]
                        best = min(best or (cost, audit), (cost, audit))
                cell = cr.parse([cr.row_cell(i if i in cr.AFTER else "?", f, costs) for i, f in zip(initials, faults)])
                assert min(cell[x] for x in cr.WHOLE if cell[x]) == best, (costs, initials, fault)


def test_costs_must_make_sense():
    with pytest.raises(ValueError):
        cr.Costs(insert=0)


def test_repaired_rows_are_whole_conversations(spark):
    rng = random.Random(3)
    rows = [(i, *r) for i in range(30) for r in _conversation(rng, 9)]
    fixed = cr.repair(spark.createDataFrame(rows, SCHEMA)).rows.collect()
    for conv in range(30):
        own = sorted((r for r in fixed if r.conv == conv), key=lambda r: (r.pos, r.nth))
        assert GOOD.fullmatch("".join(r.role[:1] for r in own))
        kept = {(r[2], r[3]) for r in rows if r[0] == conv}
        assert all((r.role, r.text) in kept for r in own if r.edit == "K")


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.audit_conversations(none.withColumnRenamed("conv", "conv_id"), none).count() == 0


def test_nulls_extra_columns_and_conversations_without_rows(spark):
    rows = [(1, None, None, None, 5, 6), (1, 2, "user", None, 5, 6), (None, None, None, "x", 5, 6), (2, 4, "user", "Hi.", 5, 6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int, cell int")
    clean = cr.clean_rows(df)
    got = {r.conv_id: r for r in cr.audit_conversations(df, clean.where("conv <=> 1")).collect()}
    assert (got[1].blank, got[1].audit, got[1].repaired_sha256) == (2, "DD", _digest([]))
    assert all((got[i].blank, got[i].cost, got[i].audit, got[i].repaired_sha256) == (0, 0, "", _digest([])) for i in (2, None))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    convs, every = {}, set()
    for r in pq.read_table(f"{sf}/conversations.parquet").to_pylist():
        c, turn, role, text = (r[k] for k in ("conv_id", "turn", "role", "text"))
        every.add(c)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        convs.setdefault(c, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    got = {r.conv_id: r.asDict() for r in queries.op13_conversation_repair(spark, sf).collect()}
    assert set(got) == every
    for c, row in got.items():
        assert {k: row[k] for k in row if k != "conv_id"} == _report(convs[c])
