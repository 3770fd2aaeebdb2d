"""Conversation repair against a search over all strings of edits, and against a plain forward search on whole tables."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE, SF_SMALL
from textprice.llm import conversations as cv

WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def forward(rows):
    """(cost, audit, lines): the least (cost, audit) over states, edit by edit (a shortest path; strings are kept whole)."""
    kinds = faults(rows)
    best = {"": (0, "", ())}

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                after = "a" if state == "u" else "u"
                new = (cost + 5, audit + "I", (*lines, "assistant:" if after == "a" else "user:"))
                if after not in best or new < best[after]:
                    best[after] = new
        return best

    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}

        def offer(state, new, after=after):
            if state not in after or new < after[state]:
                after[state] = new

        for state, (cost, audit, lines) in inserts(best).items():
            offer(state, (cost + 2, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            more = 5 if kind == "truncated" else 0
            initial, turn = role[:1], "a" if state == "u" else "u"
            if (initial == "s" and state == "") or initial == turn:
                offer(initial, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            given = "user" if turn == "u" else "assistant"
            offer(turn, (cost + more + 1, audit + "R", (*lines, f"{given}:{text}")))
        best = after
    best = inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def everything(rows):
    """(cost, audit) by trying all strings of edits with up to 3 inserts."""
    kinds, found = faults(rows), []
    for n in range(len(rows) + 4):
        for audit in product("DIKR", repeat=n):
            if sum(e != "I" for e in audit) != len(rows) or audit.count("I") > 3:
                continue
            at, choices, cost = 0, [""], 0
            for e in audit:
                if e == "I":
                    choices, cost = [c + x for c in choices for x in "ua"], cost + 5
                    continue
                kind, role, at = kinds[at], rows[at][1], at + 1
                if e == "D":
                    cost += 2
                    continue
                if kind in ("blank", "duplicate"):
                    break
                cost += (5 if kind == "truncated" else 0) + (e == "R")
                choices = [c + x for c in choices for x in (role[:1] if e == "K" else "ua")]
            else:
                if any(re.fullmatch("(s?(ua)+)?", c) for c in choices):
                    found.append((cost, "".join(audit)))
    return min(found)


def report(rows):
    turns = [t for t, _, _ in rows if t is not None]
    kinds = faults(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit, lines = forward(rows)
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


ROLES, TEXTS = ["user", "assistant", "system", "tool", "uncle", "", " "], ["Yes.", "No!", "cut off", "", " \n", "Again?  ", "x" * 50 + "."]


def drawn(rng, n):
    return [(rng.choice([None, 0, 1, 2, 3, 9]) if rng.random() < 0.2 else i, rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES),
             rng.choice(TEXTS[:3] if rng.random() < 0.8 else TEXTS) + (f" {i}." if rng.random() < 0.5 else "")) for i in range(n)]


def test_search_of_whole_strings_equals_forward_search():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", f"{i}."])) for i in range(rng.randint(0, 4))]
        assert everything(rows) == forward(rows)[:2], rows


def as_dict(r, skip="conv_id"):
    return {k: v for k, v in r.asDict().items() if k != skip}


def test_report_equals_forward_search(spark, monkeypatch):
    rng = random.Random(2)
    convs = {c: ordered(drawn(rng, rng.randint(1, 14))) for c in range(120)}
    convs[None] = ordered(drawn(rng, 9))
    convs[500] = ordered([(i, rng.choice(["tool", "tool", "user"]), f"Turn {i}.") for i in range(401)])  # two ways stay open to the end
    rows = [(c, *r, "extra") for c, rs in convs.items() for r in rs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(5)
    got = {r["conv_id"]: as_dict(r) for r in cv.repair_report(df).collect()}
    assert set(got) == set(convs)
    for c, rs in convs.items():
        assert got[c] == report(rs), (c, rs)
    put = {}
    for r in cv.repaired_rows(df).collect():
        put.setdefault(r["conv_id"], []).append((r["position"], f"{r['role']}:{r['text']}", r["edit"]))
    for c, rs in convs.items():
        lines = sorted(put.get(c, []))
        assert [p for p, _, _ in lines] == list(range(len(lines)))
        assert tuple(x for _, x, _ in lines) == forward(rs)[2]
        assert "".join(e for _, _, e in lines) == got[c]["audit"].replace("D", "")


def test_many_blocks_of_one_conversation():
    rng = random.Random(5)
    rows = ordered(drawn(rng, 3000))
    costs, blocks = cv.Costs(1), []
    for (turn, role, _), kind in reversed(list(zip(rows, faults(rows), strict=True))):
        if len(costs.bytes) >= 64:
            blocks.append(bytes(costs.bytes[::-1]))
            costs.bytes = bytearray()
        costs.add(turn, role[:1], ["", "blank", "duplicate", "truncated"].index(kind))
    repair = cv.Repair(1)
    repair.blocks.extend([bytes(costs.bytes[::-1]), *blocks[::-1]])
    for _, role, text in rows:
        repair.row(role, text)
    repair.rest()
    want = report(rows)
    assert repair.audit.decode() == want["audit"]
    assert repair.sha.hexdigest() == want["repaired_sha256"]
    assert costs.facts() == [want[k] for k in cv.FACTS]


def test_costs_stay_in_few_states():
    cv.step.cache_clear()
    rng = random.Random(4)
    costs = cv.Costs(1)
    for i in range(20000):
        costs.add(i, rng.choice(["u", "a", "s", "x"]), rng.randrange(4))
    assert cv.step.cache_info().currsize < 2000


def test_empty_null_and_long(spark):
    schema = "conv_id string, turn long, role string, text string"
    assert cv.repair_report(spark.createDataFrame([], schema)).count() == 0
    assert cv.damage(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, None, None, None), ("a", None, "user", "Long " * 200000 + "."), ("a", 1, "assistant", "Ok.")], schema)
    got = {r["conv_id"]: as_dict(r) for r in cv.repair_report(df).collect()}
    assert got[None] == report([(None, " ", " ")])
    assert got["a"]["audit"] == "KK" and got["a"]["cost"] == 0 and got["a"]["gaps"] == 0


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_equals_forward_search(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    groups = {c: [] for c, *_ in table}
    for c, *r in damaged(table):
        groups[c].append(tuple(r))
    got = {r["conv_id"]: as_dict(r) for r in entry.queries()["op13_conversation_repair"](spark, sf).collect()}
    assert len(got) == len(groups)
    nothing = hashlib.sha256(b"").hexdigest()
    for c, rs in groups.items():
        want = report(ordered(rs)) if rs else {**dict.fromkeys(cv.FACTS, 0), "audit": "", "repaired_sha256": nothing}
        assert got[c] == want, c


def test_conversation_without_rows_after_damage(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(conv, 0, "user", "Hi."), (conv + 1, None, None, None)], "conv_id long, turn long, role string, text string") \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in entry.queries()["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert set(got) == {conv, conv + 1}
    assert got[conv]["audit"] == "" and got[conv]["cost"] == 0
    assert got[conv]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
