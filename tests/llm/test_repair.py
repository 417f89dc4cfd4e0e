"""Conversation repair against exhaustive search and a plain string version."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from martlet.llm import repair as R
from martlet.llm.catalog import QUERIES
from martlet.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, digest string, n int, fault string, task int"
WELL = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    """(initial, must go, truncated, fault) of (turn, role, text) rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        ended = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated", fault))
    return out


def search(faults):
    """Every edit sequence with at most three inserts at a place."""
    best = None
    row_edits = []
    for initial, go, cut, _ in faults:
        edits = [("D", 4, "")]
        if not go:
            edits += [("K", 3 * cut, initial or "-"), ("R", 3 + 3 * cut, "u"), ("R", 3 + 3 * cut, "a")]
        row_edits.append(edits)
    gaps = [[("I" * n, 3 * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)]] * (len(faults) + 1)
    slots = [gaps[0]]
    for edits in row_edits:
        slots += [edits, gaps[0]]
    for choice in itertools.product(*slots):
        if WELL.fullmatch("".join(r for _, _, r in choice)):
            found = (sum(c for _, c, _ in choice), "".join(e for e, _, _ in choice))
            best = min(best, found) if best else found
    return best


def by_strings(faults):
    """The dynamic program with whole strings."""
    add = lambda x, cost, letter: (x[0] + cost, x[1] + letter)
    state = {"": (0, "")}

    def insert():
        for into, sources in (("u", ("", "s", "a")), ("a", ("u",))):
            options = [add(state[s], 3, "I") for s in sources if s in state] + ([state[into]] if into in state else [])
            if options:
                state[into] = min(options)

    for initial, go, cut, _ in faults:
        insert()
        new = {s: [add(x, 4, "D")] for s, x in state.items()}
        if not go:
            for role in "sua":
                for s in {"s": ("",), "u": ("", "s", "a"), "a": ("u",)}[role]:
                    if s in state:
                        if role == initial:
                            new.setdefault(role, []).append(add(state[s], 3 * cut, "K"))
                        if role != "s":
                            new.setdefault(role, []).append(add(state[s], 3 + 3 * cut, "R"))
        state = {s: min(x) for s, x in new.items()}
    insert()
    return min(state[s] for s in ("", "a") if s in state)


def repaired(rows, audit):
    lines, i = [], 0
    kept = len(audit.replace("D", ""))
    roles = ["assistant", "user"]
    for edit in audit:
        k = len(lines) + 1 - kept % 2
        if edit == "K":
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        elif edit != "D":
            lines.append(f"{roles[k % 2]}:" + ("" if edit == "I" else rows[i][2]))
        i += edit != "I"
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def result(rows, best=by_strings):
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = best(faults)
    counts = [sum(f[3] == k for f in faults) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
    return (gaps, *counts, illegal, cost, audit, repaired(rows, audit))


def in_order(rows):
    """Rows of one conversation, nulls as one space."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def brute(rows):
    return {conv: result(in_order(mine)) for conv, mine in grouped(rows).items()}


def got(df):
    rows = df.collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    out = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_string_version_is_least():
    rng = random.Random(7)
    for _ in range(150):
        faults = [(rng.choice(["s", "u", "a", "a", "u", "x", ""]), rng.random() < 0.2, rng.random() < 0.2, "") for _ in range(rng.randrange(0, 4))]
        assert by_strings(faults) == search(faults)


@pytest.mark.parametrize("split", [1, 2, 3, 1000])
def test_blocks_of_any_length(split):
    rng = random.Random(split)
    for n in [*range(8), 40, 300]:
        for _ in range(12):
            faults = [(rng.choice("suuaax"), rng.random() < 0.15, rng.random() < 0.15) for _ in range(n)]
            audit = R.Audit()
            for at in range(0, n, split):
                audit.block(R.block_moves(faults[at : at + split], tuple(R.STATES)))
            assert audit.end() == by_strings([(*f, "") for f in faults])


def test_prefixes_compare_as_strings(monkeypatch):
    rng = random.Random(1)

    def tree():
        p = R.Prefixes()
        nodes, texts = [p.root()], [""]
        for _ in range(400):
            i = rng.randrange(max(0, len(nodes) - 30), len(nodes)) if rng.random() < 0.9 else rng.randrange(len(nodes))
            letter = rng.choice("DI")
            nodes.append(p.add(nodes[i], letter))
            texts.append(texts[i] + letter)
        return p, nodes, texts

    def check():
        p, nodes, texts = tree()
        assert [p.text(n) for n in nodes] == texts
        for _ in range(3000):
            i, j = rng.randrange(len(nodes)), rng.randrange(len(nodes))
            assert p.less(nodes[i], nodes[j]) == (texts[i] < texts[j]), (texts[i], texts[j])

    check()
    monkeypatch.setattr(R, "_MODULUS", 5)  # nearly every hash collides
    check()
    monkeypatch.setattr(R, "_MODULUS", 1)
    check()


def random_rows(rng, convs, most):
    texts = ["Yes.", "No", "", " \t\n", "why? ", "long answer!", None, "é.", "x\x0b", " "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, most)):
            turn = rng.choice([t, t, t, t + 1, None]) if rng.random() < 0.3 else t
            rows.append((c, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 3, "f", 9) for r in rows], SCHEMA)


def test_random_conversations(spark):
    rows = random_rows(random.Random(3), [*range(40), None], 12)
    df = frame(spark, rows + rows[:30]).repartition(5)
    assert got(R.repair(df)) == brute(rows + rows[:30])


def test_long_conversations_over_many_tasks(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"t{t}.", f"t{t}", ""])) for t in range(9_000)]
    rows += [(0, 5, "system", "a."), (2, 1, "user", "b.")] + [(3, 7, "user", "again.")] * 5_000
    want = brute(rows)
    assert got(R.repair(frame(spark, rows).repartition(6))) == want
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(R.repair(frame(spark, rows).repartition(6))) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@lru_cache(maxsize=None)
def kind(conv, turn):
    text = ":".join(" " if x is None else str(x) for x in (conv, turn))
    return zlib.crc32(text.encode()) % 20


def damage(rows):
    for conv, turn, role, text in rows:
        k = kind(conv, turn)
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub(r"[.!?]", "", text)
        for _ in range({0: 0, 3: 2}.get(k, 1)):
            yield conv, turn, "user" if k == 4 else role, text


def damaged_brute(rows):
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {c: nothing for c, *_ in rows} | brute(list(damage(rows)))


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_repair"](spark, SF)) == damaged_brute(rows)


def test_damage_of_odd_rows(spark):
    rows = random_rows(random.Random(5), [*range(60), None, -3], 9)
    alone = next((c, t) for c in range(1000, 2000) for t in range(3) if kind(c, t) == 0)
    rows.append((*alone, "user", "gone."))
    df = frame(spark, rows)
    out = got(R.repair(R.damaged(df), ids=df.select("conv_id")))
    assert out == damaged_brute(rows) and out[alone[0]][6] == ""


def test_empty_table_and_other_names(spark):
    empty = frame(spark, [(1, 1, "user", "x.")]).where("false")
    assert R.repair(R.damaged(empty), ids=empty.select("conv_id")).count() == 0
    named = frame(spark, [(1, 1, "user", "x.")]).selectExpr("'c' as `conv.id`", "turn as t", "role as r", "text as x", "1 as conv_id")
    row = R.repair(named, None, "conv.id", "t", "r", "x").first()
    assert (row.conv_id, row.audit, row.cost) == ("c", "KI", 3)
