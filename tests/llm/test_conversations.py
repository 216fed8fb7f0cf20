"""Repairs against all edits of short conversations, against a table of best prefixes of long ones, and on odd rows."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from careloom.llm import conversations, queries
from tests.conftest import SMALL

LEGAL = re.compile(r"(s?(ua)+)?")


def all_edits(initials, faults):
    """Every way to edit, with up to two inserts before each row and at the end."""
    inserts = [("", 0, "")] + [("I" * n, 5 * n, "".join(c)) for n in (1, 2) for c in itertools.product("ua", repeat=n)]
    for places in itertools.product(inserts, repeat=len(initials) + 1):
        choices = []
        for initial, fault in zip(initials, faults):
            own = [("D", 2, "")]
            if fault in "-t":
                extra = 5 if fault == "t" else 0
                own += [("K", extra, initial), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
            choices.append(own)
        for chosen in itertools.product(*choices):
            audit, cost, roles = places[-1]
            for (a, c, r), (ia, ic, ir) in zip(reversed(chosen), reversed(places[:-1])):
                audit, cost, roles = ia + a + audit, ic + c + cost, ir + r + roles
            if LEGAL.fullmatch(roles):
                yield cost, audit


def best_prefixes(initials, faults):
    """The least (cost, audit) of each state, row by row."""
    after = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}

    def inserted(states):
        for _ in range(4):
            for s, (c, a) in list(states.items()):
                states[after[s][1]] = min(states.get(after[s][1], (10**9, "")), (c + 5, a + "I"))
        return states

    states = inserted({0: (0, "")})
    for initial, fault in zip(initials, faults):
        new = {}
        for s, (c, a) in states.items():
            ways = [(s, c + 2, "D")]
            if fault in "-t":
                c += 5 if fault == "t" else 0
                if initial == after[s][0]:
                    ways.append((after[s][1], c, "K"))
                if initial == "s" and s == 0:
                    ways.append((1, c, "K"))
                ways.append((after[s][1], c + 1, "R"))
            for to, cost, letter in ways:
                new[to] = min(new.get(to, (10**9, "")), (cost, a + letter))
        states = inserted(new)
    return min(states[s] for s in (0, 3) if s in states)


@pytest.mark.parametrize("initials", [p for n in range(3) for p in itertools.product("suax", repeat=n)], ids="".join)
def test_cheapest_of_all_edits(initials):
    for faults in itertools.product("-tb", repeat=len(initials)):
        assert conversations.cheapest("".join(initials), "".join(faults))[:2] == min(all_edits(initials, faults))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suuaax"), st.sampled_from("---tbd")), max_size=40))
def test_cheapest_of_long_ones(rows):
    initials, faults = "".join(r[0] for r in rows), "".join(r[1] for r in rows)
    assert conversations.cheapest(initials, faults)[:2] == best_prefixes(initials, faults)


SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("audit", T.StringType()), T.StructField("part", T.LongType()),
])


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            yield from [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)


def expected(rows):
    """The contract's columns, one conversation after the other."""
    out = {}
    after = sorted(damage(rows), key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    for conv in {r[0] for r in rows}:
        own, seen, faults = [r for r in after if r[0] == conv], set(), ""
        for _, _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            faults += "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "-"
            seen.add((role, text))
        initials = "".join(r[2][:1] or " " for r in own)
        cost, audit = best_prefixes(initials, faults)
        left, row, place = [], 0, 0
        wanted = "s" if any(a == "K" and i == "s" for a, i in zip(audit.replace("I", ""), initials)) else ""
        for letter in audit:
            name = "" if letter == "D" else "system" if wanted and not place else ("user", "assistant")[(place - len(wanted)) % 2]
            if letter == "I":
                left.append(f"{name}:")
            elif letter != "D":
                left.append(f"{own[row][2] if letter == 'K' else name}:{own[row][3]}")
            place += letter != "D"
            row += letter != "I"
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def odd_rows():
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(700)]
    rows += [(2, t, r, "Same.") for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(3, None, None, None), (3, None, "user", "Hello."), (3, 5, "assistant", ""), (3, 9, "tool", "data"), (3, 9, "", "no role.")]
    rows += [(None, 1, "user", "Hi!"), (None, 2, "assistant", "x" * 100000), (None, None, "assistant", "end.")]
    rows += [(4, 0, "user", "again.")] * 300 + [(4, 1, "assistant", "yes.")] * 2
    rows += [(k, t, r, f"{k} {t} é.") for k in range(5, 40) for t, r in enumerate(["system", "user", "assistant", "assistant"])]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    got = found(conversations.Repairs(conversations.damaged(df)).summary())
    assert got == {k: v for k, v in expected(rows).items() if k in got}
    assert {k for k, v in expected(rows).items() if v[6]} <= set(got)


def test_turns_are_what_the_digest_says(spark):
    repairs = conversations.Repairs(conversations.damaged(spark.createDataFrame([(*r, "x", 7) for r in odd_rows()], SCHEMA)))
    lines = {}
    for r in sorted(repairs.turns().collect(), key=lambda r: (r["part"], r["seq"], r["place"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in found(repairs.summary()).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    repairs = conversations.Repairs(conversations.damaged(none))
    assert repairs.summary().collect() == [] and repairs.turns().collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_conversation_repair(spark, SMALL)) == expected(rows)


def test_query_has_every_conversation(spark, tmp_path):
    rows = [(k, 0, "user", "One.") for k in range(200)]
    spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(queries.op12_conversation_repair(spark, str(tmp_path))) == expected(rows)
