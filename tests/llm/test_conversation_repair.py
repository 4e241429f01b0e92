"""Repair of conversations against a search over all edits, whole tables and odd rows; grammars, ropes and fragments against plain strings."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from peakframe.llm import conversation_repair as R


def edits(turns):
    """(cost, audit) by trying every edit of every turn: turns are (initial, truncated, must go)."""

    def moves(state, initial):
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial != "" and initial in legal

    def forced(state):
        return "a" if state == "u" else "u"

    @cache
    def best(i, state, inserted):
        ways = []
        if inserted < 2:
            cost, audit = best(i, forced(state), inserted + 1)
            ways.append((cost + 5, "I" + audit))
        if i == len(turns):
            return min([*ways, (0, "")]) if state in ("", "a") else min(ways, default=(10**9, ""))
        initial, truncated, gone = turns[i]
        cost, audit = best(i + 1, state, 0)
        ways.append((cost + 2, "D" + audit))
        if not gone:
            cost, audit = best(i + 1, forced(state), 0)
            ways.append((cost + 1 + 5 * truncated, "R" + audit))
            if moves(state, initial):
                cost, audit = best(i + 1, initial, 0)
                ways.append((cost + 5 * truncated, "K" + audit))
        return min(ways)

    for i in range(len(turns), 0, -50):  # from the end, so that recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def brute(rows, damage=True):
    """rows of (conv_id, turn, role, text) -> {conv_id: result}"""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv]
        said = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(said).encode()) % 20 if damage else 9
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        held[conv] += [(turn, "user" if k == 4 else role, text)] * (1 + (k == 3))
    out = {}
    for conv, turns in held.items():
        signed = lambda r, t: ((x := xxh64_intdigest(t.encode(), xxh64_intdigest(r.encode(), 42))) - (1 << 64) * (x >> 63))  # noqa: E731  Spark's xxhash64(role, text)
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), signed(x[1], x[2])))
        seen, faults = set(), []
        for _, role, text in turns:
            visible = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit = edits([(r[:1], f == "truncated", f in ("blank", "duplicate")) for (_, r, _), f in zip(turns, faults, strict=True)])
        lines, state, i = [], "", 0
        for e in audit:
            forced = "assistant" if state == "u" else "user"
            if e == "I":
                lines.append(f"{forced}:")
            else:
                _, role, text = turns[i]
                i += 1
                if e == "D":
                    continue
                lines.append(f"{forced if e == 'R' else role}:{text}")
            state = lines[-1][0]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def got(df):
    assert df.columns == ["conv_id", *R.RESULT, "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def made(n, seed, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "Agent"])
            text = rng.choice(["Yes.", "yes", "No!", "so?  \n", "", " \t", None, "Done. and", "　", f"t{turn}.", f"t{turn}"])
            rows.append((conv, rng.choice([turn, turn * 2, turn // 2, None if rng.random() < 0.2 else turn]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_all_conversations(spark, data):
    df = spark.read.parquet(f"{data}/conversations.parquet")
    assert got(R.op13_conversation_repair(spark, data)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize(("fragment", "damage"), [(R.FRAGMENT, True), (5, False), (2, True)])
def test_odd_turns(spark, fragment, damage):
    rows = made(120, 4) + [(None, t, "user", "One.") for t in (3, None, 3, 9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("piece", F.lit("clash"))
    want = brute(rows, damage)
    assert got(R.repair_conversations(R.damaged(df) if damage else df, df, fragment=fragment)) == want
    assert len({len(x[6]) for x in want.values()}) > 5


def test_one_long_conversation(spark):
    """A conversation over many fragments and ranges, most of it one repeated row."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"{t}.", f"{t}"])) for t in range(150)]
    rows += [(1, 70, "user", "again.")] * 200 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(R.repair_conversations(df, fragment=16)) == brute(rows, False)


def test_empty_tables_and_dropped_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(R.repair_conversations(R.damaged(df), df)) == {}
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert got(R.repair_conversations(R.damaged(df), df)) == {gone: (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())}


def test_grammar_gives_the_least_audits():
    rng = random.Random(2)
    rounds = [["BD", "DB"], ["ĀĀ", "DI"], ["ĂĂ", "āB"], ["ĄĄ"]]
    grammar, plain = R.Grammar(rounds), R.Grammar([])
    for _ in range(1500):
        symbols = [rng.choice([2, 2, 4, 4, 3, 5, 0, 6, 8, 8, 1, 7]) for _ in range(rng.randrange(0, 14))]
        if rng.random() < 0.3:
            symbols = ([rng.choice([3, 1]), rng.choice([1, 3])] * 30)[: rng.randrange(60)]
        text = "".join(chr(65 + s) for s in symbols)
        want = edits([("sua?"[s // 2] if s < 8 else "?", s % 2 if s < 8 else 0, s == 8) for s in symbols])
        assert grammar.edits(text) == plain.edits(text) == want, text


def test_ropes_compare_as_texts():
    rng = random.Random(1)

    def rope(text):
        if len(text) < 2 or rng.random() < 0.2:
            return R.Rope(text)
        k = rng.randrange(1, len(text))
        return R.Rope(None, rope(text[:k]), rope(text[k:]))

    for _ in range(2000):
        a = "".join(rng.choice("DK") for _ in range(rng.randrange(0, 12)))
        b = a[: rng.randrange(0, 12)] + "".join(rng.choice("DK") for _ in range(rng.randrange(0, 4)))
        assert str(rope(a)) == a and R.before(rope(a), rope(b)) == (a < b)


def test_re_pair_names_what_is_common(spark):
    strings = spark.createDataFrame([("CECECECE", 50), ("CECE", 30), ("ACECE", 20), ("III", 1)], "symbols string, n long")
    grammar = R.re_pair(strings)
    assert grammar.rounds[0][0] == "CE" and len(grammar.compressed("CECECECE")) == 1 and len(grammar.compressed("ACECE")) <= 2
    assert R.re_pair(strings.limit(0)).rounds == []
