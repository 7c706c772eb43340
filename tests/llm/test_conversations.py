"""Conversation repair against a plain dynamic program over whole strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from searchlake.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Report of ordered ``(turn, role, text)`` rows: every state keeps its
    best (cost, audit, lines), with one insertion at a time."""
    seen, faults = set(), []
    for _, role, text in rows:
        if not text.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if text.rstrip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]

    # All scripts as a search over (rows used, output state).
    best = {(0, ""): (0, "", ())}

    def put(key, value):
        if key not in best or value < best[key]:
            best[key] = value

    def after(state, letter):
        if letter == "s":
            return "s" if state == "" else None
        return letter if (letter == "u") == (state in ("", "s", "a")) else None

    for i in range(len(rows) + 1):
        for _ in range(3):  # no more insertions in a row can pay
            for state in ("", "s", "u", "a"):
                if (i, state) in best:
                    cost, audit, lines = best[i, state]
                    for letter, name in (("u", "user:"), ("a", "assistant:")):
                        if after(state, letter):
                            put((i, letter), (cost + 3, audit + "I", (*lines, name)))
        if i == len(rows):
            break
        _, role, text = rows[i]
        cut = 3 if faults[i] == "truncated" else 0
        for state in ("", "s", "u", "a"):
            if (i, state) not in best:
                continue
            cost, audit, lines = best[i, state]
            put((i + 1, state), (cost + 4, audit + "D", lines))
            if faults[i] in ("blank", "duplicate"):
                continue
            if role[:1] in ("s", "u", "a") and after(state, role[:1]):
                put((i + 1, role[:1]), (cost + cut, audit + "K", (*lines, f"{role}:{text}")))
            for letter, name in (("u", "user"), ("a", "assistant")):
                if after(state, letter):
                    put((i + 1, letter), (cost + cut + 3, audit + "R", (*lines, f"{name}:{text}")))
    cost, audit, lines = min(best[len(rows), s] for s in ("", "a") if (len(rows), s) in best)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def ordered(rows):
    return sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode())
    )


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return {c: ordered(r) for c, r in out.items()}


def reports(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(n, seed, most=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n", "Yes. ", "a\nb", "é日本.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uncle", "S"]
    return [
        (conv if conv else None, rng.choice([None, 0, 1, 2, 3, 5, 8]) if rng.random() < 0.3 else i, rng.choice(roles), rng.choice(texts))
        for conv in range(n) for i in range(rng.randint(1, most))
    ]


def test_reports_equal_brute_force(spark):
    rows = random_rows(300, 1)
    got = reports(cr.repair(spark.createDataFrame(rows, SCHEMA)))
    assert got == {c: brute(r) for c, r in by_conversation(rows).items()}


def test_brute_force_equals_enumeration():
    """The least audit over all scripts, on short conversations."""
    def scripts(rows, out="", cost=0, audit="", room=3):
        if not rows:
            yield cost, audit, out
        else:
            role, go, cut = rows[0]
            yield from scripts(rows[1:], out, cost + 4, audit + "D", room)
            if not go:
                yield from scripts(rows[1:], out + role, cost + cut, audit + "K", room)
                for letter in "ua":
                    yield from scripts(rows[1:], out + letter, cost + cut + 3, audit + "R", room)
        if room:
            for letter in "ua":
                yield from scripts(rows, out + letter, cost + 3, audit + "I", room - 1)

    grammar, rng = cr.Grammar(), random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.choice([0, 0, 3])) for _ in range(rng.randint(0, 3))]
        want = min((c, a) for c, a, o in scripts(rows) if re.fullmatch("(s?(ua)+)?", o))
        codes = tuple(cr.symbol(r, go, bool(cut)) for r, go, cut in rows)
        assert grammar.solve({codes})[codes] == want


def test_grammar_spells_its_sequences_and_repeats_no_pair():
    rng = random.Random(2)
    sequences = [[rng.choice([0, 5, 7, 7, 5]) for _ in range(rng.randint(0, 40))] for _ in range(80)] + [[3] * 33, [0]]
    grammar = cr.Grammar()
    short = grammar.compress(sequences)
    sides = {code: pair for pair, code in grammar.rules.items()}

    def spell(code):
        return spell(sides[code][0]) + spell(sides[code][1]) if code in sides else [code]

    assert [[x for code in s for x in spell(code)] for s in short] == sequences
    pairs = [p for s in short for p in itertools.pairwise(s) if p[0] != p[1]]
    assert len(pairs) == len(set(pairs))
    assert sum(map(len, short)) < sum(map(len, sequences)) / 2
    # Another text with the same pairs adds no rule for them.
    n = len(grammar.matrices)
    grammar.compress(sequences)
    assert len(grammar.matrices) == n


def test_long_conversations_equal_short_ones(spark):
    """A conversation with most rows of the table, cut at every few rows."""
    rng = random.Random(3)
    rows = random_rows(40, 4) + [
        (7, rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system"]), rng.choice(["Hi.", "cut", "", "So!", "Why? "]) * rng.choice([1, 1, 2]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {c: brute(r) for c, r in by_conversation(rows).items()}
    assert reports(cr.repair(df)) == want
    assert reports(cr.repair(df, most_rows=6)) == want
    assert reports(cr.repair(df, most_bytes=40)) == want
    whole = {tuple(r) for r in cr.repaired_rows(df).collect()}
    assert {tuple(r) for r in cr.repaired_rows(df, most_rows=6).collect()} == whole


def test_repaired_rows_match_the_pattern_and_the_digest(spark):
    rows = random_rows(60, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for r in cr.repaired_rows(df).orderBy("place").collect():
        found.setdefault(r["conv_id"], []).append(r)
    for conv, report in reports(cr.repair(df)).items():
        mine = found.get(conv, [])
        assert [r["place"] for r in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        assert "".join(r["edit"] for r in mine) == report[6].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in mine).encode()).hexdigest() == report[7]


def test_damage_keeps_every_conversation(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}. And!") for c in range(120) for t in range(1 + c % 2)]
    rows += [(None, None, None, None), (500, None, "system", "x.")]
    hurt = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        hurt.setdefault(c, []).extend([(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    assert any(not v for v in hurt.values())
    got = reports(cr.repair(cr.damaged(spark.createDataFrame(rows, SCHEMA)), copies_col="copies"))
    assert got == {c: brute(ordered(v)) for c, v in hurt.items()}
    gone = next(c for c, v in hurt.items() if not v)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("most_rows", [1, 10_000])
def test_odd_rows(spark, most_rows):
    """Clashing columns, a long text, repeated rows, an empty table."""
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 1, "assistant", "ok."), (1, 1, "assistant", "ok."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "copies", "blank", "ended", "chunk", "seq", "fresh", "long", "n", "audit", "place"):
        df = df.withColumn(name, F.lit("clash"))
    got = reports(cr.repair(df, most_rows=most_rows))
    assert got == {c: brute(r) for c, r in by_conversation(rows).items()}
    assert cr.repair(spark.createDataFrame([], SCHEMA), most_rows=most_rows).collect() == []
