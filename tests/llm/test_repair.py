import hashlib
import itertools
import random
import re
import zlib

import pytest

from civic_spark.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
FILLED = ("", "u", "a", "ua", "au")
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def enumerated(rows):
    """(cost, audit, output) by trying all edits; rows: (initial, must go, truncated)."""
    options = []
    for initial, gone, cut in rows:
        own = [("D", "", 3)]
        if not gone:
            own += [("K", initial, cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]
        options.append([("I" * len(x) + e, x + o, 2 * len(x) + c) for x in FILLED for e, o, c in own])
    options.append([("I" * len(x), x, 2 * len(x)) for x in FILLED])
    best = None
    for choice in itertools.product(*options):
        if re.fullmatch("(s?(ua)+)?", "".join(o for _, o, _ in choice)):
            found = sum(c for _, _, c in choice), "".join(e for e, _, _ in choice)
            best = min(best or found, found)
    return best


def programmed(rows):
    """The same, from the last row to the first, for longer conversations."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    forced = lambda q: next(x for x in step[q] if x in "ua")
    far = (10 ** 9, "")
    best = {"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}
    for initial, gone, cut in reversed(rows):
        here = {}
        for q in step:
            found = [far]
            at, lead = q, ""
            for _ in range(4):
                moves = [("D", 3, at)]
                if not gone:
                    moves += [("K", cut, step[at][initial])] if initial in step[at] else []
                    moves += [("R", 2 + cut, forced(at))]
                found += [(2 * len(lead) + c + best[r][0], lead + e + best[r][1]) for e, c, r in moves]
                at, lead = forced(at), lead + "I"
            here[q] = min(found)
        best = here
    return best[""]


def symbols(rows):
    return bytes(repair.symbol(i, repair.BLANK if gone else repair.CUT if cut else repair.FINE) for i, gone, cut in rows)


def test_cheapest_against_enumeration():
    rng = random.Random(1)
    for k in range(60):
        rows = [(rng.choice("suaox"), rng.random() < 0.25, int(rng.random() < 0.3)) for _ in range(k % 4)]
        assert programmed(rows) == enumerated(rows)
        assert repair.cheapest(symbols(rows)) == enumerated(rows)


def test_cheapest_on_long_runs():
    rng = random.Random(2)
    for _ in range(150):
        rows = []
        for _ in range(rng.randint(0, 9)):
            rows += [(rng.choice("suao"), rng.random() < 0.2, int(rng.random() < 0.3))] * rng.choice([1, 1, 2, 3, 7, 40])
        assert repair.cheapest(symbols(rows)) == programmed(rows)
    cost, audit = repair.cheapest(symbols([("u", False, 0)]) * 1_000_001)
    assert (cost, len(audit)) == (2 * 500_001, 1_000_001 + audit.count("I"))


def plain(table):
    """{conv_id: every column} by the definition, in plain Python."""
    space = lambda x: " " if x is None else str(x)
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            k = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            role, text = space(role), space(text)
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            role = "user" if k == 4 else role
            rows += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = programmed([(r[1][:1], f in ("blank", "duplicate"), int(f == "truncated")) for r, f in zip(rows, faults)])
        left, kept = iter(rows), []
        assert len(audit.replace("I", "")) == len(rows)
        letters = []
        for letter in audit:
            row = next(left) if letter != "I" else None
            if letter != "D":
                letters.append((letter, row))
        system = bool(letters) and letters[0][0] == "K" and letters[0][1][1][:1] == "s"
        for k, (letter, row) in enumerate(letters):
            role = row[1] if letter == "K" else ("user", "assistant")[(k - system) % 2]
            kept.append(f"{role}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in kept))
        turns = [r[0] for r in rows if r[0] is not None]
        out[conv] = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
                     "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                     "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()}
    return out


def repaired(df):
    rows = repair.damage(df)
    return {r.conv_id: {k: r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")}
            for r in repair.digests(rows, repair.plan_repairs(rows)).collect()}


def odd_rows():
    rng = random.Random(3)
    said = ["Yes.", "Yes.", "No", " ", "", None, "Why?\n\t ", "\x0b", "é…", "a" * 70_000 + "!", "\x85", " ", "end\\"]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", None, "", "User", "ü", "s", "a b"]
    rows = [(c, rng.choice([None, *range(-3, 40)]), rng.choice(roles), rng.choice(said)) for c in [*range(12), None] for _ in range(rng.choice([1, 2, 9, 30]))]
    return rows + [(50, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(300)] + [(51, t, "user", f"turn {t}.") for t in range(300)] + rows[:20]


def test_repair_of_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1, True) for r in rows], f"{SCHEMA}, n string, audit int, gone boolean").repartition(5)
    assert repaired(df) == plain(rows)
    assert repaired(df.limit(0)) == {}


def test_dropped_conversations_and_turns(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)
    assert repaired(df)[conv] == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                                  "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    whole = spark.createDataFrame(odd_rows(), SCHEMA)
    rows = repair.damage(whole)
    plans = repair.plan_repairs(rows)
    turns = repair.repaired_turns(rows, plans).collect()
    want = {r.conv_id: r.repaired_sha256 for r in repair.digests(rows, plans).collect()}
    for c, sha in want.items():
        own = sorted((t.seq, f"{t.role}:{t.text}") for t in turns if t.conv_id == c)
        assert [s for s, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == sha


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_repair_query(spark, sf):
    got = {r.conv_id: r.asDict() for r in queries.op11_conversation_repair(spark, f"/root/testdata/{sf}").collect()}
    rows = [tuple(r) for r in queries.table(spark, f"/root/testdata/{sf}", "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain(rows)
    assert {c: {k: v for k, v in r.items() if k != "conv_id"} for c, r in got.items()} == want
