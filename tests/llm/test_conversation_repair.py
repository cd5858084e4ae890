"""Conversation repair against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from quire.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, row string, part string, costs int"
GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_repair(rows, faults):
    """Cheapest (cost, audit, lines) by dynamic programming over all edits, with the edited lines carried along."""
    best = {0: (0, "", ())}

    def inserts(best):
        for _ in range(3):
            for s, (c, a, lines) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    t = GRAMMAR.get((s, letter))
                    if t is not None:
                        best[t] = min(best.get(t, (10**9,)), (c + 3, a + "I", (*lines, role + ":")))
        return best

    for (role, text), fault in zip(rows, faults):
        after = {}
        for s, (c, a, lines) in inserts(best).items():
            ways = [(s, c + 4, a + "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if (s, role[:1]) in GRAMMAR:
                    ways.append((GRAMMAR[s, role[:1]], c + more, a + "K", (*lines, f"{role}:{text}")))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if (s, letter) in GRAMMAR:
                        ways.append((GRAMMAR[s, letter], c + 3 + more, a + "R", (*lines, f"{name}:{text}")))
            for t, *way in ways:
                after[t] = min(after.get(t, (10**9,)), tuple(way))
        best = after
    return min(v for s, v in inserts(best).items() if s in (0, 3))


def plain_digests(rows):
    """The contract in plain Python over ``(conv_id, turn, role, text)`` rows (ties of a turn: by role only)."""
    out, groups = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        known, seen, faults = [t for t, _, _ in turns if t is not None], set(), []
        for _, role, text in turns:
            marks = WORD.findall(text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in turns]
        cost, audit, lines = plain_repair([r[1:] for r in turns], faults)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def digests(frame, **options):
    return {r[0]: tuple(r[1:]) for r in cr.repair_digests(frame, **options).collect()}


def test_search_equals_brute_force_and_segments_compose():
    rng = random.Random(5)
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for _ in range(800):
        classes = "".join(rng.choice("suaxSUAXDuauaua") for _ in range(rng.randint(0, 14)))
        rows = [("user" if c == "D" else names[c.lower()], "t") for c in classes]
        faults = ["blank" if c == "D" else "truncated" if c in "SUAX" else None for c in classes]
        want = plain_repair(rows, faults)
        assert cr.whole_repair(classes) == want[:2], classes
        cuts = sorted(rng.randint(0, len(classes)) for _ in range(rng.randint(1, 4)))
        parts = [classes[a:b] for a, b in zip([0, *cuts], [*cuts, len(classes)])]
        solved = [cr.segment_repairs(p) for p in parts]
        chain = cr.cheapest_chain(solved)
        audit = "".join(a[4 * e + x] for (_, a), (e, x) in zip(solved, chain)) + "I" * (cr.CLOSE[chain[-1][1]] // cr.INSERT)
        assert audit == want[1], (classes, cuts)
        assert tuple(f"{r}:{t}" for _, r, t in cr.repaired_rows(0, audit, *zip(*rows))) == want[2] if rows else audit == ""


def test_long_runs_stay_linear():
    rng, took = random.Random(1), []
    for n in (1000, 4000):
        began = time.perf_counter()
        for alphabet in ("s", "x", "D", "u", "suaxSUAXD", "ssssu", "sD"):
            cr.whole_repair("".join(rng.choice(alphabet) for _ in range(n)))
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 1 and took[1] < 30


def conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "", " ", "cut off", "cut off ", "Why?", "One. Two.", "é. ", None, "a.\n", "longer text " * 30 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for conv in [*range(150), None, -7]:
        n, turn = rng.choice([0, 1, 2, 3, 5, 8, 12]), 0
        for _ in range(n):
            turn += rng.choice([1, 1, 1, 2, 5])
            rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts) or None))
    for t in range(700):  # one conversation with a third of all rows
        rows.append((1000, t, ["user", "assistant", "system"][t % 3 if t % 50 == 0 else t % 2], f"turn {t}." if t % 7 else "again."))
    rows += [(1001, 1, "user", "same.")] * 90
    rows.append((1002, 5, "user", "x" * 200_000 + "."))
    return rows


def test_query_equals_plain_python(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA).repartition(5)
    want = plain_digests(rows)
    assert len({r[0] for r in rows}) == len(want)
    for options in ({}, {"segment_rows": 7}):
        assert digests(frame, **options) == want
    assert cr.repair_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_turns_are_well_formed(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)
    turns = cr.repaired_turns(cr.damaged(frame)).collect()
    initials, lines = defaultdict(str), defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.part, r.run, r.position)):
        initials[r.conv_id] += r.role[:1]
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
    want = plain_digests(rows)
    assert all(hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() == want[c][-1] for c in want)
