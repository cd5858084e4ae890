"""Conversation structure repair by depth-first branch-and-bound (operator 13).

A conversation is well formed if its turns are no turn at all, or an optional system turn and then user and assistant
turns in pairs: the role initials match ``(s?(ua)+)?``. Edits of a turn: Keep costs 0, Rerole to user or assistant 3,
Delete 4; Insert of an empty user or assistant turn costs 3 anywhere. Blank turns and turns whose role and text came
before must be deleted; a truncated turn that stays costs 3 more. The repair is the cheapest list of edits and, among
the cheapest, the one whose initials (``D I K R``) are least in ASCII order.

**Search** (``branch_and_bound``). A node is (turns read, state of the grammar). An explicit stack holds open prefixes;
suffix lower bounds (the turns' own faults and the alternation of users and assistants) cut prefixes that cannot beat the incumbent (cost, audit); a table per node keeps the best prefix that reached it and
drops later, worse ones. The stack is empty when the incumbent is proved optimal. Equal costs compare by the audit:
an audit tells its cost, so of two prefixes of equal cost at a node none begins the other and order is kept by
whatever follows.

**Scale.** Rows are range-sorted by (conversation, turn, role, text hash), so a conversation that holds a third of all
rows lies in many partitions. Each task reads its rows as a stream and cuts them into segments of at most
``SEGMENT_ROWS`` rows and ``SEGMENT_BYTES`` bytes. A segment that is a whole conversation is solved at once. Other
segments are solved from every entry state to every exit state, and their small records (no texts) are folded in order
per conversation: cheapest chains of states, ties by audit, exactly as if the conversation were one. Inserts stand
before a turn, the last ones at the conversation's end, so cutting changes no audit. Only a hash over a conversation's
repaired text, which no engine can split, reads its pieces in one stream of bounded memory.
Whether a turn's role and text came before is one partial aggregation; its result travels as a marker row (no text)
that the sort places before the first such turn, so no hot text is joined.

Cases: a null role or text is one space (blank, so deleted); a null turn sorts first and does not count for gaps; a
null id is one conversation; turns of equal number are ordered by role, then by a hash of the text; a role with another
or no initial can be reroled or deleted only; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import partition_id, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SEGMENT_ROWS, SEGMENT_BYTES = 1024, 8 << 20
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

#: States of the grammar: nothing yet, after system, after user, after assistant. Cost of closing a conversation there.
START, SYSTEM, USER, ASSISTANT = range(4)
CLOSE = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
NEVER = 1 << 40
#: A turn's class: its role's initial (x: neither of the three), in upper case if truncated; D if it has to go.
MUST_GO = "D"


def _next_turn(state: int) -> int:
    """The state after the one inserted or reroled turn that the grammar allows."""
    return ASSISTANT if state == USER else USER


def _kept(kind: str, state: int) -> int | None:
    """The state after keeping a turn of this class, or None where the grammar forbids it."""
    if kind in "uU":
        return None if state == USER else USER
    if kind in "aA":
        return ASSISTANT if state == USER else None
    return SYSTEM if kind in "sS" and state == START else None


def suffix_bounds(classes: str, ends: dict[int, int]) -> list[list[int]]:
    """Per state, lower bounds on the cost of the turns from i on and of the end.

    Users and assistants have to alternate, turns that must go are deleted and truncated ones pay; relaxed is that a
    conversation of which everything is deleted may count as one that had an assistant turn.
    """
    n = len(classes)
    user, assistant = [NEVER] * (n + 1), [NEVER] * (n + 1)
    system, start = [NEVER] * (n + 1), [NEVER] * (n + 1)
    user[n], assistant[n] = ends.get(ASSISTANT, NEVER), ends.get(USER, NEVER)
    system[n] = min(user[n], ends.get(SYSTEM, NEVER))
    start[n] = min(user[n], ends.get(START, NEVER))
    for i in range(n - 1, -1, -1):
        kind = classes[i]
        extra = TRUNCATED if kind in "SUAX" else 0
        u, a = DELETE + user[i + 1], DELETE + assistant[i + 1]
        if kind != MUST_GO:
            u = min(u, (KEEP if kind in "uU" else REROLE) + extra + assistant[i + 1])
            a = min(a, (KEEP if kind in "aA" else REROLE) + extra + user[i + 1])
        user[i], assistant[i] = min(u, INSERT + a), min(a, INSERT + u)
        system[i] = min(DELETE + system[i + 1], user[i])
        start[i] = min(DELETE + start[i + 1], user[i], KEEP + extra + system[i + 1] if kind in "sS" else NEVER)
    return [start, system, assistant, user]


def branch_and_bound(classes: str, entry: int, ends: dict[int, int]) -> tuple[int, str, int] | None:
    """Cheapest (cost, audit, exit state) over a run of turns; ``ends`` names the exit states and the cost of each.

    The audit covers the turns and the inserts before them; the cost includes that of the end.
    """
    n = len(classes)
    bounds = suffix_bounds(classes, ends)
    incumbent: tuple[int, str, int] | None = None
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if incumbent is not None:
            reach = cost + bounds[state][i]
            if reach > incumbent[0] or reach == incumbent[0] and audit > incumbent[1][: len(audit)]:
                continue
        known = best.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        best[i, state] = (cost, audit)
        if i == n:
            if state in ends:
                total = (cost + ends[state], audit, state)
                if incumbent is None or total < incumbent:
                    incumbent = total
            continue
        kind, branches = classes[i], [(i, _next_turn(state), cost + INSERT, audit + "I")]
        branches.append((i + 1, state, cost + DELETE, audit + "D"))
        if kind != MUST_GO:
            extra = TRUNCATED if kind in "SUAX" else 0
            branches.append((i + 1, _next_turn(state), cost + REROLE + extra, audit + "R"))
            kept = _kept(kind, state)
            if kept is not None:
                branches.append((i + 1, kept, cost + KEEP + extra, audit + "K"))
        # the most promising branch lies on top: least bound, then least letter
        branches = [(b[2] + bounds[b[1]][b[0]], b[3][-1], b) for b in branches]
        stack += [b for reach, _, b in sorted(branches, reverse=True) if reach < NEVER]
    return incumbent


def whole_repair(classes: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return _short_repair(classes) if len(classes) <= 64 else _search_whole(classes)


def _search_whole(classes: str) -> tuple[int, str]:
    cost, audit, state = branch_and_bound(classes, START, CLOSE)
    return cost, audit + "I" * (CLOSE[state] // INSERT)


_short_repair = lru_cache(maxsize=1 << 16)(_search_whole)


def segment_repairs(classes: str) -> tuple[list[int], list[str]]:
    """Cost and audit from each entry state to each exit state (entry-major); cost -1 where there is no way."""
    costs, audits = [], []
    for entry in range(4):
        for leave in range(4):
            found = branch_and_bound(classes, entry, {leave: 0})
            costs.append(-1 if found is None else found[0])
            audits.append("" if found is None else found[1])
    return costs, audits


def cheapest_chain(records: Iterable[tuple[list[int], list[str]]]) -> list[tuple[int, int]]:
    """(entry, exit) of every segment on the cheapest way through a conversation, ties by audit.

    Per boundary and state the cheapest chain is kept with the rank of its audit among the states'; audits of chains
    that end at the same boundary never begin one another, so ranks and then the new pieces decide. What stays of a
    segment are four back pointers.
    """
    cost, rank = [0, NEVER, NEVER, NEVER], [0, 0, 0, 0]
    back = bytearray()
    for costs, audits in records:
        chains = []
        for leave in range(4):
            ways = [(cost[s] + costs[4 * s + leave], rank[s], audits[4 * s + leave], s)
                    for s in range(4) if cost[s] < NEVER and costs[4 * s + leave] >= 0]
            chains.append(min(ways, default=(NEVER, 0, "", 0)))
        back += bytes(c[3] for c in chains)
        order = sorted(range(4), key=lambda s: chains[s][1:3])
        cost, rank = [c[0] for c in chains], [order.index(s) for s in range(4)]
    state = min((s for s in range(4) if cost[s] < NEVER), key=lambda s: (cost[s] + CLOSE[s], rank[s]))
    chain = []
    for k in range(len(back) // 4 - 1, -1, -1):
        entry = back[4 * k + state]
        chain.append((entry, state))
        state = entry
    return chain[::-1]


def repaired_rows(entry: int, audit: str, roles: list[str], texts: list[str]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves, from a given state on."""
    out, at, state = [], 0, entry
    for edit in audit:
        if edit == "I":
            state = _next_turn(state)
            out.append((edit, "assistant" if state == ASSISTANT else "user", ""))
            continue
        role, text = roles[at], texts[at]
        at += 1
        if edit == "R":
            state = _next_turn(state)
            out.append((edit, "assistant" if state == ASSISTANT else "user", text))
        elif edit == "K":
            state = _kept(role[:1], state)
            out.append((edit, role, text))
    return out


# ------------------------------------------------------------------------------------------------ rows to segments


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: the damage that the query repairs, by CRC-32 of ``conv_id:turn``.

    Remainder 0 of 20 drops the row (kept here without text, flagged), 1 empties its text, 2 removes its end marks,
    3 repeats it, 4 sets its role to user.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy")).drop("copy")


def _last_mark(text: Column) -> Column:
    return F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)


_SEGMENT = [
    *[(c, T.LongType()) for c in ("part", "run")], ("whole", T.BooleanType()),
    *[(c, T.LongType()) for c in ("n", "blank", "duplicate", "truncated", "illegal")],
    *[(c, T.StringType()) for c in ("first_role", "last_role")],
    *[(c, T.LongType()) for c in ("first_turn", "last_turn", "turns")],
    ("costs", T.ArrayType(T.LongType())), ("audits", T.ArrayType(T.StringType())), ("sha256", T.StringType()),
    ("roles", T.ArrayType(T.StringType())), ("texts", T.ArrayType(T.StringType())),
]


def segments(turns: DataFrame, keep_turns: bool = False, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Solved segments of ``(conv_id, turn, role, text, dropped)``, a written table.

    ``costs`` and ``audits`` have one entry for a whole conversation, else 16. Roles and texts are kept for parts of
    conversations, or for all with ``keep_turns``.
    """
    spark = turns.sparkSession
    rows = written(turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "dropped",
        F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("h1"), F.hash("role", "text").alias("h2")), "turns")
    # the first row of every role and text: least turn (null first), then the least row
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row")).alias("m")
    markers = rows.where(~F.col("dropped")).groupBy("conv_id", "role", "h1", "h2").agg(first).select(
        "conv_id", F.col("m.turn").alias("turn"), "role", F.lit(None).cast("string").alias("text"), F.lit(False).alias("dropped"),
        F.col("m.row").alias("row"), "h1", "h2", F.lit(True).alias("marker"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "h1", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        rows.withColumn("marker", F.lit(False)).unionByName(markers)
        .repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("marker").desc())
        .select("conv_id", "turn", "role", "text", "dropped", "marker", _last_mark(F.col("text")).alias("mark"))
    )
    schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *[T.StructField(c, t) for c, t in _SEGMENT]])
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = partition_id(), 0
        head, out, held = True, [], 0
        for conv_id, run, whole_end in _runs(batches, segment_rows, segment_bytes):
            # the first and the last conversation of a partition may go on in its neighbours
            whole = not head and whole_end == "all"
            head = head and whole_end == "part"
            record = _solved(run, whole, keep_turns)
            out.append({"conv_id": conv_id, "part": part, "run": done, **record})
            done += 1
            held += run.size
            if len(out) >= 4096 or held > segment_bytes:
                yield pa.RecordBatch.from_pylist(out, schema=kinds)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return written(placed.mapInArrow(solve, schema), "segments")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class _Run:
    """Consecutive rows of one conversation."""

    __slots__ = ("turns", "roles", "texts", "classes", "counts", "size")

    def __init__(self) -> None:
        self.turns: list = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.classes: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.size = 0

    def add(self, turn: int | None, role: str, text: str, mark: str, first: bool) -> None:
        fault = "blank" if not mark else "duplicate" if not first else "truncated" if mark not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
        self.classes.append(MUST_GO if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text) + 64


def _runs(batches: Iterator[pa.RecordBatch], max_rows: int, max_bytes: int) -> Iterator[tuple[object, _Run, str]]:
    """(id, rows, ``all`` | ``part`` | ``end``): all rows of an id as far as the task sees them, a part with more to
    follow here, or the end of a conversation that had parts. The last conversation of a task counts as a part."""
    current, run, cut, first = None, None, False, False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped", "marker", "mark")]
        for conv_id, turn, role, text, dropped, marker, mark in zip(*columns, strict=True):
            if run is None or conv_id != current:
                if run is not None:
                    yield current, run, "end" if cut else "all"
                current, run, cut, first = conv_id, _Run(), False, False
            if marker:
                first = True
            elif not dropped:
                if len(run.classes) >= max_rows or run.size > max_bytes:
                    yield current, run, "part"
                    run, cut = _Run(), True
                run.add(turn, role, text, mark, first)
                first = False
    if run is not None:
        yield current, run, "part"


def _solved(run: _Run, whole: bool, keep_turns: bool) -> dict:
    classes, known = "".join(run.classes), [t for t in run.turns if t is not None]
    initials = [r[:1] for r in run.roles]
    record = {
        "whole": whole, "n": len(classes), **run.counts,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "first_role": initials[0] if initials else None, "last_role": initials[-1] if initials else None,
        "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None, "turns": len(set(known)),
        "sha256": None, "roles": None, "texts": None,
    }
    if whole:
        cost, audit = whole_repair(classes)
        rows = repaired_rows(START, audit, run.roles, run.texts)
        record |= {"costs": [cost], "audits": [audit], "sha256": _sha(rows)}
    else:
        record["costs"], record["audits"] = segment_repairs(classes)
    if keep_turns or not whole:
        record |= {"roles": run.roles, "texts": run.texts}
    return record


def _lines(rows: list[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in rows)


def _sha(rows: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256(_lines(rows).encode()).hexdigest()


# ------------------------------------------------------------------------------------------------ segments to repairs


def _in_order(parts: DataFrame) -> DataFrame:
    """A conversation's segments in one task, one after the other; their number is its rows over ``SEGMENT_ROWS``."""
    return parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "run")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """Rows of a stream grouped by ``conv_id``, each group read as it comes."""
    from itertools import groupby

    rows = (r for b in batches for r in b.to_pylist())
    return groupby(rows, key=lambda r: (r["conv_id"],))


def placed_segments(solved: DataFrame) -> DataFrame:
    """The segments of divided conversations with their ``entry`` state, ``audit``, ``cost`` and ``closing`` inserts."""
    divided = solved.where(~F.col("whole"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            places: list[tuple[int, int]] = []

            def records():
                for r in rows:
                    places.append((r["part"], r["run"]))
                    yield r["costs"], r["audits"]

            chain = cheapest_chain(records())
            last = len(chain) - 1
            for at in range(0, len(chain), 4096):
                yield pa.RecordBatch.from_pylist(
                    [{"part": places[k][0], "run": places[k][1], "entry": chain[k][0], "leave": chain[k][1], "is_last": k == last}
                     for k in range(at, min(at + 4096, len(chain)))], schema=chosen)

    chosen = pa.schema([("part", pa.int64()), ("run", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("is_last", pa.bool_())])
    ways = _in_order(divided.select("conv_id", "part", "run", "costs", "audits")).mapInArrow(
        fold, "part long, run long, entry int, leave int, is_last boolean")
    at = F.col("entry") * 4 + F.col("leave") + 1
    closing = F.when(F.col("is_last") & F.col("leave").isin(SYSTEM, USER), F.when(F.col("leave") == USER, 1).otherwise(2)).otherwise(0)
    return divided.join(ways, ["part", "run"]).select(
        *divided.columns, "entry", closing.alias("closing"),
        F.concat(F.element_at("audits", at), F.repeat(F.lit("I"), closing)).alias("audit"),
        (F.element_at("costs", at) + closing * INSERT).alias("cost"))


def digests(solved: DataFrame) -> DataFrame:
    """One row per conversation: fault counts, cost, audit and the hash of its repaired text."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([solved.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in counts],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    whole = solved.where("whole").select(
        "conv_id", F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *counts[1:5], F.element_at("costs", 1).alias("cost"), F.element_at("audits", 1).alias("audit"), F.col("sha256").alias("repaired_sha256"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.select([c for c in batch.schema.names if c not in ("roles", "texts")])
            pieces = [_lines(repaired_rows(r["entry"], r["audit"], r["roles"], r["texts"])) for r in batch.to_pylist()]
            yield cut.append_column("lines", pa.array(pieces, pa.string()))

    pieces = placed_segments(solved).drop("whole", "costs", "audits", "sha256")
    pieces = pieces.mapInArrow(lines, T.StructType([*[f for f in pieces.schema if f.name not in ("roles", "texts")], T.StructField("lines", T.StringType())]))
    names = [f.name for f in schema]
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv_id,), rows in _groups(batches):
            total = dict.fromkeys(counts, 0)
            digest, audits, last_role, turn, first_turn, some = hashlib.sha256(), [], None, None, None, False
            for r in rows:
                for c in counts[1:]:
                    total[c] += r[c]
                if r["n"]:
                    total["illegal"] += last_role is not None and last_role + r["first_role"] not in ("su", "ua", "au")
                    last_role = r["last_role"]
                if r["turns"]:
                    first_turn = r["first_turn"] if turn is None else first_turn
                    total["gaps"] -= r["turns"] - (r["first_turn"] == turn)  # a turn that both sides of a cut hold counts once
                    turn = r["last_turn"]
                audits.append(r["audit"])
                if r["lines"]:
                    digest.update(("\n" + r["lines"] if some else r["lines"]).encode())
                    some = True
            if turn is not None:
                total["gaps"] += turn - first_turn + 1
            row = {"conv_id": conv_id, **total, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
            yield pa.RecordBatch.from_pylist([row], schema=kinds)

    return whole.unionByName(_in_order(pieces).mapInArrow(join_up, schema)).select(*names)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv_id, part, run, position, edit, role, text)``, in that order of turns."""
    solved = segments(turns, keep_turns=True)
    parts = solved.where("whole").select(
        "conv_id", "part", "run", F.lit(START).alias("entry"), F.element_at("audits", 1).alias("audit"), "roles", "texts"
    ).unionByName(placed_segments(solved).select("conv_id", "part", "run", "entry", "audit", "roles", "texts"))
    schema = T.StructType([solved.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in ("part", "run", "position")],
                           *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]])
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = repaired_rows(r["entry"], r["audit"], r["roles"], r["texts"])
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": r["conv_id"], "part": r["part"], "run": r["run"], "position": k, "edit": e, "role": role, "text": text}
                     for k, (e, role, text) in enumerate(rows)], schema=kinds)

    return parts.mapInArrow(edit, schema)


def repair_digests(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Damage, repair and digest of every conversation of a table (the query's form)."""
    return digests(segments(damaged(conversations), segment_rows=segment_rows))
