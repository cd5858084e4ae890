"""Shards of even size that keep linked documents together: balanced label propagation (operator 8).

Documents are nodes, links join them, and every shard may hold its even share of all documents (``rows`` law: counts
differ by one at most). Linked documents start dealt out evenly. In each round a document looks at the shards of its
neighbours and wants to move to the one with the most link weight, if that is more than in its own shard. It may do so
if its hash of the round is above those of its neighbours there, so two neighbours never swap places; every other round
documents with one link go before those with more. Wishes are granted
by gain: into the room that shards have left, and against each other, along cycles of wishes between shards, so that
full shards exchange documents. How many go from shard to shard is decided on counts per (gain, from, to); which ones,
by counts per (from, to, hash) where a level is large, and by rank in the range that is cut, so the numbers are exact. Rounds end when no wish
could be met whatever the hashes, when ``STILL`` rounds in a row move nothing, or after ``ROUNDS``.

Documents without links cut no edge wherever they go, so they come last and fill every shard up to its exact share.

Links of documents are their equal texts: every copy is linked to the first one, a star, not all pairs. Only linked
documents and slim columns take part in the rounds; texts are read once and never shuffled. Ranks come from hash
buckets of bounded size and prefix sums over the buckets' counts; nothing is numbered in one task.

Cases: a null text has size 1, the checksum of the empty text and no links; copies beyond a shard's room go to other
shards; rows with equal ids stay apart; with fewer documents than shards some shards are empty; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import written

SHARDS = 8
ROUNDS = 60
STILL = 3
BUCKET_ROWS = 20_000
CELLS = 1024


def described(docs: DataFrame) -> DataFrame:
    """``(uid, doc_id, size, text_crc32, digest)`` of every row; equal digests are equal texts, null texts have none."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def copy_links(rows: DataFrame) -> DataFrame:
    """``(uid, next, weight)``: links from every copy of a text to its first one."""
    groups = rows.where("digest is not null").groupBy("digest").agg(F.min("uid").alias("next"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.where("n > 1").select("digest", "next"), "shard-groups")
    return rows.join(groups, "digest").where("uid <> next").select("uid", "next", F.lit(1).cast("long").alias("weight"))


def ranked(rows: DataFrame, n: int, name: str, *by: str) -> DataFrame:
    """Add ``name``: gapless ranks from 0 (within ``by``), in order of hash bucket and ``uid``; ``n`` rows or so."""
    buckets = max(1, n // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    counts = rows.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(*by, "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("bucket", *by).orderBy("uid")) - 1
    return rows.withColumn("inside", inside).join(ahead, [*by, "bucket"]).withColumn(name, (F.col("ahead") + F.col("inside")).cast("long")).drop("bucket", "inside", "ahead")


def shares(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _loads(labels: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}  # a row per shard
    return [got.get(s, 0) for s in range(shards)]


def _cycle(wishes: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """The moves of a shortest cycle of wishes, or none."""
    ways: dict[int, list[int]] = {}
    for a, b in sorted(k for k, n in wishes.items() if n):
        ways.setdefault(a, []).append(b)
    best: list[tuple[int, int]] = []
    for start in ways:
        came, queue = {}, [start]
        for a in queue:
            for b in ways.get(a, []):
                if b not in came:
                    came[b] = a
                    queue.append(b)
        if start in came:
            path = [(came[start], start)]
            while path[-1][0] != start:
                path.append((came[path[-1][0]], path[-1][0]))
            if not best or len(path) < len(best):
                best = path
    return best


def exchange(wishes: dict[tuple[int, int, int], int], left: list[int]) -> tuple[dict[tuple[int, int], int], list[int]]:
    """Moves ``(from, to)`` to grant of the wished ``(level, from, to)``, and the room left after them.

    Larger gains (lower levels) come first. Free room is used up, then shards exchange documents along cycles of wishes,
    shortest first, until no wish can be met; no shard ever holds more than its room.
    """
    left, open_, granted = list(left), {}, {}

    def grant(moves: list[tuple[int, int]], n: int) -> None:
        for a, b in moves:
            open_[a, b] -= n
            granted[a, b] = granted.get((a, b), 0) + n
            left[a] += n
            left[b] -= n

    for level in sorted({k[0] for k in wishes}):
        for (_, a, b), n in ((k, n) for k, n in wishes.items() if k[0] == level):
            open_[a, b] = open_.get((a, b), 0) + n
        while True:
            into = next((k for k in sorted(open_) if open_[k] and left[k[1]]), None)
            moves = [into] if into else _cycle(open_)
            if not moves:
                break
            grant(moves, min([open_[k] for k in moves] + ([left[into[1]]] if into else [])))
    return granted, left


def _by_move(values: dict[tuple[int, int], int], shards: int, default: int) -> Column:
    each = F.array(*[F.lit(values.get((a, b), default)).cast("long") for a in range(shards) for b in range(shards)])
    return F.get(each, F.col("shard") * shards + F.col("to"))


def propagate(links: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``(uid, shard)`` of every document in ``links (uid, next, weight)``; no shard holds more than its ``room``."""
    shards = len(room)
    both = written(links.union(links.select("next", "uid", "weight")), "shard-links")
    nodes = written(both.groupBy("uid").agg((F.count(F.lit(1)) > 1).alias("many")), "shard-nodes")
    n = nodes.count()
    labels = written(ranked(nodes, n, "rank").select("uid", "many", (F.col("rank") % shards).cast("int").alias("shard")), "shard-labels")
    left = [r - k for r, k in zip(room, shares(n, shards), strict=True)]
    still = 0
    for turn in range(rounds):
        def first(uid: str, turn: int = turn) -> Column:  # every other turn documents of one link come first
            return F.struct((~F.col("many") | F.lit(turn % 2 == 1)).alias("one"), F.xxhash64(uid, F.lit(turn)).alias("hash"))

        near = both.join(labels.select(F.col("uid").alias("next"), "many", F.col("shard").alias("there")), "next")
        high = F.max(first("next")).alias("high")
        pull = near.groupBy("uid", "there").agg(F.sum("weight").alias("weight"), high).join(labels, "uid")
        own = F.coalesce(F.max(F.when(F.col("there") == F.col("shard"), F.col("weight"))), F.lit(0))
        best = F.max(F.struct("weight", (-F.col("there")).alias("there"), "high"))
        wish = pull.groupBy("uid", "many", "shard").agg(own.alias("own"), best.alias("best")).select(
            "uid", "shard", (-F.col("best.there")).cast("int").alias("to"), (F.col("best.weight") - F.col("own")).alias("gain"),
            (first("uid") > F.col("best.high")).alias("mine"))
        # the larger the gain, the lower the level and the cell; rows of equal level in order of a hash
        level = (63 - F.floor(F.log2("gain"))).cast("long")
        cell = level * CELLS + F.pmod(F.xxhash64("uid", F.lit(turn), F.lit(0)), F.lit(CELLS))
        wish = written(wish.where("gain > 0").withColumn("level", level).withColumn("cell", cell), "shard-wishes")
        counted = wish.groupBy("mine", "level", "shard", "to").count().collect()  # at most 2 * 64 * shards * shards rows
        wishes: list[dict[tuple[int, int, int], int]] = [{}, {}]
        for r in counted:
            k = r["level"], r["shard"], r["to"]
            wishes[0][k] = wishes[0].get(k, 0) + r["count"]
            if r["mine"]:
                wishes[1][k] = r["count"]
        if not exchange(wishes[0], left)[0]:
            break  # no turn can move anything
        granted, left = exchange(wishes[1], left)
        if not granted:
            still += 1
            if still == STILL:
                break
            continue
        still = 0
        # per move: all cells below the range of cells that the quota cuts, and ``rest`` rows of that range
        cut: dict[tuple[int, int], tuple[int, int, int]] = {}
        large = {}
        for move, quota in granted.items():
            for lv in sorted(k[0] for k in wishes[1] if k[1:] == move):
                here = wishes[1][lv, *move]
                if here > quota:
                    cut[move] = (lv * CELLS, (lv + 1) * CELLS, quota)
                    if here > BUCKET_ROWS:
                        large[move] = quota
                    break
                quota -= here
        for move in {k[1:] for k in wishes[1]} - set(granted):
            cut[move] = (0, 0, 0)

        def bound(i: int, default: int, cut: dict = cut) -> Column:
            return _by_move({k: v[i] for k, v in cut.items()}, shards, default)

        wish = wish.where("mine").drop("mine", "level")
        if large:  # counts per cell of one level: at most shards * shards * CELLS rows
            inside = wish.where((F.col("cell") >= bound(0, 64 * CELLS)) & (F.col("cell") < bound(1, 0)) & (_by_move(large, shards, -1) >= 0))
            cells = inside.groupBy("shard", "to", "cell").agg(F.count(F.lit(1)).alias("n"))
            ahead = F.sum("n").over(Window.partitionBy("shard", "to").orderBy("cell")) - F.col("n")
            over = cells.withColumn("ahead", ahead).where(F.col("ahead") + F.col("n") > _by_move(large, shards, 0))
            for r in over.groupBy("shard", "to").agg(F.min(F.struct("cell", "ahead")).alias("at")).collect():
                move = r["shard"], r["to"]
                cut[move] = (r["at"]["cell"], r["at"]["cell"] + 1, large[move] - r["at"]["ahead"])
        moved = wish.where(F.col("cell") < bound(0, 64 * CELLS)).select("uid", "to")
        if any(rest for _, _, rest in cut.values()):
            part = wish.where((F.col("cell") >= bound(0, 64 * CELLS)) & (F.col("cell") < bound(1, 0)))
            place = F.row_number().over(Window.partitionBy("shard", "to").orderBy("cell", "uid"))
            moved = moved.union(part.withColumn("place", place).where(F.col("place") <= bound(2, 0)).select("uid", "to"))
        labels = written(labels.join(moved, "uid", "left").select("uid", "many", F.coalesce("to", "shard").alias("shard")), "shard-labels")
    return labels.drop("many")


def shard_documents(docs: DataFrame, shards: int = SHARDS, links: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row of ``docs``."""
    rows = written(described(docs), "shard-rows")
    n = rows.count()
    room = shares(n, shards)
    labels = propagate(copy_links(rows) if links is None else links, room, rounds)
    slim = rows.drop("digest").join(labels, "uid", "left")
    placed = written(slim, "shard-linked")
    left = [r - k for r, k in zip(room, _loads(labels, shards), strict=True)]
    free = ranked(placed.where("shard is null").drop("shard"), n, "rank")
    ends = [sum(left[: s + 1]) for s in range(shards)]
    shard = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("rank")))
    every = placed.where("shard is not null").unionByName(free.withColumn("shard", shard).drop("rank"))
    return ranked(written(every, "shard-placed"), n, "slot", "shard").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
