"""Mixing sources to target weights from fixed-length blocks (operator 10).

1. Sizes (words) per document and per source; sources are ranked by code point, null last, and weigh 5, 2, 1,
   repeating. Together they share ``share`` times all words; a target stops at ``repeat`` times its source's size
   and the excess is shared again by weight until none is above.
2. The words of a source, its documents in order of their ids, are packed into blocks of ``block`` words (the last
   one may be shorter). Where a document starts within its source comes from two passes of prefix sums: inside
   range partitions and over the partitions' totals, so a source that holds most rows is spread over many tasks.
3. Every source gets as many block slots as its target needs. An output shard holds ``shard_slots`` slots and draws how
   many of them each source gets from a multinomial at the target weights, given that the sources' totals come out
   exactly. Given totals, shards are not independent, so the draw goes in two steps that need no task to see all
   shards: each source deals its slots to groups of ``GROUP_SHARDS`` shards by a multinomial, and a group halves its
   shards again and again, the sources' counts of either half drawn from what the group has (a multivariate
   hypergeometric, which is what multinomial draws of fixed size are once their total is known). Only the last shard
   of a group may be shorter.
4. Slot ``k`` of a source takes block ``permutation(k mod blocks)``, with another pseudorandom permutation
   (a keyed Feistel network) for each round ``k div blocks``. So no block is used once more before all others were,
   and with at most ``repeat`` rounds no document exceeds ``repeat`` times its size.
5. Slots and the documents' pieces of blocks are joined by (source, block index): fine-grained keys, no hot one.

The result depends on the rows alone, not on partitions or on retries: reruns agree. Rows are ordered by id, size and a
hash of the text, so only rows that agree in all three may change places.

Cases: a null text has size 0 and a null source is a source of its own; documents of size 0 take 0 words; an empty
table gives no rows; rows with equal ids keep apart (each row has a key of its own); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import written
from quire.operators.numbering import dense_number

BLOCK = 128
SHARD_SLOTS = 4096
GROUP_SHARDS = 256
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2


def sized(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``(uid, doc_id, source, size, text_hash)``: a key for every row (the column ``key`` or a new one), its number of words
    and what orders rows of one id and size."""
    uid = F.col(key) if key else F.monotonically_increasing_id()
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(uid.alias("uid"), "doc_id", "source", F.coalesce(words, F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("text").alias("text_hash"))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT,
                   block: int = BLOCK) -> DataFrame:
    """One row per source: ``(rank, source, source_size, target, blocks, slots)``.

    Resharing the excess until nothing is above its bound gives every source the lesser of its bound and its weight
    times one common level; each turn of the loop reads two sums, and the level only rises, so it ends.
    """
    totals = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = written(dense_number(totals, [F.col("source").asc_nulls_last()], "rank", start=0), "mix-ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    bound = F.col("source_size") * float(repeat)
    level, stopped = 0.0, -1
    while True:
        above = bound < weight * F.lit(level) if stopped >= 0 else F.lit(False)
        got = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, bound)).alias("bound"),
            F.sum(F.when(~above, weight)).alias("weight"), F.count(F.when(above, 1)).alias("n")).first()
        if got["n"] == stopped or not got["weight"]:
            break
        level, stopped = (share * (got["all"] or 0) - (got["bound"] or 0.0)) / got["weight"], got["n"]
    blocks = F.ceil(F.col("source_size") / block)
    return (
        ranked.withColumn("target", F.least(bound, weight * F.lit(level)))
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.least(
            F.col("blocks") * repeat, F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))).otherwise(F.lit(0)).cast("long"))
    )


def block_pieces(rows: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(rank, block, uid, first, n_words)``: the words of each document that each block of its source holds."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "size", "text_hash", "uid"]
    ranked = rows.join(sources.select(F.col("source").alias("s"), "rank"), F.col("source").eqNullSafe(F.col("s")))
    placed = ranked.select("rank", *order).where("size > 0").repartitionByRange(n, "rank", *order)
    placed = written(placed.withColumn("part", F.spark_partition_id()), "mix-placed")
    inside = Window.partitionBy("part", "rank").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part", "rank").agg(F.sum("size").alias("total"))
    over = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select("part", "rank", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("ahead"))
    starts = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ahead, ["part", "rank"])
    start = F.col("ahead") + F.col("inside")
    spans = starts.select("rank", "uid", start.alias("start"), (start + F.col("size")).alias("stop"))
    at = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))
    pieces = spans.select("rank", "uid", "start", "stop", F.explode(at).alias("block"))
    lo = F.greatest("start", F.col("block") * block)
    return pieces.select("rank", "block", "uid", (lo - F.col("start")).alias("first"),
                         (F.least("stop", (F.col("block") + 1) * block) - lo).alias("n_words"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed pseudorandom permutation of ``0 .. size-1``, applied to ``index``, elementwise.

    Four Feistel rounds on the least even number of bits that holds the size; values beyond it walk on along their
    cycle until they fall inside.
    """
    size = size.astype(np.uint64)
    half = np.ones(len(size), np.uint64)
    while (grow := (np.uint64(1) << (half * np.uint64(2))) < size).any():
        half[grow] += np.uint64(1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        h, m, k, x = half[todo], mask[todo], key[todo], out[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (_mixed(right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_draws(sources: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(rank, blocks, shard, first_slot, n)``: how many slots of each source each output shard takes.

    Shards are numbered from ``2 * GROUP_SHARDS * group``. A task holds one source's counts per group, or one group's
    slots per source and shard (at most as many rows as the group has slots).
    """
    total = sources.agg(F.sum("slots")).first()[0] or 0
    groups = max(1, round(total / (shard_slots * GROUP_SHARDS)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rank, blocks, slots in zip(*(batch.column(c).to_pylist() for c in ("rank", "blocks", "slots")), strict=True):
                n = _drawn(seed, 0, rank).multinomial(slots, np.full(groups, 1 / groups)).astype(np.int64)
                first, some = np.cumsum(n) - n, np.flatnonzero(n)
                for at in range(0, len(some), 65536):
                    g = some[at : at + 65536]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g), pa.array(np.full(len(g), rank, np.int64)), pa.array(np.full(len(g), blocks, np.int64)), pa.array(first[g]), pa.array(n[g])],
                        names=["group", "rank", "blocks", "first_slot", "n"])

    def split(rows: pa.Table) -> pa.Table:
        group, rank, blocks, first, n = (x[np.argsort(rows["rank"].to_numpy(), kind="stable")] for x in (rows[c].to_numpy() for c in ("group", "rank", "blocks", "first_slot", "n")))
        parts = list(shard_counts(n, shard_slots, _drawn(seed, 1, int(group[0]))))
        source = np.concatenate([at for _, at, _, _ in parts])
        shard = np.repeat([2 * GROUP_SHARDS * int(group[0]) + s for s, *_ in parts], [len(at) for _, at, _, _ in parts])
        ahead, count = (np.concatenate([x[i] for x in parts]) for i in (2, 3))
        return pa.table({"rank": rank[source], "blocks": blocks[source], "shard": shard.astype(np.int64), "first_slot": first[source] + ahead, "n": count})

    dealt = sources.select("rank", "blocks", "slots").where("slots > 0").mapInArrow(deal, "group long, rank long, blocks long, first_slot long, n long")
    return dealt.groupBy("group").applyInArrow(split, "rank long, blocks long, shard long, first_slot long, n long")


def _drawn(*key: int) -> np.random.Generator:
    """Random numbers that follow from the key alone, whichever task asks."""
    return np.random.Generator(np.random.Philox(np.random.SeedSequence(key)))


def shard_counts(n: np.ndarray, shard_slots: int, rng: np.random.Generator) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(shard, sources, slots of each source before the shard, slots in it)`` for the ``n`` slots of each source.

    Every shard takes ``shard_slots`` slots, the last one the rest. Halves carry the sources they have only, so the work of
    a level is bounded by its slots as well as by its sources.
    """
    shards = -(-int(n.sum()) // shard_slots)
    todo = [(0, shards, np.flatnonzero(n), np.zeros(np.count_nonzero(n), np.int64), n[n > 0].astype(np.int64))] if shards else []
    while todo:
        low, high, at, ahead, count = todo.pop()
        if high - low == 1:
            yield low, at, ahead, count
            continue
        middle = (low + high) // 2
        left = rng.multivariate_hypergeometric(count, (middle - low) * shard_slots, method="marginals").astype(np.int64)
        right = count - left
        todo.append((middle, high, at[right > 0], (ahead + left)[right > 0], right[right > 0]))
        todo.append((low, middle, at[left > 0], ahead[left > 0], left[left > 0]))


def slots(draws: DataFrame, seed: int = 0) -> DataFrame:
    """``(rank, shard, slot, round, block)``: the block of its source that each slot takes."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 64) for at in range(0, whole.num_rows, 64)):
                rank, blocks, shard, first, n = (np.asarray(batch.column(c)) for c in ("rank", "blocks", "shard", "first_slot", "n"))
                at = np.repeat(np.arange(len(n)), n)
                k = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                turn, index = k // blocks[at], k % blocks[at]
                key = _mixed(rank[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + turn.astype(np.uint64) + np.uint64(seed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (rank[at], shard[at], k, turn, permuted(index, blocks[at], key))],
                    names=["rank", "shard", "slot", "round", "block"])

    return draws.mapInArrow(expand, "rank long, shard long, slot long, round long, block long")


def mixture(rows: DataFrame, sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """``(shard, rank, slot, round, block, uid, first, n_words)``: what each slot of each output shard holds.

    ``rows`` is a written ``sized`` table and ``sources`` its ``source_targets``.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = slots(shard_draws(sources, seed, shard_slots).repartition(n, "rank", "shard"), seed)
    # slots are many more than the rows they grow from, which Spark's estimate doesn't know: never broadcast them
    return taken.hint("merge").join(block_pieces(rows, sources, block).hint("merge"), ["rank", "block"])


def mix(docs: DataFrame, key: str | None = None, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written sizes, the written source targets, and the mixture of ``docs``."""
    rows = written(sized(docs, key), "mix-sizes")
    sources = written(source_targets(rows, block=block), "mix-targets")
    return rows, sources, mixture(rows, sources, block, shard_slots, seed)


def taken_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of every row of ``docs``."""
    rows, sources, mixed = mix(docs)
    taken = mixed.groupBy("uid").agg(F.sum("n_words").alias("taken"))
    s = sources.select(F.col("source").alias("s"), "source_size", "target")
    return (
        rows.join(s, F.col("source").eqNullSafe(F.col("s"))).join(taken, "uid", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mixture, with the columns of ``docs``.

    A document comes back once for each round in which slots took pieces of it; its text is then the words of those
    pieces in their order, with the white space between them as it was, and ``n_chars`` (where ``docs`` has such a
    column) is counted anew. ``docs`` is written once with a key for each row, which joins pieces to texts.
    """
    keyed = written(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")), "mix-docs")
    _, _, mixed = mix(keyed.select("uid", "row.doc_id", "row.source", "row.text"), "uid")
    spans = mixed.groupBy("uid", "round").agg(F.sort_array(F.collect_list(F.struct("first", "n_words"))).alias("pieces"))
    others = F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text"])
    cut = keyed.join(spans, "uid").select(others.alias("row"), F.col("row.text").alias("text"), F.col("pieces.first").alias("first"), F.col("pieces.n_words").alias("n_words"))
    out = _with_pieces(cut)
    fields = [F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*fields)


def _with_pieces(cut: DataFrame) -> DataFrame:
    import re

    from pyspark.sql import types as T

    word = re.compile(rb"[^\x20\x09-\x0D]+")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 64) for at in range(0, whole.num_rows, 64)):
                texts = []
                columns = (batch.column("text").cast(pa.binary()), batch.column("first"), batch.column("n_words"))
                for text, first, n in zip(*(c.to_pylist() for c in columns), strict=True):
                    at = np.array([m.span() for m in word.finditer(text)], dtype=np.int64).reshape(-1, 2)
                    parts, i = [], 0
                    while i < len(first):
                        j, stop = i, first[i] + n[i]
                        while j + 1 < len(first) and first[j + 1] == stop:
                            j += 1
                            stop += n[j]
                        parts.append(text[at[first[i], 0] : at[stop - 1, 1]])
                        i = j + 1
                    texts.append(b"\n".join(parts).decode())
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, batch.schema.field("text").type)], names=["row", "text"])

    schema = T.StructType([cut.schema["row"], T.StructField("text", T.StringType())])
    return cut.mapInArrow(keep, schema)
