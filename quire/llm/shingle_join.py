"""Near-duplicate texts by a chosen-path similarity join over word shingles (operator 2).

Texts are sets of runs of five words; two texts are linked if the Jaccard similarity of their sets is at least 0.8.

1. Sets that are equal are one class; only its representative (least id) goes on. Each representative has a sketch of
   ``T`` min-hashes: by them a set is embedded as ``T`` tokens (i, min-hash i), and two sets share a token with
   the probability of their similarity.
2. Chosen paths (Christiani, Pagh and Sivertsen): a node of the recursion tree chooses each of the ``T`` coordinates
   with probability ``1 / (similarity * T)`` and splits its sets on the tokens there, so a pair at the threshold is
   expected to stay together in one child. Nodes of one set end, nodes of up to ``BUCKET`` sets are compared by brute
   force, larger ones split again, down to ``DEPTH``; what is large then is brute-forced all the same, in tiles.
   ``runs`` gives how many runs with other choices reach the target recall; all runs advance together, level by level.
3. A cluster of very many near copies is a large bucket of nearly the same sets in every run. Such buckets are joined to
   a family, where that means fewer comparisons than one bucket after the other; any other bucket is a family of its own.
   Brute force works on tiles: a family is dealt into blocks of at most about ``BLOCK`` sets, and every pair of
   blocks is a task's work of bounded size, so a group of very many near copies is spread over many tasks. No pair
   leaves a tile as a row. A pair counts in the family of the least bucket that both sets lie in, which their lists of
   buckets tell. First tiles of sketches find the sets that have a likely partner; only these sets'
   shingles are then fetched, and the same tiles check the pairs exactly: few pairs one by one, many at once by a product
   of set-by-shingle matrices. A tile returns, for each set, its number of links and the least set that it is connected
   with there.
4. Connected components of these links, by spreading and jumping to least labels until nothing changes.

Sketches reject pairs whose estimate lies over four standard deviations below the threshold; all others are checked
exactly. Recall is thus bounded by the chosen paths (``RECALL`` at the threshold, above it more).

Cases: a null text is an empty one; texts without words are copies of each other and linked to no other text; texts
of fewer than five words are one shingle of all their words; rows with equal ids and equal or different texts are
kept apart; null ids come first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from quire.llm.common import byte_slices, partition_id, written

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
T = 128
DEPTH = 3
BUCKET = 256
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000
BATCH_BYTES = 2 << 20

_GOLDEN = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)


def runs(similarity: float = SIMILARITY, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met at ``depth`` with the target probability.

    The common children of such a pair number one on average, so the chance to share a node at a depth follows the
    critical branching process ``f = 1 - exp(-f of the depth before)``.
    """
    f = 1.0
    for _ in range(depth):
        f = 1 - math.exp(-f)
    return math.ceil(math.log(1 - recall) / math.log(1 - f))


def shingles(text: bytes, k: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's runs of ``k`` words (all words, if they are fewer)."""
    from xxhash import xxh3_64_intdigest

    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    out = h[:n]
    for j in range(1, k):
        out = _mix(out * np.uint64(_GOLDEN) + h[j : j + n])
    return np.unique(out)


def sketch(x: np.ndarray) -> np.ndarray:
    """``T`` min-hashes of a set of hashes (multiply-shift)."""
    low = np.full(T, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(x), 1024):
        part = x[at : at + 1024, None] * _FACTORS
        np.minimum(low, (part >> np.uint64(32)).min(0), out=low)
    return low.astype(np.uint32)


def sketched(docs: DataFrame) -> DataFrame:
    """``(uid, doc_id, text_hash, key, n, sketch)`` of every row; ``key`` is a digest of the set of shingles."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    schema = T_.StructType([
        T_.StructField("uid", T_.LongType()), T_.StructField("doc_id", docs.schema["doc_id"].dataType), T_.StructField("text_hash", T_.LongType()),
        T_.StructField("key", T_.BinaryType()), T_.StructField("n", T_.IntegerType()), T_.StructField("sketch", T_.BinaryType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = partition_id() << 33
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            sets = [shingles(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + len(sets)), pa.int64()), batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()),
                 pa.array([len(x) for x in sets], pa.int32()), pa.array([sketch(x).tobytes() for x in sets], pa.binary())],
                names=[f.name for f in schema])
            uid += len(sets)

    return rows.mapInArrow(build, schema)


def equal_classes(rows: DataFrame) -> DataFrame:
    """One row per set: ``(key, uid, doc_id, text_hash, n, sketch, copies)`` of its representative, the least id."""
    least = F.min(F.struct("doc_id", "text_hash", "uid")).alias("least")
    return rows.groupBy("key").agg(least, F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")).select(
        "key", "least.uid", "least.doc_id", "least.text_hash", "n", "sketch", "copies")


def _children(paths: np.ndarray, hashes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """For nodes and the min-hashes of sets in them: ``(row, path of a child)`` of every chosen coordinate."""
    at = np.arange(T, dtype=np.uint64) * np.uint64(_GOLDEN)
    drawn = _mix(paths[:, None] + at)
    row, i = np.nonzero(drawn < np.uint64(int(2**64 / (similarity * T))))
    return row, _mix(drawn[row, i] * np.uint64(_GOLDEN) + hashes[row, i].astype(np.uint64))


def _split(batches: Iterator[pa.RecordBatch], roots: np.ndarray | None, similarity: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            hashes = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, T)
            uid, n = (np.asarray(batch.column(c)) for c in ("uid", "n"))
            for root in [None] if roots is None else roots:
                paths = np.asarray(batch.column("path")).view(np.uint64) if root is None else np.full(len(uid), root, np.uint64)
                row, child = _children(paths, hashes, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(uid[row]), pa.array(n[row])], names=["path", "uid", "n"])


def leaves(reps: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, depth: int = DEPTH, bucket: int = BUCKET) -> DataFrame:
    """``(path, uid, size, total)``: the buckets of two sets or more that the recursion ends in, over all runs."""
    roots = _mix(np.arange(1, runs(similarity, recall, depth) + 1, dtype=np.uint64) * np.uint64(_GOLDEN))
    schema = "path long, uid long, n int"
    nodes = reps.where("n > 0").select("uid", "n", "sketch").mapInArrow(lambda b: _split(b, roots, similarity), schema)
    ended = None
    for level in range(1, depth + 1):
        sizes = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).where("size > 1")
        shared = written(nodes.join(written(sizes, f"join-sizes{level}"), "path"), f"join-level{level}")
        small = (F.col("size") <= bucket) & (F.col("total") <= BLOCK_SHINGLES) if level < depth else F.lit(True)
        here = shared.where(small).select("path", "uid", "size", "total")
        ended = here if ended is None else ended.unionByName(here)
        if level < depth:
            large = shared.where(~small).select("path", "uid", "n").join(reps.select("uid", "sketch"), "uid")
            nodes = written(large.mapInArrow(lambda b: _split(b, None, similarity), schema), f"join-nodes{level}")
    return ended


def _blocks(block: int) -> Column:
    return F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")


def families(ended: DataFrame, reps: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``(path, uid, family, blocks)``: every bucket with the family that its pairs are compared in.

    Buckets of more than ``bucket`` sets that hold a set with the same least bucket are one family if it has fewer pairs
    than its buckets have together. All this is counted by partial aggregations over (bucket, set) rows.
    """
    sized = ended.withColumn("blocks", _blocks(block))
    large = sized.where(F.col("size") > bucket)
    least = large.groupBy("uid").agg(F.min("path").alias("least"))
    joined = large.join(least, "uid").groupBy("path").agg(F.min("least").alias("family"), F.first(F.col("size").cast("double")).alias("own"))
    apart = joined.groupBy("family").agg(F.sum(F.col("own") * F.col("own")).alias("apart"))
    own = written(large.select("path", "uid").join(joined.select("path", "family"), "path"), "join-families")
    united = own.select("family", "uid").distinct().join(reps.select("uid", "n"), "uid").groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    gain = united.join(apart, "family").where(F.col("size").cast("double") * F.col("size") <= F.col("apart"))
    chosen = joined.select("path", "family").join(gain.select("family", _blocks(block).alias("together")), "family")
    told = sized.join(written(chosen, "join-chosen"), "path", "left")
    return told.select("path", "uid", F.coalesce("family", "path").alias("family"), F.coalesce("together", "blocks").alias("blocks"))


def tiles(dealt: DataFrame, reps: DataFrame) -> DataFrame:
    """``(family, a, b, side, uid, n, sketch, buckets, families)``: the sets of every pair of blocks of every family.

    ``families`` goes along with ``buckets``; it is null where every bucket of the set is its own family.
    """
    lists = F.sort_array(F.collect_list(F.struct("path", "family")))
    own = dealt.groupBy("uid").agg(lists.alias("all")).select(
        "uid", F.col("all.path").alias("buckets"), F.when(F.col("all.path") != F.col("all.family"), F.col("all.family")).alias("families"))
    short = reps.join(own, "uid").select("uid", "n", "sketch", "buckets", "families")
    once = dealt.groupBy("family", "uid").agg(F.first("blocks").alias("blocks"))
    block = F.pmod(F.xxhash64("uid", "family"), F.col("blocks")).cast("int")
    spread = once.withColumn("block", block).select("family", "uid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = spread.select("family", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), (F.col("block") > F.col("other")).cast("int").alias("side"), "uid")
    return placed.join(short, "uid").select("family", "a", "b", "side", "uid", "n", "sketch", "buckets", "families")


_TILE = "family long, a int, b int, side int, uid long, n int, sketch binary, buckets array<long>, families array<long>"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole tiles from rows sorted by tile: many small ones together, up to some thousand rows."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows >= 4096 or rest.nbytes >= 32 << 20:
            keys = [np.asarray(rest.column(c)) for c in ("family", "a", "b")]
            last = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
            if len(last):
                yield rest.slice(0, last[-1] + 1)
                rest = rest.slice(last[-1] + 1)
    if rest is not None and rest.num_rows:
        yield rest


def _padded(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, known, here)`` by row and position: a row's buckets in order, whether there is one at the position, and
    whether its family is the tile's."""
    family = np.asarray(table.column("family"))
    lists, told = table.column("buckets").combine_chunks(), table.column("families").combine_chunks()
    width = np.diff(np.asarray(lists.offsets))
    known = np.arange(max(1, width.max(initial=0))) < width[:, None]
    buckets = np.zeros(known.shape, np.int64)
    buckets[known] = np.asarray(lists.flatten())
    of = buckets.copy()
    other = np.asarray(told.is_valid())
    of[other[:, None] & known] = np.asarray(told.drop_null().flatten())
    return buckets, known, known & (of == family[:, None])


def _pairs(table: pa.Table, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one tile whose sizes and sketches allow the similarity and whose least common bucket is of its family."""
    family, a, b, side, n = (np.asarray(table.column(c)) for c in ("family", "a", "b", "side", "n"))
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, T).astype(np.uint8)
    buckets, known, ours = _padded(table)
    tile = np.cumsum(np.concatenate([[False], (family[1:] != family[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    least = similarity - 4.2 * math.sqrt(similarity * (1 - similarity) / T)
    longest = int(np.bincount(tile).max())
    for gap in range(1, longest):
        i = np.flatnonzero(tile[gap:] == tile[:-gap])
        j = i + gap
        apart = (a[i] == b[i]) | (side[i] != side[j])
        i, j = i[apart], j[apart]
        fits = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
        i, j = i[fits], j[fits]
        for at in range(0, len(i), 8192):
            x, y = i[at : at + 8192], j[at : at + 8192]
            alike = (sketches[x] == sketches[y]).sum(1) >= least * T
            x, y = x[alike], y[alike]
            keep = np.zeros(len(x), bool)
            left = np.arange(len(x))  # pairs whose least common bucket is not found yet
            for c in range(buckets.shape[1]):
                if not len(left):
                    break
                p, q = x[left], y[left]
                common = known[p, c] & (known[q] & (buckets[p, c][:, None] == buckets[q])).any(1)
                keep[left[common]] = ours[p[common], c]
                left = left[~common]
            if keep.any():
                yield x[keep], y[keep]


def _least_linked(uid: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For every row the least uid that it is connected with by the links ``x, y``."""
    order = np.argsort(uid, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(uid))
    x, y, label = rank[x], rank[y], np.arange(len(uid))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return uid[order[label[rank]]]
        label = new


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the pairs ``x, y`` of sets, exactly.

    Many pairs of few sets go through a product of 0/1 matrices (in blocks of shingles), few pairs are looked up.
    """
    rows = np.unique(np.concatenate([x, y]))
    sizes = np.array([len(sets[i]) for i in rows])
    at = np.zeros(rows[-1] + 1, np.int64)
    at[rows] = np.arange(len(rows))
    if len(x) >= 4 * len(rows):
        _, column, often = np.unique(np.concatenate([sets[i] for i in rows]), return_inverse=True, return_counts=True)
    # about 16 products or one thirtieth of a lookup in a nanosecond
    if len(x) >= 4 * len(rows) and len(rows) ** 2 * float((often > 1).sum()) / 16 < sizes[at[y]].sum() * 30.0:
        row = np.repeat(np.arange(len(rows)), sizes)
        shared = often[column] > 1
        row, column = row[shared], (np.cumsum(often > 1) - 1)[column[shared]]
        by_column = np.argsort(column, kind="stable")
        row, column = row[by_column], column[by_column]
        both = np.zeros((len(rows), len(rows)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            p, q = np.searchsorted(column, [low, low + 4096])
            part = np.zeros((len(rows), 4096), np.float32)
            part[row[p:q], column[p:q] - low] = 1
            both += part @ part.T
        return both[at[x], at[y]].astype(np.int64)
    out = np.zeros(len(x), np.int64)
    by_left = np.argsort(x, kind="stable")
    for some in np.split(by_left, np.flatnonzero(np.diff(x[by_left])) + 1):
        mine = sets[x[some[0]]]
        every = np.concatenate([sets[j] for j in y[some]])
        own = sizes[at[y[some]]]
        spot = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
        out[some] = np.add.reduceat(mine[spot] == every, np.cumsum(own) - own, dtype=np.int64)
    return out


def _likely(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The rows that have a likely partner in their tile."""
    for table in _groups(batches):
        keep = np.zeros(table.num_rows, bool)
        for x, y in _pairs(table, similarity):
            keep[x] = keep[y] = True
        for batch in table.filter(pa.array(keep)).combine_chunks().to_batches():
            yield batch


def _checked(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """``(uid, root, links)`` per row of a tile: its exact links there, and the least set connected with it."""
    for table in _groups(batches):
        keys = [np.asarray(table.column(c)) for c in ("family", "a", "b", "uid")]
        again = np.concatenate([[False], np.logical_and.reduce([k[1:] == k[:-1] for k in keys])])  # equal rows of the input
        table = table.filter(pa.array(~again))
        uid = np.asarray(table.column("uid"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        found = list(_pairs(table, similarity))
        x, y = (np.concatenate([np.zeros(0, np.int64), *some]) for some in (zip(*found, strict=True) if found else ((), ())))
        first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([np.asarray(table.column(c))[1:] != np.asarray(table.column(c))[:-1] for c in ("family", "a", "b")])]))
        tile = np.searchsorted(first, x, side="right")
        by_tile = np.argsort(tile, kind="stable")
        x, y = x[by_tile], y[by_tile]
        both = [_common(sets, x[p], y[p]) for p in np.split(np.arange(len(x)), np.flatnonzero(np.diff(tile[by_tile])) + 1) if len(p)]
        both = np.concatenate([np.zeros(0, np.int64), *both])
        size = np.array([len(v) for v in sets], np.int64)
        linked = both >= similarity * (size[x] + size[y] - both) - 1e-9
        x, y = x[linked], y[linked]
        links = np.bincount(np.concatenate([x, y]), minlength=len(uid))
        has = np.flatnonzero(links)
        root = _least_linked(uid, x, y)[has]
        yield pa.RecordBatch.from_arrays([pa.array(uid[has]), pa.array(root), pa.array(links[has])], names=["uid", "root", "links"])


def links(docs: DataFrame, reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(uid, root, links)`` over all tiles: counts add up to a set's number of links, roots connect linked sets."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["family", "a", "b", "uid"]
    ended = written(leaves(reps, similarity), "join-leaves")
    grouped = written(families(ended, reps, BUCKET, BLOCK), "join-grouped")
    dealt = tiles(grouped, reps).repartition(n, "family", "a", "b").sortWithinPartitions(*order)
    likely = written(dealt.mapInArrow(lambda b: _likely(b, similarity), _TILE), "join-likely")
    wanted = likely.select("uid").distinct().join(reps.select("uid", "doc_id", "text_hash"), "uid")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    wanted = wanted.select("uid", F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    # merged at every size: what is wanted grows with the table
    fetched = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).select("uid", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            sets = [shingles(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(sets, pa.binary())], names=["uid", "shingles"])

    sets = fetched.mapInArrow(cut, "uid long, shingles binary")
    full = likely.join(sets, "uid").repartition(n, "family", "a", "b").sortWithinPartitions(*order)
    return full.mapInArrow(lambda b: _checked(b, similarity), "uid long, root long, links long")


def components(edges: DataFrame) -> DataFrame:
    """``(uid, label)``: the least connected id of every id in ``edges (uid, root)``.

    Each turn spreads least labels over the edges and then jumps from a label to its own label, which halves chains,
    until a turn changes nothing. Tables between the turns are written.
    """
    pairs = edges.where("uid <> root").select("uid", "root").distinct()
    both = written(pairs.union(pairs.select("root", "uid")).toDF("uid", "next"), "join-edges")
    labels = written(both.groupBy("uid").agg(F.least("uid", F.min("next")).alias("label")), "join-labels")
    while True:
        seen = both.join(labels.select(F.col("uid").alias("next"), "label"), "next").groupBy("uid").agg(F.min("label").alias("seen"))
        spread = written(labels.join(seen, "uid").select("uid", "label", F.least("label", "seen").alias("new")), "join-spread")
        jump = spread.select(F.col("uid").alias("new"), F.col("new").alias("further"))
        jumped = written(spread.join(jump, "new").select("uid", F.col("label").alias("old"), F.least("new", "further").alias("label")), "join-labels")
        labels = jumped.select("uid", "label")
        if jumped.where("old <> label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, text_hash, class_id, class_hash, rep_id, copies, n_links)`` of every row of ``docs``.

    ``class_id`` is the least id among the row's near-duplicates (connected by links), ``rep_id`` the least id with an
    equal set of shingles, ``copies`` the rows with an equal set, ``n_links`` the other sets that the row's is linked to.
    """
    rows = written(sketched(docs), "join-rows")
    reps = written(equal_classes(rows), "join-reps")
    found = written(links(docs, reps, similarity), "join-links")
    counts = found.groupBy("uid").agg(F.sum("links").alias("n_links"))
    member = reps.select("uid", "key", "doc_id", "text_hash", "copies").join(components(found), "uid", "left").join(counts, "uid", "left")
    member = member.withColumn("label", F.coalesce("label", "uid")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    least = member.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
    classes = written(
        member.join(least, "label").select("key", F.col("doc_id").alias("rep_id"), F.col("least.doc_id").alias("class_id"), F.col("least.text_hash").alias("class_hash"), "copies", "n_links"),
        "join-classes")
    return rows.select("doc_id", "text_hash", "key").join(classes, "key").drop("key")


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class of near-duplicates: one row each, the least id."""
    chosen = near_duplicates(docs, similarity).select("class_id", "class_hash").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    kept = rows.join(chosen.hint("merge"), F.col("d").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("class_hash")))
    return kept.dropDuplicates(["d", "h"]).select("row.*")
