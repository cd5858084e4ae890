"""Long repeated passages by De Bruijn compaction (operator 11).

A window of ``WINDOW`` = 35 consecutive words of one document is an edge of a De Bruijn graph (its first and last 34
words are the nodes). Every word that lies in an edge whose word sequence starts anywhere else is removed. The edges
of a corpus are as many as its words, so they are never shuffled one by one:

1. **Paths** (``paths``). Consecutive edges of a document that share the least hash of their ten-word pieces form a
   path of up to 26 edges. Equal edges share that hash wherever they stand. A path is known by (least hash, hash of all
   its words); one row of numbers per path, about one for 13 words, leaves the task.
2. **Compaction** (``resolved_paths``). Paths are counted by least hash with partial sums, and a join brings the counts
   back to the paths' coordinates. A hash with one path content only is nonbranching: its path is an edge sequence that
   repeats as a whole, or a unique one, which drops out. A hash with several contents (or a path that holds an edge
   twice) branches: there paths that occur twice are repeated as a whole, and others are opened.
3. **Verification at the coordinates** (``opened``, ``judged``). The opened paths' edges, and those of one copy of each
   repeated path beside them, are counted by two 64-bit hashes of their 35 words, and joined back to where they start.
   The union of repeated edges' words goes.

Texts meet their paths once, by a hash of the text (two 64-bit numbers), so nothing depends on where a row was computed
before a table was written. Least hashes, path contents and edges that a third of all rows share are combined before
they are shuffled; the joins on them read written tables, which adaptive execution splits. No group is collected but a
document's own paths.

Cases: a null or empty text has no words; fewer than 35 words: nothing is removed; repeated rows are copies of each other
and lose all their words if they have 35; empty tables give no rows; extra columns are ignored; words longer than 64 kB
are hashed one by one, others by array operations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, partition_id, written

WINDOW, PIECE = 35, 10
#: Pieces per window, and the most edges of a path.
SPAN = WINDOW - PIECE + 1
BLOCK_BYTES, LONG_WORD = 1 << 20, 1 << 16
#: Kinds of a path: repeated, opened, repeated and opened on behalf of its copies.
REPEATED, OPEN, BOTH = 0, 1, 2

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 9, 10, 11, 12, 13]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64: hashes of any stretch from running sums."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.up, self.down = np.uint64(base), np.uint64(pow(base, -1, 1 << 64)), *[np.ones(1, np.uint64)] * 2

    def sums(self, values: np.ndarray) -> np.ndarray:
        """``s`` with ``s[i]``: sum of ``values[j] * base**j`` for j < i."""
        n = len(values) + 1
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x)])) for x in (self.base, self.inverse))
        out = np.zeros(n, np.uint64)
        np.cumsum(values * self.up[: n - 1], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hashes of the stretches, equal for equal values wherever they stand."""
        return (sums[stops] - sums[starts]) * self.down[starts]


_BYTES, _FIRST, _SECOND = _Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD95), _Powers(0xA0761D6478BD642D)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts one after the other, and the number of words of each text."""
    data = b" ".join([b"", *texts, b""])
    raw = np.frombuffer(data, np.uint8)
    space = _SPACES[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edge[::2], edge[1::2]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(starts, ends, "right"), prepend=0)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = max(int(np.searchsorted(stops, starts[at] + BLOCK_BYTES, "right")), at + 1)
        first = int(starts[at])
        if upto == at + 1 and stops[at] - first > LONG_WORD:
            out[at] = 0
        else:
            sums = _BYTES.sums(raw[first : int(stops[upto - 1])].astype(np.uint64) + np.uint64(1))
            out[at:upto] = _BYTES.between(sums, starts[at:upto] - first, stops[at:upto] - first)
        at = upto
    for k in np.flatnonzero(stops - starts > LONG_WORD):
        out[k] = np.frombuffer(hashlib.blake2b(data[starts[k] : stops[k]], digest_size=8).digest(), "<u8")[0]
    return _mix(out), counts


class _Graph:
    """Edges and paths of a batch of texts; positions run through all words of the batch."""

    def __init__(self, texts: list[bytes]) -> None:
        words, self.counts = word_hashes(texts)
        self.first, self.second = _FIRST.sums(words), _SECOND.sums(_mix(words ^ np.uint64(0x5851F42D4C957F2D)))
        self.ends = np.cumsum(self.counts)
        self.begins = self.ends - self.counts
        self.n = len(words)

    def edges(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows that start there."""
        stops = starts + WINDOW
        return _mix(_FIRST.between(self.first, starts, stops)).view(np.int64), _mix(_SECOND.between(self.second, starts, stops)).view(np.int64)

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, least hash, content hash) of every path, in order, and the number of paths per document.

        ``place`` is start in the document * 64 + number of edges * 2 + whether an edge occurs twice.
        """
        none = np.empty(0, np.int64)
        if self.n < WINDOW:
            return none, none, none, none, np.zeros(len(self.counts), np.int64)
        at = np.arange(self.n - PIECE + 1)
        least = _mix(_FIRST.between(self.first, at, at + PIECE))
        size = 1
        while 2 * size <= SPAN:  # minima of stretches whose length doubles
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < SPAN:
            least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
        owner = np.repeat(np.arange(len(self.counts)), self.counts)[: self.n - WINDOW + 1]
        starts = np.flatnonzero(np.arange(len(owner)) + WINDOW <= self.ends[owner])
        if not len(starts):
            return none, none, none, none, np.zeros(len(self.counts), np.int64)
        least, owner = least[starts], owner[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(starts)), 0))
        fresh |= (np.arange(len(starts)) - run) % SPAN == 0
        heads = np.flatnonzero(fresh)
        sizes = np.diff(heads, append=len(starts))
        loops = np.zeros(len(heads), np.int64)
        path = np.cumsum(fresh) - 1
        windows = _FIRST.between(self.first, starts, starts + WINDOW)
        for d in range(1, SPAN):
            same = windows[d:] == windows[:-d]
            if same.any():
                loops[path[d:][same & (path[d:] == path[:-d])]] = 1
        first = starts[heads]
        content = _mix(_SECOND.between(self.second, first, first + sizes + WINDOW - 1) + sizes.astype(np.uint64))
        doc = owner[heads]
        place = (first - self.begins[doc]) * 64 + sizes * 2 + loops
        return doc, place, least[heads].view(np.int64), content.view(np.int64), np.bincount(doc, minlength=len(self.counts))


def _text_key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int64()))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(pc.cast(batch.column("text"), pa.binary()), b"").to_pylist()


def paths(rows: DataFrame) -> DataFrame:
    """``(rid, k1, k2, places, least, content)``: one row per text with a window, a number for it and its paths."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = partition_id() << 33
        for batch in byte_slices(batches, "text", BLOCK_BYTES):
            _, place, least, content, counts = _Graph(_texts(batch)).paths()
            ids = pa.array(np.arange(rid, rid + len(counts)))
            rid += len(counts)
            out = pa.RecordBatch.from_arrays(
                [ids, batch.column("k1"), batch.column("k2"), _lists(counts, place), _lists(counts, least), _lists(counts, content)],
                names=["rid", "k1", "k2", "places", "least", "content"])
            yield out.filter(pa.array(counts > 0))

    return rows.select("text", *_text_key()).mapInArrow(
        find, "rid long, k1 long, k2 long, places array<long>, least array<long>, content array<long>")


def resolved_paths(found: DataFrame) -> DataFrame:
    """``(rid, place, kind)`` of the paths that are repeated or have to be opened, from a written table of ``paths``."""
    each = found.select("rid", F.explode(F.arrays_zip("places", "least", "content")).alias("p")).select(
        "rid", F.col("p.places").alias("place"), F.col("p.least").alias("least"), F.col("p.content").alias("content"))
    loop = F.col("place").bitwiseAND(F.lit(1))
    hashes = written(
        each.groupBy("least")
        .agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("a"), F.max("content").alias("b"), F.max(loop).alias("loops"))
        .where("n > 1 or loops = 1").select("least", (F.expr("a <> b or loops = 1")).alias("branches")), "path-hashes")
    kept = written(each.join(hashes, "least"), "kept-paths")
    branching = kept.where("branches")
    contents = written(
        branching.groupBy("least", "content").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("first")), "path-contents")
    kind = F.when(F.col("n") == 1, OPEN).when(F.col("rid") == F.col("first"), BOTH).otherwise(REPEATED)
    return kept.where("not branches").select("rid", "place", F.lit(REPEATED).alias("kind")).unionByName(
        branching.drop("branches").join(contents, ["least", "content"]).select("rid", "place", kind.alias("kind")))


def _by_text(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """``(k1, k2, marks)``: the paths of a text, of the first of its equal rows; ``marks`` are place * 4 + kind."""
    marks = resolved.groupBy("rid").agg(F.collect_list(F.col("place") * 4 + F.col("kind")).alias("marks"))
    texts = found.groupBy("k1", "k2").agg(F.min("rid").alias("rid"))
    return texts.join(marks, "rid").drop("rid")


def opened(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """All rows with their words covered so far and the edges that are still to be counted.

    A row that has edges to learn about keeps its text; the others are finished here.
    """
    schema = T.StructType([
        T.StructField("wid", T.LongType()), rows.schema["doc_id"], *_RESULT,
        T.StructField("text", T.StringType()), T.StructField("places", T.ArrayType(T.LongType())),
        *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("starts", "first", "second", "weights")],
    ])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wid = partition_id() << 33
        for batch in byte_slices(batches, "text", BLOCK_BYTES):
            texts, marks = _texts(batch), batch.column("marks")
            graph = _Graph(texts)
            marked_by = np.array(pc.fill_null(pc.list_value_length(marks), 0), np.int64)
            doc = np.repeat(np.arange(len(texts)), marked_by)
            mark = np.array(marks.flatten(), np.int64)
            place, kind = mark >> 2, mark & 3
            begin = graph.begins[doc] + (place >> 6)
            size = (place & 63) >> 1
            covers, opens = kind != OPEN, kind != REPEATED
            mask = _covered(graph.n, begin[covers], size[covers])
            waits = np.bincount(doc[kind == OPEN], minlength=len(texts)) > 0
            results = _results(texts, graph, mask, ~waits)
            index = np.repeat(begin[opens], size[opens])
            index = index + (np.arange(len(index)) - np.repeat(np.cumsum(size[opens]) - size[opens], size[opens]))
            owner = np.repeat(doc[opens], size[opens])
            order = np.argsort(owner, kind="stable")
            index, owner = index[order], owner[order]
            weight = np.repeat(np.where(kind[opens] == BOTH, 2, 1), size[opens])[order]
            per_doc = np.bincount(owner, minlength=len(texts))
            first, second = graph.edges(index)
            by_doc = np.argsort(doc[covers], kind="stable")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(wid, wid + len(texts))), batch.column("doc_id"), *results,
                 pa.array([t.decode() if w else None for t, w in zip(texts, waits.tolist())], pa.string()),
                 _lists(np.bincount(doc[covers], minlength=len(texts)), place[covers][by_doc]),
                 *[_lists(per_doc, x) for x in (index - graph.begins[owner], first, second, weight)]], names=[f.name for f in schema])
            wid += len(texts)

    return rows.select("*", *_text_key()).join(marked, ["k1", "k2"], "left").select("doc_id", "text", "marks").mapInArrow(measure, schema)


_RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
           T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept_text", T.StringType())]


def _covered(n: int, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run of ``size`` windows that starts at ``begin``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + sizes + WINDOW - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _results(texts: list[bytes], graph: _Graph, covered: np.ndarray, ready: np.ndarray) -> list[pa.Array]:
    """Result columns; hash, spans and text only for ``ready`` texts. Spans are starts and ends of removed runs."""
    removed, shas, kept, spans = [], [], [], []
    for k, text in enumerate(texts):
        mask = covered[graph.begins[k] : graph.ends[k]]
        n = int(np.count_nonzero(mask))
        removed.append(n)
        if not ready[k]:
            shas.append(None)
            kept.append(None)
            spans.append(None)
            continue
        words = text.split()
        left = b" ".join(compress(words, (~mask).tolist()) if n else words)
        shas.append(hashlib.sha256(left).hexdigest())
        kept.append(left.decode() if n else None)
        spans.append(np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist() if n else [])
    return [pa.array(graph.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
            pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.string())]


def judged(state: DataFrame) -> DataFrame:
    """The results of all rows of a written table of ``opened``."""
    edges = state.select("wid", F.col("text").isNotNull().alias("waits"), F.explode(F.arrays_zip("starts", "first", "second", "weights")).alias("e")).select(
        "wid", "waits", F.col("e.starts").alias("start"), F.col("e.first").alias("first"), F.col("e.second").alias("second"), F.col("e.weights").alias("weight"))
    repeated = written(edges.groupBy("first", "second").agg(F.sum("weight").alias("n")).where("n > 1").drop("n"), "repeated-edges")
    hits = edges.where("waits").join(repeated, ["first", "second"]).groupBy("wid").agg(F.collect_list("start").alias("hits"))
    waiting = state.where("text is not null").select("wid", "doc_id", "text", "places").join(hits, "wid", "left")
    schema = T.StructType([state.schema["doc_id"], *_RESULT])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BLOCK_BYTES):
            texts = _texts(batch)
            graph = _Graph(texts)
            parts = []
            for column, size in (("places", None), ("hits", 1)):
                lists = batch.column(column)
                doc = np.repeat(np.arange(len(texts)), np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64))
                values = np.array(lists.flatten(), np.int64)
                starts = values >> 6 if size is None else values
                parts.append((graph.begins[doc] + starts, (values & 63) >> 1 if size is None else np.ones(len(values), np.int64)))
            mask = _covered(graph.n, *(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_results(texts, graph, mask, np.ones(len(texts), bool))], names=[f.name for f in schema])

    return state.where("text is null").select(*[f.name for f in schema]).unionByName(waiting.mapInArrow(finish, schema))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans, kept_text)`` of every row.

    ``spans`` lists first and past-the-end word of the removed runs in turn; ``kept_text`` is null where nothing goes.
    """
    rows = _rows(docs, id_col, text_col)
    found = written(paths(rows), "paths")
    return judged(written(opened(rows, _by_text(found, resolved_paths(found))), "opened"))
