"""Alignment of the token sequences of two tokenizers by diagonal run skipping (operator 12).

Both tokenizers encode a space and the text; their tokens' byte ends are two rising arrays. Byte offsets where both
end cut the text into groups. **Diagonal run skipping** (``align``): at the current shift between the two indexes the
ends are compared in stretches whose length doubles while they agree (and halves where they stop), so one-to-one
stretches are jumped; where they disagree the irregular group is resolved by stepping the side that ends first until
both meet, which updates the shift.

**Links** are pairs of an A and a B token whose byte ranges overlap. How many documents hold a pair of ids linked is a
statistic of the whole corpus. It is joined per chunk, not per document: about ``CHUNK_BYTES`` of text share a
dictionary of pairs, so what is counted, joined and shuffled are dictionaries, and a pair that every document holds costs
one row per chunk. Then each chunk meets the counts of its dictionary once.

Memory: no row holds a chunk. A slice of documents (``SLICE_BYTES`` of text) leaves a task as soon as it is aligned, its links
compressed; a dictionary grows with the slices and follows them in parts of ``PART_PAIRS``. Both meet again in order of
the chunk, the dictionary first, so a task holds one chunk's counts and one slice.

Encoding: a text is cut at spaces between two characters that are no white space. The pre-tokenizer of a byte-level
BPE starts a new pre-token there, and no piece of the other model holds a space after another character, so the pieces
of a text are encoded independently and equal pieces once. Both sides end where a piece ends, so no group or link crosses
one: equal pieces are aligned once as well, and a text's groups and links are its pieces' one after the other. Where a
piece's bytes are not its text's (or the piece model does not hold to that rule) the whole text is encoded by the
libraries and aligned.

Cases: a null or empty text, or one whose joined token bytes differ from space + text (such as one with U+2581), has no
tokens: zeros and an empty digest; empty tables give no rows; repeated rows count as documents of their own; extra
columns are ignored; a text without a safe boundary is one piece, and one longer than ``CHUNK_BYTES`` a chunk of its own.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, forget_other_stages, held, partition_id, release_memory, small_batches, written

CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
PART_PAIRS = 1 << 14
CACHE_PIECES, CACHE_TOKENS = 250_000, 2_000_000
LONGEST_CACHED = 64
SAFE = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"


class Tokens:
    """Ids, token lengths in bytes and id texts of one tokenizer."""

    def __init__(self, path: str) -> None:
        self.piecewise = True
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.bytes = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(SPACE_MARK, " ").encode() for i, t in enumerate(names)]
            self.piecewise = not any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in names)
            self.encode: Callable[[list[str]], list[list[int]]] = lambda texts: model.encode(texts, num_threads=1)
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            tok.encode_special_tokens = True
            alphabet = _byte_alphabet()
            special = {i: t.content for i, t in tok.get_added_tokens_decoder().items()}
            vocab = {i: t for t, i in tok.get_vocab().items()}
            self.bytes = [special[i].encode() if i in special else bytes(alphabet[c] for c in vocab.get(i, "")) for i in range(max(vocab) + 1)]
            self.encode = lambda texts: [e.ids for e in tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: printable bytes are themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Two tokenizers over the same texts, with a cache of pieces of bounded size; lives as long as a task.

    The cache numbers pieces; the A ids, B ids and linked pairs of all pieces stand in one array each. When it is full, the
    pieces met in most calls stay, half of it at most; one met in a single call goes.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.sides = (_tokens(path_a), _tokens(path_b))
        self.a, self.b = self.sides
        # an id as it stands in a list of groups: inside a group, at the end of its side, at the end of its piece
        size = len(self.a.bytes)
        self.b_names = 2 * size
        self.names = [b"%d%b" % (i, mark) for i in range(size) for mark in (b",", b"|")]
        self.names += [b"%d%b" % (i, mark) for i in range(len(self.b.bytes)) for mark in (b",", b";", b"\n")]
        self._clear()

    def _clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat = [np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)]
        self.starts = [np.zeros(1, np.int64) for _ in self.flat]
        self.n_groups = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int32)  # calls that met the piece, since the cache was full
        self.groups: list[bytes] = []
        self.odd: set[str] = set()
        self.long: list[str] = []

    def _thin(self) -> None:
        """Keep the pieces that several calls met."""
        pieces, numbers = list(self.index), np.fromiter(self.index.values(), np.int64)
        order = np.argsort(-self.uses[numbers], kind="stable")
        order = order[: min(int((self.uses[numbers] > 1).sum()), CACHE_PIECES // 2)]
        tokens = np.cumsum(np.diff(self.starts[0])[numbers[order]])
        order = np.sort(order[: np.searchsorted(tokens, CACHE_TOKENS // 2, side="right")])
        kept = numbers[order]
        flat, starts, n_groups, groups, odd = self.flat, self.starts, self.n_groups, self.groups, self.odd
        self._clear()
        if not len(kept):
            return
        self.index.update((pieces[k], self.index.default_factory()) for k in order.tolist())
        for x in range(3):
            (self.flat[x],) = _gather(flat[x], starts[x], kept, np.array([len(kept)]))
            self.starts[x] = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.diff(starts[x])[kept])])
        self.n_groups, self.uses = n_groups[kept], np.zeros(len(kept), np.int32)
        self.groups = [groups[k] for k in kept.tolist()]
        self.odd = {x for x in odd if x in self.index}

    def encode(self, texts: list[str]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Ids of A and B per text, in blocks that end at safe boundaries; none where the joined bytes are not those of
        space + text."""
        owner, found, stops, whole = self._pieces(texts)
        out: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
        for k, a, b in zip(owner, *[_gather(self.flat[x], self.starts[x], found, stops) for x in (0, 1)]):
            out[k].append((a, b))
        for k in whole:
            out[k] = self._whole(texts[k])
        return out

    def aligned(self, texts: list[str]) -> list[list[tuple[list[int], bytes, np.ndarray]]]:
        """(numbers of A tokens, B tokens, groups and links, groups as text, linked pairs) per text, in blocks like those
        of ``encode``. A pair is ``a << 32 | b``."""
        owner, found, stops, whole = self._pieces(texts)
        sums = [np.cumsum(x[found])[stops - 1] for x in (*map(np.diff, self.starts), self.n_groups)]
        n_a, n_b, n_links, n_groups = (np.diff(x, prepend=0).tolist() for x in sums)
        numbers, at = found.tolist(), 0
        out: list[list[tuple[list[int], bytes, np.ndarray]]] = [[] for _ in texts]
        for k, stop, *row, pairs in zip(owner, stops.tolist(), n_a, n_b, n_groups, n_links, _gather(self.flat[2], self.starts[2], found, stops)):
            out[k].append((row, b";".join(map(self.groups.__getitem__, numbers[at:stop])), pairs))
            at = stop
        for k in whole:
            out[k] = []
            for a, b in self._whole(texts[k]):
                n_groups, groups, _, pairs = self._align(a, b, np.array([len(b)]))
                out[k].append(([len(a), len(b), int(n_groups[0]), len(pairs)], groups[0], pairs))
        return out

    def _align(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Tokens of pieces one after the other, ``ends_b`` where those of each end in B: the number of groups of each,
        the groups as text of those that have tokens, the number of links of each, and the linked pairs."""
        found = align(self.a.sizes[ids_a].cumsum().tolist(), self.b.sizes[ids_b].cumsum().tolist())
        stops_a, stops_b, links_a, links_b = (np.array(x, np.int64) for x in found)
        n_groups = np.diff(np.searchsorted(stops_b, ends_b, side="right"), prepend=0)
        n_links = np.diff(np.searchsorted(links_b, ends_b), prepend=0)
        pairs = (ids_a[links_a].astype(np.int64) << 32) | ids_b[links_b]
        return n_groups, self._groups_texts(ids_a, ids_b, stops_a, stops_b, ends_b[ends_b > 0]), n_links, pairs

    def _groups_texts(self, ids_a: np.ndarray, ids_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray, ends_b: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group, per piece."""
        sizes_a, sizes_b = np.diff(stops_a, prepend=0), np.diff(stops_b, prepend=0)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[stops_a - 1] = 1
        last_b[stops_b - 1] = 1
        last_b[ends_b - 1] = 2
        names = np.empty(len(ids_a) + len(ids_b), np.int64)
        names[np.arange(len(ids_a)) + np.repeat(stops_b - sizes_b, sizes_a)] = 2 * ids_a + last_a
        names[np.arange(len(ids_b)) + np.repeat(stops_a, sizes_b)] = self.b_names + 3 * ids_b + last_b
        return b"".join(map(self.names.__getitem__, names.tolist())).split(b"\n")[:-1]

    def _pieces(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray, set[int]]:
        """The text of every block, the numbers of all blocks' pieces, where each block ends in them, and the texts that
        are encoded whole instead."""
        for piece in self.long:
            self.groups[self.index.pop(piece)] = b""
            self.odd.discard(piece)
        self.long = []
        if len(self.index) > CACHE_PIECES or len(self.flat[0]) > CACHE_TOKENS:
            self._thin()
        if not (self.a.piecewise and self.b.piecewise):
            return [], np.empty(0, np.int64), np.empty(0, np.int64), set(range(len(texts)))
        blocks: list[list[str]] = []
        owner: list[int] = []
        for k, text in enumerate(texts):
            pieces = SAFE.split(text) if text else []
            step = len(pieces) if len(text) <= SLICE_BYTES else max(len(pieces) * SLICE_BYTES // len(text), 1)
            for at in range(0, len(pieces), step or 1):
                blocks.append(pieces[at : at + step])
                owner.append(k)
        known = len(self.index)
        found = np.fromiter(map(self.index.__getitem__, chain.from_iterable(blocks)), np.int64)
        new = list(islice(reversed(self.index), len(self.index) - known))[::-1]  # numbered just now, in this order
        self._learn(new)
        self.uses = np.concatenate([self.uses, np.zeros(len(self.groups) - len(self.uses), np.int32)])
        self.uses += np.bincount(found, minlength=len(self.uses)) > 0
        self.long = [x for x in new if len(x) > LONGEST_CACHED]
        whole = {k for k, block in zip(owner, blocks) if self.odd and not self.odd.isdisjoint(block)}
        return owner, found, np.cumsum([len(x) for x in blocks], dtype=np.int64), whole

    def _learn(self, new: list[str]) -> None:
        """Encode and align pieces. An odd piece, whose tokens do not hold its bytes, has none."""
        flat, sizes, n_groups = [[] for _ in self.flat], [[] for _ in self.flat], [self.n_groups]
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            want = [b" " + x.encode() for x in part]
            ids = [tokens.encode(part) for tokens in self.sides]
            sides = [_joined(x) for x in ids]
            odd: set[int] = set()
            for tokens, found, (joined, lengths) in zip(self.sides, ids, sides):
                ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(tokens.sizes[joined])])[np.cumsum(lengths)]
                if tokens.text(joined.tolist()) != b"".join(want) or ends.tolist() != list(accumulate(map(len, want))):
                    odd.update(k for k, (w, i) in enumerate(zip(want, found)) if tokens.text(i) != w)
            if odd:
                self.odd.update(part[k] for k in odd)
                sides = [_joined([[] if k in odd else i for k, i in enumerate(found)]) for found in ids]
            (a, sizes_a), (b, sizes_b) = sides
            counted, groups, n_links, pairs = self._align(a, b, np.cumsum(sizes_b))
            texts = iter(groups)
            self.groups += [next(texts) if size else b"" for size in sizes_b.tolist()]
            n_groups.append(counted)
            for x, values, lengths in zip(range(3), (a, b, pairs), (sizes_a, sizes_b, n_links)):
                flat[x].append(values)
                sizes[x].append(lengths)
        if new:
            self.n_groups = np.concatenate(n_groups)
            for x in range(3):  # one after the other: each frees what it replaces
                self.starts[x] = np.concatenate([self.starts[x], self.starts[x][-1] + np.cumsum(np.concatenate(sizes[x]))])
                self.flat[x] = np.concatenate([self.flat[x], *flat[x]])

    def _whole(self, text: str) -> list[tuple[np.ndarray, np.ndarray]]:
        (a,), (b,), want = self.a.encode([text]), self.b.encode([text]), b" " + text.encode()
        if not text or self.a.text(a) != want or self.b.text(b) != want:
            return []
        return [(np.array(a, np.int32), np.array(b, np.int32))]


def _joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each list has."""
    return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))


def _gather(flat: np.ndarray, starts: np.ndarray, found: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    """The values of numbered pieces one after the other, cut after the pieces ``stops``."""
    sizes = starts[found + 1] - starts[found]
    ends = np.cumsum(sizes)
    ids = flat[np.repeat(starts[found] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return np.split(ids, ends[stops - 1][:-1]) if len(stops) else []


def _tokens(path: str) -> Tokens:
    return held(f"tokens {path}", lambda: Tokens(path))


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ends of the groups as indexes into A and B (exclusive), and the links as indexes into A and B.

    Both arrays rise and end at the same byte.
    """
    stops_a: list[int] = []
    stops_b: list[int] = []
    links_a: list[int] = []
    links_b: list[int] = []
    i, j, n = 0, 0, len(ends_a)
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            shift, start, step = j - i, i, 2
            i += 1
            j += 1
            while i < n and ends_a[i : i + step] == ends_b[j : j + step]:  # probe ahead on the diagonal
                i += step
                j += step
                step += step
            while step > 1 and i < n:  # the first difference lies within the last stretch
                step >>= 1
                if ends_a[i : i + step] == ends_b[j : j + step]:
                    i += step
                    j += step
            if i > n:  # slices beyond both ends are equal
                i, j = n, n + shift
            links_a += range(start, i)
            links_b += range(start + shift, j)
            stops_a += range(start + 1, i + 1)
            stops_b += range(start + shift + 1, j + 1)
        else:  # an irregular group: step the side that ends first until both meet
            while True:
                links_a.append(i)
                links_b.append(j)
                if x < y:
                    i += 1
                    x = ends_a[i]
                elif y < x:
                    j += 1
                    y = ends_b[j]
                else:
                    break
            i += 1
            j += 1
            stops_a.append(i)
            stops_b.append(j)
    return stops_a, stops_b, links_a, links_b


# ------------------------------------------------------------------------------------------------ corpus


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _chunk_schema(doc_id: T.DataType) -> T.StructType:
    def many(kind: T.DataType) -> T.ArrayType:
        return T.ArrayType(kind)

    return T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("at", T.IntegerType()),  # number of a slice, first code of a part
        T.StructField("doc_ids", many(doc_id)), *[T.StructField(c, many(T.LongType())) for c in _COUNTS],
        T.StructField("sha", many(T.StringType())), T.StructField("links", T.BinaryType()),
        T.StructField("pairs", many(T.LongType())), T.StructField("docs", many(T.IntegerType())),
    ])


def _links(sizes: np.ndarray, ranks: np.ndarray, times: np.ndarray, codes: np.ndarray) -> bytes:
    """Links of a slice as bytes: different pairs per document, their ranks among the slice's pairs (rising in a document)
    and times, and the code of every rank. Values are parted into bytes by place, which compress better."""
    arrays = [np.asarray(x, "<i4") for x in (sizes, np.diff(ranks, prepend=0), times, codes)]
    raw = b"".join(x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in arrays)
    return struct.pack("<4i", *map(len, arrays)) + pa.compress(raw, codec="zstd", asbytes=True)


def _unlinked(links: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, codes and times of ``_links``."""
    lengths = struct.unpack_from("<4i", links)
    raw = np.frombuffer(pa.decompress(memoryview(links)[16:], 4 * sum(lengths), codec="zstd"), np.uint8)
    parts = np.split(raw, 4 * np.cumsum(lengths[:3]))
    sizes, steps, times, codes = (np.ascontiguousarray(x.reshape(4, -1).T).view("<i4").ravel() for x in parts)
    return sizes, codes[np.cumsum(steps, dtype=np.int64)], times.astype(np.int64)


class Dictionary:
    """The pairs of a chunk, numbered as they come, and how many documents hold each."""

    def __init__(self) -> None:
        self.pairs, self.codes = np.empty(0, np.int64), np.empty(0, np.int32)  # rising, and their codes
        self.docs = np.empty(0, np.int32)  # by code

    def add(self, pairs: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Codes of different, rising pairs that so many more documents hold."""
        at = np.searchsorted(self.pairs, pairs)
        new = np.ones(len(pairs), bool)
        inside = at < len(self.pairs)
        new[inside] = self.pairs[at[inside]] != pairs[inside]
        first = len(self.docs)
        self.docs = np.concatenate([self.docs, np.zeros(int(new.sum()), np.int32)])
        self.codes = np.insert(self.codes, at[new], np.arange(first, len(self.docs), dtype=np.int32))
        self.pairs = np.insert(self.pairs, at[new], pairs[new])
        codes = self.codes[np.searchsorted(self.pairs, pairs)]
        self.docs[codes] += docs.astype(np.int32)
        return codes

    def parts(self, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First code, pairs and documents of stretches of codes."""
        pairs = np.empty_like(self.pairs)
        pairs[self.codes] = self.pairs
        for at in range(0, len(pairs), size):
            yield at, pairs[at : at + size], self.docs[at : at + size]


def chunks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of two kinds per chunk. Slices: some documents' alignment counts and their links as codes into the chunk's
    dictionary (``links``). Parts of the dictionary: ``pairs`` from code ``at`` on, and in how many of the chunk's documents
    each is linked (``docs``). A pair is ``a << 32 | b``."""
    schema = _chunk_schema(docs.schema[id_col].dataType)
    kinds = _arrow_schema(schema)

    def row(*values: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(values, kinds, strict=True)], schema=kinds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, tokens = partition_id(), 0, Pair(path_a, path_b)
        known, held, n_slices = Dictionary(), 0, 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal known, held, n_slices, made
            for at, pairs, docs in known.parts(PART_PAIRS):
                yield row((part << 32) + made, at, *[None] * 7, pairs, docs)
            known, held, n_slices, made = Dictionary(), 0, 0, made + 1

        for batch in byte_slices(batches, "text", min(SLICE_BYTES, chunk_bytes)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows, found, n_times = [], [], []
            for text, blocks in zip(texts, tokens.aligned(texts), strict=True):
                counts, digest, links = [0, 0, 0, 0], hashlib.sha256(), []
                for some, groups, pairs in blocks:
                    counts = [x + y for x, y in zip(counts, some)]
                    digest.update(b";" + groups if links else groups)
                    links.append(pairs)
                pairs, times = np.unique(np.concatenate([np.empty(0, np.int64), *links]), return_counts=True)
                rows.append((*counts, digest.hexdigest() if blocks else ""))
                found.append(pairs)
                n_times.append(times)
                held += len(text) + 64
            pairs, ranks, n_docs = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            links = _links([len(x) for x in found], ranks, np.concatenate(n_times), known.add(pairs, n_docs))
            yield row((part << 32) + made, n_slices, batch.column("doc_id").to_pylist(), *map(list, zip(*rows)), links, None, None)
            n_slices += 1
            if held > chunk_bytes:
                yield from closed()
        if n_slices:
            yield from closed()
        del tokens
        release_memory()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pack, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pair_counts(packed: DataFrame) -> DataFrame:
    """``(pair, n_docs, is_best)`` over the corpus: documents that hold the pair linked, and whether no other pair of
    its A id is held by more."""
    pairs = packed.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.docs").cast("long").alias("docs"))
    counts = written(pairs.groupBy("pair").agg(F.sum("docs").alias("n_docs")), "pair-counts")
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))
    return counts.withColumn("a_id", a_id).join(most, "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document the sizes of its alignment, its links' corpus counts and a digest of its groups."""
    with small_batches(docs.sparkSession):
        packed = written(chunks(docs, path_a, path_b, chunk_bytes=chunk_bytes), "aligned")
    entries = packed.select("chunk", F.posexplode("pairs").alias("pos", "pair"), "at").withColumn("code", F.col("at") + F.col("pos"))
    code = F.col("code")
    known = (
        entries.join(pair_counts(packed), "pair")
        .groupBy("chunk", (code - code % PART_PAIRS).alias("at")).agg(F.sort_array(F.collect_list(F.struct("code", "n_docs", "is_best"))).alias("known"))
        .select("chunk", "at", F.col("known.n_docs").alias("n_docs"), F.col("known.is_best").alias("is_best"))
    )
    slices = packed.where(F.col("links").isNotNull()).drop("pairs", "docs")
    # a chunk's dictionary goes before its slices: it is sent once, not with each of them
    rows = known.unionByName(slices, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.col("links").isNotNull(), "at")
    doc_type = packed.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", doc_type), *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    ])
    names = [f.name for f in schema]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_other_stages()
        release_memory()
        chunk, n_docs, is_best = None, np.empty(0, np.int64), np.empty(0, bool)
        for batch in batches:
            for k, at in enumerate(batch.column("chunk").to_pylist()):
                row = batch.slice(k, 1)
                if at != chunk:
                    chunk, n_docs, is_best = at, np.empty(0, np.int64), np.empty(0, bool)
                links = row.column("links")[0].as_py()
                if links is None:
                    n_docs = np.concatenate([n_docs, row.column("n_docs").flatten().to_numpy()])
                    is_best = np.concatenate([is_best, row.column("is_best").flatten().to_numpy(zero_copy_only=False)])
                    continue
                sizes, codes, times = _unlinked(links)
                stops = np.cumsum(sizes, dtype=np.int64)
                sums = [np.concatenate([np.zeros(1, np.int64), np.cumsum(times * x[codes])]) for x in (is_best, n_docs)]
                yield pa.RecordBatch.from_arrays(
                    [*[row.column(c).flatten() for c in ("doc_ids", *_COUNTS)], *[pa.array(x[stops] - x[stops - sizes]) for x in sums], row.column("sha").flatten()], names=names)

    return rows.mapInArrow(counted, schema)
