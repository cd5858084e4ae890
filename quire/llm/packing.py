"""Concatenate and cut: token streams packed into fixed windows (operator 3).

All documents form one token stream, each closed by a separator id, and the stream is cut every ``seq_len`` ids.
Only the last sequence can be short. The global position of a document comes from two passes:

1. every partition encodes its documents once and writes, per document, the ids and the number of ids that the
   same partition holds before it (a running sum inside the task);
2. the ids per partition are summed, prefix sums over these totals (one row per partition) give each partition's
   first global position, and every document's ids are cut at the window borders that its range crosses.

A document that crosses borders leaves one boundary record per window, flagged by ``is_boundary``. No row is
grouped, sorted or shuffled; what is broadcast has one row per input partition.

Cases: a null text is an empty document and holds the separator only; empty tables give no rows; repeated rows and
ids are packed once per row; extra columns are ignored; a document longer than a window spans several.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, held, partition_id, written

SEQ_LEN = 2048
SEPARATOR = 1
CACHE_WORDS = 800_000
BATCH_BYTES = 1 << 20

#: A full stop or comma beside a mark: they would be one pre-token.
_RUN = re.compile(r"[.,][^\w \t\n\r\x0b\f]|[^\w \t\n\r\x0b\f][.,]|_[.,]|[.,]_")


def pre_tokens(text: str) -> list[bytes]:
    """The words of a text, in a form that has the same ids and fewer different words.

    The tokenizer lower-cases what it reads and keeps a run of marks apart from letters and digits. So a composed text
    may be lower-cased here (but for special strings, a letter whose lower case depends on its neighbours, and texts
    whose lower case is longer or no longer composed), and single full stops and commas may stand apart.
    """
    if "<|" in text or "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
        return text.encode().split()
    lower = text.lower()
    if len(lower) != len(text) or not unicodedata.is_normalized("NFC", lower):
        return text.encode().split()
    text = lower
    if not _RUN.search(text):
        text = text.replace(".", " . ").replace(",", " , ")
    return text.encode().split()


def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """``texts -> ids`` (little-endian unsigned 32-bit) for a tokenizer file whose pre-tokens never hold white space.

    Such a tokenizer (here one that also lower-cases) encodes the words of a text independently, so each word is encoded once per batch and looked
    up in a cache of bounded size. New words of letters are encoded many at a time, joined by spaces: each is one
    pre-token and its last id carries the end-of-word mark, which tells the words' ids apart again.
    """
    return held(f"words {path}", lambda: _word_encoder(path))


def _word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    closes = np.zeros(tok.get_vocab_size(), bool)
    closes[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
    cache: dict[bytes, bytes] = {}

    def encode_new(words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        rest = [i for i, t in enumerate(texts) if not t.isalpha()]
        for at in range(0, len(plain), 64):
            part = plain[at : at + 64]
            ids = np.array(tok.encode(" ".join([texts[i] for i in part]), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(closes[ids]) + 1) * 4
            if len(ends) != len(part) or ends[-1] != ids.nbytes:  # the normalizer has split a letter
                rest += part
                continue
            raw, stops = ids.tobytes(), ends.tolist()
            cache.update((words[i], raw[a:b]) for i, a, b in zip(part, [0, *stops], stops))
        for at in range(0, len(rest), 1024):
            part = rest[at : at + 1024]
            for i, e in zip(part, tok.encode_batch_fast([texts[i] for i in part], add_special_tokens=False), strict=True):
                cache[words[i]] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        words = [pre_tokens(t) for t in texts]
        new = set().union(*words).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set().union(*words)
        encode_new(list(new))
        ids = [b"".join(map(cache.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > 64:
                del cache[w]
        return ids

    return encode


def encoded(docs: DataFrame, path: str, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1: ``(doc_id, part, before, n_ids, ids)`` with ``before``: ids of the same partition ahead of the document.

    Ids are kept in two bytes where the vocabulary allows it.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("part", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    tail = np.array([separator], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, ids_of = partition_id(), 0, word_encoder(path)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            ids = [x + tail for x in ids_of([t or "" for t in batch.column("text").to_pylist()])]
            n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            ids = [_narrow(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "before", "n_ids", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, schema)


def _narrow(ids: bytes) -> bytes:
    """Two bytes an id; a document with a larger id keeps four (its length tells which)."""
    wide = np.frombuffer(ids, "<u4")
    return ids if len(wide) and wide.max() > 0xFFFF else wide.astype("<u2").tobytes()


def packed(stream: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Pass 2: the pieces of every document of a written ``encoded`` table, with their ids (unsigned 32-bit)."""
    totals = stream.groupBy("part").agg(F.sum("n_ids").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per input partition
    offsets = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).cast("long").alias("ahead"))
    placed = stream.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("ahead") + F.col("before")).alias("position"), "n_ids", "ids")
    schema = T.StructType([
        T.StructField("doc_id", stream.schema["doc_id"].dataType),
        *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
        T.StructField("is_boundary", T.BooleanType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "ids", 4 * BATCH_BYTES):
            out: list[list] = [[] for _ in range(9)]
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("position").to_pylist(), batch.column("n_ids").to_pylist(), batch.column("ids").to_pylist(), strict=True)
            for doc_id, position, n, raw in rows:
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                at = 0
                while at < n:
                    sequence, offset = divmod(position + at, seq_len)
                    length = min(n - at, seq_len - offset)
                    piece = ids[4 * at : 4 * (at + length)]
                    values = (doc_id, at, length, zlib.crc32(piece), n, sequence, offset, length < n, piece)
                    for column, value in zip(out, values):
                        column.append(value)
                    at += length
            arrays = [pa.array(x, type=t) for x, t in zip(out, [batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.bool_(), pa.binary()])]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    return placed.mapInArrow(cut, schema)


def pack(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, separator: int = SEPARATOR) -> DataFrame:
    """Both passes over ``docs``; the stream between them is a written table, so it is encoded once."""
    return packed(written(encoded(docs, path, separator), "pack-stream"), seq_len)
