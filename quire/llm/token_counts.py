"""Token counts of whole texts under a public byte-level BPE (operator 6).

Arrow batches go to the tokenizer library and only lengths come back. Two rules keep memory and work bounded:

* batches are balanced by bytes, not rows: rows are regrouped so that one piece of work holds about ``BATCH_BYTES``;
* long texts are split at safe boundaries: before a space that stands between two characters that are no white
  space. The pre-tokenizer of a byte-level BPE starts a new pre-token there whatever the neighbours are (a space
  belongs to the word after it), and no special string holds a space, so the counts of the pieces add up to the
  count of the text. Every text is cut at all its safe boundaries; equal pieces of a batch are encoded once and
  counts of pieces seen before are looked up in a cache of bounded size. A text without a safe boundary is one piece.

Cases: a null text counts as empty (0 bytes, 0 tokens); empty tables give no rows; repeated rows give repeated rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, held

BATCH_BYTES = 1 << 20
CACHE_PIECES = 800_000
LONGEST_CACHED = 64
SAFE = re.compile(r"(?<=\S) (?=\S)")

def encoder(path: str) -> Callable[[list[str]], list[int]]:
    """``texts -> token counts`` of the library that reads ``path``; loaded once per Python worker and stage."""
    return held(f"counts {path}", lambda: _encoder(path))


def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]


def safe_pieces(text: str) -> list[str]:
    """The text cut at every safe boundary; joined, the pieces are the text."""
    first, *rest = SAFE.split(text)
    return [first, *(" " + x for x in rest)]


def count_texts(texts: list[str], path: str) -> list[int]:
    """Token counts of whole texts. Pieces that the cache lacks are encoded together, in batches of bounded bytes."""
    encode = encoder(path)
    if path.endswith(".model"):  # the normalizer of these files looks across spaces: whole texts only
        return encode(texts)
    cache = held(f"pieces {path}", dict)
    pieces = [safe_pieces(t) for t in texts]
    new = list(set().union(*pieces) - cache.keys())
    if len(cache) + len(new) > CACHE_PIECES:
        cache.clear()
        new = list(set().union(*pieces))
    for at in range(0, len(new), 4096):
        part = new[at : at + 4096]
        cache.update(zip(part, encode(part), strict=True))
    counts = [sum(map(cache.__getitem__, p)) for p in pieces]
    for piece in new:
        if len(piece) > LONGEST_CACHED:
            del cache[piece]
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            n = count_texts(texts.to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
