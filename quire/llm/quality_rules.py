"""Quality rules: base counts and a hashed n-gram log-likelihood ratio (operator 1).

Every word and every pair of neighbouring words of a text is hashed into one of ``BUCKETS`` buckets. Two multinomials
over the buckets are counted, one over the trusted target (documents labelled as good) and one over the whole raw
corpus, both smoothed by one count per bucket. A document's score is the mean of log(target / raw) over its n-grams,
so long and short texts compare. Thresholding is deterministic: a document is kept if the base rules pass and its
score is at least ``THRESHOLD``.

Counting is one pass over all texts beside a mark for trusted ids, which a merge join sets: texts and ids are shuffled by
id once, whatever their number, so that disk grows in proportion to the texts, and skewed ids are split. A task adds up
its own counts and returns at most ``BUCKETS`` rows, summed by bucket. The model has ``BUCKETS`` numbers whatever the
corpus; that is all that reaches the driver. Scoring is a second pass without any shuffle.

Base rules, over words ``[^\\x20\\x09-\\x0D]+``: characters in words, symbol characters, lines that repeat an earlier
line, and words in 8-word windows that occur twice or more.

Cases: a null or empty text has no words, a score of 0 and fails the base rules; without trusted documents (or for an
empty table) both models are the smoothing alone for the target; repeated rows count as often as they occur; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices

BUCKETS = 1 << 14
THRESHOLD = -0.05
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BATCH_BYTES = 4 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def gram_buckets(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all words, then of all pairs of neighbouring words (multiply-shift hashing)."""
    shift = np.uint64(64 - (buckets - 1).bit_length())
    one = (hashes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    two = ((one[:-1] ^ (one[:-1] >> np.uint64(32))) + hashes[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([one, two]) >> shift).astype(np.int64)


def repeated_words(words: list[bytes], hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` (a power of two) words which occurs twice or more in the text.

    Hashes of windows tell whether there is any such window; if so, windows are numbered exactly by doubling:
    the number of a run of 2k words is the number of its pair of runs of k words.
    """
    n = len(words)
    if n <= window:
        return 0
    h = (hashes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width = 1
    while width < window:
        h = h[:-width] * np.uint64(0xBF58476D1CE4E5B9) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    numbers: dict[bytes, int] = {}
    runs = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    width = 1
    while width < window:
        _, runs, counts = np.unique(runs[:-width] * n + runs[width:], return_inverse=True, return_counts=True)
        width *= 2
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(counts[runs] > 1)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int]:
    """``(word_chars, n_symbols, n_dup_lines, n_repeat_words)`` of a text given its words."""
    raw = np.frombuffer(text, np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum()) - int(_SPACE[raw].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return chars, int(_SYMBOL[raw].sum()), len(lines) - len(set(lines)), repeated_words(words, hashes)


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, good, n)``: n-grams of the rows whose id is in ``trusted``, and of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for text, is_good in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("good").to_pylist(), strict=True):
                if text:
                    n = np.bincount(gram_buckets(word_hashes(text.split()), buckets), minlength=buckets)
                    total[1] += n
                    if is_good:
                        total[0] += n
        at = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "good", "n"])

    ids = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().withColumn("good", F.lit(True))
    marked = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counted = marked.mapInArrow(count, "bucket long, good long, n long")
    return counted.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket: log of its share among the n-grams of trusted documents over its share in the whole corpus.

    ``trusted`` holds ids, any number of them.
    """
    good, raw = np.ones(buckets), np.ones(buckets)
    for row in gram_counts(docs, trusted, buckets).collect():  # at most one row per bucket
        good[row["bucket"]] += row["good"]
        raw[row["bucket"]] += row["n"]
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def score_documents(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept)`` per row."""
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = model.value
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = text or b""
                words = text.split()
                hashes = word_hashes(words)
                mean = float(ratio[gram_buckets(hashes, len(ratio))].mean()) if words else 0.0
                rows.append((len(words), *base_counts(text, words, hashes), mean))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.float64())], names=[f.name for f in schema])

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = docs.select("doc_id", "text").mapInArrow(score, schema).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def quality_rules(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Fit both models and judge every row of ``docs``."""
    return score_documents(docs, log_ratios(docs, trusted, buckets), threshold)
