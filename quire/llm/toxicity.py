"""Toxic passages by maximum-scoring segments over token log-odds (operator 4).

Learning, from a bounded sample of labelled texts (``TRAIN_ROWS``; rows of the training side only):

* Features are lower-case words and, for longer words, their first ``STEM`` letters. The sample gives every feature's
  tokens in toxic and in other texts. Its score is the log-odds of both with an informative Dirichlet prior: pseudo-counts
  in the shares that features have in the whole sample, as many together as the toxic texts have tokens. Features
  whose z-score and log-odds reach two limits carry these odds; all other tokens score a small negative drift, so the
  expected score of ordinary text is below 0.
* The limits are those of the grid ``LIMITS`` with the least log loss by cross-validation: each of ``FOLDS`` parts of the
  sample is scored by features learned from the other parts.
* Scores of segments in ordinary text follow an extreme-value law: a text of n tokens has about
  ``K n exp(-lambda S)`` maximal segments of score S or more by chance. Lambda solves the Karlin-Altschul equation
  over the token frequencies of the other documents, K is fitted to the segments that they really have (out of fold).
* One logistic curve, fitted out of fold as well, turns a document's evidence, the sum of ln(1 + 1/E) over its segments, into a probability. Each
  segment counts by its chance there, so the curve holds whatever the law's constants come to.

Scoring is one pass without shuffles: a linear-time scan (Ruzzo and Tompa) finds every maximal segment of a whole
text, segments with an expected chance count E below ``MAX_E`` are its toxic passages, and the evidence of all gives
the score. The model holds the features within the limits, so its size is bounded by the sample's vocabulary.

Cases: null and empty texts have no passage and get the score of no evidence; without labelled rows (or without both
labels) the score is 0 for every text; rows with null ids are scored and neither learned from nor held out; repeated
rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, held_out, labelled_sample, written

TRAIN_ROWS = 20_000
STEM = 5
FOLDS = 3
LIMITS = tuple((z, odds) for z in (2.0, 3.0, 4.5) for odds in (1.0, 2.0, 3.0))
DRIFT = 0.1
MAX_E = 0.05
PREDICT_AT = 0.7
BATCH_BYTES = 4 << 20

WORD = re.compile(r"\w+")


@dataclass
class Model:
    """Scores of words and of stems, the drift of all other tokens, and the calibration."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    drift: float = DRIFT
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    base: float = -np.inf

    def hits(self, low: str, tokens: list[str]) -> list[tuple[int, float, int, int]]:
        """``(token index, score, first, end)`` of every token with a score."""
        scores = {w: s for w in set(tokens) if (s := self.words.get(w) or self.stems.get(w[:STEM] if len(w) > STEM else None))}
        if not scores:
            return []
        return [(i, scores[m[0]], *m.span()) for i, m in enumerate(WORD.finditer(low)) if m[0] in scores]

    def segments(self, low: str, tokens: list[str]) -> list[tuple[int, int, float]]:
        """``(first, end, score)`` of every maximal segment, in characters."""
        return maximal_segments(self.hits(low, tokens), self.drift)

    def chances(self, n: int, scores: list[float]) -> np.ndarray:
        """The expected number of chance segments of at least each score in ``n`` tokens."""
        return np.maximum(1e-300, self.k * n * np.exp(-self.lam * np.array(scores, float)))

    def judged(self, text: str) -> tuple[float, list[tuple[int, int, float, float]]]:
        """The probability of a text, and ``(first, end, score, expected chance count)`` of its toxic passages."""
        low, tokens = tokenised(text)
        found = self.segments(low, tokens)
        chances = self.chances(len(tokens), [s for *_, s in found])
        passages = [(*x, float(e)) for x, e in zip(found, chances, strict=True) if e < MAX_E]
        return self.probability(evidence(chances)), passages

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.base + self.slope * evidence)))) if np.isfinite(self.base) else 0.0


def tokenised(text: str) -> tuple[str, list[str]]:
    """The text in lower case, character by character where it is, and its tokens."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer would shift positions
        low = "".join(c if len(x := c.lower()) != 1 else x for c in text)
    return low, WORD.findall(low)


def evidence(chances: np.ndarray) -> float:
    return float(np.log1p(np.log1p(1 / chances).sum()))


def maximal_segments(hits: list[tuple[int, float, int, int]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo-Tompa), in time linear in the number of scored tokens.

    Between scored tokens every token costs ``drift``. Each candidate keeps the cumulative score before and after it
    and a link to the last candidate with a smaller score before it, so every candidate is looked at once.
    """
    stack: list[list] = []  # [total before, total after, first char, end char, link]
    total, at = 0.0, 0
    for index, score, first, end in hits:
        total -= drift * (index - at)
        at = index + 1
        new = [total, total + score, first, end, -1]
        total += score
        while True:
            link = len(stack) - 1
            while link >= 0 and stack[link][0] >= new[0]:
                link = stack[link][4]
            if link < 0 or stack[link][1] >= new[1]:
                new[4] = link
                stack.append(new)
                break
            new = [stack[link][0], new[1], stack[link][2], new[3], -1]
            del stack[link:]
    return [(x[2], x[3], x[1] - x[0]) for x in stack]


def feature_counts(sample: DataFrame) -> DataFrame:
    """``(kind, feature, toxic, other)``: arrays, by fold, of a feature's tokens in texts of each label; of kind ``t`` all
    tokens and of kind ``d`` the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for text, y, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "fold")), strict=True):
                _, tokens = tokenised(text)
                for w, n in Counter(tokens).items():
                    seen["w", w, y, fold] += n
                    if len(w) > STEM:
                        seen["s", w[:STEM], y, fold] += n
                seen["t", "", y, fold] += len(tokens)
                seen["d", "", y, fold] += 1
            if len(seen) > 200_000:
                yield _rows(seen)
                seen = Counter()
        yield _rows(seen)

    def by_fold(y: int):
        return F.array(*[F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("fold") == f), F.col("n"))), F.lit(0)) for f in range(FOLDS)])

    counted = sample.select("text", "y", "fold").mapInArrow(count, "kind string, feature string, y int, fold int, n long")
    return counted.groupBy("kind", "feature").agg(by_fold(1).alias("toxic"), by_fold(0).alias("other"))


def _rows(seen: Counter) -> pa.RecordBatch:
    kind, feature, y, fold = zip(*seen, strict=True) if seen else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.string()), pa.array(feature, pa.string()), pa.array(y, pa.int32()), pa.array(fold, pa.int32()), pa.array(list(seen.values()), pa.int64())],
        names=["kind", "feature", "y", "fold", "n"])


def log_odds(toxic, other, all_toxic: int, all_other: int):
    """Log-odds and z-score of features with these tokens, of all tokens of either label; for numbers, arrays and columns.

    The prior has ``all_toxic`` pseudo-tokens, each feature's in proportion to its share of all tokens.
    """
    log, sqrt = (F.log, F.sqrt) if isinstance(toxic, Column) else (np.log, np.sqrt)
    prior = (toxic + other) * (all_toxic / (all_toxic + all_other))
    t, o = toxic + prior, other + prior
    odds = log(t / (2 * all_toxic - t)) - log(o / (all_other + all_toxic - o))
    return odds, odds / sqrt(1 / t + 1 / o)


def models(counts: DataFrame, out: int | None) -> list[Model]:
    """A model without calibration for each of ``LIMITS``, learned from all folds but ``out``."""
    def tokens(side: str) -> Column:
        kept = [F.col(side)[f] for f in range(FOLDS) if f != out]
        return sum(kept[1:], kept[0])

    slim = counts.select("kind", "feature", tokens("toxic").alias("toxic"), tokens("other").alias("other"))
    total = slim.where("kind = 't'").first()
    if not total or not total["toxic"] or not total["other"]:
        return [Model() for _ in LIMITS]
    odds, z = log_odds(F.col("toxic").cast("double"), F.col("other").cast("double"), total["toxic"], total["other"])
    chosen = (
        slim.where(F.col("kind").isin("w", "s") & (F.col("toxic") > 1)).withColumn("score", odds).withColumn("z", z)
        .where((F.col("z") >= min(z for z, _ in LIMITS)) & (F.col("score") >= min(s for _, s in LIMITS)))
        .collect())  # features of the sample, which is bounded
    made = []
    for least_z, least_odds in LIMITS:
        rows = [r for r in chosen if r["z"] >= least_z and r["score"] >= least_odds]
        model = Model(words={r["feature"]: r["score"] for r in rows if r["kind"] == "w"}, stems={r["feature"]: r["score"] for r in rows if r["kind"] == "s"})
        if rows:
            rates = np.array([r["other"] + 0.5 for r in rows]) / (total["other"] + 1)
            model.lam = karlin_altschul(np.array([r["score"] for r in rows]), rates, model.drift)
        made.append(model)
    return made


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn features, limits, extreme-value law and curve from a sample of at most ``rows`` labelled training rows."""
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    sample = written(labelled_sample(docs, labels, "toxic", rows).withColumn("fold", fold), "toxic-sample")
    counts = written(feature_counts(sample), "toxic-counts")
    seen = counts.where("kind = 'd'").first()
    if not seen or not sum(seen["toxic"]) or not sum(seen["other"]):
        return Model()
    return calibrated(sample, [models(counts, f) for f in range(FOLDS)], models(counts, None))


def karlin_altschul(scores: np.ndarray, rates: np.ndarray, drift: float) -> float:
    """The positive root of ``sum of rate * exp(lambda * score) = 1``; all remaining tokens score ``-drift``."""
    rest = max(0.0, 1 - rates.sum())
    low, high = 0.0, 50.0 / scores.max()
    for _ in range(200):
        mid = (low + high) / 2
        if (rates * np.exp(mid * scores)).sum() + rest * np.exp(-drift * mid) > 1:
            high = mid
        else:
            low = mid
    return max(low, 1e-3)


def calibrated(sample: DataFrame, by_fold: list[list[Model]], whole: list[Model]) -> Model:
    """The model of ``whole`` whose limits lose least out of fold, with the K and the curve that they have there."""
    shared = sample.sparkSession.sparkContext.broadcast(by_fold)

    def chance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, least, tokens = np.zeros(len(LIMITS), np.int64), np.full(len(LIMITS), np.inf), 0
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for text, fold in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                low, words = tokenised(text)
                tokens += len(words)
                for i, model in enumerate(shared.value[fold]):
                    found = [s for *_, s in model.segments(low, words)]
                    segments[i] += len(found)
                    least[i] = min(least[i], min(found, default=np.inf))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LIMITS))), pa.array(segments), pa.array(least), pa.array(np.full(len(LIMITS), tokens))], names=["i", "segments", "least", "tokens"])

    law = sample.where("y = 0").select("text", "fold").mapInArrow(chance, "i long, segments long, least double, tokens long")
    ks = np.ones(len(LIMITS))
    for r in law.groupBy("i").agg(F.sum("segments").alias("segments"), F.min("least").alias("least"), F.sum("tokens").alias("tokens")).collect():
        lam, least = whole[r["i"]].lam, r["least"] if np.isfinite(r["least"]) else 0.0
        ks[r["i"]] = (r["segments"] + 0.5) / (max(1, r["tokens"]) * float(np.exp(-lam * least)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            out = []
            for text, fold in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                low, words = tokenised(text)
                out.append([evidence(replace(m, k=k).chances(len(words), [s for *_, s in m.segments(low, words)])) for m, k in zip(shared.value[fold], ks, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(out, pa.list_(pa.float64()))], names=["y", "evidence"])

    seen = sample.select("text", "y", "fold").mapInArrow(judge, "y int, evidence array<double>").collect()  # a few numbers per row of the sample
    seen.sort(key=lambda r: (r["y"], r["evidence"]))
    y, x = np.array([r["y"] for r in seen], float), np.array([r["evidence"] for r in seen])
    curves = [logistic(x[:, i], y) for i in range(len(LIMITS))]
    best = min(range(len(LIMITS)), key=lambda i: (round(curves[i][2], 9), i))
    return replace(whole[best], k=float(ks[best]), base=curves[best][0], slope=curves[best][1])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Base and slope of the curve from evidence to probability, and its mean log loss."""
    # Platt's targets keep the curve finite where both labels separate
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design, w = np.stack([np.ones(len(x)), x], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ w))
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (target - p) - 1e-6 * w)
        w += step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    base, slope = float(w[0]), max(0.0, float(w[1]))
    at = base + slope * x
    return base, slope, float((np.logaddexp(0, at) - target * at).mean())


def toxic_passages(docs: DataFrame, model: Model, *keep: str, with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``score`` and ``passages`` (first, end, score, chance), besides the columns ``keep`` in
    ``row`` and the ``text``, which goes to Python once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("chance", T.DoubleType())])
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["text"].alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(passage))])
    arrow_passage = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            judged = [model.judged(t or "") for t in batch.column("text").to_pylist()]
            scores = [p for p, _ in judged]
            spans = [[dict(zip(("first", "end", "score", "chance"), x, strict=True)) for x in xs] for _, xs in judged]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text") if with_text else pa.nulls(batch.num_rows, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(spans, arrow_passage)], names=["row", "text", "score", "passages"])

    return rows.mapInArrow(scan, schema)


def toxicity(docs: DataFrame, labels: DataFrame, predict_at: float = PREDICT_AT) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_passages)`` of every row of ``docs``."""
    scored = toxic_passages(docs, fit(docs, labels), "doc_id")
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= predict_at).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def clean_documents(docs: DataFrame, labels: DataFrame, predict_at: float = PREDICT_AT) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    scored = toxic_passages(docs, fit(docs, labels), *[c for c in docs.columns if c != "text"], with_text=True)
    return scored.where(F.col("score") < predict_at).select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
