"""Text quality by attention over passages: multiple-instance learning from document labels (operator 7).

* A document is a bag of passages of ``PASSAGE`` bytes (cut anywhere; a last short one counts as a passage). Every
  passage is encoded as a vector: shares of character classes, the share of its words that the document repeats,
  lengths, and a hashed histogram of byte pairs.
* A gated attention network (Ilse, Tomczak and Welling, 2018) is trained on document labels only. With
  ``h = relu(E x)`` per passage, attention weights are a softmax over the document of
  ``w . (tanh(V h) * sigmoid(U h))``; the document's representation is the weighted sum of its ``h`` and a logistic
  unit scores it. Gradients are written out in numpy; mini-batches, Adam, a fixed seed.
* The training set is a bounded sample: ``TRAIN_ROWS`` labelled rows of the training side, those with the smallest
  hash of the id. Only their passage vectors reach the driver. Texts of any length are encoded whole.

Scoring is one pass over all rows without shuffles.

Cases: null and empty texts are one passage of zeros and get a score like every text; without labelled rows (or with
one label only) the score is that label's smoothed share, 0.5 without any; rows with null ids are scored and neither
learned from nor held out; repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_slices, held_out, labelled_sample

TRAIN_ROWS = 6_000
PASSAGE = 512
PAIRS = 32
HIDDEN = 24
GATES = 12
EPOCHS = 30
BATCH_DOCS = 256
PREDICT_AT = 0.5
BATCH_BYTES = 2 << 20

_CLASSES = 9
_CLASS = np.full(256, 7, np.int64)  # other printable
_CLASS[0x80:] = 8
_CLASS[list(range(0x00, 0x20))] = 0
_CLASS[0x20] = 1
_CLASS[0x0A] = 2
_CLASS[list(b"0123456789")] = 3
_CLASS[list(range(ord("A"), ord("Z") + 1))] = 4
_CLASS[list(range(ord("a"), ord("z") + 1))] = 5
_CLASS[list(b".,;:'\"?-()")] = 6
DIM = _CLASSES + 4 + PAIRS


def encode(text: bytes) -> np.ndarray:
    """One vector of ``DIM`` numbers per passage of the text."""
    n = max(1, -(-len(text) // PASSAGE))
    out = np.zeros((n, DIM), np.float32)
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    of = np.arange(len(raw)) // PASSAGE
    size = np.bincount(of, minlength=n)
    kinds = _CLASS[raw]
    out[:, :_CLASSES] = np.bincount(of * _CLASSES + kinds, minlength=n * _CLASSES).reshape(n, -1) / size[:, None]
    # words: their number, how many of them the document repeats, and how many equal the word before
    blank = kinds <= 2
    opens = ~blank & np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(opens)
    if len(starts):
        ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
        index = np.arange(len(raw))
        place = index - np.maximum.accumulate(np.where(opens, index, 0))
        hashed = (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, 255)] * ~blank
        words = np.add.reduceat(hashed, starts)
        _, number, count = np.unique(words, return_inverse=True, return_counts=True)
        w = of[starts]
        per = np.maximum(1, np.bincount(w, minlength=n))
        out[:, _CLASSES] = np.bincount(w, minlength=n) / size * 4
        share = count[number] / len(words)
        out[:, _CLASSES + 1] = np.bincount(w, np.minimum(1, share * 8) * (count[number] > 1), minlength=n) / per
        same = np.concatenate([[False], words[1:] == words[:-1]])
        out[:, _CLASSES + 2] = np.bincount(w, same, minlength=n) / per
        out[:, _CLASSES + 3] = np.bincount(w, np.minimum(ends - starts, 30) / 30, minlength=n) / per
    if len(raw) > 1:
        pairs = (raw[:-1].astype(np.uint32) * np.uint32(0x9E3779B1) + raw[1:].astype(np.uint32) * np.uint32(0x85EBCA6B)) >> np.uint32(27)
        out[:, _CLASSES + 4 :] = np.sqrt(np.bincount(of[:-1] * PAIRS + pairs, minlength=n * PAIRS).reshape(n, -1) / size[:, None])
    return out


_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 2**64) for i in range(256)], np.uint64)


class Network:
    """Gated attention pooling with a logistic unit; ``parts`` holds its parameters."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
        self.mean, self.spread = np.zeros(DIM), np.ones(DIM)
        self.parts = {"E": scale(DIM, HIDDEN), "e": np.zeros(HIDDEN), "V": scale(HIDDEN, GATES), "U": scale(HIDDEN, GATES),
                      "w": scale(GATES, 1)[:, 0], "c": scale(HIDDEN, 1)[:, 0], "b": np.zeros(1)}

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Probabilities of the bags that begin at ``starts`` in the passages ``x``, and what the gradient needs."""
        p = self.parts
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        x = (x - self.mean) / self.spread
        h = np.maximum(0, x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        a = np.exp(a - np.maximum.reduceat(a, starts)[of])
        a /= np.add.reduceat(a, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return y, {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "of": of}

    def gradient(self, y: np.ndarray, target: np.ndarray, weight: np.ndarray, s: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted mean cross-entropy."""
        p, of = self.parts, s["of"]
        d = (y - target) * weight / weight.sum()
        dz = d[:, None] * p["c"]
        da = (s["h"] * dz[of]).sum(1)
        ds = s["a"] * (da - np.add.reduceat(s["a"] * da, starts)[of])  # through the softmax
        dg = ds[:, None] * p["w"]
        dt, du = dg * s["g"] * (1 - s["t"] ** 2), dg * s["t"] * s["g"] * (1 - s["g"])
        dh = (s["a"][:, None] * dz[of] + dt @ p["V"].T + du @ p["U"].T) * (s["h"] > 0)
        return {"c": s["z"].T @ d, "b": np.array([d.sum()]), "w": (s["t"] * s["g"]).T @ ds, "V": s["h"].T @ dt, "U": s["h"].T @ du, "E": s["x"].T @ dh, "e": dh.sum(0)}


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Adam over mini-batches of bags; both labels weigh the same in total."""
    net, rng = Network(seed), np.random.default_rng(seed)
    every = np.concatenate(bags)
    net.mean, net.spread = every.mean(0).astype(float), every.std(0).astype(float) + 1e-3
    share = labels.mean()
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first, second = ({k: np.zeros_like(v) for k, v in net.parts.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH_DOCS):
            some = order[at : at + BATCH_DOCS]
            x = np.concatenate([bags[i] for i in some]).astype(float)
            starts = np.cumsum([0, *(len(bags[i]) for i in some[:-1])])
            y, state = net.forward(x, starts)
            grad = net.gradient(y, labels[some], weights[some], state, starts)
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for k, g in grad.items():
                g = g + 1e-4 * net.parts[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.parts[k] = net.parts[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    # undo the equal weighting of the labels, so that 0.5 stands for even odds in the sample
    net.parts["b"] = net.parts["b"] + np.log(share / (1 - share))
    return net


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network | float:
    """The trained network, or a constant where the sample lacks a label."""
    sample = labelled_sample(docs, labels, "quality", rows)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            bags = [encode(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(bags, pa.binary())], names=["doc_id", "y", "bag"])

    schema = T.StructType([docs.schema.fields[docs.columns.index("doc_id")], T.StructField("y", T.IntegerType()), T.StructField("bag", T.BinaryType())])
    seen = sample.select("doc_id", "text", "y").mapInArrow(vectors, schema).collect()  # the sample is bounded
    seen.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    y = np.array([r["y"] for r in seen], float)
    if not len(y) or y.min() == y.max():
        return float((y.sum() + 0.5) / (len(y) + 1))
    return train([np.frombuffer(r["bag"], np.float32).reshape(-1, DIM) for r in seen], y)


def score_documents(docs: DataFrame, model: Network | float) -> DataFrame:
    """``(doc_id, score, n_passages, attention)``: the score, and the largest attention weight, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("n_passages", T.LongType()), T.StructField("attention", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            bags = [encode(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            n = np.array([len(x) for x in bags], np.int64)
            starts = np.cumsum(n) - n
            if isinstance(model, float):
                y, top = np.full(len(n), model), 1 / n
            else:
                y, state = model.forward(np.concatenate(bags), starts)
                top = np.maximum.reduceat(state["a"], starts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(y), pa.array(n), pa.array(top)], names=["doc_id", "score", "n_passages", "attention"])

    return docs.select("doc_id", "text").mapInArrow(score, schema)


def quality(docs: DataFrame, labels: DataFrame, predict_at: float = PREDICT_AT) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_passages, attention)`` of every row of ``docs``."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= predict_at).cast("int").alias("predicted"), "n_passages", "attention")
