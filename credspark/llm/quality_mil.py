"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE bytes.  A passage is encoded by one
learned tanh layer over its byte statistics (shares of character classes and
of hashed byte pairs, word length, share of distinct words).  A gated
attention weighs the passages, softmax over w . (tanh(V h) * sigmoid(U h)),
and a logistic unit scores the weighted sum of their codes.  Only the document's
label is known in training; the weights of the passages are learned with it.

The model is fitted on the driver on TRAIN_DOCS labelled documents at most (a
bounded sample, picked by hash), and is a few thousand numbers.  Scoring
reads whole texts of any length, a few megabytes at a time.

Defined results: a null or empty text is one passage of zeros and has that
passage's score; repeated rows get equal scores; without labels of both kinds
every score is the share of label 1 (0.5 where there is none); an empty table
gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import Words, labelled, passes, small_batches

PASSAGE = 512
PAIRS = 256
CODE, GATE = 24, 12
TRAIN_DOCS = 3000
PREDICT_FROM = 0.7

_SYMBOLS = b"#*$%&|<>"
_CLASS = np.zeros(256, np.int64)        # 0: other punctuation and control bytes
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (1 if _b >= 128 else 2 if _c.isupper() else 3 if _c.islower() else 4 if _c.isdigit() else
                  5 if _c == "\n" else 6 if _c.isspace() else 7 if _b in _SYMBOLS else 8 if _c in "!?" else 0)
CLASSES = 9
FEATURES = CLASSES + PAIRS + 3


def passage_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, FEATURES) of the texts, and the index of each text's first passage."""
    w = Words(texts)
    sizes = w.ends - 1 - w.starts
    n = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(n) - n
    total = int(n.sum())
    of_text = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(w.buf)) - w.starts[of_text]
    passage = first[of_text] + np.minimum(place // PASSAGE, n[of_text] - 1)
    inside = place < sizes[of_text]     # not the newline that ends the text
    p, b = passage[inside], w.buf[inside].astype(np.int64)
    length = np.maximum(1, np.bincount(p, minlength=total))[:, None]
    classes = np.bincount(p * CLASSES + _CLASS[b], minlength=total * CLASSES).reshape(total, CLASSES)
    if len(b) > 1:
        near = p[1:] == p[:-1]
        pair = ((b[:-1] * 0x9E37 + b[1:] * 0x85EB) >> 3) % PAIRS
        pairs = np.bincount(p[:-1][near] * PAIRS + pair[near], minlength=total * PAIRS).reshape(total, PAIRS)
    else:
        pairs = np.zeros((total, PAIRS))
    at = passage[w.first]
    words = np.bincount(at, minlength=total)
    order = np.lexsort((w.hash, at))
    fresh = np.ones(len(order), bool)
    if len(order) > 1:
        fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (at[order][1:] != at[order][:-1])
    distinct = np.bincount(at[order][fresh], minlength=total)
    letters = np.bincount(at, w.last - w.first, minlength=total)
    some = np.maximum(1, words)
    shares = [classes / length, np.sqrt(pairs / length), (words > 0)[:, None], (distinct / some)[:, None],
              np.minimum(letters / some / 16, 4)[:, None]]
    return np.concatenate(shares, axis=1).astype(np.float32), first


class Mil:
    """Parameters and score of the network; ``w1`` is None for a constant score."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, share: float = 0.5):
        self.mean, self.spread, self.share = mean, spread, share
        self.p: dict[str, np.ndarray] | None = None

    def forward(self, x: np.ndarray, first: np.ndarray, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        h = np.tanh(x @ p["w1"] + p["b1"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        a = (t * g) @ p["a"]
        n = np.diff(np.append(first, len(x)))
        e = np.exp(a - np.repeat(np.maximum.reduceat(a, first), n))
        e /= np.repeat(np.add.reduceat(e, first), n)
        z = np.add.reduceat(h * e[:, None], first, axis=0)
        return {"h": h, "t": t, "g": g, "e": e, "z": z, "n": n,
                "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.p is None:
            return np.full(len(texts), self.share)
        x, first = passage_features(texts)
        return self.forward((x - self.mean) / self.spread, first, self.p)["y"].astype(float)

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 120, seed: int = 7,
            good: float = 0.85) -> None:
        """Adam on the log loss with a small L2 penalty; documents of label 1 hold the share ``good`` of the weight."""
        rng = np.random.default_rng(seed)
        x = ((x - self.mean) / self.spread).astype(np.float32)
        f = x.shape[1]
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {"w1": init(f, CODE), "b1": np.zeros(CODE, np.float32), "v": init(CODE, GATE), "u": init(CODE, GATE),
             "a": init(GATE), "c": init(CODE), "b": np.zeros(1, np.float32)}
        weight = np.where(y == 1, good / max(1, (y == 1).sum()), (1 - good) / max(1, (y == 0).sum())).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, epochs + 1):
            o = self.forward(x, first, p)
            d = weight * (o["y"] - y)
            dz = np.repeat(d[:, None] * p["c"], o["n"], axis=0)
            de = (dz * o["h"]).sum(axis=1)
            da = o["e"] * (de - np.repeat(np.add.reduceat(o["e"] * de, first), o["n"]))
            dtg = da[:, None] * p["a"]
            dt, dg = dtg * o["g"] * (1 - o["t"] ** 2), dtg * o["t"] * o["g"] * (1 - o["g"])
            dh = (dz * o["e"][:, None] + dt @ p["v"].T + dg @ p["u"].T) * (1 - o["h"] ** 2)
            grad = {"w1": x.T @ dh, "b1": dh.sum(axis=0), "v": o["h"].T @ dt, "u": o["h"].T @ dg,
                    "a": (o["t"] * o["g"]).T @ da, "c": o["z"].T @ d, "b": np.array([d.sum()])}
            for k in p:
                g = grad[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                p[k] = (p[k] - 0.02 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
                        ).astype(np.float32)
        self.p = p


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_DOCS) -> Mil:
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, first = passage_features(b.column(1).to_pylist())
            parts = np.split(x.astype(np.float16), first[1:])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([v.tobytes() for v in parts], pa.binary()), b.column(2)], ["id", "x", "y"])

    picked = labelled(docs, labels, label, most).select(F.xxhash64("doc_id", "text").alias("id"), "text", "y")
    rows = sorted(picked.mapInArrow(run, "id bigint, x binary, y int").collect(), key=lambda r: (r["id"], r["x"]))
    y = np.array([r["y"] for r in rows], np.float32)
    if not rows or y.min() == y.max():
        return Mil(np.zeros(FEATURES), np.ones(FEATURES), float(y.mean()) if rows else 0.5)
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in rows]
    x = np.concatenate(bags)
    n = np.array([len(b) for b in bags])
    model = Mil(x.mean(axis=0), x.std(axis=0) + 0.01)
    model.fit(x, np.cumsum(n) - n, y)
    return model


def held_out(doc_id: Column) -> Column:
    """A quarter of all ids, never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, model: Mil, predict_from: float = PREDICT_FROM) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            y = [model.scores(part) for _, part in passes(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(y) if y else [], pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= predict_from).cast("int").alias("predicted")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels of documents that are not held out, and scores every document."""
    return score(docs, train(docs, labels.filter(~held_out(F.col("doc_id")))))
