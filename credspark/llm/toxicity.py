"""Toxicity by classifier chains.

The categories are predicted one after the other by linear (logistic) models
over words and word beginnings; each model also sees the probabilities of the
categories before it.  In training these come from models that have not seen
the document (out-of-fold, FOLDS folds), in scoring from the models of all rows.

Only the label ``toxic`` is given.  The earlier categories are found in the labelled
sample: its toxic documents are clustered (spherical k-means) by the features that
tell toxic documents from others, and each of the KINDS clusters, which share
words and so languages or kinds of abuse, is a category, the largest first.  The last
link of the chain is the label itself, and its probability decides.

Training takes TRAIN_DOCS labelled documents at most (a bounded sample, picked
by hash) to the driver as sets of word hashes; a model keeps the TOP
features with the strongest evidence.  Scoring reads whole texts.

Defined results: null and empty texts have no words and the models' base
probabilities; repeated rows get equal results; where the labels hold only one
kind, every probability is its share (0 without labels); an empty table gives an
empty result; other columns are kept by ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import PUNCTUATION, Words, labelled, passes, small_batches

#: Categories that are found before the label, and features that they are found by.
KINDS, TELLING = 3, 200
FINAL = "toxic"
TRAIN_DOCS = 4000
TOP, FOLDS = 300, 3
L2 = 0.3
BEGINNING = 4           # bytes
TOXIC_FROM = 0.4
_MARK = np.uint64(0x5851F42D4C957F2D)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) pairs: hashes of the words of each text, and of their first bytes; distinct, sorted by text."""
    w = Words([(t or "").lower() for t in texts], PUNCTUATION)
    sums = w.prefix_sums()
    whole = w.hash_spans(w.first, w.last, sums)
    long = w.last - w.first > BEGINNING
    start = w.hash_spans(w.first[long], w.first[long] + BEGINNING, sums) ^ _MARK
    doc, f = np.concatenate((w.doc, w.doc[long])), np.concatenate((whole, start))
    order = np.lexsort((f, doc))
    doc, f = doc[order], f[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (f[1:] != f[:-1])
    return doc[fresh], f[fresh]


class Linear:
    """A logistic model over the presence of chosen features and the probabilities before it."""

    def __init__(self, share: float, chosen: np.ndarray, weights: np.ndarray):
        self.share, self.chosen, self.weights = share, chosen, weights

    def matrix(self, doc: np.ndarray, f: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.chosen, f)
        at[at == len(self.chosen)] = 0
        hit = self.chosen[at] == f if len(self.chosen) else np.zeros(len(f), bool)
        x = np.zeros((n, len(self.chosen) + before.shape[1] + 1), np.float32)
        x[doc[hit], at[hit]] = 1
        x[:, len(self.chosen):-1] = before
        x[:, -1] = 1
        return x

    def predict(self, doc: np.ndarray, f: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(n, self.share)
        return 1 / (1 + np.exp(-np.clip(self.matrix(doc, f, n, before) @ self.weights, -30, 30)))


def evidence(doc: np.ndarray, f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, the difference of their shares among positives and others in standard errors (0 for rare ones), and
    each entry's feature."""
    pos, n = int(y.sum()), len(y)
    ids, at, count = np.unique(f, return_inverse=True, return_counts=True)
    hits = np.bincount(at, y[doc], len(ids))
    p, q, all_ = hits / pos, (count - hits) / (n - pos), count / n
    z = (p - q) / np.sqrt(all_ * (1 - all_ + 1 / n) * (1 / pos + 1 / (n - pos)))
    z[count < 3] = 0
    return ids, z, at


def kinds_of(doc: np.ndarray, f: np.ndarray, toxic: np.ndarray, kinds: int = KINDS) -> np.ndarray:
    """The cluster of every toxic document, 0 the largest; -1 for others and for those without a telling feature."""
    out = np.full(len(toxic), -1)
    if toxic.sum() in (0, len(toxic)):
        return out
    ids, z, at = evidence(doc, f, toxic)
    told = np.lexsort((ids, -z))[:TELLING]
    told = told[z[told] > 0]
    column = np.full(len(ids), -1)
    column[told] = np.arange(len(told))
    hit = (column[at] >= 0) & (toxic[doc] > 0)
    x = np.zeros((len(toxic), len(told)))
    x[doc[hit], column[at[hit]]] = 1
    size = np.linalg.norm(x, axis=1)
    mine = np.flatnonzero(size > 0)
    if not len(mine):
        return out
    x = x[mine] / size[mine, None]
    centres = x[[int(np.argmax(size[mine]))]]
    while len(centres) < min(kinds, len(mine)):     # the document least like all centres so far
        centres = np.vstack((centres, x[int(np.argmin((x @ centres.T).max(axis=1)))]))
    for _ in range(30):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == k].sum(axis=0) for k in range(len(centres))])
        fresh = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(fresh, centres):
            break
        centres = fresh
    rank = np.argsort(np.argsort(-np.bincount(own, minlength=len(centres)), kind="stable"))
    out[mine] = rank[own]
    return out


def fit_linear(doc: np.ndarray, f: np.ndarray, y: np.ndarray, before: np.ndarray) -> Linear:
    """Newton steps with an L2 penalty over the TOP features whose share among positives differs most.

    The difference is measured in standard errors, as in a test of two shares.
    """
    pos, n = int(y.sum()), len(y)
    if pos in (0, n):
        return Linear(pos / n if n else 0.0, np.empty(0, np.uint64), np.empty(0))
    ids, z, _ = evidence(doc, f, y)
    best = np.lexsort((ids, -np.abs(z)))[:TOP]
    model = Linear(pos / n, np.sort(ids[best]), np.empty(0))
    x = model.matrix(doc, f, n, before).astype(np.float64)
    penalty = np.full(x.shape[1], L2)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    w[-1] = np.log(pos / (n - pos))
    for _ in range(12):
        mu = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = np.maximum(mu * (1 - mu), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x + np.diag(penalty), x.T @ (y - mu) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


class Chain:
    def __init__(self, names: list[str], models: list[Linear]):
        self.names, self.models = names, models

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """(texts, categories) probabilities."""
        doc, f = features(texts)
        before = np.zeros((len(texts), 0))
        for m in self.models:
            before = np.column_stack((before, m.predict(doc, f, len(texts), before)))
        return before


def fit_chain(doc: np.ndarray, f: np.ndarray, toxic: np.ndarray, fold: np.ndarray) -> Chain:
    n = len(toxic)
    before, models, names = np.zeros((n, 0)), [], []
    kind = kinds_of(doc, f, toxic)
    for number, name in enumerate([*(f"kind_{k + 1}" for k in range(KINDS)), FINAL]):
        y = toxic.astype(float) if name == FINAL else (kind == number).astype(float)
        models.append(fit_linear(doc, f, y, before))
        names.append(name)
        unseen = np.zeros(n)
        for k in range(FOLDS):
            inside, out = fold != k, fold == k
            place = np.cumsum(inside) - 1
            mine = inside[doc]
            m = fit_linear(place[doc[mine]], f[mine], y[inside], before[inside])
            place = np.cumsum(out) - 1
            mine = out[doc]
            unseen[out] = m.predict(place[doc[mine]], f[mine], int(out.sum()), before[out])
        before = np.column_stack((before, unseen))
    return Chain(names, models)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Chain:
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, f = features(b.column(1).to_pylist())
            borders = np.searchsorted(doc, np.arange(b.num_rows + 1))
            sets = [f[i:j].tobytes() for i, j in zip(borders, borders[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), b.column(2)], ["id", "f", "y"])

    picked = labelled(docs, labels, "toxic", most).select(F.xxhash64("doc_id", "text").alias("id"), "text", "y")
    rows = sorted(picked.mapInArrow(run, "id bigint, f binary, y int").collect(), key=lambda r: (r["id"], r["f"]))
    sets = [np.frombuffer(r["f"], np.uint64) for r in rows]
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.int64)
    f = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    toxic = np.array([r["y"] for r in rows], float)
    # copies of a text fall into one fold
    fold = np.array([int(s[0] % FOLDS) if len(s) else 0 for s in sets], np.int64)
    return fit_chain(doc, f, toxic, fold)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> of each link of the chain, and toxic (boolean)."""
    small_batches(docs.sparkSession)
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [chain.predict(part) for _, part in passes(b.column(1).to_pylist())]
            p = np.concatenate(p) if p else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(np.ascontiguousarray(c), pa.float64()) for c in p.T]], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))
            .withColumn("toxic", F.col(f"p_{FINAL}") >= TOXIC_FROM))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text the chain takes for toxic, in one pass and without a shuffle."""
    chain = train(docs, labels)
    final = chain.names.index(FINAL)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [chain.predict(part)[:, final] for _, part in passes(b.column(at).to_pylist())]
            if p:
                yield b.filter(pa.array(np.concatenate(p) < TOXIC_FROM))

    return docs.mapInArrow(run, docs.schema)
