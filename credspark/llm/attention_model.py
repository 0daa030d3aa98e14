"""A small causal self-attention language model over subword ids, in numpy.

One layer: every input id has a query, a key, a value and a residual vector.
A target sees the inputs of its window up to the one before it, weighted by
softmax(query . key + a bias per distance); a hidden
layer follows, and a softmax in two steps (the id's class, then the id in its
class), so that the probabilities of all ids sum to one.
"""

from __future__ import annotations

import math

import numpy as np

#: Targets of a window, and inputs that a window shows before its first target's own.
STEP, BACK = 16, 16
SPAN = STEP + BACK
#: Ids in a class of the two-step softmax; size of the vectors, hidden units.
CLASS, WIDTH, HIDDEN = 64, 32, 32
#: Windows that one gradient step, and one scoring step, take; parameters that a step moves at a time.
BATCH, SCORED, PART = 128, 128, 1 << 15

Params = dict[str, np.ndarray]


def initial(counts: np.ndarray, seed: int = 11) -> Params:
    """Parameters before training: biases from the ids' ``counts``, the rest small seeded numbers.

    The ids are 0 .. len(counts) - 1; two more inputs stand for the text's begin and for nothing."""
    rng = np.random.default_rng(seed)
    n, classes = len(counts), -(-len(counts) // CLASS)
    table = np.full(classes * CLASS, -np.inf)
    table[:n] = np.log(counts + 1.0)
    table = table.reshape(classes, CLASS)
    top = np.logaddexp.reduce(table, axis=1)
    low = np.where(np.isfinite(table), table - top[:, None], -1e9)
    small = lambda *shape: rng.normal(0.0, 0.1, shape)
    p = {"asking": small(n + 2, 2 * WIDTH), "seen": small(n + 2, 2 * WIDTH), "distance": -0.3 * np.arange(SPAN),
         "hidden_in": rng.normal(0.0, 0.2, (WIDTH, HIDDEN)), "hidden_bias": np.zeros(HIDDEN),
         "hidden_out": small(HIDDEN, WIDTH), "class_out": small(classes, WIDTH),
         "class_bias": top - np.logaddexp.reduce(top), "class_in": small(classes, WIDTH),
         "id_out": small(CLASS, WIDTH), "id_bias": low}
    return {k: v.astype(np.float32) for k, v in p.items()}


def pack(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def views(flat: np.ndarray, like: Params) -> Params:
    """The parameters as parts of one array."""
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def windows(ids: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts of ``sizes`` ids that lie one after the other in ``ids``.

    inputs (w, SPAN): the id before each target and those before it, n where the
    text begins and n + 1 where there is nothing; targets (w, STEP): -1 past the
    text's end.  Each id is the target of one window; text: its text's index."""
    count = -(-sizes // STEP)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    # each text's targets fill its windows; its inputs lie one place later, behind BACK places and its begin
    room, where = count * STEP, np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    targets = np.full(int(room.sum()), -1, np.int64)
    targets[where + np.repeat(np.cumsum(room) - room, sizes)] = ids
    room += BACK * (sizes > 0)
    start = np.cumsum(room) - room
    shown = np.full(int(room.sum()) + SPAN, n + 1, np.int64)
    shown[where + np.repeat(start + BACK + 1, sizes)] = ids
    shown[start] = n + 1        # where the text before fills its last window, its last id is no input
    shown[start[sizes > 0] + BACK] = n
    inputs = np.lib.stride_tricks.sliding_window_view(shown, SPAN)[start[text] + nth * STEP]
    return inputs, targets.reshape(-1, STEP), text


_AHEAD = np.arange(BACK, SPAN)[:, None] - np.arange(SPAN)
_CAUSAL = _AHEAD >= 0


class Room:
    """Arrays used again from batch to batch: large new ones cost more than the work on them."""

    def __init__(self):
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, dtype: type | None = None) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, dtype or self.dtype)
        return self.kept[name][:size].reshape(shape)

    def take(self, name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.take(table, at, axis=0, out=self(name, *at.shape, table.shape[1]), mode="clip")

    def product(self, name: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.matmul(x, y, out=self(name, *x.shape[:-1], y.shape[-1]))

    def of(self, p: Params) -> Room:
        self.dtype = p["seen"].dtype
        return self


def _exp(x: np.ndarray) -> np.ndarray:
    """exp in place, of numbers lowered first where some would overflow (a softmax stays as it is)."""
    if x.size and x.max() > 60:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def _sum(x: np.ndarray) -> np.ndarray:
    return x @ np.ones((x.shape[-1], 1), x.dtype)


def _tables(p: Params) -> Params:
    """What every block of windows reads alike: the logits' vectors and biases, the distances' part of the weights."""
    # the class's part of an id's logits depends on the class alone: one row of biases for each class
    bias = np.concatenate((np.tile(p["class_bias"], (len(p["class_out"]), 1)),
                           p["class_in"] @ p["id_out"].T + p["id_bias"]), axis=1)
    ahead = np.where(_CAUSAL, p["distance"][np.maximum(_AHEAD, 0)], p["distance"].dtype.type(-1e4))
    return {"bias": bias, "out": np.concatenate((p["class_out"], p["id_out"])), "ahead": ahead}


def _forward(p: Params, tables: Params, inputs: np.ndarray, targets: np.ndarray, room: Room):
    """Log probability of every target (0 where there is none) and what the gradient needs."""
    nothing = len(p["asking"]) - 1
    now = inputs[:, BACK:]
    asking, seen = room.take("asking", p["asking"], now), room.take("seen", p["seen"], inputs)
    q, k, v = asking[..., :WIDTH], seen[..., :WIDTH], seen[..., WIDTH:]
    weight = room.product("weight", q, k.transpose(0, 2, 1))
    weight += tables["ahead"]
    blank = np.flatnonzero(inputs[:, 0] == nothing)     # windows at a text's begin
    weight[blank] += np.where(inputs[blank] == nothing, weight.dtype.type(-1e4), weight.dtype.type(0))[:, None]
    _exp(weight)
    mass = _sum(weight)
    mean = room.product("mean", weight, v)
    mean /= mass
    flat = np.add(mean, asking[..., WIDTH:], out=room("flat", *mean.shape)).reshape(-1, WIDTH)
    inner = room.product("inner", flat, p["hidden_in"])
    inner += p["hidden_bias"]
    np.maximum(inner, 0, out=inner)
    out = room.product("out", inner, p["hidden_out"])
    out += flat
    ids = targets.ravel()
    live = ids >= 0
    ids = np.maximum(ids, 0)
    kind, row, classes = ids // CLASS, np.arange(len(ids)), len(p["class_out"])
    logits = room.product("logits", out, tables["out"].T)
    logits += room.take("bias", tables["bias"], kind)
    _exp(logits)
    top, low, member = logits[:, :classes], logits[:, classes:], ids % CLASS
    tops, lows = _sum(top)[:, 0], _sum(low)[:, 0]
    chance = np.maximum(top[row, kind], 1e-30) / tops * (np.maximum(low[row, member], 1e-30) / lows)
    logp = np.where(live, np.log(np.maximum(chance, 1e-35)), 0)
    return logp, (now, q, k, v, weight, mass, mean, live, flat, inner, out, kind, member, row, logits, tops, lows)


def _spread(rows: np.ndarray, ids: np.ndarray, out: np.ndarray, room: Room) -> None:
    """Sums of ``rows`` by id, in ``out``: two columns are added at a time, as one complex number."""
    pair = np.result_type(rows.dtype, np.complex64)
    half = rows.shape[-1] // 2
    at = np.add(ids.ravel()[:, None] * half, np.arange(half), out=room("at", ids.size, half, dtype=np.int64))
    out[...] = 0
    np.add.at(out.view(pair).reshape(-1), at.reshape(-1), rows.view(pair).reshape(-1))


def gradient(p: Params, inputs: np.ndarray, targets: np.ndarray, room: Room | None = None,
             into: Params | None = None) -> tuple[float, Params]:
    """Mean log loss of the targets and its gradient, in the arrays ``into`` if they are given."""
    room, tables = (room or Room()).of(p), _tables(p)
    logp, (now, q, k, v, weight, mass, mean, live, flat, inner, out, kind, member, row, logits, tops, lows) = \
        _forward(p, tables, inputs, targets, room)
    m, g = max(int(live.sum()), 1), into or {name: np.empty_like(x) for name, x in p.items()}
    classes, size = len(p["class_out"]), len(row)
    top, low = logits[:, :classes], logits[:, classes:]
    share = live.astype(low.dtype) / m
    low *= (share / lows)[:, None]
    top *= (share / tops)[:, None]
    low[row, member] -= share
    top[row, kind] -= share
    # sums over the targets of a class: what depends on the class alone needs no row for each target
    of_class = room("of_class", size, classes)
    of_class[...] = 0
    of_class[row, kind] = 1
    by_class = low.T @ of_class
    g["id_bias"][...] = by_class.T
    np.matmul(by_class.T, p["id_out"], out=g["class_in"])
    both = logits.T @ out
    g["class_out"][...] = both[:classes]
    np.add(both[classes:], by_class @ p["class_in"], out=g["id_out"])
    np.matmul(np.ones(size, low.dtype), top, out=g["class_bias"])
    d_out = room.product("d_out", logits, tables["out"])
    np.matmul(inner.T, d_out, out=g["hidden_out"])
    d_inner = room.product("d_inner", d_out, p["hidden_out"].T)
    d_inner *= inner > 0
    np.matmul(flat.T, d_inner, out=g["hidden_in"])
    np.matmul(np.ones(size, low.dtype), d_inner, out=g["hidden_bias"])
    asked, shown = room("asked", *now.shape, 2 * WIDTH), room("shown", *inputs.shape, 2 * WIDTH)
    d_flat = room.product("d_flat", d_inner, p["hidden_in"].T)
    d_flat += d_out
    d_flat = d_flat.reshape(mean.shape)
    asked[..., WIDTH:] = d_flat
    d_mean = np.divide(d_flat, mass, out=d_flat)
    np.matmul(weight.transpose(0, 2, 1), d_mean, out=shown[..., WIDTH:])
    d_score = room.product("d_score", d_mean, v.transpose(0, 2, 1))
    d_score -= _sum(np.multiply(d_mean, mean, out=mean))
    d_score *= weight
    g["distance"][...] = np.bincount(_AHEAD[_CAUSAL], d_score.sum(axis=0)[_CAUSAL], SPAN)
    np.matmul(d_score, k, out=asked[..., :WIDTH])
    np.matmul(d_score.transpose(0, 2, 1), q, out=shown[..., :WIDTH])
    _spread(asked, now, g["asking"], room)
    _spread(shown, inputs, g["seen"], room)
    return float(-logp.sum() / m), g


class Trainer:
    """Adam over batches of windows; all parameters lie in one array."""

    def __init__(self, p: Params, rate: float):
        self.flat, self.rate, self.steps, self.targets, self.room = pack(p), rate, 0, 0, Room()
        self.p, self.grad = views(self.flat, p), np.zeros_like(self.flat)
        self.grads = views(self.grad, p)
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.move = np.empty(min(PART, self.flat.size), self.flat.dtype)

    def fit(self, inputs: np.ndarray, targets: np.ndarray) -> float:
        loss, _ = gradient(self.p, inputs, targets, self.room, self.grads)
        self.steps += 1
        self.targets += int((targets >= 0).sum())
        a, b = 1 - 0.9 ** self.steps, 1 - 0.99 ** self.steps
        # the moments are kept as sums: 0.1 times ``mean`` and 0.01 times ``square`` are Adam's
        by = (0.01 / b) ** 0.5
        for lo in range(0, self.flat.size, PART):
            grad, mean, square = (x[lo:lo + PART] for x in (self.grad, self.mean, self.square))
            move = self.move[:len(grad)]
            mean *= 0.9
            mean += grad
            square *= 0.99
            square += np.multiply(grad, grad, out=move)
            np.sqrt(square, out=move)
            move += 1e-6 / by
            np.divide(mean, move, out=move)
            move *= self.rate * 0.1 / (a * by)
            self.flat[lo:lo + PART] -= move
        return loss


def log_probability(p: Params, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of every text; each id is scored in one window."""
    n = len(p["asking"]) - 2
    total = np.zeros(len(sizes))
    inputs, targets, text = windows(ids, sizes, n)
    room, tables = Room().of(p), _tables(p)
    for lo in range(0, len(text), SCORED):
        part = targets[lo:lo + SCORED]
        logp, _ = _forward(p, tables, inputs[lo:lo + SCORED], part, room)
        per_window = logp.reshape(part.shape).sum(axis=1, dtype=np.float64)
        np.add.at(total, text[lo:lo + SCORED], per_window)
    return total
