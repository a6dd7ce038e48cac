"""A small causal self-attention model in numpy.

One attention layer over windows of subword ids: CONTEXT ids that were scored
before and SCORED new ones. Queries, keys, values and the residual are tables
by input id, distances have a learned bias, and the output is a class of the
next id; an id's share of its class, given the id before, comes from corpus
counts. So every id has a positive probability and all probabilities of a place
add up to 1.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WIDTH = 16
CONTEXT, SCORED = 8, 24
WINDOW = CONTEXT + SCORED
#: Input ids with a row of their own, classes with one id, and all classes.
INPUTS, OWN, CLASSES = 512, 40, 64
BEGIN = INPUTS
#: Commonest ids whose share of their class depends on the id before, and the weight of the plain share.
FOLLOWERS, TRUST = 2048, 3.0
_SHAPES = {
    "q": (INPUTS + 1, WIDTH), "k": (INPUTS + 1, WIDTH), "v": (INPUTS + 1, WIDTH), "r": (INPUTS + 1, WIDTH),
    "bias": (WINDOW,), "out": (WIDTH, CLASSES), "prior": (CLASSES,),
}
#: Place of the query (the id before the scored one) and of the keys; a key must not come after its query.
_QUERY, _KEY = np.arange(CONTEXT - 1, WINDOW - 1)[:, None], np.arange(WINDOW - 1)[None]
_AHEAD, _BACK = _KEY > _QUERY, np.maximum(_QUERY - _KEY, 0)


class Vocabulary(NamedTuple):
    inputs: np.ndarray  # id -> input row
    classes: np.ndarray  # id -> class
    share: np.ndarray  # id -> share of its class
    prior: np.ndarray  # log share of each class
    rank: np.ndarray  # id -> place by count, at most FOLLOWERS
    after: np.ndarray  # (input row before, rank) -> log share of the class after that row
    lacking: np.ndarray  # (input row before, class) -> log weight of the plain share

    def log_share(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log of the ids' shares of their classes, given the input rows before them."""
        rank = self.rank[ids]
        out = self.after[before, np.minimum(rank, FOLLOWERS - 1)]
        rest = np.flatnonzero(rank >= FOLLOWERS)
        out[rest] = self.lacking[before[rest], self.classes[ids[rest]]] + np.log(self.share[ids[rest]])
        return out


def vocabulary(counts: np.ndarray) -> Vocabulary:
    """Input rows, classes and shares from the corpus counts of all ids."""
    held = counts.astype(np.float64) + 0.01
    order = np.argsort(-held, kind="stable")
    rank = np.empty(len(held), dtype=np.int32)
    rank[order] = np.minimum(np.arange(len(held)), FOLLOWERS)
    inputs = np.minimum(rank, INPUTS - 1)
    classes = np.empty(len(held), dtype=np.int32)
    classes[order[:OWN]] = np.arange(min(OWN, len(order)))
    rest = order[OWN:]
    if len(rest):
        mass = np.cumsum(held[rest])
        classes[rest] = OWN + np.minimum((mass / mass[-1] * (CLASSES - OWN)).astype(np.int64), CLASSES - OWN - 1)
    total = np.bincount(classes, weights=held, minlength=CLASSES)
    prior = np.log(np.maximum(total, 1e-9) / total.sum())
    return followed(Vocabulary(inputs, classes, held / total[classes], prior, rank, *[np.zeros(0)] * 2), np.zeros(0, int), np.zeros(0))


def cell(vocabulary_: Vocabulary, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Number of each (input row before, id) among the counted ones, -1 for an id beyond FOLLOWERS."""
    rank = vocabulary_.rank[ids].astype(np.int64)
    return np.where(rank < FOLLOWERS, before.astype(np.int64) * FOLLOWERS + rank, -1)


def followed(vocabulary_: Vocabulary, cells: np.ndarray, counts: np.ndarray) -> Vocabulary:
    """Shares that know which ids follow which, from the corpus counts of ``cell`` numbers."""
    n = np.bincount(cells, weights=counts, minlength=(INPUTS + 1) * FOLLOWERS).reshape(INPUTS + 1, FOLLOWERS)
    top = np.flatnonzero(vocabulary_.rank < FOLLOWERS)
    top = top[np.argsort(vocabulary_.rank[top])]
    kinds = vocabulary_.classes[top]
    after = np.full(n.shape, -np.inf, dtype=np.float32)
    per_class = np.zeros((INPUTS + 1, CLASSES))
    for c in range(CLASSES):
        per_class[:, c] = n[:, : len(top)][:, kinds == c].sum(axis=1)
    after[:, : len(top)] = np.log((n[:, : len(top)] + TRUST * vocabulary_.share[top]) / (per_class[:, kinds] + TRUST))
    return vocabulary_._replace(after=after, lacking=np.log(TRUST / (per_class + TRUST)))


def start(vocabulary_: Vocabulary, seed: int = 0) -> np.ndarray:
    """Weights that know the classes' shares and nothing else."""
    draw = np.random.default_rng(seed)
    parts = {name: draw.normal(0, 0.1, shape) for name, shape in _SHAPES.items()}
    parts["bias"], parts["prior"] = -0.1 * np.arange(WINDOW), vocabulary_.prior
    return np.concatenate([parts[name].ravel() for name in _SHAPES])


def split(weights: np.ndarray, kind=np.float32) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        out[name] = weights[at : at + size].reshape(shape).astype(kind)
        at += size
    out["q"] = out["q"] * kind(WIDTH**-0.5)
    out["mask"] = np.where(_AHEAD, kind(-1e9), out["bias"][_BACK])
    return out


def windows(ids: np.ndarray, first: np.ndarray, inputs: np.ndarray, pick=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input rows and ids of each window, with the number of windows of each text.

    ``first[i]:first[i + 1]`` are the ids of text i. Each id is scored in one
    window; places after a text's end have id -1. ``pick`` chooses windows from
    their places in their texts and their texts' numbers.
    """
    sizes = np.diff(first)
    number = -(-sizes // SCORED)
    begins = np.concatenate([[0], np.cumsum(CONTEXT + SCORED * number)])
    flat, rows = np.full(begins[-1], -1, dtype=np.int32), np.full(begins[-1], BEGIN, dtype=np.int32)
    to = np.repeat(begins[:-1] + CONTEXT - first[:-1], sizes) + np.arange(len(ids))
    flat[to], rows[to] = ids, inputs[ids]
    text = np.repeat(np.arange(len(number)), number)
    place = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    if pick is not None:
        chosen = pick(place, text)
        text, place = text[chosen], place[chosen]
    at = (begins[text] + SCORED * place)[:, None] + np.arange(WINDOW)
    return rows[at], flat[at], number


def _forward(p: dict, rows: np.ndarray):
    """Weights of attention and hidden values; scores stay small, so no maximum has to be taken off."""
    asked, seen = rows[:, CONTEXT - 1 : -1], rows[:, :-1]
    q, k, v = p["q"][asked], p["k"][seen], p["v"][seen]
    a = np.matmul(q, k.transpose(0, 2, 1))
    a += p["mask"]
    np.exp(a, out=a)
    total = a.sum(axis=2, keepdims=True)
    hidden = np.matmul(a, v)
    hidden /= total
    hidden += p["r"][asked]
    np.tanh(hidden, out=hidden)
    return q, k, v, a, total, hidden


def _logits(p: dict, hidden: np.ndarray) -> np.ndarray:
    out = hidden.reshape(-1, WIDTH) @ p["out"]
    out += p["prior"]
    return out


def log_probability(p: dict, vocabulary_: Vocabulary, rows: np.ndarray, ids: np.ndarray, step: int = 256) -> np.ndarray:
    """Summed natural log probability of the scored ids of each window."""
    out = np.zeros(len(rows))
    for at in range(0, len(rows), step):
        block = rows[at : at + step]
        logits = _logits(p, _forward(p, block)[-1])
        part = ids[at : at + step, CONTEXT:].ravel()
        known = part >= 0
        held = np.where(known, part, 0)
        got = logits[np.arange(len(held)), vocabulary_.classes[held]]
        np.exp(logits, out=logits)
        got = got - np.log(logits.sum(axis=1)) + vocabulary_.log_share(block[:, CONTEXT - 1 : -1].ravel(), held)
        out[at : at + step] = np.where(known, got, 0.0).reshape(len(block), SCORED).sum(axis=1)
    return out


def gradient(weights: np.ndarray, vocabulary_: Vocabulary, rows: np.ndarray, ids: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross-entropy of the classes and its gradient."""
    p = split(weights)
    q, k, v, a, total, hidden = _forward(p, rows)
    a /= total
    flat = hidden.reshape(-1, WIDTH)
    logits = _logits(p, hidden)
    part = ids[:, CONTEXT:].ravel()
    known = part >= 0
    number = max(1, int(known.sum()))
    target = (np.arange(len(part)), vocabulary_.classes[np.where(known, part, 0)])
    d = np.exp(logits)
    norm = d.sum(axis=1)
    loss = -float(((logits[target] - np.log(norm)) * known).sum()) / number
    d /= norm[:, None]
    d[target] -= 1
    d *= (known / number)[:, None].astype(np.float32)
    dz = ((d @ p["out"].T) * (1 - flat * flat)).reshape(hidden.shape)
    da = np.matmul(dz, v.transpose(0, 2, 1))
    dv = np.matmul(a.transpose(0, 2, 1), dz)
    ds = a * (da - (da * a).sum(axis=2, keepdims=True))
    dq = np.matmul(ds, k) * np.float32(WIDTH**-0.5)
    dk = np.matmul(ds.transpose(0, 2, 1), q)
    asked, seen = rows[:, CONTEXT - 1 : -1].ravel(), rows[:, :-1].ravel()

    def table(where: np.ndarray, what: np.ndarray) -> np.ndarray:
        places = where[:, None] * WIDTH + np.arange(WIDTH)
        return np.bincount(places.ravel(), weights=what.ravel(), minlength=(INPUTS + 1) * WIDTH)

    bias = np.bincount(np.broadcast_to(_BACK, ds.shape[1:]).ravel(), weights=np.where(_AHEAD, 0, ds.sum(axis=0)).ravel(), minlength=WINDOW)
    grads = {
        "q": table(asked, dq), "k": table(seen, dk), "v": table(seen, dv), "r": table(asked, dz),
        "bias": bias, "out": flat.T @ d, "prior": d.sum(axis=0),
    }
    return loss, np.concatenate([np.asarray(grads[name], dtype=np.float64).ravel() for name in _SHAPES])


def train(weights: np.ndarray, vocabulary_: Vocabulary, rows: np.ndarray, ids: np.ndarray, rate: float = 0.01,
          batch: int = 64, seed: int = 0) -> np.ndarray:
    """One pass of Adam over the windows in seeded order."""
    weights, m, s = weights.copy(), np.zeros(len(weights)), np.zeros(len(weights))
    order = np.random.default_rng(seed).permutation(len(rows))
    steps = -(-len(order) // batch)
    for t in range(steps):
        part = order[t * batch : (t + 1) * batch]
        g = gradient(weights, vocabulary_, rows[part], ids[part])[1]
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        pace = rate * (1 - t / steps * 0.9)
        weights -= pace * (m / (1 - 0.9 ** (t + 1))) / (np.sqrt(s / (1 - 0.99 ** (t + 1))) + 1e-8)
    return weights
