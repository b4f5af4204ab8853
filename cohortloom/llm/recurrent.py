"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Documents run in lanes, one after the other; the state is carried from window to window of a lane
and cleared where a document begins. Gradients stop at the window's start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WIDTH = 16
CLASSES = 16
UNITS = CLASSES * CLASSES
WINDOW = 32
LANES = 256
#: A pass over few documents takes fewer lanes, so that it still makes about so many steps.
LEAST_STEPS = 250
LEAST_LANES = 16
#: The unit that ends a document, and stands before its first word.
END = 0

_SHAPES = {
    "embed": (UNITS, WIDTH),
    "into": (WIDTH, 3 * WIDTH),
    "bias": (3 * WIDTH,),
    "back": (WIDTH, 3 * WIDTH),
    "class_out": (WIDTH, CLASSES),
    "class_bias": (CLASSES,),
    "unit_out": (CLASSES, WIDTH, CLASSES),
    "unit_bias": (CLASSES, CLASSES),
}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())
Weights = dict[str, np.ndarray]


def unpack(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        out[name] = np.asarray(flat[at : at + size], np.float32).reshape(shape)
        at += size
    return out


def initial(counts: np.ndarray, seed: int = 7) -> np.ndarray:
    """Small random weights; the biases give the units' own frequencies. Units never seen are all but impossible."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(SIZE, np.float32)
    w = unpack(flat)
    for name in ("embed", "into", "back", "class_out", "unit_out"):
        w[name][...] = rng.normal(0, 0.1 if name == "embed" else 0.15, w[name].shape)
    grid = np.maximum(counts.astype(float), 1e-6).reshape(CLASSES, CLASSES)
    w["class_bias"][...] = np.log(grid.sum(1) / grid.sum())
    w["unit_bias"][...] = np.log(grid / grid.sum(1, keepdims=True))
    w["embed"][counts == 0] = 0
    return flat


#: Weights stay within this, so that no exponential overflows.
MOST_WEIGHT = 3.0
_ONES = np.ones(CLASSES, np.float32)


def _choice(logits: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the wanted columns, and all probabilities (in place of the logits)."""
    at = np.arange(len(wanted)) * CLASSES + wanted
    picked = logits.ravel()[at]
    np.exp(logits, out=logits)
    total = logits @ _ONES
    return picked - np.log(total), np.divide(logits, total[:, None], out=logits)


def _chosen(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log-probabilities of the wanted columns alone."""
    picked = logits.ravel()[np.arange(len(wanted)) * CLASSES + wanted]
    np.exp(logits, out=logits)
    return picked - np.log(logits @ _ONES)


@dataclass
class Window:
    given: np.ndarray  # (steps, lanes) units read
    wanted: np.ndarray  # units to predict
    first: np.ndarray  # whether a document begins
    document: np.ndarray  # whose prediction it is, -1 beyond a lane's end


def lanes(documents: list[np.ndarray], most: int = LANES) -> Iterator[Window]:
    """Windows over documents (arrays of units without the end), longest first on the emptiest lane."""
    lengths = np.array([len(d) + 1 for d in documents], np.int64)
    if not len(lengths):
        return
    count = int(min(most, max(1, lengths.sum() // lengths.max() * 2), len(lengths)))
    heap = [(0, i) for i in range(count)]
    owned: list[list[int]] = [[] for _ in range(count)]
    for d in np.argsort(-lengths, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        owned[lane].append(d)
        heapq.heappush(heap, (load + int(lengths[d]), lane))
    loads = np.array([lengths[own].sum() for own in owned])
    order = np.argsort(-loads, kind="stable")
    steps = int(loads.max())
    given = np.full((count, steps), END, np.int16)
    wanted = np.full((count, steps), END, np.int16)
    first = np.zeros((count, steps), bool)
    document = np.full((count, steps), -1, np.int32)
    for row, lane in enumerate(order.tolist()):
        at = 0
        for d in owned[lane]:
            n = int(lengths[d])
            given[row, at + 1 : at + n] = documents[d]
            wanted[row, at : at + n - 1] = documents[d]
            first[row, at] = True
            document[row, at : at + n] = d
            at += n
    loads = loads[order]
    for start in range(0, steps, WINDOW):
        live = int(np.searchsorted(-loads, -start, "left"))
        own = (slice(0, live), slice(start, start + WINDOW))
        yield Window(given[own].T, wanted[own].T, first[own].T, document[own].T)


def _forward(w: Weights, window: Window, state: np.ndarray) -> dict[str, np.ndarray]:
    steps, live = window.given.shape
    table = w["embed"] @ w["into"] + w["bias"]
    entry = table[window.given]
    keep = (~window.first).astype(np.float32)[:, :, None]
    hidden = np.empty((steps + 1, live, WIDTH), np.float32)
    before = np.empty((steps, live, WIDTH), np.float32)
    gates = np.empty((steps, live, 2 * WIDTH), np.float32)
    fresh = np.empty((steps, live, WIDTH), np.float32)
    recall = np.empty((steps, live, WIDTH), np.float32)
    hidden[0] = state[:live]
    for t in range(steps):
        h = np.multiply(hidden[t], keep[t], out=before[t])
        back = h @ w["back"]
        gate = gates[t]
        np.add(entry[t, :, : 2 * WIDTH], back[:, : 2 * WIDTH], out=gate)
        np.multiply(gate, 0.5, out=gate)
        np.tanh(gate, out=gate)
        gate *= 0.5
        gate += 0.5
        recall[t] = back[:, 2 * WIDTH :]
        n = fresh[t]
        np.multiply(gate[:, WIDTH:], recall[t], out=n)
        n += entry[t, :, 2 * WIDTH :]
        np.tanh(n, out=n)
        z = gate[:, :WIDTH]
        np.subtract(h, n, out=hidden[t + 1])
        hidden[t + 1] *= z
        hidden[t + 1] += n
    return {"hidden": hidden, "before": before, "gates": gates, "fresh": fresh, "recall": recall, "keep": keep}


def _by_class(wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    group = (wanted // CLASSES).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=CLASSES))])
    for c in range(CLASSES):
        if edge[c + 1] > edge[c]:
            yield c, order[edge[c] : edge[c + 1]]


def log_probabilities(w: Weights, window: Window, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural logarithms for the window's predictions, and the state after it."""
    hidden = _forward(w, window, state)["hidden"]
    h = hidden[1:].reshape(-1, WIDTH)
    wanted = window.wanted.reshape(-1)
    out = _chosen(h @ w["class_out"] + w["class_bias"], wanted // CLASSES)
    for c, rows in _by_class(wanted):
        out[rows] += _chosen(h[rows] @ w["unit_out"][c] + w["unit_bias"][c], wanted[rows] % CLASSES)
    return out.reshape(window.wanted.shape), hidden[-1]


def score(w: Weights, documents: list[np.ndarray]) -> np.ndarray:
    """The natural log-likelihood of each whole document, its end included."""
    total = np.zeros(len(documents))
    state = np.zeros((LANES, WIDTH), np.float32)
    for window in lanes(documents):
        found, state = log_probabilities(w, window, state)
        real = window.document >= 0
        total += np.bincount(window.document[real], weights=found[real], minlength=len(documents))
    return total


def _sums(x: np.ndarray) -> np.ndarray:
    """Column sums."""
    return np.ones(len(x), np.float32) @ x


def gradient(w: Weights, window: Window, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Flat gradient of the mean loss over the window's predictions, the state after it, and the loss."""
    kept = _forward(w, window, state)
    hidden, before, gates, fresh, recall, keep = (kept[k] for k in ("hidden", "before", "gates", "fresh", "recall", "keep"))
    steps, live = window.given.shape
    real = (window.document >= 0).reshape(-1)
    scale = np.float32(1 / max(1, int(real.sum())))
    flat = np.zeros(SIZE, np.float32)
    g = unpack(flat)

    h = hidden[1:].reshape(-1, WIDTH)
    wanted = window.wanted.reshape(-1)
    weight = np.where(real, scale, 0).astype(np.float32)
    found, d = _choice(h @ w["class_out"] + w["class_bias"], wanted // CLASSES)
    loss = -float(found[real].sum())
    d.ravel()[np.arange(len(h)) * CLASSES + wanted // CLASSES] -= 1
    d *= weight[:, None]
    g["class_out"][...] = h.T @ d
    g["class_bias"][...] = _sums(d)
    dh = d @ w["class_out"].T
    for c, own in _by_class(wanted):
        mine, unit = h[own], wanted[own] % CLASSES
        found, d = _choice(mine @ w["unit_out"][c] + w["unit_bias"][c], unit)
        loss -= float(found[real[own]].sum())
        d.ravel()[np.arange(len(own)) * CLASSES + unit] -= 1
        d *= weight[own, None]
        g["unit_out"][c] = mine.T @ d
        g["unit_bias"][c] = _sums(d)
        dh[own] += d @ w["unit_out"][c].T

    dh = dh.reshape(steps, live, WIDTH)
    # What does not depend on later steps is worked out for the whole window at once.
    z, r = np.ascontiguousarray(gates[:, :, :WIDTH]), np.ascontiguousarray(gates[:, :, WIDTH:])
    to_z = (before - fresh) * z * (1 - z)
    to_fresh = (1 - z) * (1 - fresh * fresh)
    to_r = recall * r * (1 - r)
    dentry = np.empty((steps, live, 3 * WIDTH), np.float32)
    dback = np.empty((steps, live, 3 * WIDTH), np.float32)
    back_t = np.ascontiguousarray(w["back"].T)
    after = np.zeros((live, WIDTH), np.float32)
    for t in range(steps - 1, -1, -1):
        after += dh[t]
        own, back = dentry[t], dback[t]
        dn = after * to_fresh[t]
        np.multiply(after, to_z[t], out=back[:, :WIDTH])
        np.multiply(dn, to_r[t], out=back[:, WIDTH : 2 * WIDTH])
        np.multiply(dn, r[t], out=back[:, 2 * WIDTH :])
        own[:, 2 * WIDTH :] = dn
        after *= z[t]
        after += back @ back_t
        after *= keep[t]
    dentry[:, :, : 2 * WIDTH] = dback[:, :, : 2 * WIDTH]
    g["back"][...] = before.reshape(-1, WIDTH).T @ dback.reshape(-1, 3 * WIDTH)
    dentry = dentry.reshape(-1, 3 * WIDTH)
    given = window.given.reshape(-1)
    order = np.argsort(given, kind="stable")
    turn = np.flatnonzero(np.diff(given[order], prepend=-1))
    dtable = np.zeros((UNITS, 3 * WIDTH), np.float32)
    dtable[given[order[turn]]] = np.add.reduceat(dentry[order], turn, axis=0)
    g["bias"][...] = dtable.sum(0)
    g["into"][...] = w["embed"].T @ dtable
    g["embed"][...] = dtable @ w["into"].T
    return flat, hidden[-1], loss * float(scale)


class Trainer:
    """Adam steps from given weights over batches of documents."""

    def __init__(self, flat: np.ndarray, rate: float = 0.01):
        self.flat = np.array(flat, np.float32)
        self.w = unpack(self.flat)
        self.rate = rate
        self.one, self.two, self.steps, self.tokens = np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32), 0, 0

    def learn(self, documents: list[np.ndarray]) -> float:
        """One pass; the mean loss per unit."""
        state = np.zeros((LANES, WIDTH), np.float32)
        total, seen = 0.0, 0
        units = sum(len(d) + 1 for d in documents)
        for window in lanes(documents, int(np.clip(units // (WINDOW * LEAST_STEPS), LEAST_LANES, LANES))):
            n = int((window.document >= 0).sum())
            g, state, loss = gradient(self.w, window, state)
            g *= np.float32(min(1.0, 1.0 / (float(np.sqrt((g * g).sum())) + 1e-9)))
            self.steps += 1
            self.one += 0.1 * (g - self.one)
            self.two += 0.01 * (g * g - self.two)
            rate = self.rate / (1 + self.steps / 500)
            self.flat -= rate * (self.one / (1 - 0.9**self.steps)) / (np.sqrt(self.two / (1 - 0.99**self.steps)) + 1e-8)
            for name, own in self.w.items():
                if not name.endswith("bias"):
                    np.clip(own, -MOST_WEIGHT, MOST_WEIGHT, out=own)
            total += loss * n
            seen += n
        self.tokens += seen
        return total / max(1, seen)
