"""A small gated recurrent network with a class-factored softmax, in numpy.

Token ids 0..n-1 fall into consecutive classes of ``width`` ids; the
probability of a token is that of its class times that inside the class.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """The sigmoid of x, in its place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums of short rows (a product is faster than a sum along them)."""
    return x @ np.ones(x.shape[1], x.dtype)


def _log_prob(x: np.ndarray, bias: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log softmax of x + bias at the targets, without the whole matrix of
    it (states lie in -1..1, so logits are far from overflow)."""
    x += bias
    out = x[np.arange(len(target)), target]
    np.exp(x, out=x)
    return out - np.log(_row_sums(x))


class Gru:
    """``tokens`` ids and a start symbol (id ``tokens``) as input; ``hidden``
    units. Arrays: ``x`` input table with the gates' biases, ``u`` recurrent
    weights, ``c``/``cb`` class logits, ``w``/``wb`` logits inside classes."""

    def __init__(self, tokens: int, hidden: int = 16, width: int = 32, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.tokens, self.hidden, self.width = tokens, hidden, width
        self.classes = -(-tokens // width)
        draw = lambda *s: (rng.normal(0, 0.1, s)).astype(np.float32)
        self.p = {"x": draw(tokens + 1, 3 * hidden), "u": draw(hidden, 3 * hidden), "c": draw(hidden, self.classes),
                  "cb": np.zeros(self.classes, np.float32), "w": draw(self.classes, hidden, width),
                  "wb": np.zeros((self.classes, width), np.float32)}
        self.rest()
        last = tokens - (self.classes - 1) * width      # unused places of the last class
        self.p["wb"][-1, last:] = -1e9

    def step(self, ids: np.ndarray, h: np.ndarray):
        return self._gates(self.p["x"][ids], h)

    def _gates(self, g: np.ndarray, h: np.ndarray):
        n, u = self.hidden, h @ self.p["u"]
        zr = _sigmoid(g[:, :2 * n] + u[:, :2 * n])
        z, r = zr[:, :n], zr[:, n:]
        cand = r * u[:, 2 * n:]
        cand += g[:, 2 * n:]
        np.tanh(cand, out=cand)
        out = h - cand
        out *= z
        out += cand
        return out, (z, r, cand, u[:, 2 * n:])

    def log_probs(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each target id given its state."""
        klass, place = np.divmod(ids, self.width)
        order = np.argsort(klass.astype(np.int16), kind="stable")
        h, klass, place = h[order], klass[order], place[order]
        lp = _log_prob(h @ self.p["c"], self.p["cb"], klass)
        edges = np.searchsorted(klass, np.arange(self.classes + 1))
        for k in range(self.classes):
            of = slice(edges[k], edges[k + 1])
            if edges[k] < edges[k + 1]:
                lp[of] += _log_prob(h[of] @ self.p["w"][k], self.p["wb"][k], place[of])
        out = np.empty_like(lp)
        out[order] = lp
        return out

    def score(self, texts: list[np.ndarray], group: int = 1024, window: int = 16) -> np.ndarray:
        """Natural log probability of each whole sequence. Sequences of like
        length run together, ``window`` steps at a time; the state goes on
        from window to window."""
        total = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        for at in range(0, len(order), group):
            part = [k for k in order[at:at + group] if len(texts[k])]
            if not part:
                continue
            lens = np.array([len(texts[k]) for k in part])
            flat, starts = np.concatenate([texts[k] for k in part]), np.cumsum(lens) - lens
            h = np.zeros((len(part), self.hidden), np.float32)
            before = np.full(len(part), self.tokens)
            sums = np.zeros(len(part))
            for begin in range(0, lens[0], window):
                steps = np.arange(begin, min(begin + window, int(lens[0])))
                # the sequences that have each step come first
                alive = np.searchsorted(-lens, -steps)
                ends = np.cumsum(alive)
                states, ids = np.empty((ends[-1], self.hidden), np.float32), np.empty(ends[-1], np.int64)
                for t, n, e in zip(steps.tolist(), alive.tolist(), ends.tolist()):
                    h, _ = self.step(before[:n], h[:n])
                    states[e - n:e] = h
                    before = ids[e - n:e] = flat[starts[:n] + t]
                lp = self.log_probs(states, ids)
                sums[:alive[0]] += np.bincount(np.arange(ends[-1]) - np.repeat(ends - alive, alive), lp, alive[0])
            total[part] = sums
        return total

    def loss(self, ids: np.ndarray, before: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """Mean loss over a window, its gradients (backpropagation stops at
        the window's start) and the last state. Arrays are (steps, streams);
        ``fresh`` marks steps that begin a document."""
        p, n = self.p, self.hidden
        shape, many = (*ids.shape, n), bool(fresh.any())
        states, prev, z, r, cand, un = (np.empty(shape, h.dtype) for _ in range(6))
        inputs = p["x"][before]
        for t in range(len(ids)):
            if many and fresh[t].any():
                h = np.where(fresh[t][:, None], 0, h).astype(h.dtype)
            prev[t] = h
            h, (z[t], r[t], cand[t], un[t]) = self._gates(inputs[t], h)
            states[t] = h
        flat, target = states.reshape(-1, n), ids.ravel()
        klass, place = np.divmod(target, self.width)
        # rows in order of classes, so that those of a class are one slice
        order = np.argsort(klass.astype(np.int16), kind="stable")
        flat, klass, place, count = flat[order], klass[order], place[order], len(target)
        edges = np.searchsorted(klass, np.arange(self.classes + 1))
        g = {k: np.zeros_like(v) for k, v in p.items()}

        def softmax(rows, weights, bias, at):
            """Loss at the targets and its gradient at the logits (states
            lie in -1..1, so logits are far from overflow)."""
            d = rows @ weights
            d += bias
            each = np.arange(len(at))
            hit = d[each, at]
            np.exp(d, out=d)
            sums = _row_sums(d)
            d /= sums[:, None]
            d[each, at] -= 1
            return float(np.log(sums).sum() - hit.sum()), d
        loss, d = softmax(flat, p["c"], p["cb"], klass)
        g["c"], g["cb"] = flat.T @ d, d.sum(0)
        dsorted = d @ p["c"].T
        for k in range(self.classes):
            of = slice(edges[k], edges[k + 1])
            if edges[k] == edges[k + 1]:
                continue
            more, d = softmax(flat[of], p["w"][k], p["wb"][k], place[of])
            loss += more
            g["w"][k], g["wb"][k] = flat[of].T @ d, d.sum(0)
            dsorted[of] += d @ p["w"][k].T
        dstates = np.empty_like(dsorted)
        dstates[order] = dsorted
        dstates, dh = dstates.reshape(shape), np.zeros_like(h)
        # what the gates pass on, of all steps at once
        to_cand, to_z = (1 - z) * (1 - cand * cand), (prev - cand) * z * (1 - z)
        to_r, back = un * r * (1 - r), np.ascontiguousarray(p["u"].T)
        dx = np.empty((*ids.shape, 3 * n), h.dtype)
        du = np.empty_like(dx)
        for t in range(len(ids) - 1, -1, -1):
            dh = dh + dstates[t]
            out, rec = dx[t], du[t]
            np.multiply(dh, to_z[t], out=out[:, :n])
            np.multiply(dh, to_cand[t], out=out[:, 2 * n:])
            np.multiply(out[:, 2 * n:], to_r[t], out=out[:, n:2 * n])
            rec[:, :2 * n] = out[:, :2 * n]
            np.multiply(out[:, 2 * n:], r[t], out=rec[:, 2 * n:])
            dh = dh * z[t] + rec @ back
            if many:
                dh[fresh[t]] = 0
        g["u"] = prev.reshape(-1, n).T @ du.reshape(-1, 3 * n)
        order = np.argsort(before.ravel().astype(np.int32), kind="stable")
        token, first = np.unique(before.ravel()[order], return_index=True)
        g["x"][token] = np.add.reduceat(dx.reshape(-1, 3 * n)[order], first, axis=0)
        return loss / count, {k: v / count for k, v in g.items()}, h

    def _laid_out(self, texts: list[np.ndarray]) -> np.ndarray:
        """Tokens of the texts, the tokens before them and marks of the
        texts' first tokens, as three rows."""
        flat = np.concatenate(texts).astype(np.int64)
        fresh = np.zeros(len(flat), np.int64)
        fresh[np.cumsum([0] + [len(t) for t in texts[:-1]])] = 1
        return np.stack([flat, np.where(fresh, self.tokens, np.append(self.tokens, flat[:-1])), fresh])

    def _descend(self, g: dict[str, np.ndarray], rate: float) -> None:
        """One Adam step along gradients of norm 1 at most."""
        self.t += 1
        size = sum(float((v * v).sum()) for v in g.values()) ** 0.5
        lr = rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for k, v in g.items():
            v = v * min(1.0, 1 / max(size, 1e-9))
            m = self.moments[k]
            m[0] = 0.9 * m[0] + 0.1 * v
            m[1] = 0.999 * m[1] + 0.001 * v * v
            self.p[k] -= (lr * m[0] / (np.sqrt(m[1]) + 1e-6)).astype(np.float32)

    def rest(self) -> None:
        """Forget the moments of the gradients."""
        self.t, self.moments = 0, {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}

    def state(self) -> np.ndarray:
        """Parameters and moments in one vector of fixed size."""
        return np.concatenate([a.ravel() for k, v in self.p.items() for a in (v, *self.moments[k])])

    def set_state(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            a = flat[at:at + 3 * v.size].astype(v.dtype).reshape(3, *v.shape)
            self.p[k], self.moments[k] = a[0].copy(), [a[1].copy(), a[2].copy()]
            at += 3 * v.size

    def read(self, slices: Iterable[list[np.ndarray]], rate: float, streams: int = 256, window: int = 24) -> int:
        """Goes on training over each token of the slices of whole documents
        once; returns the number of tokens."""
        total, tail = 0, np.zeros((3, 0), np.int64)

        def run(part: np.ndarray, n: int) -> None:
            ids, before, fresh = part.reshape(3, n, -1).transpose(0, 2, 1)
            fresh = fresh.astype(bool)
            fresh[0] = True
            h = np.zeros((n, self.hidden), np.float32)
            for at in range(0, len(ids), window):
                w = slice(at, at + window)
                _, g, h = self.loss(ids[w], before[w], fresh[w], h)
                # a short window moves the network by its share of a whole one
                self._descend(g, rate * min(1.0, ids[w].size / (64 * window)))
        for texts in slices:
            texts = [t for t in texts if len(t)]
            if not texts:
                continue
            tail = np.hstack([tail, self._laid_out(texts)])
            n = min(streams, tail.shape[1] // window)
            if n:
                whole = tail.shape[1] // n * n
                run(tail[:, :whole], n)
                total, tail = total + whole, tail[:, whole:]
        if tail.shape[1]:
            run(tail, 1)
        return total + tail.shape[1]

    def train(self, texts: list[np.ndarray], streams: int = 64, window: int = 24, steps: int = 600, rate: float = 0.02) -> list[float]:
        """Adam over windows of parallel streams of whole documents."""
        self.rest()
        texts = [t for t in texts if len(t)]
        if not texts:
            return []
        flat, before, fresh = self._laid_out(texts)
        fresh = fresh.astype(bool)
        streams = max(1, min(streams, len(flat) // window))
        length = len(flat) // streams
        cut = lambda a: a[:streams * length].reshape(streams, length).T
        flat, fresh, before = cut(flat), cut(fresh), cut(before)
        fresh[0] = True
        at, h, losses = 0, np.zeros((streams, self.hidden), np.float32), []
        for t in range(1, steps + 1):
            end = min(at + window, length)
            loss, g, h = self.loss(flat[at:end], before[at:end], fresh[at:end], h)
            losses.append(float(loss))
            at = end if end < length else 0
            self._descend(g, rate * min(1.0, 2 * (1 - t / (steps + 1))))
        return losses
