"""A gated recurrent network over word ids, in numpy: fitted by truncated backpropagation, applied to whole texts.

The output is factored: a class given the state, then a word given the class and the state. The last class holds all words
that have no id; what such a word is, the network leaves to its caller. Texts lie one after the other in lanes that advance
together; the state of a lane is carried from window to window and is zero where a text begins.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Sizes of the state and of a word's vector; classes.
STATE, VECTOR, CLASSES = 32, 24, 64
#: Steps of a window when fitting, lanes, steps that lie in them; tokens after which lanes are more, how many; steps of a window when scoring, lanes.
WINDOW, FIT_LANES, FIT_STEPS, SETTLED, WIDE_LANES, TOGETHER, LANES = 32, 48, 32 * 16, 250_000, 192, 32, 256
#: Bytes of the largest blocks that are kept for the next window.
KEPT = 30 << 20
RATE, CLIP = 0.01, 1.0

Weights = dict[str, np.ndarray]


@dataclass
class Classes:
    """of: class of every id, the unknown word's last. first: where each class begins (ids are sorted by class)."""

    of: np.ndarray
    first: np.ndarray


def classes(counts: np.ndarray) -> Classes:
    """Ids in order of their counts, cut into classes of near equal counts."""
    share = np.cumsum(counts) - counts / 2
    of = np.minimum(CLASSES - 1, (share / max(1, counts.sum()) * CLASSES)).astype(np.int64)
    of = np.unique(of, return_inverse=True)[1] if len(of) else of
    k = int(of.max(initial=-1)) + 1
    return Classes(np.append(of, k), np.searchsorted(of, np.arange(k + 1)))


def begin(counts: np.ndarray, unknown: float, seed: int = 7) -> Weights:
    """Weights that give every word its share of the counts, whatever the state."""
    rng, c, v = np.random.default_rng(seed), classes(counts), len(counts)
    k = len(c.first) - 1
    mass = np.array([counts[a:b].sum() for a, b in zip(c.first, c.first[1:])] + [unknown]) + 0.1
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {
        "vectors": rng.normal(0, 0.3, (v + 1, VECTOR)), "input": draw(VECTOR, 3 * STATE), "gates": np.zeros(3 * STATE), "state": draw(STATE, 3 * STATE),
        "class": np.zeros((STATE, k + 1)), "class_bias": np.log(mass / mass.sum()), "word": np.zeros((v, STATE)), "word_bias": np.log((counts + 0.1) / max(1, counts.sum())),
    }
    return {n: x.astype(np.float32) for n, x in w.items()}


def _gates(w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input, bias and state matrices, gates first; those of the logistic gates halved, as a logistic function is had by its tangent."""
    s = w["state"].shape[0]
    half = np.repeat(np.array([0.5, 1], w["state"].dtype), [2 * s, s])[:, None]
    return w["input"].T * half, w["gates"][:, None] * half, w["state"].T * half


def _states(state: np.ndarray, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, kept: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """States after each step (steps, STATE, lanes). x: gate inputs (steps, 3 * STATE, lanes), which become the gates; fresh:
    where a text begins; kept: gets the states before each step and what they give to the gates."""
    s, begins, runs = len(h), fresh.any(1), (~fresh).astype(x.dtype)
    out, u, rn = np.empty((len(x), *h.shape), x.dtype), np.empty(x.shape[1:], x.dtype), np.empty_like(h)
    for t in range(len(x)):
        if begins[t]:
            h = h * runs[t]
        if kept is not None:
            kept[0][t], u = h, kept[1][t]
        np.matmul(state, h, out=u)
        zr, n, h_next = x[t, : 2 * s], x[t, 2 * s :], out[t]
        zr += u[: 2 * s]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        n += np.multiply(zr[s:], u[2 * s :], out=rn)
        np.tanh(n, out=n)
        np.subtract(h, n, out=h_next)
        h_next *= zr[:s]
        h_next += n
        h = h_next
    return out


def _outputs(w: Weights, c: Classes, h: np.ndarray, y: np.ndarray, grads: Weights | None = None):
    """Natural log probability of each target, an unknown word's being that of its class; with grads, dh of the mean loss.
    States (steps, STATE, lanes), targets (steps, lanes)."""
    steps, s, lanes = h.shape
    n, of = y.size, c.of[y.ravel()]
    order = np.argsort(of.astype(np.int16), kind="stable")  # few classes: sorted by digits
    of, y, rows, dh = of[order], y.ravel()[order], np.arange(n), None
    h = np.ascontiguousarray(h.transpose(0, 2, 1)).reshape(n, s)[order]
    logits = h @ w["class"]
    logits += w["class_bias"]
    np.minimum(logits, 80, out=logits)  # logits are near logs of shares: only a cap is needed
    out = logits[rows, of]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype) + np.float32(1e-30)
    out -= np.log(total)
    if grads is not None:
        logits *= (1 / (n * total))[:, None]
        logits[rows, of] -= logits.dtype.type(1 / n)
        grads["class"][:], grads["class_bias"][:] = (logits.T @ h).T, logits.sum(0)
        dh = logits @ w["class"].T
    # the words of a class: a block of rows for each class, all blocks in one row of numbers
    sizes = np.append(np.diff(c.first), 0)
    ends, blocks = np.searchsorted(of, np.arange(len(c.first))), []
    told = int(ends[-1])  # targets that are words
    if told:
        wide = sizes[of[:told]]
        starts = np.cumsum(wide) - wide
        flat = np.empty(int(wide.sum()), h.dtype)
        one = np.concatenate([h[:told], np.ones((told, 1), h.dtype)], 1)
        words = np.concatenate([w["word"], w["word_bias"][:, None]], 1)
        at = starts[np.minimum(ends[:-1], told - 1)].tolist()
        for a, b, i, j, k in zip(c.first.tolist(), c.first[1:].tolist(), ends.tolist(), ends[1:].tolist(), at):
            if i < j:
                block = flat[k : k + (j - i) * (b - a)].reshape(j - i, b - a)
                np.matmul(one[i:j], words[a:b].T, out=block)
                blocks.append((a, b, i, j, block))
        chosen = starts + y[:told] - c.first[of[:told]]
        np.minimum(flat, 80, out=flat)
        out[:told] += flat[chosen]
        np.exp(flat, out=flat)
        total = np.add.reduceat(flat, starts) + np.float32(1e-30)
        out[:told] -= np.log(total)
        if grads is not None:
            flat *= np.repeat(1 / (n * total), wide)
            flat[chosen] -= flat.dtype.type(1 / n)
            slopes = np.zeros_like(words)
            for a, b, i, j, block in blocks:
                np.matmul(block.T, one[i:j], out=slopes[a:b])
                dh[i:j] += block @ w["word"][a:b]
            grads["word"][:], grads["word_bias"][:] = slopes[:, :s], slopes[:, s]
    back = np.empty_like(out)
    back[order] = out
    if grads is not None:
        d = np.empty_like(dh)
        d[order] = dh
        dh = np.ascontiguousarray(d.reshape(steps, lanes, s).transpose(0, 2, 1))
    return back, dh


def gradients(w: Weights, c: Classes, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, grads: Weights | None = None) -> tuple[Weights, float, np.ndarray]:
    """Of the mean loss over one window (steps, lanes), truncated at its begin; the loss and the state after it. ``grads``: zeros that take them."""
    grads = {n: np.zeros_like(v) for n, v in w.items()} if grads is None else grads
    steps, lanes, s, kind = *x.shape, h.shape[1], w["state"].dtype
    into, bias, state = _gates(w)
    vectors = np.ones((steps, lanes, VECTOR + 1), kind)  # the last is for the bias
    vectors[:, :, :VECTOR] = w["vectors"][x]
    gates = np.matmul(np.concatenate([into, bias], 1), vectors.transpose(0, 2, 1))
    before, u = np.empty((steps, s, lanes), kind), np.empty((steps, 3 * s, lanes), kind)
    states = _states(state, gates, fresh, np.ascontiguousarray(h.T, kind), (before, u))
    logs, dh = _outputs(w, c, states, y, grads)
    z, r, n = gates[:, :s], gates[:, s : 2 * s], gates[:, 2 * s :]
    by_z, by_n, by_r, rest = before - n, n * n, 1 - r, 1 - z
    np.subtract(1, by_n, out=by_n)
    by_n *= rest
    by_z *= z
    by_z *= rest
    by_r *= r
    by_r *= u[:, 2 * s :]
    du, dn, dvectors, later = u, np.empty((s, lanes), kind), np.empty((steps, lanes, VECTOR), kind), np.zeros((s, lanes), kind)
    into, begins, runs = np.zeros((VECTOR + 1, 3 * s), kind), fresh.any(1), (~fresh).astype(kind)
    for t in range(steps - 1, -1, -1):
        d = dh[t]
        d += later
        np.multiply(d, by_n[t], out=dn)
        np.multiply(d, by_z[t], out=du[t, :s])
        np.multiply(dn, by_r[t], out=du[t, s : 2 * s])
        np.multiply(dn, r[t], out=du[t, 2 * s :])
        np.matmul(w["state"], du[t], out=later)
        later += np.multiply(d, z[t], out=d)
        if begins[t]:
            later *= runs[t]
        grads["state"] += before[t] @ du[t].T
        du[t, 2 * s :] = dn  # from here on the slopes of the gates' inputs
        into += vectors[t].T @ du[t].T
        np.matmul(du[t].T, w["input"].T, out=dvectors[t])
    grads["input"][:], grads["gates"][:] = into[:-1], into[-1]
    at = np.argsort(x.ravel().astype(np.int16) if len(w["vectors"]) < 1 << 15 else x.ravel(), kind="stable")
    ids, first = np.unique(x.ravel()[at], return_index=True)
    grads["vectors"][ids] = np.add.reduceat(dvectors.reshape(-1, VECTOR)[at], first)
    return grads, -float(logs.mean()), np.ascontiguousarray(states[-1].T)


def _keep_blocks() -> None:
    """A block that was freed makes glibc keep smaller ones for later use; else pages come and go with every window."""
    np.empty(KEPT, np.uint8)


def _flat(w: Weights, fill: bool = True) -> tuple[np.ndarray, Weights]:
    """All weights in one row, and as parts of it."""
    row, parts, at = np.zeros(sum(v.size for v in w.values()), np.float32), {}, 0
    for n, v in w.items():
        parts[n] = row[at : at + v.size].reshape(v.shape)
        at += v.size
        if fill:
            parts[n][:] = v
    return row, parts


def fit(w: Weights, c: Classes, texts: Iterable[np.ndarray]) -> tuple[Weights, int]:
    """Weights after one pass over the texts (ids, the end's last), and the tokens seen. ``w`` is left as it was."""
    _keep_blocks()
    (row, w), (slope, grads) = _flat(w), _flat(w, fill=False)
    first, second, some, step, seen = np.zeros_like(row), np.zeros_like(row), np.empty_like(row), 0, 0
    for lanes, ids in _stretches(texts):
        seen += len(ids[0])
        x, y, fresh = _laned(*ids, lanes)
        h = np.zeros((x.shape[1], STATE), np.float32)
        for a in range(0, len(x), WINDOW):
            part = slice(a, a + WINDOW)
            slope.fill(0)
            _, _, h = gradients(w, c, x[part], y[part], fresh[part], h, grads)
            step += 1
            norm = math.sqrt(float(slope @ slope))
            if norm > CLIP:
                slope *= CLIP / norm
            first *= 0.9  # ten times the mean slope; so is the root of second
            first += slope
            second *= 0.99
            second += np.multiply(slope, slope, out=slope)
            np.sqrt(second, out=some)
            some += 1e-5
            np.divide(first, some, out=some)
            some *= RATE * math.sqrt(lanes / FIT_LANES) * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            row -= some
    return w, seen


def _stretches(texts: Iterable[np.ndarray]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Stretches of the texts laid end to end, with where texts begin in them, and their lanes: more once the first have set the weights."""
    parts, fresh, n, done, lanes = [], [], 0, 0, FIT_LANES
    for t in texts:
        a = 0
        while a < len(t):
            most = lanes * FIT_STEPS
            piece = t[a : a + most]
            parts.append(piece)
            start = np.zeros(len(piece), bool)
            start[0] = a == 0
            fresh.append(start)
            a, n = a + len(piece), n + len(piece)
            if n >= most:
                yield lanes, (np.concatenate(parts), np.concatenate(fresh))
                done += n
                parts, fresh, n, lanes = [], [], 0, FIT_LANES if done < SETTLED else WIDE_LANES
    if n:
        yield (lanes if n >= lanes * WINDOW else FIT_LANES), (np.concatenate(parts), np.concatenate(fresh))


def _laned(ids: np.ndarray, fresh: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and begins by step and lane; a few tokens at the end that fill no step of all lanes go."""
    lanes = max(1, min(lanes, len(ids)))
    steps = len(ids) // lanes
    before = np.append(ids[-1:], ids[:-1])
    before[fresh] = 0  # the end's id: a text begins after an end
    cut = lambda v: np.ascontiguousarray(v[: steps * lanes].reshape(lanes, steps).T)
    begins = cut(fresh)
    begins[0] = True
    return cut(before), cut(ids), begins


class Scorer:
    """Natural log probabilities of whole texts."""

    def __init__(self, w: Weights, c: Classes):
        _keep_blocks()
        self.w, self.c = w, c
        into, bias, self.state = _gates(w)
        self.into, self.vectors = np.concatenate([into, bias], 1), np.concatenate([w["vectors"], np.ones((len(w["vectors"]), 1), np.float32)], 1)

    def __call__(self, texts: list[np.ndarray]) -> np.ndarray:
        """One sum for each text: ids, the end's last. Lanes take texts one after the other."""
        out = np.zeros(len(texts))
        if not texts:
            return out
        lens = np.array([len(t) for t in texts])
        lanes = int(max(1, min(LANES, len(texts), -(-lens.sum() // max(1, lens.max())) * 2)))
        queues, load = [[] for _ in range(lanes)], np.zeros(lanes, np.int64)
        for i in np.argsort(-lens, kind="stable"):
            k = int(load.argmin())
            queues[k].append(i)
            load[k] += lens[i]
        order = np.argsort(-load, kind="stable")
        queues, load = [queues[k] for k in order], load[order]
        steps = int(load[0])
        x, y, whose = np.zeros((steps, lanes), np.int32), np.zeros((steps, lanes), np.int32), np.full((steps, lanes), len(texts), np.int32)
        fresh = np.zeros((steps, lanes), bool)
        for k, queue in enumerate(queues):
            y[: load[k], k] = np.concatenate([texts[i] for i in queue])
            whose[: load[k], k] = np.repeat(queue, lens[queue])
            begins = np.cumsum([0, *lens[queue[:-1]]])
            x[1 : load[k], k] = y[: load[k] - 1, k]
            x[begins, k] = 0
            fresh[begins, k] = True
        h = np.zeros((STATE, lanes), np.float32)
        for a in range(0, steps, TOGETHER):
            alive = int(np.searchsorted(-load, -a, side="left"))  # lanes with more than a tokens
            part = slice(a, a + TOGETHER), slice(alive)
            gates = np.matmul(self.into, self.vectors[x[part]].transpose(0, 2, 1))
            states = _states(self.state, gates, fresh[part], np.ascontiguousarray(h[:, :alive]))
            h = states[-1]
            logs, _ = _outputs(self.w, self.c, states, y[part])
            out += np.bincount(whose[part].ravel(), logs, len(texts) + 1)[:-1]  # past a lane's end nothing counts
        return out
