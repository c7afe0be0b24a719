"""A gated recurrent network over word ids with a softmax over word classes, in numpy.

Training is truncated backpropagation: the hidden state is carried from window to window, gradients stay inside
one. Scoring carries it through whole documents of any length.
"""

from __future__ import annotations

import numpy as np

HIDDEN = EMBED = 16
WINDOW = 16
#: Steps, of all documents read side by side, whose class shares are held at a time.
CELLS = 512
Params = dict[str, np.ndarray]


def initial(inputs: int, class_counts: np.ndarray, seed: int = 5) -> Params:
    """Small random weights; the output starts as the class frequencies of the whole corpus."""
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    share = (class_counts + 1.0) / (class_counts + 1.0).sum()
    return {
        "embed": normal(inputs, EMBED, scale=0.3),
        "into": normal(EMBED, 3 * HIDDEN, scale=EMBED**-0.5),
        "back": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "gate": np.zeros(3 * HIDDEN, np.float32),
        "out": normal(HIDDEN, len(share), scale=0.05),
        "prior": np.log(share).astype(np.float32),
    }


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _views(values: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def unflat(values: np.ndarray, like: Params) -> Params:
    return {k: v.astype(np.float32) for k, v in _views(values, like).items()}


def window_gradients(
    p: Params, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, h: np.ndarray, live: np.ndarray
) -> tuple[float, Params, np.ndarray]:
    """Summed log-loss of one window (lanes x steps), its gradient per live step, and the state after it.

    ``fresh`` marks steps that begin a document: the state before them is zero. ``live`` marks steps that count.
    """
    # Steps come first and lanes last inside, so that what a step reads lies together, in rows of whole lanes.
    lanes, steps = inputs.shape
    at, n = inputs.T.ravel(), HIDDEN
    kept = np.where(fresh.T, 0, 1).astype(h.dtype)
    x = p["embed"][at].reshape(steps, lanes, EMBED)
    drive = p["into"].T @ x.transpose(0, 2, 1)
    drive += p["gate"][:, None]
    gates = np.empty((steps, 2 * n, lanes), drive.dtype)
    before, hidden, new, turned = (np.empty((steps, n, lanes), drive.dtype) for _ in range(4))
    into_gates, state = np.ascontiguousarray(p["back"].T), np.ascontiguousarray(h.T)
    for t in range(steps):
        held, zr, c = before[t], gates[t], new[t]
        np.multiply(state, kept[t], out=held)
        a = into_gates @ held
        np.add(a[: 2 * n], drive[t, : 2 * n], out=zr)
        zr *= 0.5  # sigmoid(x) = (tanh(x / 2) + 1) / 2
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        turned[t] = a[2 * n :]
        np.multiply(zr[n:], turned[t], out=c)
        c += drive[t, 2 * n :]
        np.tanh(c, out=c)
        state = hidden[t]
        np.subtract(c, held, out=state)
        state *= zr[:n]
        state += held
    counts, want, lane = live.T, targets.T, np.arange(lanes)
    weight = (counts / max(counts.sum(), 1)).astype(drive.dtype)
    scores, prior, loss = np.ascontiguousarray(p["out"].T), p["prior"][:, None], 0.0
    d_hidden, d_out, d_prior = np.empty_like(hidden), np.zeros_like(scores), np.zeros_like(p["prior"])
    # States lie within -1 and 1, so the weights tell whether exponentials could overflow or all vanish.
    reach = np.abs(p["out"]).sum(axis=0)
    steep = max((p["prior"] + reach).max(), -(p["prior"] - reach).max()) > 60
    some = max(1, CELLS // lanes)
    for low in range(0, steps, some):  # few steps at a time, so that their shares stay in cache
        at_once = slice(low, min(low + some, steps))
        state, part = hidden[at_once], weight[at_once]
        share = scores @ state
        share += prior
        if steep:
            share -= share.max(axis=1, keepdims=True)
        np.exp(share, out=share)
        cell = (np.arange(len(share))[:, None], want[at_once], lane)
        size, picked = share.sum(axis=1), share[cell]
        loss -= float(np.log(np.maximum(picked / size, 1e-30))[counts[at_once]].sum())
        share *= (part / size)[:, None]
        share[cell] -= part
        d_out += (share @ state.transpose(0, 2, 1)).sum(axis=0)
        d_prior += share.sum(axis=(0, 2))
        np.matmul(p["out"], share, out=d_hidden[at_once])
    z, r = gates[:, :n], gates[:, n:]
    # What a step's loss does to its three inputs, but for the factor that the later steps give.
    factors = np.empty((steps, 4 * n, lanes), drive.dtype)
    rest = 1 - z
    np.multiply((new - before) * z, rest, out=factors[:, :n])
    np.multiply(1 - new * new, z, out=factors[:, 2 * n : 3 * n])
    np.multiply(factors[:, 2 * n : 3 * n], r, out=factors[:, 3 * n :])
    np.multiply(factors[:, 3 * n :] * turned, 1 - r, out=factors[:, n : 2 * n])
    d_a = np.empty((steps, 3 * n, lanes), drive.dtype)
    carry = np.zeros_like(hidden[0])
    for t in range(steps - 1, -1, -1):
        d = d_hidden[t]
        d += carry
        step = factors[t].reshape(4, n, lanes)
        step *= d
        d_a[t, : 2 * n], d_a[t, 2 * n :] = factors[t, : 2 * n], factors[t, 3 * n :]
        carry = p["back"] @ d_a[t]
        d *= rest[t]
        carry += d
        carry *= kept[t]
    d_drive = factors[:, : 3 * n]
    g = {"out": d_out.T, "prior": d_prior, "gate": d_drive.sum(axis=(0, 2))}
    g["back"] = (before @ d_a.transpose(0, 2, 1)).sum(axis=0)
    g["into"] = (d_drive @ x).sum(axis=0).T
    dx = (d_drive.transpose(0, 2, 1) @ p["into"].T).ravel()
    cells = (at[:, None] * EMBED + np.arange(EMBED)).ravel()
    g["embed"] = np.bincount(cells, dx, minlength=p["embed"].size).reshape(-1, EMBED).astype(dx.dtype)
    return loss, g, hidden[-1].T


def train(p: Params, inputs: np.ndarray, classes: np.ndarray, fresh: np.ndarray, rate: float = 0.01, seed: int = 0) -> Params:
    """One pass of Adam over a stream of documents cut into lanes."""
    n = len(inputs)
    if n == 0:
        return p
    lanes = int(np.clip(n // 2000, 4, 256))
    length = -(-n // lanes)
    pad = lanes * length - n
    live = np.concatenate([np.ones(n, bool), np.zeros(pad, bool)]).reshape(lanes, length)
    grid = [np.concatenate([a, np.zeros(pad, a.dtype)]).reshape(lanes, length) for a in (inputs, classes, fresh)]
    # One vector holds all weights, and their views are changed in place.
    like, weights = p, flat(p)
    p = _views(weights, like)
    m, v, d, e = (np.zeros_like(weights) for _ in range(4))
    h = np.zeros((lanes, HIDDEN), np.float32)
    for step, at in enumerate(range(0, length, WINDOW), 1):
        part = [a[:, at : at + WINDOW] for a in (*grid, live)]
        _, g, h = window_gradients(p, part[0], part[1], part[2], h, part[3])
        size = rate * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
        np.concatenate([g[k].ravel() for k in sorted(g)], out=d)
        m *= 0.9
        v *= 0.99
        m += np.multiply(d, 0.1, out=e)
        np.multiply(d, d, out=e)
        e *= 0.01
        v += e
        np.sqrt(v, out=e)
        e += 1e-7
        np.divide(m, e, out=e)
        e *= size
        weights -= e
    return unflat(weights, like)


def document_scores(p: Params, inputs: np.ndarray, classes: np.ndarray, first: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Per document the summed natural log-probability of its classes, plus ``value[class]`` for each.

    ``inputs`` and ``classes`` hold documents in a row (``first``: their bounds): the id read before each step and the
    class it predicts. Documents are read side by side, longest first, in windows; the state goes on.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], first[:-1][order]
    scores = np.zeros(len(lengths))
    n, into, gate = HIDDEN, p["into"].T.copy(), p["gate"][:, None].copy()
    back = p["back"].T.copy()
    # Halved gates: sigmoid(x) = (tanh(x / 2) + 1) / 2. The other half of the second gate is in what it multiplies.
    for weights in (into, gate, back):
        weights[: 2 * n] *= 0.5
    back[2 * n :] *= 0.5
    out_rows, prior = np.ascontiguousarray(p["out"].T), p["prior"][:, None]
    state = np.zeros((n, len(lengths)), np.float32)
    longest = int(lengths[0]) if len(lengths) else 0
    for at in range(0, longest, WINDOW):
        lanes = int(np.searchsorted(-lengths, -at))  # documents longer than ``at``
        steps = min(WINDOW, longest - at)
        # Few documents at a time, so that what a window holds stays in cache.
        for low in range(0, lanes, 256):
            high = min(low + 256, lanes)
            index = starts[low:high] + at + np.arange(steps)[:, None]
            live = at + np.arange(steps)[:, None] < lengths[low:high]
            index *= live
            read, want, lane = inputs[index], classes[index], np.arange(high - low)
            # Lanes come last inside, so that a step's gates are rows of whole lanes.
            drive = into @ p["embed"][read].transpose(0, 2, 1)
            drive += gate
            h = state[:, low:high]
            hidden = np.empty((steps, n, high - low), np.float32)
            for t in range(steps):
                a = back @ h
                zr, c = a[: 2 * n], a[2 * n :]
                zr += drive[t, : 2 * n]
                np.tanh(zr, out=zr)
                zr += 1
                c *= zr[n:]
                c += drive[t, 2 * n :]
                np.tanh(c, out=c)
                c -= h
                c *= zr[:n]
                c *= 0.5
                h = np.add(h, c, out=hidden[t])
            state[:, low:high] = h
            gain = np.empty(index.shape, np.float32)
            some = max(1, CELLS // (high - low))
            for first_step in range(0, steps, some):
                part = slice(first_step, min(first_step + some, steps))
                logits = out_rows @ hidden[part]
                logits += prior
                picked = logits[np.arange(len(logits))[:, None], want[part], lane]
                # Logits are bounded by the weights, far from overflow in float32.
                np.exp(logits, out=logits)
                np.subtract(picked, np.log(logits.sum(axis=1)), out=gain[part])
            scores[low:high] += np.where(live, gain + value[want], 0).sum(axis=0)
    out = np.empty(len(scores))
    out[order] = scores
    return out
