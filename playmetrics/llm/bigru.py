"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its hashed embedding beside the mean embedding of its hashed
byte trigrams. Two recurrent passes read a window of words, attention weighs
their joint states, and a logistic unit scores the weighted mean.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_BITS, CHAR_BITS = 18, 14
WORD_SIZE, CHAR_SIZE = 12, 12
STATE, FOCUS = 12, 8

Params = dict[str, np.ndarray]
TABLES = ("words", "chars")


def initial(seed: int = 0, dtype=np.float32) -> Params:
    rng = np.random.default_rng(seed)
    inputs = WORD_SIZE + CHAR_SIZE

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.normal(size=shape) * scale).astype(dtype)

    # a word that training never saw keeps a zero embedding and speaks through its trigrams
    p = {"words": np.zeros((1 << WORD_BITS, WORD_SIZE), dtype),
         "chars": normal(1 << CHAR_BITS, CHAR_SIZE, scale=0.2),
         "focus_in": normal(2 * STATE, FOCUS, scale=0.3), "focus_bias": np.zeros(FOCUS, dtype),
         "focus_out": normal(FOCUS, scale=0.3), "out": normal(2 * STATE, scale=0.3),
         "bias": np.zeros(1, dtype)}
    for side in ("ahead", "back"):
        p[f"{side}_in"] = normal(inputs, 3 * STATE, scale=inputs ** -0.5)
        p[f"{side}_bias"] = np.zeros(3 * STATE, dtype)
        p[f"{side}_state"] = normal(STATE, 3 * STATE, scale=STATE ** -0.5)
    return p


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * x.dtype.type(0.5)) * x.dtype.type(0.5) + x.dtype.type(0.5)


# ------------------------------------------------------------------ inputs

@dataclass(frozen=True)
class Lexicon:
    """Distinct words: embedding cells, and trigram cells with the start of each word's."""

    words: np.ndarray
    chars: np.ndarray
    starts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.chars)))


def lexicon(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> Lexicon:
    """Of words given as byte spans of ``data``; A-Z read as a-z."""
    lengths = ends - starts
    # each word between two marks has as many trigrams as bytes
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    own = data[at].astype(np.uint32)
    own += np.uint32(32) * ((own >= 65) & (own <= 90))
    first = np.cumsum(lengths) - lengths
    left, right = np.roll(own, 1), np.roll(own, -1)
    left[first] = 1
    right[first + lengths - 1] = 2
    cells = (left * np.uint32(0x9E3779B1) + own * np.uint32(0x85EBCA77)
             + right * np.uint32(0xC2B2AE3D))
    cells ^= cells >> np.uint32(15)
    return Lexicon((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64),
                   (cells * np.uint32(0x27D4EB2F) >> np.uint32(32 - CHAR_BITS)).astype(np.int64), first)


def inputs_of(p: Params, lex: Lexicon, known: np.ndarray | None = None) -> np.ndarray:
    """``known`` (0 or 1 per word) hides word embeddings, so that trigrams have to learn, too."""
    chars = np.add.reduceat(p["chars"][lex.chars], lex.starts, axis=0)
    chars /= lex.sizes[:, None].astype(chars.dtype)
    words = p["words"][lex.words]
    if known is not None:
        words = words * known[:, None]
    return np.concatenate([words, chars], axis=1)


def summed(rows: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, and the sum of the rows of each."""
    order = np.argsort(number, kind="stable")
    distinct, starts = np.unique(number[order], return_index=True)
    return distinct, np.add.reduceat(rows[order], starts, axis=0)


# ------------------------------------------------------------------ forward

@dataclass
class Trace:
    """What the backward pass needs."""

    x: np.ndarray
    states: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: dict[str, list] = field(default_factory=dict)
    focus: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pooled: np.ndarray = field(default_factory=lambda: np.zeros(0))


def forward(p: Params, lex: Lexicon, windows: np.ndarray, keep: bool = False,
            known: np.ndarray | None = None) -> tuple[np.ndarray, Trace]:
    """Logit of each window; ``windows`` holds word numbers, -1 after the end."""
    x = inputs_of(p, lex, known)
    trace = Trace(x)
    n, length = windows.shape
    mask = (windows >= 0).astype(x.dtype)
    whole = bool(mask.all())
    states = np.empty((length, n, 2 * STATE), x.dtype)
    for side, order in (("ahead", range(length)), ("back", range(length - 1, -1, -1))):
        given = x @ p[f"{side}_in"] + p[f"{side}_bias"]
        weights = p[f"{side}_state"]
        h = np.zeros((n, STATE), x.dtype)
        steps = []
        for t in order:
            g = given[windows[:, t]]
            u = h @ weights
            gates = sigmoid(g[:, :2 * STATE] + u[:, :2 * STATE])
            z, r = gates[:, :STATE], gates[:, STATE:]
            new = np.tanh(g[:, 2 * STATE:] + r * u[:, 2 * STATE:])
            after = new + z * (h - new)
            if not whole:
                after = h + mask[:, t, None] * (after - h)
            if keep:
                steps.append((t, h, z, r, new, u[:, 2 * STATE:]))
            h = after
            if side == "ahead":
                states[t, :, :STATE] = h
            else:
                states[t, :, STATE:] = h
        trace.steps[side] = steps
    focus = np.tanh(states @ p["focus_in"] + p["focus_bias"])
    score = focus @ p["focus_out"]
    score[mask.T == 0] = -1e9
    score -= score.max(axis=0)
    share = np.exp(score)
    share /= share.sum(axis=0)
    pooled = np.einsum("tn,tnd->nd", share, states)
    trace.states, trace.focus, trace.share, trace.pooled = states, focus, share, pooled
    return pooled @ p["out"] + p["bias"][0], trace


# ------------------------------------------------------------------ backward

def gradients(p: Params, lex: Lexicon, windows: np.ndarray, trace: Trace, slope: np.ndarray,
              known: np.ndarray | None = None) -> dict:
    """Gradient of the loss, given its slope in each window's logit.

    The two embedding tables have (rows, gradient of those rows).
    """
    mask = (windows >= 0).astype(slope.dtype)
    states, focus, share = trace.states, trace.focus, trace.share
    g: dict = {k: np.zeros_like(v) for k, v in p.items() if k not in TABLES}
    g["out"] += trace.pooled.T @ slope
    g["bias"] += slope.sum()
    d_pooled = slope[:, None] * p["out"]
    d_states = share[:, :, None] * d_pooled
    d_share = np.einsum("nd,tnd->tn", d_pooled, states)
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    g["focus_out"] += np.einsum("tn,tnf->f", d_score, focus)
    d_focus = d_score[:, :, None] * p["focus_out"] * (1 - focus * focus)
    g["focus_in"] += np.einsum("tnd,tnf->df", states, d_focus)
    g["focus_bias"] += d_focus.sum(axis=(0, 1))
    d_states += d_focus @ p["focus_in"].T

    d_x = np.zeros_like(trace.x)
    for side, part in (("ahead", slice(0, STATE)), ("back", slice(STATE, None))):
        weights = p[f"{side}_state"]
        d_given = np.zeros((len(trace.x), 3 * STATE), trace.x.dtype)
        d_step = np.empty((*windows.shape[::-1], 3 * STATE), trace.x.dtype)
        d_h = np.zeros((len(windows), STATE), trace.x.dtype)
        for t, h, z, r, new, u_new in reversed(trace.steps[side]):
            m = mask[:, t, None]
            d_h = d_h + d_states[t, :, part]
            d_after = d_h * m
            d_new = d_after * (1 - z) * (1 - new * new)
            d_z = d_after * (h - new) * z * (1 - z)
            d_r = d_new * u_new * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_step[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            g[f"{side}_state"] += h.T @ d_u
            d_h = d_h * (1 - m) + d_after * z + d_u @ weights.T
        inside = windows.T >= 0
        number, rows = summed(d_step[inside], windows.T[inside])
        d_given[number] = rows
        g[f"{side}_in"] += trace.x.T @ d_given
        g[f"{side}_bias"] += d_given.sum(axis=0)
        d_x += d_given @ p[f"{side}_in"].T
    d_words = d_x[:, :WORD_SIZE] if known is None else d_x[:, :WORD_SIZE] * known[:, None]
    g["words"] = summed(d_words, lex.words)
    per_char = np.repeat(d_x[:, WORD_SIZE:] / lex.sizes[:, None].astype(d_x.dtype), lex.sizes, axis=0)
    g["chars"] = summed(per_char, lex.chars)
    return g


class Adam:
    """Rows of the embedding tables move only when a batch holds them."""

    def __init__(self, p: Params, rate: float):
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: Params, g: dict) -> None:
        self.step += 1
        scale = self.rate * (1 - 0.999 ** self.step) ** 0.5 / (1 - 0.9 ** self.step)
        for k in p:
            rows, grad = g[k] if k in TABLES else (slice(None), g[k])
            m = self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * grad
            v = self.v[k][rows] = 0.999 * self.v[k][rows] + 0.001 * grad * grad
            p[k][rows] -= (scale * m / (np.sqrt(v) + 1e-6)).astype(p[k].dtype)
