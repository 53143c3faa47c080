"""A linear-chain conditional random field with the tags clean and toxic, in numpy.

A token's tag depends on its own word, the words beside it, and the tags beside it. The field is
trained from document labels: token tags are hidden, and a document is toxic if it has a toxic
token (or, rarely, by a wrong label).

Messages are kept as ratios toxic : clean, for which a step of the chain is a fraction of two
linear terms. Texts of a batch form one chain that starts anew at every text; it is cut into
lanes that advance together, and passes repeat until the ratios that lanes hand on stand still.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np

FEATURES = 1 << 18
WINDOW, LANE = 12, 64
STEMS = (4, 5, 6, 7)
#: Blocks of a training document that the fit draws, at most: of those that hold a seed word, and of the others. What is
#: drawn stands for all blocks of its kind, by its weight.
MARKED_BLOCKS, OTHER_BLOCKS = 20, 3
#: Blocks that the fit works on at a time, which bounds what it holds besides them.
AT_ONCE = 4_096
#: Shares of documents whose label is toxic without a toxic token, and clean with one.
NOISE_TOXIC, NOISE_CLEAN = 0.02, 0.05
_EDGES = re.compile(r"[\W_]+")


def bare(word: str) -> str:
    """A token's word: lower case, letters and digits only."""
    return _EDGES.sub("", word.lower())


def units(w: str) -> list[str]:
    """What may mark a word as toxic: itself, and the stems that begin it."""
    return [w, *(f"{w[:k]}*" for k in STEMS if len(w) > k)] if w else []


def word_hashes(word: str) -> tuple[int, ...]:
    """Hashes of a word, of its stems (their length alone where the word is no longer) and of its end, and its length."""
    w = bare(word)
    n = len(w)
    h = lambda x: crc32(x.encode("utf-8", "surrogatepass"))
    return (h(w), *(h(w[:k]) if n > k else k for k in STEMS), h(w[-4:]), min(n, 12))


def features_of(hashes: list[tuple[int, ...]]) -> np.ndarray:
    """[words, 12] feature numbers: a bias, word, stems, end and length for its own tag, then word and 5-stem for the next token's tag and for the one before."""
    wide = np.concatenate([np.array(hashes, np.uint64).reshape(-1, 7), np.zeros((len(hashes), 1), np.uint64)], axis=1)
    mixed = (wide[:, [7, 0, 1, 2, 3, 4, 5, 6, 0, 2, 0, 2]] + np.arange(12, dtype=np.uint64) * np.uint64(0x9E3779B9)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % FEATURES


def chain_features(tokens: list[str], blocks: list[int]) -> np.ndarray:
    """[blocks, WINDOW, 12] features of the tokens of numbered blocks of WINDOW tokens; beyond the text's ends stands the empty word."""
    every = features_of([word_hashes(t) for t in ("", *tokens, *[""] * (WINDOW + 1))])
    at = np.array(blocks, np.int64)[:, None] * WINDOW + np.arange(WINDOW) + 1
    return np.concatenate([every[at][:, :, :8], every[at - 1][:, :, 8:10], every[at + 1][:, :, 10:]], axis=2)


@dataclass
class Crf:
    weight: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    #: log-weights [from, to] of clean (0) and toxic (1)
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def emission(self, word: str) -> tuple[float, float, float]:
        """What a word adds to the log-odds of its own tag, of the next token's and of the one before."""
        return tuple(self.emissions([word])[0].tolist())

    def emissions(self, words: list[str]) -> np.ndarray:
        """[words, 3]: see emission."""
        weight = self.weight[features_of([word_hashes(w) for w in words])].astype(np.float64)
        return np.add.reduceat(weight, (0, 8, 10), axis=1)


def _sweep(e: np.ndarray, fresh: np.ndarray, start: float, t: np.ndarray) -> np.ndarray:
    """Forward ratios [LANE, lanes] of emissions e (as ratios), where fresh marks the first token of a text."""
    out = np.empty_like(e)
    first = np.full(e.shape[1], start)
    for _ in range(e.shape[1] + 1):
        r = first
        for k in range(len(e)):
            r = e[k] * np.where(fresh[k], start, (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0]))
            r = np.minimum(np.maximum(r, 1e-100), 1e100)
            out[k] = r
        handed = np.concatenate([[start], r[:-1]])
        if np.all(np.abs(handed - first) <= 1e-9 * handed):
            break
        first = handed
    return out


def marginals(emissions: np.ndarray, starts: np.ndarray, model: Crf) -> np.ndarray:
    """P(toxic) of every token of a batch; starts marks the first token of each text."""
    n = len(emissions)
    if not n:
        return np.zeros(0)
    lanes = -(-n // LANE)
    e, fresh = np.ones(lanes * LANE), np.ones(lanes * LANE, bool)
    e[:n] = np.exp(np.clip(emissions, -40, 40))
    fresh[:n] = starts
    t = np.exp(model.step)
    forward = _sweep(e.reshape(lanes, LANE).T, fresh.reshape(lanes, LANE).T, float(np.exp(model.start)), t).T.reshape(-1)[:n]
    # backwards: the same recursion on the reversed chain, with the emission of the token passed taken in before its step
    last = np.ones(lanes * LANE, bool)
    last[: n - 1] = starts[1:]
    reverse_e, reverse_fresh = e[::-1].reshape(lanes, LANE).T, last[::-1].reshape(lanes, LANE).T
    out = _sweep(np.ascontiguousarray(reverse_e), np.ascontiguousarray(reverse_fresh), 1.0, t.T).T.reshape(-1)[::-1][:n]
    backward = out / e[:n]
    odds = forward * backward
    return odds / (1 + odds)


def seed_words(texts: list[str], toxic: np.ndarray, least: int = 5, ratio: float = 8.0) -> set[str]:
    """Words and stems (ending in *) that mark toxic texts, from equal texts counted once.

    They are taken one by one, by how many toxic texts they explain that none before does.
    What is as typical and at least a third as common among toxic texts as the first is taken too.
    """
    kinds: dict[str, bool] = {}
    for text, bad in zip(texts, toxic, strict=True):
        kinds[text] = bool(bad) or kinds.get(text, False)
    left = [{u for w in set(map(bare, t.split())) for u in units(w)} for t, bad in kinds.items() if bad]
    every = Counter(u for us in left for u in us)
    n1, n0, out, first = len(left), max(len(kinds) - len(left), 1), set(), 0
    least = max(least, n1 // 200)
    often = {u for u, k in every.items() if k >= least}
    clean: Counter[str] = Counter()
    for text, bad in kinds.items():
        if not bad:
            clean.update({u for w in set(map(bare, text.split())) for u in units(w) if u in often})
    typical = {u for u in often if (every[u] / n1) / ((clean[u] + 0.5) / n0) >= ratio}
    left = [us & typical for us in left]
    hits = Counter(u for us in left for u in us)
    while typical:
        unit = max(typical, key=lambda u: (hits[u] / (clean[u] + 1) ** 0.5, u))
        if hits[unit] < least:
            break
        out.add(unit)
        first = first or every[unit]
        for us in left:
            if unit in us:
                hits.subtract(us)
        left = [us for us in left if unit not in us]
    return out | {u for u in typical if first and 3 * every[u] >= first}


@dataclass
class Blocks:
    """Blocks of WINDOW tokens of the training documents: features [n, WINDOW, k], seed tags, document numbers, blocks that each stands for, and labels of documents."""

    x: np.ndarray
    seeded: np.ndarray
    doc: np.ndarray
    weight: np.ndarray
    toxic: np.ndarray


def training_blocks(texts: list[str], toxic: np.ndarray, seed: int = 0) -> Blocks:
    """Blocks that hold seed words, of clean documents too, and a few others of each document, weighted so as to stand for all its blocks."""
    seeds, rng = seed_words(texts, toxic), np.random.default_rng(seed)
    chains, tags, owner, weight = [], [], [], []
    for d, text in enumerate(texts):
        tokens = text.split()
        hit = np.array([not seeds.isdisjoint(units(bare(t))) for t in tokens], bool)
        blocks = -(-len(tokens) // WINDOW)
        if not blocks:
            continue
        marked = np.unique(np.nonzero(hit)[0] // WINDOW)
        others = np.setdiff1d(np.arange(blocks), marked)
        some = []
        for kind, most in ((marked, MARKED_BLOCKS), (others, OTHER_BLOCKS)):
            drawn = kind if len(kind) <= most else rng.choice(kind, most, replace=False)
            some += drawn.tolist()
            weight += [len(kind) / max(len(drawn), 1)] * len(drawn)
        padded = np.concatenate([hit, np.zeros(blocks * WINDOW - len(hit), bool)]).reshape(blocks, WINDOW)
        chains.append(chain_features(tokens, some).astype(np.int32))
        tags.append(padded[some])
        owner += [d] * len(some)
    return Blocks(np.concatenate([np.zeros((0, WINDOW, 12), np.int32), *chains]), np.concatenate([np.zeros((0, WINDOW), bool), *tags]), np.array(owner, np.int64), np.array(weight, np.float64), np.asarray(toxic, bool))


def expectations(model: Crf, x: np.ndarray, at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``expected`` of all blocks, so many at a time."""
    parts = [expected(model, x[k : k + at_once]) for k in range(0, max(len(x), 1), at_once)]
    return tuple(np.concatenate(same) for same in zip(*parts, strict=True))


def expected(model: Crf, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block: P(toxic) of its tokens [n, WINDOW], of pairs of tags [n, 2, 2] summed over its steps, and log P(all clean)."""
    n = len(x)
    s = np.clip(model.weight[x].sum(axis=2).astype(np.float64), -30, 30)
    t = np.exp(model.step)
    alpha, beta = np.empty((WINDOW, n, 2)), np.ones((WINDOW, n, 2))
    e = np.exp(np.stack([np.zeros_like(s), s], axis=2)).transpose(1, 0, 2)
    alpha[0] = e[0] * np.array([1.0, np.exp(model.start)])
    total = np.zeros(n)  # log of the partition sum
    for k in range(WINDOW):
        if k:
            alpha[k] = e[k] * (alpha[k - 1] @ t)
        size = alpha[k].sum(axis=1)
        alpha[k] /= size[:, None]
        total += np.log(size)
    for k in range(WINDOW - 2, -1, -1):
        beta[k] = (e[k + 1] * beta[k + 1]) @ t.T
        beta[k] /= beta[k].sum(axis=1, keepdims=True)
    p = alpha * beta
    p = (p / p.sum(axis=2, keepdims=True))[:, :, 1].T
    joint = alpha[:-1, :, :, None] * t * (e[1:] * beta[1:])[:, :, None, :]
    joint = (joint / joint.sum(axis=(2, 3), keepdims=True)).sum(axis=0)
    return p, joint, (WINDOW - 1) * model.step[0, 0] - total


def label_factors(none: np.ndarray, blocks: Blocks) -> tuple[np.ndarray, float]:
    """What a document's label does to the odds of tags with any toxic token, and the labels' log-likelihood; none: log P(all clean) a block."""
    clean = np.exp(np.minimum(np.bincount(blocks.doc, none * blocks.weight, len(blocks.toxic)), 0.0))
    clean = np.clip(clean, 1e-12, 1 - 1e-12)
    told = np.where(blocks.toxic, (1 - clean) + NOISE_TOXIC * clean, NOISE_CLEAN * (1 - clean) + clean)
    return np.where(blocks.toxic, 1.0, NOISE_CLEAN) / told, float(np.log(told).sum())


def gradient(model: Crf, blocks: Blocks, hidden: bool) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the log-likelihood, for weights, steps and start: of the seed tags, or, with hidden tags, of the documents' labels."""
    p, joint, none = expectations(model, blocks.x)
    if hidden:
        factor = label_factors(none, blocks)[0][blocks.doc]
        q, pairs = p * factor[:, None], joint * factor[:, None, None]
        pairs[:, 0, 0] = WINDOW - 1 - (pairs[:, 0, 1] + pairs[:, 1, 0] + pairs[:, 1, 1])
    else:
        q = (blocks.seeded & blocks.toxic[blocks.doc][:, None]).astype(np.float64)
        a, b = np.stack([1 - q[:, :-1], q[:, :-1]], 2), np.stack([1 - q[:, 1:], q[:, 1:]], 2)
        pairs = np.einsum("nka,nkb->nab", a, b)
    more = (q - p) * blocks.weight[:, None]
    weights = np.zeros(FEATURES)
    for k in range(0, len(more), AT_ONCE):
        x = blocks.x[k : k + AT_ONCE]
        weights += np.bincount(x.ravel(), np.repeat(more[k : k + AT_ONCE].ravel(), x.shape[2]), FEATURES)
    return weights, ((pairs - joint) * blocks.weight[:, None, None]).sum(axis=0), float(more[:, 0].sum())


def train(texts: list[str], toxic: np.ndarray, seeded_rounds: int = 25, rounds: int = 50, rate: float = 0.5, penalty: float = 1e-4, seed: int = 0) -> Crf:
    """A field fitted to the labels of documents by AdaGrad on all blocks; its first rounds follow the seed words."""
    blocks, model = training_blocks(texts, toxic, seed), Crf()
    if not len(blocks.x):
        return model
    n = len(blocks.x)
    grown_w, grown_t, grown_s = np.full(FEATURES, 1e-6), np.full((2, 2), 1e-6), 1e-6
    for k in range(seeded_rounds + rounds):
        g_w, g_t, g_s = gradient(model, blocks, hidden=k >= seeded_rounds)
        g_w, g_t, g_s = g_w / n - penalty * model.weight, g_t / n, g_s / n
        grown_w += g_w**2
        grown_t += g_t**2
        grown_s += g_s**2
        model.weight = (model.weight + rate * g_w / np.sqrt(grown_w)).astype(np.float32)
        model.step = model.step + rate * g_t / np.sqrt(grown_t)
        model.start += rate * g_s / grown_s**0.5
    return model


def summary(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """[texts, 5] of marginals and where each text's tokens end: logit of the largest, logs of 1 + their sum, of 1 + their sum in 100 tokens and of 1 + tokens, 1."""
    starts = np.concatenate([[0], ends[:-1]])
    n = (ends - starts).astype(np.float64)
    most, total = np.zeros(len(ends)), np.zeros(len(ends))
    full = ends > starts
    if full.any():
        at = starts[full]
        most[full] = np.maximum.reduceat(p, at)
        total[full] = np.add.reduceat(p, at)
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(most / (1 - most)), np.log1p(total), np.log1p(100 * total / np.maximum(n, 1)), np.log1p(n), np.ones(len(ends))], axis=1)


def fit_scores(x: np.ndarray, y: np.ndarray, rounds: int = 50, penalty: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (y - p) - penalty * w)
    return w
