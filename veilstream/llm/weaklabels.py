"""Weak supervision: a generative model of voters and the linear classifier trained on its posteriors.

The label model sees nothing but how often each combination of votes occurs.  A hidden class makes
each voter fire at its own rate (its accuracy); voters that fire together more than the class
explains are joined in blocks with a table of their own (their correlation).  Rates and tables are
fitted by expectation maximisation over all combinations.  What is believed of a voter beforehand
starts the fit and stays in it as made-up observations, a share of the real ones; a posterior is
then that of the fitted model and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np


def belief(worth: list[float], masks: np.ndarray) -> np.ndarray:
    """Belief in the class for combinations of votes: voters taken as independent, each right as often as it is worth; 0 worth speaks against."""
    w = np.array(worth, float)
    bits = (np.asarray(masks, np.int64)[:, None] >> np.arange(len(w))) & 1
    p = 1 - np.prod(1 - bits * w, axis=1)
    return np.where((bits * (w == 0)).sum(1) > 0, 0.1 * p, p)


@dataclass
class LabelModel:
    """P(class = 1 | votes) for one category; ``blocks`` are groups of voters judged together."""

    names: list[str]
    worth: list[float]  # how often each voter is believed to be right; 0: it speaks against
    trust: float = 0.25  # made-up observations by belief for each real one
    silence: float = 0.0  # weight of a block's abstaining as evidence: none, as a class has kinds and most voters speak of one kind only
    prior: float = 0.01
    blocks: list[list[int]] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)  # [class, state]
    fires: np.ndarray | None = None  # [class, voter]: how often a voter fires 
    together: np.ndarray | None = None  # [voter, voter]: correlation given the class, the greater of both

    def _state(self, masks: np.ndarray, block: list[int]) -> np.ndarray:
        out = np.zeros(len(masks), int)
        for k, i in enumerate(block):
            out |= ((masks >> i) & 1) << k
        return out

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        """The class's probability under the fitted model.  Silence of all voters leaves the base rate."""
        masks = np.asarray(masks, np.int64)
        s = np.full(len(masks), np.log(self.prior) - np.log1p(-self.prior))
        for block, table in zip(self.blocks, self.tables):
            weight = np.log(table[1]) - np.log(table[0])
            states = np.arange(len(weight))
            speaks_for = sum(((states >> k) & 1) * (self.worth[i] > 0) for k, i in enumerate(block)) > 0
            weight = np.where(speaks_for, weight, np.minimum(weight, 0.0))  # votes against are never evidence for
            weight[0] *= self.silence
            s += weight[self._state(masks, block)]
        return np.where(masks > 0, 1 / (1 + np.exp(-np.clip(s, -40, 40))), self.prior)

    def _maximise(self, masks: np.ndarray, n: np.ndarray, p: np.ndarray, held: np.ndarray) -> None:
        p = np.where(masks > 0, (p + self.trust * held) / (1 + self.trust), 0.0)  # or else the base rate would feed itself
        self.prior = float(np.clip((n * p).sum() / n.sum(), 1e-6, 0.3))
        self.tables = []
        for block in self.blocks:
            state, size = self._state(masks, block), 1 << len(block)
            table = np.stack([np.bincount(state, n * w, size) for w in (1 - p, p)]) + 0.1
            self.tables.append(table / table.sum(1, keepdims=True))

    def fit(self, masks: np.ndarray, n: np.ndarray, rounds: int = 60, linked: float = 0.6, widest: int = 3) -> LabelModel:
        """Fit to combinations ``masks`` that occur ``n`` times."""
        masks, n = np.asarray(masks, np.int64), np.asarray(n, float)
        if not len(masks) or n.sum() == 0:
            masks, n = np.zeros(1, np.int64), np.ones(1)
        k = len(self.names)
        bits = (masks[:, None] >> np.arange(k)) & 1
        p = held = belief(self.worth, masks)
        self.blocks = [[i] for i in range(k)]
        for stage in range(2):
            self._maximise(masks, n, p, held)
            for _ in range(rounds):
                p = self.posterior(masks)
                self._maximise(masks, n, p, held)
            if stage == 0:
                self.together = self._correlations(bits, n, p)
                self.blocks = self._link(self.together, linked, widest)
        self.fires = np.stack([((n * w)[:, None] * bits).sum(0) / max((n * w).sum(), 1e-9) for w in (1 - p, p)])
        return self

    @staticmethod
    def _correlations(bits: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        out = np.zeros((bits.shape[1],) * 2)
        for w in (n * (1 - p), n * p):
            total = max(w.sum(), 1e-9)
            mean = (w[:, None] * bits).sum(0) / total
            cov = (bits * w[:, None]).T @ bits / total - np.outer(mean, mean)
            sd = np.sqrt(np.clip(mean * (1 - mean), 1e-9, None))
            r = np.abs(cov / np.outer(sd, sd))
            out = np.maximum(out, np.where(np.minimum(mean[:, None], mean[None, :]) * total >= 5, r, 0))
        np.fill_diagonal(out, 0)
        return out

    @staticmethod
    def _link(r: np.ndarray, linked: float, widest: int) -> list[list[int]]:
        """Greatest correlations first, blocks of at most ``widest`` voters."""
        block = {i: [i] for i in range(len(r))}
        pairs = sorted(((r[i, j], i, j) for i in range(len(r)) for j in range(i)), reverse=True)
        for v, i, j in pairs:
            if v < linked:
                break
            if block[i] is not block[j] and len(block[i]) + len(block[j]) <= widest:
                both = block[i] + block[j]
                for x in both:
                    block[x] = both
        seen, out = set(), []
        for b in block.values():
            if id(b) not in seen:
                seen.add(id(b))
                out.append(sorted(b))
        return out


def pieces(word: str) -> list[str]:
    """A word as features: itself and its runs of four letters, with its ends marked."""
    w = f"^{word}$"
    return [word, *(w[i:i + 4] for i in range(len(w) - 3))] if len(w) > 7 else [word]


def own_features(word: str, classes: tuple[str, ...]) -> list[str]:
    return [*pieces(word), *(f"@{c}" for c in classes)]


def joint_features(words: Sequence[str], classes: Callable[[str], tuple[str, ...]]) -> list[str]:
    """Pairs of neighbours, and pairs of classes of words that follow each other with at most two words between."""
    out = [f"{a} {b}" for a, b in zip(words, words[1:])]
    told = [(i, own) for i, w in enumerate(words) if (own := classes(w))]
    for k, (i, before) in enumerate(told):
        for j, after in told[k + 1:k + 4]:
            if j - i > 3:
                break
            out += [f"@{a}>{b}" for a in before for b in after]
    return out


def features(words: Sequence[str], classes: Callable[[str], tuple[str, ...]] = lambda w: ()) -> list[str]:
    """Words, their pieces and classes, and pairs of them.  What voters make of a segment is none of the classifier's business."""
    return [f for w in words for f in own_features(w, classes(w))] + joint_features(words, classes)


@dataclass
class LinearClassifier:
    """Logistic regression on soft labels; weights by feature."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def score(self, found: Sequence[str]) -> float:
        """From the features of a segment."""
        z = self.bias + sum(self.weights.get(f, 0.0) for f in found)
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))


def fit_linear(made: list[list[str]], labels: np.ndarray, rounds: int = 200, rate: float = 0.5, shrink: float = 0.3, least: int = 2) -> list[LinearClassifier]:
    """From rows of features, one classifier a column of ``labels``, by whole-batch steps scaled by each weight's past gradients.

    Features in less than ``least`` rows are left out; ``shrink`` is the squared-weight penalty.
    """
    count: dict[str, int] = {}
    for r in made:
        for f in set(r):
            count[f] = count.get(f, 0) + 1
    names = sorted(f for f, c in count.items() if c >= least)
    index = {f: i for i, f in enumerate(names)}
    at = [np.array(sorted(index[f] for f in r if f in index), np.int64) for r in made]
    sizes = np.array([len(x) for x in at], int)
    flat = np.concatenate(at) if at else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(made)), sizes)
    out = []
    for k in range(labels.shape[1]):
        y = labels[:, k]
        w, g = np.zeros(len(names)), np.full(len(names), 1e-3)
        base = float(np.clip(y.sum() / max(len(y), 1), 1e-4, 0.5))
        b, gb = float(np.log(base / (1 - base))), 1e-3
        speed = np.zeros(len(names))
        for _ in range(rounds if len(made) else 0):
            z = np.bincount(row, w[flat], len(made)) + b
            e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            step = np.bincount(flat, e[row], len(names)) + shrink * w
            g = 0.9 * g + 0.1 * step * step
            speed = 0.8 * speed - 0.2 * rate * step / np.sqrt(g + 1e-6) * 0.2
            w += speed
            gb = 0.9 * gb + 0.1 * e.sum() ** 2
            b -= 0.04 * rate * e.sum() / np.sqrt(gb + 1e-6)
        out.append(LinearClassifier({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-4}, b))
    return out
