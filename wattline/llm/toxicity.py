"""Toxicity: a convolutional text classifier in numpy.

A word is the mean of the hashed embeddings of the word itself and of its first four and five bytes, so that unseen
forms of a known stem are understood. Filters over one, two and three words run along the whole text; each filter's
greatest response over the text goes into a logistic output. Training follows the gradient through those maxima only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm import textbytes
from wattline.llm.common import labelled_sample

BUCKETS = 1 << 17
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
#: The bound of the training sample: so many labelled documents of either class.
PER_CLASS = 4000
#: Passes over the sample, and the least number of steps, for which small samples are passed over more often.
EPOCHS = 4
STEPS = 120
BATCH = 64
#: A score of this or more is a predicted toxic text, in the query fixed by its contract.
PREDICT_AT = 0.3
#: A threshold is calibrated on at least so many toxic documents; languages with fewer are judged by that of all
#: languages, and all by ``PREDICT_AT`` if even together there are fewer.
LEAST_TOXIC = 20

_SALTS = np.array([0x1B873593CC9E2D51, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D], dtype=np.uint64)
_PAD = max(WIDTHS) - 1


def word_features(cut_up: textbytes.Words) -> np.ndarray:
    """Embedding rows of every word: of the word, and of its first four and five bytes."""
    parts = [cut_up.hashes()]
    for n in (4, 5):
        parts.append(cut_up.hashes(cut_up.start, np.minimum(cut_up.start + n, cut_up.end)))
    salted = textbytes.mixed(np.stack(parts, axis=1) ^ _SALTS)
    return (salted % np.uint64(BUCKETS)).astype(np.int32)


@dataclass
class Model:
    words: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray  # one weight per filter of all widths
    scale: tuple[float, float] = (1.0, 0.0)  # calibration of the output
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = PREDICT_AT

    def responses(self, rows: np.ndarray, first: np.ndarray):
        """Word vectors with padding after each text, filter responses, and where each text's words are."""
        counts = np.diff(first)
        begin = first[:-1] + _PAD * np.arange(len(counts))
        text = np.repeat(np.arange(len(counts)), counts)
        vectors = np.zeros((len(rows) + _PAD * len(counts), DIM), dtype=np.float32)
        place = np.arange(len(rows)) + _PAD * text
        vectors[place] = self.words[rows[:, 0]] + self.words[rows[:, 1]] + self.words[rows[:, 2]]
        vectors *= np.float32(1 / 3)
        heard = []
        for width, weights, bias in zip(WIDTHS, self.filters, self.bias):
            reply = vectors @ weights[0]
            for j in range(1, width):
                reply[:-j] += vectors[j:] @ weights[j]
            heard.append(reply + bias)
        return vectors, heard, place, begin, counts

    def pooled(self, heard, begin, counts) -> np.ndarray:
        """The greatest response of every filter over each text, at least zero; zero for texts without words."""
        some = np.flatnonzero(counts > 0)
        best = np.zeros((len(counts), FILTERS * len(WIDTHS)), dtype=np.float32)
        if len(some):
            edges = np.stack([begin[some], begin[some] + counts[some]], axis=1).ravel()
            if edges[-1] >= len(heard[0]):
                edges = edges[:-1]
            for k, reply in enumerate(heard):
                top = np.maximum.reduceat(reply, edges, axis=0)[::2]
                best[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top, 0)
        return best

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        _, heard, _, begin, counts = self.responses(rows, first)
        return self.pooled(heard, begin, counts).astype(np.float64) @ self.out[:-1] + self.out[-1]

    def scores(self, texts) -> np.ndarray:
        """Calibrated probabilities of whole texts; null counts as empty."""
        out = np.zeros(len(texts))
        for begun, raws in textbytes.chunks(texts):
            cut_up = textbytes.tokenize(raws)
            out[begun : begun + len(raws)] = self.logits(word_features(cut_up), cut_up.first)
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * out + self.scale[1], -40, 40)))


def _features(text: str | None) -> np.ndarray:
    return word_features(textbytes.tokenize([textbytes.raw(text)]))


def _log_odds(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """How much more often toxic documents have a feature, shrunk where it is rare."""
    seen = np.zeros((2, BUCKETS))
    for begun, raws in textbytes.chunks(texts):
        cut_up = textbytes.tokenize(raws)
        rows = word_features(cut_up)
        for d in range(len(raws)):
            own = np.unique(rows[cut_up.first[d] : cut_up.first[d + 1]])
            seen[labels[begun + d], own] += 1
    total = [(labels == 0).sum() + 1, (labels == 1).sum() + 1]
    odds = np.log((seen[1] + 0.5) / total[1]) - np.log((seen[0] + 0.5) / total[0])
    count = seen.sum(axis=0)
    return np.clip(odds, -5, 5) * count / (count + 4)


def _step(model: Model, rows: np.ndarray, first: np.ndarray, labels: np.ndarray, memory: dict, rate: float) -> None:
    """One step of Adagrad on a batch; the gradient flows through each filter's best position only."""
    vectors, heard, place, begin, counts = model.responses(rows, first)
    best = model.pooled(heard, begin, counts)
    logit = best @ model.out[:-1] + model.out[-1]
    error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / len(labels)
    origin = np.full(len(vectors), -1)
    origin[place] = np.arange(len(rows))

    def learn(name, value, gradient):
        sums = memory.setdefault(name, np.full(value.shape, 1e-6))
        sums += gradient**2
        value -= (rate * gradient / np.sqrt(sums)).astype(value.dtype)

    touched, pushes = [], []
    for k, width in enumerate(WIDTHS):
        span = slice(k * FILTERS, (k + 1) * FILTERS)
        at = np.zeros((len(counts), FILTERS), dtype=np.int64)
        for d in np.flatnonzero(counts > 0):
            at[d] = begin[d] + heard[k][begin[d] : begin[d] + counts[d]].argmax(axis=0)
        push = error[:, None] * model.out[:-1][span] * (best[:, span] > 0)
        gradient = np.zeros_like(model.filters[k])
        for j in range(width):
            spot = np.minimum(at + j, len(vectors) - 1)
            gradient[j] = np.einsum("bf,bfd->df", push, vectors[spot])
            word = origin[spot]
            real = (word >= 0) & (push != 0)
            touched.append(word[real])
            pushes.append((push[:, :, None] * model.filters[k][j].T[None])[real] / 3)
        learn(("f", k), model.filters[k], gradient)
        learn(("b", k), model.bias[k], push.sum(axis=0))
    learn("out", model.out, np.append(error @ best + 1e-4 * model.out[:-1], error.sum()))
    touched, pushes = np.concatenate(touched), np.concatenate(pushes)
    if len(touched):
        ids, back = np.unique(rows[touched].ravel(), return_inverse=True)
        gradient = np.zeros((len(ids), DIM))
        np.add.at(gradient, back.ravel(), np.repeat(pushes, 3, axis=0))
        sums = memory.setdefault("words", np.full((BUCKETS, DIM), 1e-4, dtype=np.float32))
        sums[ids] += gradient**2
        model.words[ids] -= (0.2 * rate * gradient / np.sqrt(sums[ids])).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, langs: list[str | None], counts: tuple[int, int], seed: int = 7) -> Model:
    """A model of the labelled texts. ``counts`` are the labels of either class in the whole table.

    Two fifths of the texts tell where embeddings start, two train the network, and one, unseen by both, calibrates
    its output to the whole table's share of toxic labels and sets the thresholds. With labels of one class only, every score is the
    share of toxic labels, 0 without any.
    """
    rng = np.random.default_rng(seed)
    words = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    filters = [rng.normal(0, 0.05, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
    out = np.append(rng.normal(0, 0.01, FILTERS * len(WIDTHS)), 0.0)
    model = Model(words, filters, bias, out)
    part = np.empty(len(texts), dtype=np.int64)
    for label in (0, 1):
        mine = np.flatnonzero(labels == label)
        part[rng.permutation(mine)] = np.array([0, 1, 0, 1, 2])[np.arange(len(mine)) % 5]
    early, later, unseen = (np.flatnonzero(part == i) for i in range(3))
    if any(np.bincount(labels[some], minlength=2).min() == 0 for some in (early, later, unseen)):
        share = counts[1] / max(1, sum(counts))
        model.out[:] = 0
        model.scale = (0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
        return model
    words[:, 0] = _log_odds([texts[i] for i in early], labels[early])
    for weights in filters:
        weights[0, 0, :2] = 1.0
        out[:-1].reshape(len(WIDTHS), FILTERS)[0, :2] = 0.5
    out[-1] = -1.0

    held = [_features(texts[i]) for i in later]
    memory: dict = {}
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(later)))
    for epoch in range(epochs):
        order = rng.permutation(len(later))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rows = np.concatenate([held[i] for i in batch])
            first = np.concatenate([[0], np.cumsum([len(held[i]) for i in batch])])
            _step(model, rows, first, labels[later[batch]], memory, 0.05 / (1 + epoch * EPOCHS / epochs))
    logit = np.concatenate([model.logits(rows, np.array([0, len(rows)])) for rows in (_features(texts[i]) for i in unseen)])
    own = labels[unseen]
    weight = np.where(own == 1, counts[1] / own.sum(), counts[0] / (1 - own).sum())
    model.scale = _platt(logit, own, weight / weight.mean())
    score = 1 / (1 + np.exp(-np.clip(model.scale[0] * logit + model.scale[1], -40, 40)))
    if own.sum() >= LEAST_TOXIC:
        model.threshold = _threshold(score, own, weight)
    lang = np.array([x or "" for x in (langs[i] for i in unseen)])
    for name in sorted(set(lang)):
        mine = lang == name
        if name and own[mine].sum() >= LEAST_TOXIC:
            model.thresholds[name] = _threshold(score[mine], own[mine], weight[mine])
    return model


def _platt(logit: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by weighted Newton steps, with a little ridge so that separable data stay finite."""
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - labels)) + 1e-2 * (beta - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def _threshold(score: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The threshold of the best F1, in the middle of the gap that it lies in."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum((weight * labels)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * labels).sum())
    last = np.append(s[1:] < s[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    below = s[best + 1] if best + 1 < len(s) else 0.0
    return float(min(max((s[best] + below) / 2, 0.1), 0.9))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model of ``labels.toxic``, learnt from at most ``per_class`` documents of either class."""
    rows, counts = labelled_sample(docs, labels, "toxic", per_class, ("lang",))
    return train([r.text for r in rows], np.array([r.label for r in rows], dtype=np.int64), [r.lang for r in rows], counts)


def score(model: Model, text: Column) -> Column:
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(textbytes.views(texts)))

    return F.arrow_udf(scores, "double")(text)


def threshold(model: Model, lang: Column) -> Column:
    """The calibrated threshold of a row's language."""
    out = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def judge(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows with ``toxicity`` (0 to 1) and ``toxic``, whether it reaches the threshold of the row's language.

    Null and empty texts are scored as texts without words. Columns of these names are replaced, all others and
    repeated rows kept.
    """
    return docs.withColumn("toxicity", score(model, F.col(text))).withColumn(
        "toxic", F.col("toxicity") >= threshold(model, F.col(lang))
    )
