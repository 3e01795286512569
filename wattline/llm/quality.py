"""Quality by hierarchical empirical Bayes: what a document shows, and what its site and path have shown.

A logistic classifier on whole-text statistics gives each document its evidence, a log likelihood ratio. Grouped
aggregation turns the documents' probabilities into good shares of hosts and of paths; the strength of the shrinkage
(host to global, path to host) is estimated from the spread between the groups, so a sparse site says little. A
document's posterior adds its evidence to the log odds of its path, from which it has itself been taken out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm import textbytes
from wattline.llm.common import column, cut, labelled_sample, sized_broadcast, whole

#: The bound of the training sample: so many labelled documents of either class.
PER_CLASS = 3000
#: Documents with a lower posterior are rejected.
KEEP_AT = 0.5
#: Most (host, path) groups that are broadcast to the documents; beyond it that join is shuffled.
BROADCAST_BOUND = 200_000
#: Evidence and prior log odds are held within these, so that neither silences the other.
MOST_EVIDENCE = 12.0
MOST_PRIOR = 2.0

_LAGS = range(1, 9)
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[ord(c) for c in " \t\r\n.,;:'\"!?()-"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True


def features(texts) -> np.ndarray:
    """Statistics of whole texts; a text without words has zeros but for the constant that says so."""
    out = np.zeros((len(texts), 10))
    for begun, raws in textbytes.chunks(texts):
        cut_up = textbytes.tokenize(raws)
        hashes, first = cut_up.hashes(), cut_up.first
        cased = np.frombuffer(b" " + b" ".join(raws) + b" ", dtype=np.uint8)
        low = cut_up.low
        symbol = ~textbytes._IN_WORD[low] & ~_PLAIN[low]
        after = cut_up.end[cut_up.end < len(low)]
        sums = {
            "upper": _sums(_UPPER[cased]),
            "symbol": _sums(symbol),
            "runs": _sums(np.append(False, (low[1:] == low[:-1]) & ~textbytes._IN_WORD[low[1:]] & (low[1:] != 32))),
            "line": _sums(cased == 10),
            "bar": _sums(cased == ord("|")),
            "digit": _sums((low >= 48) & (low <= 57)),
        }
        repeated = np.zeros(len(hashes), dtype=bool)
        for lag in _LAGS:
            repeated[lag:] |= hashes[lag:] == hashes[:-lag]
        glued = np.zeros(len(hashes), dtype=bool)
        glued[: len(after)] = symbol[after]
        word_sums = {"same": _sums(repeated), "glued": _sums(glued), "length": _sums(cut_up.end - cut_up.start)}
        lo, hi = cut_up.text_start[:-1], cut_up.text_start[1:] - 1
        n_bytes = np.maximum(hi - lo, 1)
        n_words = np.maximum(np.diff(first), 1)
        a, b = first[:-1], first[1:]
        of_bytes = {k: (v[hi] - v[lo]) for k, v in sums.items()}
        of_words = {k: (v[b] - v[a]) / n_words for k, v in word_sums.items()}
        out[begun : begun + len(raws)] = np.stack(
            [
                of_bytes["upper"] / n_bytes,
                of_bytes["symbol"] / n_bytes,
                np.minimum(of_bytes["runs"] / n_words, 3),
                np.minimum(of_bytes["line"] / n_words, 1),
                np.minimum(of_bytes["bar"] / n_words, 2),
                of_bytes["digit"] / n_bytes,
                of_words["same"],
                of_words["glued"],
                np.minimum(of_words["length"], 30),
                (np.diff(first) == 0).astype(float),
            ],
            axis=1,
        )
    return out


def _sums(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks)])


@dataclass
class Model:
    """Log likelihood ratio of good against bad, and the share of good labels."""

    mean: np.ndarray
    spread: np.ndarray
    beta: np.ndarray
    good: float

    def evidence(self, texts) -> np.ndarray:
        x = (features(texts) - self.mean) / self.spread
        return np.clip(x @ self.beta[:-1] + self.beta[-1], -MOST_EVIDENCE, MOST_EVIDENCE)


def train(texts: list[str], labels: np.ndarray, counts: tuple[int, int]) -> Model:
    """Ridge logistic regression; without labels of both classes the evidence is 0 for every text."""
    good = (counts[1] + 1) / (sum(counts) + 2)
    x = features(texts) if texts else np.zeros((0, 10))
    width = x.shape[1]
    if len(texts) == 0 or labels.min() == labels.max():
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1), good)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    design = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = np.diag([*[1.0] * width, 1e-3])
    beta = np.zeros(width + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, design.T @ (p - labels) + ridge @ beta)
        beta -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    share = labels.mean()
    beta[-1] -= np.log(share / (1 - share))  # odds of the sample go, the ratio of likelihoods stays
    return Model(mean, spread, beta, good)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model of ``labels.quality``, learnt from at most ``per_class`` documents of either class."""
    rows, counts = labelled_sample(docs, labels, "quality", per_class)
    return train([r.text for r in rows], np.array([r.label for r in rows], dtype=np.int64), counts)


def evidence(model: Model, text: Column) -> Column:
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.evidence(textbytes.views(texts)))

    # as a non-deterministic function, which it is not, it is run once per row even where a filter uses its result
    return F.arrow_udf(of, "double").asNondeterministic()(text)


def _logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(mean: Column, n: Column, spread: Column) -> Column:
    """Pseudo-count of a Beta prior from the spread between groups, beyond what chance gives."""
    chance = mean * (1 - mean)
    return F.least(F.greatest(chance / F.greatest(spread - chance / n, chance / 1e4) - 1, F.lit(1.0)), F.lit(1e4))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Shrunk good shares from rows ``(host, path, p)``: ``host, path, sum_p, n, host_rate, weight``.

    Everything is grouped aggregation, combined before its shuffles; a host or path of any size is only summed.
    ``weight`` is the strength with which a path is drawn to its host.
    """
    paths = cut(scored.groupBy("host", "path").agg(F.sum("p").alias("sum_p"), F.count("*").alias("n")))
    hosts = cut(paths.groupBy("host").agg(F.sum("sum_p").alias("host_p"), F.sum("n").alias("host_n")))
    rate = F.col("host_p") / F.col("host_n")
    total = hosts.agg(
        F.sum("host_p").alias("p"), F.sum("host_n").alias("n"), F.avg("host_n").alias("each"), F.count("*").alias("k")
    ).first()
    mean = min(max(total.p / total.n, 0.01), 0.99) if total.k else 0.5
    between = hosts.agg((F.sum(F.col("host_n") * (rate - mean) ** 2) / F.sum("host_n")).alias("v")).first().v or 0.0
    prior = F.lit(mean)
    kappa = _strength(prior, F.lit(float(total.each or 1.0)), F.lit(float(between)))
    hosts = hosts.withColumn("host_rate", (F.col("host_p") + kappa * prior) / (F.col("host_n") + kappa))
    joined = paths.join(
        hosts.select(F.col("host").alias("_host"), "host_rate"), F.col("host").eqNullSafe(F.col("_host"))
    ).drop("_host")
    inside = joined.agg(
        (F.sum(F.col("n") * (F.col("sum_p") / F.col("n") - F.col("host_rate")) ** 2) / F.sum("n")).alias("v"),
        F.avg("n").alias("each"),
    ).first()
    weight = _strength(prior, F.lit(float(inside.each or 1.0)), F.lit(float(inside.v or 0.0)))
    return joined.withColumn("weight", weight)


def posteriors(
    docs: DataFrame, model: Model, host: Column, path: Column, text: str = "text", keep_at: float = KEEP_AT
) -> DataFrame:
    """The rows with ``quality_evidence, quality_site, quality`` (0 to 1) and ``rejected``.

    ``quality_site`` is the path's shrunk share of good documents without the row itself. Null hosts and paths are
    groups of their own. Null and empty texts are texts without words. Columns of these names are replaced; all
    others, and repeated rows, are kept.
    """
    names = ("quality_evidence", "quality_site", "quality", "rejected")
    prior = float(np.log(model.good / (1 - model.good)))
    scored = docs.select(
        whole(docs, *names), evidence(model, column(text)).alias("evidence"), host.alias("host"), path.alias("path")
    ).withColumn("p", _logistic(F.col("evidence") + prior))
    sites = cut(site_posteriors(scored.select("host", "path", "p")))
    sites = sites.toDF(*[f"site_{name}" for name in sites.columns])
    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    strength = F.col("site_weight")
    others = F.col("site_sum_p") - F.col("p") + strength * F.col("site_host_rate")
    rate = others / (F.col("site_n") - 1 + strength)
    odds = F.greatest(F.least(F.log(rate / (1 - rate)), F.lit(MOST_PRIOR)), F.lit(-MOST_PRIOR))
    return (
        scored.join(sized_broadcast(sites, sites.count(), BROADCAST_BOUND), same)
        .withColumn("site", rate)
        .withColumn("quality", _logistic(F.col("evidence") + odds))
        .select(
            "row.*",
            F.col("evidence").alias("quality_evidence"),
            F.col("site").alias("quality_site"),
            "quality",
            (F.col("quality") < keep_at).alias("rejected"),
        )
    )


def document_site(source: str = "source", lang: str = "lang") -> tuple[Column, Column]:
    """Site of a corpus document: its source is the host, the source's part in one language the path."""
    return F.col(source), F.concat_ws("/", F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(lang), F.lit("")))


def url_site(url: str = "url") -> tuple[Column, Column]:
    """Site of a web page: the host name, and the host with the first folder of its path."""
    host = F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    folder = F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^/?#]*)/", 1)
    return host, F.concat(host, folder)
