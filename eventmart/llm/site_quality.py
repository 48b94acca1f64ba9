"""Quality classifier: a document's own evidence, and what its host and path are known for.

Evidence is the log-odds of a logistic classifier over the looks of a text, trained on a bounded
sample of labelled documents. Hosts and paths get Beta posteriors of their share of good
documents: a path is shrunk toward its host and a host toward all documents, the more the fewer
documents it has. How much is estimated from the data (empirical Bayes, by moments). A document's
posterior joins its evidence with its path's posterior, from which its own share is taken out.

Defined cases: a null or empty text has no words and is rejected; null hosts and null paths are
groups of their own; repeated rows count as often as they occur; without labels of both classes
the evidence is zero, and every document with a word is kept; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.shared import (
    binary_texts,
    labelled_sample,
    same,
    table,
    unused,
    with_columns,
)
from eventmart.session import settle

# Bound of the training sample: documents of each class.
SAMPLE = 1000
# No text counts for more than this, as log-odds.
MOST_EVIDENCE = 6.0
KEEP = 0.5

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
FEATURES = 11


def looks(raw: bytes) -> list[float]:
    """What a text looks like, as numbers from about 0 to 1."""
    words = raw.split()
    count, size = len(words), max(len(raw), 1)
    if not count:
        return [0.0] * FEATURES
    lines = [line for line in raw.split(b"\n") if line]
    sentences = raw.count(b". ") + raw.count(b".\n") + raw.count(b"? ") + raw.count(b"! ")
    return [
        1.0,
        min(math.log10(count) / 4, 1.5),
        min(8 * (size - len(raw.translate(None, SYMBOLS))) / size, 2.0),
        min(20 * raw.count(b"|") / size, 2.0),
        min(2 * (size - len(raw.translate(None, CAPITALS))) / size, 2.0),
        min(4 * raw.count(b"!") / count, 2.0),
        min(4 * (size - len(raw.translate(None, DIGITS))) / size, 2.0),
        min(4 * sum(map(eq, words, words[1:])) / count, 4.0),
        len(set(words)) / count,
        1 - len(set(lines)) / max(len(lines), 1),
        min(10 * sentences / count, 2.0),
    ]


@dataclass
class Looks:
    """A logistic classifier over ``looks``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def evidence(self, texts: list[bytes]) -> list[float]:
        """Log-odds that a text is good, against even odds; 0 for a text without words."""
        if not texts:
            return []
        x = np.array([looks(t) for t in texts])
        score = ((x - self.mean) / self.scale) @ self.weights
        return np.where(x[:, 0] > 0, np.clip(score, -MOST_EVIDENCE, MOST_EVIDENCE), 0.0).tolist()


def train(texts: list[bytes], labels: list[int], rounds: int = 25) -> Looks | None:
    """A classifier of texts."""
    return train_looks([looks(t) for t in texts], labels, rounds)


def train_looks(seen: list[list[float]], labels: list[int], rounds: int = 25) -> Looks | None:
    """Ridge logistic regression by Newton steps; both classes weigh the same."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return None
    x = np.array(seen)
    mean, scale = x.mean(0), x.std(0)
    mean[0], scale[0] = 0.0, 1.0  # the constant
    scale[scale < 1e-6] = 1.0
    x = (x - mean) / scale
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(FEATURES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(FEATURES)
        w = w + np.linalg.solve(bend, slope)
    return Looks(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Looks | None:
    """A classifier trained on up to ``most`` labelled documents of each class."""

    def make(column):
        return {"looks": [looks(raw) for raw in binary_texts(column)]}

    rows = labelled_sample(docs, labels, "quality", most, make, "looks array<double>")
    rows = rows.orderBy("key", "doc_id").collect()
    return train_looks([r["looks"] for r in rows], [r["label"] for r in rows])


def add_evidence(
    docs: DataFrame, looks_model: Looks | None, name: str, keep: bool = False
) -> DataFrame:
    """Put a struct (score, words) in the place of ``text``, or beside it."""

    def make(column):
        raw = binary_texts(column)
        scores = looks_model.evidence(raw) if looks_model else [0.0] * len(raw)
        return {name: [{"score": s, "words": bool(t.split())} for s, t in zip(scores, raw)]}

    return with_columns(docs, "text", make, f"{name} struct<score: double, words: boolean>", keep)


@dataclass
class Prior:
    """Share of good documents overall, and how many documents' worth each prior is."""

    mean: float
    host: float
    path: float


def _strength(groups: float, n: float, n2: float, spread: float, noise: float) -> float:
    """Documents' worth of a Beta prior, from the spread of group means (by moments).

    ``noise`` is m(1 - m). Groups that differ no more than chance makes them are shrunk fully.
    """
    most = 1e6
    if n <= groups or groups < 2 or noise <= 0:
        return most
    alike = (spread - (groups - 1) * noise) / (noise * (n - n2 / n - (groups - 1)))
    return most if alike <= 1 / most else max((1 - alike) / alike, 1.0)


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, Prior]:
    """Totals of each (host, path) with its host's, and the priors, from (host, path, score).

    Everything is grouped sums: by path first, hosts are summed from paths, and the priors come
    from one row of sums.
    """
    good = F.expr("1 / (1 + exp(-score))")
    paths = settle(
        scored.groupBy("host", "path").agg(F.sum(good).alias("good"), F.count("*").alias("n"))
    )
    hosts = paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    sites = settle(paths.join(hosts, same(paths, hosts, ["host"])).drop(hosts["host"]))
    total = paths.agg(F.sum("good"), F.sum("n")).first()
    if not total[1]:
        return sites, Prior(0.5, 1.0, 1.0)
    mean = total[0] / total[1]
    noise = mean * (1 - mean)
    h = hosts.agg(
        F.count("*"),
        F.sum("host_n"),
        F.sum(F.expr("double(host_n) * host_n")),
        F.sum(F.expr(f"host_n * pow(host_good / host_n - {mean!r}D, 2)")),
    ).first()
    p = sites.agg(
        F.count("*"),
        F.sum("n"),
        F.sum(F.expr("double(n) * n")),
        F.sum(F.expr("n * pow(good / n - host_good / host_n, 2)")),
    ).first()
    return sites, Prior(mean, _strength(*h, noise), _strength(*p, noise))


def _posterior(prior: Prior, score: Column, site: str = "") -> tuple[Column, Column, Column]:
    """Shares of the host and the path without the document itself, and its posterior.

    ``site`` is put in front of the names of the site's totals.
    """
    good, n, host_good, host_n = (F.col(site + c) for c in ("good", "n", "host_good", "host_n"))
    own = F.lit(1) / (F.lit(1) + F.exp(-score))
    host = (F.lit(prior.host * prior.mean) + host_good - own) / (
        F.lit(prior.host) + host_n - 1
    )
    path = (F.lit(prior.path) * host + good - own) / (F.lit(prior.path) + n - 1)
    path = F.least(F.greatest(path, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = score + F.log(path / (1 - path))
    return host, path, F.lit(1) / (F.lit(1) + F.exp(-odds))


def _scored(docs: DataFrame, model: Looks | None, host: str, path: str) -> DataFrame:
    named = docs.select(
        "doc_id", "text", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")
    )
    rows = add_evidence(named, model, "evidence")
    return rows.select("doc_id", "host", "path", "evidence.*")


def classify(
    docs: DataFrame, model: Looks | None, host: str = "source", path: str = "lang", keep: float = KEEP
) -> DataFrame:
    """(doc_id, host, path, evidence, host_share, path_share, posterior, kept) of documents."""
    rows = settle(_scored(docs, model, host, path))
    sites, prior = site_posteriors(rows)
    joined = rows.join(sites, same(rows, sites, ["host", "path"])).drop(sites["host"], sites["path"])
    of_host, of_path, posterior = _posterior(prior, F.col("score"))
    return joined.select(
        "doc_id",
        "host",
        "path",
        F.col("score").alias("evidence"),
        of_host.alias("host_share"),
        of_path.alias("path_share"),
        posterior.alias("posterior"),
        (F.col("words") & (posterior >= keep)).alias("kept"),
    )


def keep_good(
    docs: DataFrame, model: Looks | None, host: str = "source", path: str = "lang", keep: float = KEEP
) -> DataFrame:
    """``docs`` without the documents that ``classify`` does not keep.

    Whole texts meet one small row per site and are not shuffled, unless there are so many sites
    that these rows are too large to send to every task.
    """
    sites, prior = site_posteriors(settle(_scored(docs, model, host, path)))
    evidence, site = unused(docs, "evidence"), unused(docs, "site")
    rows = add_evidence(docs, model, evidence, keep=True)
    known = sites.select(F.struct(*sites.columns).alias(site))
    joined = rows.join(
        known,
        rows[host].cast("string").eqNullSafe(known[f"{site}.host"])
        & rows[path].cast("string").eqNullSafe(known[f"{site}.path"]),
    )
    _, _, posterior = _posterior(prior, F.col(f"{evidence}.score"), f"{site}.")
    return joined.where(F.col(f"{evidence}.words") & (posterior >= keep)).select(*docs.columns)


def with_site(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``, the first folder of the path, of an address."""
    folder = F.regexp_extract(F.parse_url(F.col(url), F.lit("PATH")), "^/([^/]*)", 1)
    return pages.withColumns({"host": F.parse_url(F.col(url), F.lit("HOST")), "path": folder})


def op1_classify_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's posterior; a source is a host and a language in it a path."""
    docs = table(spark, folder, "documents", "doc_id", "text", "source", "lang")
    return classify(docs, fit(docs, table(spark, folder, "labels", "doc_id", "quality")))
