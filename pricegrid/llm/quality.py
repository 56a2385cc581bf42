"""Quality by hierarchical empirical Bayes: document evidence with host and path posteriors."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.common import staged
from pricegrid.llm.toxicity import held_out

#: Labelled documents that the document classifier is fitted on, at most.
SAMPLE_ROWS = 12_000
THRESHOLD = 0.5
#: Pseudo-documents of a parent in a child's posterior: limits of the estimate.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 10_000.0

_WORD = re.compile(r"[^\W\d_]+")
_DOUBLED = re.compile(r"([^\w\s])\1")
SIGNS = ("log_words", "word_length", "distinct", "top_word", "repeats", "letters", "caps", "digits", "doubled",
         "pipes", "line_length", "line_repeats", "short_lines", "ends", "blank")


def signs(text: str) -> list[float]:
    """Numbers that describe how a whole text is written."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    if not n:
        return [0.0] * (len(SIGNS) - 1) + [1.0]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same = sum(map(str.__eq__, words[1:], words[:-1]))
    letters = sum(map(len, _WORD.findall(text)))
    lines = text.split("\n")
    ends = text.count(".") + text.count("!") + text.count("?")
    return [
        np.log1p(n),
        min(letters / n, 20.0),
        len(counts) / n**0.8,
        max(counts.values()) / n,
        same / n,
        letters / size,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        len(re.findall("[0-9]", text)) / size,
        min(len(_DOUBLED.findall(text)) / n, 1.0),
        text.count("|") / n,
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines),
        min(ends / n, 1.0),
        0.0,
    ]


def _basis(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Each sign as itself and as steps above its knots: curves, still linear to fit."""
    steps = (x[:, :, None] > knots[None, :, :]).reshape(len(x), -1)
    return np.hstack([x, steps, np.ones((len(x), 1))])


@dataclass(frozen=True)
class DocumentModel:
    mean: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray

    def evidence(self, texts: pd.Series) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        x = (np.array([signs(t or "") for t in texts]) - self.mean) / self.scale
        return np.clip(_basis(x, self.knots) @ self.weights, -12, 12)

    def column(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(model.evidence(batch))

        return evidence(F.coalesce(text.cast("string"), F.lit("")))


def fit_document_model(x: np.ndarray, y: np.ndarray, steps: int = 800, ridge: float = 1e-3) -> DocumentModel:
    """Logistic regression on standardised signs and their steps (Adam, fixed steps)."""
    if not len(x):
        x, y = np.zeros((1, len(SIGNS))), np.ones(1)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / scale
    knots = np.quantile(z, [0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.98], axis=0).T
    b = _basis(z, knots)
    w, m, s = np.zeros(b.shape[1]), np.zeros(b.shape[1]), np.zeros(b.shape[1])
    for t in range(1, steps + 1):
        grad = b.T @ (1 / (1 + np.exp(-np.clip(b @ w, -30, 30))) - y) / len(y) + ridge * w
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        w -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return DocumentModel(mean, scale, knots, w)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DocumentModel, float]:
    """Document classifier, and the share of good documents in its sample.

    Fitted on at most ``sample_rows`` labelled documents that are not held out (the
    lowest by a hash of the identifier). Null labels are skipped; of several labels of
    one document the lowest counts.
    """
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )

    @F.pandas_udf("array<double>")
    def described(text: pd.Series) -> pd.Series:
        return text.map(signs)

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(sample), "doc_id")  # at most sample_rows rows of 12 bytes
        .select("doc_id", "quality", described("text").alias("signs"))
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["signs"]))
    y = np.array([float(r["quality"] > 0) for r in rows])
    model = fit_document_model(np.array([r["signs"] for r in rows]), y)
    return model, float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))


def _strength(between: Column, mean: Column) -> Column:
    """Pseudo-documents from the spread of children's means: m(1-m)/variance - 1, within limits."""
    value = mean * (1 - mean) / F.greatest(between, F.lit(1e-9)) - 1
    return F.least(F.greatest(value, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Posterior share of good documents for every (host, path), from ``(host, path, p)``.

    Sums and counts are taken per path in the map tasks, so a host with a third of all
    rows reaches the shuffle as a row per task and path. A host's mean is drawn to the
    global one, a path's to its host's, each by a number of pseudo-documents that the
    spread of the means (less their sampling error) tells. The sums and strengths that
    :func:`without_own` needs come along.
    """
    paths = scored.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n"), F.sum(F.col("p") * F.col("p")).alias("ss"))
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"), F.sum("ss").alias("hss"))
    noise = (F.col("hss") / F.col("hn") - (F.col("hs") / F.col("hn")) ** 2) / F.col("hn")
    world = hosts.agg(
        (F.sum("hs") / F.sum("hn")).alias("g"),
        (F.sum(F.col("hs") ** 2 / F.col("hn")) / F.sum("hn") - (F.sum("hs") / F.sum("hn")) ** 2
         - F.sum(noise * F.col("hn")) / F.sum("hn")).alias("between"),
    )
    world = world.select(F.struct("g", _strength(F.col("between"), F.col("g")).alias("k")).alias("world"))
    top = hosts.withColumn("world", world.scalar())
    top = top.select(
        "host", "hs", "hn", "world", (F.col("hs") / F.col("hn")).alias("raw"),
        ((F.col("hs") + F.col("world.k") * F.col("world.g")) / (F.col("hn") + F.col("world.k"))).alias("host_mean"),
    )
    both = paths.join(top, "host")
    noise = (F.col("ss") / F.col("n") - (F.col("s") / F.col("n")) ** 2) / F.col("n")
    spread = both.agg(
        (F.sum(F.col("n") * ((F.col("s") / F.col("n") - F.col("raw")) ** 2 - noise)) / F.sum("n")).alias("between"),
        (F.sum("s") / F.sum("n")).alias("g"),
    )
    strength = spread.select(_strength(F.col("between"), F.col("g")).alias("k")).scalar()
    return both.withColumn("k", strength).select(
        "host", "path", "n", "s", "k", "hn", "hs", "world", "host_mean",
        ((F.col("s") + F.col("k") * F.col("host_mean")) / (F.col("n") + F.col("k"))).alias("path_mean"),
    )


def without_own(p: Column) -> Column:
    """The path's posterior as the other documents alone give it, beside a row's own ``p``.

    A document's evidence would else count twice, once by itself and once through its
    site, most of all on a site that has no other document. Only the global mean and
    the strengths still contain it.
    """
    host = (F.col("hs") - p + F.col("world.k") * F.col("world.g")) / (F.col("hn") - 1 + F.col("world.k"))
    return (F.col("s") - p + F.col("k") * host) / (F.col("n") - 1 + F.col("k"))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = THRESHOLD,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, host, path, score, site_score, keep, held_out`` of every document.

    The document's log odds are moved by the log odds of its path's posterior, as the
    site's other documents give it, against the classifier's prior: a text counts for less on a site that is otherwise poor,
    and a site with few documents says hardly more than the prior.

    One row per row of ``docs``. Null text counts as empty; null host or path are the
    empty name; null doc_id is kept. The score depends on labels only through the model.
    """
    model, prior = fit(docs, labels, sample_rows)
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        model.column(F.col("text")).alias("evidence"),
    )
    named = staged(named, "quality-evidence")
    scored = named.withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))
    sites = site_posteriors(scored)
    inside = F.least(F.greatest(F.col("site"), F.lit(1e-4)), F.lit(1 - 1e-4))
    total = F.col("evidence") + F.log(inside / (1 - inside)) - F.lit(float(np.log(prior / (1 - prior))))
    placed = scored.join(sites, ["host", "path"]).withColumn("site", without_own(F.col("p")))
    return placed.select(
        "doc_id",
        "host",
        "path",
        (1 / (1 + F.exp(-total))).alias("score"),
        F.col("site").alias("site_score"),
        (1 / (1 + F.exp(-total)) >= threshold).alias("keep"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
