"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.common import staged, texts

#: Labelled rows that the lexicon is learned from and that EM knows labels of, at most.
SAMPLE_ROWS = 16_000
#: Groups of documents with the same votes, label and signs that the classifier is fitted on, at most.
GROUPS = 40_000
#: Entries of the learned lexicon, at most, and labelled toxic documents an entry needs;
#: with few labels one in PER_SUPPORT toxic documents, but two.
LEXICON, SUPPORT, PER_SUPPORT = 4096, 5, 25
#: Times more frequent in toxic documents than in others (smoothed) for an entry.
LIFT = 12.0
THRESHOLD = 0.7
#: False alarms that a missed toxic document outweighs; moves the scores, not their order.
MISS_COST = 4.0

# Common English insults, for the first voter.
INSULTS = (
    "bastard clown creep crap damn disgusting dumb fool freak garbage hate idiot idiotic jerk kill "
    "liar loser lunatic moron moronic pathetic pig psycho racist retard scum scumbag shit shut slut "
    "stupid sucks trash ugly vermin whore worthless"
).split()

_STRIP = ".,;:!?\"'()[]{}<>*#%&$|-_=/\\"
_STEMS = (4, 5, 6, 7, 8)
_SECOND_PERSON = re.compile(r"\b(?:you|you're|u|your)(?: are| r)? (?:a |an |so |such )?([a-z]+)")
_MASKED = re.compile(r"\b[a-z][*#@$]{2,}[a-z]?\b")


def words_in(text: str) -> set[str]:
    """Distinct words in lower case, without marks around them."""
    return {w.strip(_STRIP) for w in set(text.lower().split())} - {""}


def features_of(word: str) -> list[str]:
    """A word and its stems; stems end with a star."""
    return [word, *(word[:k] + "*" for k in _STEMS if len(word) >= k)]


def signature(words: set[str]) -> int:
    """The same for copies and for most near copies: a hash of the words with the lowest hashes."""
    low = sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)[:4]
    return (zlib.crc32(repr(low).encode()) >> 1) << 32 | (low[0] if low else 0)


class _Known(dict):
    """word -> numbers of the lexicon entries that it or a stem of it matches."""

    def __init__(self, lexicon: dict[str, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        found = tuple(self.lexicon[f] for f in features_of(word) if f in self.lexicon)
        self[word] = found
        return found


# Voters: 1 votes toxic, 0 clean, 2 abstains.
_GROUPS = 2  # the learned lexicon is dealt by kind of entry and hash over several voters
LEXICON_VOTERS = [f"{kind}_{k}" for kind in ("word", *(f"stem{n}" for n in _STEMS)) for k in range(_GROUPS)]
VOTERS = ["insults", *LEXICON_VOTERS, "several", "second_person", "masked", "shouting", "long_and_none"]


def _voter_of(entry: str) -> int:
    kind = _STEMS.index(len(entry) - 1) + 1 if entry.endswith("*") else 0
    return kind * _GROUPS + zlib.crc32(entry.encode()) % _GROUPS


def votes(text: str, words: set[str], found: list[tuple[int, ...]], voter_of: list[int]) -> str:
    """One character per voter; ``found`` has the lexicon entries of each word that has some."""
    insulted = not words.isdisjoint(INSULTS)
    lexical = {voter_of[h] for hits in found for h in hits}
    caps = sum(w.isupper() and len(w) > 2 for w in words_in_case(text)) if "!" in text else 0
    lowered = text.lower()
    person = any(w in _INSULT_SET for w in _SECOND_PERSON.findall(lowered)) if "you" in lowered else False
    out = ["1" if insulted else "2"]
    out += ["1" if k in lexical else "2" for k in range(len(LEXICON_VOTERS))]
    out.append("1" if len(found) >= 3 else ("0" if not found and not insulted else "2"))
    out.append("1" if person else "2")
    out.append("1" if _MASKED.search(lowered) else "2")
    out.append("1" if caps >= 3 and insulted else "2")
    out.append("0" if len(text) > 400 and not found and not insulted else "2")
    return "".join(out)


_INSULT_SET = frozenset(INSULTS)
_INSULT_AT = {w: k for k, w in enumerate(INSULTS)}


def signs_of(words: set[str], known: _Known, first: int) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """Lexicon entries of the words that have some, and the same with fixed insults numbered from ``first``."""
    found = {known[w] for w in words} - {()}
    insults = words & _INSULT_SET
    if not insults:
        return sorted(found), sorted(found)
    signs = {known[w] for w in words - insults} - {()}
    signs |= {(*known[w], first + _INSULT_AT[w]) for w in insults}
    return sorted(found), sorted(signs)


def vote_features(pattern: str, first: int) -> list[int]:
    """Feature numbers of the votes given, two for each voter, from ``first`` on."""
    return [first + 2 * j + (v == "1") for j, v in enumerate(pattern) if v != "2"]


def words_in_case(text: str) -> set[str]:
    return {w.strip(_STRIP) for w in set(text.split())}


# --- label model -------------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """Naive Bayes over votes, each voter's say reduced by its correlations with others."""

    prior: float
    rates: np.ndarray  # voter x class x vote
    say: np.ndarray  # weight of each voter
    correlation: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        v = _matrix(patterns)
        score = np.full(len(v), np.log(self.prior / (1 - self.prior)))
        logs = np.log(self.rates)
        for j in range(v.shape[1]):
            score += self.say[j] * (logs[j, 1, v[:, j]] - logs[j, 0, v[:, j]])
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))

    def accuracy(self) -> np.ndarray:
        """Estimated share of right votes among those given, for each voter."""
        right = self.rates[:, 1, 1] * self.prior + self.rates[:, 0, 0] * (1 - self.prior)
        given = right + self.rates[:, 1, 0] * self.prior + self.rates[:, 0, 1] * (1 - self.prior)
        return right / given


def _matrix(patterns: list[str]) -> np.ndarray:
    width = len(VOTERS)
    return np.frombuffer("".join(patterns).encode(), dtype=np.uint8).reshape(-1, width) - 48


def _correlation(fired: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Correlations of the voters' votes over weighted rows, 0 with themselves."""
    total = max(weight.sum(), 1.0)
    centred = fired - (weight @ fired) / total
    cov = (centred * weight[:, None]).T @ centred / total
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
    out = cov / sd[:, None] / sd[None, :]
    np.fill_diagonal(out, 0)
    return out


def fit_label_model(counts: list[tuple[str, int | None, int]], rounds: int = 60, gold: float = 0.99) -> LabelModel:
    """EM over (vote pattern, label or None, rows); labels are one more voter, ``gold`` reliable.

    Deterministic: it begins from the majority of the votes. Correlations of votes
    given the class are taken from the posterior and reduce the say of voters that
    repeat each other: 1 / (1 + the sum of their positive correlations).
    """
    if not counts:
        counts = [("2" * len(VOTERS), None, 1)]
    counts = sorted(counts, key=lambda c: (c[0], -1 if c[1] is None else c[1]))
    patterns = [c[0] for c in counts]
    v, weight = _matrix(patterns), np.array([c[2] for c in counts], float)
    label = np.array([-1 if c[1] is None else c[1] for c in counts])
    known = np.where(label == 1, np.log(gold / (1 - gold)), np.where(label == 0, -np.log(gold / (1 - gold)), 0.0))
    onehot = np.stack([(v == k) for k in range(3)], axis=2).astype(float)  # rows x voters x vote
    fired = onehot[:, :, 1] - onehot[:, :, 0]
    # near copies of a voter count as one from the start, or they would outvote the rest
    copies = np.clip((_correlation(fired, weight) - 0.7) / 0.3, 0, 1)
    say, model = 1 / (1 + copies.sum(axis=1)), None
    p = np.clip(0.5 + 0.2 * (fired @ say), 0.02, 0.98)
    p = np.where(label >= 0, np.where(label == 1, gold, 1 - gold), p)
    for step in range(rounds):
        pos, neg = weight * p, weight * (1 - p)
        rates = np.stack([np.tensordot(w, onehot, 1) + 0.5 for w in (neg, pos)], axis=1)
        rates /= rates.sum(axis=2, keepdims=True)
        prior = float(np.clip(pos.sum() / weight.sum(), 1e-4, 1 - 1e-4))
        corr = copies
        if step >= 3:
            corr = np.maximum(corr, np.maximum(_correlation(fired, neg), _correlation(fired, pos)))
            say = 1 / (1 + np.clip(corr, 0, 1).sum(axis=1))
        model = LabelModel(prior, rates, say, corr)
        q = model.posterior(patterns)
        new = 1 / (1 + np.exp(-np.clip(np.log(q / (1 - q)) + known, -30, 30)))
        if np.abs(new - p).max() < 1e-6 and step > 4:
            break
        p = new
    return model


def calibration(log_odds: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the votes' log odds that fit labels best, drawn to 1 and 0.

    Correlated voters have a reduced say, so their log odds are right in order but too
    small. The pull counts as little as one document, so without labels nothing changes.
    """
    x = np.stack([log_odds, np.ones(len(log_odds))], axis=1)
    at = start = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (weight * (p - toxic)) + (at - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        at = np.clip(at - np.clip(np.linalg.solve(curve, grad), -0.5, 0.5), [0.2, -5.0], [5.0, 5.0])
    return float(at[0]), float(at[1])


def soft_labels(model: LabelModel, patterns: list[str], toxic: list[int | None], count: np.ndarray,
                gold: float = 0.99) -> np.ndarray:
    """Posterior of each group from its votes, and from its label where it has one.

    A label is one more voter, ``gold`` reliable as in EM: votes that say more than
    it does can outvote it. Groups without a label have the votes' posterior.
    """
    if not patterns:
        return np.zeros(0)
    q = np.clip(model.posterior(patterns), 1e-9, 1 - 1e-9)
    odds = np.log(q / (1 - q))
    known = np.array([y is not None for y in toxic])
    label = np.array([float(bool(y) and y > 0) for y in toxic])
    slope, shift = calibration(odds[known], label[known], count[known])
    sure = np.log(gold / (1 - gold))
    odds = slope * odds + shift + np.where(known, np.where(label > 0, sure, -sure), 0.0)
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


# --- classifier --------------------------------------------------------------


def word_rows(rows: list[list], voted: list[list[int]], target: np.ndarray,
              count: np.ndarray) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Each group's signs and votes, and beside it the signs of each of its words alone.

    Signs of toxicity come together in most toxic documents, so whole documents alone
    would leave each sign with a part of the evidence; one sign has to do by itself.
    """
    out, labels, weights = [], [], []
    for found, given, y, n in zip(rows, voted, target, count):
        out.append(sorted({h for hits in found for h in hits} | set(given)))
        labels.append(y)
        weights.append(float(n))
        if len(found) > 1:
            out += [list(hits) for hits in found]
            labels += [y] * len(found)
            weights += [n / len(found)] * len(found)
    return out, np.array(labels), np.array(weights)


def fit_linear(rows: list[list[int]], target: np.ndarray, width: int, weight: np.ndarray | None = None,
               steps: int = 400, ridge: float = 2e-5):
    """Logistic regression on sets of feature numbers and soft labels (Adam, fixed steps)."""
    weight = np.ones(len(rows)) if weight is None else weight
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    cols = np.concatenate([np.array(r, dtype=np.int64) for r in rows]) if lengths.sum() else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    w = np.zeros(width + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    n = max(1.0, weight.sum())
    for t in range(1, steps + 1):
        z = np.bincount(owner, w[cols], len(rows)) + w[-1]
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        grad = np.append(np.bincount(cols, err[owner], width), err.sum()) / n
        grad[:-1] += ridge * w[:-1]
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, int]
    weights: np.ndarray  # lexicon entries, then fixed insults, then two for each voter
    bias: float
    labels: LabelModel

    def scores(self, batch: pd.Series) -> np.ndarray:
        known = _Known(self.lexicon)
        voter_of = _voters_of(self.lexicon)
        width = len(self.lexicon)
        out = np.empty(len(batch))
        for i, text in enumerate(batch):
            words = words_in(text or "")
            found, signs = signs_of(words, known, width)
            hits = {h for each in signs for h in each}
            hits.update(vote_features(votes(text or "", words, found, voter_of), width + len(INSULTS)))
            out[i] = self.bias + (self.weights[sorted(hits)].sum() if hits else 0.0)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    def score(self, text: Column) -> Column:
        """Column with the probability that a text is toxic; null counts as empty."""
        model = self

        @F.pandas_udf("double")
        def toxicity_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(model.scores(batch))

        return toxicity_score(F.coalesce(text.cast("string"), F.lit("")))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _signature(text: Column) -> Column:
    # declared here, not with the module: executors import it without a session
    @F.pandas_udf("long")
    def text_signature(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: signature(words_in(t))).astype("int64")

    return text_signature(text)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()

    def flush():
        keys = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
             pa.array([clean[k] for k in keys], pa.int64())], names=["entry", "in_toxic", "in_clean"])

    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            (toxic if label else clean).update({f for w in words_in(text) for f in features_of(w)})
        if len(toxic) + len(clean) > 400_000:
            yield flush()
            toxic.clear()
            clean.clear()
    yield flush()


def _voters_of(lexicon: dict[str, int]) -> list[int]:
    return [_voter_of(e) for e in sorted(lexicon, key=lexicon.get)]


def _evidence(batches: Iterator[pa.RecordBatch], lexicon: dict[str, int]) -> Iterator[pa.RecordBatch]:
    known = _Known(lexicon)
    voter_of = _voters_of(lexicon)
    for batch in batches:
        patterns, features = [], []
        for text in batch["text"].to_pylist():
            words = words_in(text)
            found, signs = signs_of(words, known, len(lexicon))
            patterns.append(votes(text, words, found, voter_of))
            features.append(signs)
        yield pa.RecordBatch.from_arrays(
            [batch["toxic"], pa.array(patterns, pa.string()), pa.array(features, pa.list_(pa.list_(pa.int32())))],
            names=["toxic", "votes", "features"],
        )


def _groups(evidence: DataFrame, most: int) -> tuple[list, np.ndarray]:
    """Rows with the same votes, label and signs as one, with their numbers.

    Beyond ``most`` groups the largest are taken, of the smallest size taken those with
    the lowest hash; these stand for the documents of the groups left out.
    """
    grouped = evidence.groupBy("votes", "toxic", "features").agg(F.count("*").alias("n"))
    key = F.xxhash64("votes", "toxic", "features")
    rows = grouped.orderBy(F.desc("n"), key, "votes", "toxic", "features").limit(most).collect()
    n = np.array([r["n"] for r in rows], float)
    if len(rows) == most and most:
        last = n == n[-1]
        n[last] *= 1 + max(0.0, evidence.count() - n.sum()) / n[last].sum()
    order = sorted(range(len(rows)), key=lambda k: (rows[k]["votes"], repr(rows[k]["toxic"]), rows[k]["features"]))
    return [rows[k] for k in order], n[order]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, support: int = SUPPORT,
        groups: int = GROUPS, entries_most: int = LEXICON) -> ToxicityModel:
    """Fit voters, label model and classifier.

    Labels come only from rows that :func:`held_out` leaves, at most ``sample_rows`` of
    them (the lowest by a hash of the identifier); the learned lexicon uses these. The
    label model and the classifier use every document that is not held out, labelled or
    not: rows are counted per vote pattern for the one, and per votes, label and signs
    for the other, which learns the posteriors of at most ``groups`` groups. The lexicon
    has at most ``entries_most`` entries.

    Null labels are skipped, several labels of one document count as toxic if one is;
    without labels the lexicon stays empty and the fixed voters alone say what is toxic.
    """
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = texts(docs).where(~held_out(F.col("doc_id")))
    small = F.broadcast(sample)  # at most sample_rows rows of 12 bytes
    # copies of a toxic document would make signs of its rare words: one of them counts
    counted = (
        rows.join(small, "doc_id")
        .select("text", "toxic", _signature(F.col("text")).alias("signature"))
        .dropDuplicates(["signature", "toxic"])
        .select("text", "toxic")
        .mapInArrow(_entries, "entry string, in_toxic long, in_clean long")
        .groupBy("entry")
        .agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
    )
    base = sample.agg(F.sum("toxic"), F.count("*")).first()
    positive, negative = float(base[0] or 0), float((base[1] or 0) - (base[0] or 0))
    support = min(support, max(2, int(positive // PER_SUPPORT)))
    lift = ((F.col("in_toxic") + 0.5) / (positive + 1)) / ((F.col("in_clean") + 0.5) / (negative + 1))
    entries = (
        counted.where((F.col("in_toxic") >= support) & (lift >= LIFT))
        .orderBy(F.desc("in_toxic"), "in_clean", "entry")
        .limit(entries_most)
        .collect()
    )
    lexicon = {r["entry"]: k for k, r in enumerate(entries)}
    evidence = staged(
        rows.join(small, "doc_id", "left")
        .select("text", "toxic")
        .mapInArrow(lambda it: _evidence(it, lexicon), "toxic int, votes string, features array<array<int>>"),
        "toxicity-evidence",
    )
    counts = [tuple(r) for r in evidence.groupBy("votes", "toxic").count().collect()]
    model = fit_label_model([(p, None if y is None else int(y > 0), n) for p, y, n in counts])
    shown, count = _groups(evidence, groups)
    width = len(lexicon) + len(INSULTS) + 2 * len(VOTERS)
    if positive and shown:
        target = soft_labels(model, [r["votes"] for r in shown], [r["toxic"] for r in shown], count)
        voted = [vote_features(r["votes"], len(lexicon) + len(INSULTS)) for r in shown]
        rows_of, soft, weight = word_rows([r["features"] for r in shown], voted, target, count)
        weights, bias = fit_linear(rows_of, soft, width, weight)
        # half the loss is about single words, which leaves whole documents too low; and
        # toxic documents are few, which draws all scores towards 0
        whole = [sorted({h for hits in r["features"] for h in hits} | set(v)) for r, v in zip(shown, voted)]
        known = np.array([r["toxic"] is not None for r in shown])
        if known.any():
            odds = np.array([bias + weights[hits].sum() for hits in whole])[known]
            marked = np.array([float((r["toxic"] or 0) > 0) for r in shown])[known]
            slope, shift = calibration(odds, marked, count[known] * np.where(marked > 0, MISS_COST, 1.0))
            weights, bias = slope * weights, slope * bias + shift
    else:
        # nothing labelled toxic, or no document to learn from: EM has no hold on which class is which, so insults count alike
        weights, bias = np.zeros(width), -3.0
        weights[len(lexicon) : len(lexicon) + len(INSULTS)] = 4.0
    return ToxicityModel(lexicon, weights, bias, model)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    One row per row of ``docs``; null text counts as empty and gets the score of a text
    without any sign; null doc_id is kept. The score depends on the text alone.
    """
    model = fit(docs, labels, **options)
    scored = texts(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns whose score is below ``threshold``."""
    model = fit(docs, labels, **options)
    return docs.where(model.score(F.col("text")) < threshold)
