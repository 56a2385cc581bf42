"""Benchmark decontamination: SimHash windows of an item's size, multi-index Hamming search.

A window of a document and an item are compared by the weighted Jaccard similarity of
their distinct five-word shingles. Candidates come from 64-bit SimHash fingerprints
within a Hamming radius; the index over blocks of bits returns every such pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import hashing
from pricegrid.llm.common import SHINGLE, SIMILARITY, signed, texts
from pricegrid.llm.hashing import shingle_hashes

#: Hamming radius, bits of a fingerprint, and blocks they are cut into.
RADIUS, BITS, BLOCKS = 19, 64, 5
#: Items that one pass over the documents is held against.
ITEMS_PER_PASS = 2_000
THRESHOLD = SIMILARITY[0] / SIMILARITY[1]

HITS = "doc_id long, item_id long, similarity double, first_word long, n_words long"
_TABLE_BITS = 22


def _block_bounds() -> list[tuple[int, int]]:
    cuts = [round(BITS * k / BLOCKS) for k in range(BLOCKS + 1)]
    return list(zip(cuts, cuts[1:]))


def _near(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``radius`` bits set."""
    out = [0]
    for r in range(1, radius + 1):
        out += [sum(1 << b for b in c) for c in combinations(range(width), r)]
    return np.array(out, dtype=np.uint64)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from sums of signed weights, one row each."""
    bits = np.packbits(sums > 0, axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).reshape(-1)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


@dataclass(frozen=True)
class Item:
    item_id: int | None
    shingles: np.ndarray  # sorted, distinct
    weight: float


@dataclass
class _SizeIndex:
    """Items of one number of words: fingerprints and their blocks."""

    size: int
    items: list[Item]
    prints: np.ndarray
    least: float  # shared weight below which no item of this size can be similar enough
    starts: list[np.ndarray] = field(default_factory=list)
    members: list[np.ndarray] = field(default_factory=list)

    def build(self) -> None:
        # At most RADIUS differing bits over BLOCKS blocks: one block has RADIUS // BLOCKS at most.
        for low, high in _block_bounds():
            width = high - low
            near = _near(width, RADIUS // BLOCKS)
            values = (self.prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
            keys = (values[:, None] ^ near[None, :]).ravel().astype(np.int64)
            owner = np.repeat(np.arange(len(self.prints), dtype=np.int32), len(near))
            order = np.argsort(keys, kind="stable")
            self.starts.append(np.searchsorted(keys[order], np.arange((1 << width) + 1)))
            self.members.append(owner[order])

    def within(self, fingerprint: np.uint64) -> np.ndarray:
        """Numbers of all items whose fingerprint is within the radius."""
        return self.pairs(np.array([fingerprint], dtype=np.uint64))[1]

    def pairs(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among ``prints`` and numbers of items within the radius, in ascending order.

        All fingerprints are looked up in a block together; a pair may turn up in several blocks.
        """
        found = []
        for (low, high), starts, members in zip(_block_bounds(), self.starts, self.members):
            v = ((prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)
            first, count = starts[v], starts[v + 1] - starts[v]
            skipped = np.cumsum(count) - count
            place = np.repeat(np.arange(len(prints)), count)
            item = members[np.arange(len(place)) + np.repeat(first - skipped, count)]
            near = _popcount(self.prints[item] ^ prints[place]) <= RADIUS
            found.append(place[near] * len(self.prints) + item[near])
        return np.divmod(np.unique(np.concatenate(found)), len(self.prints))


@dataclass(frozen=True)
class Weights:
    """Weights of shingles over the whole benchmark, whatever pass an item is in.

    A shingle's weight is log(1 + items / items that hold it), so phrases that many
    items share say less; shingles of no item weigh as those of one. Only shingles of
    two items or more are listed.
    """

    items: int
    shared: np.ndarray  # sorted
    held: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes))
        if len(self.shared):
            at = np.minimum(np.searchsorted(self.shared, hashes), len(self.shared) - 1)
            known = self.shared[at] == hashes
            held[known] = self.held[at[known]]
        return np.log1p(max(1, self.items) / held)


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's distinct shingles, and a null for the item itself."""
    for batch in batches:
        for words in hashing.rows(batch):
            if len(words):
                distinct = signed(np.unique(shingle_hashes(words)))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(distinct, pa.int64()), pa.nulls(1, pa.int64())])], names=["shingle"]
                )


def benchmark_weights(benchmark: DataFrame) -> Weights:
    """One aggregate over all items; what comes to the driver are the shingles of several items."""
    items = benchmark.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = items.mapInArrow(_item_shingles, "shingle long").groupBy("shingle").agg(F.count("*").alias("held"))
    found = counted.where("shingle IS NULL OR held > 1").toArrow()
    total = found.filter(pa.compute.is_null(found["shingle"]))["held"].to_pylist()
    shared = found.filter(pa.compute.is_valid(found["shingle"]))
    names = shared["shingle"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(names)
    return Weights(sum(total), names[order], shared["held"].to_numpy().astype(np.int64)[order])


class ItemIndex:
    """Fingerprints and shingles of one pass's items, with the weights of all items."""

    def __init__(self, rows: list[tuple[int | None, str | None]], weights: Weights, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.weights = weights
        batch = pa.record_batch([pa.array([t or "" for _, t in rows], pa.string())], names=["text"])
        split = [(i, w, shingle_hashes(w)) for (i, _), w in zip(rows, hashing.rows(batch)) if len(w)]
        every = np.concatenate([np.unique(s) for _, _, s in split]) if split else np.zeros(0, np.uint64)
        self.shingles = np.unique(every)
        self.spans = sorted({min(SHINGLE, len(w)) for _, w, _ in split})
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.shingles >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        by_size: dict[int, list] = {}
        for i, w, s in split:
            distinct = np.unique(s)
            by_size.setdefault(len(w), []).append((Item(i, distinct, float(self.weight(distinct).sum())), s))
        self.sizes = []
        for size, group in sorted(by_size.items()):
            prints = _packed(np.stack([(_signs(s) * self.weight(s)[:, None]).sum(0) for _, s in group]))
            least = self.threshold * min(item.weight for item, _ in group)
            index = _SizeIndex(size, [item for item, _ in group], prints, least)
            index.build()
            self.sizes.append(index)

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        return self.weights.of(hashes)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are shingles of an item."""
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        out = np.zeros(len(hashes), dtype=bool)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.shingles, hashes[maybe]), len(self.shingles) - 1)
            out[maybe] = self.shingles[at] == hashes[maybe]
        return out

    def hits(self, words: np.ndarray) -> list[tuple[int | None, float, int, int]]:
        """(item, similarity, first word, words) of the best window for each similar item.

        Every window of as many words as an item is looked at (the whole text where it
        is shorter), but one that shares less weight with all items together than any
        item of its size needs gets no fingerprint: it can't be similar enough.
        """
        best: dict[int | None, tuple[float, int, int]] = {}
        for span in self.spans:
            if len(words) < span:
                continue
            s = shingle_hashes(words, span)
            known = self.known(s)
            if not known.any():
                continue
            self._windows(s, known, span, len(words), best)
        return [(i, *v) for i, v in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))]

    def _windows(self, s, known, span, n_words, best) -> None:
        # most texts share a phrase or two with some item, which is not enough for any
        own = self.weight(s[known])
        total = float(own.sum()) + 1e-9
        sizes = [i for i in self.sizes if min(i.size, SHINGLE) == span and i.least <= total]
        if not sizes:
            return
        weight = self.weight(s)
        shared = np.concatenate([[0.0], np.cumsum(np.where(known, weight, 0.0))])
        for index in sizes:
            width = min(index.size, n_words) - span + 1  # shingles of a window
            starts = np.flatnonzero(shared[width:] - shared[:-width] >= index.least - 1e-9)
            # windows are worked on in pieces, so a text full of passages needs no more memory
            for k in range(0, len(starts), 256):
                self._compare(s, weight, starts[k : k + 256], width, index, span, best)

    def _compare(self, s, weight, starts, width, index, span, best) -> None:
        at = starts[:, None] + np.arange(width)[None, :]
        uniq, inverse = np.unique(at, return_inverse=True)
        votes = _signs(s[uniq]) * weight[uniq][:, None].astype(np.float32)
        prints = _packed(votes[inverse.reshape(at.shape)].sum(axis=1))
        last = None
        for place, k in zip(*(x.tolist() for x in index.pairs(prints))):
            start, item = starts[place], index.items[k]
            if place != last:
                last, window = place, np.unique(s[start : start + width])
                own = float(self.weight(window).sum())
            both = np.intersect1d(window, item.shingles, assume_unique=True)
            shared = float(self.weight(both).sum())
            value = shared / (own + item.weight - shared)
            if value >= self.threshold - 1e-12 and (
                item.item_id not in best or value > best[item.item_id][0] + 1e-12
            ):
                best[item.item_id] = (value, int(start), int(width + span - 1))


def _item_passes(benchmark: DataFrame, per_pass: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in groups of bounded size; the driver holds one group at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    group = []
    for r in rows.toLocalIterator():
        group.append((r[0], r[1]))
        if len(group) == per_pass:
            yield group
            group = []
    if group:
        yield group


def _scan(batches: Iterator[pa.RecordBatch], index: ItemIndex) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, words in zip(batch["doc_id"].to_pylist(), hashing.rows(batch)):
            rows += [(doc_id, *hit) for hit in index.hits(words)]
        if rows:
            ids, items, similarity, first, words = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(similarity, pa.float64()),
                 pa.array(first, pa.int64()), pa.array(words, pa.int64())],
                names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
            )


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """Pairs of a document and an item that one of its windows repeats.

    ``doc_id, item_id, similarity, first_word, n_words`` with the best window (the
    first of equal ones). Items are the query set: they are taken in groups of
    ``per_pass``, each held against all documents in one scan without a shuffle, so
    the index that goes to the tasks has a fixed bound, but for the shingles of two
    items or more: their weights count all items, so results don't depend on the
    groups, and go with each pass (16 bytes each). Two texts as similar as the
    threshold have fingerprints further apart than the radius about once in 250
    pairs; equal ones never.

    Null or empty texts, of documents or items, match nothing; items of fewer than
    five words count as one shingle, and match it anywhere. Null identifiers are
    kept. Rows of the same item_id count as one item with several texts; repeated
    documents give repeated rows. Other columns are ignored.
    """
    found = None
    weights = benchmark_weights(benchmark)
    for group in _item_passes(benchmark, per_pass):
        index = ItemIndex(group, weights, threshold)
        part = texts(docs).mapInArrow(lambda it, index=index: _scan(it, index), HITS)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], HITS)
    return found


def _contamination(index: ItemIndex, text: Column) -> Column:
    @F.pandas_udf("boolean")
    def repeats_an_item(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            column = pa.record_batch([pa.array(batch, pa.string())], names=["text"])
            yield pd.Series([bool(index.hits(words)) for words in hashing.rows(column)], dtype=bool)

    return repeats_an_item(F.coalesce(text.cast("string"), F.lit("")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                         per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window repeats an item."""
    weights = benchmark_weights(benchmark)
    for group in _item_passes(benchmark, per_pass):
        docs = docs.where(~_contamination(ItemIndex(group, weights, threshold), F.col("text")))
    return docs
