"""Importance resampling towards a target: bucket gains, noisy scores, radix-sorted ranks.

1. Texts are split into words, and a document's weight is the sum of the gains of its
   words' buckets, looked up in one array of a fixed size.
2. The rows with scores are ranked by a distributed LSD radix sort. A chunk holds at
   most ``CHUNK`` consecutive places. Each pass counts the digits of a chunk, and prefix
   sums over (digit, chunk) give each row its place: ahead of it are all smaller
   digits, equal digits of earlier chunks, and equal ones earlier in its chunk.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.session import staged, staged_while

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
SHARE = (10, 100)
#: Places in a chunk, and bits of a digit.
CHUNK = 1 << 16
DIGIT_BITS = 11
#: Distinct words whose buckets a task remembers.
REMEMBERED = 1 << 18

# Bytes that end a word become blanks, A-Z become a-z.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Buckets:
    """Buckets of words, looked up once per distinct word as long as there is room."""

    def __init__(self, count: int):
        self.count, self.known = count, {}

    def of(self, raw: bytes) -> list[int]:
        words = raw.translate(_TABLE).split(b" ")
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        known[b""] = -1
        out = []
        for w in words:
            bucket = known.get(w)
            if bucket is None:
                bucket = known[w] = zlib.crc32(w) % self.count
            out.append(bucket)
        return out


#: Bytes of a text that are split at a time; a word may be longer.
PIECE = 1 << 20


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    if len(raw) <= PIECE:
        yield raw
        return
    at = 0
    while at < len(raw):
        to = min(len(raw), at + PIECE)
        while to < len(raw) and _TABLE[raw[to]] != 32:
            to += 1
        yield raw[at:to]
        at = to


def _raw(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One task's features per bucket."""
    table, total = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for raw in _raw(batch["text"]):
            for piece in _pieces(raw):
                found = np.array(table.of(piece), dtype=np.int64)
                total += np.bincount(found[found >= 0], minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; an array of ``buckets`` numbers whatever the input."""
    text = rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    summed = text.mapInArrow(lambda it: _counts(it, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of a thousand times the log of how much likelier a bucket is in the target."""
    buckets = len(own)
    s_all, t_all = int(own.sum()), int(target.sum())
    out = []
    for s, t in zip(own.tolist(), target.tolist()):
        above, below = (t + 1.0) * (s_all + buckets), (s + 1.0) * (t_all + buckets)
        out.append(math.floor(1000 * math.log(above / below)))
    return np.array(out, dtype=np.int64)


_WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    table, padded = Buckets(len(gain)), np.append(gain, 0)  # -1 looks up the 0
    for batch in batches:
        features, weights = [], []
        for raw in _raw(batch["text"]):
            n = weight = 0
            for piece in _pieces(raw):
                found = np.array(table.of(piece), dtype=np.int64)
                n += int((found >= 0).sum())
                weight += int(padded[found].sum())
            features.append(n)
            weights.append(weight)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(features, pa.int64()), pa.array(weights, pa.int64())], schema=_WEIGHED)


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score`` of every row.

    The noise of a document is a Gumbel variable made from the SHA-256 of seed and
    doc_id, so it is the same wherever the row is computed.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    gain = gains(bucket_counts(rows, buckets), bucket_counts(target, buckets))
    weighed = rows.mapInArrow(lambda it: _weigh(it, gain), "doc_id long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


# --- distributed LSD radix sort ---------------------------------------------------


def _digit(high: np.ndarray, low: np.ndarray, shift: int, low_bits: int, bits: int) -> np.ndarray:
    """A digit of the composite key, whose low part has ``low_bits`` bits."""
    mask = np.uint64((1 << bits) - 1)
    part = low >> np.uint64(shift) if shift < low_bits else high >> np.uint64(shift - low_bits)
    return (part & mask).astype(np.uint16)


def _counting_sort(digit: np.ndarray) -> np.ndarray:
    """For each row, how many rows before it have its digit."""
    counts = np.bincount(digit)
    starts = np.cumsum(counts) - counts
    order = np.argsort(digit, kind="stable")  # a counting sort for 16-bit numbers
    out = np.empty(len(digit), dtype=np.int64)
    out[order] = np.arange(len(digit)) - starts[digit[order]]
    return out


_NUMBERED = "chunk long, high long, low long, id long, digit int, at long"


def _numbering(high_from: np.uint64, low_from: np.uint64, shift: int, low_bits: int, bits: int):
    """For a pass: a chunk's rows in their places, each with its digit and its number among equal ones."""

    def numbered(chunk: pa.Table) -> pa.Table:
        place = chunk["place"].to_numpy()
        order = np.empty(len(place), dtype=np.int64)
        order[place - place.min()] = np.arange(len(place))  # places are dense inside a chunk
        chunk = chunk.take(pa.array(order)).combine_chunks()
        # differences wrap around as 64-bit numbers do, which makes them unsigned
        high, low = (chunk[c].to_numpy().view(np.uint64) - least for c, least in (("high", high_from), ("low", low_from)))
        digit = _digit(high, low, shift, low_bits, bits)
        out = chunk.select(["chunk", "high", "low", "id"])
        out = out.append_column("digit", pa.array(digit.astype(np.int32)))
        return out.append_column("at", pa.array(_counting_sort(digit)))

    return numbered


def _offsets(numbered: DataFrame) -> DataFrame:
    """(chunk, digit, offset): the place of the first row of each digit of each chunk.

    The table has a row per chunk and digit, whatever the chunks hold. Sums inside a
    digit run in parallel; only one row per digit value is summed over all digits.
    """
    counts = numbered.groupBy("chunk", "digit").agg(F.count("*").alias("n"))
    running = Window.partitionBy("digit").orderBy("chunk")
    within = counts.select("chunk", "digit", (F.sum("n").over(running) - F.col("n")).alias("within"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2^DIGIT_BITS rows
    over = Window.partitionBy(F.lit(0)).orderBy("digit")
    base = totals.select("digit", (F.sum("n").over(over) - F.col("n")).alias("base"))
    return within.join(base, "digit").select("chunk", "digit", (F.col("base") + F.col("within")).alias("offset"))


def radix_ranks(rows: DataFrame, chunk: int = CHUNK, bits: int = DIGIT_BITS) -> DataFrame:
    """``id, rank`` of rows ``(high, low, id)``, ranked from 1 by ascending (high, low).

    ``high`` and ``low`` are longs of any sign. Equal rows get consecutive ranks. Every
    pass is one exchange of the keys, and at most ``chunk`` rows are worked on together.
    """
    spark = rows.sparkSession
    with ExitStack() as held:
        keys = held.enter_context(staged_while(rows.select("high", "low", "id"), "radix-keys"))
        ends = keys.agg(F.min("high"), F.max("high"), F.min("low"), F.max("low"), F.count("*")).first()
        if not ends[4]:
            return spark.createDataFrame([], "id long, rank long")
        high_from, low_from = (np.uint64(ends[k] % (1 << 64)) for k in (0, 2))
        low_bits = -(-(ends[3] - ends[2]).bit_length() // bits) * bits
        high_bits = (ends[1] - ends[0]).bit_length()
        # a task's rows are numbered in it; its chunks are those numbers' quotients
        number = F.monotonically_increasing_id()
        task, at = F.shiftright(number, 33), number.bitwiseAND(F.lit((1 << 33) - 1))
        per_task = -(-(1 << 33) // chunk)
        placed = keys.select("high", "low", "id", task.alias("task"), at.alias("place"))
        placed = placed.select(
            "high", "low", "id", (F.col("task") * per_task + F.expr(f"place div {chunk}")).alias("chunk"), "place"
        )
        for shift in range(0, max(1, low_bits + high_bits), bits):  # equal keys need a pass for their places

            numbering = _numbering(high_from, low_from, shift, low_bits, bits)
            numbered = placed.groupBy("chunk").applyInArrow(numbering, _NUMBERED)
            numbered = held.enter_context(staged_while(numbered, "radix-pass"))
            moved = numbered.join(_offsets(numbered), ["chunk", "digit"])
            moved = moved.select("high", "low", "id", (F.col("offset") + F.col("at")).alias("place"))
            placed = moved.select("high", "low", "id", F.expr(f"place div {chunk}").alias("chunk"), "place")
        return staged(placed.select("id", (F.col("place") + 1).alias("rank")), "radix-ranks")


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    share: tuple[int, int] = SHARE,
    chunk: int = CHUNK,
    bits: int = DIGIT_BITS,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; undrawn rows have no rank.

    Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z are lower-cased;
    a word's bucket is its CRC-32 modulo ``buckets``. Of the N rows with at least
    ``least_words`` words the ``share`` of N (rounded down) with the highest scores is
    drawn, smaller doc_id first among equal scores.

    Null text counts as empty: no features, weight 0, never drawn unless ``least_words``
    is 0. Null doc_id stays null, has the noise of the empty string and comes first among
    equal scores. Rows that repeat a doc_id with one score get consecutive ranks in any
    order. Very long texts are split in pieces. An empty table gives no rows; an empty
    target has no features, so frequent words weigh least. Other columns are ignored.
    """
    part, whole = share
    rows = scored(docs, target, buckets, seed).withColumn("id", F.monotonically_increasing_id())
    rows = staged(rows, "resample-scores")
    able = rows.where(F.col("n_features") >= least_words)
    drawn = able.count() * part // whole
    least = -(1 << 63)
    keys = able.select((-F.col("score")).alias("high"), F.coalesce("doc_id", F.lit(least)).alias("low"), "id")
    ranks = radix_ranks(keys, chunk, bits).where(F.col("rank") <= drawn)
    return rows.join(ranks, "id", "left").select("doc_id", "n_features", "weight", "score", "rank")
