"""Audit of interacting filters: what each removes in every order they may run in.

Every document is reduced to one bit per filter, and a part's documents to a tensor of
counts with one axis per filter (0 passes, 1 fails). What a filter does at a step of an
order is a contraction of that tensor: each axis is met with "passes", "fails" or "all".
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The measures of a cell: documents, good ones, toxic ones.
MEASURES = ("docs", "good", "toxic")

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT_DDL = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
_AUDIT = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [(c, pa.int64()) for c in COUNTS]
)

ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS ord FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT ord, step, substr(ord, step, 1) AS own, left(ord, step - 1) AS before FROM orders, range(1, 6) r(step)),
audit AS (SELECT part, ord, CAST(step AS INTEGER) AS step, own,
    sum(CASE WHEN translate(fails, before || own, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, ord AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM audit"""


def text_fails(text: Column) -> Column:
    """Bits of the filters that a text alone decides: A is 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    # one lambda over a one-element array names the words, so they are split once
    counts = F.element_at(
        F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("u"))), 1
    )
    few = counts["n"] < 200
    repeated = 100 * counts["u"] < 50 * counts["n"]
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    shouted = 100 * upper.cast("long") > 3 * F.length(text).cast("long")
    bits = [few, repeated, shouted, text.rlike(r"[#$%&*|]")]
    return sum((F.when(b, F.lit(1 << k)).otherwise(F.lit(0)) for k, b in enumerate(bits)), F.lit(0))


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, digest, part, bits, good, toxic, m): m rows that agree in all of these."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_fails(text).alias("bits"),
    )
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    )
    joined = rows.join(marks, "doc_id", "left").select(
        *rows.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    )
    # The join has dealt the rows by doc_id, so this needs no exchange.
    return joined.groupBy("doc_id", "digest", "part", "bits", "good", "toxic").agg(F.count("*").alias("m"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, docs, good, toxic``: counts per part and combination of failed filters.

    ``cell`` has the bit ``1 << k`` for the k-th of :data:`FILTERS`. Of equal texts, all
    rows but those of the smallest doc_id fail E. Copies are reduced to one row per text,
    part and label pair before they are shuffled, so no group of copies meets in a task.
    """
    where = ["digest", "part", "bits", "good", "toxic"]
    known = F.col("doc_id").isNotNull()
    kinds = _marked(docs, labels).groupBy(*where).agg(
        F.sum("m").alias("rows"),
        F.sum(F.when(~known, F.col("m")).otherwise(0)).alias("unnamed"),
        F.min(F.when(known, F.struct("doc_id", "m"))).alias("first"),
    )
    # A text has a kind per part and pair of labels, a few rows.
    kind = F.struct("part", "good", "toxic", "rows", "unnamed", "first")
    texts = kinds.groupBy("digest", "bits").agg(
        F.collect_list(kind).alias("kinds"), F.min("first.doc_id").alias("smallest")
    )
    split = texts.select("bits", "smallest", F.inline("kinds"))
    own = F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.m")).otherwise(F.lit(0))
    passing = F.col("unnamed") + F.coalesce(own, F.lit(0))
    late = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("bits").alias("cell"), passing.alias("n")),
        F.struct((F.col("bits") + late).alias("cell"), (F.col("rows") - passing).alias("n")),
    )
    rows = split.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return rows.groupBy("part", "cell").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def _vectors(letters: str) -> tuple[list[str], dict[str, np.ndarray]]:
    """Orders, and per contraction what each of (order, step) takes along each axis."""
    orders = ["".join(p) for p in permutations(letters)]
    k = len(letters)
    taken = {name: np.empty((len(orders) * k, k, 2), dtype=np.int64) for name in ("kept", "removed", "failing", "alone")}
    for i, order in enumerate(orders):
        for step, own in enumerate(order):
            row = i * k + step
            for axis, letter in enumerate(letters):
                before = letter in order[:step]
                taken["kept"][row, axis] = PASS if before or letter == own else ALL
                taken["removed"][row, axis] = FAIL if letter == own else PASS if before else ALL
                taken["failing"][row, axis] = FAIL if letter == own else ALL
                taken["alone"][row, axis] = FAIL if letter == own else PASS
    return orders, taken


def _contract(tensor: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """The tensor met with one vector along each axis, for every row of ``taken``."""
    axes = tensor.ndim
    arguments = [tensor, list(range(axes))]
    for axis in range(axes):
        arguments += [taken[:, axis], [axes, axis]]
    return np.einsum(*arguments, [axes])


def audit_tensors(part: str, tensors: dict[str, np.ndarray], letters: str = FILTERS) -> dict[str, list | np.ndarray]:
    """The audit's columns of one part from its tensors of documents, good and toxic ones."""
    orders, taken = _vectors(letters)
    k = len(letters)
    docs = tensors["docs"]
    removed = _contract(docs, taken["removed"])
    own = np.array([letters.index(c) for order in orders for c in order])
    total = np.bincount(own, weights=removed, minlength=k).astype(np.int64)
    if len(removed) and removed.max(initial=0) > (1 << 52) // len(removed):
        total = np.array([int(removed[own == i].sum()) for i in range(k)], dtype=np.int64)
    return {
        "part": [part] * len(own),
        "filter_order": [order for order in orders for _ in order],
        "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)),
        "kept": _contract(docs, taken["kept"]),
        "removed": removed,
        "redundant": _contract(docs, taken["failing"]) - removed,
        "unique_fails": _contract(docs, taken["alone"]),
        "good_lost": _contract(tensors["good"], taken["removed"]),
        "toxic_lost": _contract(tensors["toxic"], taken["removed"]),
        "shapley": total[own],
    }


def _tensor(cell: np.ndarray, counts: np.ndarray, axes: int = len(FILTERS)) -> np.ndarray:
    flat = np.zeros(1 << axes, dtype=np.int64)
    flat[cell] = counts
    # the first filter is the lowest bit, so its axis comes last in C order
    return flat.reshape((2,) * axes).transpose()


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part in, its 600 rows out."""
    for batch in batches:
        names = batch["part"].to_pylist()
        for name, row in zip(names, batch["cells"].to_pylist()):
            cell = np.array([c["cell"] for c in row], dtype=np.int64)
            tensors = {m: _tensor(cell, np.array([c[m] for c in row], dtype=np.int64)) for m in MEASURES}
            yield pa.RecordBatch.from_pydict(audit_tensors(name, tensors), schema=_AUDIT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with counts of the part's documents.

    A document fails A with fewer than 200 words, B if less than half of its words are
    distinct, C if more than 3 % of its characters are A-Z, D with any of ``#$%&*|``, and
    E if a row with a smaller doc_id has the same text. Parts are the values of ``lang``.
    ``kept`` is what remains after the step, ``removed`` what it takes, ``redundant`` what
    fails its filter but is gone already, ``unique_fails`` what fails no other filter,
    ``good_lost`` and ``toxic_lost`` what it takes of documents labelled so, and
    ``shapley`` what the filter removes, summed over all orders.

    Null text counts as empty, null lang as the empty string. Rows without doc_id never
    fail E and have no labels. Rows that repeat a doc_id each count; those of the smallest
    doc_id of a text pass E. Several labels of a document count as 1 if any is 1; null
    labels as none. Texts are equal when their SHA-256 is. Texts of any length count
    whole. Without documents there are no rows; other columns are ignored.
    """
    listed = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("cell", *MEASURES)).alias("cells"))
    return listed.mapInArrow(_audit, AUDIT_DDL)
