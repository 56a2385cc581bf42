"""Second-order boosting on grouped histograms, and trees as a table.

Features are cut at quantiles once, so a row is a byte per feature. For every level of
a tree one job sums gradients and rows per (node, feature, bin): each task adds up its
own rows, and the sums of the tasks are grouped. The driver sees these sums only; their
number is bounded by nodes, features and bins, not by rows. A tree grows by levels, or
leaf by leaf in the order of gain; both take one job per level.

Rows keep the margin of the rounds before the last ``rebase_every``; it is written anew
after so many rounds, so a task applies few trees and a lost executor repeats little.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.plans.models import LABEL, input_columns, training_matrix
from pricegrid.session import staged_while

_EPS = 1e-6


@dataclass(frozen=True)
class Settings:
    """Learning parameters; the defaults are those of the first family.

    ``alpha`` and ``lam`` are the L1 and L2 terms, ``gamma`` the least gain of a split,
    ``min_child`` the least rows of a child. ``leaves`` bounds the leaves of a tree that
    grows leaf by leaf; without it trees grow by levels. ``patience`` rounds without a
    better validation error end the training, and the trees of the best round remain.
    """

    rounds: int = 500
    depth: int = 8
    rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_child: float = 3
    gamma: float = 0.1
    alpha: float = 0.1
    lam: float = 1.0
    leaves: int | None = None
    patience: int = 50
    metric: str = "rmse"
    bins: int = 64
    seed: int = 42
    rebase_every: int = 16


LEVEL_WISE = Settings()
LEAF_WISE = Settings(min_child=20, gamma=0.0, leaves=31, metric="mae")


@dataclass
class Tree:
    """Nodes numbered from 0; a split's children are ``left`` and ``left + 1``."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)
    order: list[int] = field(default_factory=list)

    def add(self, rows: float, value: float) -> int:
        for column, entry in zip(
            (self.feature, self.bin, self.left, self.value, self.gain, self.rows, self.order),
            (-1, 0, -1, value, 0.0, rows, -1),
        ):
            column.append(entry)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of a matrix of bins."""
        feature, cut, left = (np.array(c, dtype=np.int64) for c in (self.feature, self.bin, self.left))
        node = np.zeros(len(bins), dtype=np.int64)
        row = np.arange(len(bins))
        while len(row):
            at = node[row]
            inner = left[at] >= 0
            row, at = row[inner], at[inner]
            node[row] = left[at] + (bins[row, feature[at]] > cut[at])
        return node


@dataclass
class Model:
    """Names of the inputs, their cuts, the mean label, trees, and the error after each round."""

    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]
    errors: list[float]


# --- one pass over the rows -------------------------------------------------------

_ROWS = "bins binary, label double, val boolean, key long, margin double"
_SUMS = "node int, feature int, bin int, g double, h double"
_SUMS_ARROW = pa.schema(
    [("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("g", pa.float64()), ("h", pa.float64())]
)


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    column = batch["bins"].cast(pa.large_binary())
    start = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset]
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8, count=len(column) * features, offset=int(start))
    return raw.reshape(len(column), features)


def _margin(batch: pa.RecordBatch, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    out = batch["margin"].to_numpy(zero_copy_only=False).copy()
    for tree in trees:
        out += np.array(tree.value)[tree.leaf_of(bins)]
    return out


def _sampled(keys: np.ndarray, turn: int, share: float, seed: int) -> np.ndarray:
    """Whether a row takes part in a round: a hash of its key, the round and the seed."""
    x = keys.view(np.uint64) ^ np.uint64((turn * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(40)).astype(np.float64) < share * (1 << 24)


def _sums(
    batches: Iterator[pa.RecordBatch], trees: Sequence[Tree], tree: Tree, open_: Sequence[int],
    chosen: Sequence[int], features: int, turn: int, s: Settings,
) -> Iterator[pa.RecordBatch]:
    """A task's sums per (open node, chosen feature, bin); node -1 has the validation error."""
    slot = np.full(len(tree.feature), -1, dtype=np.int64)
    slot[list(open_)] = np.arange(len(open_))
    shape = (len(chosen), len(open_) * s.bins)
    g_all, h_all = np.zeros(shape), np.zeros(shape)
    off, rows = 0.0, 0
    for batch in batches:
        bins = _matrix(batch, features)
        error = _margin(batch, bins, trees) - batch["label"].to_numpy()
        val = batch["val"].to_numpy(zero_copy_only=False)
        off += float(np.abs(error[val]).sum() if s.metric == "mae" else (error[val] ** 2).sum())
        rows += int(val.sum())
        use = ~val & _sampled(batch["key"].to_numpy(), turn, s.row_share, s.seed)
        bins, g = bins[use], error[use]
        at = slot[tree.leaf_of(bins)]
        inside = at >= 0
        bins, g, at = bins[inside], g[inside], at[inside] * s.bins
        for k, f in enumerate(chosen):
            cell = at + bins[:, f]
            g_all[k] += np.bincount(cell, weights=g, minlength=shape[1])
            h_all[k] += np.bincount(cell, minlength=shape[1])
    k, cell = np.nonzero(h_all)
    node = np.array(open_, dtype=np.int32)[cell // s.bins]
    columns = [
        np.append(node, -1), np.append(np.array(chosen, dtype=np.int32)[k], 0), np.append(cell % s.bins, 0),
        np.append(g_all[k, cell], off), np.append(h_all[k, cell], rows),
    ]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUMS_ARROW)], schema=_SUMS_ARROW)


def _rebased(batches: Iterator[pa.RecordBatch], trees: Sequence[Tree], features: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        margin = pa.array(_margin(batch, _matrix(batch, features), trees))
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("bins", "label", "val", "key")), margin],
                                         names=["bins", "label", "val", "key", "margin"])


# --- splits -----------------------------------------------------------------------


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def _strength(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    return _shrunk(g, s.alpha) ** 2 / (h + s.lam)


def _weight(g: float, h: float, s: Settings) -> float:
    """The leaf value that lowers the regularised error most, times the learning rate."""
    return float(-_shrunk(np.float64(g), s.alpha) / (h + s.lam) * s.rate)


def best_split(g: np.ndarray, h: np.ndarray, cuts: Sequence[int], s: Settings):
    """(gain, feature, bin, left g, left h) of a node's best split, or None.

    ``g`` and ``h`` are (features, bins) sums; ``cuts`` how many cuts each feature has.
    Gains count to six decimals: of equal ones the first feature's lowest cut wins.
    """
    left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = _strength(left_g, left_h, s) + _strength(right_g, right_h, s) - _strength(all_g, all_h, s)
    able = (left_h >= s.min_child) & (right_h >= s.min_child) & (np.arange(g.shape[1]) < np.array(cuts)[:, None])
    gain = np.where(able, np.round(gain, 6), -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[f, b] > max(s.gamma, _EPS):
        return None
    return float(gain[f, b]), int(f), int(b), float(left_g[f, b]), float(left_h[f, b])


def _grow(sums_of, chosen: Sequence[int], cuts: Sequence[Sequence[float]], s: Settings) -> tuple[Tree, tuple[float, float]]:
    """A tree grown to its full depth, one call of ``sums_of`` per level, and the validation sums."""
    tree, open_, val = Tree(), [0], None
    tree.add(0.0, 0.0)
    counts = [len(cuts[f]) for f in chosen]
    for level in range(s.depth):
        node, feature, cell, g, h = sums_of(tree, open_)
        if val is None:
            val = (float(g[node < 0].sum()), float(h[node < 0].sum()))
        slot = {f: k for k, f in enumerate(chosen)}
        following = []
        for n in open_:
            own = node == n
            if not own.any():
                continue
            sums = np.zeros((2, len(chosen), s.bins))
            at = [slot[f] for f in feature[own].tolist()], cell[own]
            np.add.at(sums[0], at, g[own])
            np.add.at(sums[1], at, h[own])
            if level == 0:
                all_g, all_h = float(sums[0, 0].sum()), float(sums[1, 0].sum())
                tree.rows[0], tree.value[0] = all_h, _weight(all_g, all_h, s)
            split = best_split(sums[0], sums[1], counts, s)
            if split is None:
                continue
            tree.gain[n], f, tree.bin[n], left_g, left_h = split
            tree.feature[n] = chosen[f]
            all_g, all_h = float(sums[0, f].sum()), float(sums[1, f].sum())
            tree.left[n] = tree.add(left_h, _weight(left_g, left_h, s))
            tree.add(all_h - left_h, _weight(all_g - left_g, all_h - left_h, s))
            following += [tree.left[n], tree.left[n] + 1]
        open_ = following
        if not open_:
            break
    return tree, val or (0.0, 0.0)


def best_first(tree: Tree, leaves: int | None) -> Tree:
    """The splits a tree keeps that grows leaf by leaf, the largest gain next.

    A leaf's best split is known as soon as its parent is split, so the order is found
    on the fully grown tree. Without a bound every split stays, numbered by level.
    """
    out, waiting, left = Tree(), [], (leaves or len(tree.feature) + 1) - 1

    def add(old: int) -> None:
        new = out.add(tree.rows[old], tree.value[old])
        if tree.left[old] >= 0:
            heapq.heappush(waiting, (-tree.gain[old] if leaves else 0, new, old))

    add(0)
    while waiting and left:
        _, new, old = heapq.heappop(waiting)
        out.feature[new], out.bin[new], out.gain[new] = tree.feature[old], tree.bin[old], tree.gain[old]
        out.order[new] = sum(o >= 0 for o in out.order)
        out.left[new] = len(out.feature)
        left -= 1
        add(tree.left[old])
        add(tree.left[old] + 1)
    return out


# --- fitting ----------------------------------------------------------------------


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """At most ``bins - 1`` different quantiles per feature, from one aggregate."""
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f"`{c}`"), shares, accuracy).alias(f"q{k}") for k, c in enumerate(features)]).first()
    return [sorted(set(found[k] or [])) for k in range(len(features))]


def _binned(batches: Iterator[pa.RecordBatch], names: Sequence[str], cuts: Sequence[Sequence[float]], base: float) -> Iterator[pa.RecordBatch]:
    """Rows as bytes: a feature's bin is the number of its cuts below the value."""
    for batch in batches:
        bins = np.empty((batch.num_rows, len(names)), dtype=np.uint8)
        for k, name in enumerate(names):
            bins[:, k] = np.searchsorted(cuts[k], batch[name].to_numpy(), side="left")
        packed = pa.array([row.tobytes() for row in bins], pa.binary())
        margin = pa.array(np.full(batch.num_rows, base))
        yield pa.RecordBatch.from_arrays([packed, *(batch[c] for c in ("label", "val", "key")), margin],
                                         names=["bins", "label", "val", "key", "margin"])


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 0) with the least error before patience ran out, and whether it did."""
    best = 0
    for turn, error in enumerate(errors):
        if error < errors[best]:
            best = turn
        elif turn - best >= patience:
            return best, True
    return best, False


def fit(
    df: DataFrame,
    features: Sequence[str] | None = None,
    settings: Settings = LEVEL_WISE,
    split_col: str = "split",
) -> Model:
    """Boosted trees for the rows labelled ``train``, stopped by those labelled ``val``.

    After every round the validation error of the whole ensemble is known; once it has
    not improved for ``patience`` rounds the trees of the best round are the model. Round
    0 is the mean label alone. Without validation rows all rounds are kept. Rows without
    a label are left out, null features count as 0, and other labels of ``split_col`` are
    ignored. Equal rows are sampled alike. Without training rows the model has no trees
    and predicts 0.
    """
    s = settings
    if not 2 <= s.bins <= 256:
        raise ValueError("bins are stored in a byte: 2 to 256")
    names = list(features) if features is not None else input_columns(df)
    spark = df.sparkSession
    known = training_matrix(df.where(F.col(split_col).isin("train", "val")), features=names, keep=(split_col,))
    train = known.where(F.col(split_col) == "train")
    with ExitStack() as held:
        cuts = quantile_cuts(train, names, s.bins)
        base = train.agg(F.avg(F.col(LABEL).cast("double"))).first()[0]
        if base is None:
            return Model(names, cuts, 0.0, [], [])
        plain = known.select(
            *[F.col(f"`{c}`").alias(f"f{k}") for k, c in enumerate(names)],
            F.col(LABEL).cast("double").alias("label"),
            (F.col(split_col) == "val").alias("val"),
            F.xxhash64(*[F.col(f"`{c}`") for c in names], F.col(LABEL)).alias("key"),
        )
        inputs = [f"f{k}" for k in range(len(names))]
        rows = held.enter_context(
            staged_while(plain.mapInArrow(lambda it: _binned(it, inputs, cuts, base), _ROWS), "boosting-rows")
        )
        trees: list[Tree] = []
        errors: list[float] = []
        recent = 0  # trees that the stored margins lack
        for turn in range(s.rounds + 1):
            rng = np.random.default_rng([s.seed, turn])
            count = max(1, round(s.feature_share * len(names)))
            chosen = sorted(rng.choice(len(names), count, replace=False).tolist())
            newest = trees[len(trees) - recent :]
            last = turn == s.rounds

            def sums_of(tree, open_, newest=newest, chosen=chosen, turn=turn):
                taken = rows.mapInArrow(
                    lambda it: _sums(it, newest, tree, open_, chosen, len(names), turn, s), _SUMS
                )
                grouped = taken.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                found = grouped.toArrow()
                return tuple(found[c].to_numpy() for c in ("node", "feature", "bin", "g", "h"))

            # the last call only asks for the error after the last round
            tree, (off, seen) = _grow(sums_of, chosen, cuts, replace(s, depth=1) if last else s)
            if seen:
                errors.append(off / seen if s.metric == "mae" else (off / seen) ** 0.5)
                best, over = best_round(errors, s.patience)
                if over:
                    break
            if last or tree.rows[0] == 0:
                break
            trees.append(best_first(tree, s.leaves))
            recent += 1
            if recent == s.rebase_every:
                newest = trees[-recent:]
                rows = held.enter_context(
                    staged_while(rows.mapInArrow(lambda it, newest=newest: _rebased(it, newest, len(names)), _ROWS), "boosting-rows")
                )
                recent = 0
        if errors:
            trees = trees[: best_round(errors, s.patience)[0]]
        return Model(names, cuts, float(base), trees, errors)


# --- trees as a table -------------------------------------------------------------

NODES = "tree int, node int, feature string, cut double, left int, gain double, rows double, value double, split_order int"


def model_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """One row per node. ``value`` is set on leaves, the other columns on splits.

    A row goes to ``left`` if its feature is at most ``cut``, else to ``left + 1``. Tree 0
    is a single leaf with the mean label, so a prediction is the sum over all trees.
    """
    rows = [(0, 0, None, None, None, None, None, model.base, None)]
    for number, tree in enumerate(model.trees, 1):
        for n in range(len(tree.feature)):
            if tree.left[n] < 0:
                rows.append((number, n, None, None, None, None, tree.rows[n], tree.value[n], None))
            else:
                f = tree.feature[n]
                rows.append((number, n, model.features[f], model.cuts[f][tree.bin[n]], tree.left[n],
                             tree.gain[n], tree.rows[n], None, tree.order[n]))
    return spark.createDataFrame(rows, NODES)


def save_nodes(nodes: DataFrame, root: str, name: str, version: int) -> str:
    path = f"{root.rstrip('/')}/{name}/version={version}"
    nodes.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_nodes(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    return spark.read.schema(NODES).parquet(f"{root.rstrip('/')}/{name}/version={version}")


def score_nodes(df: DataFrame, nodes: DataFrame, keep: Sequence[str], output: str = "predicted_price") -> DataFrame:
    """``keep`` columns and the sum of the leaves that each row reaches.

    Trees are one value of nested arrays (its size is that of the model, not of the
    data), and a row walks down each of them by an aggregate over the levels. Absent
    features and nulls count as 0; other columns of ``df`` do not matter.
    """
    names = [r[0] for r in nodes.where("feature IS NOT NULL").select("feature").distinct().orderBy("feature").collect()]
    have = set(df.columns)
    inputs = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in have else F.lit(0.0) for c in names]
    number = F.array_position(F.array(*map(F.lit, names)), F.col("feature")).cast("int") if names else F.lit(0)
    node = F.struct("node", F.coalesce(number, F.lit(0)).alias("f"), "cut", "left", "value")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("t"), F.count(F.col("left")).alias("splits"))
    one = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "t"))).alias("trees"), F.max("splits").alias("most"))
    ensemble = one.select(F.transform("trees", lambda x: x["t"])).scalar()
    x = F.array(*inputs) if inputs else F.array(F.lit(0.0))
    depth = max(1, _depth(nodes))

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            lower = F.get(tree, at["left"])
            upper = F.get(tree, at["left"] + 1)
            return F.when(at["left"].isNull(), at).when(F.get(F.col("__x"), at["f"] - 1) <= at["cut"], lower).otherwise(upper)

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.get(tree, F.lit(0)), step)["value"]

    kept = df.select(
        *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], x.alias("__x"), ensemble.alias("__trees")
    )
    total = F.aggregate("__trees", F.lit(0.0), lambda acc, tree: acc + leaf(tree))
    return kept.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], total.alias(output))


def _depth(nodes: DataFrame) -> int:
    """Splits on the longest way down, from the (bounded) table of splits."""
    splits = nodes.where("left IS NOT NULL").select("tree", "node", "left").collect()
    children: dict[tuple[int, int], int] = {(r[0], r[1]): r[2] for r in splits}
    depth, level = 0, [k for k in children if k[1] == 0]
    while level:
        depth += 1
        level = [(t, c) for t, n in level for c in (children[t, n], children[t, n] + 1) if (t, c) in children]
    return depth


def node_importance(nodes: DataFrame, kind: str = "gain", top: int | None = 10) -> DataFrame:
    """``feature, importance``: mean gain per split, or number of splits, as shares of the sum."""
    own = F.avg("gain") if kind == "gain" else F.count("*").cast("double")
    per = nodes.where("feature IS NOT NULL").groupBy("feature").agg(own.alias("own"))
    total = per.agg(F.sum("own")).scalar()
    out = per.select("feature", (F.col("own") / total).alias("importance")).orderBy(F.col("importance").desc(), "feature")
    return out.limit(top) if top is not None else out
