import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricegrid.plans import boosting as b
from pricegrid.plans import jobs


def plain_tree(rows, labels, s):
    """Leaf value of every row by exhaustive search over all values of all features."""
    out = np.zeros(len(rows))

    def strength(g):
        return max(abs(g.sum()) - s.alpha, 0) ** 2 / (len(g) + s.lam)

    def grow(at, level):
        g = -labels[at]
        best = (max(s.gamma, 1e-6), None)
        for f in range(rows.shape[1]) if level < s.depth else ():
            for cut in sorted(set(rows[at, f]))[:-1]:
                left = rows[at, f] <= cut
                if min(left.sum(), (~left).sum()) < s.min_child:
                    continue
                gain = round(strength(g[left]) + strength(g[~left]) - strength(g), 6)
                if gain > best[0]:
                    best = (gain, (f, cut))
        if best[1] is None:
            out[at] = -np.sign(g.sum()) * max(abs(g.sum()) - s.alpha, 0) / (len(g) + s.lam) * s.rate
            return
        f, cut = best[1]
        left = rows[at, f] <= cut
        grow(at[left], level + 1)
        grow(at[~left], level + 1)

    grow(np.arange(len(rows)), 0)
    return out


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(7)
    rows = []
    for k in range(400):
        x, z = rng.randint(0, 30), rng.choice([0.5, 1.5, 2.5, None])
        price = (20.0 if x > 11 else 5.0) + 3 * (z or 0) + rng.gauss(0, 1)
        rows.append((k, float(x), z, price if k % 50 else None, "val" if k % 4 == 0 else "train"))
    return spark.createDataFrame(rows, "id long, x double, z double, price double, split string").repartition(3)


WHOLE = replace(b.LEVEL_WISE, row_share=1.0, feature_share=1.0)


def test_one_round_is_the_best_tree_of_all(spark, noisy):
    s = replace(WHOLE, rounds=1, depth=3, rate=0.5, bins=256, gamma=20.0, alpha=2.0, min_child=10)
    model = b.fit(noisy.where("split = 'train'"), ["x", "z"], s)
    got = b.score_nodes(noisy, b.model_nodes(spark, model), ["id", "x", "z", "price", "split"]).toPandas()
    train = got[(got.split == "train") & got.price.notna()]
    inputs, label = train[["x", "z"]].fillna(0).to_numpy(), train.price.to_numpy()
    want = label.mean() + plain_tree(inputs, label - label.mean(), s)
    assert np.allclose(train.predicted_price.to_numpy(), want)


def test_trees_in_tasks_and_stored_trees_agree(spark, noisy, tmp_path):
    s = replace(b.LEVEL_WISE, rounds=7, rate=0.3, depth=4, rebase_every=3)
    model = b.fit(noisy, ["x", "z"], s)
    b.save_nodes(b.model_nodes(spark, model), str(tmp_path), "m", 2)
    nodes = b.load_nodes(spark, str(tmp_path), "m", 2)
    got = b.score_nodes(noisy.drop("z"), nodes, ["split", "price", "x"]).toPandas()
    bins = np.stack([np.searchsorted(model.cuts[0], got.x), np.zeros(len(got), dtype=int)], axis=1).astype(np.uint8)
    want = model.base + sum(np.array(t.value)[t.leaf_of(bins)] for t in model.trees)
    assert np.allclose(got.predicted_price, want)
    whole = b.score_nodes(noisy, nodes, ["split", "price"]).toPandas()
    val = whole[(whole.split == "val") & whole.price.notna()]
    error = float(np.sqrt(((val.predicted_price - val.price) ** 2).mean()))
    assert abs(error - model.errors[len(model.trees)]) < 1e-9


def test_best_round_waits_through_a_dip():
    errors = [9, 7, 8, 8, 6, 6, 7, 8, 9]
    assert b.best_round(errors[:4], 3) == (1, False)
    assert b.best_round(errors, 3) == (4, True)
    assert b.best_round(errors, 2) == (1, True)
    assert b.best_round([5.0], 3) == (0, False)


def test_training_ends_with_the_trees_of_the_best_round(spark, noisy):
    flat = noisy.withColumn("price", F.when(F.col("split") == "val", 11.0).otherwise(F.col("price")))
    model = b.fit(flat, ["x"], replace(b.LEVEL_WISE, rounds=40, rate=0.5, patience=4, depth=2))
    best = min(range(len(model.errors)), key=model.errors.__getitem__)
    assert len(model.errors) == best + 5 < 40 and len(model.trees) == best
    learned = b.fit(noisy, ["x", "z"], replace(b.LEVEL_WISE, rounds=12, rate=0.4, depth=3))
    assert min(learned.errors) < 0.35 * learned.errors[0] and learned.errors[len(learned.trees)] == min(learned.errors)


def test_leaves_are_bounded_and_split_by_gain(spark, noisy):
    s = replace(b.LEAF_WISE, rounds=1, row_share=1.0, feature_share=1.0, leaves=5, min_child=5)
    tree = b.fit(noisy.where("split = 'train'"), ["x", "z"], s).trees[0]
    assert sum(n < 0 for n in tree.left) == 5
    by_order = sorted((o, n) for n, o in enumerate(tree.order) if o >= 0)
    open_ = {0}
    for _, n in by_order:  # each split is the best among the leaves of its time
        assert tree.gain[n] == max(tree.gain[k] for k in open_)
        open_ = (open_ - {n}) | {tree.left[n], tree.left[n] + 1}


def test_no_rows_no_features_one_value(spark, noisy):
    empty = b.fit(noisy.where("id < 0"), ["x"])
    assert empty.trees == [] and empty.base == 0.0
    assert b.score_nodes(noisy, b.model_nodes(spark, empty), ["id"]).agg(F.max("predicted_price")).first()[0] == 0
    same = b.fit(noisy.withColumn("x", F.lit(3.0)), ["x"], replace(WHOLE, rounds=2))
    assert all(t.left == [-1] for t in same.trees)
    with pytest.raises(ValueError):
        b.fit(noisy, ["x"], replace(WHOLE, bins=500))


def test_importance_is_mean_gain(spark, noisy):
    model = b.fit(noisy, ["x", "z"], replace(WHOLE, rounds=3, depth=2))
    nodes = b.model_nodes(spark, model)
    gains = {}
    for t in model.trees:
        for n, f in enumerate(t.feature):
            if f >= 0:
                gains.setdefault(model.features[f], []).append(t.gain[n])
    mean = {f: sum(g) / len(g) for f, g in gains.items()}
    got = {r.feature: r.importance for r in b.node_importance(nodes).collect()}
    assert got == pytest.approx({f: g / sum(mean.values()) for f, g in mean.items()})
    counts = {r.feature: r.importance for r in b.node_importance(nodes, "splits").collect()}
    assert counts == pytest.approx({f: len(g) / sum(map(len, gains.values())) for f, g in gains.items()})
