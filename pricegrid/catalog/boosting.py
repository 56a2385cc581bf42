"""Boosted trees: their nodes, scores from stored nodes, validation errors, order of splits.

The twins grow the same trees in SQL, a few statements per level. Rows and features are
not sampled here, so that both sides have the same sums.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.features import FULL_SQL, full_features_of
from pricegrid.catalog.registry import query, rounded
from pricegrid.operators.reports import mode_label
from pricegrid.plans import boosting as b
from pricegrid.plans.models import score_modes_with
from pricegrid.session import checkpointed, fresh_path

FEATURES = ["hour", "day_of_year", "load_forecast", "wind_forecast", "residual_load", "price_lag_1h", "price_lag_24h"]
VAL_FROM = "2024-01-18 00:00:00"
LEVELS = replace(b.LEVEL_WISE, rounds=2, depth=3, rate=0.3, row_share=1.0, feature_share=1.0, bins=16)
ROUNDS = replace(LEVELS, rounds=4, rate=0.5)
LEAVES = replace(b.LEAF_WISE, rounds=1, rate=1.0, row_share=1.0, feature_share=1.0, bins=16, leaves=6)


def _rows(spark, sf, features=FEATURES):
    """Priced rows; those before ``VAL_FROM`` train. Values in six decimals, as in the twin."""
    rows = full_features_of(spark, sf).where("price IS NOT NULL")
    values = [F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), 6).alias(c) for c in features]
    split = F.when(F.col("ts") < F.lit(VAL_FROM).cast("timestamp"), "train").otherwise("val")
    return checkpointed(rows.select("series_id", "ts", "price", *values, split.alias("split")))


def _only_train(rows):
    return rows.where("split = 'train'")


def _strength(g: str, h: str, s: b.Settings) -> str:
    return f"power(greatest(abs({g}) - {s.alpha}::DOUBLE, 0), 2) / ({h} + {s.lam}::DOUBLE)"


def _best_sql(name: str, rows: str, s: b.Settings, open_: str) -> str:
    """``{name}``: (node, f, b, gain, rows) of the best split of each open node."""
    gain = f"{_strength('gl', 'hl', s)} + {_strength('ga - gl', 'ha - hl', s)} - {_strength('ga', 'ha', s)}"
    return f"""{name}_h AS (SELECT node, f, b, sum(m - y) AS g, count(*) AS h FROM {rows} JOIN bb USING (rid)
  WHERE NOT val AND {open_} GROUP BY node, f, b),
{name}_c AS (SELECT node, f, b, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS ga, sum(h) OVER p AS ha FROM {name}_h
  WINDOW w AS (PARTITION BY node, f ORDER BY b), p AS (PARTITION BY node, f)),
{name} AS (SELECT node, f, b, gain, CAST(ha AS DOUBLE) AS rows FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) AS nth FROM (
    SELECT *, round({gain}, 6) AS gain FROM {name}_c
    WHERE hl >= {s.min_child} AND ha - hl >= {s.min_child} AND b < (SELECT count(*) FROM bc WHERE bc.f = {name}_c.f)))
  WHERE nth = 1 AND gain > {max(s.gamma, 1e-6)})"""


def _moved_sql(name: str, rows: str, splits: str) -> str:
    return f"""{name} AS (SELECT n.rid, n.y, n.val, n.m, CASE WHEN s.node IS NULL THEN n.node
  ELSE 2 * n.node + CAST(bb.b > s.b AS INTEGER) END AS node
  FROM {rows} n LEFT JOIN {splits} s USING (node) LEFT JOIN bb ON bb.rid = n.rid AND bb.f = s.f)"""


def _base_sql(features, s: b.Settings, only_train: bool) -> list[str]:
    values = ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), 0), 6) AS {c}" for c in features)
    shares = ", ".join(str(k / s.bins) for k in range(1, s.bins))
    long = " UNION ALL ".join(f"SELECT rid, val, {k} AS f, {c} AS v FROM br" for k, c in enumerate(features))
    return [
        FULL_SQL,
        f"""br AS (SELECT series_id, ts, row_number() OVER (ORDER BY series_id, ts) AS rid, price AS y,
  ts >= TIMESTAMP '{VAL_FROM}' AS val, {values} FROM full_features WHERE price IS NOT NULL)""",
        f"bl AS ({long})",
        f"""bc AS (SELECT f, cut, row_number() OVER (PARTITION BY f ORDER BY cut) - 1 AS c FROM (SELECT DISTINCT f, cut FROM (
  SELECT f, unnest(quantile_disc(v, CAST([{shares}] AS DOUBLE[]))) AS cut FROM bl WHERE NOT val GROUP BY f)))""",
        """bb AS (SELECT l.rid, l.f, count(c.cut) AS b FROM bl l LEFT JOIN bc c ON c.f = l.f AND c.cut < l.v
  GROUP BY l.rid, l.f)""",
        f"""m0 AS (SELECT rid, y, val, (SELECT avg(y) FROM br WHERE NOT val) AS m FROM br{" WHERE NOT val" if only_train else ""})""",
    ]


def _trees_sql(s: b.Settings, rounds: int) -> list[str]:
    """Rounds of trees that grow by levels; nodes have the root 1 and children 2n and 2n + 1."""
    out = []
    for r in range(1, rounds + 1):
        out.append(f"n{r}_0 AS (SELECT rid, y, val, m, 1 AS node FROM m{r - 1})")
        for level in range(s.depth):
            out.append(_best_sql(f"s{r}_{level}", f"n{r}_{level}", s, f"node >= {1 << level}"))
            out.append(_moved_sql(f"n{r}_{level + 1}", f"n{r}_{level}", f"s{r}_{level}"))
        out.append(
            f"""v{r} AS (SELECT node, count(*) AS rows, -sign(sum(m - y)) * greatest(abs(sum(m - y)) - {s.alpha}::DOUBLE, 0)
  / (count(*) + {s.lam}::DOUBLE) * {s.rate}::DOUBLE AS value FROM n{r}_{s.depth} WHERE NOT val GROUP BY node)"""
        )
        out.append(f"m{r} AS (SELECT rid, y, val, m + value AS m FROM n{r}_{s.depth} JOIN v{r} USING (node))")
    return out


def _nodes_twin() -> str:
    s, rounds = LEVELS, LEVELS.rounds
    names = "[" + ", ".join(f"'{c}'" for c in FEATURES) + "]"
    splits = " UNION ALL ".join(
        f"SELECT {r} AS tree, node, f, b, gain, rows FROM s{r}_{k}" for r in range(1, rounds + 1) for k in range(s.depth)
    )
    leaves = " UNION ALL ".join(
        f"SELECT {r}, node, NULL, NULL, NULL, CAST(rows AS DOUBLE), value FROM v{r}" for r in range(1, rounds + 1)
    )
    ctes = [*_base_sql(FEATURES, s, True), *_trees_sql(s, rounds), f"""every AS (
  SELECT tree, node, f, b, gain, rows, CAST(NULL AS DOUBLE) AS value FROM ({splits}) UNION ALL {leaves}),
placed AS (SELECT e.*, cut, row_number() OVER (PARTITION BY tree ORDER BY node) - 1 AS place,
  row_number() OVER (PARTITION BY tree, e.f IS NULL ORDER BY node) - 1 AS nth
  FROM every e LEFT JOIN bc ON bc.f = e.f AND bc.c = e.b)"""]  # fmt: skip
    return f"""WITH {", ".join(ctes)}
SELECT 0 AS tree, 0 AS node, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS cut, CAST(NULL AS INTEGER) AS "left",
  CAST(NULL AS DOUBLE) AS gain, CAST(NULL AS DOUBLE) AS rows, {rounded("avg(y)", "value")}, CAST(NULL AS INTEGER) AS split_order
FROM br WHERE NOT val UNION ALL
SELECT p.tree, CAST(p.place AS INTEGER), {names}[p.f + 1], {rounded("p.cut", "cut")}, CAST(c.place AS INTEGER), {rounded("p.gain", "gain")},
  p.rows, {rounded("p.value", "value")}, CASE WHEN p.f IS NOT NULL THEN CAST(p.nth AS INTEGER) END
FROM placed p LEFT JOIN placed c ON c.tree = p.tree AND c.node = 2 * p.node AND p.f IS NOT NULL"""


@query("boosted_nodes", _nodes_twin())
def _boosted_nodes(spark, sf):
    return b.model_nodes(spark, b.fit(_only_train(_rows(spark, sf)), FEATURES, LEVELS))


def _scores_twin() -> str:
    ctes = [*_base_sql(FEATURES, LEVELS, False), *_trees_sql(LEVELS, LEVELS.rounds)]
    return f"""WITH {", ".join(ctes)},
scored AS (SELECT series_id, ts, CASE WHEN ts < TIMESTAMP '{v.AS_OF}' THEN 'backtest' ELSE 'forecast' END AS mode,
  br.y AS actual_price, m AS predicted_price, br.y - m AS error, abs(br.y - m) AS abs_error FROM br JOIN m{LEVELS.rounds} USING (rid)
  WHERE ts >= TIMESTAMP '{v.AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{v.AS_OF}' + INTERVAL 2 DAY)
SELECT series_id, ts, mode, {", ".join(rounded(c, c) for c in ("actual_price", "predicted_price", "error", "abs_error"))} FROM scored"""


@query("boosted_scores", _scores_twin())
def _boosted_scores(spark, sf):
    """Train, store the nodes, load them, and score the labelled rows with them."""
    rows = _rows(spark, sf)
    root = fresh_path(spark, "boosted-models")
    b.save_nodes(b.model_nodes(spark, b.fit(_only_train(rows), FEATURES, LEVELS)), root, "price", 1)
    nodes = b.load_nodes(spark, root, "price", 1)
    return score_modes_with(mode_label(rows, v.as_of(), 7, 2), lambda df, keep: b.score_nodes(df, nodes, keep))


def _rounds_twin() -> str:
    ctes = [*_base_sql(FEATURES, ROUNDS, False), *_trees_sql(ROUNDS, ROUNDS.rounds)]
    errors = " UNION ALL ".join(
        f"SELECT {r} AS round, sqrt(avg((m - y) * (m - y))) AS val_error FROM m{r} WHERE val" for r in range(ROUNDS.rounds + 1)
    )
    return f"""WITH {", ".join(ctes)}, errors AS ({errors})
SELECT round, {rounded("val_error", "val_error")}, round = arg_min(round, val_error) OVER () AS kept FROM errors"""


@query("boosting_rounds", _rounds_twin())
def _boosting_rounds(spark, sf):
    """The validation error of every prefix of the ensemble, and which one is kept."""
    model = b.fit(_rows(spark, sf), FEATURES, ROUNDS)
    rows = [(k, e, k == len(model.trees)) for k, e in enumerate(model.errors)]
    return spark.createDataFrame(rows, "round int, val_error double, kept boolean")


def _leafwise_twin() -> str:
    s = LEAVES
    ctes = _base_sql(["price_lag_24h"], s, True) + ["n0 AS (SELECT rid, y, val, m, 1 AS node FROM m0)"]
    for k in range(s.leaves - 1):
        ctes.append(_best_sql(f"a{k}", f"n{k}", s, f"node < {1 << s.depth}"))
        ctes.append(f"s{k} AS (SELECT * FROM a{k} ORDER BY gain DESC, node LIMIT 1)")
        ctes.append(_moved_sql(f"n{k + 1}", f"n{k}", f"s{k}"))
    splits = " UNION ALL ".join(f"SELECT {k} AS split_order, * FROM s{k}" for k in range(s.leaves - 1))
    return f"""WITH {", ".join(ctes)}
SELECT split_order, 'price_lag_24h' AS feature, {rounded("cut", "cut")}, {rounded("gain", "gain")}, rows
FROM ({splits}) x JOIN bc ON bc.f = x.f AND bc.c = x.b"""


@query("leafwise_splits", _leafwise_twin())
def _leafwise_splits(spark, sf):
    """The splits of a tree that grows leaf by leaf, in their order."""
    rows = _rows(spark, sf, ["price_lag_24h"])
    nodes = b.model_nodes(spark, b.fit(_only_train(rows), ["price_lag_24h"], LEAVES))
    return nodes.where("split_order IS NOT NULL").select("split_order", "feature", "cut", "gain", "rows")


def _importance_twin() -> str:
    return f"""SELECT feature, {rounded("importance", "importance")} FROM (
  SELECT feature, avg(gain) / sum(avg(gain)) OVER () AS importance FROM ({_nodes_twin()}) WHERE feature IS NOT NULL GROUP BY feature)"""


@query("boosted_importance", _importance_twin())
def _boosted_importance(spark, sf):
    nodes = b.model_nodes(spark, b.fit(_only_train(_rows(spark, sf)), FEATURES, LEVELS))
    return b.node_importance(nodes, top=None)
