import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pricegrid.llm import mixing

LEVELS = ["domain", "lang", "source"]


def fill(budget, nodes):
    """[(name, room, weight)] -> {name: given}, by filling the fullest child first."""
    out, left, open_ = {}, budget, sorted(nodes, key=lambda x: (x[1] / x[2], x[2], x[0]))
    while open_:
        name, room, weight = open_[0]
        total = sum(x[2] for x in open_)
        if left * weight / total < room:
            for name, room, weight in open_:
                out[name] = min(int(left * weight // total), room)
            break
        out[name] = room
        left -= room
        open_.pop(0)
    return out


def brute(rows, budget, weights, epochs, seed):
    tokens = defaultdict(int)
    for _, *names, n in rows:
        tokens[tuple(names)] += n
    weight = lambda level, name: weights.get(level, {}).get(name, 1)
    room = {k: n * epochs if all(weight(c, x) for c, x in zip(LEVELS, k)) else 0 for k, n in tokens.items()}
    given = {(): budget if budget is not None else sum(tokens.values())}
    for depth, level in enumerate(LEVELS):
        new = {}
        for parent, b in given.items():
            children = defaultdict(int)
            for k, r in room.items():
                if k[:depth] == parent and r > 0:
                    children[k[depth]] += r
            part = fill(b, [(c, r, weight(level, c)) for c, r in children.items()])
            new |= {(*parent, c): g for c, g in part.items()}
        given = new
    out = []
    for leaf, n in tokens.items():
        b = given.get(leaf, 0)
        whole, rest = (b // n, b % n) if n else (0, 0)
        docs = sorted(
            ((hashlib.md5(f"{seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r) for r in rows if tuple(r[1:4]) == leaf),
            key=lambda x: x[0],
        )
        for h, r in docs:
            upto = sum(x[1][4] for x in docs if x[0] <= h)
            copies = whole + (1 if rest and upto <= rest else 0)
            if copies:
                out.append((*r, copies))
    return sorted(map(str, out))


@pytest.mark.parametrize("ranges", [1, 8, 4096])
@pytest.mark.parametrize("budget,epochs", [(None, 1), (None, 2), (700, 1), (10**9, 3), (0, 2)])
def test_mix_equals_brute_force(spark, ranges, budget, epochs):
    rng = random.Random(ranges)
    rows = []
    for i in range(260):
        d = rng.choice(["web", "web", "web", "books", ""])
        rows.append((i, d, rng.choice(["en", "de"]), rng.choice(["s0", "s0", "s1", "s2"]), rng.choice([0, 1, 3, 20])))
    rows += [(7, "books", "en", "s1", 5), (None, "web", "de", "s2", 4), (None, "web", "de", "s2", 4)]
    weights = {"domain": {"web": 5, "books": 3, "": 1}, "lang": {"de": 2}, "source": {"s2": 0}}
    df = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, tokens long")
    got = mixing.mixed_rows(df, LEVELS, budget, weights, epochs, 11, ranges, 1)
    got = got.select("doc_id", *LEVELS, "tokens", "copies").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, budget, weights, epochs, 11)


def test_siblings_take_a_shortage_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "1", 1000), ("b", "x", "1", 5000)],
        "domain string, lang string, source string, tokens long",
    )
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(leaves, 800, {}, LEVELS, 1).collect()}
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "1"): 200, ("b", "x", "1"): 400}
    short = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(leaves, 6000, {}, LEVELS, 1).collect()}
    assert short == {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 3990}


def test_odd_texts(spark, documents):
    rows = [(1, None), (2, ""), (3, "a  b\tc\n"), (4, "w " * 50_000), (3, "x"), (None, "y z")]
    levels = {"domain": F.lit("d"), "lang": F.col("lang"), "source": F.when(F.col("doc_id") != 2, F.col("source"))}
    got = mixing.mix(documents(rows), None, {}, levels, epochs=1).collect()
    assert sum(r.tokens * r.copies for r in got) == 3 + 50_000 + 1 + 2
    assert {r.tokens for r in got if r.doc_id == 3} == {3, 1}


def test_empty_table(spark, documents):
    levels = {"domain": F.lit("d"), "lang": F.col("lang"), "source": F.col("source")}
    assert mixing.mix(documents([]), None, {}, levels).count() == 0
