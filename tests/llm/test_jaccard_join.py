import random

import numpy as np
import pytest

from pricegrid.llm import hashing, jaccard_join


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        if not sets[k]:
            out.append((i, 0, i))
        else:
            ids = [rows[j][0] for j in range(len(rows)) if sets[j] and find(j) == find(k) and rows[j][0] is not None]
            out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(map(str, out))


def corpus(seed, families=12, copies=9, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)]
    passage = rng.choices(vocabulary, k=12)
    rows, serial = [], 0
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(5, words))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            serial += 1
            rows.append((serial, " ".join(text)))
    rng.shuffle(rows)
    return rows


EDGES = [
    (900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE  two"), (905, "one"), (None, "one"),
    (906, "a b c d e"), (906, "a b c d e"), (907, "É b c d e"), (908, "é b c d e"), (None, None),
    (909, " ".join(f"x{k}" for k in range(20_000))), (910, " ".join(f"x{k}" for k in range(19_000))),
]


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_SHINGLES, 150])
def test_components_equal_brute_force(spark, documents, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rows = corpus(5) + EDGES
    got = jaccard_join.jaccard_components(documents(rows).repartition(3))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_one_document_of_each_component_stays(spark, documents):
    rows = corpus(6, families=5) + EDGES
    want = {i for i, _, c in map(eval, brute(rows)) if i == c}
    kept = jaccard_join.one_per_component(documents(rows))
    assert {r.doc_id for r in kept.collect()} == want
    assert kept.columns == documents([]).columns


def test_empty_table(spark, documents):
    assert jaccard_join.jaccard_components(documents([])).count() == 0


def test_trees_lose_no_pair():
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64) for _ in range(40)]
    sets = []
    for b in base:
        for _ in range(4):
            keep = b[rng.random(len(b)) > 0.07]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, len(b) // 20).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    vectors = [jaccard_join.count_vector(s) for s in sets]
    trees = jaccard_join.SizeBands(vectors, sizes)
    pruned = 0
    for k in range(len(sets)):
        found = set(trees.search(vectors[k], int(sizes[k])).tolist())
        linked = {j for j in range(len(sets)) if jaccard_join.links(sets[k], sets[j])}
        assert linked <= found
        pruned += len(sets) - len(found)
    assert pruned > 0.7 * len(sets) ** 2


def test_linked_sets_share_a_prefix_shingle():
    rng = random.Random(4)
    levels = np.array([rng.randrange(16) for _ in range(jaccard_join.CELLS)], dtype=np.uint8)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = [rng.getrandbits(64) for _ in range(n)]
        b = a[: rng.randint(max(1, int(0.7 * n)), n)] + [rng.getrandbits(64) for _ in range(rng.randint(0, 6))]
        a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (a, b))
        if jaccard_join.links(a, b):
            assert np.intersect1d(jaccard_join.prefix_of(a, levels), jaccard_join.prefix_of(b, levels)).size


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (200, 201)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for nodes in (range(0, 61), range(100, 140), (200, 201)):
        assert {got.get(n, n) for n in nodes} == {min(nodes)}


def test_words_are_hashed_alike_in_any_batch():
    import pyarrow as pa

    texts = ["Ab  cD", "ab cd", "", "cd", "x" * 600_000 + " cd", "É É", "cd\x0bab"]
    all_at_once = list(hashing.rows(pa.record_batch([pa.array(texts)], names=["text"])))
    for t, h in zip(texts, all_at_once):
        (alone,) = hashing.rows(pa.record_batch([pa.array([t])], names=["text"]), most=1)
        assert (alone == h).all() and len(h) == len(t.encode().split())
    assert all_at_once[0].tolist() == all_at_once[1].tolist()
    assert all_at_once[3][0] == all_at_once[4][1] == all_at_once[6][0]
