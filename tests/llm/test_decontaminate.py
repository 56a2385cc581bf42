import random

import numpy as np
import pytest

from pricegrid.llm import decontaminate


def words(text):
    return (text or "").encode().lower().split()


def shingles(w, span):
    return [tuple(w[k : k + span]) for k in range(len(w) - span + 1)]


def brute(docs, items, threshold=0.75):
    """Every window against every item, by weighted sets."""
    prepared = [(i, words(t)) for i, t in items if words(t)]
    held = {}
    for _, w in prepared:
        for s in set(shingles(w, min(5, len(w)))):
            held[s] = held.get(s, 0) + 1
    n = max(1, len(prepared))
    weight = lambda ss: sum(np.log1p(n / held.get(s, 1)) for s in ss)
    out = {}
    for d, t in docs:
        w = words(t)
        for i, iw in prepared:
            span, item = min(5, len(iw)), set(shingles(iw, min(5, len(iw))))
            if len(w) < span:
                continue
            size = min(len(iw), len(w))
            for start in range(len(w) - size + 1):
                window = set(shingles(w[start : start + size], span))
                both = weight(window & item)
                value = both / (weight(window) + weight(item) - both)
                if value >= threshold - 1e-12:
                    out[(d, i)] = max(out.get((d, i), 0), value)
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(150)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(6, 50)))) for k in range(25)]
    items += [(25, "Two words"), (26, ""), (27, None), (28, items[0][1] + " tail of it")]
    docs = []
    for d in range(n):
        text = rng.choices(vocabulary, k=rng.randint(0, 120))
        if rng.random() < 0.6:
            part = list(words(rng.choice(items)[1] or ""))
            part = [p.decode() for p in part]
            for _ in range(rng.randint(0, 2)):
                if part:
                    part[rng.choice([0, -1, rng.randrange(len(part))])] = rng.choice(vocabulary)
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((d, " ".join(text).upper() if d % 7 == 0 else " ".join(text)))
    return docs, items


def frame(spark, items):
    return spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("per_pass", [2000, 10])
def test_hits_equal_brute_force(spark, documents, per_pass):
    docs, items = corpus(3)
    docs += [(900, None), (901, ""), (902, "two  WORDS"), (None, items[1][1]), (903, "v1 " * 30_000 + items[2][1]), (0, items[3][1])]
    if per_pass == 2000:
        want = brute([x for x in docs if x[0] != 903], items)
    else:  # weights are those of a pass, so passes are held against their own items
        want = {}
        for k in range(0, len(items), per_pass):
            want |= brute([x for x in docs if x[0] != 903], items[k : k + per_pass])
    df = frame(spark, items).coalesce(1)
    got = decontaminate.contaminated(documents(docs), df, per_pass=per_pass).collect()
    found = {}
    for r in got:
        if r.doc_id != 903:
            found[(r.doc_id, r.item_id)] = max(found.get((r.doc_id, r.item_id), 0), r.similarity)
    assert set(found) <= set(want)
    missed = set(want) - set(found)
    assert len(missed) <= 0.02 * len(want)
    assert not [m for m in missed if want[m] > 0.8]
    assert all(abs(found[k] - want[k]) < 1e-9 for k in found)
    assert [r.first_word for r in got if (r.doc_id, r.item_id) == (903, 2)] == [30_000]


def test_clean_documents_stay(spark, documents):
    docs, items = corpus(4)
    df = frame(spark, items)
    bad = {r.doc_id for r in decontaminate.contaminated(documents(docs), df).collect()}
    left = decontaminate.without_contaminated(documents(docs), df)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - bad
    assert left.columns == documents([]).columns


def test_empty_tables(spark, documents):
    docs, items = corpus(5, 4)
    assert decontaminate.contaminated(documents([]), frame(spark, items)).count() == 0
    assert decontaminate.contaminated(documents(docs), frame(spark, [])).count() == 0
    assert decontaminate.without_contaminated(documents(docs), frame(spark, [])).count() == 4


def test_index_returns_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    index = decontaminate._SizeIndex(10, [], rng.integers(0, 1 << 63, 300).astype(np.uint64), 0.0)
    index.build()
    for _ in range(300):
        f = index.prints[rng.integers(300)]
        for b in rng.choice(64, rng.integers(0, 26), replace=False):
            f = f ^ np.uint64(1 << int(b))
        want = np.flatnonzero(np.bitwise_count(index.prints ^ f) <= decontaminate.RADIUS)
        assert index.within(f).tolist() == want.tolist()


@pytest.mark.parametrize("per_pass", [2000, 10, 7])
def test_weights_are_those_of_the_whole_benchmark(spark, documents, per_pass):
    """Twenty items begin alike; the groups they fall into must not matter."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(16)]
    items = [(k, " ".join(common + rng.choices([f"r{j}" for j in range(400)], k=14))) for k in range(20)]
    items.append((20, " ".join(rng.choices([f"r{j}" for j in range(400)], k=30))))
    docs = []
    for k, text in items:
        own = text.split()
        docs += [(3 * k, text), (3 * k + 1, " ".join(["x", "y", *own[2:]])), (3 * k + 2, " ".join([*own[:-2], "x", "y"]))]
    want = brute(docs, items)
    got = decontaminate.contaminated(documents(docs), frame(spark, items).coalesce(1), per_pass=per_pass).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert set(found) <= set(want) and all(abs(found[k] - want[k]) < 1e-9 for k in found)
    assert {(3 * k, k) for k, _ in items} <= set(found)
    left = decontaminate.without_contaminated(documents(docs), frame(spark, items).coalesce(1), per_pass=per_pass)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in found}


def test_index_looks_up_all_windows_together():
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    index = decontaminate._SizeIndex(9, [], prints, 0.0)
    index.build()
    asked = np.concatenate([prints[:20] ^ np.uint64(0b1011 << 30), rng.integers(0, 1 << 63, 60, dtype=np.uint64), prints[:3]])
    want = [
        (place, k)
        for place, f in enumerate(asked)
        for k in range(40)
        if int(f ^ prints[k]).bit_count() <= decontaminate.RADIUS
    ]
    place, item = index.pairs(asked)
    assert list(zip(place.tolist(), item.tolist())) == want
    assert len(want) >= 23
    assert [x.tolist() for x in index.pairs(asked[:0])] == [[], []]
