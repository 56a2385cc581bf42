import random
from collections import Counter
from itertools import permutations

import numpy as np

from pricegrid.llm import filter_audit as fa


def fails(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
        out.add("C")
    if set("#$%&*|") & set(text):
        out.add("D")
    return out


def brute(rows, labels):
    """rows: (doc_id, text, lang). Filters are really applied, one order after the other."""
    docs = []
    for i, text, lang in rows:
        bad = fails(text or "")
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows):
            bad.add("E")
        marks = [m for m in labels if m[0] is not None and m[0] == i]
        docs.append((lang or "", frozenset(bad), any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    out, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                before = len(left)
                left = [d for d in left if f not in d[1]]
                failing = [d for d in own if f in d[1]]
                assert before - len(gone) == len(left)
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                            sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), f))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, good int, part string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(docs, marks)
    assert got.schema.simpleString().startswith("struct<part:string,filter_order:string,step:int,kept:bigint")
    return sorted(tuple(r) for r in got.collect())


def test_equals_filters_that_are_really_applied(spark):
    rng = random.Random(6)
    long = " ".join(f"w{k}" for k in range(220))
    texts = ["", None, "a b", "A B", "a #", long, long + " $", " ".join(["x", "y"] * 150), "É" * 97 + "AAA", "É" * 96 + "AAAA",
             "a\tb\nc\x0b\x0c\rd", "　", "|" + "B" * 50, long.upper()]
    rows = [(k, rng.choice(texts), rng.choice(["en", "de", "", None])) for k in range(120)]
    rows += [(5, "a b", "en"), (5, "a b", "en"), (5, "a b", "de"), (None, "a b", "en"), (None, "a b", "en"), (None, None, None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 140, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    assert audit(spark, rows, labels) == brute(rows, labels)


def test_no_rows_and_no_labels(spark):
    assert audit(spark, [], [(1, 1, 1)]) == []
    rows = [(1, "a", "en"), (2, "a", "en")]
    assert audit(spark, rows, []) == brute(rows, [])


def test_contractions_hold_for_large_counts():
    rng = np.random.default_rng(0)
    cell = np.arange(32)
    tensors = {m: fa._tensor(cell, rng.integers(0, 1 << 50, 32)) for m in fa.MEASURES}
    got = fa.audit_tensors("p", tensors)
    total = int(tensors["docs"].sum())
    for k in range(0, 600, 5):  # what an order removes and keeps is all there is
        assert int(got["kept"][k + 4]) + sum(int(x) for x in got["removed"][k : k + 5]) == total
    own = [o[s - 1] for o, s in zip(got["filter_order"], got["step"])]
    for f in "ABCDE":
        assert {int(x) for x, o in zip(got["shapley"], own) if o == f} == {
            sum(int(x) for x, o in zip(got["removed"], own) if o == f)
        }
