import hashlib
import random

import numpy as np
import pytest

from pricegrid.llm import suffix_dedup as s


def brute(rows, length):
    """Report of distinct (doc_id, text) rows by a dictionary of all windows."""
    ids = {(-(1 << 63) if i is None else i, t or "") for i, t in rows}
    assert len({i for i, _ in ids}) == len(ids), "texts of one doc_id have no order here"
    seen, out = set(), {}
    for i, text in sorted(ids):
        raw = text.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            window = raw[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((str(i), *out[-(1 << 63) if i is None else i]) for i, _ in rows)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(seed, letters="ab", docs=25):
    rng = random.Random(seed)
    phrases = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(6)]
    return [(i, "".join(rng.choice(phrases) for _ in range(rng.randint(0, 8)))) for i in range(docs)]


ODD = [
    (100, None), (101, ""), (None, "q" * 60), (102, "q" * 61), (103, "naïve €uro " * 9), (104, "naïve €uro " * 9),
    (105, "\0\0\0" * 20), (106, "\0" * 30 + "x"), (107, "short"), (5000, "z" + "\0" * 59),
]


@pytest.mark.parametrize("limit", [1, 3, s.LIMIT])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh é"])
def test_report_equals_brute_force(spark, documents, limit, letters):
    rows = corpus(limit, letters) + ODD
    rows += [rows[3], rows[7], (None, "q" * 60)]  # delivered again
    rows += [(300 + k, f"{k:05d}" + "the same passage in many contexts" + f"{7 * k:05d}") for k in range(30)]
    report = s.repeat_report(documents(rows).repartition(3), 12, anchors=(5, 9), limit=limit, block=300)
    assert got(report) == brute(rows, 12)


def test_long_texts_with_the_given_length(spark, documents):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghij ") for _ in range(600_000))
    rows = [(1, text), (2, text[1000:590_000] + "!"), (3, text[:99]), (4, text[:100]), (5, "=" * 5000)]
    assert got(s.repeat_report(documents(rows))) == brute(rows, 100)


def test_texts_of_one_id_are_rows_of_their_own(spark, documents):
    rows = [(1, "abcdefghijklmnop"), (1, "abcdefghijklmnopq")]
    report = s.repeat_report(documents(rows), 12, anchors=(5,)).collect()
    assert sorted(r.n_removed for r in report) in ([0, 16], [0, 16])  # one of them goes, whichever is second


def test_no_rows(spark, documents):
    assert s.repeat_report(documents([])).collect() == []
    assert s.without_repeats(documents([(1, None)]).where("doc_id = 2")).collect() == []


def test_texts_without_repeats(spark, documents):
    rows = [(1, "x" + "é" * 10 + "y"), (2, "é" * 10 + "tail"), (3, None), (4, "z")]
    docs = documents(rows).withColumnRenamed("node", "__key")
    done = s.without_repeats(docs, 11, anchors=(4,))
    assert done.columns == docs.columns
    by_id = {r.doc_id: r for r in done.collect()}
    # the 11-byte string that starts on a character leaves the tail behind
    assert by_id[2].text == "tail" and by_id[2].n_chars == 4
    assert by_id[3].text is None and by_id[4].text == "z"


def test_two_stage_sort_orders_suffixes():
    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(12, 40, rng.integers(1, 8))
        text = rng.integers(0, rng.integers(2, 5), sizes.sum()).astype(np.uint8) * 85
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        block = s.Block(text, bounds)
        windows = sizes - 11
        order = s.two_stage_sort(block, windows, 12)
        wanted = [p for b, n in zip(bounds, windows) for p in range(b, b + n)]
        assert sorted(order.tolist()) == wanted
        keys = [text[p : p + 12].tobytes() for p in order]
        assert keys == sorted(keys)
        lcp = s.common_prefixes(block, order, 12)
        for k in range(1, len(keys)):
            same = next((j for j in range(12) if keys[k][j] != keys[k - 1][j]), 12)
            assert lcp[k] == same


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(s, "PIECE", 64)
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 700).astype(np.uint8)
    bounds = np.array([0, 0, 150, 155, 400, 700])
    owner, met = {}, []
    for start, n, h, text in s._runs(raw, bounds, s._Grams(4, 10)):
        for a, c, x, t in zip(start, n, h, text):
            assert bounds[t] <= a and a + c + 9 <= bounds[t + 1]
            met += range(a, a + c)
            for k in range(a, a + c):
                assert owner.setdefault(raw[k : k + 10].tobytes(), x) == x
    assert met == [k for a, b in zip(bounds, bounds[1:]) for k in range(a, b - 9)]
