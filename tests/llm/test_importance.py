import hashlib
import math
import random
import re
import zlib

import pytest

from pricegrid.llm import importance as im


def brute(rows, target, buckets, least, share):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [zlib.crc32(w.encode()) % buckets for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]

    own, goal = [words(t) for _, t in rows], [words(t) for t in target]
    s, t = [0] * buckets, [0] * buckets
    for total, texts in ((s, own), (t, goal)):
        for text in texts:
            for b in text:
                total[b] += 1
    gain = [
        math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)
    ]
    out = []
    for (i, _), found in zip(rows, own):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, weight + noise, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * share[0] // share[1]], 1):
        r[4] = rank
    return sorted(map(str, out))


@pytest.mark.parametrize("chunk,bits", [(im.CHUNK, im.DIGIT_BITS), (7, 3), (16, 8)])
def test_equals_brute_force(spark, documents, chunk, bits):
    rng = random.Random(4)
    rows = [
        (k * 97 - 1000, " ".join(rng.choice(["Ab", "ß12", "c", "d_e", "zz", "€"]) for _ in range(rng.randint(0, 9))))
        for k in range(60)
    ]
    rows += [(None, "ab c d"), (-(2**62), None), (2**62, ""), (9, "x" * 10), (10, "--,--")]
    target = [("a", "zz zz ß12"), ("b", None), ("c", "Zz")]
    bench = spark.createDataFrame(target, "item_id string, text string")
    docs = documents(rows).repartition(4)
    got = im.resample(docs, bench, 50, 2024, 2, (40, 100), chunk, bits)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    found = sorted(str([*r]) for r in got.collect())
    assert found == brute(rows, [t for _, t in target], 50, 2, (40, 100))


def test_repeated_rows_take_consecutive_ranks(spark, documents):
    bench = spark.createDataFrame([("a", "b b")], "item_id string, text string")
    got = im.resample(documents([(3, "b b")] * 5 + [(4, "c c c")]), bench, 10, 1, 2, (100, 100), 2, 4).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1


def test_no_rows(spark, documents):
    bench = spark.createDataFrame([], "item_id string, text string")
    assert im.resample(documents([]), bench).collect() == []
    few = im.resample(documents([(1, "a b"), (2, None)]), bench).collect()
    assert [r["rank"] for r in few] == [None, None]


def test_ranks_are_stable_and_whole(spark):
    rng = random.Random(1)
    rows = [(rng.randint(-5, 5), rng.choice([-(2**63), -1, 0, 7, 2**63 - 1]), k) for k in range(300)]
    frame = spark.createDataFrame(rows, "high long, low long, id long").repartition(3)
    ranks = {r["id"]: r["rank"] for r in im.radix_ranks(frame, 32, 5).collect()}
    assert sorted(ranks.values()) == list(range(1, 301))
    ordered = sorted(rows, key=lambda r: ranks[r[2]])
    assert [r[:2] for r in ordered] == sorted(r[:2] for r in rows)


def test_words_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(im, "PIECE", 5)
    raw = b"ab cdefghijkl  m " + b"n" * 12
    pieces = list(im._pieces(raw))
    assert b"".join(pieces) == raw and len(pieces) == 2
    table = im.Buckets(1000)
    assert [b for p in pieces for b in table.of(p) if b >= 0] == [b for b in table.of(raw) if b >= 0]
