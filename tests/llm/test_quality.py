import random

import numpy as np
from pyspark.sql import functions as F

from pricegrid.llm import quality


def corpus(n=700, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(20, 90))]
        text = ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)) + "."
        if not good:
            text = rng.choice([" ".join([words[0]] * 60), text.upper().replace(" ", "!! "), text.replace(" ", "$$$ ")])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def run(spark, docs, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return quality.quality(docs, frame, F.col("source"), F.col("lang"))


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    truth = {i: q for i, q, _ in labels}
    got = run(spark, documents(rows), labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows)
    assert np.mean([int(r.keep) == truth[r.doc_id] for r in held]) > 0.95


def test_odd_rows(spark, documents, by_id):
    rows, labels = corpus(300)
    extra = [(9001, None), (9002, ""), (None, rows[0][1]), (0, rows[1][1]), (9003, "word " * 50_000)]
    docs = documents(rows + extra).withColumn("lang", F.when(F.col("doc_id") != 7, F.col("lang")))
    got = by_id(run(spark, docs, labels + [(1, None, 0), (None, 1, 0), (2, 1, 0), (2, 0, 0)]))
    assert len(got[0]) == 2 and len(got[None]) == 1 and got[7][0].path == ""
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)


def test_empty_tables(spark, documents):
    assert run(spark, documents([]), []).count() == 0
    assert run(spark, documents([(1, "a b c")]), []).count() == 1


def test_sparse_sites_shrink_to_their_parents(spark):
    rng = random.Random(5)
    rows = []
    for host, mean, n in (("good", 0.9, 400), ("bad", 0.2, 400), ("mid", 0.6, 400)):
        for path, shift in (("a", 0.05), ("b", -0.05)):
            rows += [(host, path, min(1.0, max(0.0, rng.gauss(mean + shift, 0.1)))) for _ in range(n)]
    rows += [("bad", "new", 1.0), ("unknown", "x", 1.0)]
    got = {(r.host, r.path): r for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(got["good", "a"].path_mean - 0.95) < 0.06 and abs(got["bad", "b"].path_mean - 0.15) < 0.06
    assert got["bad", "new"].path_mean < 0.6  # one document says little against its host
    assert got["unknown", "x"].path_mean < 0.97
    assert got["bad", "new"].path_mean < got["unknown", "x"].path_mean


def plain_posteriors(rows):
    """The other documents' posterior of each row's path, written out plainly."""
    mean = lambda v: sum(v) / len(v)

    def noise(v):
        return (mean([x * x for x in v]) - mean(v) ** 2) / len(v)

    def strength(between, m):
        return min(max(m * (1 - m) / max(between, 1e-9) - 1, quality.LEAST_STRENGTH), quality.MOST_STRENGTH)

    hosts, paths = {}, {}
    for host, path, p in rows:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    every, n = [p for _, _, p in rows], len(rows)
    g = mean(every)
    k = strength(sum(len(v) * (mean(v) - g) ** 2 - len(v) * noise(v) for v in hosts.values()) / n, g)
    spread = sum(len(v) * ((mean(v) - mean(hosts[h])) ** 2 - noise(v)) for (h, _), v in paths.items()) / n
    kp = strength(spread, g)
    out = []
    for host, path, p in rows:
        others, near = list(hosts[host]), list(paths[host, path])
        others.remove(p), near.remove(p)
        host_mean = (sum(others) + k * g) / (len(others) + k)
        out.append((sum(near) + kp * host_mean) / (len(near) + kp))
    return out


def test_posteriors_of_the_other_documents(spark):
    rng = random.Random(8)
    rows = []
    for h in range(6):
        for path in range(rng.randint(1, 4)):
            rows += [(f"h{h}", f"p{path}", round(rng.random() * (0.3 + 0.1 * h), 3)) for _ in range(rng.randint(1, 30))]
    rows += [("alone", "x", 0.99), ("h0", "p0", 0.5), ("h0", "p0", 0.5)]
    shape = "no int, host string, path string, p double"
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], shape)
    placed = frame.join(quality.site_posteriors(frame), ["host", "path"])
    got = dict(placed.select("no", quality.without_own(F.col("p"))).collect())
    want = plain_posteriors(rows)
    assert len(got) == len(rows) and max(abs(got[k] - w) for k, w in enumerate(want)) < 1e-9
    # a site's only document says nothing about its site
    alone = len(rows) - 3
    assert abs(got[alone] - sum(r[2] for r in rows) / len(rows)) < 1e-9


def test_scores_contain_the_site(spark, documents, by_id):
    rows, labels = corpus(300)
    docs = documents(rows).withColumn("source", F.when(F.col("doc_id") < 150, "s").otherwise(F.concat(F.lit("t"), "doc_id")))
    got = by_id(run(spark, docs, labels))
    sites = [r[0].site_score for k, r in got.items() if k >= 150]
    assert max(sites) - min(sites) < 1e-9 and any(abs(r[0].site_score - sites[0]) > 1e-6 for k, r in got.items() if k < 150)
