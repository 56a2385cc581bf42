import random

import numpy as np

from pricegrid.llm import toxicity

WORDS = [f"word{k}" for k in range(80)]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 60))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zork" + rng.choice("abcdefgh") * 3]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def as_labels(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    truth = {i: t for i, _, t in labels}
    got = toxicity.toxicity(documents(rows), as_labels(spark, labels)).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and len(held) > 200
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark, documents):
    import zlib

    rows, labels = corpus(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a = {r.doc_id: r.score for r in toxicity.toxicity(documents(rows), as_labels(spark, labels)).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(documents(rows), as_labels(spark, flipped)).collect()}
    assert a == b


def test_odd_rows(spark, documents, by_id):
    rows, labels = corpus(300)
    extra = [(9001, None), (9002, ""), (None, "you idiot"), (9003, "word1 " * 30_000), (5, "again"), (9004, "IDIOT!")]
    labels += [(9001, None, None), (3, 1, None), (4, 1, 1), (4, 1, 0), (None, 1, 1)]
    got = by_id(toxicity.toxicity(documents(rows + extra), as_labels(spark, labels)))
    assert len(got[5]) == 2 and got[None][0].predicted == 1 and got[9004][0].predicted == 1
    assert {got[k][0].predicted for k in (9001, 9002, 9003)} == {0}
    assert got[9001][0].score == got[9002][0].score


def test_without_labels_or_documents(spark, documents):
    none = as_labels(spark, [])
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(documents([(1, "you idiot"), (2, "fine")]), none).collect()}
    assert got == {1: 1, 2: 0}
    assert toxicity.toxicity(documents([]), none).count() == 0


def test_no_documents_to_learn_from(spark, documents):
    rows, labels = corpus(300)
    marks = as_labels(spark, labels)
    assert toxicity.toxicity(documents([]), marks).count() == 0
    assert toxicity.without_toxic(documents([]), marks).count() == 0
    learned = set(learned_from(300, 0))
    only_held_out = [(i, t) for i, t in rows if i not in learned] + [(40_000, None)]
    only_held_out = [r for r in only_held_out if r[0] not in set(learned_from(1, r[0]))]
    got = toxicity.toxicity(documents(only_held_out), marks).collect()
    assert len(got) == len(only_held_out) and all(0 <= r.score <= 1 and r.held_out for r in got)


def test_bounds_are_parameters(spark, documents):
    rows, labels = corpus(600)
    model = toxicity.fit(documents(rows), as_labels(spark, labels), entries_most=3, groups=50)
    assert len(model.lexicon) <= 3


def test_filter_keeps_columns(spark, documents):
    rows, labels = corpus(300)
    docs = documents(rows)
    kept = toxicity.without_toxic(docs, as_labels(spark, labels))
    assert kept.columns == docs.columns and 150 < kept.count() < 300


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(0)
    n, width = 6000, len(toxicity.VOTERS)
    truth = rng.random(n) < 0.3
    acc = [0.95, 0.8, 0.8, 0.7]
    votes = np.full((n, width), 2)
    for j, a in enumerate(acc):
        votes[:, j] = np.where(rng.random(n) < a, truth, ~truth)
    votes[:, 4] = votes[:, 5] = votes[:, 3]  # a weak voter three times
    counts = [("".join(map(str, v)), None, 1) for v in votes]
    model = toxicity.fit_label_model(counts)
    assert model.accuracy()[0] > model.accuracy()[1] > model.accuracy()[3] - 0.02
    assert model.say[3] < 0.5 < model.say[0]
    q = model.posterior(["".join(map(str, v)) for v in votes])
    assert np.mean((q > 0.5) == truth) > 0.93


def learned_from(docs, doc_id):
    """Identifiers whose labels are learned from, from ``doc_id`` on."""
    import zlib

    out = []
    while len(out) < docs:
        if zlib.crc32(str(doc_id).encode()) % 3 != 1:
            out.append(doc_id)
        doc_id += 1
    return out


def test_unlabelled_documents_teach_fixed_insults(spark, documents):
    rows, labels = corpus(600)
    rows = [(i, t.replace("idiot", "zorkaaa")) for i, t in rows]
    unlabelled = [(k, f"word{k % 80} zorkaaa zorkbbb zorkccc you moron word3") for k in learned_from(120, 20_000)]
    asked = [(90_001, "word1 word2 moron word5"), (90_002, "word1 word2 word5")]
    got = {r.doc_id: r for r in toxicity.toxicity(documents(rows + unlabelled + asked), as_labels(spark, labels)).collect()}
    # before, only entries learned from labels had a weight, and both scores were equal
    assert got[90_001].score > 10 * got[90_002].score


def test_few_labels_give_a_lexicon(spark, documents):
    ids = learned_from(130, 0)
    signs = ["qwert", "asdfg", "yxcvb", "poiuz", "lkjhg"]
    rows = [(i, f"word{k % 80} word{k % 7} {signs[k % 5] if k < 15 else ''}") for k, i in enumerate(ids)]
    labels = [(i, 1, int(k < 15)) for k, i in enumerate(ids)]
    model = toxicity.fit(documents(rows), as_labels(spark, labels))
    assert set(signs) <= set(model.lexicon)


def test_sure_votes_can_outvote_a_label():
    width = len(toxicity.VOTERS)
    fired, none = "1" * width, "2" * width
    model = toxicity.fit_label_model([(fired, 1, 500), (none, 0, 2000)])
    q = toxicity.soft_labels(model, [fired, none, fired], [1, 0, 0], np.array([500.0, 2000.0, 1.0]))
    assert q[0] > 0.99 and q[1] < 0.01 and q[2] > 0.5
