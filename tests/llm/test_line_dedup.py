import random

import pytest

from pricegrid.llm import line_dedup


def tokens(line):
    w = [x for x in line.split(" ") if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, text) -> lines that stay, and numbers of the others, by comparing every pair."""
    seen, places = set(), []
    for i, t in rows:
        if (i, t or "") in seen:
            continue
        seen.add((i, t or ""))
        places += [((i is not None, i or 0), t or "", k, x) for k, x in enumerate((t or "").split("\n"))]
    first = {}
    for i, t, k, x in places:
        if tokens(x):
            first[x] = min(first.get(x, (i, k)), (i, k))
    gone = {}
    for i, t, k, x in places:
        a = tokens(x)
        if not a:
            continue
        near = any(
            first[y] < first[x] and y != x and 100 * len(a & b) >= 75 * len(a | b) for y in first if (b := tokens(y)) & a
        )
        if near or (i, k) != first[x]:
            gone.setdefault((i[1] if i[0] else None, t), set()).add(k)
    out = {}
    for i, t in rows:
        lost = gone.get((i, t or ""), set())
        out[(i, t)] = [x for k, x in enumerate((t or "").split("\n")) if k not in lost], lost
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    base = [rng.choices(vocabulary, k=rng.randint(3, 50)) for _ in range(14)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(base))
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


EDGES = [
    (500, None), (501, ""), (502, "\n\n"), (503, "a b c d"), (504, "a b c d"), (505, "p q r s t"), (506, "p  q r s t "),
    (507, "k l m n o\nk l m n o\nshort"), (507, "k l m n o\nk l m n o\nshort"), (None, "n1 n2 n3 n4 n5"), (508, "n1 n2 n3 n4 n5"),
    (509, " ".join(f"v{k}" for k in range(20_000))), (510, "x\n" + " ".join(f"v{k}" for k in range(19_500))),
]


@pytest.mark.parametrize("seed,many,carried", [(1, 32, 256), (2, 3, 256), (3, 3, 20)])
def test_lines_equal_brute_force(spark, documents, seed, many, carried, monkeypatch):
    monkeypatch.setattr(line_dedup, "MANY", many)
    monkeypatch.setattr(line_dedup, "CARRIED", carried)
    rows = corpus(seed) + EDGES
    want = brute(rows)
    report = line_dedup.line_report(documents(rows).repartition(4)).collect()
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.removed) for r in report)
    expected = []
    for i, t in rows:
        lines, gone = (t or "").split("\n"), sorted(want[(i, t)][1])
        expected.append((str(i), len(lines), len(gone), gone))
    assert got == sorted(expected)
    texts = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(documents(rows).repartition(4)).collect()}
    for i, t in rows:
        keep = want[(i, t)][0]
        if not want[(i, t)][1] or any(keep):
            assert (i, None if t is None else "\n".join(keep)) in texts


def test_documents_keep_their_columns_and_emptied_ones_go(spark, documents):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, ""), (5, "a b c d e f\none two three four five six")]
    done = line_dedup.dedup_lines(documents(rows))
    assert done.columns == documents([]).columns
    got = {r.doc_id: r for r in done.collect()}
    assert {k: r.text for k, r in got.items()} == {1: rows[0][1], 3: None, 4: "", 5: "a b c d e f"}
    assert got[5].n_chars == 11 and got[3].n_chars is None and got[1].score == 0.5


def test_empty_table(spark, documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_no_python_in_the_plan(spark, documents, capsys):
    line_dedup.line_report(documents(EDGES)).explain()
    assert "Python" not in capsys.readouterr().out and "Arrow" not in capsys.readouterr().out


def test_short_lines_and_clashing_names(spark, documents):
    rows = [(1, "Home\nAbout us\n \none two three four five"), (2, "About  us\nHome\nhome\n\n"), (3, "Home"), (4, "Home\nand more here")]
    docs = documents(rows).withColumnRenamed("score", "gone").withColumnRenamed("node", "__id").withColumnRenamed("source", "d")
    done = line_dedup.dedup_lines(docs)
    assert done.columns == docs.columns
    assert {r.doc_id: r.text for r in done.collect()} == {1: rows[0][1], 2: "home\n\n", 4: "and more here"}


def test_candidates_are_all_similar_lines_and_few_others(spark, documents):
    """One shared run of function words among many tokens makes no candidate."""
    rng = random.Random(5)
    words = lambda n: [f"{rng.randrange(10**9):09d}" for _ in range(n)]
    base = words(80)
    near = [" ".join(base), " ".join(base[:-3]), " ".join(base[2:])]
    loose = [" ".join([*words(40), *"to the end of it".split(), *words(40)]) for _ in range(6)]
    docs = documents([(k, x) for k, x in enumerate(near + loose)])
    lines = line_dedup._lines(docs)
    with line_dedup.ExitStack() as held:
        keys = line_dedup._candidates(line_dedup._prefixes(lines), held)
        got = {r.line for r in lines.join(keys, "line_key").collect()}
    assert got == set(near)
    report = line_dedup.line_report(docs).collect()
    assert {r.doc_id for r in report if r.n_removed} == {1, 2}
