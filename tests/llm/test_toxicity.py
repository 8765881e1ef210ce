"""Neighbours equal to a scan of all examples, held-out accuracy, odd inputs."""

from collections import namedtuple

import numpy as np
from fitloom.llm import toxicity
from fitloom.llm.queries import op5_toxicity

Row = namedtuple("Row", "doc_id y at n")


def test_block_bounds_lose_no_neighbour():
    rng = np.random.default_rng(2)
    rows = [Row(i, int(rng.integers(2)), sorted(rng.choice(60, rng.integers(1, 9), replace=False).tolist()), None) for i in range(900)]
    rows = [r._replace(n=rng.integers(1, 5, len(r.at)).tolist()) for r in rows]
    model = toxicity.fit(rows, rng.random(60) + 1, {0: 2.0, 1: 1.0})
    flat = model.lanes[model.rows].reshape(60, -1)
    for _ in range(200):
        at = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = model.vector(at, rng.integers(1, 5, len(at)))
        spot, cosines = model.nearest(at, w, 10)
        every = w @ flat[at]
        want = [i for i in np.lexsort((np.arange(len(every)), -every)) if every[i] > 0][:10]
        assert np.allclose(cosines, every[want], atol=1e-6)
        assert (every[spot] >= every[want].min() - 1e-6).all() and len(set(spot.tolist())) == len(want)


def test_slices_change_no_term(monkeypatch):
    text = "Ünïcode words, and sömé plain ones; x yz! " * 60
    whole = sorted(np.concatenate(list(toxicity.term_codes(text))).tolist())
    for size in (1, 3, 7, 50):
        monkeypatch.setattr(toxicity, "SLICE", size)
        assert sorted(np.concatenate(list(toxicity.term_codes(text))).tolist()) == whole


def codes(text):
    return set(np.concatenate(list(toxicity.term_codes(text))).tolist())


def test_every_letter_is_read():
    for a, b in (("Kindergartenidiot", "Kindergartenfreund"), ("これはとても長い文章で終わりが違う", "これはとても長い文章で終わりが同じ"), ("abcdefghijk", "abcdefghijl")):
        assert codes(a) != codes(b)
    long = "kindergartenidiot"
    for i in range(len(long)):
        assert codes(long) != codes(long[:i] + "ß" + long[i + 1 :])
    assert codes("Kindergartenidiot") & codes("Superduperidiotentum")


def test_one_of_similar_examples_counts():
    rows = [(1, 5, [1, 2, 3, 4, 5]), (1, 6, [1, 2, 3, 4, 5, 6]), (0, 7, [1, 2, 3, 4, 5]), (1, 8, [1, 2]), (1, 9, []), (1, 10, [1, 9])]
    assert toxicity._unlike(rows[::-1]) == [(0, 7), (1, 5), (1, 8), (1, 9), (1, 10)]


def test_chances_are_those_of_the_exact_test():
    from itertools import combinations
    from math import comb, exp

    n0, n1 = 5, 4
    for a in range(n1 + 1):
        for b in range(n0 + 1):
            draws = list(combinations([1] * n1 + [0] * n0, a + b))
            want = sum(sum(d) >= a for d in draws) / len(draws) if a + b else 1.0
            got = float(toxicity.log_chance(np.array([a]), np.array([b]), n0, n1)[0])
            assert abs(exp(got) - want) < 1e-9 and len(draws) == comb(9, a + b)


def test_chosen_terms_scores_and_votes_by_brute_force(spark):
    """All steps again in plain Python: false discoveries, weights, neighbours, votes, calibration."""
    from math import comb, log

    rng = np.random.default_rng(5)
    common, bad = [f"plain{chr(97 + i)}" for i in range(14)], ["nitwit", "dolt", "oaf"]
    rows, labels = [], []
    for i in range(160):
        words = rng.choice(common, 12).tolist()
        if i % 4 == 0:
            words[3] = bad[i // 4 % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, y int")
    sample, _ = toxicity._sample(docs, marks)
    chosen = set(toxicity._chosen_terms(sample).codes.tolist())
    y, terms = dict(labels), {i: codes(t) for i, t in rows}
    seen = {}
    for i, own in terms.items():
        for c in own:
            seen.setdefault(c, [0, 0])[y[i]] += 1
    n1, n0 = sum(y.values()), len(y) - sum(y.values())

    def chance(b, a):
        return sum(comb(n1, k) * comb(n0, a + b - k) for k in range(a, a + b + 1) if k <= n1) / comb(n0 + n1, a + b)

    least = next(k for k in range(2, n1) if chance(0, k) <= 0.05)
    p = {c: chance(*n) for c, n in seen.items() if sum(n) >= least}
    steps = {c: int(np.ceil(round(log(v) * 64, 9))) for c, v in p.items()}
    cut = max((s for s in steps.values() if np.exp(s / 64) <= 0.05 * sum(t <= s for t in steps.values()) / len(p)), default=None)
    want = {c for c, s in steps.items() if s <= cut and seen[c][1] >= 2 and seen[c][1] * n0 > 4 * (seen[c][0] + 0.5) * n1}
    assert chosen == want and want
    scores = {r.doc_id: r.score for r in toxicity.score(docs, marks).collect()}
    at = {i: sorted(own & chosen) for i, own in terms.items()}
    df = {c: sum(c in own for own in terms.values()) for c in chosen}

    def vector(i):
        n = np.concatenate(list(toxicity.term_codes(dict(rows)[i]))).tolist()
        w = {c: (1 + log(n.count(c))) * (log((len(rows) + 1) / (df[c] + 1)) + 1) for c in at[i]}
        size = sum(v * v for v in w.values()) ** 0.5 or 1.0
        return {c: v / size for c, v in w.items()}

    vectors = {i: vector(i) for i in y if at[i]}
    empty = [i for i in y if not at[i]]
    base = (sum(y[i] for i in empty) + 0.5) / (len(empty) + 1.0)

    def vote(i, out):
        near = sorted(((sum(vectors[i][c] * w.get(c, 0.0) for c in vectors[i]), j) for j, w in vectors.items() if j != out), reverse=True)
        near = [n for n in near if n[0] > 1e-9][:25]
        w = [(c / (1 + ((1 - min(c, 1.0)) / (1 - toxicity.HALF_VOTE)) ** 2), y[j]) for c, j in near]
        return (sum(a * b for a, b in w) + toxicity.PULL * base) / (sum(a for a, _ in w) + toxicity.PULL)

    # all neighbours are of label 1 here, so which of equal cosines are taken changes nothing
    assert {y[i] for i in vectors} == {1}
    assert all(abs(scores[i] - base) < 1e-6 for i in empty)
    assert all(scores[i] >= 0.7 and vote(i, None) > 0.7 for i in vectors)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op5_toxicity(spark, folder).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic == 1], [r for r in held if r.toxic == 0]
    assert toxic and clean
    assert sum(r.predicted for r in clean) <= 0.005 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, score string, at double")


def test_odd_rows(spark):
    bad, good = "you horrible nitwit number {}", "a pleasant walk along river {}"
    rows = [(i, (bad if i % 2 else good).format("abcdefgh"[i % 8] * 3)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "nitwit nitwit horrible"), (102, "nitwit nitwit horrible"), (None, "horrible nitwit"), (103, "river " * 300_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (3, None), (None, 1), (7, 5)], "doc_id long, y int")
    docs = documents(spark, rows)
    got = {}
    for r in toxicity.score(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert len(got[102]) == 2 and min(got[102]) >= 0.7 and got[None][0] >= 0.7
    assert got[100] == got[101] and got[100][0] < 0.7 and got[103][0] < 0.7
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 102 not in ids and None not in ids and {100, 101, 103} <= set(ids) and not any(i % 2 for i in ids if i < 40)


def test_no_rows_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, y int")
    docs = documents(spark, [(1, "any text at all")])
    assert [r.score for r in toxicity.score(docs, labels).collect()] == [0.5]
    assert toxicity.without_toxic(docs, labels).count() == 1
    assert toxicity.score(docs.where("false"), labels).collect() == []
