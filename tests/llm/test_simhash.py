"""SimHash groups against brute force, and the defined results of odd inputs."""

import random
from itertools import combinations

import pyarrow.parquet as pq
import pytest
import xxhash
from fitloom.llm import simhash
from fitloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, values, radius):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(ids)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            root[find(j)] = find(i)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(ids))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


def test_whole_table_equals_brute_force(spark, folder):
    from fitloom.llm.queries import op1_simhash

    table = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    values = [plain_fingerprint(t) for t in table["text"]]
    want = dict(zip(table["doc_id"], plain_groups(table["doc_id"], values, 3), strict=True))
    got = op1_simhash(spark, folder).collect()
    assert len(got) == len(values)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(zip(table["doc_id"], values, strict=True))


@pytest.mark.parametrize("bound", [8, 4096])
def test_split_shards_and_chains_equal_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(simhash, "TREE_NODES", bound)
    rng, values = random.Random(5), []
    for _ in range(4):
        v = rng.getrandbits(64)
        for _ in range(25):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            values.append(v)
    values = sorted(set(values))
    fps = spark.createDataFrame([(v.to_bytes(8, "big"),) for v in values], "fp binary")
    links = simhash.linked(fps, simhash.pigeonhole_shards(3, 5), 3)
    roots = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in connected_components(links).collect()}
    assert [roots.get(v, v) for v in values] == plain_groups(values, values, 3)


def test_tree_search_finds_what_a_scan_finds():
    rng = random.Random(1)
    base = rng.getrandbits(64)
    values = list({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(300)})
    tree, words = simhash.BKTree(values), simhash._words([v.to_bytes(8, "big") for v in values])
    many = {(at, int(q)) for at, hits in tree.search_all(words, words, 3) for q in hits}
    scan = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if (a ^ b).bit_count() <= 3}
    assert many == scan
    assert {(i, q) for q, v in enumerate(values) for i in tree.search(v, 3)} == scan


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (7, "One"), (8, "one"), (1, long), (2, long), (2, long), (None, "one"), (4, "cafÉ x y z")]
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted([("5", 3), ("3", 3), ("9", 3), ("7", 7), ("8", 7), ("None", 7), ("1", 1), ("2", 1), ("2", 1), ("4", 4)])
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.near_duplicates(frame(spark, [(None, "a")])).first().component_id is None


def test_columns_with_the_operator_s_own_names(spark):
    df = spark.createDataFrame([(1, "a b c d", b"x", 2, 3), (2, "a b c d", b"y", 4, 5)], "doc_id long, text string, fp binary, component_id long, first long")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()} == {(1, 1), (2, 1)}


def test_one_of_each_group_stays(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    near = list(base)
    near[200] = "changed"
    other = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(4, " ".join(base)), (2, " ".join(near)), (6, " ".join(base)), (6, " ".join(base)), (9, " ".join(other)), (9, " ".join(other)), (None, " ".join(base))]
    kept = simhash.keep_one_of_each(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 9, None]


@pytest.mark.parametrize("pieces", [1, 3, 256])
def test_only_sets_that_are_similar_enough_are_near_copies(spark, monkeypatch, pieces):
    monkeypatch.setattr(simhash, "PIECE_SETS", pieces)
    rng, rows = random.Random(12), []
    for k in range(60):  # changed words cost five shingles each: similarities from 0.6 to 0.95
        n = rng.choice([7, 12, 40, 150, 400])
        base = [f"w{rng.randrange(9000)}" for _ in range(n)]
        for i in range(4):
            near = list(base)
            for at in rng.sample(range(n), rng.randint(0, max(1, n // 25))):
                near[at] = f"x{rng.randrange(9000)}"
            rows.append((10 * k + i, " ".join(near[rng.randint(0, 1) :])))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    roots = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                roots = [min(roots[i], roots[j]) if r in (roots[i], roots[j]) else r for r in roots]
    kept = {r.doc_id for r in simhash.keep_one_of_each(frame(spark, rows)).collect()}
    assert kept == {rows[r][0] for r in roots} and 60 < len(kept) < 220


def test_a_unique_text_under_a_repeated_id_stays(spark):
    rng = random.Random(13)
    a, b, c = (" ".join(f"w{rng.randrange(5000)}" for _ in range(100)) for _ in range(3))
    rows = [(1, a), (2, a + " end"), (2, b), (3, b), (4, c), (4, c + " end"), (4, a)]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(frame(spark, rows)).collect())
    assert [r[0] for r in kept] == [1, 2, 4] and kept[:2] == [(1, a), (2, b)] and kept[2][1].startswith(c)
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(frame(spark, rows[::-1])).collect()) == kept


@pytest.mark.parametrize("rounds", [1, 3])
def test_large_groups_of_near_copies_are_connected_whole(spark, monkeypatch, rounds):
    """Copies of two similar bases, and chains away from them, in one loose group of many pieces."""
    monkeypatch.setattr(simhash, "PIECE_SETS", 5)
    monkeypatch.setattr(simhash, "ROUNDS", rounds)
    rng, rows = random.Random(21), []
    base = [f"w{rng.randrange(9000)}" for _ in range(200)]
    other = list(base)
    for at in range(10, 190, 30):  # far from the base: 6 changes cost 30 shingles
        other[at] = f"y{at}"
    for k in range(60):
        near = list(other if k % 3 == 0 else base)
        for at in rng.sample(range(200), rng.randint(0, 7)):
            near[at] = f"x{rng.randrange(9000)}"
        rows.append((k, " ".join(near)))
    chain = list(base)
    for k in range(12):
        for at in rng.sample(range(200), 3):
            chain[at] = f"z{k}{at}"
        rows.append((100 + k, " ".join(chain)))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    roots = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                roots = [min(roots[i], roots[j]) if r in (roots[i], roots[j]) else r for r in roots]
    kept = {r.doc_id for r in simhash.keep_one_of_each(frame(spark, rows)).collect()}
    assert kept == {rows[r][0] for r in roots} and 1 < len(kept) < 40


def test_near_copies_of_odd_rows(spark):
    long = " ".join(f"w{i % 9973}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, long), (5, long + " end"), (6, "few words"), (7, "Few Words"), (None, "few words")]
    docs = spark.createDataFrame([(*r, b"x", "y", 1) for r in rows], "doc_id long, text string, fp binary, set string, first int")
    kept = simhash.keep_one_of_each(docs)
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "4", "6", "None"] and kept.columns == docs.columns
    assert simhash.keep_one_of_each(docs.where("false")).collect() == []
