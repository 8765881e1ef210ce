"""Encodings equal to the library's, however texts are cut into chunks, and exact round trips."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from fitloom.llm import sentencepiece as ours
from fitloom.llm.queries import SENTENCEPIECE_MODEL as PATH
from fitloom.llm.queries import op7_sentencepiece

library = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return ours.load(PATH)


@pytest.fixture(scope="module")
def public():
    return library.SentencePieceProcessor(model_file=PATH)


def random_texts(model, n, seed):
    rng, pieces = random.Random(seed), [p.replace(ours.SPACE, " ") for p in model.ids if len(p) < 7]
    for k in range(n):
        if k % 2:
            yield "".join(rng.choice("aaabbnoté  \n한中xX.,😀") for _ in range(rng.randint(0, 80)))
        else:
            yield "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))


def test_random_texts_equal_the_library(model, public):
    for text in random_texts(model, 1500, 1):
        assert model.encode(text).tolist() == public.encode(text), text


def test_word_marks_of_a_text_come_back(model, public):
    for text in ("a▁b", "▁", " ▁ ▁▁x", "  "):
        assert model.decode(model.encode(text)) == text
        assert public.decode(model.encode(text).tolist()) == text


def test_rows_encoded_together_equal_the_library(public, monkeypatch):
    """stretches of up to SHORT characters are not walked one by one, whatever is kept of them and their pairs."""
    monkeypatch.setattr(ours, "KEPT_PAIRS", 300)
    model = ours.Model(PATH)
    model.kept = 50
    walked, plain = [], ours.Model._onward
    monkeypatch.setattr(ours.Model, "_onward", lambda self, text, start, *a: walked.append(len(text)) or plain(self, text, start, *a))
    solid = "".join(random.Random(6).choice("aothen") for _ in range(500))
    texts = [*random_texts(model, 600, 5), "", solid, "x" * 64, "한" * 70, "\n\n \r\t a", "a" * 65, *random_texts(model, 300, 5)]
    for at in range(0, len(texts), 90):
        rows = model.rows(texts[at : at + 90])
        ids, bounds = model.encode_rows(rows)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [public.encode(t) for t in texts[at : at + 90]]
        assert model.decodes(ids, bounds, rows) == [True] * len(rows)
        other = [r + b"." for r in rows]
        assert not any(model.decodes(ids, bounds, other))
    assert walked and min(walked) > ours.SHORT


@pytest.mark.parametrize("letters", ["aonthe", "aaaaab", "thequi ck", "a中b\n"])
def test_matrices_and_traces_at_any_cut_give_the_whole_encoding(model, letters):
    rng = random.Random(len(letters))
    for _ in range(12):
        text = model.prepared("".join(rng.choice(letters) for _ in range(150)))
        cuts = [0, *sorted(rng.sample(range(40, len(text) - 40, 7), 2)), len(text)]
        matrices = [model.transfer(text, a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        whole = matrices[0]
        for m in matrices[1:]:
            whole = ours.max_plus(whole, m)
        assert (whole == 0).sum() == 1
        found = ours.border_states(matrices)
        states = [model.states(text, c)[i] for c, i in zip(cuts, found, strict=True)]
        ids = b"".join(model.traced(text, a, b, s, t) for a, b, s, t in zip(cuts, cuts[1:], states, states[1:], strict=False))
        assert np.frombuffer(ids, np.int32).tolist() == np.frombuffer(model.numbers(model.trace(model.path(text, 0, "", len(text)), len(text))), np.int32).tolist()


def test_giant_and_odd_texts(spark, model, public, monkeypatch):
    monkeypatch.setattr(ours, "CHUNK", 400)
    rng = random.Random(4)
    long = "".join(rng.choice(["the", "on", " ", "\n", "xyz", "é"]) for _ in range(3000))
    solid = "".join(rng.choice("aothen") for _ in range(3000))
    marks = "▁a " * 700
    rows = [(1, long), (2, solid), (3, marks), (4, None), (5, ""), (None, "x y"), (1, long), (6, " " * 900)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, row long")
    got = ours.encoded(df, PATH).collect()
    assert len(got) == len(rows) and all(r.exact for r in got)
    by_id = {r.doc_id: r.ids for r in got}
    assert by_id[1] == public.encode(long) and by_id[2] == public.encode(solid) and by_id[6] == public.encode(" " * 900)
    assert by_id[4] == by_id[5] == [] and by_id[None] == public.encode("x y")
    assert model.decode(np.array(by_id[3], np.int32)) == marks
    assert ours.encoded(df.where("false"), PATH).collect() == []


def test_query_equals_the_library(spark, folder, public):
    texts = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    want = {i: public.encode(t) for i, t in zip(texts["doc_id"], texts["text"], strict=True)}
    got = op7_sentencepiece(spark, folder).collect()
    assert {r.doc_id: r.ids for r in got} == want and all(r.exact and r.n_tokens == len(r.ids) for r in got)
