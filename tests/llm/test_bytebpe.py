"""Byte-level BPE against the public library."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
from fitloom.llm import bytebpe
from fitloom.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bytebpe.read_ranks(PATH), special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), sha256((text or "").encode()).hexdigest()


def ids(coder, text):
    return [int.from_bytes(x[i : i + 4], "little") for _, x in coder.encode([text]) for i in range(0, len(x), 4)]


def test_query_equals_library(spark, library):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_bytebpe"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: digests(library, r.text) for r in rows} and len(got) == 1000


@pytest.mark.parametrize("cells", [64, 1 << 20])
def test_random_strings(library, monkeypatch, cells):
    monkeypatch.setattr(bytebpe, "CELLS", cells)
    monkeypatch.setattr(bytebpe, "BUCKETS", (4, 8, 24))
    monkeypatch.setattr(bytebpe, "MATCHES", 7)
    monkeypatch.setattr(bytebpe, "KEPT", 50)
    coder, rng = bytebpe.Coder(bytebpe.read_ranks(PATH), PATTERN), random.Random(5)
    letters = "aaabcdeinorst  \n\t'012éßжщ私の日本😀<| \x85\x1c "
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        assert ids(coder, text) == library.encode_ordinary(text)
    for text in ("a" * 300, "ab" * 200, "'s 't 'll", "<|endoftext|>", "x" * 23 + "é" * 40):
        assert ids(coder, text) == library.encode_ordinary(text)


def test_long_match(library):
    coder, rng = bytebpe.Coder(bytebpe.read_ranks(PATH), PATTERN), random.Random(6)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKL", k=200_000))
    assert ids(coder, text) == library.encode_ordinary(text)


def test_pair_table_knows_every_split():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258}
    table = bytebpe.PairTable(ranks)
    left, right = bytebpe.np.array([97, 98, 256, 97, 97, -1, 97]), bytebpe.np.array([98, 99, 99, 257, 97, 97, -1])
    assert table.ranks(left, right).tolist() == [256, 257, 258, 258, *[int(bytebpe.NEVER)] * 3]


def test_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "ab", "x"), (3, "word " * 300_000, "x"), (4, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.round_trip(docs, PATH, PATTERN).collect()))
    assert got == sorted((i or 0, *digests(library, t)) for i, t, _ in rows)
    tokens = bytebpe.encoded(docs, PATH, PATTERN)
    assert sorted(map(len, (r.ids for r in tokens.collect())))[:3] == [0, 0, 0]
    back = {r.doc_id: bytes(r.bytes).decode() for r in bytebpe.decoded(tokens, PATH, PATTERN).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert bytebpe.round_trip(docs.where("false"), PATH, PATTERN).collect() == []
