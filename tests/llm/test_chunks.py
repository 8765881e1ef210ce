"""Chunk borders, repeated passages against planted ones, odd inputs."""

import random

import numpy as np
import pytest
from fitloom.llm import chunks


def plain_borders(data):
    ends, last = [], 0
    for i in range(len(data)):
        h = sum(int(chunks._GEAR[data[i - j]]) << j for j in range(min(chunks.WINDOW, i + 1))) % 2**32
        if (h >> (32 - chunks.BITS) == 0 and i + 1 - last >= chunks.SHORTEST) or i + 1 - last == chunks.LONGEST:
            last = i + 1
            ends.append(last)
    return ends if not data or last == len(data) else [*ends, len(data)]


@pytest.mark.parametrize("size", [1 << 20, 50, 333])
def test_borders_are_those_of_the_plain_rule(monkeypatch, size):
    monkeypatch.setattr(chunks, "SLICE", size)
    rng = random.Random(size)
    for n in (0, 1, 15, 16, 17, 255, 256, 257, 700, 2000):
        for data in (bytes(rng.randrange(256) for _ in range(n)), b"a" * n):
            assert chunks.borders(data) == plain_borders(data)


def test_an_insertion_moves_few_borders():
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    other = data[:9000] + b"inserted" + data[9000:]
    a = {data[i:j] for i, j in zip([0, *chunks.borders(data)], chunks.borders(data), strict=False)}
    b = {other[i:j] for i, j in zip([0, *chunks.borders(other)], chunks.borders(other), strict=False)}
    assert len(a - b) <= 6


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def planted_rows(rng, shortest, longest):
    rows, planted = [], {}
    for k in range(40):
        passage = words(rng, rng.randint(shortest, longest))
        for i in (2 * k, 2 * k + 1):
            rows.append((i, f"{words(rng, rng.randint(0, 200))} {passage} {words(rng, rng.randint(0, 200))}"))
            planted[i] = (2 * k, passage)
    return rows + [(1000 + i, words(rng, 300) + " one short shared line of words") for i in range(30)], planted


def test_planted_passages_are_found_and_clean_texts_are_not(spark):
    rows, planted = planted_rows(random.Random(2), 90, 140)
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    assert {r.doc_id for r in got} == set(planted)
    for r in got:
        first, passage = planted[r.doc_id]
        assert r.first_doc_id == first and r.keep == (r.doc_id == first)
        assert texts[r.doc_id].encode()[r.start : r.end].decode().strip() in passage


def test_most_passages_just_over_fifty_words_are_found(spark):
    rows, planted = planted_rows(random.Random(4), 51, 70)
    got = {r.doc_id for r in chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= set(planted) and len(got) >= 0.9 * len(planted)


def test_odd_rows(spark):
    rng = random.Random(3)
    copy, long = words(rng, 60), words(rng, 20_000)
    rows = [(1, None), (2, ""), (3, copy), (4, copy), (4, copy), (5, long), (6, long), (7, words(rng, 100)), (None, copy)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, start string")
    got = sorted(((r.doc_id, r.first_doc_id, r.keep, r.words, r.end) for r in chunks.repeated_passages(df).collect()), key=str)
    n, m = len(copy.encode()), len(long.encode())
    want = [(3, 3, True, 60, n), (4, 3, False, 60, n), (4, 3, False, 60, n), (5, 5, True, 20_000, m), (6, 5, False, 20_000, m), (None, 3, False, 60, n)]
    assert got == sorted(want, key=str)
    assert chunks.repeated_passages(df.where("false")).collect() == []


def test_every_chunk_of_overlapping_passages_is_kept_once(spark):
    rng = random.Random(7)
    x, y = words(rng, 120), words(rng, 120)
    texts = {1: x, 2: f"{x} {y}", 3: y}
    got = chunks.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    kept, dropped = ({texts[r.doc_id].encode()[r.start : r.end] for r in got if r.keep == k and r.doc_id in (2, 3)} for k in (True, False))
    assert any(len(part) > len(y) // 2 and part.decode().strip() in y for part in kept)
    assert {(r.doc_id, r.keep) for r in got} == {(1, True), (2, False), (2, True), (3, False)}
    left = b"".join(texts[i].encode()[a:b] for i in texts for a, b in stays(texts[i], [r for r in got if r.doc_id == i and not r.keep]))
    cut = texts[2].encode()
    for a, b in zip([0, *chunks.borders(cut)], chunks.borders(cut), strict=False):
        assert left.count(cut[a:b]) >= 1


def stays(text, gone):
    ends = [0, *[e for r in sorted(gone, key=lambda r: r.start) for e in (r.start, r.end)], len(text.encode())]
    return list(zip(ends[::2], ends[1::2], strict=True))
