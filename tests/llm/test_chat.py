"""Formatted turns read back exactly; digests against the plain rule; parts and odd inputs."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest
from fitloom.llm import chat
from fitloom.llm.queries import op8_chat
from pyspark.sql import functions as F


def plain(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] if r[1] is not None else -(10**9))):
        n, turns, loss = out.get(conv, (0, "", ""))
        text = text or ""
        out[conv] = (n + 1, turns + f"{role or ''}\n{text}\n", loss + (text if role == "assistant" else ""))
    return {c: (n, hashlib.sha256(t.encode()).hexdigest(), len(x), hashlib.sha256(x.encode()).hexdigest()) for c, (n, t, x) in out.items()}


def found(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query_equals_the_plain_rule(spark, folder):
    t = pq.read_table(f"{folder}/conversations.parquet").to_pydict()
    rows = list(zip(t["conv_id"], t["turn"], t["role"], t["text"], strict=True))
    marked = "</s>[INST] ok [/INST]"
    assert found(op8_chat(spark, folder)) == plain([*rows, (-1, 0, "user", marked), (-1, 1, "assistant", marked)])


def test_any_text_comes_back():
    rng = random.Random(1)
    parts = ["<|", "|>", "<\\|", "\\", "<", "|", chat.TURN, chat.BODY, chat.END, "</s>", "<s>", "[INST]", "[/INST]", "[\\/INST]", "<<SYS>>", "<</SYS>>", "<|image 1|>", "é", "\n", "x"]
    for _ in range(5000):
        text, role = ("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2))
        v = chat.Visitor()
        v.visit({"kind": "text", "text": text})
        formatted = v.formatted(role)
        assert chat.unescape(chat.escape(text)) == text
        assert [(r, t) for r, t, _, _ in chat.read_back(formatted)] == [(role, text)], text
        inside = chat.escape(text)
        assert not any(c in inside for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_parts_become_placeholders(spark):
    parts = [("text", "see <|", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("text", "| and", None, None, None, None, None),
             ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, None, None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = sorted(chat.formatted_turns(df).collect(), key=lambda r: r.turn)
    assert rows[0].formatted == f"{chat.TURN}assistant{chat.BODY}see <\\|<|image 1|>| and<|audio 2|><|document 3|>{chat.END}"
    assert [(a.n, a.kind, a.ref, a.tokens) for a in rows[0].attachments] == [(1, "image", "a.png", 4), (2, "audio", "b.wav", 38), (3, "document", "c.pdf", 768)]
    assert rows[0].loss and not rows[1].loss and rows[1].attachments == []
    assert [(r, t) for r, t, _, _ in chat.read_back(rows[0].formatted + rows[1].formatted)] == [("assistant", "see <|| and"), ("", "")]
    done = chat.digests(chat.formatted_turns(df)).first()
    assert done.attachment_tokens == 810 and done.n_turns == 2
    with pytest.raises(ValueError, match="unknown part"):
        chat.Visitor().visit({"kind": "video"})


def test_odd_rows(spark):
    long = "<|end|> word " * 100_000
    rows = [(1, 2, "assistant", None), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 0, None, long), (None, 0, "assistant", "lost"), (None, 1, "user", ""), (3, None, "assistant", "b"), (3, 0, "assistant", "c")]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, formatted string, loss boolean")
    turns = chat.formatted_turns(df.withColumn("parts", chat.text_part(F.col("text"))))
    assert found(chat.digests(turns)) == plain(rows)
    assert chat.digests(turns.where("false")).collect() == []
