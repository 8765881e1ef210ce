"""CSV files with line ends inside fields, cut into records by many tasks a file."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitloom import sources as so
from fitloom.sources import csv_records

TYPES = {"id": T.LongType(), "text": T.StringType(), "x": T.DoubleType()}


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes: many a file, and many a long field."""
    names = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_csv(path, seed, n, end="\n"):
    rng = random.Random(seed)
    pick = lambda k: "".join(rng.choice(['a', 'ß', ',', '""', '\n', '\r\n', ' ', 'b\n\n']) for _ in range(k))
    lines = ["id,text,x"]
    for i in range(n):
        text = f'"{pick(rng.choice([0, 1, 3, 30]))}"' if rng.random() < 0.7 else rng.choice(["", "plain", " a ", "NA"])
        if i % 40 == 7:
            text = '"' + pick(900) + '"'
        lines.append(f"{i},{text},{rng.choice(['', '1.5', '-2'])}")
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode())
    return str(path)


def plainly(files):
    found = []
    for f in files:
        with open(f, newline="", encoding="utf-8") as lines:
            for i, text, x in list(csv.reader(lines))[1:]:
                found.append((int(i), None if text in so.MISSING_MARKERS else text, float(x) if x else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task_a_file(spark, tmp_path, small_blocks, end):
    files = [random_csv(tmp_path / f"{k}.csv", k, 120, end) for k in range(3)]
    got = so.read_csv(spark, files, TYPES, multi_line="split")
    assert rows(got) == plainly(files)
    if end == "\n":  # one task turns the line ends inside fields into those of the file
        assert rows(so.read_csv(spark, files, TYPES, multi_line=True)) == plainly(files)
    blocks = spark.read.text(files, lineSep="\n").select(F.spark_partition_id().alias("p")).distinct().count()
    assert blocks > 3 * len(files)


def test_blocks_that_meet_their_state_by_a_shuffle(spark, tmp_path, small_blocks, monkeypatch):
    files = [random_csv(tmp_path / f"{k}.csv", k, 80) for k in range(2)]
    monkeypatch.setattr(csv_records, "INLINE_BLOCKS", 0)
    assert rows(so.read_csv(spark, files, TYPES, multi_line="split")) == rows(so.read_csv(spark, files, TYPES, multi_line=True))


def test_inferred_types_and_mixed_headers(spark, tmp_path, small_blocks):
    one, two = tmp_path / "1.csv", tmp_path / "2.csv"
    one.write_text('id,t\n1,"a\nb"\n2,c\n' * 1)
    two.write_text('t,id\n"x\n\ny",3\n')
    got = so.read_csv(spark, [str(one), str(two)], mixed_headers=True, multi_line="split")
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"id": "bigint", "t": "string"}
    assert rows(got.select("id", "t")) == [(1, "a\nb"), (2, "c"), (3, "x\n\ny")]


def test_odd_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,text,x\n1,"a\n')
    with pytest.raises(ValueError, match="not closed"):
        so.read_csv(spark, str(tmp_path / "open.csv"), TYPES, multi_line="split")
    (tmp_path / "only.csv").write_text("id,text,x\n\n")
    assert so.read_csv(spark, str(tmp_path / "only.csv"), TYPES, multi_line="split").collect() == []
    (tmp_path / "ragged.csv").write_text('id,text,x\n1,"a\nb"\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        so.read_csv(spark, str(tmp_path / "ragged.csv"), TYPES, multi_line="split").collect()
    (tmp_path / "other.csv").write_text("id,words,x\n1,a,2\n")
    with pytest.raises(Exception, match="another header"):
        so.read_csv(spark, [str(tmp_path / "only.csv"), str(tmp_path / "other.csv")], TYPES, multi_line="split").collect()
    with pytest.raises(ValueError, match="multi_line"):
        so.read_csv(spark, str(tmp_path / "only.csv"), TYPES, multi_line="lines")


def test_session_setting_is_put_back(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,x\n1,a,2\n")
    so.read_csv(spark, str(tmp_path / "a.csv"), TYPES, multi_line="split")
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
