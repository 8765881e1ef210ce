import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitloom import sources as so


def write(path, text):
    path.write_text(text)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_markers_and_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,x,s\n1,,a\n2,NaN,NA\n3,NA,\n4,2.5, b\n")
    types = {"id": T.LongType(), "x": T.DoubleType(), "s": T.StringType(), "unused": T.LongType()}
    assert rows(so.read_csv(spark, path, types)) == [(1, None, "a"), (2, None, None), (3, None, None), (4, 2.5, " b")]


def test_malformed_field_fails(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id\nx1\n")
    with pytest.raises(Exception, match="not a bigint"):
        so.read_csv(spark, path, {"id": T.LongType()}).collect()


def test_ragged_row_fails(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,x\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        so.read_csv(spark, path, {"id": T.LongType(), "x": T.LongType()}).collect()


def test_inference(spark, tmp_path):
    path = write(tmp_path / "a.csv", "i,f,b,s,e,m\n1,1,True,a,,NA\n2,2.5,false,1,,3\n")
    schema = so.infer_schema(spark, path)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "i": "bigint", "f": "double", "b": "boolean", "s": "string", "e": "double", "m": "bigint",
    }
    assert rows(so.read_csv(spark, path)) == [(1, 1.0, True, "a", None, None), (2, 2.5, False, "1", None, 3)]


def test_schema_table_widens_half_precision(spark, tmp_path):
    table = write(tmp_path / "t.csv", "column,dtype\na,float16\nb,int64\nc,object\nd,datetime64[ns]\n")
    schema = so.read_schema_table(spark, table)
    assert [f.dataType for f in schema] == [T.FloatType(), T.LongType(), T.StringType(), T.TimestampNTZType()]
    data = write(tmp_path / "d.csv", "b,a,c,d\n1,0.5,x,2011-01-20 05:00:00\n")
    assert rows(so.read_csv(spark, data, schema)) == [(1, 0.5, "x", datetime.datetime(2011, 1, 20, 5))]
    with pytest.raises(ValueError, match="unknown dtype"):
        so.spark_type("complex128")


def test_headers_are_bound_by_name(spark, tmp_path):
    one = write(tmp_path / "1.csv", "id,a\n1,x\n")
    two = write(tmp_path / "2.csv", "a,id\ny,2\n")
    three = write(tmp_path / "3.csv", "id,a,b\n3,z,9\n")
    types = {"id": T.LongType(), "a": T.StringType(), "b": T.LongType()}
    mixed = so.read_csv(spark, [one, two, three], types, mixed_headers=True)
    assert mixed.columns == ["id", "a", "b"]
    assert rows(mixed) == [(1, "x", None), (2, "y", None), (3, "z", 9)]
    with pytest.raises(Exception, match="(?i)header"):
        so.read_csv(spark, [one, two], types).collect()
    with pytest.raises(ValueError):
        so.read_csv(spark, [])


def test_same_files_same_header_need_one_scan(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.csv", f"id\n{i}\n") for i in range(5)]
    df = so.read_csv(spark, paths, {"id": T.LongType()}, mixed_headers=True)
    assert rows(df) == [(i,) for i in range(5)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_only_used_columns_are_parsed(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,x\n1,bad\n")
    df = so.read_csv(spark, path, {"id": T.LongType(), "x": T.DoubleType()})
    assert rows(df.select("id")) == [(1,)]


def test_csv_sink_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a,"b"\n c '), (2, "plain")], "id bigint, t string")
    so.write_csv(df, str(tmp_path / "out"))
    so.write_csv(df, str(tmp_path / "out"))
    assert rows(so.read_csv(spark, str(tmp_path / "out"), df.schema, multi_line=True)) == rows(df)


def test_submission_needs_key_and_names(spark):
    df = spark.createDataFrame([(1, 0.5)], "id int, p double")
    assert so.submission(df, "id", {"target": "p"}).columns == ["id", "target"]
    for key, outputs in (("no", {"target": "p"}), ("id", {}), ("id", {"id": "p"}), ([], {"target": "p"})):
        with pytest.raises(ValueError):
            so.submission(df, key, outputs)


def test_previews(spark):
    df = spark.range(50).repartition(7)
    assert [r[0] for r in so.preview(df, "id", 3).collect()] == [0, 1, 2]
    assert so.preview_files(["b", "d", "a", "c"]) == ["a", "b", "c"]


def test_generated_values_depend_on_the_key_only(spark):
    def made(df):
        return sorted(
            tuple(r)
            for r in df.select(
                "id",
                so.hashed_uniform("id", "u", 42, 50.0),
                so.hashed_normal("id", "n", 42, 10.0),
                so.hashed_integers("id", "i", 42, 0, 100),
            ).collect()
        )

    ids = so.numbered_rows(spark, 2000)
    first = made(ids)
    assert first == made(ids.repartition(7)) and first[0][0] == 1 and len(first) == 2000
    uniform, normal, whole = ([r[i] for r in first] for i in (1, 2, 3))
    assert 0 < min(uniform) and max(uniform) < 50 and abs(sum(uniform) / 2000 - 25) < 1.5
    assert abs(sum(normal) / 2000) < 1 and 9 < (sum(x * x for x in normal) / 2000) ** 0.5 < 11
    assert min(whole) == 0 and max(whole) == 99


def test_literal_table(spark):
    df = so.literal_table(spark, [("Mike", 0), ("Nathalie", 1)], "Names string, label int")
    assert df.agg(F.sum("label")).first()[0] == 1


def test_blank_and_padded_texts_stay_and_hash_like_ids_are_text(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as out:
        out.write('id,note,code,size,when\n1,"  ",1d,+1.5e3,2024-01-02\n2," NA ",2f,.5,2024-01-03\n3,NA,30d,-2.,2024-01-04\n4,,0x1,,\n')
    df = so.read_csv(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("id", "bigint"), ("note", "string"), ("code", "string"), ("size", "double"), ("when", "string")]
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert [r.note for r in rows] == ["  ", " NA ", None, None]
    assert [r.code for r in rows] == ["1d", "2f", "30d", "0x1"] and [r.size for r in rows] == [1500.0, 0.5, -2.0, None]


def test_files_have_a_bounded_number_of_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    so.write_csv(spark.range(95).coalesce(1), path, rows_per_file=20)
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(files) == 5 and so.read_csv(spark, path).count() == 95


def test_clean_up_deletes_intermediate_tables_only(tmp_path, spark, monkeypatch):
    from fitloom import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    session.materialise(spark.range(3), "t")
    assert (tmp_path / "fitloom").exists()
    session.clean_up(spark)
    assert not (tmp_path / "fitloom").exists() and (tmp_path / "other").exists()


def test_headers_of_many_files_in_odd_places(spark, tmp_path):
    folder = tmp_path / "with space & 50%"
    folder.mkdir()
    for i in range(6):
        names = ["a", "b c"] if i % 2 else ["b c", "a"]
        values = {"a": i, "b c": f"t{i}"}
        (folder / f"f {i}.csv").write_text(",".join(f'"{n}"' for n in names) + "\n" + ",".join(str(values[n]) for n in names) + "\n")
    df = so.read_csv(spark, [str(folder / f"f {i}.csv") for i in range(6)], mixed_headers=True)
    assert sorted((r["a"], r["b c"]) for r in df.collect()) == [(i, f"t{i}") for i in range(6)]
