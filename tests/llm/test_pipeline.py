"""The stages in order against what each operator says of every document."""

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from fitloom.llm import decontaminate, secrets, sentencepiece
from fitloom.llm.queries import SENTENCEPIECE_MODEL
from test_decontaminate import plain_leaks


def test_every_stage_takes_effect(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    docs, kept = table, {"all": table.count()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == table.columns
        kept[name] = docs.count()
    assert kept["all"] > kept["toxicity"] > kept["near_copies"] > kept["decontamination"] == kept["secrets"] > 0.6 * kept["all"]
    rows = docs.collect()
    items = pq.read_table(f"{folder}/benchmark.parquet").to_pydict()
    assert not plain_leaks([(r.doc_id, r.text) for r in rows], list(zip(items["item_id"], items["text"], strict=True)))
    assert not any(s.kind != "guess" for r in rows for s in secrets.find(r.text) if s.value == s.start)
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None and "<hex>" in r.text)
    texts = [r.text for r in rows]
    assert len(set(texts)) == len(texts)
    encoded = {r.doc_id: r.ids for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    model = sentencepiece.load(SENTENCEPIECE_MODEL)
    assert encoded == {r.doc_id: model.encode(r.text).tolist() for r in rows}


def test_run_on_tables_with_odd_rows(spark, tmp_path):
    item = "which of these many words is the right one to say. the ninth word of them."
    rows = [(1, "bad nitwit words"), (2, None), (3, ""), (4, "a fine day by the sea with friends and bread"), (5, "a fine day by the sea with friends and bread"),
            (6, f"before {item} after"), (7, "key token=abcdef0123456789abcdef01 end"), (7, "key token=abcdef0123456789abcdef01 end"), (None, "no id")]
    spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    model = sentencepiece.load(SENTENCEPIECE_MODEL)
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "4", "7", "None"] and all(r.exact for r in got)
    assert model.decode(__import__("numpy").array(next(r.ids for r in got if r.doc_id == 7))) == "key token=<assign> end"
    spark.read.parquet(f"{tmp_path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_stages_are_registered_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "sentencepiece"]
    assert decontaminate.OVERLAP >= 0.8
    with pytest.raises(TypeError):
        corpus_pipeline.run()


def test_batches_of_the_stages_are_bounded_in_bytes(spark):
    """all texts of a slice, up to 10,000, went to a worker at once."""
    assert all(hasattr(f, "__wrapped__") for _, f in corpus_pipeline.STAGES)
    key, docs = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 2000) AS text")
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    stage, before = corpus_pipeline.small_batches(lambda spark, docs, _: docs.mapInArrow(sizes, "n long")), spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        found = [r.n for r in stage(spark, docs, "").collect()]
        assert sum(found) > 30_000_000 and max(found) < 1.1 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(key, "1m")
        assert max(r.n for r in stage(spark, docs, "").collect()) < 1_200_000
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)
