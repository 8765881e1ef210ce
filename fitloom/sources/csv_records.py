"""Records of CSV files with line ends inside quoted fields, found by many tasks a file.

Whether a line end lies inside quotes depends on all quotes before it. A first pass counts
the quotes of every block of a file; the running parity of those counts tells whether a block
begins inside a quoted field. A second pass then cuts each block into records by itself, and
only the pieces of records that cross a block border are moved and put together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Blocks that begin inside a field, up to which their places are broadcast.
INLINE_BLOCKS = 100_000

_PIECE = "path string, block long, first boolean, begins boolean, ends boolean, text string"
_PARALLELISM = "spark.sql.files.minPartitionNum"


@contextmanager
def _same_blocks(spark: SparkSession):
    """Both passes see the same blocks, also if the cluster grows or shrinks in between."""
    before = spark.conf.get(_PARALLELISM, None)
    if before is None:
        spark.conf.set(_PARALLELISM, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PARALLELISM)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    lines = spark.read.text(list(paths), lineSep="\n")
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    return lines.select(*place, F.monotonically_increasing_id().alias("n"), F.col("value").alias("text"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and pieces of records at block borders, of lines that come block by block.

    The columns are path, block, whether the block begins inside quotes, and the line. An
    open record is held until it closes, so a task holds one record besides its batch.
    """
    held: list[str] = []  # lines of the open record
    place, inside = (None, None), False
    flags = (False, False)  # of the open record: first of its block, begins here

    def out(first: list, begins: list, ends: list, texts) -> pa.RecordBatch:
        n = len(first)
        columns = [pa.array([place[0]] * n, pa.string()), pa.array([place[1]] * n, pa.int64())]
        columns += [pa.array(c, pa.bool_()) for c in (first, begins, ends)]
        return pa.RecordBatch.from_arrays([*columns, texts], ["path", "block", "first", "begins", "ends", "text"])

    for batch in batches:
        paths, blocks = batch.column(0), batch.column(1).to_numpy()
        whole = pa.array(batch.column(3).cast(pa.large_string()))
        odd = pc.count_substring(whole, '"').to_numpy(zero_copy_only=False) & 1
        ids = pc.dictionary_encode(paths).indices.to_numpy()
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(ids) != 0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            if a == b:
                continue
            new = (paths[a].as_py(), int(blocks[a]))
            if fresh := new != place:
                if held:
                    yield out([flags[0]], [flags[1]], [False], pa.array(["\n".join(held)], pa.large_string()).cast(pa.string()))
                held, place, inside = [], new, bool(batch.column(2)[a].as_py())
            after = (np.cumsum(odd[a:b]) + inside) & 1  # inside quotes behind each line
            before = np.concatenate(([int(inside)], after[:-1]))
            inside = bool(after[-1])
            starts = np.flatnonzero(before == 0)
            if not len(starts) or starts[0]:  # the first lines go on with what was open
                to = a + (int(starts[0]) if len(starts) else b - a)
                if not held:
                    flags = (fresh, False)
                held += whole.slice(a, to - a).to_pylist()
                if len(starts) or not inside:  # it closes with these lines
                    yield out([flags[0]], [flags[1]], [True], pa.array(["\n".join(held)], pa.large_string()).cast(pa.string()))
                    held = []
                if not len(starts):
                    continue
            offsets = np.concatenate((starts, [b - a]))
            if inside:  # the last record is open
                held = whole.slice(a + int(offsets[-2]), b - a - int(offsets[-2])).to_pylist()
                flags = (fresh and len(starts) == 1 and starts[0] == 0, True)
                offsets = offsets[:-1]
            n = len(offsets) - 1
            if n > 0:
                lists = pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0], pa.int64()), whole.slice(a + int(offsets[0]), int(offsets[-1] - offsets[0])))
                texts = pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())
                yield out([fresh and starts[0] == 0, *[False] * (n - 1)], [True] * n, [True] * n, texts)
    if held:
        yield out([flags[0]], [flags[1]], [False], pa.array(["\n".join(held)], pa.large_string()).cast(pa.string()))


def split_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The records of CSV files as ``(path, first, record)``, the first of each file marked.

    Line ends inside quotes stay as they are, those behind a record and empty records go.
    Quotes must be those of quoted fields, doubled inside them; a file whose quotes do not
    pair up fails. The records are written once to the shared folder.
    """
    with _same_blocks(spark):
        lines = _lines(spark, paths)
        quotes = F.char_length("text") - F.char_length(F.replace("text", F.lit('"'), F.lit("")))
        counts = materialise(lines.groupBy("path", "block").agg(F.sum(quotes).alias("quotes")), "quotes")
        broken = counts.groupBy("path").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").select("path").first()
        if broken:
            raise ValueError(f"a quoted field is not closed: {broken['path']}")
        earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        opened = counts.withColumn("before", F.sum("quotes").over(earlier)).where("before % 2 = 1").select("path", "block", F.lit(True).alias("inside"))
        if opened.count() <= INLINE_BLOCKS:
            placed = lines.join(F.broadcast(opened), ["path", "block"], "left")
        else:  # a block meets its state by a shuffle, and is put in order again
            placed = lines.join(opened, ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("path", "block", "n")
        cut = placed.select("path", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "text").mapInArrow(_pieces, _PIECE)
        pieces = materialise(cut, "pieces")
    onward = Window.partitionBy("path").orderBy("block", "begins")
    crossing = pieces.where("NOT (begins AND ends)").withColumn("at", F.sum(F.col("begins").cast("int")).over(onward))
    joined = crossing.groupBy("path", "at").agg(
        F.bool_or(F.col("first") & F.col("begins") & (F.col("block") == 0)).alias("first"),
        F.sort_array(F.collect_list(F.struct("block", "begins", "text"))).alias("parts"),
    )
    joined = joined.select("path", "first", F.array_join("parts.text", "\n").alias("record"))
    single = pieces.where("begins AND ends").select("path", (F.col("first") & (F.col("block") == 0)).alias("first"), F.col("text").alias("record"))
    records = single.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return records.where("record != ''")
