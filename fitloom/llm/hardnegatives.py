"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

Candidates are written once as Parquet, ordered by label and by their place on a Hilbert curve
through the dimensions of most variance, and cut into blocks of one label. The first row of a
block carries its zone map: the least and greatest value of every dimension. For an anchor,
interval arithmetic over a zone map bounds the scores of a whole block from both sides.

A search looks for the k best scores within a window, the same way for positives (any score,
own label) and negatives (a share of a positive's score, other labels): the zones whose middle
lies nearest to the window's upper end are read first and give a floor; then only parts with a
zone that can reach over a floor are read, and in them only blocks that still can.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.session import materialise, scratch_path

#: Rows of a block and, at most on average, of a part, which is a folder that is read or not.
BLOCK_ROWS, PART_ROWS, LEAST_PARTS = 256, 65_536, 16
#: Dimensions of the curve and bits of each: 56 bits of a long.
CURVE, BITS = 8, 7
#: Anchors that are answered together, and the most bytes of their vectors.
WAVE, WAVE_BYTES = 4096, 16 << 20
#: Zones of each window that are read for its floor.
SEEDS = 2
#: Found rows that a task holds before it keeps the k best of each window.
HELD = 400_000

LOWEST, HIGHEST = -(1 << 62), 1 << 62
_TABLE = "vec_id long, label int, v array<long>, block int, lo array<long>, hi array<long>, part int"


def scaled(embedding: Column, by: int = 256) -> Column:
    """floor(by * x) of every component as longs; null for a null vector, a null or a
    non-finite component. Components and scores must fit into longs."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & fine, F.transform(embedding, lambda x: F.floor(F.lit(float(by)) * x.cast("double"))))


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on a Hilbert curve of every row of whole-number coordinates below 2**bits.

    Skilling's transform: undo the excess work of each bit from the top, Gray-encode, then
    interleave the bits.
    """
    x = cells.astype(np.int64)
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            high = (x[:, i] >> b & 1) == 1
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> b & 1, (1 << b) - 1, 0) if dims else 0
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[:, i] >> b & 1
    return key


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: through floats where no sum can pass 2**53, else as integers."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if size < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _spread(vectors: DataFrame, width: int) -> list[tuple[int, float, float]]:
    """The dimensions of most variance, each with its mean and deviation."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, width))
        for batch in batches:
            v = _matrix(batch.column(0), width).astype(np.float64)
            total += np.stack([np.full(width, float(len(v))), v.sum(axis=0), (v * v).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), *map(pa.array, total)], ["dim", "n", "s", "q"])

    rows = vectors.select("v").mapInArrow(sums, "dim long, n double, s double, q double").groupBy("dim").agg(*[F.sum(c).alias(c) for c in "nsq"])
    mean = F.col("s") / F.greatest("n", F.lit(1.0))
    rows = rows.select("dim", mean.alias("m"), F.sqrt(F.greatest(F.col("q") / F.greatest("n", F.lit(1.0)) - mean * mean, F.lit(0.0))).alias("d"))
    return [(r.dim, r.m, max(r.d, 0.5)) for r in rows.orderBy(F.desc("d"), "dim").limit(CURVE).collect()]


def candidate_blocks(vectors: DataFrame, width: int, rows: int) -> DataFrame:
    """``vectors(vec_id, label, v)`` of one width as a written table of blocks, in folders of parts."""
    axes = _spread(vectors, width)

    @F.arrow_udf("long")
    def place(v: pa.Array) -> pa.Array:
        x = _matrix(v, width)
        cells = [np.clip(((x[:, i] - m) / (4 * d) + 0.5) * (1 << BITS), 0, (1 << BITS) - 1) for i, m, d in axes]
        return pa.array(hilbert_index(np.stack(cells, axis=1) if cells else np.zeros((len(x), 0)), BITS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held = TaskContext.get().partitionId(), 0, None

        def out(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            v = _matrix(rows.column("v").chunk(0), width)
            zone = [pa.array([bound.tolist()] + [None] * (len(v) - 1), pa.list_(pa.int64())) for bound in (v.min(axis=0), v.max(axis=0))]
            same = [pa.array(np.full(len(v), x, np.int32)) for x in (block, part)]
            columns = [rows.column("vec_id").chunk(0), rows.column("label").chunk(0), rows.column("v").chunk(0), same[0], *zone, same[1]]
            return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "block", "lo", "hi", "part"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            labels = held.column("label").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(labels)) + 1, len(labels))
            at = 0
            for end in ends.tolist():
                # the last run of a label may go on in the next batch
                while at < end and (end < len(labels) or end - at >= BLOCK_ROWS):
                    size = min(BLOCK_ROWS, end - at)
                    yield out(held.slice(at, size))
                    at, block = at + size, block + 1
            held = held.slice(at)
        if held is not None and len(held):
            yield out(held)

    parts = max(LEAST_PARTS, -(-rows // PART_ROWS))
    keyed = vectors.select("vec_id", "label", "v", place("v").alias("key"))
    # ids part the copies of one vector, so no range is crowded
    ordered = keyed.repartitionByRange(parts, "label", "key", "vec_id").sortWithinPartitions("label", "key", "vec_id")
    path = scratch_path(vectors.sparkSession, "negatives-blocks")
    blocks = ordered.select("vec_id", "label", "v").mapInArrow(cut, _TABLE)
    # the writer wants rows in order of parts; blocks stay together, the row with the zone first
    blocks.sortWithinPartitions("part", "block", F.col("lo").isNull()).write.partitionBy("part").parquet(path)
    return vectors.sparkSession.read.schema(_TABLE).parquet(path)


@dataclass
class Windows:
    """What a wave of anchors looks for: up to ``slots`` windows of scores for each."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray  # anchors x slots; HIGHEST for no window
    high: np.ndarray
    same: bool  # rows of the anchor's own label, or of the others
    k: int
    rising: np.ndarray = field(init=False)
    falling: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.rising, self.falling = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)

    @property
    def slots(self) -> int:
        return self.low.shape[1]

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score any row within each zone can have with each anchor."""
        return _products(self.rising, lo) + _products(self.falling, hi), _products(self.rising, hi) + _products(self.falling, lo)

    def asked(self, labels: np.ndarray) -> np.ndarray:
        """Which anchors look for rows of which labels."""
        equal = self.labels[:, None] == labels[None, :]
        return equal if self.same else ~equal

    def reach(self, least: np.ndarray, most: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Anchors x zones x slots: whether a zone's scores can lie in a window, at its floor or over it."""
        return (most[:, :, None] >= floor[:, None, :]) & (least[:, :, None] <= self.high[:, None, :])


class Found:
    """The k best rows of every window that a task has met, and the floors they give."""

    def __init__(self, windows: Windows, floor: np.ndarray) -> None:
        self.windows, self.floor = windows, floor.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, anchors: np.ndarray, vec: np.ndarray, rows: np.ndarray) -> None:
        w = self.windows
        scores = _products(w.vectors[anchors], rows)
        for slot in range(w.slots):
            near = (scores >= self.floor[anchors, slot][:, None]) & (scores <= w.high[anchors, slot][:, None]) & (w.ids[anchors][:, None] != vec[None, :])
            a, r = np.nonzero(near)
            if len(a):
                self.parts.append((anchors[a] * w.slots + slot, vec[r], scores[a, r]))
                self.size += len(a)
        if self.size > HELD:
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows (anchor times slots plus slot), vector ids and scores, k of each at most."""
        if not self.parts:
            return (np.empty(0, np.int64),) * 3
        window, vec, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((vec, -score, window))
        window, vec, score = window[order], vec[order], score[order]
        place = np.arange(len(window)) - np.searchsorted(window, window, "left")
        full = place == self.windows.k - 1
        flat = self.floor.reshape(-1)
        flat[window[full]] = np.maximum(flat[window[full]], score[full])
        keep = place < self.windows.k
        window, vec, score = window[keep], vec[keep], score[keep]
        # the k rows of a window stay, so what it asks of later rows may only rise
        self.parts, self.size = [(window, vec, score)], len(window)
        return window, vec, score


_FOUND = "window long, vec_id long, score long"


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple[int, int], int, tuple | None, np.ndarray, np.ndarray]]:
    """Runs of rows of one block: its name, label, zone if it has been met, ids and vectors."""
    zone, zone_of = None, None
    for batch in batches:
        names = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        part, block = names["part"].to_numpy(), names["block"].to_numpy()
        vec, label, v = names["vec_id"].to_numpy(), names["label"].to_numpy(), _matrix(names["v"], width)
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
            if a == b:
                continue
            name = int(part[a]), int(block[a])
            heads = names["lo"].slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)
            if heads.any():
                at = a + int(np.flatnonzero(heads)[0])
                zone_of, zone = name, tuple(np.array([names[k][at].as_py()], np.int64).reshape(1, width) for k in ("lo", "hi"))
            yield name, int(label[a]), zone if zone_of == name else None, vec[a:b], v[a:b]


def _read(windows: Windows, floor: np.ndarray, seeds: dict[tuple[int, int], np.ndarray] | None):
    """One pass over blocks: only ``seeds``' blocks and anchors, or all that can reach a floor."""
    width = windows.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(windows, floor)
        for name, label, zone, vec, rows in _blocks(batches, width):
            if seeds is not None:
                anchors = seeds.get(name, np.empty(0, np.int64))
            else:
                asked = windows.asked(np.array([label]))[:, 0]
                if zone is not None:  # a file cut inside a block has rows before any zone
                    least, most = windows.bounds(*zone)
                    asked &= windows.reach(least, most, found.floor)[:, 0, :].any(axis=1)
                anchors = np.flatnonzero(asked)
            if len(anchors):
                found.add(anchors, vec, rows)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found.best()], ["window", "vec_id", "score"])

    return run


def _nearest_zones(windows: Windows):
    """For every window, the zones of a task whose middle lies nearest to the window's upper end."""
    width = windows.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3 + [np.empty(0)]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, block, label, lo, hi = (batch.slice(at, 512).column(i) for i in range(5))
                least, most = windows.bounds(_matrix(lo, width), _matrix(hi, width))
                here = windows.asked(label.to_numpy())[:, :, None] & windows.reach(least, most, windows.low)
                a, z, slot = np.nonzero(here)
                gap = np.abs((least[a, z] / 2 + most[a, z] / 2) - windows.high[a, slot])
                new = [a * windows.slots + slot, part.to_numpy()[z].astype(np.int64), block.to_numpy()[z].astype(np.int64), gap]
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
                order = np.lexsort((held[2], held[1], held[3], held[0]))
                held = [x[order] for x in held]
                keep = np.arange(len(order)) - np.searchsorted(held[0], held[0], "left") < SEEDS
                held = [x[keep] for x in held]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["window", "part", "block", "gap"])

    return run


def _open_parts(windows: Windows, floor: np.ndarray):
    """The parts with a zone that can reach a floor."""
    width = windows.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, _, label, lo, hi = (batch.slice(at, 512).column(i) for i in range(5))
                least, most = windows.bounds(_matrix(lo, width), _matrix(hi, width))
                open_ = windows.asked(label.to_numpy()) & windows.reach(least, most, floor).any(axis=2)
                parts.update(part.to_numpy()[open_.any(axis=0)].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(parts), pa.int32())], ["part"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def best_in_windows(table: DataFrame, windows: Windows) -> DataFrame:
    """``(window, rank, vec_id, score)``: the k best rows of every window, ties to the smaller id."""
    zones = table.where("lo is not null").select("part", "block", "label", "lo", "hi")
    near = zones.mapInArrow(_nearest_zones(windows), "window long, part long, block long, gap double")
    place = F.row_number().over(W.partitionBy("window").orderBy("gap", "part", "block"))
    seeds: dict[tuple[int, int], set[int]] = {}
    for r in near.withColumn("r", place).where(F.col("r") <= SEEDS).select("window", "part", "block").collect():
        seeds.setdefault((r.part, r.block), set()).add(r.window // windows.slots)
    first = table.where(F.col("part").isin(sorted({p for p, _ in seeds})))
    named = {name: np.array(sorted(anchors), np.int64) for name, anchors in seeds.items()}
    floor = windows.low.copy()
    kth = _ranked(first.mapInArrow(_read(windows, floor, named), _FOUND), windows.k).where(F.col("rank") == windows.k)
    for r in kth.select("window", "score").collect():
        floor[r.window // windows.slots, r.window % windows.slots] = r.score
    parts = [r.part for r in zones.mapInArrow(_open_parts(windows, floor), "part int").distinct().collect()]
    rest = table.where(F.col("part").isin(sorted(parts)))
    return _ranked(rest.mapInArrow(_read(windows, floor, None), _FOUND), windows.k)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each of ``anchors(vec_id, label, v)`` has as positives its best other rows of
    ``vectors(vec_id, label, v)`` of its own label; for each, the best rows of other labels
    whose score lies between ``least`` and ``most`` hundredths of the positive's score. Ties
    go to the smaller id. Scores are inner products of arrays of longs.

    Rows with a null id, label or vector take no part; a vector meets only anchors of its own
    length, and never one of its own id. A repeated row is found as often as it stands there;
    a repeated anchor asks once, with its least label and vector. A negative positive score
    has an empty window. Empty tables give an empty table. Anchors are taken in waves, whose
    vectors, floors and positives are all that the driver holds; each wave's rows are written.
    """
    spark = vectors.sparkSession
    present = "vec_id is not null and label is not null and v is not null"
    narrow = [F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "v"]
    rows = materialise(vectors.where(present).select(*narrow), "negatives-rows")
    asked = anchors.where(present).select(*narrow).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x"))
    asked = materialise(asked.select("vec_id", "x.*", F.size("x.v").alias("width")), "negatives-anchors")
    sizes = {r.width: r.n for r in rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()}
    out, path = 0, scratch_path(spark, "negatives-found")
    for width, n in sorted((r.width, r.n) for r in asked.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()):
        if width not in sizes:
            continue
        table = candidate_blocks(rows.where(F.size("v") == width), width, sizes[width])
        waves = -(-n // max(1, min(WAVE, WAVE_BYTES // (8 * max(width, 1)))))
        for wave in range(waves):
            mine_ = asked.where((F.col("width") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave))
            got = mine_.select("vec_id", "label", "v").orderBy("vec_id").toArrow().combine_chunks()
            if not len(got):
                continue
            ids, labels = got.column(0).to_numpy(), got.column(1).to_numpy()
            _wave(table, ids, labels, _matrix(got.column(2).chunk(0), width), positives, negatives, least, most).write.mode("append").parquet(path)
            out += 1
    return spark.read.schema(_RESULT).parquet(path) if out else spark.createDataFrame([], _RESULT)


def _wave(table: DataFrame, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    any_ = np.full((len(ids), 1), HIGHEST)
    told = best_in_windows(table, Windows(ids, labels, v, -any_, any_, True, positives)).select("window", "rank", "vec_id", "score").toArrow()
    anchor, slot, vec, score = (told.column(i).to_numpy() for i in range(4))
    slot = slot - 1
    low, high = np.full((len(ids), positives), HIGHEST), np.full((len(ids), positives), LOWEST)
    hundreds, rest = score // 100, score % 100  # so that no product leaves a long
    low[anchor, slot], high[anchor, slot] = least * hundreds - (-least * rest // 100), most * hundreds + most * rest // 100
    partner = np.zeros((2, len(ids) * positives), np.int64)
    partner[:, anchor * positives + slot] = vec, score
    found = best_in_windows(table, Windows(ids, labels, v, low, high, False, negatives))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            window = batch.column(0).to_numpy()
            columns = [pa.array(ids[window // positives]), pa.array(partner[0, window]), batch.column(1), batch.column(2), pa.array(partner[1, window]), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RESULT.split(", ")])

    return found.select("window", "rank", "vec_id", "score").mapInArrow(named, _RESULT)
