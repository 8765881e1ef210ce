"""Spelling variants: words one edit apart, found by walking a frontier down a trie.

The trie is a table of edges ``(node, first, label, child, target)``: a node is a branching
prefix or a whole word, named by a digest, and a label is the letters between two nodes, so a
long word is a few edges. The frontier is a table of states ``(word, position, node, edits)``.
Level by level it is joined with the edges of that level: a state goes on where its next
letters are the label, and an unedited one also where label and letters differ by one edit at
their first difference. One-edit states that end on a whole word are its neighbours.

Every word walks a trie of words and one of reversed words, and edits only in its second
half: a pair of neighbours differs first in the second half of one of the two spellings. So
states branch deep in the tries, where nodes have few edges, and not at the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.session import materialise

# The letters of a run, and the only ones that are lowered.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Edges of one level up to this size, counted before, are broadcast.
BROADCAST_BYTES = 8 << 20
#: Rows of a batch of prefixes.
ROWS = 50_000


def runs(docs: DataFrame, every: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word)`` for every run of letters of every whole text.

    Where ``every`` divides the CRC32 of ``<doc_id>:<run>``, one letter of the run is lost
    (a null id counts as an empty one). Null and empty texts have no runs.
    """
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    found = docs.select(F.col(id_col).cast("string").alias("doc"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.encode(F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), "run"), "utf-8"))
    size = F.char_length("run")
    hashed = found.select("run", size.alias("size"), h.alias("h"))
    at = F.pmod("h", "size").cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    return hashed.select(F.when(F.pmod("h", F.lit(every)) == 0, shorter).otherwise(F.col("run")).alias("word"))


def words(docs: DataFrame, letters: int = 6, occurrences: int = 5, **options) -> DataFrame:
    """``(word, n)``: the distinct runs of at least so many letters and occurrences."""
    long_enough = runs(docs, **options).where(F.char_length("word") >= letters)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def _root(back: bool) -> bytes:
    return blake2b(b"\x01" if back else b"\x00", digest_size=16).digest()


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, depth, node, next)``: all prefixes of an item but the empty one, and the letter behind each."""
    names = ["id", "depth", "node", "next"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.string()]
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for id_, item, back in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h = blake2b(b"\x01" if back else b"\x00", digest_size=16)
            for depth, letter in enumerate(item, 1):
                h.update(letter.encode())
                for column, value in zip(out, (id_, depth, h.copy().digest(), item[depth : depth + 1]), strict=True):
                    column.append(value)
                if len(out[0]) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def trie(items: DataFrame) -> DataFrame:
    """``(level, node, first, label, size, child, ahead, target, target_n)``: the edges of the tries
    of ``items(id, item, back, n)``; ``ahead`` are the letters that go on from the child, and
    ``target`` is the item that ends at it, if any."""
    paths = materialise(items.select("id", "item", "back").mapInArrow(_prefixes, "id long, depth int, node binary, next string"), "spelling-paths")
    # the empty string behind an item marks its end: a node stays if it ends an item or branches
    kept = paths.groupBy("node").agg(F.collect_set("next").alias("next"))
    kept = kept.where("size(next) > 1 or next[0] = ''").select("node", F.array_join(F.array_sort("next"), "").alias("ahead"))
    kept = materialise(kept, "spelling-nodes")
    stops = paths.join(kept, "node").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "ahead"))).alias("stops"))
    start = F.when(F.col("back"), F.lit(_root(True))).otherwise(F.lit(_root(False)))
    along = items.join(stops, "id").select(
        "item", "n", F.concat(F.array(F.struct(F.lit(0).alias("depth"), start.alias("node"), F.lit("").alias("ahead"))), "stops").alias("stops"), F.size("stops").alias("last")
    )
    steps = along.select("item", "n", "stops", "last", F.explode(F.sequence(F.lit(1), "last")).alias("level"))
    here, there = F.get("stops", F.col("level") - 1), F.get("stops", F.col("level"))
    size = there["depth"] - here["depth"]
    own = F.col("level") == F.col("last")
    edges = steps.select(
        "level", here["node"].alias("node"), there["node"].alias("child"), there["ahead"].alias("ahead"), F.substring("item", here["depth"] + 1, size).alias("label"),
        F.when(own, F.struct(F.col("item").alias("target"), F.col("n").alias("target_n"))).alias("end"),
    )
    # several items share an edge; the one that ends at its child says so
    edges = edges.groupBy("level", "node", "child", "ahead").agg(F.min("label").alias("label"), F.max("end").alias("end"))
    return edges.select("level", "node", F.substring("label", 1, 1).alias("first"), "label", F.char_length("label").alias("size"), "child", "ahead", "end.*")


def _shared() -> Column:
    """Letters that ``label`` and the item's rest begin with alike, by bisection."""
    same = "acc + shiftleft(1, b) <= least(size, length - at) and substring(item, at + 1, acc + shiftleft(1, b)) = substring(label, 1, acc + shiftleft(1, b))"
    bits = "sequence(cast(floor(log2(size)) as int), 0, -1)"
    return F.expr(f"aggregate({bits}, 0, (acc, b) -> if({same}, acc + shiftleft(1, b), acc))")


def _edited(m: Column) -> Column:
    """Positions behind the label after one edit at its letter ``m``: changed, left out of the
    item, or put into it."""
    at, size, rest = F.col("at"), F.col("size"), F.col("length") - F.col("at")
    item = lambda start, n: F.substring("item", at + start + 1, n)
    tail = F.substring("label", m + 2, size)  # label behind its letter m
    changed = (rest >= size) & (m < rest) & (item(m + 1, size - m - 1) == tail)
    added = (rest >= size - 1) & (item(m, size - m - 1) == tail)
    removed = (rest >= size + 1) & (item(m + 1, size - m) == F.substring("label", m + 1, size))
    return F.array_compact(F.array(F.when(changed, at + size), F.when(added, at + size - 1), F.when(removed, at + size + 1)))


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level down, with the end of an item where there is one."""
    late = F.col("length").cast("int").bitwiseAND(F.lit(-2)) / 2  # half the letters
    letter = F.substring("item", F.col("at") + 1, F.lit(1))
    on_path = states.withColumn("first", letter).join(edges, ["node", "first"])
    straight = F.substring("item", F.col("at") + 1, F.col("size")) == F.col("label")
    on_path = on_path.withColumn("straight", straight).where("straight or edits = 0")
    m = F.when(~F.col("straight"), _shared())
    on_path = on_path.withColumn("m", m)
    go_on = F.when(F.col("straight"), F.array(F.col("at") + F.col("size"))).when(F.col("at") + F.col("m") >= late, _edited(F.col("m")))
    on_path = on_path.withColumn("to", F.explode(go_on)).withColumn("edits", F.when(F.col("straight"), F.col("edits")).otherwise(1))
    aside = states.where("edits = 0").where(F.col("at") >= late).join(edges, "node").where(F.col("first") != letter)
    aside = aside.withColumn("to", F.explode(_edited(F.lit(0)))).withColumn("edits", F.lit(1))
    # an edited state must end here, or find its next letter behind the child
    open_ = "edits = 0 or (to = length and target is not null) or (to < length and instr(ahead, substring(item, to + 1, 1)) > 0)"
    columns = ["item", "back", "n", "length", F.col("to").cast("int").alias("at"), F.col("child").alias("node"), "edits", "target", "target_n"]
    return on_path.where(open_).select(*columns).union(aside.where(open_).select(*columns))


def neighbours(known: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: all pairs of ``known(word, n)`` that differ by exactly one
    inserted, deleted or replaced code point, in both directions.

    Words are distinct and not empty. Each level of the trie is one join, written to the shared folder;
    there are as many levels as a word has prefixes that branch or are words themselves.
    """
    # ids are read back from the written table, so no retry changes them
    both = known.withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
    both = both.select(F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("item"), "back", "n")
    items = materialise(both.withColumn("id", F.monotonically_increasing_id()), "spelling-items")
    edges = materialise(trie(items), "spelling-edges")
    weight = F.octet_length("label") + F.octet_length("ahead") + F.coalesce(F.octet_length("target"), F.lit(0)) + 64
    levels = {r.level: r.bytes for r in edges.groupBy("level").agg(F.sum(weight).alias("bytes")).collect()}
    start = F.when(F.col("back"), F.lit(_root(True))).otherwise(F.lit(_root(False)))
    states = items.select("item", "back", "n", F.char_length("item").alias("length"), F.lit(0).alias("at"), start.alias("node"), F.lit(0).alias("edits"))
    met = []
    for level in sorted(levels):
        mine = edges.where(F.col("level") == level).drop("level")
        reached = _step(states, F.broadcast(mine) if levels[level] <= BROADCAST_BYTES else mine)
        reached = materialise(reached, "spelling-states")
        # a lost last letter is an edit behind the last edge
        met.append(reached.where("target is not null and (edits = 1 and at = length or edits = 0 and at = length - 1)"))
        states = reached.where("edits = 0 or at < length").drop("target", "target_n")
    spelled = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    found = known.sparkSession.createDataFrame([], "word string, n long, near string, near_n long")
    for part in met:
        found = found.union(part.select(spelled("item").alias("word"), "n", spelled("target").alias("near"), F.col("target_n").alias("near_n")))
    return found.distinct()


def variants(known: DataFrame, times: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``known(word, n)``.

    ``form`` is the neighbour of largest n, the first by code points of several, if its n is
    ``times`` the word's or more; ``root`` is where forms lead, the word itself without one.
    An empty table gives an empty one.
    """
    known = materialise(known.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near"))
    near = neighbours(known).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.least") >= times * F.col("n")
    formed = known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.least")).alias("form_n")
    )
    formed = materialise(formed, "spelling-forms")
    # forms grow times over at each step, so a few rounds of doubled steps reach every root
    jumps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = jumps.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        moved = materialise(moved, "spelling-roots")
        jumps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    out = formed.join(jumps, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
