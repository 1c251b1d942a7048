"""Multi-line CSV read in parallel byte blocks (S-1).

Spark's ``multiLine`` reader takes a file in one task.  Here the text source
splits files into byte blocks at line ends, and what it can't know, whether a
line stands inside a quoted field, is found in two passes:

1. *Quote maps.*  Each block sends one row: for either state at its start
   (outside, inside quotes) the state at its end.  A map is the identity, a
   swap (an odd number of quotes that count in both states) or constant, and a
   prefix scan per file (two windows over one row per block) composes them: the
   state before a block is its last constant value, swapped once for every
   swap since.
2. *Records.*  With its entry state a task cuts its own lines into records,
   which ``from_csv`` parses.  A record that crosses a block border leaves a
   fragment in each block; only files with such a border are looked at again
   for these, and the fragments alone are shuffled.

A block of the second pass that the first one didn't have (files changed
meanwhile) stops the job with an error.

Fields are quoted as in RFC 4180: a quote opens a field only at its start, a
doubled one inside is a character, and a quote inside an unquoted field is
text.  Records end with ``\\n`` or ``\\r\\n`` outside quotes; line ends inside
are kept.  Empty lines are no records.  Files that can't be split (gzip) are
one block.  Every file starts with the header.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise import config
from ratewise.session import cut_lineage

_MAPS = "file string, block bigint, from_outside boolean, from_inside boolean"
_PIECES = "file string, block bigint, opens boolean, closes boolean, first boolean, piece binary"


def ends_inside(line: bytes, inside: bool) -> bool:
    """The state (inside a quoted field) at the end of ``line`` that starts in
    state ``inside``; a line that starts outside starts a record."""
    at = 0
    while True:
        if not inside:
            if line[at:at + 1] != b'"':  # an unquoted field, up to its comma
                at = line.find(b",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        while True:  # the quote that closes the field
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] != b'"':
                break
            at += 2
        inside = False
        at = line.find(b",", at + 1) + 1
        if not at:
            return False


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(file, block, rows) for each run of lines of one block; a task's
    blocks come one after the other, and a block may come in several runs."""
    for batch in batches:
        files, blocks = batch.column("file"), batch.column("block")
        codes, starts = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
        changes = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for a, b in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
            if b > a:
                yield files[a].as_py(), int(starts[a]), batch.slice(a, b - a)


def _quoted(lines: pa.Array) -> list[int]:
    """Places of the lines that hold a quote at all; no other changes a state."""
    return pc.indices_nonzero(pc.match_substring(lines, b'"')).to_pylist()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("line")))


def quote_maps(lines: DataFrame) -> DataFrame:
    """One row per block: the state at its end for either state at its start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, states, done = None, (False, True), []
        for file, block, rows in _runs(batches):
            part = rows.column("line")
            if at != (file, block):
                if at is not None:
                    done.append((*at, *states))
                at, states = (file, block), (False, True)
            for i in _quoted(part):
                line = part[i].as_py()
                first = ends_inside(line, states[0])
                states = (first, first if states[0] == states[1] else ends_inside(line, states[1]))
        if at is not None:
            done.append((*at, *states))
        names = ["file", "block", "from_outside", "from_inside"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.record_batch([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names=names)
    return lines.mapInArrow(run, _MAPS)


def entry_states(maps: DataFrame) -> DataFrame:
    """(file, block, inside, leaves): the state before and after each block,
    by a prefix composition of the maps of its file.

    One row per block is windowed, the lines are not."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    swap = F.col("from_outside") & ~F.col("from_inside")
    constant = F.col("from_outside") == F.col("from_inside")
    counted = maps.withColumn("swaps", F.sum(swap.cast("long")).over(upto))
    fixed = F.last(F.when(constant, F.struct(F.col("from_outside").alias("value"), "swaps")), ignorenulls=True).over(before)
    since = F.coalesce(F.sum(swap.cast("long")).over(before), F.lit(0)) - F.coalesce(F.col("fixed.swaps"), F.lit(0))
    inside = F.coalesce(F.col("fixed.value"), F.lit(False)) != (since % 2 == 1)
    found = counted.withColumn("fixed", fixed).withColumn("inside", inside)
    return found.select("file", "block", "inside",
                        F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("leaves"))


def _pieces(lines: DataFrame, fragments: bool) -> DataFrame:
    """Whole records of each block, or its fragments: of a record begun before
    (``closes`` or not) and of one that goes on behind it (``opens``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
            names = ["file", "block", "opens", "closes", "first", "piece"]
            return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*found), kinds)], names=names)

        # ``held``: lines of the record being read, ``opened``: it began in this block
        at, inside, opened, first, held = None, False, True, False, []
        for file, block, rows in _runs(batches):
            out, part = [], rows.column("line")
            if at != (file, block):
                if held and fragments:
                    out.append((*at, opened, False, opened and first, b"\n".join(held)))
                at, inside, held = (file, block), rows.column("inside")[0].as_py(), []
                opened, first = not inside, block == 0
            quoted = set(_quoted(part))
            for i, line in enumerate(part.to_pylist()):
                was = inside
                if i in quoted:
                    inside = ends_inside(line, inside)
                if inside or was:
                    held.append(line)
                if inside:
                    continue
                record = b"\n".join(held) if was else line
                if opened != fragments:  # a whole record, or the end of one begun before
                    out.append((file, block, opened, True, opened and first, record))
                first = first and opened and record in (b"", b"\r")
                held, opened = [], True
            if out:
                yield table(out)
        if held and fragments:
            yield table([(*at, opened, False, opened and first, b"\n".join(held))])
    return lines.mapInArrow(run, _PIECES)


def _joined(fragments: DataFrame) -> DataFrame:
    """Records of several blocks: (file, block, first, piece)."""
    # in a block the fragment that began before it stands before the one that goes on
    order = Window.partitionBy("file").orderBy("block", "opens")
    origin = F.last(F.when(F.col("opens"), F.col("block")), ignorenulls=True).over(order)
    parts = F.array_sort(F.collect_list(F.struct("block", "opens", "piece")))
    text = F.array_join(F.transform(parts, lambda p: p["piece"].cast("string")), "\n")
    return (fragments.withColumn("origin", origin).groupBy("file", "origin")
            .agg(F.bool_or("first").alias("first"), text.cast("binary").alias("piece"))
            .select("file", F.col("origin").alias("block"), "first", "piece"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, first, record): every CSV record as text, in no order;
    ``first`` marks the first record of a file (its header)."""
    lines = _lines(spark, path)
    states = cut_lineage(entry_states(quote_maps(lines)))
    # one small row per block; beyond the limit the planner joins, and the lines get their order back
    few = states.count() <= config.BROADCAST_MAX_ROWS
    unknown = F.raise_error(F.lit("the files changed while they were read")).cast("boolean")

    def entered(some: DataFrame) -> DataFrame:
        entry, columns = states.select("file", "block", "inside"), ["file", "block", "line", "inside"]
        if few:
            joined = some.join(F.broadcast(entry), ["file", "block"], "left")
        else:
            joined = (some.withColumn("place", F.monotonically_increasing_id()).join(entry, ["file", "block"], "left")
                      .repartition("file", "block").sortWithinPartitions("file", "block", "place"))
        return joined.withColumn("inside", F.coalesce("inside", unknown)).select(*columns)
    whole = _pieces(entered(lines), False).select("file", "block", "first", "piece")
    crossing = states.where("inside or leaves").select("file").distinct()
    if not crossing.isEmpty():
        again = lines.join(F.broadcast(crossing) if few else crossing, "file", "left_semi")
        whole = whole.unionByName(_joined(_pieces(entered(again), True)))
    record = F.regexp_replace(F.col("piece").cast("string"), "\r$", "")
    return whole.select("file", "block", "first", record.alias("record")).where(F.col("record") != "")


def read_csv_blocks(spark: SparkSession, path: str) -> DataFrame:
    """A folder or file of CSV with a header, all columns as strings."""
    header = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    body = csv_records(spark, path).where(~F.col("first"))
    return body.select(F.from_csv("record", F.lit(schema.toDDL()), options).alias("r")).select("r.*")
