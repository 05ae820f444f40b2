"""CSV with line breaks in quoted fields, read by many tasks a file.

Spark gives a ``multiLine`` file to one task, as a line alone does not tell whether it begins a
record. The number of quotes before it does: quotes are doubled inside a field, so a line begins
a record if and only if an even number of quotes stands before it. Three scans by lines:

1. Quotes by split (one JVM aggregate). A running sum over each file's splits says which splits
   begin inside a quoted field: a narrow row a split, put beside the lines by a broadcast behind
   a check of its size, beyond it by a shuffled join that restores the order of the lines.
2. Records that cross a split's border: each split gives the lines before its first record and
   those of its last, unfinished one, and the pieces are joined by file (two a split at most).
3. Records within a split, joined where they have several lines. They are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from enrichkit.operators.sizing import fits_broadcast
from enrichkit.sources.files import CSV_OPTIONS, _NO_TEXT, read_csv

_SPLIT = ["file", "start", "length"]
_PIECE = "file string, start bigint, kind int, record string"
# Kinds of pieces: a record, lines of a record begun earlier, the begin of one that goes on, the
# begin of a header that goes on.
_WHOLE, _LATER, _OPEN, _HEADER = range(4)
_NUMBERS = (1 << 33) - 1


def read_split_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = False,
    schema: StructType | str | None = None,
    line_end: str = "\n",
    max_broadcast_bytes: int | None = None,
    place: str | None = None,
) -> DataFrame:
    """The rows that ``read_csv(multiline=True, options={"lineSep": line_end})`` gives, with as
    many tasks as the files have splits.

    Quotes inside a quoted field are doubled and a field that holds a quote is quoted, as
    ``write_csv`` writes it (a lone quote within an unquoted field would turn all lines after it).
    ``header`` drops the first record of each file. Without a schema every column is a string,
    named as the sequential reader names it. Records without a character are skipped. A file whose
    last quote is not closed gives the rest of it as one record. ``place`` names a column with each
    record's file, the split where it begins and its number there: their order is that of the files.

    All scans must see the same splits; if files or the settings that cut them change in between,
    the read fails instead of giving wrong records.
    """
    if schema is None:
        schema = read_csv(spark, path, header=header, multiline=True, options={"lineSep": line_end}).schema
    lines = spark.read.text(path, lineSep=line_end).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes")).select(
        *_SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("inside")
    )
    placed = _beside(lines, splits, max_broadcast_bytes)

    def pieces(whole: bool) -> DataFrame:
        return placed.mapInArrow(lambda batches: _pieces(batches, whole, header, line_end), _PIECE)

    # Of a record's pieces all but the first are later lines: it begins where the count steps.
    parts = pieces(False).withColumn("begins", (F.col("kind") >= _OPEN).cast("int"))
    order = Window.partitionBy("file").orderBy("start", "begins").rowsBetween(Window.unboundedPreceding, 0)
    glued = (
        parts.withColumn("number", F.sum("begins").over(order))
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("start", "begins", "record"))).alias("p"), F.max("kind").alias("kind"))
        .where(F.col("kind") != _HEADER)
        # The last record of the split where it begins.
        .select("file", F.col("p")[0]["start"].alias("start"), F.lit(_NUMBERS).alias("at"), F.array_join(F.col("p.record"), line_end).alias("record"))
    )
    # The low bits of the increasing id: the number within the task.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(_NUMBERS))
    within = pieces(True).select("file", "start", number.alias("at"), "record")
    records = within.unionByName(glued).where(F.col("record") != "")
    ddl = schema if isinstance(schema, str) else _ddl(schema)
    options = CSV_OPTIONS | {"nullValue": _NO_TEXT, "emptyValue": "", "lineSep": line_end, "multiLine": "true"}
    own = [F.from_csv("record", ddl, options).alias("r")]
    if place is None:
        return records.select(*own).select("r.*")
    return records.select(*own, F.struct("file", "start", "at").alias(place)).select("r.*", place)


def _ddl(schema: StructType) -> str:
    return ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields)


def _beside(lines: DataFrame, splits: DataFrame, max_broadcast_bytes: int | None) -> DataFrame:
    """The lines, in order within their split, with the state at the begin of their split."""
    if fits_broadcast(splits, max_broadcast_bytes):
        joined = lines.join(F.broadcast(splits), _SPLIT, "left")
    else:
        joined = lines.withColumn("at", F.monotonically_increasing_id()).join(splits.hint("merge"), _SPLIT, "left")
        joined = joined.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "at")
    unknown = F.raise_error(F.lit("the splits of the CSV files changed between two scans")).cast("int")
    return joined.select("file", "start", "value", "quotes", F.coalesce("inside", unknown).alias("inside"))


def _pieces(batches: Iterator[pa.RecordBatch], whole: bool, header: bool, line_end: str) -> Iterator[pa.RecordBatch]:
    """The records that lie within a split, or the pieces of those that cross its border.

    ``held`` are the lines of the record that the last batch left open: at most a split's.
    """
    split, inside, held, kind = None, 0, [], _WHOLE

    def rest() -> Iterator[pa.RecordBatch]:
        """What stands open at the end of a split: a record that is complete, or a piece."""
        if not held:
            return
        ends = inside == 0
        if kind == _LATER:
            wanted, last = not whole, _LATER
        elif ends:
            wanted, last = whole and kind != _HEADER, _WHOLE
        else:
            wanted, last = not whole, kind
        if wanted:
            yield _batch(split, last, pa.array([line_end.join(held)], pa.string()))

    for batch in batches:
        for part, key in _by_split(batch):
            fresh = key != split
            if fresh:
                yield from rest()
                split, inside, held = key, part.column("inside")[0].as_py(), []
                kind = _LATER if inside else _HEADER if header and key[1] == 0 else _OPEN
            quotes = part.column("quotes").to_numpy().astype(np.int64)
            state = (inside + np.cumsum(quotes)) % 2
            begins = np.concatenate([[inside], state[:-1]]) == 0
            inside = int(state[-1])
            at = np.flatnonzero(begins)
            lines = part.column("value")
            if fresh and len(at) and at[0] == 0:
                at = at[1:]  # the split's first record is open already
            if not len(at):
                held += lines.to_pylist()
                continue
            held += lines.slice(0, int(at[0])).to_pylist()
            if held:
                closed = line_end.join(held)
                if kind == _LATER and not whole:
                    yield _batch(split, _LATER, pa.array([closed], pa.string()))
                if kind == _OPEN and whole:
                    yield _batch(split, _WHOLE, pa.array([closed], pa.string()))
            if whole and len(at) > 1:
                own = lines.slice(int(at[0]), int(at[-1] - at[0]))
                ends = pa.array(at - at[0], pa.int32())
                yield _batch(split, _WHOLE, pc.binary_join(pa.ListArray.from_arrays(ends, own.cast(pa.string())), line_end))
            held, kind = lines.slice(int(at[-1])).to_pylist(), _OPEN
    yield from rest()


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple[str, int]]]:
    """The batch cut where the split changes (a task may read several small files)."""
    if not batch.num_rows:
        return
    files, starts = batch.column("file"), batch.column("start")
    one = files.dictionary_encode().indices.to_numpy()
    moved = (np.diff(one) != 0) | (np.diff(starts.to_numpy()) != 0)
    borders = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
    for a, b in zip(borders, borders[1:]):
        yield batch.slice(a, b - a), (files[a].as_py(), starts[a].as_py())


def _batch(split: tuple[str, int], kind: int, records: pa.Array) -> pa.RecordBatch:
    n = len(records)
    same = [pa.array([x] * n, t) for x, t in ((split[0], pa.string()), (split[1], pa.int64()), (kind, pa.int32()))]
    return pa.RecordBatch.from_arrays([*same, records], names=["file", "start", "kind", "record"])
