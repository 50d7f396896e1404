"""CSV files of any size whose quoted fields hold line breaks, read by as many tasks as Spark makes splits.

A line break ends a record only outside quotes, and whether a split begins inside quotes depends on all text before it.
So the files are read twice, as plain lines:

1. Each line maps "begins outside / inside quotes" to what holds at its end. A task folds the maps of a split's lines into
   one row. A window over a file's splits, few and small rows, gives the state in which each begins.
2. With that state a task knows where each record begins. A record of one line is parsed where it was read; only the lines
   of the others are shuffled, keyed by the split and number of the record they belong to, wherever they lie.

A quote opens a field only at the field's start and is a character elsewhere in an unquoted one; ``""`` inside quotes is a
quote. Blank lines outside quotes are skipped, the first record of each file is its header, fields go by position. Line
breaks inside a field stay as they are. A file that ends inside quotes is an error, since its last record would be the
whole rest of the file. A record has to fit in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from caseweave.session import stored

# Possessive throughout: no backtracking, and no recursion on long texts.
_QUOTED = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:[^",][^,]*+|"{_QUOTED}"[^,]*+)?+,)*+'
OPENED = f'^{_FIELDS}"{_QUOTED}\\z'
STILL_OPEN = f'^{_QUOTED}\\z'
REOPENED = f'^{_QUOTED}"(?!")[^,]*+,{_FIELDS}"{_QUOTED}\\z'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``block`` (where the split begins), ``value``, the line's map ``after_out`` and ``after_in``, ``filled``."""
    value = F.col("value")
    quoted = F.instr(value, '"') > 0
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        (quoted & value.rlike(OPENED)).cast("byte").alias("after_out"),
        (~quoted | value.rlike(STILL_OPEN) | value.rlike(REOPENED)).cast("byte").alias("after_in"),
        (~value.isin("", "\r")).alias("filled"),
    )


class _Fold:
    """State and records so far of one split, if it begins outside quotes (0) and if it begins inside (1)."""

    def __init__(self) -> None:
        self.state, self.records, self.lines = [0, 1], [0, 0], 0

    def add(self, out: np.ndarray, inside: np.ndarray, filled: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """For both beginnings: the state before and after each line, and the records begun up to it."""
        settled = np.maximum.accumulate(np.where(out == inside, np.arange(len(out)), -1))
        flips = np.cumsum((out == 1) & (inside == 0))
        found = []
        for begin in (0, 1):
            since = np.where(settled >= 0, flips - flips[settled], flips) & 1
            after = np.where(settled >= 0, out[settled], self.state[begin]) ^ since
            before = np.concatenate([[self.state[begin]], after[:-1]])
            records = self.records[begin] + np.cumsum((before == 0) & filled)
            self.state[begin], self.records[begin] = int(after[-1]), int(records[-1])
            found.append((before, after, records))
        self.lines += len(out)
        return found


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Where the rows of one split begin and end in the batch."""
    path, block = batch["path"], batch["block"].to_numpy()
    new = block[1:] != block[:-1]
    new |= pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    return zip(edges[:-1], edges[1:])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, begin, key, fold of the key's split, what the stretch gave), in the order of the rows."""
    key, fold = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        out, inside = (batch[c].to_numpy().astype(np.int64) for c in ("after_out", "after_in"))
        filled = batch["filled"].to_numpy(zero_copy_only=False).astype(bool)
        for begin, end in _stretches(batch):
            here = (batch["path"][begin].as_py(), batch["block"][begin].as_py())
            if here != key:
                key, fold = here, _Fold()
            first = fold.lines
            yield batch, begin, end, key, fold, first, fold.add(out[begin:end], inside[begin:end], filled[begin:end])


_SPLIT = "path string, block long, end_out byte, end_in byte, records_out long, records_in long"


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maps: dict[tuple, _Fold] = {}  # one entry per split of the task
    for _, _, _, key, fold, _, _ in _folded(batches):
        maps[key] = fold
    yield pa.RecordBatch.from_arrays([
        pa.array([k[0] for k in maps], pa.string()), pa.array([k[1] for k in maps], pa.int64()),
        *[pa.array([f.state[i] for f in maps.values()], pa.int8()) for i in (0, 1)],
        *[pa.array([f.records[i] for f in maps.values()], pa.int64()) for i in (0, 1)],
    ], ["path", "block", "end_out", "end_in", "records_out", "records_in"])


_PLACES = ("before_out", "after_out", "record_out", "before_in", "after_in", "record_in")
_PLACED = "path string, block long, line long, value string, filled boolean, " + ", ".join(f"{c} long" for c in _PLACES)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, begin, end, _, _, first, (out, inside) in _folded(batches):
        part = batch.slice(begin, end - begin)
        yield pa.RecordBatch.from_arrays(
            [part["path"], part["block"], pa.array(np.arange(first, first + end - begin)), part["value"], part["filled"],
             *[pa.array(a.astype(np.int64)) for a in (*out, *inside)]],
            ["path", "block", "line", "value", "filled", *_PLACES],
        )


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins ``inside`` quotes, and the last record begun before it in its file.

    ``earlier`` counts the earlier splits that begin a record; ``owner`` is the last of them and ``owner_record`` the
    number of its last record.
    """
    maps = lines.drop("value").mapInArrow(_split_maps, _SPLIT)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("end_out") == F.col("end_in")
    flips = maps.withColumn(
        "flips", F.sum(F.when((F.col("end_out") == 1) & (F.col("end_in") == 0), 1).otherwise(0)).over(upto)
    )

    def state(over) -> F.Column:
        fixed = F.last(F.when(settled, F.col("end_out")), ignorenulls=True).over(over)
        since = F.last("flips").over(over) - F.coalesce(
            F.last(F.when(settled, F.col("flips")), ignorenulls=True).over(over), F.lit(0)
        )
        return F.coalesce((F.coalesce(fixed, F.lit(0)) + since) % 2, F.lit(0))

    states = flips.withColumns({"inside": state(before), "inside_after": state(upto)})
    records = F.when(F.col("inside") == 0, F.col("records_out")).otherwise(F.col("records_in"))
    begun = states.withColumn("records", records)
    last = Window.partitionBy("path").orderBy(F.desc("block"))
    return begun.select(
        "path", "block", "inside",
        F.last(F.when(F.col("records") > 0, F.col("block")), ignorenulls=True).over(before).alias("owner"),
        F.last(F.when(F.col("records") > 0, F.col("records")), ignorenulls=True).over(before).alias("owner_record"),
        F.coalesce(F.sum((F.col("records") > 0).cast("long")).over(before), F.lit(0)).alias("earlier"),
        ((F.row_number().over(last) == 1) & (F.col("inside_after") == 1)).alias("unclosed"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of each record but the headers. The first pass runs at once, the second with the result."""
    lines = _lines(spark, path)
    splits = stored(split_states(lines), "csv-splits")
    broken = splits.where("unclosed").select("path").first()
    if broken:
        raise ValueError(f"{broken['path']} ends inside a quoted field")
    out = F.col("inside") == 0
    placed = lines.mapInArrow(_places, _PLACED).join(splits.drop("unclosed"), ["path", "block"]).select(
        "path", "block", "line", "value", "filled", "owner", "owner_record", "earlier",
        *[F.when(out, F.col(f"{c}_out")).otherwise(F.col(f"{c}_in")).alias(c) for c in ("before", "after", "record")],
    )
    carried = F.col("record") == 0  # of a record that an earlier split began
    header = F.when(carried, (F.col("earlier") == 1) & (F.col("owner_record") == 1)).otherwise(
        (F.col("earlier") == 0) & (F.col("record") == 1)
    )
    placed = placed.where(((F.col("before") == 1) | F.col("filled")) & ~header)
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    pieces = placed.where(~alone).groupBy(
        "path", F.when(carried, F.col("owner")).otherwise(F.col("block")).alias("owner"),
        F.when(carried, F.col("owner_record")).otherwise(F.col("record")).alias("record"),
    ).agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("pieces"))
    whole = placed.where(alone).select(F.col("value").alias("record"))
    joined = whole.unionAll(pieces.select(F.array_join("pieces.value", "\n").alias("record")))
    return joined.select(F.rtrim("record", F.lit("\r")).alias("record"))


def read_csv(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The files below ``path`` with the declared columns."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    parsed = F.from_csv("record", fields, {"quote": '"', "escape": '"', "multiLine": "true"})
    return records(spark, path).select(parsed.alias("r")).select("r.*")
