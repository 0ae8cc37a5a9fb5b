"""Isolated inserts of new keys into a Parquet table of committed batches.

A table is a folder with a log. An insert writes its rows aside, sorted by key and split by key
range, and one log entry makes them visible: a reader sees whole batches only, and an insert that
dies half-way leaves nothing but a folder that no entry names. Entries are numbered and each number
belongs to one writer. A writer that finds its number taken compares its rows with the batches
committed meanwhile and tries the next number, so inserts that overlap in time leave the table of
one after the other. Files that lay in the folder before its first entry count as a batch of their own.

Every entry lists its files with the smallest and largest value of each key column. An insert
compares its keys only with files that its own key ranges touch; all others are not opened.

Defined cases: a key repeated in the input goes in once, and which copy stays depends only on the
rows' content; NULLs in keys are values like others; an empty insert makes an empty table if there
is none, and else changes nothing. Columns must be those of the table, in any order.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import time
import uuid
from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators.panel import one_row_per_key
from tidemark.sources import commits

RANGES = 256  # key ranges an insert is described by, whatever its size
ATTEMPTS = 100
_COMPARED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType,
             T.TimestampType, T.TimestampNTZType, T.BooleanType)

Box = list  # per key column [smallest, largest], or None where values cannot be compared


def _log(target: str) -> str:
    return f"{target}/_log"


def _sortable(value):
    """As JSON keeps it; order is the same as Spark's."""
    if isinstance(value, dt.datetime):
        return value.isoformat(timespec="microseconds")
    return value.isoformat() if isinstance(value, dt.date) else value


def _boxes(df: DataFrame, keys: list[str], group: Column) -> list[tuple]:
    """(group, rows, box) of every group of rows; a NULL anywhere leaves its column open."""
    compared = [isinstance(df.schema[k].dataType, _COMPARED) for k in keys]
    picks = [
        F.struct(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count_if(F.col(k).isNull()).alias("nulls"))
        if ok else F.lit(None) for k, ok in zip(keys, compared)
    ]
    found = df.groupBy(group.alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), *[p.alias(f"_b{i}") for i, p in enumerate(picks)]
    )
    out = []
    for row in found.collect():
        box = [
            [_sortable(b["lo"]), _sortable(b["hi"])] if b is not None and not b["nulls"] else None
            for b in row[2:]
        ]
        out.append((row[0], row[1], box))
    return out


def _disjoint(a: Box, b: Box) -> bool:
    return any(x and y and (x[1] < y[0] or y[1] < x[0]) for x, y in zip(a, b))


def touched(files: list[tuple[str, Box]], asked: list[Box]) -> list[str]:
    """Files whose box meets one of the boxes asked for.

    Boxes with a known first column are searched by it, so files times ranges are not all compared.
    """
    known = sorted((b for b in asked if b[0]), key=lambda b: b[0][0])
    others = [b for b in asked if not b[0]]
    lows = [b[0][0] for b in known]
    highest, so_far = [], None
    for b in known:
        so_far = b[0][1] if so_far is None else max(so_far, b[0][1])
        highest.append(so_far)
    out = []
    for name, box in files:
        near = others
        if box[0]:
            stop = bisect_right(lows, box[0][1])
            start = stop
            while start and highest[start - 1] >= box[0][0]:
                start -= 1
            near = near + known[start:stop]
        else:
            near = near + known
        if any(not _disjoint(box, b) for b in near):
            out.append(name)
    return out


class InsertTable:
    """The committed state of a table, and inserts into it."""

    def __init__(self, spark: SparkSession, target: str, keys: list[str] | None = None):
        self.spark, self.target, self.keys = spark, target.rstrip("/"), keys

    def entries(self, after: int = 0) -> list[tuple[int, dict]]:
        return commits.entries(self.spark, _log(self.target), after)

    def _plain(self) -> list[str]:
        """Files that lie in the folder itself."""
        names = [n for n, _ in commits.children(self.spark, self.target)]
        return [f"{self.target}/{n}" for n in names if n.endswith(".parquet")]

    def read(self) -> DataFrame:
        """All committed rows."""
        entries, plain = self.entries(), self._plain()
        if not entries:
            return self.spark.read.parquet(self.target)
        schema = T.StructType.fromJson(entries[0][1]["schema"])
        folders = [f"{self.target}/{e['batch']}" for _, e in entries if e["files"]]
        if not folders and not plain:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*plain, *folders)

    def known_keys(self, keys: list[str], asked: list[Box], after: int = 0) -> DataFrame | None:
        """Keys in the committed files that the ranges touch; None if there are no such files."""
        files, schema = [], None
        for number, entry in self.entries(after):
            schema = schema or T.StructType.fromJson(entry["schema"])
            same = entry["keys"] == keys
            files += [
                (f"{self.target}/{entry['batch']}/{name}", box if same else [None] * len(keys))
                for name, _, box in entry["files"]
            ]
        paths = touched(files, asked)
        if not after:
            paths = self._plain() + paths
        if not paths:
            return None
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*paths).select(*keys)

    def _write(self, df: DataFrame, keys: list[str], name: str) -> tuple[str, list]:
        """Write a batch by key ranges; its folder, and its files with rows and boxes."""
        batch = f"_batches/{name}"
        path = f"{self.target}/{batch}"
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        file = F.element_at(F.split(F.input_file_name(), "/"), -1)
        return batch, [list(b) for b in _boxes(written, keys, file)]

    def _asked(self, batch: str, schema: T.StructType, keys: list[str], rows: int) -> list[Box]:
        """Ranges of a sorted batch, finer than its files."""
        if not rows:
            return []
        step = math.ceil(rows / RANGES)
        at = F.monotonically_increasing_id()
        group = F.concat_ws("-", F.shiftright(at, 33), F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / step))
        read = self.spark.read.schema(schema).parquet(f"{self.target}/{batch}")
        return [box for _, _, box in _boxes(read, keys, group)]

    def insert(self, df: DataFrame, keys: list[str]) -> int:
        """Add the rows whose key the table lacks; returns how many there were."""
        self._fits(df.schema)
        made: list[str] = []
        token = uuid.uuid4().hex
        try:
            made.append(f"_batches/{token}-0")
            batch, files = self._write(one_row_per_key(df, keys), keys, f"{token}-0")
            seen = 0
            for attempt in range(1, ATTEMPTS):
                # Only what was committed since the last look is new to these rows.
                entries = self.entries(seen)
                latest = entries[-1][0] if entries else seen
                rows = sum(f[1] for f in files)
                known = self.known_keys(keys, self._asked(batch, df.schema, keys, rows), seen)
                if known is not None and rows:
                    mine = self.spark.read.schema(df.schema).parquet(f"{self.target}/{batch}")
                    other = known.toDF(*[f"_k{i}" for i in range(len(keys))])
                    same = reduce(
                        Column.__and__, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys))
                    )
                    made.append(f"_batches/{token}-{attempt}")
                    batch, files = self._write(
                        mine.join(other, same, "left_anti"), keys, f"{token}-{attempt}"
                    )
                    rows = sum(f[1] for f in files)
                seen = latest
                if not rows and (seen or self._plain()):
                    return 0
                entry = {
                    "batch": batch, "keys": keys, "rows": rows, "files": files,
                    "schema": json.loads(df.schema.json()),
                }
                if commits.append(self.spark, _log(self.target), seen + 1, entry):
                    made.remove(batch)
                    return rows
            raise RuntimeError(f"{ATTEMPTS} other inserts came first")
        finally:
            for left in made:
                commits.delete(self.spark, f"{self.target}/{left}")

    def _fits(self, schema: T.StructType) -> None:
        entries = self.entries()
        if not entries and not self._plain():
            return
        have = {f.name: f.dataType for f in self.read().schema}
        if {f.name: f.dataType for f in schema} != have:
            raise ValueError(f"the table's columns are {have}")

    def clean_up(self, older_than: float = 86_400) -> list[str]:
        """Remove batches that no entry names and nobody has written to for so many seconds."""
        named = {e["batch"].split("/")[1] for _, e in self.entries()}
        gone = []
        for name, changed in commits.changed(self.spark, f"{self.target}/_batches"):
            if name not in named and changed < time.time() - older_than:
                commits.delete(self.spark, f"{self.target}/_batches/{name}")
                gone.append(name)
        return gone


def insert_new(df: DataFrame, target: str, keys: list[str]) -> int:
    """Append the rows whose key the target lacks; a key repeated in ``df`` goes in once."""
    return InsertTable(df.sparkSession, target).insert(df, keys)


def read_inserted(spark: SparkSession, target: str) -> DataFrame:
    """All committed rows of a table that ``insert_new`` made or added to."""
    return InsertTable(spark, target).read()
