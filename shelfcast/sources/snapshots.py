"""Keyed Parquet tables with upsert.

Data files are never changed. A write puts the touched partitions into a new folder of
its own and then appends one line per partition to the table's log; readers take, for each
partition, the newest replacement and what was added after it. A job that dies before
the log line leaves the table as it was, and can be run again. Keys are never NULL.
"""

import logging
import re
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.logger import PySparkLogger
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import constants as K
from shelfcast.session import cut_lineage

#: Name of the column that partitions the files of a table.
PARTITION = "_part"
_LOG = "version long, part string, mode string, path string, rows long"


def checked_identifier(name):
    if not re.fullmatch(K.IDENTIFIER_PATTERN, name):
        raise ValueError(f"unsafe identifier: {name!r}")
    return name


def checked_table(name):
    if name not in K.TABLE_KEYS:
        raise ValueError(f"unknown table: {name!r}")
    return name


def input_order(frame):
    """Order of the rows in the input: file, place of the block in it, row of the block.

    Spark packs files by size, so the partition alone is not the file order. A frame that is
    not read from files, or has lost their place on its way (through a join, an aggregation or
    an Arrow step), has the order of its rows.
    """
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    log = PySparkLogger.getLogger("DataFrameQueryContextLogger")
    level = log.level
    try:
        log.setLevel(logging.CRITICAL)  # that a frame has no place is an answer, not an error
        frame.select(*place)
    except AnalysisException:
        place = []
    finally:
        log.setLevel(level)
    return F.struct(*place, F.monotonically_increasing_id().alias("row"))


@dataclass
class SnapshotTable:
    """A table below `root` with the given schema, unique keys and partition expression."""

    spark: Any
    root: str
    schema: T.StructType
    keys: tuple
    part: Any = None

    def _log(self):
        try:
            return self.spark.read.schema(_LOG).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def _part(self):
        return (F.lit("all") if self.part is None else self.part).cast("string")

    def _live(self, parts=None):
        """Folders in force: per partition the newest replacement and what came after it.

        Only these reach the driver, not the history of the table.
        """
        log = self._log().filter("rows > 0")
        if parts is not None:
            log = log.filter(F.col("part").isin(*parts))
        replaced = F.when(F.col("mode") == "replace", F.col("version"))
        newest = log.groupBy(F.col("part").alias("of")).agg(F.coalesce(F.max(replaced), F.lit(0)).alias("since"))
        live = log.join(newest, F.col("part") == F.col("of")).filter("version >= since")
        return [r["path"] for r in live.orderBy("version", "part").select("path").collect()]

    def read(self, parts=None, with_part=False):
        """The rows in force; `with_part` adds the column that partitions the files, for pruning."""
        paths, schema = self._live(parts), self.schema
        if with_part:
            schema = T.StructType([*schema.fields, T.StructField(PARTITION, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if with_part:
            reader = reader.option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*schema.names)

    def _commit(self, frame, mode, batch_rows):
        version = (self._log().agg(F.max("version")).first()[0] or 0) + 1
        # a name no earlier attempt had, whether it lived to write its log line or not
        folder = f"{self.root}/data/version={version}-{uuid.uuid4().hex}"
        parted = frame.withColumn(PARTITION, self._part()).hint("rebalance", PARTITION)
        parted.write.partitionBy(PARTITION).parquet(folder)
        lines = [
            (version, part, mode, f"{folder}/{PARTITION}={part}", rows)
            for part, rows in batch_rows.items()
        ]
        log = self.spark.createDataFrame(lines, _LOG)
        log.coalesce(1).write.mode("append").json(f"{self.root}/log")

    def _batch_rows(self, batch):
        """Rows per partition; raises when a key is NULL."""
        without = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        counts = batch.groupBy(self._part().alias("part")).agg(
            F.count("*").alias("rows"), F.count_if(without).alias("without")
        ).collect()
        if missing := sum(r["without"] for r in counts):
            raise ValueError(f"{missing} rows without a value in {', '.join(self.keys)}")
        return {r["part"]: r["rows"] for r in counts}

    def _staged(self, batch, order, stable=False):
        """The batch with the place of its rows, run once and written to the shared folder.

        A stable batch gives the same rows whenever it runs and costs little to run again, so it
        is not written.
        """
        checked = self._checked(batch, order)
        position = input_order(checked) if order is None else F.col(order)
        kept = [c for c in checked.columns if c in self.schema.names]
        placed = checked.select(*kept, position.alias("_position"))
        return placed if stable else cut_lineage(placed)

    def _checked(self, batch, order):
        for name in [*batch.columns, *self.keys]:
            checked_identifier(name)
        unknown = set(batch.columns) - set(self.schema.names) - {order}
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
        return batch

    def _one_per_key(self, staged, pick):
        """One row per key by partial aggregation, so copies of a key shrink map-side."""
        others = [c for c in staged.columns if c != "_position" and c not in self.keys]
        if not others:
            return staged.select(*self.keys).distinct()
        packed = pick(F.struct(*others), F.col("_position")).alias("_row")
        return staged.groupBy(*self.keys).agg(packed).select(*self.keys, "_row.*")

    def _conformed(self, frame):
        kinds = {f.name: f.dataType for f in self.schema.fields}
        return frame.select(*[
            (F.col(c) if c in frame.columns else F.lit(None)).cast(kinds[c]).alias(c)
            for c in self.schema.names
        ])

    def upsert(self, batch, order=None, stable=False):
        """Insert new keys, replace the supplied columns of known ones; returns input rows.

        Among copies of a key the last one in input order (see input_order), or by `order`,
        counts. The batch runs once, unless it is `stable` (a plain read of files, say), which saves
        writing it down first; a NULL key raises before anything is stored. Columns the batch lacks
        keep their old values. A batch of keys alone adds the unknown ones. Only partitions the
        batch touches are read and rewritten.
        """
        if set(batch.columns) - {order} <= set(self.keys):
            return self.insert_new(batch, order, stable)
        staged = self._staged(batch, order, stable)
        rows = self._batch_rows(staged)
        if not rows:
            return 0
        latest = self._one_per_key(staged, F.max_by)
        supplied = [c for c in latest.columns if c not in self.keys]
        new = latest.select(*self.keys, F.struct(*supplied).alias("_new"))
        merged = self.read(list(rows)).join(new, list(self.keys), "full_outer")
        columns = [
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in supplied else F.col(c) for c in self.schema.names
        ]
        self._commit(self._conformed(merged.select(*columns)), "replace", rows)
        return sum(rows.values())

    def insert_new(self, batch, order=None, stable=False):
        """Insert unknown keys only, the first of several copies; returns input rows.

        The new rows are added next to the stored ones, which are not rewritten. `stable` is as
        in upsert.
        """
        staged = self._staged(batch, order, stable)
        rows = self._batch_rows(staged)
        if not rows:
            return 0
        first = self._one_per_key(staged, F.min_by)
        stored = self.read(list(rows)).select(*self.keys)
        fresh = cut_lineage(self._conformed(first.join(stored, list(self.keys), "left_anti")))
        fresh_rows = self._batch_rows(fresh)
        if fresh_rows:
            self._commit(fresh, "add", fresh_rows)
        return sum(rows.values())


def table(spark, root, name, schema, part=None):
    """A table of the fixed list with its unique key."""
    checked_table(name)
    return SnapshotTable(spark, f"{root}/{name}", schema, tuple(K.TABLE_KEYS[name]), part)
