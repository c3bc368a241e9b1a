"""Star tables whose daily and weekly frames are loaded once per application.

The load job writes both as Parquet, daily rows partitioned by month and weekly rows by year,
into the shared folder of the cluster; analytical queries then scan those tables with pruning and
pushdown instead of repeating the joins. Tables belong to one application and one data folder.
"""

from functools import cached_property

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.session import scratch_path
from shelfcast.sources.snapshots import PARTITION
from shelfcast.sources.star_tables import StarTables

_LOADED = {}


class StoredTables(StarTables):
    def _stored(self, name, build, part, with_part=False):
        """The stored table; `build` gives its plan and is only called for the load.

        `part` names the partition column and gives its expression; one task writes a partition.
        """
        key, (column, value) = (self.spark.sparkContext.applicationId, self.folder, name), part
        if key not in _LOADED:
            frame, path = build(), scratch_path(self.spark, name)
            frame.withColumn(column, value).hint("rebalance", column).write.partitionBy(column).parquet(path)
            _LOADED[key] = path, frame.schema
        path, schema = _LOADED[key]
        kind = "string" if column == PARTITION else "integer"
        read = self.spark.read.schema(StructType([*schema.fields]).add(column, kind)).parquet(path)
        return read.select(*schema.names, *([column] if with_part else []))

    def _stored_daily(self, with_part):
        month = PARTITION, F.date_format("date", "yyyy-MM")
        return self._stored("daily", lambda: StarTables(self.spark, self.folder).daily, month, with_part)

    @cached_property
    def daily(self):
        return self._stored_daily(False)

    @property
    def daily_sales_by_month(self):
        """`daily_sales` with the month that partitions its files, for pruning while a query runs."""
        return self.sales_of(self._stored_daily(True), PARTITION)

    @cached_property
    def weekly(self):
        return self._stored("weekly", lambda: self.weekly_computed, ("_year", F.year("week")))

    @cached_property
    def weekly_computed(self):
        """The panel as a plan over the stored daily table."""
        return StarTables.weekly.func(self)
