"""Weekly sums of daily files as they arrive, upserted into a keyed table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import constants as K
from shelfcast.schemas import DAILY
from shelfcast.sources.snapshots import SnapshotTable

SECONDS_PER_DAY = 86400
WEEKLY_SUMS = T.StructType([
    T.StructField("sku", T.StringType()), T.StructField("week", T.DateType()),
    T.StructField("channel", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("units_sold", T.DoubleType()), T.StructField("delivered_qty", T.DoubleType()),
    T.StructField("stock_available", T.DoubleType()),
    T.StructField("promotion_flag", T.IntegerType()),
    T.StructField("price_unit", T.DoubleType()), T.StructField("delivery_days", T.DoubleType()),
])


def weekly_sums_table(spark, root):
    return SnapshotTable(spark, root, WEEKLY_SUMS, K.WEEKLY_KEY, F.date_format("week", "yyyy-MM"))


def stream_weekly_sums(daily_stream, late_days=K.SETTLE_DAYS):
    """Weekly sums of a daily stream; rows up to `late_days` late still count.

    The watermark bounds the state to the weeks still open. Seven-day windows start at
    day 4 after the epoch's Thursday, which makes them begin on Mondays. Event times are
    counted from the epoch day, so the session's time zone does not shift them.
    """
    midnight = F.timestamp_seconds(F.unix_date("date") * SECONDS_PER_DAY)
    events = daily_stream.withColumn("ts", midnight).withWatermark("ts", f"{late_days} days")
    week = F.window("ts", "7 days", startTime="4 days")
    sums = events.groupBy(*K.SERIES, week).agg(
        F.sum("units_sold").alias("units_sold"), F.sum("delivered_qty").alias("delivered_qty"),
        F.max("stock_available").alias("stock_available"),
        F.max("promotion_flag").alias("promotion_flag"),
        F.avg("price_unit").alias("price_unit"), F.avg("delivery_days").alias("delivery_days"),
    )
    start_day = (F.unix_seconds("window.start") / SECONDS_PER_DAY).cast("int")
    return sums.withColumn("week", F.date_from_unix_date(start_day)).select(*WEEKLY_SUMS.names)


def run_weekly_stream(spark, source, table_root, checkpoint, late_days=K.SETTLE_DAYS):
    """Processes all files that arrived since the last run, then stops; returns the table.

    Each micro-batch upserts the weeks it changed. A batch that is replayed after a
    failure writes the same rows again under the same keys.
    """
    target = weekly_sums_table(spark, table_root)
    daily = spark.readStream.schema(DAILY).option("recursiveFileLookup", True).parquet(source)

    def store(batch, _batch_id):
        held = batch.persist()
        target.upsert(held)
        held.unpersist()

    query = (
        stream_weekly_sums(daily, late_days).writeStream.outputMode("update")
        .foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return target
