"""Readers and writers of files; columns are taken by name and cast, never inferred.

Of several CSV files all must have the columns of the first in its order; a file with another
header raises, as Spark reads by place.
"""

from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import scalars as S
from shelfcast.operators.cleaning import require_columns


def _typed(frame, field):
    """Column of the wanted type; text flags True/False count as 1/0."""
    c, kind = F.col(field.name), field.dataType.simpleString()
    have = dict(frame.dtypes)[field.name]
    if kind == "double":
        return S.nan_to_null(c.cast("double")).alias(field.name)
    if kind == "int" and have == "string":
        word = F.lower(c)
        number = (
            F.when(word == "true", 1).when(word == "false", 0)
            .otherwise(F.when(~word.isin("true", "false"), c).cast("double").cast("int"))
        )
        return number.alias(field.name)
    return c.cast(kind).alias(field.name)


def conform(frame, schema):
    """The schema's columns present in the frame, in schema order and type."""
    return frame.select(*[_typed(frame, f) for f in schema.fields if f.name in frame.columns])


def _read_csv(spark, path, schema, required=None):
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    first = reader.csv(path)
    require_columns(first, required or schema.names, "CSV file")
    return conform(reader.schema(first.schema).option("enforceSchema", False).csv(path), schema)


def read_daily_csv(spark, path):
    """Daily sales; an unreadable date or number raises, and so does a missing file."""
    return _read_csv(spark, path, schemas.DAILY)


def read_weekly_csv(spark, path):
    return _read_csv(spark, path, schemas.WEEKLY)


def read_enriched_csv(spark, path):
    return _read_csv(spark, path, schemas.ENRICHED)


def read_batch_parquet(spark, path):
    """Daily-grain batch file; columns it lacks stay absent."""
    return conform(spark.read.parquet(path), schemas.DAILY)


def run_query(spark, query, params=None):
    """Parameterised SQL over registered tables (`:name` markers)."""
    return spark.sql(query, args=params or {})


def read_database(spark, url, query, partitioning=None, **options):
    """Query of an external database; `partitioning` splits the read over tasks.

    `partitioning` holds column, lower, upper and parts; without it one task reads.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partitioning is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partitioning["column"])
        .option("lowerBound", partitioning["lower"]).option("upperBound", partitioning["upper"])
        .option("numPartitions", partitioning["parts"]).load()
    )


def write_by_year(frame, date, path):
    """Parquet snapshot partitioned by the year of a date column."""
    partition = F.year(date).alias("_year")
    frame.select("*", partition).write.mode("overwrite").partitionBy("_year").parquet(path)


def write_artifacts(enriched, weekly, folder):
    """Snapshots of the enriched and the modelling weekly tables."""
    write_by_year(enriched, "week", f"{folder}/weekly_enriched")
    write_by_year(weekly, "week", f"{folder}/weekly_modeling")
