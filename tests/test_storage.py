import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.session import scratch_path, shared_root
from shelfcast.sources import loads, readers
from shelfcast.sources.catalog import ModelCatalog
from shelfcast.sources.snapshots import checked_identifier, checked_table

PRODUCTS = [("MI-001", "a", "s", "Milk", "Single"), ("MI-002", "b", "s", "Milk", "Single"),
            ("YO-001", "c", "s", "Yogurt", "Carton")]


def products(spark, rows=PRODUCTS):
    return spark.createDataFrame(rows, schemas.PRODUCTS)


def test_upsert_twice_keeps_one_copy(spark):
    table = loads.open_table(spark, scratch_path(spark, "t"), "products")
    assert table.upsert(products(spark)) == 3
    assert table.upsert(products(spark)) == 3
    assert table.read().count() == 3
    assert table.upsert(products(spark, [])) == 0


def test_upsert_keeps_columns_it_was_not_given(spark):
    table = loads.open_table(spark, scratch_path(spark, "t"), "products")
    table.upsert(products(spark))
    batch = spark.createDataFrame([("MI-001", "x", 1), ("MI-001", "y", 2)], "sku string, brand string, n int")
    assert table.upsert(batch, order="n") == 2
    row = table.read().filter("sku = 'MI-001'").first()
    assert (row["brand"], row["category"]) == ("y", "Milk")


def test_keys_alone_insert_only(spark):
    table = loads.open_table(spark, scratch_path(spark, "t"), "products")
    table.upsert(products(spark))
    table.upsert(spark.createDataFrame([("MI-001",), ("ZZ-001",), ("ZZ-001",)], "sku string"))
    rows = {r["sku"]: r["brand"] for r in table.read().collect()}
    assert rows == {"MI-001": "a", "MI-002": "b", "YO-001": "c", "ZZ-001": None}


def test_only_touched_partitions_are_rewritten(spark, small):
    table = loads.open_table(spark, scratch_path(spark, "t"), "daily_sales")
    table.upsert(small.daily_sales)
    before = set(table._live())
    one_month = small.daily_sales.filter(F.date_format("sale_date", "yyyy-MM") == "1997-03")
    table.upsert(one_month.withColumn("units_sold", F.lit(1.0)))
    assert len(before & set(table._live())) == len(before) - 1
    assert table.read().count() == small.daily_sales.count()


def test_a_dead_job_leaves_the_table_writable(spark, monkeypatch):
    """The data of an attempt is there, its log line is not: the next attempt succeeds."""
    table = loads.open_table(spark, scratch_path(spark, "t"), "products")
    table.upsert(products(spark))

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(DataFrameWriter, "json", die)
        with pytest.raises(OSError):
            table.upsert(products(spark, [("MI-001", "x", "s", "Milk", "Single")]))
    assert table.read().filter("brand = 'x'").count() == 0
    table.upsert(products(spark, [("MI-001", "x", "s", "Milk", "Single")]))
    assert table.read().filter("brand = 'x'").count() == 1


def test_null_keys_are_refused_and_harm_nothing(spark, small):
    table = loads.open_table(spark, scratch_path(spark, "t"), "daily_sales")
    rows = small.daily_sales.limit(10)
    table.upsert(rows)
    for write in (table.upsert, table.insert_new):
        with pytest.raises(ValueError, match="without a value"):
            write(rows.withColumn("sale_date", F.lit(None).cast("date")))
    assert table.read().count() == 10


def test_last_file_wins_however_files_are_packed(spark):
    """A small first file and a larger second one, which Spark reads first."""
    path = scratch_path(spark, "files")
    rows = [(f"MI-{i:05d}", "old", "s", "Milk", "Single") for i in range(3)]
    newer = [(f"MI-{i:05d}", "new", "s", "Milk", "Single") for i in range(20000)]
    for n, part in enumerate((rows, newer)):
        products(spark, part).coalesce(1).write.parquet(f"{path}/{n}")
    read = spark.read.option("recursiveFileLookup", True).parquet(path)
    for order in (read, read.select("*")):
        table = loads.open_table(spark, scratch_path(spark, "t"), "products")
        table.upsert(order)
        assert {r["brand"] for r in table.read().filter("sku < 'MI-00003'").collect()} == {"new"}
        first = loads.open_table(spark, scratch_path(spark, "t"), "products")
        first.insert_new(order)
        assert {r["brand"] for r in first.read().filter("sku < 'MI-00003'").collect()} == {"old"}


def test_csv_files_with_other_column_order_are_refused(spark, small):
    path = scratch_path(spark, "csv")
    frame = small.template.limit(4).coalesce(1)
    frame.write.option("header", True).csv(path)
    swapped = [c for c in frame.columns if c not in ("avg_temp", "inflation_index")]
    frame.select("inflation_index", "avg_temp", *swapped).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="header"):
        readers.read_enriched_csv(spark, path).collect()


def test_a_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError):
        checked_table("users")
    with pytest.raises(ValueError):
        checked_identifier("a; drop")
    table = loads.open_table(spark, scratch_path(spark, "t"), "products")
    with pytest.raises(ValueError):
        table.upsert(products(spark).withColumn("extra", F.lit(1)))


def test_csv_reader_refuses_bad_dates_and_missing_columns(spark, small):
    path = scratch_path(spark, "csv")
    bad = small.daily.limit(5).withColumn("date", F.lit("2024-13-45"))
    bad.write.option("header", True).csv(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_daily_csv(spark, path).collect()
    with pytest.raises(ValueError, match="week"):
        readers.read_weekly_csv(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_daily_csv(spark, path + "-absent")


def test_catalog_versions_are_numbers(spark):
    catalog = ModelCatalog(spark, scratch_path(spark, "catalog"))
    with pytest.raises(FileNotFoundError):
        catalog.get("m")
    with pytest.raises(ValueError):
        catalog.get("../m")
    for i in range(10):
        catalog.save(lambda path: None, "m", "ridge", {"mape": 1.0}, ["a"], category="Milk",
                     baselines={"a": (float(i), 1.0)})
    assert catalog.get("m")["version"] == 10
    assert catalog.get("m", "9")["version"] == 9
    assert catalog.latest_baselines().first()["mean"] == 9.0
    assert catalog.incumbents().count() == 0


def test_frames_that_went_through_an_arrow_step_are_stored(spark):
    """Files below an Arrow step offer their place, the step does not hand it up."""
    root = scratch_path(spark, "t")
    products(spark).write.parquet(f"{root}/files")
    read = spark.read.parquet(f"{root}/files")
    mapped = read.mapInArrow(lambda batches: batches, read.schema)
    for way in ("upsert", "insert_new"):
        table = loads.open_table(spark, scratch_path(spark, "t"), "products")
        assert getattr(table, way)(mapped) == 3
        assert table.read().count() == 3
    joined = read.join(read.select("sku"), "sku").groupBy("sku").agg(F.max("category").alias("category"))
    assert loads.open_table(spark, scratch_path(spark, "t"), "products").upsert(joined) == 3


def test_a_stable_batch_is_stored_as_any_other(spark, small, monkeypatch):
    """The same table with and without writing the batch down first, also where copies meet."""
    from shelfcast.sources import snapshots

    root = scratch_path(spark, "t")
    units = F.col("units_sold")
    small.daily_sales.unionByName(small.daily_sales.withColumn("units_sold", units + 1)).write.parquet(f"{root}/files")
    read = spark.read.parquet(f"{root}/files")
    tables = [loads.open_table(spark, scratch_path(spark, "t"), "daily_sales") for _ in range(2)]
    tables[0].upsert(read)
    written = []
    monkeypatch.setattr(snapshots, "cut_lineage", lambda frame: written.append(frame) or frame)
    tables[1].upsert(read, stable=True)
    assert not written
    first, second = (t.read() for t in tables)
    assert first.count() == small.daily_sales.count()
    assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0
