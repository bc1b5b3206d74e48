"""The streamed price log: several files, late and too-late rows, a replayed batch."""

from datetime import datetime

from pyspark.sql import functions as F

from agrospark.session import scratch_path
from agrospark.streaming import rollups as S

SCHEMA = "ts timestamp, crop string, price double, file int"


def landed(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 1, d, h), c, p, f) for d, h, c, p, f in rows], SCHEMA)
    src = S.land_arrivals(df, "file", "log-test")
    return spark.readStream.schema(df.drop("file").schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_late_rows_count_until_the_watermark(spark):
    stream = landed(spark, [(1, 8, "soy", 1.0, 1), (1, 9, "corn", 5.0, 1), (2, 8, "soy", 2.0, 2),
                            (1, 20, "soy", 3.0, 2),                  # late, newer than the row of its day
                            (1, 7, "corn", 9.0, 2),                  # late, older: changes nothing
                            (9, 8, "soy", 4.0, 3), (9, 9, "soy", 6.0, 4),
                            (1, 23, "soy", 8.0, 5),                  # its day is closed
                            (9, 23, "soy", 7.0, 5)])
    got = S.price_log(spark, stream, "ts", "crop", "log-test", "1 day")
    assert {(r.day.day, r.crop): r.price for r in got.collect()} == {
        (1, "soy"): 3.0, (1, "corn"): 5.0, (2, "soy"): 2.0, (9, "soy"): 7.0}


def test_a_replayed_batch_replaces_its_own_rows(spark):
    path = scratch_path(spark, "log-replay")
    first = spark.createDataFrame([(1, "soy", 1.0), (2, "soy", 2.0)], "day int, crop string, price double")
    second = spark.createDataFrame([(1, "soy", 3.0)], "day int, crop string, price double")
    for batch, i in ((first, 0), (second, 1), (second, 1), (first, 0)):
        S.write_log_batch(batch, i, path)
    schema = first.withColumn("batch", F.lit(0).cast("long")).schema
    assert spark.read.parquet(path).count() == 3
    assert {(r.day, r.price) for r in S.read_log(spark, path, schema, "crop").collect()} == {(1, 3.0), (2, 2.0)}


def test_nothing_landed_gives_an_empty_log(spark):
    path = scratch_path(spark, "log-empty")
    empty = spark.createDataFrame([], "day int, crop string, price double")
    S.write_log_batch(empty, 0, path)
    assert S.read_log(spark, path, empty.withColumn("batch", F.lit(0).cast("long")).schema, "crop").count() == 0
