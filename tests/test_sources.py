"""Readers and writers on small files."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mensula.operators import combine
from mensula.sizing import scratch_path, settle, small_side
from mensula.sources import readers, writers


def test_csv_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,big,text,day,flag,amount\n1,9000000000,x,2024-01-01,true,1.5\n2,5,,2024-01-02,false,\n")
    df = readers.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"id": "int", "big": "bigint", "text": "string", "day": "string", "flag": "string",
                               "amount": "double"}
    assert df.where("id = 2").first()["text"] is None
    assert df.first()["day"] == "2024-01-01"
    assert dict(readers.read_csv(spark, str(path), wide_integers_as_doubles=["big"]).dtypes)["big"] == "double"


def test_unknown_suffix(spark):
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, "table.xlsx")


def test_parquet_layout(spark, tmp_path):
    target = writers.save_parquet(spark.range(250_000).coalesce(1), str(tmp_path / "big.csv"))
    assert target.endswith("big.parquet")
    part = next(f for f in os.listdir(target) if f.endswith(".parquet"))
    meta = pq.ParquetFile(f"{target}/{part}").metadata
    assert meta.row_group(0).num_rows <= 100_000 and meta.num_rows == 250_000
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 5).cast("int").alias("period"))
    target = writers.save_parquet(df, str(tmp_path / "p"), partition_by="period")
    back = readers.read_period(spark, target, "3")
    assert back.count() == 200
    assert "PartitionFilters: [isnotnull(period" in back._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        readers.read_period(spark, target, 9)


def test_contacts_are_sorted(spark, tmp_path):
    writers.save_contacts(spark.createDataFrame([(3,), (1,), (2,)], "e int"), "e", str(tmp_path / "c"))
    assert [r["e"] for r in spark.read.csv(str(tmp_path / "c"), header=True, schema="e int").sort("e").collect()] == [1, 2, 3]


def test_ledger_appends(spark, tmp_path):
    for i in (1, 2):
        writers.append_records(spark.createDataFrame([(i, 1.5)], "trial_number int, value double"), str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 2
    with pytest.raises(ValueError):
        writers.save_summary(spark.range(1), str(tmp_path / "s"), kind="xml")


def test_append_is_distinct_and_checks_columns(spark):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, None, "n")], "e int, t int, v string")
    new = spark.createDataFrame([(2, 1, "b"), (2, 1, "changed"), (3, 2, "c"), (3, None, "n")], "e int, t int, v string")
    want = {(1, 1, "a"), (2, 1, "b"), (2, 1, "changed"), (3, 2, "c"), (3, None, "n")}
    for out in (combine.append_period(base, new), combine.append_period(base, new, "t", base_is_distinct=True)):
        rows = [tuple(r) for r in out.collect()]
        assert set(rows) == want and len(rows) == len(want)
    with pytest.raises(ValueError, match="differ"):
        combine.append_period(base, new.withColumn("t", F.col("t").cast("long")))


def test_small_side_bound(spark):
    df = spark.range(10).withColumn("s", F.struct(F.array("id").alias("a")))
    small = small_side(df, 10)
    assert small.count() == 10 and small.schema == df.schema
    assert small_side(df, 9) is df


def test_small_side_counts_bytes(spark):
    wide = spark.range(5_000).select("id", F.sequence(F.lit(0), F.lit(99)).alias("a"))
    assert small_side(wide, max_bytes=1 << 20) is wide
    assert small_side(wide, max_bytes=64 << 20).count() == 5_000


def test_settled_rows_are_written(spark):
    df = settle(spark.range(5).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_score_files_are_read_by_name_without_a_search_per_row(spark, tmp_path):
    base = f"{tmp_path}/a b[1]%20"
    for study, seed, n in (("m_1", 0, 40), ("m_1", 11, 70), ("x", 3, 5)):
        spark.range(n).repartition(3).write.parquet(f"{base}/{study}_seed{seed}_test_2.parquet")
    found = readers.read_score_files(spark, str(tmp_path) + "/a b?1?%20/*_test_2.parquet")
    counts = {(r["study"], r["seed"], r["split"]): r["count"] for r in found.groupBy("study", "seed", "split").count().collect()}
    assert counts == {("m_1", 0, "test_2"): 40, ("m_1", 11, "test_2"): 70, ("x", 3, "test_2"): 5}
    assert dict(found.dtypes) == {"id": "bigint", "study": "string", "seed": "int", "split": "string"}
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
    spark.range(3).write.parquet(f"{base}/other.parquet")
    with pytest.raises(ValueError, match="other.parquet"):
        readers.read_score_files(spark, str(tmp_path) + "/a b?1?%20/*.parquet")
