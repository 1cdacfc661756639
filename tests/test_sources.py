"""Sources, sinks and the streaming extension."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.config import PanelConfig
from tidegrid.functions.common import bounded_rows, cut
from tidegrid.operators import retrieval
from tidegrid.plans import pipeline
from tidegrid.sources import tables
from tidegrid.streaming.panel_stream import weekly_totals


def test_csv_and_retail_panel(spark, tmp_path):
    from tidegrid.operators.panel import retail_panel

    (tmp_path / "train.csv").write_text("Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday\n1,1,2015-07-31,5,5,1,1,0,1\n1,1,2015-08-01,0,5,1,1,a,1\n2,1,bad,7,5,1,1,0,1\n2,1,2015-08-01,7,5,0,1,0,1\n")
    (tmp_path / "store.csv").write_text("Store,StoreType,Assortment,CompetitionDistance,CompetitionOpenSinceMonth,CompetitionOpenSinceYear,Promo2,Promo2SinceWeek,Promo2SinceYear,PromoInterval\n1,c,a,10,1,2000,0,,,\n")
    out = retail_panel(tables.read_csv(spark, str(tmp_path / "train.csv"), tables.TRAIN_SCHEMA), tables.read_csv(spark, str(tmp_path / "store.csv"), tables.STORE_SCHEMA)).orderBy("time_series_id").collect()
    assert [(r.time_series_id, r.ds, r.y, r.StoreType, r.is_short_series) for r in out] == [("1", dt.date(2015, 7, 31), 5, "c", False), ("2", None, 7, None, False)]


def test_texts_and_index(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.py").write_text("def f(z):\n  1\n")
    (tmp_path / "a" / "b" / "y.py").write_text("class C:\n  2")
    (tmp_path / "a" / "n.txt").write_text("no")
    index = retrieval.build_index(tables.read_texts(spark, str(tmp_path / "a")))
    path = str(tmp_path / "index")
    tables.write_parquet(index, path)
    got = tables.load_index(spark, path)
    assert {r.object_name for r in got.collect()} == {"f", "C"} and len(got.first().embedding) == 64
    with pytest.raises(FileNotFoundError):
        tables.load_index(spark, str(tmp_path / "none"))


def test_table_write_and_pipeline(spark, tmp_path):
    rows = [("a", dt.date(2023, 1, 2) + dt.timedelta(days=7 * i), float(i % 5)) for i in range(60) if i != 30]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tg LOCATION '{tmp_path}'")
    spark.createDataFrame(rows, "id string, date date, y double").createOrReplaceTempView("raw_rows")
    cfg = PanelConfig(source_table="raw_rows", output_table="tg.out", key_columns=("id",))
    out = pipeline.run(spark, cfg)
    assert out.count() == 60 and "table_update_datetime" in out.columns and out.where("y is null").first().y_clean_int == 2.5  # between 4 and 1
    reports = pipeline.diagnose(out, cfg)
    assert reports["short_report"].first().short_series == 1 and reports["nulls"].where("column_name = 'y'").first().null_count == 1
    assert out.select("y_int").where("y_int is null").count() == 0
    with pytest.raises(ValueError):
        pipeline.preprocess(spark.table("raw_rows"), PanelConfig(key_columns=("id",), numeric=("nothing",)))
    spark.sql("DROP DATABASE tg CASCADE")


def test_stream(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, d), 1.0) for d in (1, 7, 8, 9)]
    df = spark.createDataFrame(rows, "g string, ts timestamp, y double")
    df.write.parquet(str(tmp_path / "in"))
    s = weekly_totals(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "g", "ts", "y")
    q = s.writeStream.outputMode("complete").format("memory").queryName("weeks").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r.ds, r.y) for r in spark.sql("select * from weeks order by ds").collect()] == [(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 8), 2.0)]


def test_search_many(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [1.0]), (6, [0.0, 0.0])], "vec_id long, embedding array<float>")
    q = items.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).where("query_id in (1, 3, 4)")
    got = {(r.query_id, r.rank): r.vec_id for r in retrieval.search_many(items, q, k=2).collect()}
    assert got[1, 1] == 1 and got[1, 2] == 2 and got[3, 1] == 3 and len(got) == 4
    assert retrieval.search_many(items, q.limit(0)).count() == 0 and retrieval.search_many(items.limit(0), q).count() == 0


def test_search_many_with_queries_of_several_lengths(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 0.0, 1.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(10, [0.9, 0.1, 0.0]), (11, [0.1, 0.9]), (12, [1.0]), (13, [1.0, 0.2]), (14, [0.0, 0.1, 0.9])], "query_id long, query array<float>").coalesce(1)
    got = {(r.query_id, r.rank): r.vec_id for r in retrieval.search_many(items, q, k=1).collect()}
    assert got == {(10, 1): 3, (11, 1): 2, (13, 1): 1, (14, 1): 4}


def test_helpers(spark):
    df = spark.range(10)
    assert cut(df).count() == 10 and len(bounded_rows(df, 10, "rows")) == 10
    with pytest.raises(ValueError):
        bounded_rows(df, 9, "rows")
    assert tables.quoted("a.b`c") == "`a`.`b``c`" and len(tables.to_pandas(df, 3)) == 3


def test_console(spark):
    from tidegrid.config import RetrievalConfig
    from tidegrid.plans import console

    index = retrieval.build_index(spark.createDataFrame([("a.py", "def fill gaps(x):\n  fill gaps"), ("b.py", "def other(y):\n  nothing")], "file_path string, text string"))
    lines, said = iter(["", "files", "fill gaps", "more", "quit", "never"]), []
    history = console.converse(index, RetrievalConfig(top_k=1, max_history_turns=1), ask=lambda _: next(lines), say=said.append)
    assert said[0] == "a.py\nb.py" and "a.py :: fill" in said[1] and [q for q, _ in history] == ["more"]
    assert console.converse(index, ask=lambda _: (_ for _ in ()).throw(EOFError)) == [] and console.environment()["spark"]
    assert console.answer(index, "x", [("q", "a")], RetrievalConfig(), chat=lambda m: str(len(m))) == "4"


def test_index_is_built_when_missing(spark, tmp_path):
    for n, t in (("a.py", "x = 1\n"), ("b.sql", "select 1"), ("c.txt", "no")):
        (tmp_path / n).write_text(t)
    assert tables.read_texts(spark, str(tmp_path), ("*.py", "*.sql")).count() == 2
    path, built = f"file://{tmp_path}/index", []

    def build():
        built.append(1)
        return spark.range(3)

    assert not tables.exists(spark, path) and tables.saved_index(spark, path, build).count() == 3
    assert tables.saved_index(spark, path, build).count() == 3 and len(built) == 1 and tables.exists(spark, path)
    assert tables.saved_index(spark, path, build, anew=True).count() == 3 and len(built) == 2
    assert len(tables.preview(spark.range(9), 4)) == 4


def test_cuts_are_swept(spark):
    import os

    from tidegrid.functions import common

    got = common.cut(spark.range(5))
    at = got.inputFiles()[0].split("file://")[1]
    assert os.path.exists(at)
    common.sweep()
    assert not os.path.exists(at)


def test_index_errors(spark):
    files = spark.createDataFrame([("a.py", "x = 1")], "file_path string, text string")
    assert retrieval.checked_index(files).count() == 1
    for bad in (files.limit(0), files.withColumn("text", F.lit(" \n ")), files.withColumn("text", F.lit(1))):
        with pytest.raises(ValueError):
            retrieval.checked_index(bad)
