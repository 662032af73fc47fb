"""Readers, sinks and the file stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelpulse.session import new_folder, shared_folder
from parcelpulse.operators import carriers
from parcelpulse.sources import readers, sinks, versions
from parcelpulse.streaming.ingest import load_new_files


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


def _log(spark, rows):
    return spark.createDataFrame(rows, "id string, v int, year_month string")


def test_shared_folder_is_the_named_one(spark):
    named = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") == named and shared_folder(spark) == named


def test_reloading_a_month_replaces_only_that_month(spark, folder):
    first = _log(spark, [("a", 1, "2025-01"), ("b", 2, "2025-02")])
    sinks.reload_months(first, folder)
    sinks.reload_months(first, folder)
    sinks.reload_months(_log(spark, [("c", 3, "2025-02")]), folder)
    got = sorted(r.id for r in spark.read.parquet(folder).collect())
    assert got == ["a", "c"]


def test_a_reloaded_month_without_rows_is_emptied(spark, folder):
    sinks.reload_months(_log(spark, [("a", 1, "2025-01"), ("b", 2, "2025-02"), ("c", 3, "2025-03")]), folder)
    sinks.reload_months(_log(spark, [("d", 4, "2025-02")]), folder, reloaded=["2025-01", "2025-02", "2031-01"])
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == ["c", "d"]


def _ids(spark, folder, **kw):
    return sorted(r.id for r in versions.read_months(spark, folder, _log(spark, []).schema, **kw).collect())


def test_a_load_is_all_or_nothing(spark, folder, monkeypatch):
    assert _ids(spark, folder) == []
    one = versions.reload_months(_log(spark, [("a", 1, "2025-01"), ("b", 2, "2025-02"), ("n", 0, None)]), folder)
    new = _log(spark, [("c", 3, "2025-02"), ("d", 4, "2025-03")])
    versions.write_load(new, folder)  # dies before its commit
    assert _ids(spark, folder) == ["a", "b", "n"]
    with monkeypatch.context() as m:  # dies while it commits
        m.setattr(versions._Files, "rename", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            versions.reload_months(new, folder, ["2025-01"])
    assert _ids(spark, folder) == ["a", "b", "n"]
    two = versions.reload_months(new, folder, ["2025-01", "2031-01"])  # runs again
    assert (one, two) == (1, 2) and _ids(spark, folder) == ["c", "d", "n"]
    assert _ids(spark, folder, only=["2025-03"]) == ["d"] and _ids(spark, folder, number=1) == ["a", "b", "n"]
    assert versions.sweep(spark, folder) == 6 and _ids(spark, folder) == ["c", "d", "n"] and _ids(spark, folder, number=1) == []
    assert versions.sweep(spark, folder) == 0
    versions.reload_months(_log(spark, []), folder, ["2025-02", "2025-03", "__HIVE_DEFAULT_PARTITION__"])
    assert _ids(spark, folder) == []


def test_of_two_loads_at_once_one_fails(spark, folder, monkeypatch):
    versions.reload_months(_log(spark, [("a", 1, "2025-01")]), folder)
    load, seen = versions.write_load(_log(spark, [("z", 9, "2025-01")]), folder), versions.manifest(spark, folder)
    versions.reload_months(_log(spark, [("b", 2, "2025-02")]), folder)
    monkeypatch.setattr(versions, "manifest", lambda *_: seen)
    with pytest.raises(RuntimeError):
        versions.commit_load(spark, folder, load)
    monkeypatch.undo()
    assert _ids(spark, folder) == ["a", "b"]


def test_upsert_reads_touched_buckets_only(spark, folder):
    rows = spark.range(2000).select(F.format_string("k%05d", "id").alias("id"), F.lit(1).alias("v"))
    assert len(sinks.upsert_first_bucketed(rows, folder, ["id"], ["v"], 64)) == 64
    more = spark.createDataFrame([("k00007", 0), ("new", 5), ("new", 4), (None, 1), (None, 0)], "id string, v int")
    touched = sinks.upsert_first_bucketed(more, folder, ["id"], ["v"], 64)
    got = spark.read.parquet(folder)
    assert len(touched) <= 3 and got.count() == 2002
    assert {r.id: r.v for r in got.where("id is null or id in ('k00007', 'new')").collect()} == {"k00007": 1, "new": 4, None: 0}
    assert sinks.upsert_first_bucketed(more, folder, ["id"], ["v"], 64) == touched and spark.read.parquet(folder).count() == 2002
    read = sinks.read_buckets(spark, folder, got.schema, touched)
    assert "PartitionFilters: [bucket#" in read._jdf.queryExecution().toString()
    assert read.select(F.input_file_name()).distinct().count() < len(got.inputFiles()) / 10


def test_carriers_month_by_month_equal_the_full_run(spark, folder):
    """Two months with ties, a month loaded again with other rows, and an order that loses its only envelope."""
    kind = "logistic_order_id string, year_month string, carrier_code string, carrier_name string, seen long"
    jan = [("1", "2025-01", "A", "a", 1), ("1", "2025-01", "B", "b", 2), ("2", "2025-01", "C", "c", 3), ("3", "2025-01", "D", "d", 4)]
    feb = [("1", "2025-02", "B", "bb", 5), ("2", "2025-02", "A", "a", 6), ("2", "2025-02", "A", "a", 7)]
    again = [("1", "2025-01", "A", "a", 1), ("1", "2025-01", "A", "a", 8), ("2", "2025-01", "C", "c", 3)]
    make = lambda rows: spark.createDataFrame(rows, kind)
    full = lambda rows: {r.logistic_order_id: tuple(r) for r in carriers.carrier_per_order(make(rows)).select("logistic_order_id", "carrier_code", "carrier_name", "year_month", "n_envelopes").collect()}
    table = {}
    for load, now in ((jan, jan), (feb, jan + feb), (again, again + feb)):
        touched = {r.logistic_order_id: tuple(r) for r in carriers.load_carrier_months(make(load), folder).collect()}
        assert set(touched) >= {r[0] for r in load}
        table = {k: r for k, r in {**table, **touched}.items() if r[1] is not None}
        assert table == full(now)
    assert touched["3"][1:] == (None, None, None, None)


def test_tab_separated_text_comes_back(spark, folder):
    rows = [
        ("a\tb", 1, None), ("", 2, "n"), ("line\nbreak", 3, "x"), ('q"uo"te', None, "\\N"), ("\\N", 5, "\\"), (None, 6, " lead "),
        ('"', 7, "back\\slash\\"), ("\r\n", 8, '""'), ("\\\\N", 9, 'a"\tb'),
    ]
    df = spark.createDataFrame(rows, "x string, n int, y string")
    sinks.write_tsv(df, folder)
    assert sorted(map(tuple, sinks.read_tsv(spark, folder, df.schema).collect()), key=str) == sorted(rows, key=str)


def test_stored_upsert_keeps_the_first(spark, folder):
    sinks.upsert_first(_log(spark, [("a", 1, "2025-01"), ("a", 0, "2024-01")]), folder, ["id"], ["year_month"])
    sinks.upsert_first(_log(spark, [("a", 5, "2023-01"), ("b", 7, "2025-03")]), folder, ["id"], ["year_month"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(folder).collect()) == [("a", 0), ("b", 7)]
    sinks.upsert_first(_log(spark, [("a", 5, "2023-01")]), folder, ["id"], ["year_month"], reload=True)
    assert [(r.id, r.v) for r in spark.read.parquet(folder).collect()] == [("a", 5)]


def test_a_tree_keeps_its_folders_values(spark, folder):
    _log(spark, [("a", 1, "2025-01"), ("b", 2, "2025-02")]).write.partitionBy("year_month").parquet(f"{folder}/deep/er")
    _log(spark, [("c", 3, "2025-03")]).write.parquet(f"{folder}/flat")
    got = readers.scan_tree(spark, folder, ["id", "year_month", "country"], partitions=["year_month", "country"]).collect()
    assert sorted(map(tuple, got)) == [("a", "2025-01", None), ("b", "2025-02", None), ("c", "2025-03", None)]


def test_staged_folders_can_be_dropped(spark, tmp_path):
    from parcelpulse import session

    kept, session._MADE = session._MADE, {}
    try:
        df = session.staged(spark.range(3), "drop-me")
        path = session._MADE[spark.sparkContext.applicationId][0]
        assert df.count() == 3
        session.drop_staged(spark)
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    finally:
        session._MADE = kept


def test_append_takes_missing_months_only(spark, folder):
    sinks.reload_months(_log(spark, [("a", 1, "2025-01")]), folder)
    more = _log(spark, [("x", 9, "2025-01"), ("b", 2, "2025-02")])
    sinks.append_missing_months(more, folder)
    sinks.append_missing_months(more, folder)
    assert sorted(r.id for r in spark.read.schema(more.schema).parquet(folder).collect()) == ["a", "b"]


def test_first_writer_wins(spark):
    target = spark.createDataFrame([("a", 1, "2025-01")], "id string, v int, year_month string")
    new = _log(spark, [("a", 5, "2025-02"), ("b", 7, "2025-03"), ("b", 6, "2025-02")])
    got = sinks.insert_if_absent(new, target, ["id"], ["year_month"]).collect()
    assert [tuple(r) for r in got] == [("b", 6, "2025-02")]


def test_conform(spark):
    df = spark.createDataFrame([("1", "2025-01-01 00:00:00", "7", {"k": "v"}), ("2", "mal", "x", None)], "id string, t string, n string, m map<string, string>")
    got = readers.conform(df.withColumn("extra", F.lit(1)), "id string, t timestamp_ntz, n int, m string, gone double, year_month string", year_month=F.lit("2025-01"))
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        ("1", dt.datetime(2025, 1, 1), 7, '{"k":"v"}', None, "2025-01"), ("2", None, None, None, None, "2025-01"),
    ]


def test_month_scan_prunes_folders(spark, folder):
    df = spark.createDataFrame([("a", "CL", "2025-01"), ("b", "CL", "2025-02"), ("c", "PE", "2025-01")], "id string, country string, year_month string")
    df.write.partitionBy("country", "year_month").parquet(folder)
    got = readers.scan_months(spark, folder, "CL", ["2025-01"])
    assert [r.id for r in got.collect()] == ["a"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "year_month" in plan


def test_search_in_files_with_and_without_the_column(spark, folder):
    spark.createDataFrame([("1", "X"), ("2", "Y")], "id string, carrier string").write.parquet(f"{folder}/a/b")
    spark.createDataFrame([("3",)], "id string").write.parquet(f"{folder}/c")
    tree = readers.scan_tree(spark, folder)
    assert tree.count() == 3
    assert [r.id for r in readers.search_equal(tree, "carrier", "X").collect()] == ["1"]
    assert readers.search_equal(tree.drop("carrier"), "carrier", "X").count() == 0


def test_flatten_and_types(spark):
    df = spark.createDataFrame([(1, {"a": "b"}, [1], ("x",))], "i long, m map<string, string>, a array<int>, s struct<f: string>")
    assert tuple(sinks.flatten_nested(df).first()) == (1, '{"a":"b"}', "[1]", '{"f":"x"}')
    assert [sinks.relational_type(f.dataType) for f in df.schema] == ["BIGINT", "JSONB", "JSONB", "JSONB"]
    assert sinks.relational_type(T.DayTimeIntervalType()) == "TEXT"
    assert sinks.relational_type(T.DecimalType(6, 4)) == "NUMERIC(6,4)"


def test_tsv_writes_null_as_backslash_n(spark, folder):
    sinks.write_tsv(spark.createDataFrame([("a\tb", None), ("", "n")], "x string, y string"), folder)
    lines = [r.value for r in spark.read.text(folder).collect()]
    assert '"a\tb"\t\\N' in lines


def test_finished_experiment_is_not_run_again(spark, folder):
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)

    sinks.run_once(spark, folder, "e1", build)
    sinks.run_once(spark, folder, "e1", build)
    sinks.run_once(spark, folder, "e2", build)
    assert len(calls) == 2 and spark.read.parquet(folder).count() == 4


def test_read_features_by_split_and_month(spark):
    df = spark.createDataFrame([("a", "train", "2025-01"), ("b", "val", "2025-12"), ("c", "train", "2025-02")], "id string, split_set string, year_month string")
    assert [r.id for r in readers.read_features(df, "train", columns=["id"]).collect()] == ["a", "c"]
    assert [r.id for r in readers.read_features(df, months=["2025-12", "2025-02"]).collect()] == ["b", "c"]


def test_stream_loads_each_file_once(spark, folder):
    source, target, progress = f"{folder}/in", f"{folder}/out", f"{folder}/progress"
    schema = T.StructType.fromDDL("id string, event_dt timestamp_ntz, note string")

    def put(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{source}/{name}")

    def load():
        query = load_new_files(spark, source, target, progress, schema, "id string, event_dt timestamp_ntz, carrier double, year_month string")
        assert query.awaitTermination(120)
        return sorted((r.id, r.year_month) for r in spark.read.parquet(target).collect())

    put("f1", [("a", dt.datetime(2025, 1, 5), "x"), ("b", dt.datetime(2025, 2, 5), "x")])
    assert load() == [("a", "2025-01"), ("b", "2025-02")]
    assert load() == [("a", "2025-01"), ("b", "2025-02")]
    put("f2", [("c", dt.datetime(2025, 2, 6), "x")])
    assert load() == [("a", "2025-01"), ("b", "2025-02"), ("c", "2025-02")]
