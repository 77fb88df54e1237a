import uuid

import pytest

from paywatch.columns import RUN_SCHEMA
from paywatch.sources import runs, tables


@pytest.fixture
def name(spark):
    table = f"t_{uuid.uuid4().hex[:10]}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_append_creates_aligns_and_follows_new_columns(spark, name):
    first = spark.createDataFrame([(1, "a")], "id int, note string")
    tables.append_table(first, name)
    assert tables.add_column_if_absent(spark, name, "run_id", "string")
    assert not tables.add_column_if_absent(spark, name, "RUN_ID", "string")
    tables.append_table(spark.createDataFrame([("r", 2, 9.0)], "run_id string, id int, extra double"), name)
    assert sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[0]) == [(1, "a", None), (2, None, "r")]


@pytest.mark.parametrize("folder", [False, True])
def test_append_once_keeps_one_copy_of_a_batch(spark, name, folder, tmp_path):
    table = str(tmp_path / name) if folder else name
    batch = lambda run, ids: spark.createDataFrame([(i, run) for i in ids], "id int, run_id string")
    for run, ids in (("a", [1, 2]), ("b", [3]), ("a", [1, 2, 4]), ("b", [3])):
        tables.append_once(batch(run, ids), table)
    rows = tables.read_table(spark, table).select("run_id", "id").collect()
    assert sorted(map(tuple, rows)) == [("a", 1), ("a", 2), ("a", 4), ("b", 3)]


def test_append_once_to_a_table_without_batches(spark, name):
    tables.append_table(spark.createDataFrame([(1, "a")], "id int, run_id string"), name)
    for _ in range(2):
        tables.append_once(spark.createDataFrame([(2, "b"), (3, "b")], "id int, run_id string"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b"), (3, "b")]


def test_failed_version_leaves_the_old_one(spark, name, tmp_path):
    path = str(tmp_path / "versions")
    first = tables.replace_version(spark.range(5), name, path)
    bad = spark.range(3).selectExpr("CAST(raise_error('no') AS BIGINT) AS id")
    with pytest.raises(Exception):
        tables.replace_version(bad, name, path)
    assert spark.table(name).count() == 5
    reader = spark.table(name)
    second = tables.replace_version(spark.table(name).where("id > 1"), name, path)
    assert (reader.count(), spark.table(name).count()) == (5, 3) and first != second
    tables.drop_versions(spark, path, second)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP VIEW {name}")


def test_files_of_a_day_follow_its_rows(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "id AS tx_id", "CAST(timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, IF(id < 900, 0, 1)) AS timestamp_ntz) AS event_timestamp")
    path = str(tmp_path / "features")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # small files would be joined
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    tables.overwrite_features(rows, path, rows_per_file=100)
    spark.conf.set(setting, before)
    files = spark.read.parquet(path).selectExpr("event_date", "input_file_name() AS f").distinct().groupBy("event_date").count().collect()
    found = {str(r["event_date"]): r["count"] for r in files}
    assert found["2024-01-02"] == 1 and 1 < found["2024-01-01"] <= 9
    assert spark.read.parquet(path).count() == 1000


def test_overwrite_replaces(spark, name):
    for n in (5, 2):
        tables.overwrite_table(spark.range(n), name)
        assert spark.table(name).count() == n


def test_alignment_casts_and_logs(spark, caplog):
    target = spark.createDataFrame([], "b bigint, a string, z double").schema
    out = tables.align_to(spark.createDataFrame([(1, 2, 3)], "a int, B int, gone int"), target)
    assert out.schema == target or [f.dataType for f in out.schema] == [f.dataType for f in target]
    assert tuple(out.first()) == (2, "1", None) and "gone" in caplog.text


def test_run_row_fits_the_run_table(spark, name):
    summary = spark.range(1).selectExpr("timestamp_ntz'2024-01-01 00:00:00' AS cutoff_ts", "10L AS n_train", "5L AS n_test",
                                        "0.1D AS test_fraud_rate", "0.5D AS auc_pr", "0.6D AS roc_auc", "0.7D AS ks",
                                        "0.75D AS best_threshold_youden")
    row = runs.run_row(summary, "r1", "m_r1", {"max_depth": 5, "learning_rate": 0.1}, ["a", "b"], "p")
    assert row.columns == RUN_SCHEMA.names
    runs.log_run(spark, row, name)
    runs.log_run(spark, row, name)
    got = spark.table(name).collect()
    assert len(got) == 2 and got[0]["features_json"] == '["a","b"]'
    assert got[0]["params_json"] == '{"max_depth":5,"learning_rate":0.1}' and got[0]["created_at"] is not None


def test_sql_text_over_frames(spark):
    assert tables.run_sql(spark, "SELECT sum(id) AS s FROM {t}", t=spark.range(4)).first()["s"] == 6
