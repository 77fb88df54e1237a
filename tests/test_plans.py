"""Shape of physical plans and of the code: what must hold at any scale."""

import re
from pathlib import Path
from types import SimpleNamespace

import pytest

from paywatch.columns import FROM_KEYS, TO_KEYS
from paywatch.operators import dedup, evaluation, sampling
from paywatch.operators.account_windows import _minute_frames, outgoing_features
from paywatch.operators.hot_keys import HotKeys
from paywatch.plans.features import payment_features, transaction_features
from paywatch.session import shared_folder, stage
from paywatch.sources import event_payments as source
from tests.helpers import skewed_payments

PACKAGE = Path(__file__).resolve().parents[1] / "paywatch"
COLD = HotKeys(tuple(FROM_KEYS)), HotKeys(tuple(TO_KEYS))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tx(spark):
    return stage(skewed_payments(spark, 500), "plan_payments")


def test_windows_share_two_shuffles(tx):
    text = plan(payment_features(tx, *COLD))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert "SinglePartition" not in text
    assert len(re.findall(r"\bSort \[", text)) == 5


def test_account_lookup_adds_no_shuffle_of_payments(spark, tx):
    accounts = source.raw_accounts(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(transaction_features(tx, accounts, *COLD))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\((?:from|to)_bank#\d+, (?:from|to)_account#\d+L", text)) == 4
    assert len(re.findall(r"SortMergeJoin \[(?:from|to)_bank", text)) == 2


def test_unused_windows_are_pruned(tx):
    text = plan(outgoing_features(tx, COLD[0]).select("tx_id", "txn_count_1h_from"))
    assert "row_number" not in text and "stddev" not in text and "lag(" not in text


def test_scan_reads_only_needed_columns(tx):
    text = plan(outgoing_features(tx, COLD[0]).select("tx_id", "txn_count_1h_from"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"tx_id", "ts", "from_bank", "from_account"}


def test_hot_rows_join_history_without_another_shuffle(spark, tx):
    hot = HotKeys(tuple(FROM_KEYS), frame=spark.createDataFrame([(1, 1)], "from_bank int, from_account bigint"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(outgoing_features(tx, hot).select("tx_id", "txn_count_7d_from"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    top = text[text.index("SortMergeJoin [_group"):]
    left = top[:top.index("FileScan")]
    assert len(re.findall(r"Exchange hashpartitioning\(_group", left)) == 1


def test_hot_accounts_cost_one_more_shuffle(spark, tx):
    """With hot accounts the payments pass three exchanges: payer, pair of accounts, payee. Lookups reuse theirs."""
    accounts = source.raw_accounts(spark, "/root/testdata/sf0.001")
    hot = tuple(HotKeys(tuple(k), frame=spark.createDataFrame([(1, 1)], f"{k[0]} int, {k[1]} bigint")) for k in (FROM_KEYS, TO_KEYS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(transaction_features(tx, accounts, *hot))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines, depth, wide = text.splitlines(), [], 0
    # The payments' own branch: from the top, always the left child.
    for line in lines:
        bare = line.lstrip(" :+-*()0123456789")
        indent = len(line) - len(line.lstrip(" :+-"))
        if depth and indent <= depth[-1] and ":" in line[:depth[-1]]:
            continue
        depth.append(indent)
        wide += bare.startswith("Exchange hashpartitioning")
        if "FileScan" in line:
            break
    assert wide == 3
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_curve_has_no_row_level_single_task(tx):
    scores = stage(source.synthetic_scores(tx), "plan_scores")
    text = plan(evaluation.score_curve(scores))
    for match in re.finditer(r"Exchange SinglePartition", text):
        below = text[match.end():].splitlines()[1]
        assert "Aggregate" in below or "Project" in below, below


def test_sampling_and_dedup_combine_before_shuffling(tx):
    events = tx.withColumnRenamed("ts", "event_timestamp")
    text = plan(sampling.class_cap(events, {0: 10, 1: 2}))
    assert "partial_count" in text
    # Rows themselves pass through filters only: no exchange holds their other columns.
    assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*payment_format", text)
    assert "partial_min_by" in plan(dedup.dedupe_keys(events))


def test_day_split_prunes_rows_before_anything_else(tx):
    from paywatch.operators.splits import train_test
    text = plan(train_test(tx, 10, "ts")[0])
    assert re.search(r"DataFilters: \[[^\]]*ts", text)


def test_day_split_reads_only_its_folders(spark, tx, tmp_path):
    from paywatch.operators.splits import train_test, trailing_windows
    from paywatch.sources.tables import overwrite_features
    events = tx.withColumnRenamed("ts", "event_timestamp")
    overwrite_features(events, "pruned_features", str(tmp_path / "features"), files_per_day=1)
    table = spark.table("pruned_features")
    days = table.select("event_date").distinct().count()
    for out in (train_test(table, 10)[1], trailing_windows(table, (3, 7))):
        rows = out.select("tx_id", "event_timestamp").collect()
        text = plan(out)
        assert rows and re.search(r"PartitionFilters: \[[^\]]*event_date", text)
    assert train_test(table, 10)[0].count() + train_test(table, 10)[1].count() == events.count() and days > 15


def test_no_bulk_collect_in_the_package():
    allowed = {
        "operators/boosting.py": 6,       # saved edges and nodes, bins per column, open nodes, 2 ** 16 cells, validation cells
        "operators/hot_keys.py": 2,       # at most MAX_HOT_KEYS rows per side
        "operators/preparation.py": 2,    # one row per feature
        "operators/quality.py": 1,        # one row per split
    }
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:  # bounded by parameters there
            continue
        text = path.read_text()
        name = str(path.relative_to(PACKAGE))
        assert "toPandas" not in text and "localCheckpoint" not in text and "crossJoin" not in text, name
        assert len(re.findall(r"\.collect\(\)", text)) == allowed.get(name, 0), name


def test_no_pairwise_joins(spark, tx):
    hot = tuple(HotKeys(tuple(k), frame=spark.createDataFrame([(1, 1)], f"{k[0]} int, {k[1]} bigint"))
                for k in (FROM_KEYS, TO_KEYS))
    accounts = source.raw_accounts(spark, "/root/testdata/sf0.001")
    events = tx.withColumnRenamed("ts", "event_timestamp")
    for df in (transaction_features(tx, accounts, *hot), sampling.enforce_positive_rate(events, 0.01),
               evaluation.top_k_shares(stage(source.synthetic_scores(tx), "plan_scores"))):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_only_local_masters_get_a_temporary_folder():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                               sparkContext=SimpleNamespace(master=master, applicationId=f"test-{master}"))
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_minute_frames_sort_copies_twice_dealt_out_by_week(spark):
    """A task holds a few sorts of narrow rows, sized by the copies: one exchange by week behind them, none of the sorts by day alone."""
    minutes = spark.sql("""SELECT 1 AS bank, id AS account, make_timestamp_ntz(2024, 1, 1, 0, 0, 0) + make_dt_interval(id) AS ts, id AS n,
        1d AS total, 1d AS low, 1d AS high, 1L AS similar, 1L AS cross, 1L AS gaps, CAST(1 AS DECIMAL(19, 0)) AS gap, 1d AS mean, 0d AS _m2
        FROM range(9)""")
    text = plan(_minute_frames(minutes, ["bank", "account"]))
    copies = text[:text.index("Generate explode")]
    assert len(re.findall(r"\bSort \[", copies)) == 2
    assert re.findall(r"Exchange hashpartitioning\(([^)]*)\)", copies) and "_week" in copies[copies.index("Exchange hashpartitioning"):][:80]
