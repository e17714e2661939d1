from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from tickloom.operators import quality
from tickloom.operators.quality import (
    DataQualityError,
    LogContext,
    NonNegativeCheck,
    NullCheck,
    RowCountCheck,
    UniquenessCheck,
    enforce,
    evaluate,
)
from tickloom.schemas import DQ_LOG
from tickloom.sources.tables import read_table

AT = datetime(2024, 1, 15, 10, 30)
CTX = LogContext("t", "Silver", AT)


@pytest.fixture
def rows(spark):
    data = [("a", 1, 1.0), ("a", 1, -1.0), ("a", 1, None), (None, 2, 5.0), (None, 2, -2.0), ("b", 3, 0.0)]
    return spark.createDataFrame(data, "k string, n int, v double")


def texts(log):
    columns = ["check_name", "check_type", "expected_value", "observed_value", "status", "error_message"]
    return [tuple(r[c] for c in columns) for r in log.collect()]


def test_null_check_texts(rows):
    assert texts(evaluate(rows, [NullCheck(["k", "n"])], CTX)) == [
        ("null_check_k", "validation", "No nulls", "2 nulls", "FAIL", "2 nulls in column k"),
        ("null_check_n", "validation", "No nulls", "0 nulls", "PASS", ""),
    ]


def test_non_negative_check_lets_null_pass(rows):
    assert texts(evaluate(rows, [NonNegativeCheck(["v"])], CTX)) == [
        (
            "non_negative_check_v",
            "validation",
            "Values >= 0",
            "2 invalid values",
            "FAIL",
            "2 invalid values in column v (< 0)",
        )
    ]


def test_row_count_texts(rows):
    good, bad = texts(evaluate(rows, [RowCountCheck(6), RowCountCheck(5)], CTX))
    assert good == ("row_count_exact_check", "validation", "Exactly 6 rows", "6 rows", "PASS", "")
    assert bad[2:] == ("Exactly 5 rows", "6 rows", "FAIL", "Row count 6 rows does not match expected 5")


def test_uniqueness_counts_rows_or_groups_and_null_keys(rows):
    keys = ["k", "n"]
    surplus, groups = texts(evaluate(rows, [UniquenessCheck(keys), UniquenessCheck(keys, "groups")], CTX))
    assert surplus == (
        "multi_column_uniqueness_k_n",
        "validation",
        "Unique combination of ['k', 'n']",
        "3 duplicate rows",
        "FAIL",
        "3 duplicate rows for columns ['k', 'n']",
    )
    assert groups[3] == "2 duplicate rows"


def test_several_keys_and_checks_keep_their_order_number(rows):
    checks = [UniquenessCheck(["k"]), NullCheck(["k"]), UniquenessCheck(["n", "v"]), RowCountCheck(6)]
    log = evaluate(rows, checks, CTX)
    assert {r["check_name"]: r["_check"] for r in log.collect()} == {
        "multi_column_uniqueness_k": 0,
        "null_check_k": 1,
        "multi_column_uniqueness_n_v": 2,
        "row_count_exact_check": 3,
    }


def test_empty_table_passes_everything_but_the_row_count(rows):
    checks = [UniquenessCheck(["k"]), NullCheck(["k"]), NonNegativeCheck(["v"]), RowCountCheck(1)]
    assert [t[4] for t in texts(evaluate(rows.limit(0), checks, CTX))] == ["PASS", "PASS", "PASS", "FAIL"]


def test_log_columns_and_stamp(rows):
    log = evaluate(rows, [RowCountCheck(6)], LogContext("t", "Gold", AT, "b7")).drop("_check")
    assert log.columns == DQ_LOG.names
    assert dict(log.dtypes) == {f.name: f.dataType.simpleString() for f in DQ_LOG.fields}
    row = log.first()
    assert (row["batch_id"], row["check_timestamp"], row["year"], row["month"], row["day"]) == ("b7", AT, 2024, 1, 15)


@pytest.mark.parametrize(
    ("checks", "message"),
    [
        ([NullCheck(["k", "v"])], "Null check failed for columns: k, v"),
        ([NonNegativeCheck(["v"])], "Non-negative value check failed for columns: v"),
        ([RowCountCheck(2)], "Exact row count check failed: Row count 6 rows does not match expected 2"),
        ([UniquenessCheck(["k", "n"])], r"Multi-column uniqueness check failed for columns: \['k', 'n'\]"),
    ],
)
def test_failure_is_logged_before_it_is_raised(spark, tmp_path, rows, checks, message):
    log_path = str(tmp_path / "log")
    with pytest.raises(DataQualityError, match=message):
        enforce(evaluate(rows, checks, CTX), log_path)
    assert read_table(spark, log_path, DQ_LOG).filter("status = 'FAIL'").count() >= 1


def test_a_critical_run_stops_at_the_first_failed_check(spark, tmp_path, rows):
    checks = [RowCountCheck(6), NonNegativeCheck(["v"]), NullCheck(["k"])]
    with pytest.raises(DataQualityError, match="Non-negative"):
        enforce(evaluate(rows, checks, CTX), str(tmp_path / "log"))
    logged = {r["check_name"] for r in read_table(spark, str(tmp_path / "log"), DQ_LOG).collect()}
    assert logged == {"row_count_exact_check", "non_negative_check_v"}


def test_an_uncritical_run_logs_all_and_does_not_raise(spark, tmp_path, rows):
    checks = [NonNegativeCheck(["v"]), NullCheck(["k"])]
    assert enforce(evaluate(rows, checks, CTX), str(tmp_path / "log"), critical=False) is False
    assert enforce(evaluate(rows, [RowCountCheck(6)], CTX), str(tmp_path / "log")) is True
    assert read_table(spark, str(tmp_path / "log"), DQ_LOG).count() == 3


def test_a_further_attempt_replaces_the_log_of_the_one_before(spark, tmp_path, rows):
    path, later = str(tmp_path / "log"), LogContext(CTX.table_path, CTX.layer, CTX.as_of + timedelta(days=40), CTX.batch_id)
    for ctx, expected in ((CTX, 1), (later, 6), (later, 6)):
        enforce(evaluate(rows, [RowCountCheck(expected)], ctx), path, critical=False, tag="q-0")
    enforce(evaluate(rows, [RowCountCheck(1)], CTX), path, critical=False, tag="q-1")
    assert sorted(r["status"] for r in read_table(spark, path, DQ_LOG).collect()) == ["FAIL", "PASS"]


def test_unknown_expectation_does_not_pass(rows):
    from pyspark.sql import functions as F

    unknown = RowCountCheck(F.lit(None).cast("long"))
    assert texts(evaluate(rows, [unknown], CTX))[0][4] == "FAIL"


def test_expected_rows_counts_unknown_time_once_and_symbols_once(spark):
    df = spark.createDataFrame([(AT,), (AT,), (None,), (None,)], "extract_time timestamp")
    symbols = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "symbol string")
    assert quality.expected_rows(df, symbols).first()["expected_rows"] == 4


def deliveries(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, extract_time timestamp")
    return df.selectExpr("*", "year(extract_time) year", "month(extract_time) month", "day(extract_time) day")


@pytest.mark.parametrize("scope", ["month", "days"])
def test_duplicate_delivery_counts_pairs(spark, scope):
    hour = datetime(2024, 1, 15, 9)
    stored = [("A", hour + timedelta(minutes=m)) for m in (0, 1, 2)] + [("B", hour)]
    incoming = [("A", hour + timedelta(minutes=m)) for m in (30, 40)] + [("B", hour + timedelta(hours=1))]
    log = quality.duplicate_delivery_check(deliveries(spark, incoming), deliveries(spark, stored), CTX, scope)
    row = log.first()
    assert row["observed_value"] == "6 duplicates"
    assert row["error_message"] == "6 duplicate (symbol, extract_time-hour) records found in Bronze table"


def test_duplicate_delivery_scopes_differ_on_an_older_batch(spark):
    old = [("A", datetime(2023, 12, 31, 9))]
    both = deliveries(spark, old), deliveries(spark, old)
    assert quality.duplicate_delivery_check(*both, CTX, "month").first()["status"] == "PASS"
    assert quality.duplicate_delivery_check(*both, CTX, "days").first()["status"] == "FAIL"
    empty = both[0].limit(0)
    assert quality.duplicate_delivery_check(empty, both[1], CTX, "days").first()["observed_value"] == "0 duplicates"


def test_duplicate_delivery_matches_unknown_times_within_a_month(spark):
    rows = spark.createDataFrame([("A", None, 2024, 1, 1)], "symbol string, extract_time timestamp, year int, month int, day int")
    assert quality.duplicate_delivery_check(rows, rows, CTX, "month").first()["status"] == "FAIL"


def test_uncritical_duplicate_delivery_only_logs(spark, tmp_path):
    rows = deliveries(spark, [("A", AT)])
    log = quality.duplicate_delivery_check(rows, rows, CTX, "month")
    assert enforce(log, str(tmp_path / "log"), critical=False) is False
    with pytest.raises(DataQualityError, match="Critical DQ check failed: 1 duplicate"):
        enforce(log, str(tmp_path / "log"))


def arrival(spark, root, at, mode="string"):
    return quality.file_arrival_check(spark, LogContext(str(root), "Bronze", at), mode).first()


def test_file_arrival(spark, tmp_path):
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    folder = tmp_path / str(now.year) / str(now.month)
    missing = arrival(spark, tmp_path, now)
    assert (missing["status"], missing["observed_value"]) == ("FAIL", "Missing")
    assert missing["error_message"] == f"No files found in folder {folder}"
    folder.mkdir(parents=True)
    (folder / "x.csv").write_text("a\n")
    found = arrival(spark, tmp_path, now)
    assert (found["status"], found["observed_value"], found["error_message"]) == ("PASS", "Found", "")
    assert found["expected_value"] == f"File for {now:%Y-%m-%d} hour {now:%H}"
    late = arrival(spark, tmp_path, now.replace(hour=(now.hour + 1) % 24))
    assert late["status"] == "FAIL" and "not in current hour" in late["error_message"]
    assert late["observed_value"].endswith("+00:00")


def test_file_arrival_prefix_also_sees_later_months(spark, tmp_path):
    (tmp_path / "2024" / "10").mkdir(parents=True)
    (tmp_path / "2024" / "10" / "x.csv").write_text("a\n")
    january = datetime(2024, 1, 15, 10)
    assert arrival(spark, tmp_path, january)["observed_value"] != "Missing"
    assert arrival(spark, tmp_path, january, "folder")["observed_value"] == "Missing"
