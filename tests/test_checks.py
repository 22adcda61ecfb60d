from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltstone.operators import keys
from siltstone.operators.checks import (
    TABLE_CHECKS,
    TableChecks,
    check_raw_header,
    check_table,
    enforce,
    expectation_of,
    judge,
    run_checks,
    run_summary,
)

SCHEMA = "a string, b int, ingest_dt string"


def outcomes(df):
    return {r.check_name.split("t_", 1)[1]: (r.value, r.outcome) for r in df.collect()}


@pytest.fixture
def table(spark):
    rows = [("x", 1, "d1"), ("x", 1, "d1"), (None, 1, "d1"), (None, 1, "d1"), (" ", 2, "d1"), ("y", None, "d2")]
    return spark.createDataFrame(rows, SCHEMA)


def test_forms_of_duplicates_and_nulls(table):
    found = outcomes(check_table(table, TableChecks("t", ["a"], "distinct"), "d1"))
    assert found == {"nullpk": (2, "failed"), "dupes": (3, "failed"), "rowcnt": (5, "passed")}
    found = outcomes(check_table(table, TableChecks("t", ["a", "b"], "joined", "cells")))
    assert found == {"nullpk": (3, "failed"), "dupes": (4, "failed"), "rowcnt": (6, "passed")}
    found = outcomes(check_table(table, TableChecks("t", ["a", "b"], "groups", not_blank=["a"]), "d1"))
    assert found == {"nullpk": (3, "failed"), "dupes": (2, "failed"), "rowcnt": (5, "passed")}


def test_agrees_with_the_single_statistics(table):
    df = table.where("ingest_dt = 'd1'")
    assert keys.duplicate_keys(df, "a").first()[0] == 3
    assert keys.duplicate_joined_keys(df, ["a", "b"]).first()[0] == 3
    assert keys.repeated_key_groups(df, ["a", "b"]).first()[0] == 2
    assert keys.null_key_rows(df, ["a", "b"], blank=["a"]).first()[0] == 3
    assert keys.null_key_cells(df, ["a", "b"]).first()[0] == 2


def test_empty_partition(table):
    rows = outcomes(check_table(table, TableChecks("t", ["a"], "distinct", "rows"), "none"))
    assert rows == {"nullpk": (0, "passed"), "dupes": (0, "passed"), "rowcnt": (0, "failed")}
    cells = outcomes(check_table(table, TableChecks("t", ["a"], "joined", "cells", dates=["b"]), "none"))
    assert cells["nullpk"] == (None, "error") and cells["nulldates_b"] == (None, "error")


def test_joined_key_of_parts_with_the_separator(spark):
    df = spark.createDataFrame([("p|q", "r"), ("p", "q|r")], "a string, b string")
    assert keys.duplicate_joined_keys(df, ["a", "b"]).first()[0] == 1
    assert keys.repeated_key_groups(df, ["a", "b"]).first()[0] == 0


def test_every_partition_is_checked_and_enforced(table):
    rules = [TableChecks("t", ["a"], "distinct")]
    results = run_checks({"t": table}, {"t": ["d2", "d1"]}, rules)
    assert results.count() == 6
    with pytest.raises(AssertionError, match=r"t_nullpk \(d1\): expected zero, got 2"):
        enforce(results)
    assert enforce(run_checks({"t": table}, {"t": ["d2"]}, rules)) == {"checks_passed": 3, "checks_failed": 0}
    assert run_summary(results, ["t"], 2)["failed_checks"] == ["t_nullpk", "t_dupes"]


def test_expectation_from_name(spark):
    assert [expectation_of(n) for n in ("x_zero", "x_gt_zero", "x_ge_one")] == ["zero", "gt_zero", "ge_one"]
    with pytest.raises(ValueError):
        expectation_of("x_g3_one")
    number = spark.range(1).select(F.lit(0).alias("n"), F.lit(9).alias("not judged"))
    assert [judge(number, f"x_{e}", "t").first().outcome for e in ("zero", "gt_zero", "ge_one")] == [
        "passed", "failed", "failed",
    ]


def test_raw_header(spark):
    rows = [(" cms certification number (ccn) ", "d1"), ("1", "d1"), ("1", "d2")]
    df = spark.createDataFrame(rows, "k string, ingest_dt string")
    found = {r.check_name: (r.value, r.outcome) for r in check_raw_header(df, "t", "k", "d1").collect()}
    assert found == {"t_num_records": (2, "passed"), "t_bad_headers": (1, "failed")}


def test_rules_cover_all_tables():
    checks = sum(3 + len(r.dates) for r in TABLE_CHECKS)
    assert (len(TABLE_CHECKS), checks) == (11, 34)


def test_longest_text(spark):
    rows = [("k", "aa"), ("k", "zz"), ("k", "b"), ("n", None), ("n", None), ("e", "")]
    df = spark.createDataFrame(rows, "k string, t string")
    assert {tuple(r) for r in keys.longest_text(df, "k", "t").collect()} == {("k", "zz"), ("n", None), ("e", "")}
