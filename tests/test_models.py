from __future__ import annotations

from datetime import date

import pytest

from siltstone.functions.cleaning import with_missing_columns
from siltstone.plans import models
from siltstone.plans.calendar import dim_date
from siltstone.sources.schemas import raw_schema

CCN = "cms_certification_number_ccn"


@pytest.fixture
def raw(spark):
    def make(dataset, *records, ingest_dt="2024-01-01"):
        names = list(dict.fromkeys(k for r in records for k in r)) or [raw_schema(dataset).names[0]]
        schema = ", ".join(f"`{n}` string" for n in [*names, "ingest_dt"])
        rows = [(*(r.get(n) for n in names), ingest_dt) for r in records]
        return with_missing_columns(spark.createDataFrame(rows, schema), raw_schema(dataset))

    return make


def only(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 31777
    assert days.dtypes == [
        ("date_id", "int"), ("date", "date"), ("day_nbr", "string"), ("month_nbr", "string"), ("year", "string"),
        ("quarter", "string"),
    ]
    assert tuple(days.where("date_id = 20240229").first()) == (20240229, date(2024, 2, 29), "29", "02", "2024", "1")


def test_facility_with_two_regions_and_edge_keys(raw):
    provider = raw(
        "provider",
        {"ccn_provnum": '"15009"', "provider_name": ' "A" ', "provider_zip_code": "501", "number_of_certified_beds": "9.5"},
        {"ccn_provnum": "1234567", "number_of_certified_beds": "70", "avg_residents_per_day": "35.5"},
        {"ccn_provnum": ""},
        {"ccn_provnum": None},
    )
    swing = raw(
        "swing_bed", {CCN: "015009", "cms_region": '"4"'}, {CCN: "15009", "cms_region": "4"},
        {CCN: "15009", "cms_region": "5"}, {CCN: None, "cms_region": "6"}, {CCN: "123456", "cms_region": "x"},
    )
    df = models.dim_facility(provider, swing, "2024-02-01")
    assert only(df, "ccn_provnum", "provider_name", "provider_zip_code", "cms_region", "number_of_certified_beds") == [
        ("000000", None, None, None, None),
        ("015009", "A", "00501", 4, None),
        ("015009", "A", "00501", 5, None),
        ("123456", None, None, None, 70),
    ]
    assert df.columns[6] == "cms_region" and df.columns[-1] == "ingest_dt" and len(df.columns) == 29
    assert {r[0] for r in df.select("ingest_dt").collect()} == {"2024-02-01"}


def test_ownership(spark, raw):
    full = {
        CCN: "1", "owner_name": " N ", "owner_type": "T", "ownership_percentage": "5%",
        "role_played_by_owner_or_manager_in_facility": "R",
    }
    df = models.fact_ownership(
        raw(
            "ownership",
            {**full, "association_date": "since 1/2/2003"},
            {**full, "association_date": "since 2/30/2003"},
            {**full, "association_date": "since 1/2/1939"},
            {**full, "association_date": "NO DATE PROVIDED"},
            {**full, "association_date": None},
            {**full, "association_date": "1/2/2003", "owner_type": None},
        ),
        dim_date(spark),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("000001", date(2003, 1, 2), 20030102, "N", "T", "5%", "R", "2024-01-01")
    ]


def test_measures_take_the_longest_text(raw):
    claims = raw(
        "claims_measures",
        {"measure_code": '"401"', "measure_description": "aa"},
        {"measure_code": "401", "measure_description": " bb "},
        {"measure_code": "402", "measure_description": ""},
        {"measure_code": '""', "measure_description": "long text"},
        {"measure_code": None, "measure_description": "long text"},
    )
    mds = raw("mds_measures", {"measure_code": "401", "measure_description": None})
    snf = raw("snf_measures", {"measure_code": "S_1"}, {"measure_code": "402"})
    swing = raw("swing_bed", {"measure_code": "S_1"})
    df = models.dim_measure(claims, mds, snf, swing, "2024-02-01")
    assert only(df, "measure_code", "measure_description", "ingest_dt") == [
        ("401", "bb", "2024-02-01"), ("402", None, "2024-02-01"), ("S_1", None, "2024-02-01"),
    ]


def test_covid(raw):
    df = models.fact_facility_covid(
        raw("covid_provider", {CCN: "1", "vax_data_last_update": " 2024-10-13"}, {CCN: "2", "vax_data_last_update": "10/13/2024"},
            {CCN: "3", "vax_data_last_update": "soon"}, {CCN: None})
    )
    assert only(df, "ccn_provnum", "vax_data_last_update") == [
        ("000001", date(2024, 10, 13)), ("000002", date(2024, 10, 13)), ("000003", None),
    ]
    df = models.fact_state_covid_vax_avgs(
        raw("covid_state", {"state_raw": ' "al" ', "pct_residents_up_to_date_raw": '"1.5"', "vax_data_last_updated_raw": '"10/13/2024"'},
            {"state_raw": "  "}, {"state_raw": None})
    )
    assert [tuple(r) for r in df.collect()] == [("AL", 1.5, None, date(2024, 10, 13), "2024-01-01")]


def test_survey_events_outside_the_calendar_drop_out(spark, raw):
    df = models.fact_survey_event(
        raw("survey_dates", {CCN: "1", "survey_date": "2024-01-02", "type_of_survey": " Health ", "survey_cycle": "x"},
            {CCN: "1", "survey_date": "2027-01-01"}, {CCN: "1", "survey_date": "1/2/2024"}, {CCN: None, "survey_date": "2024-01-02"}),
        dim_date(spark),
    )
    assert [tuple(r) for r in df.collect()] == [("000001", date(2024, 1, 2), 20240102, "Health", None, "2024-01-01")]


def test_payment_denials_without_amount_drop_out(spark, raw):
    row = {"cms certification number (ccn)": '"1"', "penalty date": '"1/2/2024"', "penalty type": "Fine"}
    df = models.fact_penalties(
        raw("penalties", {**row, "fine amount": '"650.5"', "payment denial start date": "2024-01-05", "payment denial length in days": "7"},
            {**row, "penalty type": "Payment Denial", "fine amount": ""}, {**row, "penalty date": None, "fine amount": "1"}),
        dim_date(spark),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("000001", date(2024, 1, 2), 20240102, "Fine", 650.5, date(2024, 1, 5), 7, "2024-01-01")
    ]


def test_scores_keep_each_dataset_own_date(raw):
    base = {CCN: "1", "measure_code": " 401 ", "measure_period": "20230101-20231231", "used_in_quality_measure_five_star_rating": "Y"}
    claims = raw("claims_measures", {**base, "adjusted_score": "12.5", "footnote_for_score": "9"}, ingest_dt="2024-01-01")
    mds = raw("mds_measures", {**base, "four_quarter_average_score": "x", "q1_measure_score": "3"}, {**base, "measure_code": None}, ingest_dt="2024-01-09")
    df = models.fact_quality_measure_score(claims, mds)
    assert len(df.columns) == 26
    assert only(df, "measure_code", "measure_period_end_date", "score", "footnote", "q1_measure_score", "adjusted_score", "ingest_dt") == [
        ("401", date(2023, 12, 31), "12.5", "9", None, 12.5, "2024-01-01"),
        ("401", date(2023, 12, 31), None, None, 3.0, None, "2024-01-09"),
    ]


def test_citations(spark, raw):
    row = {CCN: "1", "deficiency_tag_number": "0641", "survey_type": "Health", "correction_date": "2024-02-30"}
    df = models.fact_citations(
        raw("fire_citations", {**row, "survey_date": "2030-01-01"}, {**row, "survey_date": "never"}),
        raw("health_citations", {**row, "survey_date": "2024-01-02", "citation_under_idr": "N"}, {**row, "survey_date": "2024-01-02", "survey_type": None}),
        dim_date(spark),
    )
    assert only(df, "survey_date", "date_id", "correction_date", "citation_idr", "citation_iidr") == [
        (date(2024, 1, 2), 20240102, None, "N", None), (date(2030, 1, 1), None, None, None, None),
    ]


def test_staffing_and_summary(spark, raw):
    df = models.fact_staffing_daily(
        raw("staffing", {"provnum": "15009", "workdate": " 20240401 ", "mdscensus": "50", "hrs_rn": "7.5", "hrs_cna_ctr": "n/a"},
            {"provnum": "15009", "workdate": "2024-04-01"}, {"provnum": "15009", "workdate": "20241301"}),
        dim_date(spark),
    )
    assert only(df, "ccn_provnum", "workdate", "date_id", "mdscensus", "hrs_rn", "hrs_cna_ctr") == [
        ("015009", date(2024, 4, 1), 20240401, 50, 7.5, None)
    ]
    assert len(df.columns) == 30
    df = models.fact_survey_cycle_summary(
        raw("survey_summary", {CCN: "1", "inspection_cycle": '"2"', "fire_safety_survey_date": '"2024-01-02"', "count_of_smoke_deficiencies": '"3"'},
            {CCN: " ", "inspection_cycle": "1"}, {CCN: "1", "inspection_cycle": "x"}, {CCN: "1", "inspection_cycle": None})
    )
    assert only(df, "ccn_provnum", "inspection_cycle", "first_safety_survey_date", "cnt_smoke_deficiencies") == [
        ("000001", 2, date(2024, 1, 2), 3)
    ]
    assert len(df.columns) == 35


def test_metrics_use_the_latest_run(raw):
    provider = raw("provider", {"ccn_provnum": "1", "number_of_certified_beds": "0", "avg_residents_per_day": "10"})
    old = models.dim_facility(provider, raw("swing_bed"), "2024-01-01")
    new = models.dim_facility(provider, raw("swing_bed"), "2024-02-01")
    rows = models.facility_staffing_metrics_latest(old.unionByName(new)).collect()
    assert [(r.ingest_dt, r.estimated_total_nurse_hours_per_day, r.occupancy_proxy) for r in rows] == [("2024-02-01", 0.0, None)]


def test_ledger(spark):
    from siltstone.sources.schemas import MANIFEST

    doc = {"ingest_dt": "2024-01-01", "run_ts_utc": "2024-01-01T05:00:00+00:00", "files": [{"filename": "a"}], "skipped_unchanged": [], "errors": [{"error": "x"}]}
    row = models.control_watermark(spark.createDataFrame([doc], MANIFEST), "control/manifest.json").first()
    assert row.status == "partial_failure"
    assert row.counts.asDict() == {"uploaded": 1, "skipped_unchanged": 0, "errors": 1, "total_files_seen": 2}
