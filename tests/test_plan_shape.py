"""Physical plans of hot operators: what is pushed down, what is shuffled, what is broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental, keys, profile, series
from siltstone.plans import models
from siltstone.plans.calendar import dim_date
from siltstone.sources.readers import at_date
from siltstone.workload import catalog
from siltstone.workload.inputs import raw, table

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    df = catalog.queries()["key_normalize"](spark, SF_DIR)
    schema = plan(df).split("ReadSchema:")[1]
    assert "l_returnflag" not in schema and "l_tax" not in schema


def test_partition_date_reaches_the_scan(spark, tmp_path):
    raw(spark, SF_DIR, "survey_dates").write.partitionBy("ingest_dt").parquet(f"{tmp_path}/t")
    stored = spark.read.schema(raw(spark, SF_DIR, "survey_dates").schema).parquet(f"{tmp_path}/t")
    text = plan(models.fact_survey_event(at_date(stored, "2024-01-01"), dim_date(spark)))
    assert "PartitionFilters: [isnotnull(ingest_dt" in text
    assert "processing_date" not in text.split("ReadSchema:")[1].split("\n")[0]


@pytest.mark.parametrize("model, dataset", [("fact_survey_event", "survey_dates"), ("fact_ownership", "ownership"), ("fact_penalties", "penalties")])
def test_calendar_is_broadcast_by_its_size(spark, tmp_path, model, dataset):
    raw(spark, SF_DIR, dataset).write.parquet(f"{tmp_path}/t")
    text = plan(getattr(models, model)(spark.read.parquet(f"{tmp_path}/t"), dim_date(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_a_calendar_too_large_is_not_broadcast(spark, tmp_path):
    raw(spark, SF_DIR, "survey_dates").write.parquet(f"{tmp_path}/t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        text = plan(models.fact_survey_event(spark.read.parquet(f"{tmp_path}/t"), dim_date(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text


def test_rank_limit_comes_before_the_shuffle(spark):
    text = plan(series.last_rows(table(spark, SF_DIR, "events"), ["event_type"], ["ts", "event_id"], 20))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_measure_texts_are_made_distinct_before_they_are_ranked(spark):
    text = plan(keys.longest_text(table(spark, SF_DIR, "part"), "p_brand", "p_type"))
    assert text.count("HashAggregate") >= 2 and text.index("SortAggregate") < text.index("HashAggregate")


def test_no_query_collects_rows_into_one_partition(spark):
    """A single-partition exchange may only carry pre-aggregated totals."""
    for name, run in catalog.queries().items():
        if name.startswith(("sink_", "src_", "profile_report", "join_key_report", "key_search")):
            continue
        text = plan(run(spark, SF_DIR))
        assert "CartesianProduct" not in text, name
        for part in text.split("Exchange SinglePartition")[1:]:
            assert "Aggregate(" in part.split("\n")[1], (name, part[:300])


def test_moving_average_pieces_split_a_hot_group(spark):
    rows = spark.range(0, 4000).select(F.lit("hot").alias("g"), "id", (F.col("id") % 7).cast("double").alias("v"))
    text = plan(series.moving_averages(rows, ["g"], ["id"], "v", {"m": 20}, piece_rows=100))
    assert "Exchange hashpartitioning(g" in text and "_piece" in text.split("Exchange hashpartitioning(g")[1].split(")")[0]


def test_positions_are_joined_without_shuffling_the_rows(spark):
    indexed = series.with_row_index(table(spark, SF_DIR, "events"), ["event_type"], ["ts", "event_id"])
    text = plan(indexed)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    error = series.fit_error(indexed, series.linear_fit(indexed, ["event_type"], "value"), ["event_type"], "value")
    assert plan(error).count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan(error)


def test_hot_key_of_the_region_lookup_is_split(spark):
    """Two thirds of the facilities share one key; its join partition is cut into several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        key = F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).cast("string")
        rows = spark.range(0, n, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        lookup = spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).alias("region"))
        joined = keys.enrich_left(rows, lookup.unionByName(lookup), "k", ["region"])
        assert joined.count() == n
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_dates_prune_folders(spark, tmp_path):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-08", 2), ("b", "2024-01-01", 3), ("c", "2023-01-01", 4)]
    files = spark.createDataFrame(rows, "dataset_key string, ingest_dt string, n int")
    files.write.partitionBy("dataset_key", "ingest_dt").parquet(f"{tmp_path}/t")
    stored = spark.read.schema(files.schema).parquet(f"{tmp_path}/t")
    latest = incremental.keep_latest(stored, files.where("n < 4"))
    assert sorted(r.n for r in latest.collect()) == [2, 3]
    text = plan(latest)
    filters = next(line for line in text.split("\n") if "PartitionFilters" in line).split("PartitionFilters: ")[1]
    assert "dataset_key" in filters and "ingest_dt" in filters and "Join" not in text and "Filter (" not in text
    joined = incremental.keep_latest(stored, files.where("n < 4"), literals=1)
    assert sorted(r.n for r in joined.collect()) == [2, 3]
    assert incremental.keep_latest(stored, files.limit(0)).count() == 0


def _exchanged(df) -> list[str]:
    """What each exchange of the plan moves, as name:type."""
    top, found = df._jdf.queryExecution().executedPlan(), []
    stack = [top.initialPlan() if "AdaptiveSparkPlan" in top.nodeName() else top]
    while stack:
        at = stack.pop()
        if "Exchange" in at.nodeName():
            output = at.output()
            found += [f"{output.apply(i).name()}:{output.apply(i).dataType().simpleString()}" for i in range(output.length())]
        stack += [at.children().apply(i) for i in range(at.children().length())]
    return found


def test_no_text_is_shuffled_by_column_statistics(spark):
    texts = table(spark, SF_DIR, "documents")
    for df in (profile.column_stats(texts), profile.uniqueness(texts, ["source", "text"])):
        moved = _exchanged(df)
        assert any(m.endswith(":binary") for m in moved)
        assert not [m for m in moved if m.endswith(":string")], moved


def test_key_rounds_shuffle_classes_not_keys(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "source", "lang", "text")
    left, at = profile.key_classes(docs, docs.columns, "source", docs.count())
    moved = set(_exchanged(left.refined(at["lang"]).pairs([at["doc_id"], at["text"]])))
    assert moved == {"k0:binary", "position:int", "value:binary", "count:bigint"}, moved
