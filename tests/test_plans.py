"""Plan-shape regressions for the properties that matter at scale."""

import os
import re

import pytest

from brisa.plans import marts
from brisa.plans.tpch import OBS_MEASURES, RULES, Model

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def scans_of(df, table_prefix: str) -> int:
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*{table_prefix}", formatted(df)))


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, SF)


def test_conditions_plan(spark, model):
    lazy = Model(spark, SF, materialize=False)
    c6 = marts.movements_with_conditions(lazy.stg_movements(), lazy.stg_observations(), lazy.hubs(), OBS_MEASURES, RULES)
    p = plan(c6)
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert "WindowGroupLimit" in p  # dedup forwards one row per key and task


def test_route_risk_counts_days_without_expand(model):
    assert "Expand" not in plan(model.route_risk())


def test_phase_lookup_joins_days_not_movements(spark):
    from brisa.plans import catalog

    p = plan(catalog.QUERIES["phase_lookup"][0](spark, SF))
    assert p.index("NestedLoopJoin") < p.rindex("HashAggregate")  # an aggregate lies below the range join


def test_replaced_input_gives_new_tables(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    d = tmp_path / "tables"
    shutil.copytree(SF, d)
    (d / "lineitem.parquet").chmod(0o644)
    first = Model(spark, str(d)).stg_movements().count()
    half = pq.read_table(f"{SF}/lineitem.parquet")
    pq.write_table(half.slice(0, half.num_rows // 2), d / "lineitem.parquet", coerce_timestamps="us")
    second = Model(spark, str(d)).stg_movements().count()
    lazy = Model(spark, str(d), materialize=False).stg_movements().count()
    assert second == lazy < first


def test_no_cached_frame_stays(spark):
    from brisa.plans import catalog

    for name in ("hour_bucket_join", "two_end_bucket_join", "movements_with_conditions"):
        catalog.QUERIES[name][0](spark, SF).count()
    assert spark._jsc.sc().getPersistentRDDs().isEmpty()


def test_marts_scan_conditions_once(model):
    for df in (model.recovery(), model.resilience(), model.carrier_performance()):
        assert scans_of(df, "model-conditions") == 1


def test_base_year_bounds_reach_parquet(model):
    f = formatted(model.baseline())
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(movement_date,1996-01-01\)[^\]]*LessThanOrEqual\(movement_date,1996-12-31\)", f)
    r = formatted(model.route_risk())
    assert re.search(r"GreaterThanOrEqual\(movement_date,1996-01-01\), LessThan\(movement_date,1997-01-01\)", r)


def test_columns_pruned_at_scan(model):
    f = formatted(model.resilience())
    read = re.search(r"model-conditions[^\n]*\n(?:[^\n]*\n)*?ReadSchema: (struct<[^\n]*>)", f).group(1)
    assert "origin_price" not in read and "callsign" not in read


def test_hub_ranking_is_top_n_not_sort(spark):
    lazy = Model(spark, SF, materialize=False)
    p = plan(lazy.hubs())
    assert "TakeOrderedAndProject" in p and "Sort [" not in p


def test_dedup_sorts_raw_columns_only(spark):
    """Ids are hashed for the rows that stay, above the window."""
    p = plan(Model(spark, SF, materialize=False).stg_movements())
    assert p.count("md5(") == 1 and p.index("md5(") < p.index("Window [")


def test_intermediate_tables_are_written_by_small_tasks(spark, tmp_path, monkeypatch):
    from brisa.plans import tpch

    name, seen = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    monkeypatch.setattr(tpch.files, "write_clustered", lambda df, path, by: (seen.append(spark.conf.get(name)), df.write.parquet(path)))
    before = spark.conf.get(name)
    m = Model(spark, SF)
    key = (spark.sparkContext.applicationId, tpch.input_identity(spark, SF), "small_tasks")
    try:
        m._table("small_tasks", lambda: spark.range(3), ("id",))
    finally:
        tpch._TABLES.pop(key, None)
    assert seen == [tpch.TASK_BYTES] and spark.conf.get(name) == before


def test_the_observation_grid_is_a_table_of_known_size(spark, model):
    from brisa.plans import catalog

    assert scans_of(catalog.QUERIES["hour_bucket_join"][0](spark, SF), "model-observation_grid") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    joined = marts.movements_with_conditions(model.stg_movements(), model.grid(), model.hubs(), OBS_MEASURES, RULES)
    # Room for the written grid, not for what the planner would expect of orders and customers.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    try:
        assert "SortMergeJoin" not in plan(joined.select("movement_id", "origin_price", "destination_price"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
