"""The driver contract, oracles on the smallest data, and what the plans must look like."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, duck
from touchline.plans import catalog

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
SLOW = {"stacking_predict", "feature_importance", "model_evaluation", "model_facts", "match_features", "land_feeds", "load_and_build_tables", "load_late_rows", "load_rejects"}
SAMPLE = sorted(set(catalog.ORACLES) - SLOW)[::6]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"stacking_predict", "feature_importance", "model_evaluation"}
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_models_have_the_planned_sizes():
    from touchline.plans import model, queries_model

    assert queries_model._SIZES == model.StackSizes(500, 12, 500, 6, 8, 0.05, 3)


@needs_data
def test_entry(spark):
    assert sorted(entry.entry(spark).columns) == ["n", "result"]


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_oracle(spark, name):
    assert compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name]) == ""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_all_statistics_are_returned(spark):
    from touchline.schemas import STATISTIC_COLUMNS

    rows = entry.queries()["silver_statistics_all"](spark, SF)
    assert {column for column, _ in STATISTIC_COLUMNS.values()} < set(rows.columns)
    assert compare(rows, duck(SF), entry.oracle_sql()["silver_statistics_all"]) == ""


@needs_data
def test_all_features_are_loaded(spark):
    from touchline.schemas import FEATURES

    rows = entry.queries()["feature_load_all"](spark, SF)
    assert len(FEATURES) == 30 and set(FEATURES) < set(rows.columns)
    assert compare(rows, duck(SF), entry.oracle_sql()["feature_load_all"]) == ""


@needs_data
@pytest.mark.parametrize("name", ["team_form", "head_to_head", "odds_consensus", "silver_fixtures", "asof_form", "stats_pivot_kv"])
def test_no_python_in_plans(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


@needs_data
def test_rating_is_the_only_arrow_step(spark):
    assert plan_of(entry.queries()["elo_ratings"](spark, SF)).count("MapInPandas") == 1


@needs_data
def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(entry.queries()["implied_probs"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan


@needs_data
def test_form_without_hot_keys_is_one_window_shuffle(spark):
    plan = plan_of(entry.queries()["form_string"](spark, SF))
    assert plan.count("Exchange hashpartitioning(team_id") == 1 and plan.count("Window [") == 1


@needs_data
def test_a_landing_of_the_stream_is_many_files(spark):
    """Each was one file, written by one task."""
    import glob

    root = spark.conf.get("spark.checkpoint.dir")
    known = set(glob.glob(f"{root}/stream-*/raw"))
    assert entry.queries()["stream_upsert"](spark, SF).count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    (raw,) = set(glob.glob(f"{root}/stream-*/raw")) - known
    assert len(glob.glob(f"{raw}/*.parquet")) > 2


@needs_data
def test_land_feeds_writes_no_text_to_count(spark):
    """Each parsed record was turned back into text to see whether it has fields."""
    assert "= {})" not in plan_of(entry.queries()["land_feeds"](spark, SF))


def test_a_query_of_the_stack_scores_only_the_parts_it_reads(spark, monkeypatch):
    """Importances score no match, the evaluation the newest fifth, the facts all that are not trained on."""
    from touchline.plans import queries_model

    asked = []

    def stack(spark, sf, parts=()):
        asked.append(list(parts))
        raise LookupError

    monkeypatch.setattr(queries_model, "_stack", stack)
    for name in ("feature_importance", "stacking_predict", "model_evaluation", "model_facts"):
        with pytest.raises(LookupError):
            getattr(queries_model, name)(spark, SF)
    assert asked == [[], [], ["validation"], ["validation", "open"]]


def test_feeds_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    """A small file of matches or players was one task, here and in every load of its payloads."""
    from touchline.plans import testbed

    orders = spark.range(1, 41).selectExpr(
        "id AS o_orderkey", "id % 5 AS o_custkey", "'F' AS o_orderstatus", "DATE '1996-01-02' + CAST(id AS INT) AS o_orderdate"
    )
    given = {
        "orders": orders.unionByName(orders.limit(1)),
        "customer": spark.range(5).selectExpr("id AS c_custkey", "CAST(id AS INT) AS c_nationkey"),
        "nation": spark.range(5).selectExpr("CAST(id AS INT) AS n_nationkey", "CAST(id AS INT) AS n_regionkey"),
        "part": spark.range(1, 41).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size"),
    }
    for name, rows in given.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for make in (testbed.raw_teams, testbed.raw_leagues, testbed.raw_api_predictions, testbed.raw_transfers, testbed.raw_players):
        rows = make(spark, str(tmp_path))
        filled = sum(n > 0 for n in rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
        assert filled >= 4 and rows.count() == (40 if make is testbed.raw_players else 41), make.__name__
