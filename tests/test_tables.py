"""Landing, upsert, partitions, layout, audit and streams."""

import datetime as dt
import json
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.schemas import RAW
from touchline.session import scratch_path
from touchline.sources import landing, tables
from touchline.streaming import live

FX = "fixture_id BIGINT, match_date DATE, status STRING"
D = [dt.date(2025, 1, d) for d in range(1, 6)]


def content(spark, path):
    return sorted((r.fixture_id, r.match_date, r.status) for r in spark.read.parquet(path).collect())


def test_first_load_then_update_insert_and_move(spark):
    path = scratch_path(spark, "t")
    tables.upsert_table(spark.createDataFrame([(1, D[0], "NS"), (2, D[0], "NS"), (3, D[1], "NS")], FX), path, ["fixture_id"], ["match_date"])
    change = spark.createDataFrame([(1, D[3], "PST"), (4, D[1], "NS")], FX)
    for _ in range(2):
        tables.upsert_table(change, path, ["fixture_id"], ["match_date"])
        assert content(spark, path) == [(1, D[3], "PST"), (2, D[0], "NS"), (3, D[1], "NS"), (4, D[1], "NS")]


def test_partition_emptied_by_a_move_disappears(spark):
    path = scratch_path(spark, "t")
    tables.upsert_table(spark.createDataFrame([(1, D[0], "NS"), (2, D[1], "NS")], FX), path, ["fixture_id"], ["match_date"])
    tables.upsert_table(spark.createDataFrame([(1, D[1], "PST")], FX), path, ["fixture_id"], ["match_date"])
    assert content(spark, path) == [(1, D[1], "PST"), (2, D[1], "NS")]


def test_untouched_partitions_are_not_rewritten(spark):
    path = scratch_path(spark, "t")
    tables.upsert_table(spark.createDataFrame([(1, D[0], "NS"), (2, D[1], "NS")], FX), path, ["fixture_id"], ["match_date"])
    before = {f for f in spark.read.parquet(path).inputFiles() if "2025-01-02" in f}
    tables.upsert_table(spark.createDataFrame([(1, D[0], "FT")], FX), path, ["fixture_id"], ["match_date"])
    assert before <= set(spark.read.parquet(path).inputFiles())


def test_null_keys_and_null_partitions(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([(None, None, "a"), (1, D[0], "b")], FX)
    for _ in range(2):
        tables.upsert_table(rows, path, ["fixture_id"], ["match_date"])
    assert spark.read.parquet(path).count() == 2
    assert tables.upsert(rows, rows, ["fixture_id"], null_safe=False).count() == 3


def test_two_partition_columns(spark):
    path = scratch_path(spark, "t")
    schema = "k INT, a INT, b STRING, v INT"
    tables.upsert_table(spark.createDataFrame([(1, 1, "x", 0), (2, 1, "y", 0)], schema), path, ["k"], ["a", "b"])
    tables.upsert_table(spark.createDataFrame([(1, 2, "x", 1)], schema), path, ["k"], ["a", "b"])
    assert sorted((r.k, r.a, r.b, r.v) for r in spark.read.parquet(path).collect()) == [(1, 2, "x", 1), (2, 1, "y", 0)]


pairs = st.dictionaries(st.integers(0, 8), st.integers(0, 3), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_upsert_is_a_dictionary_update(spark, old, new):
    schema = "k INT, v INT"
    target, source = (spark.createDataFrame(list(d.items()), schema) for d in (old, new))
    once = tables.upsert(target, source, ["k"])
    twice = tables.upsert(once, source, ["k"])
    for out in (once, twice):
        rows = [(r.k, r.v) for r in out.collect()]
        assert dict(rows) == old | new and len(rows) == len(old | new)


def test_overwrite_and_expire(spark):
    path = scratch_path(spark, "t")
    tables.append_table(spark.createDataFrame([(i, d, "a") for i, d in enumerate(D)], FX), path, ["match_date"])
    tables.overwrite_partitions(spark.createDataFrame([(9, D[0], "b")], FX), path, ["match_date"])
    assert len(content(spark, path)) == 5 and (9, D[0], "b") in content(spark, path)
    assert tables.expire_partitions(spark, path, "match_date", 2, D[4]) == 2
    assert [r[1] for r in content(spark, path)] == D[2:]


def test_scan_prunes_partitions(spark):
    path = scratch_path(spark, "t")
    tables.append_table(spark.createDataFrame([(i, d, "a") for i, d in enumerate(D)], FX), path, ["match_date"])
    df = landing.scan_since(spark.read.parquet(path), D[3], "match_date")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(match_date" in plan


def test_land_both_shapes_and_empty(spark):
    record = {"fixture": {"id": 1}}
    body = json.dumps({"parameters": {"fixture": "1"}, "response": [record, record]})
    empty = json.dumps({"parameters": {}, "response": []})
    bodies = spark.createDataFrame([(body,), (empty,)], "body STRING")
    rows = landing.land_raw(bodies, "fixtures", "b1").collect()
    assert [json.loads(r.payload) for r in rows] == [record, record]
    assert {json.loads(r.params)["fixture"] for r in rows} == {"1"} and rows[0]._batch_id == "b1"
    assert rows[0].asDict().keys() == {p.split()[0] for p in RAW.split(", ")}
    single = landing.land_raw(spark.createDataFrame([(json.dumps(record),)], "body STRING"), "fixtures", "b", shape="record")
    assert json.loads(single.first().payload) == record
    with pytest.raises(ValueError):
        landing.land_raw(bodies, "fixtures", "b", shape="other")


def test_read_bodies_formats(spark):
    root = scratch_path(spark, "files")
    spark.createDataFrame([(1, "a")], "k INT, v STRING").write.parquet(f"{root}/p")
    spark.createDataFrame([('{"k": 1}',)], "value STRING").write.text(f"{root}/j")
    assert json.loads(landing.read_bodies(spark, f"{root}/p", "parquet").first().body) == {"k": 1, "v": "a"}
    assert landing.read_bodies(spark, f"{root}/j", "jsonl").first().body == '{"k": 1}'
    assert landing.read_bodies(spark, f"{root}/j", "json").first().body.strip() == '{"k": 1}'
    with pytest.raises(ValueError):
        landing.read_bodies(spark, root, "xml")


def test_date_window():
    assert landing.date_window("incremental", today=D[1]) == (D[0], D[1])
    assert landing.date_window("backfill", D[0], D[4]) == (D[0], D[4])
    for args in (("backfill", D[0], None), ("backfill", None, D[0]), ("backfill", D[4], D[0]), ("other", None, None)):
        with pytest.raises(ValueError):
            landing.date_window(*args)


def test_batches_are_full(spark):
    rows = landing.batch_keys(spark.range(0, 450, 10), "id", seed_rows=8).orderBy("batch_no").collect()
    assert [r.n_keys for r in rows] == [20, 20, 5] and rows[0].ids.startswith("0-10-20-")


def test_high_water_mark_of_empty(spark):
    assert landing.high_water_mark(spark.createDataFrame([], FX), "match_date") is None


def test_latest_coverage_of_no_seasons(spark):
    schema = "id INT, seasons ARRAY<STRUCT<year: INT, coverage: STRUCT<odds: BOOLEAN>>>"
    rows = [(1, [(2024, (True,)), (2025, (False,))]), (2, [])]
    got = {r.id: r.coverage and r.coverage.odds for r in landing.latest_coverage(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: False, 2: None}


def test_layout_narrows_file_ranges(spark):
    root = scratch_path(spark, "z")
    spark.range(10000).select(F.hash("id").alias("a"), F.hash(F.col("id") + 7).alias("b")).write.parquet(f"{root}/in")
    listed = {"t": (f"{root}/in", ["a", "b"]), "no": (f"{root}/no", ["a"])}
    report = {r.table_name: r.status for r in tables.layout_job(spark, listed, f"{root}/out", 8 << 10).collect()}
    assert report == {"t": "success", "no": "skipped"}
    out = spark.read.parquet(f"{root}/out/t")
    assert out.exceptAll(spark.read.parquet(f"{root}/in")).isEmpty() and out.count() == 10000
    spans = out.groupBy(F.input_file_name()).agg((F.max("a").cast("double") - F.min("a")).alias("a"))
    assert spans.count() > 4 and spans.agg(F.avg("a")).first()[0] < 0.3 * 2**32
    with pytest.raises(ValueError):
        tables.compact_table(spark, f"{root}/in", f"{root}/more", ["a"] * 5)


def test_upsert_text_partitions_leave_no_copies(spark):
    path, schema = scratch_path(spark, "text"), "k INT, p STRING, q STRING"
    tables.upsert_table(spark.createDataFrame([(1, "A/1 x", "007"), (2, "A/1 x", "007"), (3, None, "a=b%c:d")], schema), path, ["k"], ["p", "q"])
    tables.upsert_table(spark.createDataFrame([(1, "B", "008"), (2, "é?*", "008"), (3, None, "x")], schema), path, ["k"], ["p", "q"])
    rows = {tuple(r) for r in spark.read.schema(schema).parquet(path).select("k", "p", "q").collect()}
    assert rows == {(1, "B", "008"), (2, "é?*", "008"), (3, None, "x")}


def test_upsert_keeps_columns_and_newer_versions(spark):
    path = scratch_path(spark, "wide")
    tables.upsert_table(spark.createDataFrame([(1, "a", "x", 5), (2, "b", "y", 2)], "k INT, v STRING, extra STRING, at INT"), path, ["k"])
    tables.upsert_table(spark.createDataFrame([(1, "A", 4), (2, "B", 2), (3, "C", 1)], "k INT, v STRING, at INT"), path, ["k"], version="at")
    rows = {tuple(r) for r in spark.read.parquet(path).select("k", "v", "extra", "at").collect()}
    assert rows == {(1, "a", "x", 5), (2, "B", "y", 2), (3, "C", None, 1)}
    with pytest.raises(ValueError):
        tables.upsert_table(spark.createDataFrame([(1, "p", 9), (1, "q", 9)], "k INT, v STRING, at INT"), path, ["k"])


def test_analyze(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.range(10).createOrReplaceTempView(f"{name}_v")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{scratch_path(spark, name)}' AS SELECT * FROM {name}_v")
    tables.analyze_table(spark, name, ["id"])
    assert "10 rows" in spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").first().data_type
    spark.sql(f"DROP TABLE {name}")


def test_run_step_status(spark):
    root = scratch_path(spark, "s")
    rows = spark.createDataFrame([(1, D[0], "a")], FX)

    def write(df):
        df.write.mode("append").parquet(f"{root}/out")

    assert tables.run_step(spark, "a", "r", rows, lambda d: d, write, f"{root}/audit") == {"rows_affected": 1, "status": "success"}
    assert tables.run_step(spark, "b", "r", rows.limit(0), lambda d: d, write, f"{root}/audit")["status"] == "no_data"
    with pytest.raises(ZeroDivisionError):
        tables.run_step(spark, "c", "r", rows, lambda d: 1 / 0, write, f"{root}/audit")
    log = spark.read.parquet(f"{root}/audit")
    assert {r.step: r.status for r in log.collect()} == {"a": "success", "b": "no_data", "c": "failed"}
    assert tables.audit_summary(log).first().failed_steps == 1


def test_stream_windows_drop_late_rows(spark):
    root = scratch_path(spark, "w")
    base = dt.datetime(2025, 1, 1, 12)
    schema = "fixture_id INT, bet_id INT, outcome STRING, ts TIMESTAMP, odd DOUBLE"

    def land(name, *rows):
        data = [(1, 1, "Home", base + dt.timedelta(minutes=m), o) for m, o in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        live.run_to_table(live.odds_windows(spark.readStream.schema(schema).parquet(f"{root}/in")), f"{root}/out", f"{root}/cp")

    land("a", (1, 2.0), (3, 1.5), (4, 1.8))
    run()
    land("b", (40, 3.0))
    run()
    land("c", (2, 9.9), (80, 3.0))
    run()
    rows = {r.window_start.minute: (r.last_odd, r.min_odd, r.max_odd, r.quotes) for r in spark.read.parquet(f"{root}/out").collect()}
    assert rows[0] == (1.8, 1.5, 2.0, 3) and rows[40] == (3.0, 3.0, 3.0, 1)


def test_stream_dedup(spark):
    root = scratch_path(spark, "d")
    rows = [(i % 10, dt.datetime(2025, 1, 1, 12, i % 10)) for i in range(30)]
    spark.createDataFrame(rows, "k INT, ts TIMESTAMP").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("k INT, ts TIMESTAMP").parquet(f"{root}/in")
    live.run_to_table(live.stream_dedup(stream, ["k"], "ts", "1 hour"), f"{root}/out", f"{root}/cp")
    assert spark.read.parquet(f"{root}/out").count() == 10


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "H", 1.0), (2, "X", 200.0), (None, None, None)], "k INT, r STRING, odd DOUBLE")
    got = {r.check_name: r.violations for r in quality.column_checks(df, ["k"], {"r": ["H", "D", "A"]}, {"odd": (1.01, 50)}).collect()}
    assert got == {"not_null:k": 1, "accepted:r": 1, "between:odd": 2}
    assert quality.odds_out_of_range(df, ["odd"]).count() == 2
    p = spark.createDataFrame([(0.5, 0.3, 0.26), (0.4, 0.3, 0.3), (None, 0.5, 0.5)], "prob_home_win DOUBLE, prob_draw DOUBLE, prob_away_win DOUBLE")
    assert quality.probability_sum_off(p).count() == 2
    drift = {r.column_name: (r.drift, r.filled) for r in quality.schema_drift(df, {"k": "bigint", "r": "string", "z": "int"}).collect()}
    assert drift == {"k": ("retyped", 2), "odd": ("extra", 2), "z": ("missing", None)}
    fresh = quality.freshness(spark.createDataFrame([], "ts TIMESTAMP"), "ts", F.current_timestamp(), "t").first()
    assert fresh.status == "error"
    report = quality.run_checks({"a": df.limit(0), "b": df})
    assert {r.check_name: r.status for r in report.collect()} == {"a": "pass", "b": "fail"}


def test_usable_raw_rows_are_parsed_once(spark):
    """They were turned back into text, and searched for their id, before the load read them."""
    good = '{"fixture": {"id": 1, "date": "2024-08-01"}}'
    payloads = [
        good, good[:30], good + "}", '{"other": 1}', '{"fixture": {"id": null}}', '{"fixture": {"id": "abc"}}', '{"fixture": {"id": NaN}}',
        "", None, "[1]", '{"fixture": 5}',
    ]
    raw = spark.createDataFrame([(p, str(i)) for i, p in enumerate(payloads)], "payload STRING, _batch_id STRING")
    usable, rejected = landing.split_raw(raw, "fixtures")
    assert {r._batch_id for r in usable.collect()} == {"0", "2", "5"}
    reasons = {r._batch_id: r._reject_reason for r in rejected.collect()}
    no_fields, malformed = dict.fromkeys("3 10 9".split(), "no_fields"), dict.fromkeys("1 6 7 8".split(), "malformed")
    assert reasons == {**no_fields, **malformed, "4": "null_key"}
    assert "structstojson" not in usable._jdf.queryExecution().optimizedPlan().toString().lower()


def test_keys_whose_hashes_agree_are_compared(spark):
    """A hash skips NULL, so these two keys share one."""
    rows = spark.createDataFrame([(None, "x"), ("x", None)], "a STRING, b STRING")
    tables.reject_duplicates(rows, ["a", "b"])
    with pytest.raises(ValueError, match="several rows"):
        tables.reject_duplicates(rows.unionByName(rows), ["a", "b"])
