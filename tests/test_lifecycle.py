"""A small league from raw records to marts, loaded in two increments."""

import datetime as dt
import json
import os

from touchline.operators import flatten
from touchline.plans import lifecycle
from touchline.schemas import FEEDS, RAW
from touchline.session import scratch_path
from touchline.sources import landing, tables


def raw(spark, records, at):
    rows = [(json.dumps(p), "/e", json.dumps(params), at.date(), at, "b", "/e") for p, params in records]
    return spark.createDataFrame(rows, RAW)


def fixture(i, day, home, away, score=None):
    return (
        {
            "fixture": {"id": i, "date": f"{day}T20:00:00+00:00", "status": {"short": "FT" if score else "NS"}},
            "league": {"id": 71, "season": 2025, "round": "1"},
            "teams": {"home": {"id": home}, "away": {"id": away}},
            "goals": dict(zip(("home", "away"), score or (None, None), strict=True)),
        },
        {},
    )


def card(i, minute, player):
    return (
        {"time": {"elapsed": minute}, "team": {"id": 1}, "player": {"id": player}, "type": "Card", "detail": "Yellow Card"},
        {"fixture": str(i)},
    )


def test_two_increments(spark):
    root = scratch_path(spark, "e2e")
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0)
    lifecycle.land(raw(spark, [fixture(1, "2025-04-01", 1, 2), fixture(2, "2025-04-08", 2, 1)], now), root, "fixtures")
    lifecycle.land(raw(spark, [card(1, 10, 5), card(1, 10, 6), card(1, 10, 5)], now), root, "events")
    first = lifecycle.load_all(spark, root, "r1")
    assert first["fixtures"] == {"rows_affected": 2, "status": "success"}
    assert first["match_events"]["rows_affected"] == 2

    later = now + dt.timedelta(seconds=5)
    lifecycle.land(raw(spark, [fixture(1, "2025-04-01", 1, 2, (2, 0)), fixture(2, "2025-04-20", 2, 1)], later), root, "fixtures")
    for run in ("r2", "r3"):
        lifecycle.load_all(spark, root, run)
        rows = {r.fixture_id: (r.match_date, r.result) for r in spark.read.parquet(f"{root}/silver/fixtures").collect()}
        assert rows == {1: (dt.date(2025, 4, 1), "H"), 2: (dt.date(2025, 4, 20), None)}
    events = spark.read.parquet(f"{root}/silver/match_events").collect()
    assert {r.match_date for r in events} == {dt.date(2025, 4, 1)} and len(events) == 2

    for _ in range(2):
        lifecycle.build_marts(spark, root, "r3")
    summary = spark.read.parquet(f"{root}/gold/league_summary").collect()
    assert [(r.total_matches, r.matches_played, r.home_win_pct) for r in summary] == [(2, 1, 100.0)]
    form = {r.team_id: (r.form_string, r.elo_rating) for r in spark.read.parquet(f"{root}/gold/team_form").collect()}
    assert form[1][0] == "W" and form[2][0] == "L" and form[1][1] > 1500 > form[2][1]
    assert spark.read.parquet(f"{root}/gold/head_to_head").count() == 2

    audit = spark.read.parquet(f"{root}/audit")
    # Every batch is read once: both feeds in r1, fixtures in r2, nothing in r3.
    assert audit.filter("status = 'success'").count() == 3 and audit.filter("status = 'no_data'").count() == 3
    future = lifecycle.load_table(spark, root, "fixtures", "r4", since=dt.date(2999, 1, 1))
    assert future == {"rows_affected": 0, "status": "no_data"}

    before = {n: spark.read.parquet(f"{root}/{n}") for n in ("silver/fixtures", "gold/team_form", "gold/head_to_head")}
    status = {r.table_name: r.status for r in lifecycle.layout_all(spark, root, f"{root}/laid").collect()}
    assert {status[n.split("/")[1]] for n in before} == {"success"} and status["injuries"] == "skipped"
    for name, df in before.items():
        out = spark.read.parquet(f"{root}/laid/{name.split('/')[1]}").select(*df.columns)
        assert out.exceptAll(df).isEmpty() and out.count() == df.count()

    assert lifecycle.expire_raw(spark, root, now.date()) == {"fixtures": 0, "events": 0}
    gone = lifecycle.expire_raw(spark, root, now.date() + dt.timedelta(days=40))
    assert gone["events"] == 1 and gone["fixtures"] >= 1


def test_a_load_parses_a_record_once(spark, monkeypatch):
    """For its reject reason and for the typed row; a load without rejects reads no raw row for them."""
    root, plans = scratch_path(spark, "once"), []
    at = dt.datetime(2025, 4, 2)
    store, reject = tables.stored, lifecycle.append_table

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString().lower()))
        return store(df, name)

    def rejects(df, path, *rest):
        plans.append(("rejects", df._jdf.queryExecution().optimizedPlan().toString().lower()))
        reject(df, path, *rest)

    monkeypatch.setattr(tables, "stored", seen)
    monkeypatch.setattr(lifecycle, "append_table", rejects)
    reject(raw(spark, [fixture(1, "2025-04-01", 1, 2, (2, 0)), fixture(2, "2025-04-08", 2, 1)], at), f"{root}/bronze/fixtures")
    assert lifecycle.load_table(spark, root, "fixtures", "r1", partitioned=False)["rows_affected"] == 2
    assert [plan.count("from_json") for name, plan in plans if name == "upsert-source"] == [1]
    assert [plan.count("from_json") for name, plan in plans if name == "rejects"] == [0]
    assert spark.read.parquet(f"{root}/rejects/fixtures").count() == 0

    good = json.dumps(fixture(3, "2025-04-09", 1, 2, (1, 1))[0])
    lists = {"r2": [good[:30], good], "r3": [good[:40], '{"other": 1}']}  # the last load has no usable row
    for run, payloads in lists.items():
        later = at + dt.timedelta(seconds=int(run[1]))
        rows = [(p, "/e", None, later.date(), later, run, "/e") for p in payloads]
        reject(spark.createDataFrame(rows, RAW), f"{root}/bronze/fixtures")
        done = lifecycle.load_table(spark, root, "fixtures", run, partitioned=False)
        assert done == {"rows_affected": int(run == "r2"), "status": "success"}
    found = {(r._run_id, r._reject_reason) for r in spark.read.parquet(f"{root}/rejects/fixtures").collect()}
    assert found == {("r2", "malformed"), ("r3", "malformed"), ("r3", "no_fields")}
    assert {r.fixture_id for r in spark.read.parquet(f"{root}/silver/fixtures").collect()} == {1, 2, 3}


def test_first_load_of_an_unpartitioned_table_moves_the_staged_files(spark, monkeypatch):
    """Also where an empty directory is in the way; rows and a second load are as before."""
    path = scratch_path(spark, "first")
    os.makedirs(path)
    monkeypatch.setattr(tables, "_write", None)
    tables.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING"), path, ["k"])
    monkeypatch.undo()
    assert not [n for n in os.listdir(path) if os.path.isdir(f"{path}/{n}")]
    tables.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], "k INT, v STRING"), path, ["k"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_records_marked_and_parsed_again_are_the_same(spark):
    """A usable record has the same fields whichever way it is parsed, cut or of other types."""
    good = json.dumps(fixture(1, "2025-04-01", 1, 2, (2, 0))[0])
    odd = [good, good + "}", '{"fixture": {"id": "abc"}}', '{"fixture": {"id": 7, "date": 5}, "goals": {"home": "x", "away": 1}}',
           '{"fixture": {"id": 8}, "league": [1]}', '{"fixture": {"id": 9}, "teams": "none", "league": {"id": 1.5}}']
    rows = spark.createDataFrame([(p, i) for i, p in enumerate(odd)], "payload STRING, i INT")
    marked = landing.mark_raw(rows, "fixtures").filter("_reject_reason IS NULL")
    again = flatten.parse_payload(rows, FEEDS["fixtures"].schema)
    names = [f.name for f in again.schema["rec"].dataType]
    expected = {r.i: r.asDict(True) for r in again.select("i", "rec.*").collect()}
    found = {r.i: r.asDict(True) for r in marked.select("i", *[f"rec.{n}" for n in names]).collect()}
    assert len(found) >= 4 and found == {i: expected[i] for i in found}
