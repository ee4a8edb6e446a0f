"""Match data derived from the given tables by integer arithmetic, as typed and as raw tables.

Nothing here collects an unbounded group: a raw record is built from one row of a large table, and only
the standings payload gathers rows (at most twenty teams of a league season).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.columns import argmax_label, confidence_band, outcome_label
from touchline.operators.aggregates import standings_table, team_season_stats
from touchline.operators.flatten import to_team_rows
from touchline.schemas import STATISTIC_COLUMNS

c = F.col


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as matches, before typing: every field the feeds need."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customers = table(spark, sf, "customer").select(c("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, sf, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_regionkey")
    joined = orders.join(customers, "o_custkey").join(nations, "c_nationkey")
    league = c("n_regionkey").cast("bigint")
    key, cust = c("o_orderkey"), c("o_custkey")
    status = F.when(c("o_orderstatus") == "F", "FT").when(c("o_orderstatus") == "O", "NS").otherwise("PST")
    return joined.select(
        key.alias("fixture_id"),
        cust.alias("seed"),
        league.alias("league_id"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("round"),
        c("o_orderdate").cast("date").alias("match_date"),
        status.alias("status"),
        (league * 100 + cust % 20).alias("home_team_id"),
        (league * 100 + (cust % 20 + 1 + key % 19) % 20).alias("away_team_id"),
        F.when(status == "FT", (key * 7 + cust) % 5).cast("int").alias("goals_home"),
        F.when(status == "FT", (key * 3 + cust * 2) % 4).cast("int").alias("goals_away"),
    )


def fixtures(spark: SparkSession, sf: str) -> DataFrame:
    return (
        matches(spark, sf)
        .drop("seed")
        .withColumn("result", outcome_label(c("goals_home"), c("goals_away"), c("status")))
    )


def _spread(rows: DataFrame, key: str = "fixture_id") -> DataFrame:
    """Rows dealt over as many tasks as shuffles have: one small file of tables becomes many payloads.

    By the match, or another ``key``, as rows dealt in turn are sorted before."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, key)


def _landed(payload: Column, feed: str, day: Column, params: Column | None = None, batch: str = "b1") -> list[Column]:
    return [
        payload.alias("payload"),
        F.lit(feed).alias("endpoint"),
        (F.lit(None).cast("string") if params is None else params).alias("params"),
        day.alias("_ingestion_date"),
        day.cast("timestamp").alias("_ingestion_ts"),
        F.lit(batch).alias("_batch_id"),
        F.lit(feed).alias("_source_endpoint"),
    ]


def _for_fixture() -> Column:
    return F.to_json(F.struct(c("fixture_id").cast("string").alias("fixture")))


def fixture_record(goals_home: Column, goals_away: Column, status: Column) -> Column:
    """The fixture document; kick-off is 23:30 at UTC-3, so the instant falls on the next UTC day."""

    def team(side: str) -> Column:
        key = c(f"{side}_team_id")
        return F.struct(key.alias("id"), F.concat(F.lit("Team "), key).alias("name"))

    return F.struct(
        F.struct(
            c("fixture_id").alias("id"),
            F.concat(c("match_date").cast("string"), F.lit("T23:30:00-03:00")).alias("date"),
            F.when(c("fixture_id") % 3 == 0, F.concat(F.lit("Referee "), c("seed") % 40)).alias("referee"),
            F.struct(status.alias("short")).alias("status"),
            F.struct(F.concat(F.lit("Ground "), c("home_team_id")).alias("name")).alias("venue"),
        ).alias("fixture"),
        F.struct(
            c("league_id").alias("id"),
            F.concat(F.lit("League "), c("league_id")).alias("name"),
            c("season"),
            F.concat(F.lit("Round "), c("round")).alias("round"),
        ).alias("league"),
        F.struct(team("home").alias("home"), team("away").alias("away")).alias("teams"),
        F.struct(goals_home.alias("home"), goals_away.alias("away")).alias("goals"),
    )


def raw_fixtures(spark: SparkSession, sf: str) -> DataFrame:
    """Every fixture landed twice: announced, then with its final state."""
    rows = _spread(matches(spark, sf)).withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    final = c("version") == 2
    record = fixture_record(
        F.when(final, c("goals_home")), F.when(final, c("goals_away")), F.when(final, c("status")).otherwise("NS")
    )
    return rows.select(*_landed(F.to_json(record), "/fixtures", F.date_add("match_date", c("version"))))


def statistic_value(j: int) -> Column:
    """Text of the j-th statistic: a number, a percentage, a decimal, or NULL."""
    base = (c("fixture_id") * (j + 3) + c("team_id") * 7) % 20
    name = list(STATISTIC_COLUMNS)[j]
    if name in ("Ball Possession", "Passes %"):
        return F.concat((base + 30).cast("string"), F.lit("%"))
    if name == "expected_goals":
        return F.concat(F.lit("1."), (base + 10).cast("string"))
    if name == "Red Cards":
        return F.when(c("fixture_id") % 3 != 0, base.cast("string"))
    return base.cast("string")


def raw_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """One record per finished match and team; ``Offsides`` is missing in every fifth match."""
    rows = to_team_rows(_spread(fixtures(spark, sf).filter(c("status") == "FT")))
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("type"), statistic_value(j).alias("value"))
            for j, name in enumerate(STATISTIC_COLUMNS)
        ]
    )
    listed = F.filter(entries, lambda e: (e["type"] != "Offsides") | (c("fixture_id") % 5 != 0))
    record = F.struct(F.struct(c("team_id").alias("id")).alias("team"), listed.alias("statistics"))
    return rows.select(*_landed(F.to_json(record), "/fixtures/statistics", F.date_add("match_date", 1), _for_fixture()))


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Up to three events per finished match; every second match landed twice."""
    key = c("fixture_id")
    rows = (
        _spread(matches(spark, sf))
        .filter((c("status") == "FT") & (key % 4 > 0))
        .withColumn("i", F.explode(F.sequence(F.lit(1), (key % 4).cast("int"))))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), (key % 2 + 1).cast("int"))))
    )
    kind = (key + c("i")) % 4
    record = F.struct(
        F.struct(
            ((key * 7 + c("i") * 13) % 90 + 1).cast("int").alias("elapsed"),
            F.when(c("i") == 2, c("i")).alias("extra"),
        ).alias("time"),
        F.struct(F.when(c("i") % 2 == 1, c("home_team_id")).otherwise(c("away_team_id")).alias("id")).alias("team"),
        F.struct(F.when(key % 7 != 0, (key * 3 + c("i")) % 500).alias("id")).alias("player"),
        F.when(kind == 0, "Goal").when(kind == 1, "Card").when(kind == 2, "subst").otherwise("Var").alias("type"),
        F.when(kind == 0, F.when(key % 5 == 0, "Own Goal").otherwise("Normal Goal"))
        .when(kind == 1, F.when(key % 3 == 0, "Red Card").otherwise("Yellow Card"))
        .when(kind == 2, "Substitution 1")
        .alias("detail"),
    )
    day = F.date_add("match_date", c("copy"))
    return rows.select(*_landed(F.to_json(record), "/fixtures/events", day, _for_fixture()))


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as price quotes of the match-winner market."""
    side = c("l_linenumber") % 3
    return table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("fixture_id"),
        (c("l_suppkey") % 10).alias("bookmaker_id"),
        F.lit(1).cast("bigint").alias("bet_id"),
        F.when(side == 0, "Home").when(side == 1, "Draw").otherwise("Away").alias("outcome"),
        ((c("l_partkey") % 900 + 101) / F.lit(100.0)).alias("odd"),
        c("l_shipdate").cast("date").alias("day"),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
    )


def raw_odds(spark: SparkSession, sf: str) -> DataFrame:
    """One four-level record per line item: its match-winner price, an over/under pair, and a first-half price under the
    match-winner's outcome names."""
    rows = _spread(quotes(spark, sf))
    text = c("odd").cast("decimal(6,2)").cast("string")
    other = ((c("l_suppkey") % 200 + 110) / F.lit(100.0)).cast("decimal(6,2)").cast("string")

    half = ((c("l_suppkey") % 300 + 1200) / F.lit(100.0)).cast("decimal(6,2)").cast("string")

    def price(value: Column, odd: Column) -> Column:
        return F.struct(value.alias("value"), odd.alias("odd"))

    bets = F.array(
        F.struct(
            c("bet_id").alias("id"), F.lit("Match Winner").alias("name"), F.array(price(c("outcome"), text)).alias("values")
        ),
        F.struct(
            F.lit(5).cast("bigint").alias("id"),
            F.lit("Goals Over/Under").alias("name"),
            F.array(price(F.lit("Over 2.5"), other), price(F.lit("Under 2.5"), other)).alias("values"),
        ),
        F.struct(
            F.lit(13).cast("bigint").alias("id"),
            F.lit("First Half Winner").alias("name"),
            F.array(price(c("outcome"), half)).alias("values"),
        ),
    )
    book = F.struct(
        c("bookmaker_id").alias("id"), F.concat(F.lit("Book "), c("bookmaker_id")).alias("name"), bets.alias("bets")
    )
    record = F.struct(F.struct(c("fixture_id").alias("id")).alias("fixture"), F.array(book).alias("bookmakers"))
    return rows.select(*_landed(F.to_json(record), "/odds", c("day")))


def odds_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Highest price per fixture, bookmaker and outcome (typed stand-in); spread by fixture, as its readers group by that."""
    from touchline.operators.flatten import pivot_static
    from touchline.schemas import OUTCOME_COLUMNS

    return pivot_static(quotes(spark, sf).repartition("fixture_id"), ["fixture_id", "bookmaker_id"], "outcome", OUTCOME_COLUMNS, "odd")


def season_standings(spark: SparkSession, sf: str, known: DataFrame | None = None) -> DataFrame:
    """Final table per league and season; the snapshot day is the last day of the season. ``known``: stored fixtures."""
    rows = to_team_rows(fixtures(spark, sf) if known is None else known)
    return standings_table(team_season_stats(rows)).withColumn("_snapshot_date", F.make_date("season", F.lit(12), F.lit(31)))


def raw_standings(spark: SparkSession, sf: str) -> DataFrame:
    """One record per league and season: two groups of at most ten teams, an array of arrays."""
    team = F.struct(
        c("position").alias("rank"),
        F.struct(c("team_id").alias("id"), F.concat(F.lit("Team "), c("team_id")).alias("name")).alias("team"),
        c("points"),
        c("goal_diff").alias("goalsDiff"),
        F.when(c("position") <= 10, "A").otherwise("B").alias("group"),
        F.struct(
            c("played"),
            c("wins").alias("win"),
            c("draws").alias("draw"),
            c("losses").alias("lose"),
            F.struct(c("goals_for").alias("for"), c("goals_against").alias("against")).alias("goals"),
        ).alias("all"),
    )
    grouped = season_standings(spark, sf).groupBy("league_id", "season").agg(F.sort_array(F.collect_list(team)).alias("t"))
    halves = F.array(F.filter("t", lambda r: r["group"] == "A"), F.filter("t", lambda r: r["group"] == "B"))
    record = F.struct(
        F.struct(
            c("league_id").alias("id"),
            F.concat(F.lit("League "), c("league_id")).alias("name"),
            c("season"),
            halves.alias("standings"),
        ).alias("league")
    )
    return grouped.select(*_landed(F.to_json(record), "/standings", F.make_date("season", F.lit(12), F.lit(31))))


def line_rows(spark: SparkSession, sf: str, known: DataFrame | None = None, spread: bool = False) -> DataFrame:
    """Line items with their match; even line numbers belong to the home side. ``known``: stored fixtures.

    ``spread``: dealt by match before they are joined, so that the join does not deal them once more."""
    lines = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("fixture_id"),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        c("l_quantity").cast("int").alias("quantity"),
        "l_returnflag",
        c("l_shipdate").cast("date").alias("day"),
    )
    home = c("l_linenumber") % 2 == 0
    return (
        (_spread(lines) if spread else lines)
        .join(fixtures(spark, sf) if known is None else known, "fixture_id")
        .withColumn("team_id", F.when(home, c("home_team_id")).otherwise(c("away_team_id")))
        .withColumn("player_id", c("team_id") * 100 + c("l_partkey") % 25)
    )


def player_stats(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Typed player match statistics. ``lines``: stored :func:`line_rows`."""
    return (line_rows(spark, sf) if lines is None else lines).select(
        "fixture_id",
        "season",
        "team_id",
        "player_id",
        (c("quantity") + 40).alias("minutes_played"),
        (c("l_linenumber") % 3).alias("goals"),
        (c("l_partkey") % 2).cast("int").alias("assists"),
        ((c("l_suppkey") % 50 + 50) / F.lit(10.0)).alias("rating"),
    )


def raw_player_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = line_rows(spark, sf, spread=True)
    statistics = F.struct(
        F.struct((c("quantity") + 40).alias("minutes"), ((c("l_suppkey") % 50 + 50) / F.lit(10.0)).cast("string").alias("rating")).alias(
            "games"
        ),
        F.struct((c("l_linenumber") % 3).alias("total"), (c("l_partkey") % 2).alias("assists")).alias("goals"),
        F.struct((c("l_partkey") % 9).alias("total"), (c("l_partkey") % 4).alias("on")).alias("shots"),
        F.struct(
            (c("l_partkey") % 80).alias("total"),
            (c("l_suppkey") % 6).alias("key"),
            F.concat((c("l_partkey") % 100).cast("string"), F.lit("%")).alias("accuracy"),
        ).alias("passes"),
        F.struct((c("l_suppkey") % 7).alias("total"), (c("l_suppkey") % 3).alias("interceptions")).alias("tackles"),
        F.struct((c("l_linenumber") % 2).alias("yellow"), F.lit(0).alias("red")).alias("cards"),
    )
    player = F.struct(
        F.struct(c("player_id").alias("id"), F.concat(F.lit("Player "), c("player_id")).alias("name")).alias("player"),
        F.array(statistics).alias("statistics"),
    )
    record = F.struct(F.struct(c("team_id").alias("id")).alias("team"), F.array(player).alias("players"))
    return rows.select(*_landed(F.to_json(record), "/fixtures/players", c("day"), _for_fixture()))


def injuries(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Typed injuries: returned line items. ``lines``: stored :func:`line_rows`."""
    return (
        (line_rows(spark, sf) if lines is None else lines)
        .filter(c("l_returnflag") == "R")
        .select("fixture_id", "league_id", "season", "team_id", "player_id", "match_date")
        .distinct()
    )


def raw_injuries(spark: SparkSession, sf: str) -> DataFrame:
    rows = line_rows(spark, sf, spread=True).filter(c("l_returnflag") == "R")
    record = F.struct(
        F.struct(
            c("player_id").alias("id"),
            F.concat(F.lit("Player "), c("player_id")).alias("name"),
            F.when(c("player_id") % 2 == 0, "Missing Fixture").otherwise("Questionable").alias("type"),
            F.when(c("player_id") % 3 == 0, "Knee Injury").otherwise("Suspended").alias("reason"),
        ).alias("player"),
        F.struct(c("team_id").alias("id")).alias("team"),
        F.struct(
            c("fixture_id").alias("id"), F.concat(c("match_date").cast("string"), F.lit("T20:00:00+00:00")).alias("date")
        ).alias("fixture"),
        F.struct(c("league_id").alias("id"), c("season")).alias("league"),
    )
    return rows.select(*_landed(F.to_json(record), "/injuries", c("day")))


def raw_lineups(spark: SparkSession, sf: str) -> DataFrame:
    """Eleven starters and three substitutes per team of a finished match."""
    rows = to_team_rows(_spread(fixtures(spark, sf).filter(c("status") == "FT")))

    def player(i: Column) -> Column:
        key = c("team_id") * 100 + (c("fixture_id") + i) % 25
        position = F.when(i == 0, "G").when(i <= 4, "D").when(i <= 8, "M").otherwise("F")
        return F.struct(
            F.struct(
                key.alias("id"), F.concat(F.lit("Player "), key).alias("name"), (i + 1).alias("number"), position.alias("pos")
            ).alias("player")
        )

    record = F.struct(
        F.struct(c("team_id").alias("id")).alias("team"),
        F.when(c("fixture_id") % 2 == 0, "4-3-3").otherwise("4-4-2").alias("formation"),
        F.transform(F.sequence(F.lit(0), F.lit(10)), player).alias("startXI"),
        F.transform(F.sequence(F.lit(11), F.lit(13)), player).alias("substitutes"),
    )
    return rows.select(*_landed(F.to_json(record), "/fixtures/lineups", c("match_date"), _for_fixture()))


def raw_teams(spark: SparkSession, sf: str) -> DataFrame:
    """One record per home match: the latest one describes the team."""
    key = c("home_team_id")
    record = F.struct(
        F.struct(
            key.alias("id"),
            F.concat(F.lit("Team "), key).alias("name"),
            F.concat(F.lit("T"), key).alias("code"),
            F.concat(F.lit("Country "), c("league_id")).alias("country"),
            (key % 120 + 1890).cast("int").alias("founded"),
        ).alias("team"),
        F.struct(
            F.concat(F.lit("Ground "), key).alias("name"),
            F.concat(F.lit("City "), key % 50).alias("city"),
            (key * 37 % 80000).cast("int").alias("capacity"),
        ).alias("venue"),
    )
    return _spread(matches(spark, sf)).select(*_landed(F.to_json(record), "/teams", c("match_date")))


def raw_leagues(spark: SparkSession, sf: str) -> DataFrame:
    """One record per match: its league with the season it was played in and the one before."""
    league, season = c("league_id"), c("season")

    def entry(year: Column) -> Column:
        return F.struct(
            year.cast("int").alias("year"),
            F.concat(year.cast("string"), F.lit("-01-01")).alias("start"),
            F.concat(year.cast("string"), F.lit("-12-31")).alias("end"),
            F.struct(
                F.struct(
                    (year % 2 == 0).alias("events"),
                    F.lit(True).alias("lineups"),
                    ((year + league) % 3 != 0).alias("statistics_fixtures"),
                ).alias("fixtures"),
                F.lit(True).alias("standings"),
                (league % 2 == 0).alias("players"),
                F.lit(False).alias("predictions"),
                ((year + league) % 2 == 0).alias("odds"),
            ).alias("coverage"),
        )

    record = F.struct(
        F.struct(
            league.alias("id"),
            F.concat(F.lit("League "), league).alias("name"),
            F.when(league == 4, "Cup").otherwise("League").alias("type"),
        ).alias("league"),
        F.struct(F.concat(F.lit("Country "), league).alias("name"), F.concat(F.lit("C"), league).alias("code")).alias("country"),
        F.array(entry(season - 1), entry(season)).alias("seasons"),
    )
    return _spread(matches(spark, sf)).select(*_landed(F.to_json(record), "/leagues", c("match_date")))


def league_types(spark: SparkSession, sf: str) -> DataFrame:
    key = c("r_regionkey").cast("bigint")
    return table(spark, sf, "region").select(key.alias("league_id"), F.when(key == 4, "Cup").otherwise("League").alias("league_type"))


def raw_players(spark: SparkSession, sf: str) -> DataFrame:
    key = c("p_partkey")
    record = F.struct(
        F.struct(
            key.alias("id"),
            c("p_name").alias("name"),
            F.concat(F.lit("First "), key % 97).alias("firstname"),
            c("p_brand").alias("lastname"),
            (key % 20 + 17).cast("int").alias("age"),
            F.struct(F.concat((key % 20 + 1980).cast("string"), F.lit("-05-17")).alias("date")).alias("birth"),
            c("p_type").alias("nationality"),
            F.concat((c("p_size") + 150).cast("string"), F.lit(" cm")).alias("height"),
        ).alias("player"),
        F.array(
            *[
                F.struct(
                    F.struct((key % 5 * 100 + (key + s) % 20).alias("id")).alias("team"),
                    F.struct(F.lit(s).alias("season")).alias("league"),
                    F.struct(F.when(key % 2 == 0, "Attacker").otherwise("Defender").alias("position")).alias("games"),
                )
                for s in (2000, 2001)
            ]
        ).alias("statistics"),
    )
    day = F.make_date(F.lit(2001), F.lit(1), F.lit(1))
    return _spread(table(spark, sf, "part"), "p_partkey").select(*_landed(F.to_json(record), "/players", day))


def raw_transfers(spark: SparkSession, sf: str) -> DataFrame:
    key = c("o_custkey")
    team = (key % 5 * 100 + c("o_orderkey") % 20).alias("id")
    other = (key % 5 * 100 + (c("o_orderkey") + 7) % 20).alias("id")

    def named(col: Column) -> Column:
        return F.struct(col.alias("id"), F.concat(F.lit("Team "), col).alias("name"))

    move = F.struct(
        c("o_orderdate").cast("date").cast("string").alias("date"),
        F.when(c("o_orderkey") % 2 == 0, "Loan").otherwise("Free").alias("type"),
        F.struct(named(team).alias("in"), named(other).alias("out")).alias("teams"),
    )
    record = F.struct(
        F.struct(key.alias("id"), F.concat(F.lit("Player "), key).alias("name")).alias("player"), F.array(move).alias("transfers")
    )
    orders = _spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    return orders.select(*_landed(F.to_json(record), "/transfers", c("o_orderdate").cast("date")))


def api_percent(side: str) -> Column:
    key = c("fixture_id")
    return {"home": key * 13 % 60, "draw": key * 7 % 40, "away": key * 11 % 50}[side]


def raw_api_predictions(spark: SparkSession, sf: str) -> DataFrame:
    def text(side: str) -> Column:
        return F.concat(api_percent(side).cast("string"), F.lit("%")).alias(side)

    record = F.struct(
        F.struct(
            F.struct(c("home_team_id").alias("id"), F.concat(F.lit("Team "), c("home_team_id")).alias("name")).alias("winner"),
            F.lit("Double chance").alias("advice"),
            F.struct(text("home"), text("draw"), text("away")).alias("percent"),
        ).alias("predictions")
    )
    return _spread(matches(spark, sf)).select(*_landed(F.to_json(record), "/predictions", c("match_date"), _for_fixture()))


def api_predictions(spark: SparkSession, sf: str, known: DataFrame | None = None) -> DataFrame:
    """Typed external predictions as fractions. ``known``: stored fixtures."""
    return (fixtures(spark, sf) if known is None else known).select(
        "fixture_id", *[(api_percent(s) / F.lit(100.0)).alias(f"pred_{s}_pct") for s in ("home", "draw", "away")]
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored predictions of two model versions; probabilities are whole ten-thousandths."""
    home = c("fixture_id") * 13 % 60 + 20
    draw = c("seed") * 7 % 30 + 10
    away = (c("fixture_id") * 11 + c("seed")) % 50 + 20
    total = home + draw + away

    def share(weight: Column) -> Column:
        return F.floor(weight * 10000 / total) / F.lit(10000.0)

    probs = {"H": c("prob_home_win"), "D": c("prob_draw"), "A": c("prob_away_win")}
    return (
        matches(spark, sf)
        .select(
            "fixture_id",
            "league_id",
            "season",
            "round",
            "match_date",
            "home_team_id",
            "away_team_id",
            share(home).alias("prob_home_win"),
            share(draw).alias("prob_draw"),
            share(away).alias("prob_away_win"),
            F.concat(F.lit("v"), c("fixture_id") % 2 + 1).alias("model_version"),
        )
        .withColumns({"predicted_result": argmax_label(probs), "confidence": confidence_band(*probs.values())})
    )


def derbies(spark: SparkSession, sf: str) -> DataFrame:
    """Derby pairs: neighbouring team ids of each nation's league (at most one pair per nation)."""
    key = c("n_regionkey").cast("bigint") * 100 + c("n_nationkey") % 19
    return table(spark, sf, "nation").select((key + 1).alias("team_a"), key.cast("bigint").alias("team_b")).distinct()


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Alias names of nations: upper-case name to a common form."""
    return table(spark, sf, "nation").select(
        c("n_name").alias("alias_name"), F.concat(F.lit("Nation "), c("n_nationkey")).alias("common_name")
    )


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a log of requests against a daily quota of 7,500; ``remaining`` from the JSON property."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, sf, "events").select(
        c("ts").cast("date").alias("day"), "event_id", k.alias("remaining"), F.lit(1000).alias("quota")
    )
