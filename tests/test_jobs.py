"""The jobs end to end, over files."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.jobs import bronze, gold, history, marts, normalise, sentiment, silver

START = 1_704_067_200_000


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lake")
    body = [
        json.dumps(
            {
                "source": "x",
                "symbol": symbol,
                "price": 10.0 + minute % 7,
                "quantity": 1.0,
                "trade_time": START + minute * 60_000 + at,
                "is_buyer_maker": at == 0,
                "ingested_at": "2024-01-01T00:00:00",
            }
        )
        for minute in range(0, 2000, 10)
        for symbol in ("btcusdt", "ethusdt")
        for at in (0, 500)
    ]
    df = spark.createDataFrame([("k", b) for b in body * 2], schemas.MESSAGE)
    df.write.parquet(str(path / "topic"))
    return path


def test_layers(spark, lake, capsys):
    bronze.main(["--files", f"{lake}/topic", "--bronze", f"{lake}/bronze", "--checkpoint", f"{lake}/c/b"])
    run = ["--bronze", f"{lake}/bronze", "--silver", f"{lake}/silver", "--checkpoint", f"{lake}/c/s"]
    silver.main([*run, "--days", f"{lake}/days"])
    assert "1600 new bronze rows" in capsys.readouterr().out
    stream = ["--bronze", f"{lake}/bronze", "--silver", f"{lake}/appended", "--checkpoint", f"{lake}/c/a"]
    silver.main([*stream, "--stream", "--state-partitions", "2"])
    assert "1600 bronze rows read, 0 dropped as late" in capsys.readouterr().out
    for layer in ("silver", "appended"):
        assert spark.read.schema(schemas.SILVER).parquet(f"{lake}/{layer}").count() == 800


def test_candles(spark, lake):
    gold.main(["--silver", f"{lake}/silver", "--candles", f"{lake}/candles"])
    built = spark.read.parquet(f"{lake}/candles")
    order = ["candle_start_time", "symbol"]
    whole = rows(built.drop("ingested_at"), *order)
    assert len(whole) == 400
    # One day again: that day is replaced, the other stays.
    before = built.groupBy("day").agg(F.max("ingested_at")).collect()
    gold.main(["--silver", f"{lake}/silver", "--candles", f"{lake}/candles", "--start", "2024-01-02", "--end", "2024-01-02"])
    again = spark.read.parquet(f"{lake}/candles")
    after = again.groupBy("day").agg(F.max("ingested_at")).collect()
    assert rows(again.drop("ingested_at"), *order) == whole
    assert dict(before)[1] == dict(after)[1] and dict(before)[2] < dict(after)[2]
    # The days of the silver run, both, and then none.
    record = ["--days", f"{lake}/days", "--checkpoint", f"{lake}/c/g"]
    stamps = [dict(after)]
    for _ in range(2):
        gold.main(["--silver", f"{lake}/silver", "--candles", f"{lake}/candles", *record])
        again = spark.read.parquet(f"{lake}/candles")
        assert rows(again.drop("ingested_at"), *order) == whole
        stamps.append(dict(again.groupBy("day").agg(F.max("ingested_at")).collect()))
    assert stamps[0][1] < stamps[1][1] and stamps[0][2] < stamps[1][2] and stamps[1] == stamps[2]


def test_history(spark, lake):
    for _ in range(2):
        history.main(["--silver", f"{lake}/silver", "--history", f"{lake}/history", "--hour", "2024-01-01T03:00:00"])
    assert spark.read.parquet(f"{lake}/history").count() == 24
    history.main(["--silver", f"{lake}/silver", "--history", f"{lake}/history", "--all"])
    assert spark.read.parquet(f"{lake}/history").count() == 800


def test_history_to_a_database(spark, lake, monkeypatch):
    calls = []
    monkeypatch.setattr(history, "write_warehouse", lambda df, *args, **more: calls.append((rows(df, "trade_timestamp"), df.columns, args, more)))
    args = ["--silver", f"{lake}/silver", "--history", f"{lake}/history_db", "--jdbc-url", "jdbc:x", "--jdbc-option", "user=u"]
    history.main([*args, "--hour", "2024-01-01T03:00:00"])
    history.main([*args, "--all"])
    assert [(len(found), target, more) for found, _, target, more in calls] == [
        (24, ("jdbc:x", "history", "append"), {"user": "u"}),
        (800, ("jdbc:x", "history", "overwrite"), {"user": "u"}),
    ]
    assert calls[0][1] == calls[1][1] and "trade_hour" not in calls[0][1]


def test_sentiment_under_a_name(spark, lake):
    table = "sentiment_now"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for day, value in ((0, 40), (1, 60)):
        folder = lake / f"named{day}"
        folder.mkdir()
        item = {"value": str(value), "value_classification": "x", "timestamp": str(START // 1000 + day * 86400)}
        (folder / "one.json").write_text(json.dumps({"data": [item]}))
        sentiment.main(["--payloads", str(folder), "--table", table, "--next", f"{lake}/named/{day}"])
    assert [r.fng_value for r in spark.table(table).orderBy("date").collect()] == [40, 60]
    spark.sql(f"DROP TABLE {table}")
    with pytest.raises(SystemExit):
        sentiment.main(["--payloads", "x", "--table", table, "--current", "y", "--next", "z"])


def test_sentiment(spark, lake):
    folder = lake / "payloads"
    folder.mkdir()
    for day, value in ((0, 40), (1, 60)):
        item = {"value": str(value), "value_classification": "x", "timestamp": str(START // 1000 + day * 86400)}
        (folder / f"{day}.json").write_text(json.dumps({"data": [item]}, indent=2))
    sentiment.main(["--payloads", str(folder), "--next", f"{lake}/sentiment/1"])
    assert spark.read.parquet(f"{lake}/sentiment/1").count() == 2
    sentiment.main(["--payloads", str(folder), "--current", f"{lake}/sentiment/1", "--next", f"{lake}/sentiment/2"])
    table = spark.read.parquet(f"{lake}/sentiment/2")
    assert [(r.date.day, r.fng_value, r.updated_at is None) for r in table.orderBy("date").collect()] == [
        (1, 40, False),
        (2, 60, False),
    ]


def test_marts(spark, lake):
    args = ["--candles", f"{lake}/candles", "--sentiment", f"{lake}/sentiment/2", "--out", f"{lake}/marts"]
    marts.main([*args, "--as-of", "2024-01-03 00:00:00", "--pair", "btcusdt"])
    overview = spark.read.parquet(f"{lake}/marts/mart_market_overview")
    assert [(r.date.day, r.symbol, r.fng_value) for r in overview.orderBy("date").collect()] == [(1, "BTC", 40), (2, "BTC", 60)]
    report = spark.read.parquet(f"{lake}/marts/mart_ingestion_health")
    assert report.select(F.sum("candles_count")).first()[0] == 400
    assert report.columns[:2] == ["ingestion_hour", "symbol"]


def test_marts_fail_on_bad_candles(spark, lake):
    bad = spark.read.parquet(f"{lake}/candles")
    bad.unionByName(bad).write.parquet(f"{lake}/twice")
    args = ["--candles", f"{lake}/twice", "--sentiment", f"{lake}/sentiment/2", "--out", f"{lake}/marts_twice"]
    with pytest.raises(SystemExit, match="unique_candle_start_time_symbol: 800 of 800"):
        marts.main(args)
    assert not (lake / "marts_twice").exists()


def test_marts_of_some_days_and_from_a_database(spark, lake, monkeypatch):
    asked = []

    def read(session, url, table, **options):
        asked.append((url, table, options))
        return session.read.parquet(f"{lake}/candles")

    monkeypatch.setattr(marts, "read_warehouse", read)
    sentiment_path, day = ["--sentiment", f"{lake}/sentiment/2"], ["--start", "2024-01-02", "--end", "2024-01-02"]
    sources = (["--candles", f"{lake}/candles"], ["--jdbc-url", "jdbc:x", "--jdbc-option", "user=u"])
    found = []
    for at, source in enumerate(sources):
        marts.main([*source, *sentiment_path, *day, "--out", f"{lake}/marts_day{at}", "--as-of", "2024-01-03 00:00:00"])
        overview = spark.read.parquet(f"{lake}/marts_day{at}/mart_market_overview")
        found.append(rows(overview, "date", "symbol"))
    assert asked == [("jdbc:x", "fact_market_candles", {"user": "u"})]
    assert found[0] == found[1] and len(found[0]) == 2 and all(r[0].day == 2 for r in found[0])


def test_normalise_needs_its_topics():
    with pytest.raises(SystemExit):
        normalise.main([])
