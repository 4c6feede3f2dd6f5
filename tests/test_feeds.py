"""Feed files → typed rows, and the ingestion jobs that store them."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.functions.scalars import mentioned_tickers, statement_timestamp
from quotemill.plans.ingest import JOBS, ingest, ingest_articles, ingest_constituents
from quotemill.sources import feeds
from quotemill.sources.tables import Tables

DAY = "2024-05-03"


def millis(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def land(root, feed, lines, day=DAY):
    folder = os.path.join(str(root), feed, day)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.json"), "w") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return folder


def read(spark, tmp_path, lines, schema):
    return feeds.read_feed(spark, land(tmp_path, "feed", lines), schema)


def bar(close, day=None, **more):
    return {"o": 1.0, "h": 2.0, "l": 0.5, "c": close, "v": 1.2e3, "vw": 1.1, "n": 7} | (
        {"t": millis(day)} if day else {}
    ) | more


PRICES = [
    {"ticker": "A", "status": "OK", "results": [bar(10.0, "2024-05-02"), bar(11.0, "2024-05-03")]},
    {"ticker": "B", "status": "OK", "results": []},
    {"ticker": "C", "status": "ERROR", "results": [bar(1.0)]},
    {"ticker": "D", "status": "OK"},
    "{broken",
    {"ticker": "E", "status": "OK", "results": [bar(5.0), bar(6.0, "2024-05-02T23:59:59.999")]},
]


def test_price_bars(spark, tmp_path):
    payloads = read(spark, tmp_path, PRICES, schemas.PRICE_FEED)
    rows = feeds.stock_prices(payloads, DAY).orderBy("ticker", "close").collect()
    assert [(r["ticker"], r["close"], str(r["date"])) for r in rows] == [
        ("A", 10.0, DAY), ("A", 11.0, DAY), ("E", 5.0, DAY), ("E", 6.0, DAY)
    ]
    assert rows[0]["volume"] == 1200 and rows[0]["transactions"] == 7
    dated = feeds.stock_prices_range(payloads).orderBy("ticker", "close").collect()
    assert [str(r["date"]) for r in dated] == ["2024-05-02", "2024-05-03", "None", "2024-05-02"]


def test_indicator_points(spark, tmp_path):
    days = ["2024-05-01", "2024-05-02", "2024-05-03T23:59:59.999", "2024-05-04"]
    points = [{"timestamp": millis(d), "value": float(i)} for i, d in enumerate(days)]
    lines = [
        {"ticker": "A", "status": "OK", "results": {"values": points}},
        {"ticker": "B", "status": "OK", "results": {}},
        {"ticker": "C", "status": "OK", "results": {"values": points[:1] + [{"value": 9.0}]}},
    ]
    payloads = read(spark, tmp_path, lines, schemas.INDICATOR_FEED)
    rows = feeds.indicator(payloads, DAY, "rsi", 14, limit=2).orderBy("ticker", "timestamp").collect()
    assert [(r["ticker"], r["rsi_value"], str(r["date"]), r["window_size"]) for r in rows] == [
        ("A", 1.0, DAY, 14), ("A", 2.0, DAY, 14), ("C", 9.0, DAY, 14), ("C", 0.0, DAY, 14)
    ]
    own = feeds.indicator(payloads, DAY, "sma", 30, limit=1, stamp_run_date=False).filter("ticker = 'A'").first()
    assert (own["sma_value"], str(own["date"]), own["series_type"]) == (2.0, "2024-05-03", "close")


def test_macd_points(spark, tmp_path):
    values = [{"timestamp": millis("2024-05-02"), "value": 1.0, "signal": 2.0, "histogram": -1.0}]
    payloads = read(spark, tmp_path, [{"ticker": "A", "status": "OK", "results": {"values": values}}], schemas.MACD_FEED)
    row = feeds.macd(payloads, DAY).first()
    assert (row["macd_value"], row["signal_value"], row["histogram_value"]) == (1.0, 2.0, -1.0)
    assert (row["short_window"], row["long_window"], row["signal_window"]) == (12, 26, 9)


def article(i, published, **more):
    return {"id": f"n{i}", "title": f"t{i}", "published_utc": published} | more


NEWS = [
    {
        "ticker": "A",
        "status": "OK",
        "results": [
            article(1, "2024-05-03T10:00:00Z", publisher={"name": "P"}, tickers=["A", "B"], keywords=["k"]),
            article(2, "2024-05-03T23:00:00+02:00"),
            article(3, "2024-05-02T10:00:00Z"),
            article(4, None),
        ],
    },
    {"ticker": "B", "status": "OK", "results": None},
]


def test_news(spark, tmp_path):
    payloads = read(spark, tmp_path, NEWS, schemas.NEWS_FEED)
    rows = {r["article_id"]: r for r in feeds.news(payloads, DAY).collect()}
    assert set(rows) == {"n1", "n2"}
    assert rows["n1"]["publisher_name"] == "P" and rows["n2"]["publisher_name"] is None
    assert rows["n2"]["published_utc"] == dt.datetime(2024, 5, 3, 23)
    assert rows["n1"]["tickers"] == '["A","B"]' and rows["n2"]["tickers"] == "null"
    assert [r["article_id"] for r in feeds.news(payloads, DAY, limit_per_ticker=1).collect()] == ["n2"]
    ranged = feeds.news_range(payloads, "2024-05-01", DAY).collect()
    assert {(r["article_id"], str(r["date"])) for r in ranged} == {("n1", DAY), ("n2", DAY), ("n3", "2024-05-02")}
    parsed = feeds.with_variants(feeds.news(payloads, DAY), "tickers")
    kinds = parsed.select("article_id", F.schema_of_variant("tickers")).collect()
    assert {tuple(r) for r in kinds} == {("n1", "ARRAY<STRING>"), ("n2", "VOID")}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("NYSE:MRK,NASDAQ:AAPL", ["MRK", "AAPL"]),
        (" NYSE:MRK , ", ["MRK"]),
        ("MRK", ["MRK"]),
        ("A:B:MRK", ["MRK"]),
        ("", []),
        (None, None),
        ("\tNYSE:MRK\n,NYSE:MRK", ["MRK", "MRK"]),
    ],
)
def test_mentioned_tickers(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(mentioned_tickers(F.col("t"))).first()[0] == expected


def test_articles(spark, tmp_path):
    lines = [
        {"date": f"{DAY} 08:00:00", "tickers": "NYSE:A, NYSE:A, NASDAQ:Z", "title": "x", "link": "l"},
        {"date": "2024-05-02 08:00:00", "tickers": "NYSE:A"},
        {"date": "2024-05-04 08:00:00", "tickers": "NYSE:A"},
        {"tickers": "NYSE:A"},
    ]
    feed = read(spark, tmp_path, lines, schemas.ARTICLE_FEED)
    members = spark.createDataFrame([("A",), ("B",)], "ticker string")
    rows = feeds.articles(feed, DAY, members).collect()
    assert [(r["ticker"], r["title"], r["article_url"], str(r["date"])) for r in rows] == [("A", "x", "l", DAY)] * 2


def test_statement_timestamp(spark):
    rows = [("2024-05-03 16:30:00",), ("2024-05-03",), ("soon",), (None,), ("2024-13-40 00:00:00",)]
    df = spark.createDataFrame(rows, "t string").select(statement_timestamp(F.col("t")))
    assert [r[0] for r in df.collect()] == [dt.datetime(2024, 5, 3, 16, 30), None, None, None, None]


def test_feed_names():
    assert schemas.feed_name("total_debt") == "totalDebt"
    assert schemas.feed_name("weighted_average_shares_out_diluted") == "weightedAverageShsOutDil"
    assert (len(schemas.INCOME_AMOUNTS), len(schemas.BALANCE_AMOUNTS), len(schemas.CASH_FLOW_AMOUNTS)) == (31, 52, 39)


STATEMENTS = [
    {
        "ticker": "A",
        "results": [
            {"date": "2023-12-31", "fiscalYear": "2023", "period": "FY", "acceptedDate": "2024-02-01 16:00:00",
             "revenue": 1234567890123.5, "epsDiluted": 1.25, "weightedAverageShsOutDil": 10},
            {"date": "2022-12-31", "fiscalYear": "2022", "period": "FY", "acceptedDate": "?", "revenue": 5},
        ],
    },
    {"ticker": "B", "results": []},
    {"ticker": "C"},
]


def test_income_statements(spark, tmp_path):
    payloads = read(spark, tmp_path, STATEMENTS, schemas.statement_feed(schemas.INCOME_AMOUNTS))
    late, early = feeds.income_statements(payloads).orderBy(F.desc("date")).collect()
    assert late["revenue"] == 1234567890124 and late["eps_diluted"] == 1.25
    assert late["weighted_average_shares_out_diluted"] == 10 and late["net_income"] is None
    assert late["accepted_date"] == dt.datetime(2024, 2, 1, 16) and early["accepted_date"] is None
    assert feeds.income_statements(payloads).schema.names == schemas.INCOME.names


# -- jobs ---------------------------------------------------------------------


@pytest.fixture
def warehouse(spark, tmp_path):
    tables, root = Tables(spark, str(tmp_path / "tables")), str(tmp_path / "feeds")
    folder = os.path.join(root, "constituents", DAY)
    os.makedirs(folder)
    with open(os.path.join(folder, "part.csv"), "w") as out:
        out.write(",".join(schemas.CONSTITUENT_HEADERS) + "\n")
        out.write('A,Alpha,Tech,Chips,"Austin, Texas",1999-01-04,1,1950\n')
        out.write("E,Echo,Energy,Oil,Houston,,2,1960 (1910)\n")
    assert ingest_constituents(tables, root, DAY)
    return tables, root


def test_constituents(warehouse):
    tables, _ = warehouse
    rows = tables.read("raw/tickers_lookup", schemas.CONSTITUENTS).orderBy("ticker").collect()
    assert [(r["ticker"], r["headquarters_location"], str(r["date_added"]), str(r["date"])) for r in rows] == [
        ("A", "Austin, Texas", "1999-01-04", DAY), ("E", "Houston", "None", DAY)
    ]


def stored(tables, name):
    return tables.read(f"raw/{name}", schemas.RAW_TABLES[name])


def test_price_jobs(warehouse):
    tables, root = warehouse
    land(root, "prices", [PRICES[0], {**PRICES[5], "ticker": "NOT_A_MEMBER"}])
    assert ingest(tables, root, "prices", DAY)
    assert ingest(tables, root, "prices", DAY)  # a rerun replaces the day
    assert stored(tables, "stock_prices").count() == 2
    land(root, "prices_range", [PRICES[0], PRICES[5]])
    assert ingest(tables, root, "prices_backfill", DAY, lookback_days=30)
    assert ingest(tables, root, "prices_backfill", DAY, lookback_days=30)
    kept = stored(tables, "stock_prices_backfill")
    assert kept.filter("date is not null").count() == 3
    assert kept.filter("date is null").count() == 2  # undated bars are never replaced
    land(root, "prices", [PRICES[2]], day="2024-05-04")
    land(root, "constituents", [], day="2024-05-04")
    assert not ingest(tables, root, "prices", "2024-05-04")


def test_indicator_jobs(warehouse):
    tables, root = warehouse
    values = [{"timestamp": millis(f"2024-05-0{d}"), "value": float(d)} for d in (1, 2, 3)]
    land(root, "rsi", [{"ticker": "A", "status": "OK", "results": {"values": values}}])
    ingest(tables, root, "rsi", DAY)
    ingest(tables, root, "rsi_backfill", DAY)
    assert [(r["rsi_value"], str(r["date"])) for r in stored(tables, "rsi").collect()] == [(3.0, DAY)]
    assert stored(tables, "rsi_backfill").select("date").distinct().count() == 3
    macd = [{"timestamp": millis("2024-05-02"), "value": 1.0, "signal": 2.0, "histogram": -1.0}]
    land(root, "macd", [{"ticker": "A", "status": "OK", "results": {"values": macd}}])
    ingest(tables, root, "macd", DAY)
    ingest(tables, root, "macd_backfill", DAY)
    assert str(stored(tables, "macd").first()["date"]) == DAY
    assert str(stored(tables, "macd_backfill").first()["date"]) == "2024-05-02"
    land(root, "sma", [{"ticker": "A", "status": "OK", "results": {"values": values}}])
    ingest(tables, root, "sma", DAY, limit=2)
    assert stored(tables, "sma").count() == 2
    with pytest.raises(ValueError):
        ingest(tables, root, "sma", DAY, colour="red")


def test_news_jobs_store_variants(warehouse):
    tables, root = warehouse
    land(root, "news", NEWS)
    land(root, "news_range", NEWS)
    ingest(tables, root, "news", DAY)
    ingest(tables, root, "news_backfill", DAY)
    assert stored(tables, "news").count() == 2 and stored(tables, "news_backfill").count() == 3
    first = stored(tables, "news").filter("article_id = 'n1'")
    assert first.select(F.variant_get("tickers", "$[1]", "string")).first()[0] == "B"


def test_statement_and_article_jobs(warehouse):
    tables, root = warehouse
    for name in ("income_statements", "balance_sheets", "cash_flow_statements"):
        land(root, name, STATEMENTS)
        assert ingest(tables, root, name, DAY)
        assert stored(tables, name).count() == 2
    land(root, "articles", [{"date": f"{DAY} 01:00:00", "tickers": "NYSE:A,NYSE:Q", "link": "l"}])
    assert ingest_articles(tables, root, DAY)
    assert stored(tables, "articles").count() == 1


def test_every_job_has_a_raw_table():
    assert {job.table.removeprefix("raw/") for job in JOBS.values()} | {"tickers_lookup", "articles"} == set(
        schemas.RAW_TABLES
    )


def test_lines_without_rows_are_rejected_with_a_reason(spark, tmp_path):
    from quotemill import schemas

    lines = [
        '{"ticker":"A","status":"OK","results":[{"c":1.0,"v":1e300,"t":0}]}',
        '{"ticker":"B","status":"OK","results":[{"c":1.0',
        "nonsense",
        '{"ticker":"C","status":"ERROR"}',
        '{"ticker":"D","status":"OK","results":[]}',
        '{"ticker":"E","status":"OK"}',
    ]
    path = str(tmp_path / "feed")
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(path)
    reasons = {r["line"]: r["reason"] for r in feeds.read_rejects(spark, path, schemas.PRICE_FEED).collect()}
    assert reasons == dict(zip(lines[1:], ["broken", "broken", "status", "empty", "empty"]))
    rows = feeds.stock_prices_range(feeds.read_feed(spark, path, schemas.PRICE_FEED)).collect()
    assert [(r["ticker"], r["volume"]) for r in rows] == [("A", None)]


def test_text_that_is_no_json_gives_no_variant(spark):
    rows = spark.createDataFrame([('["a"]',), ("[",), (None,)], "keywords string")
    got = feeds.with_variants(rows, "keywords").select(F.to_json("keywords").alias("k")).collect()
    assert [r["k"] for r in got] == ['["a"]', None, None]


def test_jobs_keep_lines_that_bring_no_rows(warehouse):
    tables, root = warehouse
    good = PRICES[0]
    land(root, "prices", [good, {"ticker": "A", "status": "ERROR"}, {"ticker": "A", "status": "OK", "results": []}])
    done = ingest(tables, root, "prices", DAY)
    assert done.written and done.rejects == {"status": 1, "empty": 1}
    kept = tables.read("rejects/prices").collect()
    assert {(r["feed"], r["reason"], str(r["date"])) for r in kept} == {("prices", "status", DAY), ("prices", "empty", DAY)}
    assert all(r["line"].startswith("{") for r in kept)
    land(root, "prices", [good])
    assert ingest(tables, root, "prices", DAY).rejects == {}  # a rerun without damage clears the day
    assert tables.read("rejects/prices").count() == 0


def test_partial_payloads_are_used_and_told(spark, tmp_path):
    """A field of another type costs that field, not the rows, and the line is on record."""
    lines = ['{"ticker":"A","status":"OK","results":[{"c":1.0,"n":"many","t":0}]}', '{"ticker":"B","status":"OK","results":"none"}']
    path = str(tmp_path / "feed")
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(path)
    read = feeds.parsed(feeds.read_lines(spark, path), schemas.PRICE_FEED)
    assert {r["line"]: r["reason"] for r in feeds.rejected(read).collect()} == dict(zip(lines, ["partial", "broken"]))
    rows = feeds.stock_prices_range(feeds.payloads(read)).collect()
    assert [(r["ticker"], r["close"], r["transactions"]) for r in rows] == [("A", 1.0, None)]


def test_members_without_a_ticker_are_rejected(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "w"))
    header = ",".join(schemas.CONSTITUENT_HEADERS)
    path = tmp_path / "feeds" / "constituents" / DAY
    path.mkdir(parents=True)
    (path / "part.csv").write_text(f"{header}\nA,Alpha,S,I,L,2001-01-01,1,1950\n,Nobody,S,I,L,2001-01-01,1,1950\nB,Beta\n")
    done = ingest_constituents(tables, str(tmp_path / "feeds"), DAY)
    assert done.written and done.rejects == {"empty": 1, "partial": 1}
    assert {r["ticker"] for r in tables.read("raw/tickers_lookup").collect()} == {"A", "B"}


def test_landed_files_are_read_once(warehouse, spark):
    """Rows and rejects come from one parse: the stored reading is what both plans scan."""
    tables, root = warehouse
    land(root, "prices", [PRICES[0]])
    read = feeds.parsed(feeds.read_lines(spark, f"{root}/prices/{DAY}"), schemas.PRICE_FEED).persist()
    try:
        for df in (feeds.payloads(read), feeds.rejected(read)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan
    finally:
        read.unpersist()
