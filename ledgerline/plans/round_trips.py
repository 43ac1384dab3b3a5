"""Queries of sources and streams: data derived from the driver tables is landed in the shared folder and read back."""

from __future__ import annotations

import contextlib
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events
from ..sources import landed
from ..streaming import events as stream
from ..streaming import keyed
from . import adapters
from .queries import ORACLES, QUERIES


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset, only a local session gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """What is run inside leaves no shuffle files behind: its result is read back from the shared folder, so nothing needs them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, for what is read more than once."""
    path = _folder(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _register(name: str, tables: str, sql: str | None):
    if name in QUERIES:
        raise ValueError(f"two queries are named {name}")

    def wrap(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = adapters.with_tables(tables.split(), " " + sql)
        return build

    return wrap


@_register("s01_read_index", "filings", "SELECT CAST(CAST(cik AS BIGINT) AS STRING) AS cik, company, form, filing_date, accession AS path FROM filings")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "index")
    landed.write_index(adapters.load(spark, sf_dir, "filings").withColumnRenamed("accession", "path"), path)
    return landed.read_index(spark, path)[0].drop("index_path")


@_register("s15_price_charts", "prices", "SELECT security AS symbol, date, close, adjusted_close FROM prices")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "charts")
    day = F.unix_timestamp(F.col("date").cast("timestamp")).alias("t")
    rows = adapters.load(spark, sf_dir, "prices").groupBy(F.col("security").alias("symbol")).agg(F.array_sort(F.collect_list(F.struct(day, F.coalesce("open", "close").alias("o"), "close", "adjusted_close"))).alias("c"))
    arrays = {"timestamp": "t", "open": "o", "close": "close", "adjclose": "adjusted_close"}
    rows.select("symbol", F.lit("USD").alias("currency"), *[F.col(f"c.{f}").alias(n) for n, f in arrays.items()]).write.json(path)
    return landed.read_price_charts(spark, path)[0].drop("open")


@_register("s17_price_batches", "prices", "SELECT security, date, close FROM prices")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "batches")
    rows = adapters.load(spark, sf_dir, "prices").select(F.lit("price").alias("record_type"), "security", F.col("security").alias("symbol"), "date", F.lit("USD").alias("currency"), "open", "close", "adjusted_close")
    landed.write_price_batches(rows, path)
    return landed.read_price_batches(spark, path)[0].select("security", "date", "close")


def _land_xml(elements: DataFrame, root: str, path: str, per_file: int = 1000) -> None:
    """One document per file, about per_file elements dealt by hash to each, so that files grow in number only."""
    files = elements.count() // per_file + 1
    dealt = elements.groupBy(F.pmod(F.xxhash64("value"), F.lit(files)).alias("n")).agg(F.array_join(F.collect_list("value"), "").alias("value"))
    dealt.select(F.concat(F.lit(f"<{root}>"), "value", F.lit(f"</{root}>")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@_register("s14_read_fx", "fx", "SELECT currency, denominator, time, CAST(round(value) AS BIGINT) AS whole FROM fx")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "fx")
    obs = F.concat(F.lit("<Obs><ObsDimension value='"), "time", F.lit("'/><ObsValue value='"), F.col("value").cast("string"), F.lit("'/></Obs>"))
    key = F.concat(F.lit("<Series><SeriesKey><Value id='CURRENCY' value='"), "currency", F.lit("'/><Value id='CURRENCY_DENOM' value='"), "denominator", F.lit("'/></SeriesKey>"))
    rows = adapters.load(spark, sf_dir, "fx").groupBy("currency", "denominator").agg(F.array_join(F.collect_list(obs), "").alias("o"))
    _land_xml(rows.select(F.concat(key, "o", F.lit("</Series>")).alias("value")), "DataSet", path)
    return landed.read_fx(spark, path).select("currency", "denominator", "time", F.round("value").cast("long").alias("whole"))


@_register("s13_atom_feed", "filings", "SELECT accession, cik, form, company, 'edgar/data/1/' || accession || '.txt' AS path FROM filings")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "feed")
    f = adapters.load(spark, sf_dir, "filings")
    entry = F.concat(
        F.lit("<entry><title>"), "form", F.lit(" - "), "company", F.lit(" ("), "cik", F.lit(") (Filer)</title><link rel='alternate' href='https://www.sec.gov/Archives/edgar/data/1/"), "accession",
        F.lit("-index.htm'/><summary type='html'>CIK: "), "cik", F.lit("</summary><updated>2024-01-01</updated><category term='"), "form", F.lit("'/></entry>"),
    )
    _land_xml(f.select(entry.alias("value")), "feed", path)
    return landed.read_atom_feed(spark, path)[0].select("accession", "cik", "form", "company", "path")


@_register("s11_shred_13f", "positions", "SELECT accession, cusip, count(*) AS n FROM positions GROUP BY ALL")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit("<infoTable><nameOfIssuer>"), "title", F.lit("</nameOfIssuer><titleOfClass>"), "security_class", F.lit("</titleOfClass><cusip>"), "cusip", F.lit("</cusip><value>1,000</value></infoTable>"))
    docs = adapters.load(spark, sf_dir, "positions").groupBy("accession").agg(F.concat(F.lit("<informationTable>"), F.array_join(F.collect_list(row), ""), F.lit("</informationTable>")).alias("xml"))
    return landed.shred_13f(docs)[0].groupBy("accession", "cusip").agg(F.count("*").alias("n"))


def _land_events(spark: SparkSession, sf_dir: str) -> str:
    """Discovery events as JSON lines, every tenth one twice and every hundredth one broken."""
    path = _folder(spark, "discovery")
    e = adapters.load(spark, sf_dir, "events_feed").withColumns({"event_id": F.col("sequence").cast("string"), "observed_at": F.date_format(F.timestamp_seconds(1704067200 + F.col("sequence") % 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "filing_date": F.col("filing_date").cast("string")})
    e = e.withColumn("copy", F.explode(F.when(F.col("sequence") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    body = F.to_json(F.struct("event_id", "accession", "cik", "company", "form", "filing_date", "observed_at"))
    e.select(F.when(F.col("sequence") % 100 == 7, "{broken").otherwise(body).alias("value")).write.text(path)
    return path


def _drained(spark: SparkSession, rows: DataFrame) -> DataFrame:
    out = _folder(spark, "stream")
    stream.drain(rows, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


@_register("st01_dedupe", "events_feed", "SELECT CAST(sequence AS STRING) AS event_id, accession FROM events_feed WHERE sequence % 100 <> 7")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _dead = stream.split_poison(stream.read_events(spark, _land_events(spark, sf_dir)))
    return _drained(spark, stream.dedupe(events)).select("event_id", "accession")


@_register("st02_accession_once", "events_feed", "SELECT DISTINCT accession FROM events_feed WHERE sequence % 100 <> 7")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _dead = stream.split_poison(stream.read_events(spark, _land_events(spark, sf_dir), per_trigger=1))
    out = _folder(spark, "accessions")
    return stream.accession_once(events, f"{out}/rows", f"{out}/checkpoint")[1].read().select("accession")


@_register("st03_select", "events_feed members", "SELECT CAST(sequence AS STRING) AS event_id FROM events_feed e JOIN members m ON m.cik = lpad(e.cik, 10, '0'), (SELECT unnest([1, 2]) AS copy) WHERE sequence % 100 <> 7 AND (copy = 1 OR sequence % 10 = 0) AND form IN ('10-K', '10-Q') AND year(filing_date) >= 2016")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _dead = stream.split_poison(stream.read_events(spark, _land_events(spark, sf_dir)))
    chosen = stream.select(events, adapters.load(spark, sf_dir, "members"), ["10-K", "10-Q"], "building")
    return _drained(spark, chosen).where("selected").select("event_id")


@_register("st04_poison", "events_feed", "SELECT count(*) AS dead FROM events_feed WHERE sequence % 100 = 7")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events, dead = stream.split_poison(stream.read_events(spark, _land_events(spark, sf_dir)))
    return _drained(spark, dead).agg(F.count("*").alias("dead"))


@_register("st10_ownership_branch", "events_feed", "SELECT CAST(sequence AS STRING) AS event_id, 'insider' AS family FROM events_feed, (SELECT unnest([1, 2]) AS copy) WHERE form = '4' AND sequence % 100 <> 7 AND (copy = 1 OR sequence % 10 = 0)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _dead = stream.split_poison(stream.read_events(spark, _land_events(spark, sf_dir)))
    return _drained(spark, stream.ownership_branch(events)).select("event_id", "family")


@_register(
    "st06_retry", "failure_log",
    """SELECT accession, attempts, CASE WHEN ok THEN 'resolved' WHEN attempts >= 5 THEN 'exhausted' ELSE 'retry' END AS status, CASE WHEN NOT ok AND attempts < 5 THEN sequence + 60 END AS next_at FROM (
SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY accession, g ORDER BY sequence) AS attempts FROM (
SELECT accession, sequence, outcome = 'ok' AS ok, count(*) FILTER (outcome = 'ok') OVER (PARTITION BY accession ORDER BY sequence) AS g FROM failure_log WHERE outcome <> 'skipped'))""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "outcomes")
    log = adapters.load(spark, sf_dir, "failure_log").where("outcome != 'skipped'")
    log.select("accession", (F.col("outcome") == "ok").alias("ok"), F.col("sequence").alias("at")).repartition("accession").write.parquet(f"{out}/landed")
    rows = spark.readStream.schema("accession string, ok boolean, at long").parquet(f"{out}/landed")
    stream.drain(stream.retry(rows), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


#: Events in a landed file at least.
PER_FILE = 50_000


def _news_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Discovery events landed by thirds of their sequence, one after the other, and read one third a batch.

    Each third has the same number of files, which grows with the events, so that a batch is written and read in many tasks;
    a small third has all be one file.
    """
    out = _folder(spark, "news")
    e = adapters.load(spark, sf_dir, "events_feed").select("accession", "form", "company", "filing_date", "sequence", "selected")
    last = e.agg(F.max("sequence")).first()[0] or 0
    third = F.least(F.floor(F.col("sequence") * 3 / (last + 1)), F.lit(2))
    sizes = [r["count"] for r in e.groupBy(third.alias("third")).count().where("third is not null").collect()]  # three rows
    files = max(1, min(sizes) // PER_FILE) if len(sizes) == 3 else 1
    for n in range(3):
        part = e.where(third == n)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(f"{out}/landed")
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", files).parquet(f"{out}/landed"), out


_NEWS_SQL = "SELECT accession, arg_min(form, sequence) AS form, arg_min(company, sequence) AS company, arg_min(filing_date, sequence) AS filing_date, max(sequence) AS sequence, arg_max(selected, sequence) AS selected FROM events_feed GROUP BY accession"


@_register("st05_project_news", "events_feed", _NEWS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, out = _news_stream(spark, sf_dir)
    return stream.project_news(rows, f"{out}/table", f"{out}/checkpoint")[1].read()


@_register("st09_replay", "events_feed", "SELECT *, 2 AS tables FROM (" + _NEWS_SQL + ")")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projection, replayed under a new checkpoint over its own table and into an empty one: how many give each row."""
    rows, out = _news_stream(spark, sf_dir)
    stream.project_news(rows, f"{out}/first", f"{out}/checkpoint")
    tables = [stream.project_news(rows, f"{out}/{name}", f"{out}/checkpoint-{name}")[1].read() for name in ("first", "empty")]
    return tables[0].unionByName(tables[1]).groupBy(*tables[0].columns).agg(F.count("*").alias("tables"))


@_register("s23_upsert_table", "positions", "SELECT accession, row_number, CASE WHEN accession LIKE '%7' THEN 'NEW' ELSE cusip END AS cusip FROM positions UNION ALL SELECT accession, -1, 'ADDED' FROM (SELECT DISTINCT accession FROM positions WHERE accession LIKE '%3')")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of positions, some replaced by a second batch and some added by a third."""
    p = adapters.load(spark, sf_dir, "positions").select("accession", "row_number", "cusip")
    table = keyed.KeyedTable(spark, _folder(spark, "table"), p.schema, ["accession", "row_number"], buckets=16)
    table.upsert(p)
    table.upsert(p.where("accession LIKE '%7'").withColumn("cusip", F.lit("NEW")))
    table.upsert(p.where("accession LIKE '%3'").select("accession", F.lit(-1).cast("long").alias("row_number"), F.lit("ADDED").alias("cusip")).distinct())
    return table.read()


@_register("st07_counters", "events_feed", "SELECT 'news' AS stage, count(*) AS scanned, count(*) FILTER (selected) AS selected, count(*) FILTER (NOT selected) AS skipped FROM events_feed")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that a listener gathers while the backlog is drained in three batches."""
    rows, out = _news_stream(spark, sf_dir)
    counters = stream.StageCounters()
    spark.streams.addListener(counters)
    try:
        counters.wait(stream.drain(stream.observe(rows, "news"), f"{out}/rows", f"{out}/checkpoint"))
    finally:
        spark.streams.removeListener(counters)
    return spark.createDataFrame([(stage, n["scanned"], n["selected"], n["skipped"]) for stage, n in counters.totals.items()], "stage string, scanned long, selected long, skipped long")


@_register(
    "st06_timer", "failure_log",
    """, o AS (SELECT accession, sequence, outcome = 'ok' AS ok, count(*) FILTER (outcome = 'ok') OVER (PARTITION BY accession ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM failure_log WHERE outcome <> 'skipped'),
a AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY accession, coalesce(g, 0) ORDER BY sequence) AS attempts, row_number() OVER (PARTITION BY accession ORDER BY sequence DESC) AS back FROM o)
SELECT accession, attempts, 'exhausted' AS status FROM a WHERE NOT ok AND attempts >= 5 UNION ALL SELECT accession, attempts, 'resolved' FROM a WHERE ok AND attempts > 0
UNION ALL SELECT accession, attempts, 'retry' FROM a WHERE NOT ok AND attempts < 5 AND back = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as one batch; the query runs on until every open failure's timer has gone off."""
    out = _folder(spark, "timed")
    log = adapters.load(spark, sf_dir, "failure_log").where("outcome != 'skipped'").select("accession", (F.col("outcome") == "ok").alias("ok"), F.col("sequence").alias("at"))
    log.write.parquet(f"{out}/landed")
    last = log.groupBy("accession").agg(F.max_by("ok", "at").alias("ok"), F.max(F.when(F.col("ok"), F.col("at"))).alias("good")).where("NOT ok")
    open_ = log.join(last.select("accession", "good"), "accession").where(~F.col("ok") & (F.col("good").isNull() | (F.col("at") > F.col("good")))).groupBy("accession").count().where("count < 5").count()
    rows = spark.readStream.schema(log.schema).parquet(f"{out}/landed")
    with stream.timed_state(spark):
        query = stream.retry_after(rows, delay_seconds=1).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(processingTime="1 second").start()
    try:
        until = time.time() + 180
        while not query.recentProgress or spark.read.schema("accession string, attempts long, status string").parquet(f"{out}/rows").where("status = 'retry'").count() < open_:
            if query.exception() or time.time() > until:
                raise TimeoutError(f"timers did not go off: {query.exception()}")
            time.sleep(1)
    finally:
        query.stop()
    return spark.read.parquet(f"{out}/rows")


@_register("st12_feed_dead_letters", "filings", "SELECT 'no link ' || accession AS company FROM filings WHERE form = '8-K'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed as a stream in which the entries of one form have no link."""
    path = _folder(spark, "feed")
    f = adapters.load(spark, sf_dir, "filings")
    link = F.when(F.col("form") == "8-K", "").otherwise(F.concat(F.lit("<link rel='alternate' href='https://h/Archives/edgar/data/1/"), "accession", F.lit("-index.htm'/>")))
    _land_xml(f.select(F.concat(F.lit("<entry><title>no link "), "accession", F.lit("</title>"), link, F.lit("<updated>2024-01-01</updated></entry>")).alias("value")), "feed", path)
    _entries, dead = landed.stream_atom_feed(spark, path)
    return _drained(spark, dead).select("company")


@_register("s02_stitch", "filings", "SELECT accession AS path, CAST(year(filing_date) AS INT) AS year, CAST(quarter(filing_date) AS INT) AS quarter FROM filings WHERE year(filing_date) BETWEEN 1995 AND 1997")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly files are landed under their names, chosen by a range of years and read as one index."""
    path = _folder(spark, "quarters")
    f = adapters.load(spark, sf_dir, "filings").withColumnsRenamed({"accession": "path"}).withColumn("name", F.format_string("%d-QTR%d.tsv", F.year("filing_date"), F.quarter("filing_date")))
    f.select("name", F.concat_ws("|", "cik", "company", "form", F.col("filing_date").cast("string"), "path").alias("value")).repartition("name").write.partitionBy("name").text(path)
    names = [r[0] for r in f.select("name").distinct().collect()]  # four a year
    chosen = landed.select_index_files(names, from_year=1995, to_year=1997)
    return landed.stitch(spark, [f"{path}/name={n}" for n in chosen])[0].select("path", "year", "quarter")


@_register("s03_archive_calendar", "filings", "SELECT y AS year, q AS quarter, y || '-QTR' || q || '.tsv' AS file, 'https://www.sec.gov/Archives/edgar/full-index/' || y || '/QTR' || q || '/master.zip' AS url FROM (SELECT unnest(range(1993, (SELECT max(year(filing_date)) FROM filings) + 1)) AS y), (SELECT unnest([1, 2, 3, 4]) AS q) WHERE y < (SELECT max(year(filing_date)) FROM filings) OR q <= 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = adapters.load(spark, sf_dir, "filings").agg(F.max(F.year("filing_date"))).first()[0] or events.EARLIEST_YEAR
    return events.archive_calendar(1993, last, 2, spark).select("year", F.col("quarter"), "file", "url")
