"""Filing index, discovery events, news and failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .predicates import small


def new_accessions(events: DataFrame, seen: DataFrame) -> DataFrame:
    """First event of every accession not seen before."""
    first = events.groupBy("accession").agg(F.min(F.struct("sequence", *[c for c in events.columns if c not in ("accession", "sequence")])).alias("e"))
    return first.select("accession", "e.*").join(seen.select("accession"), "accession", "left_anti")


def first_seen(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("__n", rank).where("__n = 1").drop("__n")


def form_histogram(rows: DataFrame) -> DataFrame:
    return rows.groupBy("form").agg(F.count("*").alias("filings")).orderBy(F.desc("filings"), "form")


def distinct_forms(index: DataFrame) -> DataFrame:
    return index.select("form").distinct().orderBy("form")


def project_news(current: DataFrame, events: DataFrame) -> DataFrame:
    """News by accession: descriptive columns of the first event, sequence and selection of the last."""
    both = current.unionByName(events)
    kept = [c for c in current.columns if c not in ("accession", "sequence", "selected")]
    out = both.groupBy("accession").agg(*[F.min_by(c, "sequence").alias(c) for c in kept], F.max("sequence").alias("sequence"), F.max_by("selected", "sequence").alias("selected"))
    return out.select(*current.columns)


def news_overview(news: DataFrame) -> DataFrame:
    return news.agg(F.count("*").alias("items"), F.count_if("selected").alias("selected"), F.count_if(~F.col("selected")).alias("observed"), F.max("sequence").alias("last_sequence"), F.max("filing_date").alias("last_date"))


def latest_decisions(news: DataFrame, *, n: int = 5) -> DataFrame:
    return news.orderBy(F.desc("sequence")).limit(n)


def ingestion_stats(accessions: DataFrame) -> DataFrame:
    return accessions.agg(F.count_distinct("accession").alias("accessions"), F.count_if(F.col("source") == "ATOM").alias("atom"), F.count_if(F.col("source") == "BATCH").alias("batch"))


def failures(log: DataFrame) -> DataFrame:
    """Attempts since the last resolution per stage and accession; log: sequence, stage, accession, outcome."""
    w = Window.partitionBy("stage", "accession")
    rows = log.withColumn("__ok", F.max(F.when(F.col("outcome") == "ok", F.col("sequence"))).over(w))
    open_rows = F.count_if((F.col("outcome") == "failed") & (F.col("sequence") > F.coalesce("__ok", F.lit(-1))))
    out = rows.groupBy("stage", "accession").agg(open_rows.alias("attempts"), F.max_by("outcome", "sequence").alias("last"), F.max("sequence").alias("sequence"))
    return out.withColumn("resolved", F.col("last") == "ok").drop("last")


def failure_list(rows: DataFrame, *, stage: str = "", limit: int = 50) -> DataFrame:
    out = rows.where(~F.col("resolved") & (F.col("attempts") > 0))
    out = out.where(F.col("stage") == stage) if stage else out
    return out.orderBy(F.desc("sequence"), "accession").limit(min(limit, 500))


def failure_classes(results: DataFrame, *, classes: int = 10) -> DataFrame:
    """Failures by bounded message text; the classes that appear first by name, the rest as other."""
    groups = results.groupBy(F.left("message", F.lit(512)).alias("message")).agg(F.count("*").alias("n"), F.min("sequence").alias("first"))
    kept = groups.orderBy("first").limit(classes).select("message", F.lit(True).alias("kept"))  # a handful of rows
    named = groups.join(F.broadcast(kept), "message", "left").withColumn("class", F.when(F.col("kept"), F.col("message")).otherwise("other"))
    return named.groupBy("class").agg(F.sum("n").alias("failures"))


#: First year of the archive.
EARLIEST_YEAR = 1993


def archive_calendar(since_year: int, now_year: int, now_quarter: int, spark, *, base: str = "https://www.sec.gov/Archives") -> DataFrame:
    """Quarters from since_year to now, newest first, with file name and address."""
    if since_year < EARLIEST_YEAR:
        raise ValueError(f"the archive begins in {EARLIEST_YEAR}")
    years = spark.range(since_year, max(since_year, now_year + 1)).withColumnRenamed("id", "year").withColumn("quarter", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    years = years.where((F.col("year") < now_year) | (F.col("quarter") <= now_quarter))
    url = F.format_string(f"{base.rstrip('/')}/edgar/full-index/%d/QTR%d/master.zip", "year", "quarter")
    return years.withColumns({"file": F.format_string("%d-QTR%d.tsv", "year", "quarter"), "url": url}).orderBy(F.desc("year"), F.desc("quarter"))


def missing_quarters(calendar: DataFrame, files: DataFrame) -> DataFrame:
    return calendar.join(files.select("year", "quarter").distinct(), ["year", "quarter"], "left_anti").select("year", "quarter")


def filing_status(index: DataFrame, raw: DataFrame, views: DataFrame) -> DataFrame:
    r = raw.select("accession", F.lit(True).alias("__raw")).distinct()
    v = views.select("accession", F.lit(True).alias("__view")).distinct()
    rows = index.join(r, "accession", "left").join(v, "accession", "left")
    return rows.withColumn("status", F.when(F.col("__view"), "parsed").when(F.col("__raw"), "downloaded").otherwise("missing")).drop("__raw", "__view")


def coverage_summary(status: DataFrame, missing: DataFrame) -> DataFrame:
    one = status.agg(
        F.count("*").alias("expected"), F.count_if(F.col("status") != "missing").alias("downloaded"), F.count_if(F.col("status") == "parsed").alias("parsed"),
        F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status") == "downloaded").alias("unparsed"),
    )
    return one.crossJoin(missing.agg(F.count("*").alias("with_missing_metrics")))


def acquisition(status: DataFrame) -> DataFrame:
    """Missing filings grouped to one request per company, form and year."""
    gone = status.where("status = 'missing'").withColumn("year", F.year("filing_date"))
    return gone.groupBy("cik", "form", "year").agg(F.count("*").alias("filings"), F.array_join(F.array_sort(F.collect_set("accession")), ",").alias("accessions"))


def gate(totals: DataFrame) -> DataFrame:
    """RED, REVIEW or GREEN of one row with missing, unparsed, failed_checks and unexplained."""
    red = (F.col("missing") > 0) | (F.col("unparsed") > 0) | (F.col("failed_checks") > 0)
    return totals.withColumn("gate", F.when(red, "RED").when(F.col("unexplained") > 0, "REVIEW").otherwise("GREEN"))


def split_exceptions(gaps: DataFrame, exceptions: DataFrame) -> tuple[DataFrame, DataFrame]:
    keys = ["cik", "accession", "metric"]
    accepted = exceptions.select(*keys)
    return gaps.join(accepted, keys, "left_semi"), gaps.join(accepted, keys, "left_anti")


def filing_ticker(filings: DataFrame, members: DataFrame) -> DataFrame:
    return filings.join(small(members.groupBy("cik").agg(F.min("ticker").alias("ticker"))), "cik", "left")


def outcomes(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Terminal outcomes by accession, the fresh ones in place of stored ones, with bounded diagnostics."""
    bounded = fresh.withColumn("diagnostic", F.left("diagnostic", F.lit(4000)))
    return current.join(bounded.select("accession"), "accession", "left_anti").unionByName(bounded)
