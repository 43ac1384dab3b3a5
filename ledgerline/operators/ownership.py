"""Institutional, beneficial and insider ownership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; Spark keeps only leading rows per task before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def _processed(filings: DataFrame, *columns: str) -> DataFrame:
    return filings.where("status = 'processed'").select("accession", *columns)


def baseline(positions: DataFrame, filings: DataFrame) -> DataFrame:
    """Per manager and period the last processed filing that isn't an addition of holdings."""
    pairs = positions.select("manager", "period", "accession").distinct()
    full = _processed(filings, "filing_date", "amendment_type").where("amendment_type != 'NEW HOLDINGS'").drop("amendment_type")
    best = pairs.join(full, "accession").groupBy("manager", "period").agg(F.max(F.struct("filing_date", "accession")).alias("b"))
    return best.select("manager", "period", F.col("b.filing_date").alias("filing_date"), F.col("b.accession").alias("accession"))


def effective_candidates(positions: DataFrame, filings: DataFrame) -> DataFrame:
    """Positions of the baseline filing and of additions after it (or without one)."""
    f = _processed(filings, "filing_date", "amendment_type")
    b = baseline(positions, filings).select("manager", "period", F.col("filing_date").alias("__date"), F.col("accession").alias("__base"))
    rows = positions.join(f, "accession").join(b, ["manager", "period"], "left")
    after = F.struct("filing_date", "accession") > F.struct(F.col("__date").alias("filing_date"), F.col("__base").alias("accession"))
    added = (F.col("amendment_type") == "NEW HOLDINGS") & (F.col("__base").isNull() | after)
    return rows.where((F.col("accession") == F.col("__base")) | added).drop("__date", "__base")


def effective_positions(positions: DataFrame, filings: DataFrame) -> DataFrame:
    keys = ["manager", "period", "cusip", "security_class", "put_call", "other_managers"]
    return _latest(effective_candidates(positions, filings), keys, [F.desc("accession"), F.desc("row_number")])


def latest_beneficial(reports: DataFrame, filings: DataFrame) -> DataFrame:
    rows = reports.join(_processed(filings, "form", "filing_date"), "accession")
    return _latest(rows, ["issuer", "owner", "security"], [F.desc("event_date"), F.desc("filing_date"), F.desc("accession"), F.desc("row_number")])


def reported_insider(holdings: DataFrame, transactions: DataFrame, filings: DataFrame) -> DataFrame:
    """Holdings and what transactions leave behind, under one date."""
    done = _processed(filings)
    keep = ["accession", "row_number", "issuer", "owner", "security", "is_derivative", "direct_or_indirect", "nature"]
    held = holdings.join(done, "accession", "left_semi").select(*keep, F.col("report_date").alias("as_of"), "amount")
    dated = F.coalesce(F.nullif("transaction_date", F.lit("")), "report_date")
    traded = transactions.join(done, "accession", "left_semi").where("shares_after != ''").select(*keep, dated.alias("as_of"), F.col("shares_after").alias("amount"))
    return held.unionByName(traded)


def latest_insider(holdings: DataFrame, transactions: DataFrame, filings: DataFrame) -> DataFrame:
    rows = reported_insider(holdings, transactions, filings).join(_processed(filings, "filing_date"), "accession")
    keys = ["issuer", "owner", "security", "is_derivative", "direct_or_indirect", "nature"]
    return _latest(rows, keys, [F.desc("as_of"), F.desc("filing_date"), F.desc("accession"), F.desc("row_number"), F.desc("amount")])


def company_rows(rows: DataFrame, parties: DataFrame, issuer: str, *, limit: int = 250) -> DataFrame:
    """One issuer's rows with the owner's name, largest list first."""
    return rows.where(F.col("issuer") == issuer).join(parties.select(F.col("party").alias("owner"), "name"), "owner").orderBy("owner", "security", "accession", "row_number").limit(limit)


def outcome_counts(filings: DataFrame, *, from_date: str, through: str) -> DataFrame:
    return filings.where(F.col("filing_date").between(F.lit(from_date).cast("date"), F.lit(through).cast("date"))).groupBy("family", "status").agg(F.count("*").alias("filings"))


def coverage_record(counts: DataFrame, families: list[str]) -> DataFrame:
    """Per family: expected, processed, failed, unsupported and status; families without rows too."""
    dim = counts.sparkSession.createDataFrame([(f,) for f in families], "family string")

    def of(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("filings"))), F.lit(0))

    out = dim.join(counts, "family", "left").groupBy("family").agg(of("processed").alias("processed"), of("failed").alias("failed"), of("unsupported").alias("unsupported"))
    return out.withColumn("expected", F.col("processed") + F.col("failed") + F.col("unsupported")).withColumn("status", F.when(F.col("failed") > 0, "partial").otherwise("complete"))


def latest_coverage(coverage: DataFrame, version: int) -> DataFrame:
    return _latest(coverage.where(F.col("version") == version), ["family"], [F.desc("completed"), F.asc("from_date"), F.asc("through")])


def securities_13f(positions: DataFrame) -> DataFrame:
    """Title and class of a CUSIP's first row in its filing."""
    first = F.min(F.struct("row_number", "title", "security_class"))
    return positions.groupBy("accession", "cusip").agg(first.alias("f")).select("accession", "cusip", "f.title", "f.security_class")


def footnote_refs(links: DataFrame) -> DataFrame:
    return links.groupBy("accession", "row_number").agg(F.array_join(F.array_sort(F.collect_set("footnote")), ",").alias("refs"))


def rows_by_owner(rows: DataFrame, owners: DataFrame) -> DataFrame:
    return rows.join(owners, "accession")


def ordinals(parties: DataFrame) -> DataFrame:
    """Parties of a filing numbered in filing order from an array column."""
    return parties.select("accession", F.posexplode("parties").alias("ordinal", "party"))


def upsert_securities(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Securities by id after fresh ones: a null issuer or an empty text keeps what was there. fresh: unique by security."""
    both = current.join(fresh.select("security", *[F.col(c).alias(f"__{c}") for c in ("issuer", "title", "security_class", "kind")]), "security", "full")
    texts = {c: F.coalesce(F.nullif(f"__{c}", F.lit("")), F.col(c), F.lit("")) for c in ("title", "security_class", "kind")}
    return both.select("security", F.coalesce("__issuer", "issuer").alias("issuer"), *[x.alias(c) for c, x in texts.items()])
