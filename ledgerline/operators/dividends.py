"""Dividends from facts and announcement texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn

#: Concepts and kinds, and text patterns (fixed values).
KINDS = {"CommonStockDividendsPerShareDeclared": "per_share_declared", "DividendsCommonStockCash": "cash_paid", "PaymentsOfDividendsCommonStock": "cash_paid"}
_DATE = r"((?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}, [0-9]{4})"
AMOUNT = r"(?i)(?:dividend|dividends)[^$]{0,180}\$([0-9]+(?:\.[0-9]+)?)\s*(?:per|a)\s+share"
EX_DATE = r"(?i)ex[- ]dividend(?: date)?\s*(?:is|:)?\s*" + _DATE
RECORD_DATE = r"(?i)record date\s*(?:is|:)?\s*" + _DATE
PAYABLE_DATE = r"(?i)payable(?: date)?\s*(?:is|on|:)?\s*" + _DATE


def observations(facts: DataFrame, contexts: DataFrame, filings: DataFrame) -> DataFrame:
    """Dividend facts, once each, with kind, form and filing date, and the period of their context: its instant, else its end.

    Contexts with dimensions count too; a fact whose context is missing keeps empty dates.
    """
    kind = F.lit(None).cast("string")
    for concept, name in KINDS.items():
        kind = F.when(F.col("local") == concept, name).otherwise(kind)
    spans = contexts.select("accession", "instance", F.col("id").alias("context_ref"), "instant", "start_date", "end_date")
    rows = facts.withColumn("kind", kind).where("kind is not null").join(spans, ["accession", "instance", "context_ref"], "left")
    rows = rows.join(filings.select("accession", "cik", "form", "filing_date"), "accession")

    def day(*columns: str) -> Column:
        return F.coalesce(*[F.col(c).cast("string") for c in columns], F.lit(""))

    return rows.select(
        "accession", "cik", "form", "filing_date", "kind", day("instant", "end_date").alias("period"), "context_ref",
        day("start_date").alias("context_start"), day("end_date", "instant").alias("context_end"), "value", "unit_ref",
    ).distinct()


def announcements(texts: DataFrame, filings: DataFrame) -> DataFrame:
    """First amount of every document with its labelled dates; the filing date stands in for the declaration."""
    rows = texts.join(filings.select("accession", "cik", "filing_date"), "accession").withColumn("clean", fn.clean_text(F.col("text")))
    for name, pattern in (("amount", AMOUNT), ("ex_date", EX_DATE), ("record_date", RECORD_DATE), ("payable_date", PAYABLE_DATE)):
        rows = rows.withColumn(name, F.regexp_extract("clean", pattern, 1))
    declared = F.date_format("filing_date", "yyyy-MM-dd")
    event = fn.dividend_event_id(F.col("accession"), declared, F.col("ex_date"), F.col("record_date"), F.col("payable_date"), F.col("amount"))
    out = rows.where("amount != ''").select("accession", "cik", event.alias("event_id"), declared.alias("declared"), "ex_date", "record_date", "payable_date", "amount", F.lit("USD").alias("currency"), F.lit("announced").alias("status"))
    return out


def merge(current: DataFrame, fresh: DataFrame, accession: str) -> DataFrame:
    """Register after one filing is replaced: its rows go, fresh rows join, sources of one event are gathered."""
    both = current.where(F.col("accession") != accession).unionByName(fresh)
    rest = [c for c in current.columns if c not in ("event_id", "accession")]
    return both.groupBy("event_id").agg(*[F.min_by(c, "accession").alias(c) for c in rest], F.array_join(F.array_sort(F.collect_set("accession")), ",").alias("sources"))


def year_table(events: DataFrame) -> DataFrame:
    """Per company and year the amounts, joined in order."""
    return events.withColumn("year", fn.dividend_year(F.col("declared"))).groupBy("cik", "year").agg(F.array_join(F.array_sort(F.collect_list("amount")), ";").alias("amounts"))


def dividend_table(events: DataFrame, seen: DataFrame) -> DataFrame:
    """cik, label, year, values: announced amounts with their payable date, in order of declaration, and observed values, in
    order of filing, as they are shown. Lines without a year or a value are left out.

    Values are gathered as they are and shown in the groups, as showing one reads it many times.
    """
    told = events.select("cik", F.lit("Declared cash dividends").alias("label"), "declared", F.col("event_id").alias("source"), F.col("amount").alias("value"), F.concat("currency", F.lit("/share")).alias("unit"), F.coalesce("payable_date", F.lit("")).alias("payable"), F.lit("/share").alias("per"))
    per_share = F.col("kind") == "per_share_declared"
    label = F.when(per_share, "Declared dividends per share").when(F.col("kind") == "cash_paid", "Common-stock cash dividends paid").otherwise("Dividend observation")
    unit = F.when(per_share, "USD/share").otherwise("USD")
    found = seen.select("cik", label.alias("label"), fn.dividend_year(F.col("period")).alias("year"), F.col("filing_date").cast("string").alias("first"), F.col("accession").alias("source"), "value", unit.alias("unit"), F.lit("").alias("payable"), F.lit("").alias("per"))
    rows = told.select("cik", "label", fn.dividend_year(F.col("declared")).alias("year"), F.col("declared").alias("first"), "source", "value", "unit", "payable", "per").unionByName(found)
    of = rows.where("year is not null and value != ''").groupBy("cik", "label", "year").agg(F.collect_list(F.struct("first", "source", "value", "unit", "payable", "per")).alias("of"))

    def shown(x: Column) -> Column:
        payable = F.when(x["payable"] != "", F.concat(F.lit(" · payable "), x["payable"])).otherwise("")
        text = F.concat(fn.format_fact_value(x["value"], F.lit(False), x["unit"]), x["per"], payable)
        return F.struct(x["first"].alias("first"), x["source"].alias("source"), text.alias("text"))

    return of.select("cik", "label", "year", F.transform(F.array_sort(F.transform("of", shown)), lambda x: x["text"]).alias("values"))
