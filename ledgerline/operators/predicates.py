"""Filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn

PARSED_FORMS = ["10-K", "10-Q", "8-K"]
#: Ownership forms by family (fixed values); the first of a pair of lists has a parser.
FAMILIES = {
    "insider": (["3", "4", "5", "3/A", "4/A", "5/A"], []),
    "institutional": (["13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A"], []),
    "beneficial": (["SCHEDULE 13D", "SCHEDULE 13D/A", "SCHEDULE 13G", "SCHEDULE 13G/A"], ["SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A"]),
}


#: Rows up to which a table that is small by nature is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint where a count shows that it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def index_filter(index: DataFrame, *, cik: str = "", ciks=(), year: int = 0, from_year: int = 0, to_year: int = 0, forms=()) -> DataFrame:
    """Index rows that pass every filter given; padding of CIKs is ignored, an empty filter lets all pass."""
    wanted = [str(c).strip().lstrip("0") or "0" for c in ([cik] if cik else []) + list(ciks)]
    tests = [F.lit(True)]
    if wanted:
        tests.append(fn.bare_cik(F.col("cik")).isin(wanted))
    filed = F.year("filing_date")
    if year:
        tests.append(filed == year)
    tests.append(fn.in_year_range(filed, from_year, to_year))
    if forms:
        tests.append(F.col("form").isin(list(forms)))
    return index.where(reduce(lambda a, b: a & b, tests))


def supported_form(form: Column) -> Column:
    return fn.normalize_form(form).isin(PARSED_FORMS)


def ownership_family(form: Column) -> Column:
    """struct(family, supported, amendment); family is null for other forms."""
    f = fn.normalize_form(form)
    family, supported = F.lit(None).cast("string"), F.lit(False)
    for name, (parsed, known) in FAMILIES.items():
        family = F.when(f.isin(parsed + known), name).otherwise(family)
        supported = supported | f.isin(parsed)
    return F.struct(family.alias("family"), supported.alias("supported"), f.endswith("/A").alias("amendment"))


def selection(events: DataFrame, members: DataFrame, forms, set_name: str) -> DataFrame:
    """Whether each event is selected, and the first reason against it."""
    cik = fn.canonical_cik(F.col("cik"))
    inside = members.select(F.col("cik").alias("__member")).distinct()
    form = fn.normalize_form(F.col("form"))
    rows = events.join(small(inside), cik == F.col("__member"), "left")
    reason = (
        F.when(~form.isin(PARSED_FORMS), "form is not supported by the parser")
        .when(~form.isin(list(forms)), "form is not enabled by EDGAR_FORM_TYPES")
        .when(F.lit(not set_name), "EDGAR_SET is not configured")
        .when(cik.isNull(), "filing has an invalid CIK")
        .when(F.col("__member").isNull(), f"company is outside EDGAR_SET={set_name}")
        .otherwise(f"supported form and member of EDGAR_SET={set_name}")
    )
    return rows.withColumn("selection_reason", reason).withColumn("selected", F.col("selection_reason").startswith("supported form")).withColumn("selection_set", F.lit(set_name)).drop("__member")


def pipeline_boundary(events: DataFrame, *, year: int = 2016) -> DataFrame:
    return events.where(F.year("filing_date") >= year)


def filing_search(filings: DataFrame, members: DataFrame, *, cik: str = "", query: str = "", form: str = "", year: int = 0) -> DataFrame:
    """Filings by company, form and year; without any filter nothing."""
    if not (cik or query or form or year):
        return filings.limit(0)
    out = filings
    if cik:
        out = out.where(fn.bare_cik(F.col("cik")) == (cik.lstrip("0") or "0"))
    if query:
        found = member_index(members).where(F.col("key").contains(query.lower())).select("cik").distinct()
        out = out.join(found, "cik", "left_semi")
    if form:
        out = out.where(F.lower("form") == form.lower())
    if year:
        out = out.where(F.year("filing_date") == year)
    return out


def news_filter(news: DataFrame, *, query: str = "", cik: str = "", form: str = "", selection: str = "", from_date: str = "", to_date: str = "", limit: int = 100) -> DataFrame:
    """Newest first; the query is plain text, found in company, accession or CIK whatever its case."""
    out = news
    if query:
        q = query.lower()
        out = out.where(reduce(lambda a, b: a | b, [F.lower(c).contains(q) for c in ("company", "accession", "cik")]))
    for name, value in (("cik", cik), ("form", form)):
        out = out.where(F.col(name) == value) if value else out
    if selection:
        out = out.where(F.col("selected") == (selection == "selected"))
    out = out.where(F.col("filing_date") >= F.lit(from_date).cast("date")) if from_date else out
    out = out.where(F.col("filing_date") <= F.lit(to_date).cast("date")) if to_date else out
    return out.orderBy(F.desc("sequence")).limit(min(max(limit, 1), 500))


def member_index(members: DataFrame) -> DataFrame:
    """Search keys of members: lower-case ticker and name."""
    return members.select("cik", F.explode(F.array(F.lower("ticker"), F.lower("name"))).alias("key")).where("key != ''").distinct()


def member_search(members: DataFrame, query: str) -> DataFrame:
    q = query.lower()
    return members.where(reduce(lambda a, b: a | b, [F.lower(c).contains(q) for c in ("cik", "ticker", "name")])).orderBy("ticker")


def needs_import(candidates: DataFrame, stored: DataFrame, version: int) -> DataFrame:
    """Candidates without a usable stored outcome at this parser version."""
    usable = stored.where((F.col("parser_version") == version) & (F.col("status") != "failed") & ((F.col("status") != "processed") | ((F.coalesce("source_path", F.lit("")) != "") & (F.coalesce("source_hash", F.lit("")) != ""))))
    return candidates.join(usable.select("accession"), "accession", "left_anti")


def _unsound(x: str) -> Column:
    return F.col(x).isNull() | F.isnan(x) | (F.col(x) <= 0) | (F.col(x) == float("inf"))


def price_fault(lo: Column, hi: Column) -> Column:
    """The first fault of a price row of the span lo to hi, or null."""
    outside = F.when(~F.col("date").between(lo, hi), "date outside range")
    return outside.when(_unsound("close"), "invalid close").when(_unsound("adjusted_close"), "invalid adjusted close").when(F.col("open").isNotNull() & _unsound("open"), "invalid open")


def action_fault(lo: Column, hi: Column) -> Column:
    """The first fault of an action row of the span lo to hi, or null."""
    split = F.col("numerator").isNotNull() | F.col("denominator").isNotNull()
    return (
        F.when(~F.col("date").between(lo, hi), "date outside range")
        .when((F.col("action_type") == "dividend") & (_unsound("amount") | split), "invalid dividend")
        .when((F.col("action_type") == "split") & (_unsound("numerator") | _unsound("denominator") | F.col("amount").isNotNull()), "invalid split")
        .when(~F.col("action_type").isin("dividend", "split"), "unknown action")
    )


def validate_batch(prices: DataFrame, actions: DataFrame, from_date: str, through: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of price and action rows, with the first fault as reason."""
    span = (F.lit(from_date).cast("date"), F.lit(through).cast("date"))
    p = prices.withColumns({"reason": price_fault(*span), "record_type": F.lit("price")})
    a = actions.withColumns({"reason": action_fault(*span), "record_type": F.lit("action")})
    both = p.unionByName(a, allowMissingColumns=True)
    return both.where("reason is null").drop("reason"), both.where("reason is not null")


def valid_period(instant: Column, start: Column, end: Column) -> Column:
    s, e = fn.parse_date(start), fn.parse_date(end)
    return F.when(F.coalesce(instant, F.lit("")) != "", fn.parse_date(instant).isNotNull()).otherwise(F.coalesce(s <= e, F.lit(False)))


def company_extension(namespace: Column) -> Column:
    """A namespace that holds none of the standard fragments (fixed values)."""
    standard = ["/us-gaap/", "/us-gaap:", "xbrl.sec.gov/dei", "xbrl.org/", "www.xbrl.org/"]
    return (F.coalesce(namespace, F.lit("")) != "") & ~reduce(lambda a, b: a | b, [namespace.contains(s) for s in standard])


def statement_period(values: DataFrame) -> DataFrame:
    return values.where((F.col("statement") == "balance") == (F.col("group") == "Instant"))


def valid_period_key(key: Column) -> Column:
    return key.rlike("^(FY|Q|YTD)") | fn.parse_date(key).isNotNull()


def extraction_failures(filings: DataFrame, diagnostics: DataFrame) -> DataFrame:
    return filings.join(diagnostics.where(F.col("code").isin("xbrl_error", "xbrl_reference")), "accession", "left_semi")


def unchanged_sources(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files that still have to be parsed: new, or of another size or time, or without a finished view."""
    done = processed.where(F.col("status").isin("complete", "no_xbrl", "unsupported")).select("path", "length", "modified")
    return files.join(done, ["path", "length", "modified"], "left_anti")


def fx_window(observations: DataFrame, currency: str, denominator: str, start: str, end: str) -> DataFrame:
    if start > end:
        raise ValueError("start is after end")
    return observations.where((F.col("currency") == currency) & (F.col("denominator") == denominator) & F.col("time").between(start, end))
