"""Readers of landed files and writers of exports. Bad rows are set apart with a reason, never dropped unseen."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as fn


def _index_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, rejects) of lines (value); other columns stay."""
    rest = [c for c in raw.columns if c != "value"]
    lines = raw.withColumn("value", F.rtrim(F.replace("value", F.lit("\r"), F.lit("")))).where("trim(value) != ''")
    parts = lines.select("value", *rest, F.transform(F.split("value", r"\|"), lambda t: F.trim(t)).alias("p"))
    field = [F.get("p", F.lit(i)) for i in range(6)]
    date = fn.parse_date(field[3])
    reason = F.when(~F.size("p").isin(5, 6), "column count").when(date.isNull(), "invalid date").when((field[0] == "") | (field[2] == "") | (field[4] == ""), "empty field")
    rows = parts.select("value", *rest, reason.alias("reason"), fn.bare_cik(field[0]).alias("cik"), field[1].alias("company"), field[2].alias("form"), date.alias("filing_date"), field[4].alias("path"), field[5].alias("index_path"))
    return rows.where("reason is null").drop("value", "reason"), rows.where("reason is not null").select("value", *rest, "reason")


def read_index(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(index, rejects) of pipe-separated index files: cik, company, form, filing date, path and perhaps index path."""
    return _index_rows(spark.read.text(paths))


def read_raw_index(spark: SparkSession, paths: str | list[str], *, header_lines: int = 11) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of raw index files below their header lines; lines with fewer than five fields are set apart."""
    whole = spark.read.text(paths, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\n")).alias("n", "line")).where(F.col("n") >= header_lines)
    parts = lines.where("trim(line) != ''").select("line", F.split("line", r"\|").alias("p"))
    good = parts.where(F.size("p") >= 5)
    rows = good.select(*[F.trim(F.get("p", F.lit(i))).alias(c) for i, c in enumerate(("cik", "company", "form", "filing_date", "path"))])
    return rows, parts.where(F.size("p") < 5).select(F.col("line").alias("value"), F.lit("column count").alias("reason"))


def write_index(index: DataFrame, path: str) -> None:
    cols = ["cik", "company", "form", F.date_format("filing_date", "yyyy-MM-dd"), "path"]
    index.select(F.concat_ws("|", *cols).alias("value")).write.text(path)


_ATOM = "title string, updated string, summary struct<_VALUE:string, _type:string>, link struct<_href:string, _rel:string, _type:string>, category struct<_term:string, _label:string, _scheme:string>"


def _feed_rows(rows: DataFrame) -> DataFrame:
    """Fields of feed entries; accession is null where an entry's link has none. The patterns are fixed values."""
    href, title = F.coalesce("link._href", F.lit("")), F.coalesce("title", F.lit(""))
    summary = fn.clean_text(F.coalesce("summary._VALUE", F.lit("")))

    def found(text, pattern):
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    digits = found(href, r"edgar/data/\d+/(\d{18})")
    accession = F.coalesce(found(href, r"edgar/data/\d+/(\d{10}-\d{2}-\d{6})"), F.concat_ws("-", F.substring(digits, 1, 10), F.substring(digits, 11, 2), F.substring(digits, 13, 6)))
    return rows.select(
        F.when(F.length(accession) == 20, accession).alias("accession"), fn.canonical_cik(F.coalesce(found(summary, r"(?i)\bCIK\s*[:=]\s*([0-9]{1,10})"), found(title, r"\(([0-9]{10})\)"))).alias("cik"),
        fn.normalize_form(F.coalesce(found(summary, r"(?i)\bForm Type\s*:\s*([^\s]+)"), "category._term")).alias("form"),
        F.coalesce(found(title, r"^\s*.+?\s+-\s+(.*?)\s+\([0-9]{10}\)"), F.trim(title)).alias("company"), href.alias("url"), "updated",
    ).withColumn("path", fn.filing_path_from_href(F.col("url"), F.col("cik"), F.col("accession")))


def read_atom_feed(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of feed files: one event per accession, entries without an accession set apart. A title
    of another form is the company's name as it stands."""
    rows = _feed_rows(spark.read.format("xml").options(rowTag="entry", ignoreNamespace="true").schema(_ATOM).load(paths))
    events = rows.where("accession is not null").groupBy("accession").agg(F.min(F.struct("url", "cik", "form", "company", "updated", "path")).alias("e")).select("accession", "e.*")
    return events, rows.where("accession is null")


def stream_atom_feed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries with an accession, dead letters) of a folder of feed files as streams; repeats are for a later stage."""
    rows = _feed_rows(spark.readStream.format("xml").options(rowTag="entry", ignoreNamespace="true").schema(_ATOM).load(path))
    return rows.where("accession is not null"), rows.where("accession is null")


def select_index_files(files: list[str], *, file: str = "", latest: bool = False, year: int = 0, from_year: int = 0, to_year: int = 0) -> list[str]:
    """The quarterly files (YYYY-QTRn.tsv) that a choice names; the ways to choose exclude each other."""
    ranged = bool(from_year or to_year)
    if bool(file) + latest + bool(year) + ranged != 1:
        raise ValueError("choose by one of file, latest, year or a range of years")
    if from_year and to_year and from_year > to_year:
        raise ValueError("from_year is after to_year")
    known = sorted(f for f in files if re.search(r"(^|/)\d{4}-QTR[1-4]\.tsv$", f))

    def of(f: str) -> int:
        return int(re.search(r"(\d{4})-QTR", f)[1])

    if file:
        known = [f for f in known if f == file or f.endswith(f"/{file}")]
    elif latest:
        known = known[-1:]
    else:
        known = [f for f in known if (year or from_year) <= of(f) <= (year or to_year or 9999)]
    if not known:
        raise ValueError("no index file fits")
    return known


def stitch(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """read_index of all quarterly files with the year and quarter in their names; an error when there are none."""
    if not files:
        raise ValueError("no quarterly index files")
    raw = spark.read.text(sorted(files)).select("value", F.input_file_name().alias("file"))
    index, rejects = _index_rows(raw)
    part = [F.regexp_extract("file", r"(\d{4})-QTR(\d)", i).cast("int").alias(c) for i, c in ((1, "year"), (2, "quarter"))]
    return index.select(*[c for c in index.columns if c != "file"], *part), rejects.drop("file")


def read_fx(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """currency, denominator, time, value of landed generic-data XML."""
    value = "struct<_id:string, _value:string>"
    schema = f"SeriesKey struct<Value:array<{value}>>, Obs array<struct<Time:string, ObsDimension:struct<_value:string>, ObsValue:struct<_value:string>>>"
    rows = spark.read.format("xml").options(rowTag="Series", ignoreNamespace="true").schema(schema).load(paths)
    key = F.map_from_entries(F.transform("SeriesKey.Value", lambda v: F.struct(v["_id"], v["_value"])))
    obs = rows.select(key.alias("k"), F.explode("Obs").alias("o"))
    return obs.select(F.try_element_at("k", F.lit("CURRENCY")).alias("currency"), F.try_element_at("k", F.lit("CURRENCY_DENOM")).alias("denominator"), F.coalesce("o.Time", "o.ObsDimension._value").alias("time"), F.col("o.ObsValue._value").try_cast("double").alias("value"))


_CHART = "symbol string, currency string, timestamp array<bigint>, open array<double>, close array<double>, adjclose array<double>, dividends map<string, struct<amount:double, date:bigint>>, splits map<string, struct<date:bigint, numerator:double, denominator:double>>"


def read_price_charts(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prices, actions, rejects) of chart JSON: parallel arrays of a symbol; a file of uneven arrays, another
    currency or unordered times is rejected whole, candles without a close are skipped."""
    rows = spark.read.schema(_CHART).json(paths)
    n = F.size("timestamp")
    ordered = F.forall(F.sequence(F.lit(1), n - 1), lambda i: F.get("timestamp", i) > F.get("timestamp", i - 1)) | (n < 2)
    reason = F.when(F.col("currency") != "USD", "currency").when((F.size("close") != n) | (F.size("open") != n) | (F.size("adjclose") != n), "uneven arrays").when(~ordered, "unordered times")
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason is null")
    day = F.to_date(F.timestamp_seconds("timestamp"))
    prices = good.select("symbol", F.inline(F.arrays_zip("timestamp", "open", "close", "adjclose"))).where("close is not null").select("symbol", day.alias("date"), "open", "close", F.col("adjclose").alias("adjusted_close"))
    paid = good.select("symbol", F.explode("dividends").alias("source_id", "d")).select("symbol", "source_id", F.to_date(F.timestamp_seconds("d.date")).alias("date"), F.lit("dividend").alias("action_type"), "d.amount")
    split = good.select("symbol", F.explode("splits").alias("source_id", "s")).select("symbol", "source_id", F.to_date(F.timestamp_seconds("s.date")).alias("date"), F.lit("split").alias("action_type"), "s.numerator", "s.denominator")
    return prices, paid.unionByName(split, allowMissingColumns=True), rows.where("reason is not null").select("symbol", "reason")


BATCH_SCHEMA = "record_type string, security string, symbol string, date date, currency string, open double, close double, adjusted_close double, action_type string, amount double, numerator double, denominator double, source_id string"


def write_price_batches(rows: DataFrame, path: str) -> None:
    """CSV with a header, one folder per record type; columns are those of BATCH_SCHEMA."""
    columns = [c.split()[0] for c in BATCH_SCHEMA.split(", ")]
    there = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in columns])
    there.withColumn("kind", F.col("record_type")).write.partitionBy("kind").csv(path, header=True)


def read_price_batches(spark: SparkSession, paths: str | list[str], *, identity: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): prices carry no action values and the reverse; a date or an action that its file has twice, another
    currency than USD and, with identity (a pattern whose first group is the symbol of a file's path), rows of another symbol
    are rejected too."""
    rows = spark.read.csv(paths, header=True, schema=BATCH_SCHEMA, mode="FAILFAST").withColumn("__path", F.col("_metadata.file_path"))
    action = F.coalesce("amount", "numerator", "denominator").isNotNull() | F.col("action_type").isNotNull()
    price = F.coalesce("open", "close", "adjusted_close").isNotNull()
    is_price = F.col("record_type") == "price"
    once = Window.partitionBy("__path", "security", "record_type", F.when(is_price, F.col("date").cast("string")).otherwise(F.col("source_id")))
    reason = F.when(~F.col("record_type").isin("price", "action"), "record type").when(is_price & action, "price with action values").when((F.col("record_type") == "action") & price, "action with prices")
    reason = reason.when(F.coalesce("currency", F.lit("")) != "USD", "currency").when(F.count("*").over(once) > 1, F.when(is_price, "duplicate price date").otherwise("duplicate action"))
    if identity:
        reason = reason.when(F.regexp_extract("__path", identity, 1) != F.col("symbol"), "identity mismatch")
    rows = rows.withColumn("reason", reason).drop("__path")
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def _first_reason(*rules: tuple[Column, str]) -> Column:
    """The first rule that holds, as a reason; null where none does."""
    return F.coalesce(*[F.when(F.coalesce(broken, F.lit(True)), reason) for broken, reason in rules])


def read_constituents(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(members, rejects): set_name, as_of, cik, ticker, name by ticker, and path, reason of files that break a rule.

    A set needs a name, a date and members; a member needs a CIK, a ticker that no other has, and a name. One broken member
    rejects its whole file.
    """
    rows = spark.read.schema("name string, as_of string, source string, members array<struct<cik:string, ticker:string, name:string>>").json(paths, multiLine=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.trim("name").alias("set_name"), "as_of", "members")
    clean = F.transform("members", lambda m: F.struct(fn.canonical_cik(m["cik"]).alias("cik"), fn.normalize_ticker(m["ticker"]).alias("ticker"), F.trim(m["name"]).alias("name")))
    rows = rows.withColumn("members", clean)

    def lacks(field: str) -> Column:
        return F.exists("members", lambda m: F.coalesce(m[field], F.lit("")) == "")

    tickers = F.col("members.ticker")
    reason = _first_reason(
        (F.coalesce("set_name", F.lit("")) == "", "set without name"), (F.try_to_date("as_of", "yyyy-MM-dd").isNull(), "invalid date"), (F.coalesce(F.size("members"), F.lit(0)) < 1, "no members"),
        (lacks("cik"), "member without CIK"), (lacks("ticker"), "member without ticker"), (lacks("name"), "member without name"), (F.size(F.array_distinct(tickers)) < F.size(tickers), "duplicate ticker"),
    )
    rows = rows.withColumn("reason", reason)
    return rows.where("reason IS NULL").select("set_name", "as_of", F.inline("members")).orderBy("ticker"), rows.where("reason IS NOT NULL").select("path", "reason")


_TAXONOMY = "schema_version int, taxonomy_version string, metrics array<struct<key:string, name:string, label:string, statement:string, tier:string, concepts:array<struct<name:string, namespace:string, priority:int>>>>, ratios array<struct<key:string, label:string, numerator:string, denominator:string, format:string>>"


def read_taxonomy(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, ratios, rejects) of taxonomy files.

    concepts: concept, family, metric, label, statement, tier, priority, position in file order; ratios: ratio, label, numerator,
    denominator, style; rejects: path, reason. A file needs schema 1 and a version; metrics need a key of their own, a label, a
    statement and concepts with names.
    """
    rows = spark.read.schema(_TAXONOMY).json(paths, multiLine=True).withColumn("path", F.col("_metadata.file_path"))
    key = F.transform("metrics", lambda m: F.coalesce(m["key"], m["name"], F.lit("")))

    def blank(x: Column) -> Column:
        return F.coalesce(x, F.lit("")) == ""

    reason = _first_reason(
        (F.coalesce("schema_version", F.lit(0)) != 1, "unsupported schema"), (blank(F.trim("taxonomy_version")), "version is empty"),
        (F.exists(key, lambda k: k == "") | F.exists("metrics", lambda m: blank(m["label"]) | blank(m["statement"])), "empty key, label or statement"), (F.size(F.array_distinct(key)) < F.size(key), "duplicate metric"),
        (F.exists("metrics", lambda m: F.coalesce(F.size(m["concepts"]), F.lit(0)) < 1), "metric without concepts"), (F.exists("metrics", lambda m: F.exists(m["concepts"], lambda c: blank(c["name"]))), "concept without name"),
    )
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason IS NULL")
    metrics = good.select(F.posexplode("metrics").alias("i", "m")).select("i", F.coalesce("m.key", "m.name").alias("metric"), "m.label", "m.statement", "m.tier", F.posexplode("m.concepts").alias("j", "c"))
    concepts = metrics.select(F.col("c.name").alias("concept"), F.col("c.namespace").alias("family"), "metric", "label", "statement", "tier", F.col("c.priority").alias("priority"), (F.col("i") * 1000 + F.col("j")).alias("position"))
    ratios = good.select(F.inline("ratios")).select(F.col("key").alias("ratio"), "label", "numerator", "denominator", F.col("format").alias("style"))
    return concepts, ratios, rows.where("reason IS NOT NULL").select("path", "reason")


_TABLE = "infoTable array<struct<nameOfIssuer:string, titleOfClass:string, cusip:string, value:string, shrsOrPrnAmt:struct<sshPrnamt:string, sshPrnamtType:string>, putCall:string, otherManager:string>>"


def shred_13f(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(positions, rejects) of information tables; a position needs issuer and CUSIP."""
    rows = documents.select("accession", F.posexplode(F.from_xml("xml", F.lit(_TABLE), {"ignoreNamespace": "true"})["infoTable"]).alias("row_number", "t"))
    rows = rows.select("accession", "row_number", F.trim("t.nameOfIssuer").alias("issuer_name"), "t.titleOfClass", F.upper(F.trim("t.cusip")).alias("cusip"), fn.parse_amount(F.col("t.value")).alias("value"), fn.parse_amount(F.col("t.shrsOrPrnAmt.sshPrnamt")).alias("shares"), F.coalesce("t.putCall", F.lit("")).alias("put_call"), F.coalesce("t.otherManager", F.lit("")).alias("other_managers"))
    good = (F.coalesce("issuer_name", F.lit("")) != "") & (F.coalesce("cusip", F.lit("")) != "")
    return rows.where(good), rows.where(~good)
