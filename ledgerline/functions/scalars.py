"""Scalar functions: every one takes and returns columns and stays inside the JVM."""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,4)"


def canonical_cik(x: Column, *, keep_invalid: bool = False) -> Column:
    """Ten digits, zero-padded; anything but one to ten digits is null (or itself)."""
    t = F.trim(x)
    return F.when(t.rlike("^[0-9]{1,10}$"), F.lpad(t, 10, "0")).otherwise(x if keep_invalid else F.lit(None))


def bare_cik(x: Column) -> Column:
    """Without padding; blank is 0."""
    return F.coalesce(F.nullif(F.ltrim(F.trim(x), F.lit("0")), F.lit("")), F.when(x.isNotNull(), "0"))


def accession_from_path(path: Column) -> Column:
    """Accession of a filing path: dashed, 18 digits, or an -index page; else null."""
    base = F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(-index)?\.[A-Za-z]+$", "")
    dashed = F.concat_ws("-", F.substring(base, 1, 10), F.substring(base, 11, 2), F.substring(base, 13, 6))
    return F.when(base.rlike("^[0-9]{10}-[0-9]{2}-[0-9]{6}$"), base).when(base.rlike("^[0-9]{18}$"), dashed)


def parse_date(x: Column) -> Column:
    """ISO or compact date, else null."""
    t = F.trim(x)
    return F.coalesce(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")), F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")))


def normalize_date(x: Column) -> Column:
    """ISO text of a date written in one of four ways, else the text unchanged."""
    t = F.trim(x)
    layouts = [(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"), (r"^\d{2}-\d{2}-\d{4}$", "MM-dd-yyyy")]
    return F.coalesce(*[F.when(t.rlike(r), F.date_format(F.try_to_date(t, f), "yyyy-MM-dd")) for r, f in layouts], t)


def classify_period(instant: Column, start: Column, end: Column, report: Column) -> Column:
    """struct(group, key) of a context's dates, or null for a context that fits no group.

    The month span decides the group; the fiscal year ends in the report date's month (the end date's without one).
    """
    fiscal_month = F.month(F.coalesce(report, end))
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1
    fy = (F.year(end) + F.when((fiscal_month != 12) & (F.month(end) > fiscal_month), 1).otherwise(0)).cast("string")
    first = fiscal_month % 12 + 1
    quarter = (F.floor((F.month(start) - first + 12) % 12 / 3) + 1).cast("string")

    def period(group: str, key: Column) -> Column:
        return F.struct(F.lit(group).alias("group"), key.alias("key"))

    return (
        F.when(instant.isNotNull(), period("Instant", F.date_format(instant, "yyyy-MM-dd")))
        .when(start.isNull() | end.isNull() | (start > end), None)
        .when(months >= 10, period("Fiscal year", F.concat(F.lit("FY"), fy)))
        .when(months == 3, period("Quarterly", F.concat(F.lit("Q"), quarter, F.lit(" FY"), fy)))
        .when(months > 3, period("Year to date", F.concat(F.lit("YTD FY"), fy)))
    )


def normalize_unit(measures: Column, numerator: Column, denominator: Column, unit_id: Column) -> Column:
    """Name of a unit from arrays of struct(ns, local): measures, or a numerator over a denominator.

    USD, shares and pure by name, others as ns#local; a unit without measures, or with one side only, is unknown:id.
    """

    def name(m: Column) -> Column:
        local = F.lower(m["local"])
        plain = F.when(local == "usd", "USD").when(local.isin("shares", "share"), "shares").when(local == "pure", "pure")
        return F.coalesce(plain, F.when(F.coalesce(m["ns"], F.lit("")) != "", F.concat(m["ns"], F.lit("#"), m["local"])), m["local"])

    def side(x: Column) -> Column:
        return F.array_join(F.transform(x, name), "*")

    def filled(x: Column) -> Column:
        return F.coalesce(F.size(x), F.lit(0)) > 0

    both = filled(numerator) & filled(denominator)
    return F.when(filled(measures), side(measures)).when(both, F.concat(side(numerator), F.lit("/"), side(denominator))).otherwise(F.concat(F.lit("unknown:"), unit_id))


def namespace_matches(namespace: Column, family: Column) -> Column:
    """Any or empty family fits all; us-gaap fits its standard namespaces; else the family is a fragment."""
    standard = namespace.contains("/us-gaap/") | namespace.contains("/us-gaap:")
    return (family.isin("", "any") | family.isNull()) | F.when(family == "us-gaap", standard).otherwise(namespace.contains(family))


def parse_amount(x: Column) -> Column:
    return F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast(MONEY)


def precision_score(decimals: Column, precision: Column) -> Column:
    """INF is best, then integer decimals, then integer precision, then nothing."""
    top, bottom = F.lit(2147483647), F.lit(-2147483647)
    return F.when((F.upper(F.trim(decimals)) == "INF") | (F.upper(F.trim(precision)) == "INF"), top).otherwise(
        F.coalesce(F.trim(decimals).try_cast("int"), F.trim(precision).try_cast("int"), bottom)
    )


def decimals_tolerance(decimals: Column) -> Column:
    """Half a unit of the last reported digit; unknown or exact: zero."""
    d = F.trim(decimals).try_cast("int")
    return F.when(d.between(-12, 4), F.lit("0.5").cast("decimal(38,10)") * F.pow(F.lit(10.0), -d).cast("decimal(20,4)")).otherwise(F.lit(0)).cast("decimal(24,6)")


def ratio_string(numerator: Column, denominator: Column, style: Column) -> Column:
    """Percent or multiple with two decimals, half away from zero; null for a zero or unreadable denominator."""
    n, d = numerator.cast(MONEY), denominator.cast(MONEY)
    q = F.try_divide(n * F.when(style == "percent", 100).otherwise(1).cast("decimal(4,0)"), d)
    return F.concat(F.round(q, 2).cast("decimal(24,2)").cast("string"), F.when(style == "percent", "%").otherwise("x"))


def _trimmed(x: Column) -> Column:
    """Text of a decimal without trailing zeros or point."""
    return F.regexp_replace(x.cast("string"), r"\.?0+$", "")


def compact_number(x: Column) -> Column:
    """K, M, B or T with one decimal at most, half away from zero; negatives in parentheses."""
    a = F.abs(x.cast(MONEY))
    out = _trimmed(F.round(a, 1).cast("decimal(24,1)"))
    for power, suffix in ((3, "K"), (6, "M"), (9, "B"), (12, "T")):
        scaled = F.round(a / F.lit(10**power).cast(f"decimal({power + 1},0)"), 1).cast("decimal(24,1)")
        out = F.when(a >= 10**power, F.concat(_trimmed(scaled), F.lit(suffix))).otherwise(out)
    return F.when(x < 0, F.concat(F.lit("("), out, F.lit(")"))).otherwise(out)


def format_fact_value(value: Column, nil: Column, unit: Column) -> Column:
    """A value for display: nil and blank as a dash, no number as it is; units with usd or per share get a dollar sign,
    and two decimals below a thousand."""
    number, u = parse_amount(value), F.lower(unit)
    priced = F.coalesce(u.contains("usd") | u.contains("pershare") | u.contains("/shares"), F.lit(False))
    compact = compact_number(number)
    text = F.when(priced & (F.abs(number) < 1000), _trimmed(F.round(number, 2).cast("decimal(24,2)"))).otherwise(compact)
    money = F.when(text.startswith("("), F.concat(F.lit("($"), F.substr(text, F.lit(2)))).otherwise(F.concat(F.lit("$"), text))
    shown = F.when(number.isNull(), value).when(priced, money).otherwise(text)
    return F.when(F.coalesce(nil, F.lit(False)) | value.isNull() | (F.trim(value) == ""), "-").otherwise(shown)


def dividend_year(x: Column) -> Column:
    t = F.trim(x)
    return F.when(t.rlike("^[0-9]{4}"), F.substring(t, 1, 4)).when(t.rlike("^[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}$"), F.right(t, F.lit(4)))


@cache
def _references() -> str:
    """All named character references as a JSON object; the frequent ones stand first, as a map is searched in order."""
    first = ["nbsp;", "amp;", "lt;", "gt;", "quot;", "apos;", "rsquo;", "lsquo;", "ldquo;", "rdquo;", "mdash;", "ndash;", "middot;", "copy;"]
    return json.dumps({n: html5[n] for n in (*first, *(k for k in html5 if k not in first))})


#: Longest name that counts without its semicolon.
_LEGACY = max(len(n) for n in html5 if not n.endswith(";"))
#: Numbers below 160 that browsers read as Windows-1252.
_WINDOWS = {i: bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def unescape(x: Column) -> Column:
    """Text with its character references decoded: named ones by the longest name that fits, with or without semicolon where HTML
    knows it so, and numbers; impossible numbers become U+FFFD, unknown names stay as they are."""
    names = F.from_json(F.lit(_references()), "map<string,string>")
    windows = F.from_json(F.lit(json.dumps({str(k): v for k, v in _WINDOWS.items()})), "map<string,string>")

    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, "^&#([0-9]+|[xX][0-9a-fA-F]+);?", 1)
        hexadecimal = F.regexp_extract(number, "^[xX]0*([0-9a-fA-F]{1,9})", 1)
        decimal = F.regexp_extract(number, "^0*([0-9]{1,9})", 1)  # nine digits are enough to be too many
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(F.nullif(decimal, F.lit(""))).cast("long")
        fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        rest = F.substring(part, F.length(F.regexp_extract(part, "^&#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)) + 1, F.length(part))
        whole = F.regexp_extract(part, "^&([A-Za-z][A-Za-z0-9]*;)", 1)
        name = F.regexp_extract(part, "^&([A-Za-z][A-Za-z0-9]*)", 1)
        prefixes = [F.left(name, F.lit(n)) for n in range(_LEGACY, 1, -1)]
        shorter = [F.when(F.length(name) >= n, F.concat(names[k], F.substring(part, F.lit(n + 2), F.length(part)))) for n, k in zip(range(_LEGACY, 1, -1), prefixes, strict=True)]
        by_name = F.coalesce(F.concat(names[whole], F.substring(part, F.length(whole) + 2, F.length(part))), *shorter, part)
        return F.when(number != "", F.concat(F.coalesce(windows[code.cast("string")], plain), rest)).when(name != "", by_name).otherwise(part)

    return F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(F.split(x, "(?=&)"), decoded), "")).otherwise(x)


def clean_text(x: Column) -> Column:
    """Text without tags, with all character references decoded and white space of any kind collapsed."""
    blanks = "[\\s\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(x, r"<[^>]*>", " ")), blanks, " "))


def evidence_text(x: Column) -> Column:
    return F.when(F.length(x) > 320, F.concat(F.left(x, F.lit(320)), F.lit("..."))).otherwise(x)


def truncate_text(x: Column, n: int) -> Column:
    return F.left(x, F.lit(n))


def party_id(cik: Column, accession: Column, key: Column) -> Column:
    c = canonical_cik(cik)
    return F.when(c.isNotNull(), F.concat(F.lit("cik:"), c)).otherwise(F.concat(F.lit("filing:"), accession, F.lit(":party:"), key))


def security_id(cusip: Column, issuer: Column, kind: Column, title: Column, klass: Column) -> Column:
    c = F.upper(F.trim(cusip))
    digest = F.sha2(F.concat_ws("\u0000", *[F.coalesce(x, F.lit("")) for x in (issuer, kind, title, klass)]), 256)
    return F.when(c != "", F.concat(F.lit("cusip:"), c)).otherwise(F.concat(F.lit("security:"), digest))


def dividend_event_id(*parts: Column) -> Column:
    return F.left(F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256), F.lit(16))


def observation_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def normalize_amendment(kind: Column, form: Column) -> Column:
    """Amendment type by family: holdings reports have aliases, other families one fixed type per amendment."""
    k, amended = F.upper(F.trim(F.coalesce(kind, F.lit("")))), form.endswith("/A")
    holdings = F.when(k.isin("NEW HOLDINGS", "NEW HOLDING", "ADDS NEW HOLDINGS ENTRIES"), "NEW HOLDINGS").when(k.isin("RESTATEMENT", "RESTATES"), "RESTATEMENT").when(amended, "RESTATEMENT").otherwise(k)
    return (
        F.when(form.startswith("13F"), holdings)
        .when(form.isin("3/A", "4/A", "5/A"), "CORRECTION")
        .when(amended & (form.contains("13D") | form.contains("13G")), "STATE UPDATE")
        .otherwise("")
    )


def normalize_form(x: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(x, r"\s+", " ")))


def subject_for(form: Column) -> Column:
    return F.coalesce(F.nullif(F.translate(normalize_form(form), "./ *>", "_____"), F.lit("")), F.lit("unknown"))


def normalize_ticker(x: Column) -> Column:
    return F.translate(F.translate(F.upper(x), " \u00a0", ""), ".", "-")


def source_url(path: Column, base: str = "https://www.sec.gov/Archives/") -> Column:
    at = F.locate("edgar/data/", path)
    return F.when(at > 0, F.concat(F.lit(base), F.substr(path, at))).otherwise("")


def history_year(key: Column) -> Column:
    return F.when(key.rlike("^FY[0-9]{4}$"), F.substring(key, 3, 4)).when(key.rlike("^[0-9]"), F.left(key, F.lit(4))).otherwise("")


def retry_delay_minutes(failures: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.least(F.greatest(failures - 1, F.lit(0)), F.lit(6)).cast("int"))


def scheduled_through(now: Column, *, zone: str = "America/New_York", cutoff_hour: int = 21) -> Column:
    """Last day that a daily price run covers: the local day once the cutoff has passed, else the day before."""
    local = F.from_utc_timestamp(now, zone)
    return F.when(F.hour(local) >= cutoff_hour, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))


def parse_boolean(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin("1", "true", "y", "yes"), F.lit(False))


def filing_path_from_href(href: Column, cik: Column, accession: Column) -> Column:
    """Path of a submission: the folder of the link's path and the accession, or where the link has no folder the CIK's."""
    path = F.regexp_extract(F.coalesce(href, F.lit("")), "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(path, "^/Archives/", ""), "^(.*)/[^/]*$", 1)
    file = F.concat(accession, F.lit(".txt"))
    return F.when(folder != "", F.concat(folder, F.lit("/"), file)).when(path.startswith("/") & ~path.startswith("/Archives/"), F.concat(F.lit("/"), file)).otherwise(F.concat(F.lit("edgar/data/"), F.ltrim(cik, F.lit("0")), F.lit("/"), file))


def unwrap_value(text: Column, value: Column | None = None) -> Column:
    """Trimmed text of an element's value child, or else its own; null where both are missing or blank."""
    given = [F.nullif(F.trim(c), F.lit("")) for c in (value, text) if c is not None]
    return F.coalesce(*given)


def fx_series_key(currency: Column, denominator: Column) -> Column:
    return F.concat(F.lit("D."), F.upper(currency), F.lit("."), F.upper(denominator), F.lit(".SP00.A"))


def fx_series_pair(key: Column) -> Column:
    """(currency, denominator) of a series key; null for any other key."""
    fits = key.rlike(r"^D\.[A-Z]{3}\.[A-Z]{3}\.SP00\.A$")
    return F.when(fits, F.struct(F.split_part(key, F.lit("."), F.lit(2)).alias("currency"), F.split_part(key, F.lit("."), F.lit(3)).alias("denominator")))


def join_child_texts(texts: Column) -> Column:
    return F.array_join(F.filter(F.transform(texts, lambda t: F.trim(t)), lambda t: t != ""), ",")


def distinct_ordered(values: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.upper(F.trim(v))), lambda v: v != ""))


def year_of(x: Column) -> Column:
    return F.left(x, F.lit(4)).try_cast("int")


def in_year_range(year: Column, low: int, high: int) -> Column:
    """Bounds of 0 are open."""
    return (F.lit(low == 0) | (year >= low)) & (F.lit(high == 0) | (year <= high))
