"""Registered queries of the scalar functions, over texts and numbers that the tables give, with every branch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import scalars as fn
from .queries import query


def _pick(key: str, cases: list[Column]) -> Column:
    """One of the cases by a row's number."""
    out = cases[-1]
    for i in reversed(range(len(cases) - 1)):
        out = F.when(F.col(key) % len(cases) == i, cases[i]).otherwise(out)
    return out


def _case(key: str, cases: list[str]) -> str:
    return f"CASE {key} % {len(cases)} " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cases)) + " END"


def _digits(accession: Column) -> Column:
    return F.replace(accession, F.lit("-"), F.lit(""))


@query("f03_accession_from_path", "filings", f"SELECT accession, {_case('CAST(substring(accession, 15) AS INT)', ['accession', 'accession', 'accession', 'NULL', 'NULL'])} AS found FROM filings")
def _(f):
    rows = f.withColumn("n", F.substring("accession", 15, 6).cast("int"))
    a = F.col("accession")
    path = _pick("n", [F.concat(F.lit("edgar/data/1/"), a, F.lit(".txt")), F.concat(F.lit("edgar/data/1/"), _digits(a)), F.concat(a, F.lit("-index.htm")), F.concat(F.lit("x/"), F.left(a, F.lit(9))), F.lit("")])
    return rows.select("accession", fn.accession_from_path(path).alias("found"))


_DATES = ["strftime(filing_date, '%Y-%m-%d')", "strftime(filing_date, '%Y%m%d')", "' ' || strftime(filing_date, '%Y-%m-%d') || ' '", "'2024-02-30'", "strftime(filing_date, '%m/%d/%Y')", "strftime(filing_date, '%m-%d-%Y')", "'soon'", "''"]


def _dates(f):
    d = F.col("filing_date")
    rows = f.withColumn("n", F.substring("accession", 15, 6).cast("int"))
    written = [F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "yyyyMMdd"), F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd"), F.lit(" ")), F.lit("2024-02-30"), F.date_format(d, "MM/dd/yyyy"), F.date_format(d, "MM-dd-yyyy"), F.lit("soon"), F.lit("")]
    return rows.withColumn("text", _pick("n", written))


_N = "CAST(substring(accession, 15) AS INT)"


@query("f05_parse_date", "filings", f"SELECT accession, {_case(_N, ['filing_date', 'filing_date', 'filing_date', 'NULL', 'NULL', 'NULL', 'NULL', 'NULL'])} AS parsed FROM filings")
def _(f):
    return _dates(f).select("accession", fn.parse_date(F.col("text")).alias("parsed"))


@query("f06_normalize_date", "filings", f"SELECT accession, {_case(_N, [_DATES[0]] * 3 + [_DATES[3]] + [_DATES[0]] * 2 + [_DATES[6], _DATES[7]])} AS iso FROM filings")
def _(f):
    return _dates(f).select("accession", fn.normalize_date(F.col("text")).alias("iso"))


_UNITS = [("USD", "[m('i', 'usd')]", "[]", "[]"), ("USD/shares", "[]", "[m('i', 'USD')]", "[m('x', 'Share')]"), ("pure", "[m('x', 'pure')]", "[]", "[]"), ("i#EUR", "[m('i', 'EUR')]", "[]", "[]"), ("barrel", "[m('', 'barrel')]", "[]", "[]"), (None, "[]", "[m('i', 'USD')]", "[]"), (None, "[]", "[]", "[]"), ("USD*shares", "[m('i', 'USD'), m('x', 'shares')]", "[]", "[]")]


@query("f07_normalize_unit", "own_filings", f"SELECT accession, coalesce({_case('n', [f"'{name}'" if name else 'NULL' for name, *_ in _UNITS])}, 'unknown:u' || n) AS unit FROM (SELECT accession, CAST(substring(accession, 5) AS INT) AS n FROM own_filings)")
def _(f):
    def measures(text: str) -> Column:
        found = [x.split("', '") for x in text.strip("[]").replace("m('", "").rstrip("')").split("'), ")] if text != "[]" else []
        shape = "array<struct<ns:string,local:string>>"
        return F.array(*[F.struct(F.lit(ns).alias("ns"), F.lit(local).alias("local")) for ns, local in found]).cast(shape)

    rows = f.select("accession", F.substring("accession", 5, 10).cast("int").alias("n"))
    sides = [_pick("n", [measures(u[i]) for u in _UNITS]) for i in (1, 2, 3)]
    return rows.select("accession", fn.normalize_unit(*sides, F.concat(F.lit("u"), F.col("n"))).alias("unit"))


@query("f08_namespace_matches", "facts", "SELECT id, namespace LIKE '%/us-gaap/%' OR namespace LIKE '%/us-gaap:%' AS gaap, namespace LIKE '%dei%' AS dei, true AS any FROM facts")
def _(f):
    return f.select("id", *[fn.namespace_matches(F.col("namespace"), F.lit(x)).alias(name) for x, name in (("us-gaap", "gaap"), ("dei", "dei"), ("any", "any"))])


#: Cents of a value between thousandths and billions of either sign, for the display functions.
_CENTS = "CASE WHEN n % 2 = 0 THEN -1 ELSE 1 END * ((n * 7919) % 99991) * CAST(power(10, n % 10) AS BIGINT)"


def _tenths(cents: str, divisor: str) -> str:
    """A trimmed decimal with one place of cents over a divisor of whole units, half away from zero."""
    t = f"((abs({cents}) * 20 + {100 * int(divisor)}::HUGEINT) // {200 * int(divisor)}::HUGEINT)"
    return f"CAST({t} // 10 AS STRING) || CASE WHEN {t} % 10 = 0 THEN '' ELSE '.' || CAST({t} % 10 AS STRING) END"


def _compact(cents: str) -> str:
    sizes = [(10**12, "T"), (10**9, "B"), (10**6, "M"), (10**3, "K")]
    text = "CASE " + " ".join(f"WHEN abs({cents}) >= {100 * d}::HUGEINT THEN {_tenths(cents, str(d))} || '{s}'" for d, s in sizes) + f" ELSE {_tenths(cents, '1')} END"
    return f"CASE WHEN {cents} < 0 THEN '(' || ({text}) || ')' ELSE {text} END"


_NUMBERED = f"SELECT accession, n, CAST({_CENTS} AS HUGEINT) AS c FROM (SELECT accession, CAST(substring(accession, 5) AS BIGINT) AS n FROM own_filings)"


def _numbered(f):
    rows = f.select("accession", F.substring("accession", 5, 10).cast("long").alias("n"))
    cents = F.when(F.col("n") % 2 == 0, -1).otherwise(1) * ((F.col("n") * 7919) % 99991) * F.pow(F.lit(10.0), F.col("n") % 10).cast("long")
    return rows.withColumn("value", (cents.cast("decimal(20,0)") / 100).cast("decimal(24,4)"))


@query("f12_compact_number", "own_filings", f"SELECT accession, {_compact('c')} AS text FROM ({_NUMBERED})")
def _(f):
    return _numbered(f).select("accession", fn.compact_number(F.col("value")).alias("text"))


_MONEY = f"CASE WHEN abs(c) < 100000 THEN '$' || CASE WHEN c < 0 THEN '-' ELSE '' END || CAST(abs(c) // 100 AS STRING) || CASE WHEN abs(c) % 100 = 0 THEN '' WHEN abs(c) % 10 = 0 THEN '.' || CAST(abs(c) % 100 // 10 AS STRING) ELSE '.' || lpad(CAST(abs(c) % 100 AS STRING), 2, '0') END WHEN c < 0 THEN '($' || substring({_compact('c')}, 2) ELSE '$' || {_compact('c')} END"


@query("f13_format_fact_value", "own_filings", f"SELECT accession, {_case('n', [_MONEY, _MONEY, _compact('c'), chr(39) + '-' + chr(39), chr(39) + 'text' + chr(39)])} AS text FROM ({_NUMBERED})")
def _(f):
    rows = _numbered(f)
    value = _pick("n", [F.col("value").cast("string")] * 3 + [F.lit(" "), F.lit("text")])
    unit = _pick("n", [F.lit("USD"), F.lit("usdPerShare"), F.lit("shares"), F.lit("USD"), F.lit("USD")])
    return rows.select("accession", fn.format_fact_value(value, F.lit(False), unit).alias("text"))


@query("f15_clean_text", "parties", "SELECT party, name || ' & \"Co\" · ' || party AS text, CASE WHEN length(repeat(name, 20)) > 320 THEN substring(repeat(name, 20), 1, 320) || '...' ELSE repeat(name, 20) END AS evidence, substring(name, 1, 5) AS short FROM parties")
def _(p):
    marked = F.concat(F.lit("<p class='x'>"), "name", F.lit("</p>\n &amp;&nbsp;&quot;Co&quot; <b>&middot;</b>"), "party")
    return p.select("party", fn.clean_text(marked).alias("text"), fn.evidence_text(F.repeat("name", F.lit(20))).alias("evidence"), fn.truncate_text(F.col("name"), 5).alias("short"))


@query("f15_unescape", "parties", "SELECT party, '<' || name || '> ' || chr(233) || chr(8364) || ' ' || chr(128512) || ' ¬it; &zz; ' || chr(65533) AS text FROM parties")
def _(p):
    return p.select("party", fn.unescape(F.concat(F.lit("&lt;"), "name", F.lit("&gt &eacute;&#x80; &#128512; &notit; &zz; &#xD800;"))).alias("text"))


@query("f32_series_pair", "fx", "SELECT DISTINCT upper(substring(currency, 1, 3)) AS currency, denominator FROM fx WHERE regexp_matches(upper(substring(currency, 1, 3)), '^[A-Z]{3}$')")
def _(x):
    key = fn.fx_series_key(F.substring("currency", 1, 3), F.col("denominator"))
    return x.select(fn.fx_series_pair(key).alias("p")).where("p IS NOT NULL").select("p.*").distinct()


@query("f18_normalize_amendment", "forms", """SELECT sequence, CASE WHEN form LIKE '13F%' THEN CASE sequence % 3 WHEN 0 THEN 'NEW HOLDINGS' WHEN 1 THEN 'RESTATEMENT' ELSE CASE WHEN form LIKE '%/A' THEN 'RESTATEMENT' ELSE '' END END
WHEN form IN ('3/A', '4/A', '5/A') THEN 'CORRECTION' WHEN form LIKE '%/A' AND (form LIKE '%13D%' OR form LIKE '%13G%') THEN 'STATE UPDATE' ELSE '' END AS kind FROM forms""")
def _(e):
    kind = _pick("sequence", [F.lit(" new holding "), F.lit("Restates"), F.lit(None).cast("string")])
    return e.select("sequence", fn.normalize_amendment(kind, F.col("form")).alias("kind"))


@query("f19_normalize_form", "forms", "SELECT sequence, upper(regexp_replace(trim(form), '\\s+', ' ', 'g')) AS form, translate(upper(regexp_replace(trim(form), '\\s+', ' ', 'g')), './ *>', '_____') AS subject FROM forms")
def _(e):
    return e.select("sequence", fn.normalize_form(F.col("form")).alias("form"), fn.subject_for(F.col("form")).alias("subject"))


@query("f20_normalize_ticker", "members", "SELECT cik, ticker || '-A' AS ticker, 'https://www.sec.gov/Archives/edgar/data/' || cik || '/a.txt' AS url, '/edgar/data/' || cik || '/' || ticker || '.txt' AS path, 'edgar/data/' || ltrim(cik, '0') || '/' || ticker || '.txt' AS fallback FROM members")
def _(m):
    href = F.concat(F.lit("http://h/edgar/data/"), "cik", F.lit("/a.txt"))
    return m.select("cik", fn.normalize_ticker(F.concat(F.lower("ticker"), F.lit(".a "))).alias("ticker"), fn.source_url(href).alias("url"), fn.filing_path_from_href(F.concat(href, F.lit("?x/y#z/")), F.col("cik"), F.col("ticker")).alias("path"), fn.filing_path_from_href(F.lit("a.htm"), F.col("cik"), F.col("ticker")).alias("fallback"))


@query("f25_scheduled_through", "own_filings", "SELECT accession, filing_date - CAST(CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END AS INT) AS through FROM (SELECT accession, filing_date, CAST(substring(accession, 5) AS INT) AS n FROM own_filings)")
def _(f):
    """20:59 and 21:01 of the exchange's day, as instants."""
    at = F.when(F.substring("accession", 5, 10).cast("int") % 2 == 0, " 20:59:00").otherwise(" 21:01:00")
    instant = F.to_utc_timestamp(F.concat(F.col("filing_date").cast("string"), at).cast("timestamp"), "America/New_York")
    return f.select("accession", fn.scheduled_through(instant).alias("through"))


_WORDS = ["1", "TRUE", "y", "Yes", "0", "no", None]


@query("f28_parse_boolean", "forms", f"SELECT sequence, {_case('sequence', ['true'] * 4 + ['false'] * 3)} AS yes, {_case('sequence', [f"'{w}'" if w else 'NULL' for w in _WORDS])} AS word FROM forms")
def _(e):
    word = _pick("sequence", [F.lit(f" {w or ''} ") for w in _WORDS])
    return e.select("sequence", fn.parse_boolean(word).alias("yes"), fn.unwrap_value(word).alias("word"))


@query("f35_child_texts", "parties", "SELECT party, name || ',' || party AS joined, upper(name) || '|' || party AS distinct_texts FROM parties")
def _(p):
    texts = F.array(F.concat(F.lit(" "), "name"), F.lit(""), F.col("party"))
    again = F.array(F.col("name"), F.lit(" "), F.upper("name"), F.col("party"))
    return p.select("party", fn.join_child_texts(texts).alias("joined"), F.array_join(fn.distinct_ordered(again), "|").alias("distinct_texts"))


@query("f39_year_range", "filings", "SELECT accession, year(filing_date) AS year, year(filing_date) >= 1996 AS since, year(filing_date) BETWEEN 1995 AND 1997 AS inside, true AS open FROM filings")
def _(f):
    year = fn.year_of(F.col("filing_date").cast("string"))
    return f.select("accession", year.cast("long").alias("year"), fn.in_year_range(year, 1996, 0).alias("since"), fn.in_year_range(year, 1995, 1997).alias("inside"), fn.in_year_range(year, 0, 0).alias("open"))
