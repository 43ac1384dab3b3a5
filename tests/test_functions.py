import pytest
import html
from html.entities import html5

from pyspark.sql import functions as F

from ledgerline.functions import scalars as fn
from ledgerline.operators import predicates


@pytest.fixture(scope="module")
def one(spark):
    return lambda *columns: spark.range(1).select(*columns).first()


def test_classify_period(spark):
    rows = [
        (None, "2024-10-01", "2024-12-31", "2024-12-31", "Quarterly", "Q4 FY2024"),
        (None, "2024-07-01", "2024-12-31", "2024-12-31", "Year to date", "YTD FY2024"),
        (None, "2024-04-01", "2024-12-31", "2024-12-31", "Year to date", "YTD FY2024"),
        ("2024-12-31", None, None, "2024-12-31", "Instant", "2024-12-31"),
        (None, "2023-07-01", "2023-09-30", "2024-06-30", "Quarterly", "Q1 FY2024"),
        (None, "2025-07-01", "2026-06-30", "2026-06-30", "Fiscal year", "FY2026"),
        (None, "2024-12-31", "2024-10-01", "2024-12-31", None, None),
        (None, "2024-12-01", "2024-12-31", None, None, None),
    ]
    df = spark.createDataFrame(rows, "i string, s string, e string, r string, g string, k string")
    got = df.select(fn.classify_period(*[F.col(c).cast("date") for c in "iser"]).alias("p"), "g", "k").collect()
    for row in got:
        assert (row.p and row.p["group"], row.p and row.p["key"]) == (row.g, row.k)


def test_ciks_and_dates(one):
    row = one(
        fn.canonical_cik(F.lit(" 320193 ")), fn.canonical_cik(F.lit("12345678901")), fn.canonical_cik(F.lit("x"), keep_invalid=True), fn.bare_cik(F.lit("0000320193")), fn.bare_cik(F.lit("000")),
        fn.accession_from_path(F.lit("edgar/data/1/0000320193-24-000123.txt")), fn.accession_from_path(F.lit("a/000032019324000123")), fn.accession_from_path(F.lit("a/b.txt")),
        F.date_format(fn.parse_date(F.lit("20240229")), "yyyy-MM-dd"), fn.parse_date(F.lit("2024-02-30")), fn.normalize_date(F.lit("02/03/2024")), fn.normalize_date(F.lit(" soon ")),
    )
    assert list(row) == ["0000320193", None, "x", "320193", "0", "0000320193-24-000123", "0000320193-24-000123", None, "2024-02-29", None, "2024-02-03", "soon"]


def test_numbers(one):
    row = one(
        fn.compact_number(F.lit(331839000000).cast("decimal(24,4)")), fn.compact_number(F.lit(-1500).cast("decimal(24,4)")), fn.compact_number(F.lit(2000000).cast("decimal(24,4)")),
        fn.ratio_string(F.lit("1"), F.lit("3"), F.lit("percent")), fn.ratio_string(F.lit("5"), F.lit("2"), F.lit("multiple")), fn.ratio_string(F.lit("1"), F.lit("0"), F.lit("percent")),
        fn.precision_score(F.lit("INF"), F.lit(None).cast("string")), fn.precision_score(F.lit("x"), F.lit("4")), fn.precision_score(F.lit(None).cast("string"), F.lit("")),
        fn.decimals_tolerance(F.lit("-3")).cast("double"), fn.decimals_tolerance(F.lit("2")).cast("double"), fn.decimals_tolerance(F.lit("INF")).cast("double"),
        fn.retry_delay_minutes(F.lit(1)), fn.retry_delay_minutes(F.lit(9)),
    )
    assert list(row) == ["331.8B", "(1.5K)", "2M", "33.33%", "2.50x", None, 2147483647, 4, -2147483647, 500.0, 0.005, 0.0, 1, 64]


def test_texts(one):
    row = one(
        fn.clean_text(F.lit("<p>A &amp; B</p>\n <b>C</b>")), fn.normalize_form(F.lit(" sc  13d/a ")), fn.subject_for(F.lit("10-k/a")), fn.normalize_ticker(F.lit("brk.b ")), fn.source_url(F.lit("x/edgar/data/1/a.txt")),
        fn.dividend_year(F.lit("March 3, 2024")), fn.history_year(F.lit("FY2023")), fn.history_year(F.lit("Q1 FY2023")), fn.parse_boolean(F.lit(" Yes ")), fn.parse_boolean(F.lit(None).cast("string")),
        fn.normalize_amendment(F.lit("new holding"), F.lit("13F-HR/A")), fn.normalize_amendment(F.lit(None).cast("string"), F.lit("13F-HR/A")), fn.normalize_amendment(F.lit(""), F.lit("4/A")), fn.normalize_amendment(F.lit(""), F.lit("SCHEDULE 13D/A")),
        fn.join_child_texts(F.array(F.lit(" a "), F.lit(""), F.lit("b"))), fn.distinct_ordered(F.array(F.lit("b"), F.lit("A"), F.lit(" B "))),
    )
    assert list(row) == ["A & B C", "SC 13D/A", "10-K_A", "BRK-B", "https://www.sec.gov/Archives/edgar/data/1/a.txt", "2024", "2023", "", True, False, "NEW HOLDINGS", "RESTATEMENT", "CORRECTION", "STATE UPDATE", "a,b", ["B", "A"]]


def test_scheduled_through_follows_daylight_saving(spark):
    rows = [("2024-07-02 00:59:00", "2024-06-30"), ("2024-07-02 01:00:00", "2024-07-01"), ("2024-01-02 01:59:00", "2023-12-31"), ("2024-01-02 02:00:00", "2024-01-01")]
    df = spark.createDataFrame(rows, "t string, d string").withColumn("got", fn.scheduled_through(F.col("t").cast("timestamp")).cast("string"))
    assert all(r.d == r.got for r in df.collect())


def test_units(spark):
    m = "array<struct<ns:string,local:string>>"
    usd, share = [("http://www.xbrl.org/2003/iso4217", "usd")], [("x", "Share")]
    rows = [(usd, [], []), (None, usd, share), ([("x", "pure")], None, None), ([("ns", "barrel")], [], []), ([("", "EUR")], [], []), ([("i", "EUR")], [], []), ([], usd, []), (None, None, None), (usd + share, [], [])]
    df = spark.createDataFrame([(*r, f"u{i}") for i, r in enumerate(rows)], f"m {m}, n {m}, d {m}, id string").orderBy("id")
    got = [r[0] for r in df.select(fn.normalize_unit(*[F.col(c) for c in ("m", "n", "d", "id")])).collect()]
    assert got == ["USD", "USD/shares", "pure", "ns#barrel", "EUR", "i#EUR", "unknown:u6", "unknown:u7", "USD*shares"]


def test_display_values(one):
    def shown(value, unit, nil=False):
        return fn.format_fact_value(F.lit(value), F.lit(nil), F.lit(unit))

    row = one(shown("1,234.5", "USD"), shown("-1500", "USD"), shown("-5.25", "USD"), shown("12.34", "shares"), shown("12.345", "USD/shares"), shown("2000000", "shares"), shown("x", "USD"), shown(" ", "USD"), shown("5", "USD", True), shown("0", "usdPerShare"), shown("999.96", "pure"))
    assert list(row) == ["$1.2K", "($1.5K)", "$-5.25", "12.3", "$12.35", "2M", "x", "-", "-", "$0", "1000"]


def test_namespaces_and_links(one):
    row = one(*[fn.namespace_matches(F.lit(n), F.lit("us-gaap")) for n in ("http://fasb.org/us-gaap/2024", "urn:x/us-gaap:2009", "http://fasb.org/srt/2024", "us-gaap")], fn.namespace_matches(F.lit("x/dei/y"), F.lit("dei")), fn.namespace_matches(F.lit("x"), F.lit("any")),
              *[fn.filing_path_from_href(F.lit(h), F.lit("0000000012"), F.lit("acc")) for h in ("https://h/Archives/edgar/data/1/a-index.htm?x=1#b", "https://h/", "/Archives/x.htm", None)], fn.unwrap_value(F.lit("  ")), fn.unwrap_value(F.lit(" 1 ")))
    assert list(row) == [True, True, False, False, True, True, "edgar/data/1/acc.txt", "/acc.txt", "edgar/data/12/acc.txt", "edgar/data/12/acc.txt", None, "1"]


def test_unescape_knows_every_name(spark):
    texts = [f"&{name} x" for name in html5] + ["&#65;&#x41;&#X41 &#65b &#128;&#x9F; &#0; &#55296; &#1114112; &#99999999999999999999999; &", "a&b &amp;amp; &notin; &notit; &unknown; &;", "no reference", "", "&ampx &AMP;&lt&gt"]
    got = {r.t: r.u for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.unescape(F.col("t")).alias("u")).collect()}
    assert {t: got[t] for t in texts} == {t: html.unescape(t) for t in texts}
    assert spark.range(1).select(fn.clean_text(F.lit("<p>a&nbsp;&#8195;b&mdash;<b>c</b>&hellip;</p>"))).first()[0] == "a b— c …"


def test_series_pairs(one):
    row = one(fn.fx_series_pair(F.lit("D.USD.EUR.SP00.A")), fn.fx_series_pair(F.lit("M.USD.EUR.SP00.A")), fn.fx_series_pair(F.lit("D.USDX.EUR.SP00.A")), fn.unwrap_value(F.lit("text"), F.lit(" value ")), fn.unwrap_value(F.lit(" text"), F.lit(" ")))
    assert list(row) == [("USD", "EUR"), None, None, "value", "text"]


def test_validate_batch_sets_bad_rows_apart(spark):
    prices = spark.sql("SELECT 's' AS security, date '2024-01-02' AS date, CAST(NULL AS DOUBLE) AS open, 1.0D AS close, 1.0D AS adjusted_close UNION ALL SELECT 's', date '2024-01-03', 1.0D, double('NaN'), 1.0D")
    actions = spark.sql("SELECT 's' AS security, 'a' AS source_id, date '2024-01-02' AS date, 'dividend' AS action_type, 1.0D AS amount, 2.0D AS numerator, CAST(NULL AS DOUBLE) AS denominator")
    valid, rejects = predicates.validate_batch(prices, actions, "2024-01-01", "2024-01-31")
    assert valid.count() == 1 and sorted(r.reason for r in rejects.collect()) == ["invalid close", "invalid dividend"]
