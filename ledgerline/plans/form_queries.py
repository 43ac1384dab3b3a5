"""Registered queries of the ownership forms: documents are written from the tables as XML and shredded again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import ownership_forms
from .queries import query


def _tag(name: str, value: Column | str, *, wrapped: bool = False) -> Column:
    inner = F.concat(F.lit("<value>"), value, F.lit("</value>")) if wrapped else (F.col(value) if isinstance(value, str) else value)
    return F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows by accession in the session's number of tasks. A given number is not merged by size: the rows are small, but the
    documents made of them are costly to parse."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "accession")


def _insider_forms(h: DataFrame, t: DataFrame) -> DataFrame:
    """One form per accession: its holdings, then its transactions, both tables, two owners, a note and a signature."""
    held = h.select("accession", "row_number", "security", "is_derivative", "direct_or_indirect", F.col("amount").alias("after"), F.lit("").alias("day"), F.lit(0).alias("kind"))
    traded = t.select("accession", "row_number", "security", "is_derivative", "direct_or_indirect", F.col("shares_after").alias("after"), F.col("transaction_date").alias("day"), F.lit(1).alias("kind"))
    rows = held.unionByName(traded)
    element = F.concat(F.when(F.col("is_derivative"), "derivative").otherwise("nonDerivative"), F.when(F.col("kind") == 0, "Holding").otherwise("Transaction"))
    body = F.concat(
        _tag("securityTitle", F.col("security"), wrapped=True), _tag("transactionDate", F.col("day"), wrapped=True), F.lit("<postTransactionAmounts>"), _tag("sharesOwnedFollowingTransaction", F.col("after"), wrapped=True),
        F.lit("</postTransactionAmounts><ownershipNature>"), _tag("directOrIndirectOwnership", F.col("direct_or_indirect"), wrapped=True), F.lit("</ownershipNature>"), F.when(F.col("is_derivative"), _tag("expirationDate", F.lit("2030-01-31"), wrapped=True)).otherwise(""),
    )
    rows = rows.withColumn("x", F.concat(F.lit("<"), element, F.lit(">"), body, F.lit("</"), element, F.lit(">")))

    def table(derivative: bool) -> Column:
        mine = F.array_sort(F.collect_list(F.when(F.col("is_derivative") == derivative, F.struct("kind", "row_number", "x"))))
        return F.array_join(F.transform(mine, lambda r: r["x"]), "")

    forms = _dealt(rows).groupBy("accession").agg(table(False).alias("plain"), table(True).alias("options"))
    owner = "<reportingOwner><reportingOwnerId><rptOwnerCik>{0}</rptOwnerCik><rptOwnerName>Owner {0}</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>{1}</isDirector><officerTitle>CFO</officerTitle></reportingOwnerRelationship></reportingOwner>"
    head = "<ownershipDocument><periodOfReport>2024-03-31</periodOfReport><issuer><issuerCik>77</issuerCik></issuer>" + owner.format(1, "true") + owner.format(2, "0")
    tail = "<footnotes><footnote id='F1'>one</footnote></footnotes><ownerSignature><signatureName>A B</signatureName><signatureDate>04/01/2024</signatureDate></ownerSignature></ownershipDocument>"
    return forms.select("accession", F.concat(F.lit(head + "<nonDerivativeTable>"), "plain", F.lit("</nonDerivativeTable><derivativeTable>"), "options", F.lit("</derivativeTable>" + tail)).alias("xml"))


_ROWS = """, r AS (SELECT accession, row_number, security, is_derivative, direct_or_indirect, amount AS after, '' AS day, 'holding' AS kind FROM holdings UNION ALL SELECT accession, row_number, security, is_derivative, direct_or_indirect, shares_after, transaction_date, 'transaction' FROM transactions)"""


@query("s10_insider_rows", "holdings transactions", """SELECT accession, row_number() OVER (PARTITION BY accession, o.owner ORDER BY is_derivative, kind, row_number) AS row_number, owner, kind, is_derivative, security, direct_or_indirect, nullif(after, '') AS shares_after,
CASE WHEN kind = 'transaction' THEN nullif(day, '') END AS transaction_date, CASE WHEN is_derivative THEN '2030-01-31' END AS expiration_date FROM r, (VALUES ('1'), ('2')) AS o(owner)""", ctes=_ROWS)
def _(h, t):
    rows = ownership_forms.insider_rows(_insider_forms(h, t))
    return rows.select("accession", F.col("row_number").cast("long").alias("row_number"), "owner", "kind", "is_derivative", "security", "direct_or_indirect", "shares_after", F.nullif("transaction_date", F.lit("")).alias("transaction_date"), "expiration_date")


@query("s10_insider_owners", "holdings transactions", "SELECT DISTINCT accession, owner, 'Owner ' || owner AS name, owner = '1' AS is_director, 'CFO' AS officer_title FROM r, (VALUES ('1'), ('2')) AS o(owner)", ctes=_ROWS)
def _(h, t):
    return ownership_forms.insider_owners(_insider_forms(h, t)).select("accession", "owner", "name", "is_director", "officer_title")


@query("s10_insider_notes", "holdings transactions", "SELECT DISTINCT accession, kind, key, text FROM (SELECT accession FROM r), (VALUES ('footnote', 'F1', 'one'), ('signature', 'A B', '2024-04-01')) AS n(kind, key, text)", ctes=_ROWS)
def _(h, t):
    return ownership_forms.insider_notes(_insider_forms(h, t))


def _schedules(r: DataFrame) -> DataFrame:
    """One schedule per accession of the reports, persons in row order; rows of issuer 0 have no issuer."""
    person = F.concat(F.lit("<reportingPersonInfo>"), _tag("reportingPersonCIK", "owner"), _tag("percentOfClass", "percent"), F.lit("<typeOfReportingPerson>IN</typeOfReportingPerson><typeOfReportingPerson> HC </typeOfReportingPerson></reportingPersonInfo>"))
    forms = _dealt(r).groupBy("accession").agg(F.min("issuer").alias("issuer"), F.array_sort(F.collect_list(F.struct("row_number", "owner", "security", person.alias("x")))).alias("p"))
    issuer = F.when(F.col("issuer") == "1", "").otherwise(F.concat(F.lit("<issuerInfo>"), _tag("issuerCIK", "issuer"), F.lit("<issuerCusip> p7 </issuerCusip><issuerCUSIP>P8</issuerCUSIP></issuerInfo>")))
    return forms.select("accession", F.concat(
        F.lit("<edgarSubmission xmlns='http://x'><formData><coverPageHeader><dateOfEvent>03/31/2024</dateOfEvent>"), issuer, F.lit("</coverPageHeader><reportingPersons>"), F.array_join(F.transform("p", lambda x: x["x"]), ""),
        F.lit("</reportingPersons><items/><item4><purpose>hold</purpose><more><deep>"), F.col("issuer"), F.lit("</deep></more></item4></formData></edgarSubmission>"),
    ).alias("xml"))


@query("s12_schedule_reports", "reports", """SELECT accession, row_number() OVER (PARTITION BY accession ORDER BY r.row_number, owner, security) AS row_number, i AS issuer, owner, percent, '2024-03-31' AS event_date, 'P8' AS cusip, 'IN,HC' AS person_type
FROM reports r JOIN (SELECT accession, min(issuer) AS i FROM reports GROUP BY accession) m USING (accession) WHERE i <> '1'""")
def _(r):
    reports, _rejects = ownership_forms.schedule_reports(_schedules(r))
    return reports.select("accession", F.col("row_number").cast("long").alias("row_number"), "issuer", "owner", "percent", "event_date", "cusip", "person_type")


@query("s12_schedule_rejects", "reports", "SELECT accession, 'no issuer' AS reason FROM reports GROUP BY accession HAVING min(issuer) = '1'")
def _(r):
    return ownership_forms.schedule_reports(_schedules(r))[1]


@query("s12_narratives", "reports", "SELECT accession, row_number, 'item4' AS item, field, CASE row_number WHEN 1 THEN 'hold' ELSE i END AS text FROM (SELECT accession, min(issuer) AS i FROM reports GROUP BY accession), (VALUES (1, 'purpose'), (2, 'more.deep')) AS n(row_number, field)")
def _(r):
    return ownership_forms.schedule_narratives(_schedules(r))


def _covers(p: DataFrame) -> DataFrame:
    """One primary document per accession: every third is an amendment without a type, every fifth has no manager, every seventh counts wrong."""
    n = F.right("accession", F.lit(6)).cast("int")
    forms = _dealt(p.select("accession", "period")).groupBy("accession").agg(F.count("*").alias("entries"), F.min("period").alias("period"))
    head = F.concat(F.lit("<edgarSubmission xmlns='urn:13f'><headerData><submissionType>"), F.col("form"), F.lit("</submissionType><filerInfo><periodOfReport>12-31-1990</periodOfReport><filer><credentials><cik>0000000077</cik></credentials></filer></filerInfo></headerData><formData><coverPage>"))
    manager = F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("<filingManager><name> Manager "), n.cast("string"), F.lit(" </name></filingManager>")))
    page = F.concat(_tag("reportCalendarOrQuarter", F.date_format("period", "MM-dd-yyyy")), F.lit("<isAmendment>"), (n % 3 == 0).cast("string"), F.lit("</isAmendment><amendmentNo>2</amendmentNo>"), manager, F.lit("<reportType>13F  holdings report</reportType><otherManagersInfo><otherManager><form13FFileNumber>28-1</form13FFileNumber><name>First</name></otherManager></otherManagersInfo></coverPage>"))
    last = F.concat(F.lit("<summaryPage>"), _tag("otherIncludedManagersCount", F.lit("2")), _tag("tableEntryTotal", (F.col("entries") + (n % 7 == 0).cast("int")).cast("string")), _tag("tableValueTotal", F.format_number(F.col("entries") * 1000, 0)), F.lit("<otherManagers2Info><otherManager2><sequenceNumber>1</sequenceNumber><otherManager><name>Second</name></otherManager></otherManager2><otherManager2><sequenceNumber>2</sequenceNumber></otherManager2></otherManagers2Info></summaryPage></formData></edgarSubmission>"))
    forms = forms.withColumn("form", F.when(n % 3 == 0, "13F-HR/A").otherwise("13F-HR"))
    return forms.select("accession", "form", F.concat(head, page, last).alias("xml"))


_COVERS = ", c AS (SELECT accession, CAST(right(accession, 6) AS INT) AS n, count(*) AS entries, min(period) AS period FROM positions GROUP BY accession)"


@query("s11_covers", "positions", "SELECT accession, '0000000077' AS manager_cik, 'Manager ' || n AS manager, CAST(period AS STRING) AS period, n % 3 = 0 AS amendment, CASE WHEN n % 3 = 0 THEN 'RESTATEMENT' ELSE '' END AS amendment_type, '13F HOLDINGS REPORT' AS report_kind, 'reporting:First:28-1|included:Second:' AS notices FROM c WHERE n % 5 <> 0", ctes=_COVERS)
def _(p):
    said = F.array_join(F.transform("notices", lambda m: F.concat_ws(":", m["kind"], m["name"], F.coalesce(m["file"], F.lit("")))), "|")
    return ownership_forms.holdings_covers(_covers(p))[0].select("accession", "manager_cik", "manager", "period", "amendment", "amendment_type", "report_kind", said.alias("notices"))


@query("s11_cover_rejects", "positions", "SELECT accession, 'no filing manager' AS reason FROM c WHERE n % 5 = 0", ctes=_COVERS)
def _(p):
    return ownership_forms.holdings_covers(_covers(p))[1]


@query("s11_summary_differences", "positions", "SELECT accession, entries + 1 AS entries, entries AS found, entries * 1000 AS total_value, entries * 1000 AS found_value FROM c WHERE n % 5 <> 0 AND n % 7 = 0", ctes=_COVERS)
def _(p):
    covers = ownership_forms.holdings_covers(_covers(p))[0]
    return ownership_forms.summary_differences(covers, p.select("accession", F.lit(1000).cast("decimal(24,4)").alias("value")))
