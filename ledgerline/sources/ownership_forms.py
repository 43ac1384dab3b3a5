"""Ownership forms as tables: insider forms 3, 4 and 5, and schedules 13D and 13G.

Documents have the columns accession and xml. Covers, people and rows come from `from_xml` under a schema, so they stay
in the JVM; only the nested item texts of schedules need a walk over the tree.
"""

from __future__ import annotations

import sys
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn

_V = "struct<value:string>"
_NATURE = f"ownershipNature:struct<directOrIndirectOwnership:{_V}, natureOfOwnership:{_V}>"
_AFTER = f"postTransactionAmounts:struct<sharesOwnedFollowingTransaction:{_V}>"
_OPTION = f"conversionOrExercisePrice:{_V}, exerciseDate:{_V}, expirationDate:{_V}, underlyingSecurity:struct<underlyingSecurityTitle:{_V}, underlyingSecurityShares:{_V}>"
_HOLDING = f"securityTitle:{_V}, {_AFTER}, {_NATURE}, transactionCoding:struct<transactionFormType:string>, {_OPTION}"
_TRADE = (
    f"securityTitle:{_V}, transactionDate:{_V}, deemedExecutionDate:{_V}, transactionCoding:struct<transactionFormType:string, transactionCode:string, equitySwapInvolved:string>, "
    f"transactionAmounts:struct<transactionShares:{_V}, transactionPricePerShare:{_V}, transactionAcquiredDisposedCode:{_V}>, {_AFTER}, {_NATURE}, {_OPTION}"
)
#: Tables of an insider form in the order in which their rows are numbered: table, element, kind, derivative.
_PARTS = [("nonDerivativeTable", "nonDerivativeHolding", "holding", False), ("nonDerivativeTable", "nonDerivativeTransaction", "transaction", False), ("derivativeTable", "derivativeHolding", "holding", True), ("derivativeTable", "derivativeTransaction", "transaction", True)]
_INSIDER = (
    "issuer struct<issuerCik:string, issuerName:string, issuerTradingSymbol:string>, periodOfReport string, "
    "reportingOwner array<struct<reportingOwnerId:struct<rptOwnerCik:string, rptOwnerName:string>, reportingOwnerRelationship:struct<isDirector:string, isOfficer:string, isTenPercentOwner:string, isOther:string, officerTitle:string>>>, "
    f"nonDerivativeTable struct<nonDerivativeHolding:array<struct<{_HOLDING}>>, nonDerivativeTransaction:array<struct<{_TRADE}>>>, derivativeTable struct<derivativeHolding:array<struct<{_HOLDING}>>, derivativeTransaction:array<struct<{_TRADE}>>>, "
    "footnotes struct<footnote:array<struct<_id:string, _VALUE:string>>>, ownerSignature array<struct<signatureName:string, signatureDate:string>>"
)


def _parsed(documents: DataFrame, schema: str, *more: str) -> DataFrame:
    """Documents with their fields as x. Filters on fields stop at the generator; pushed below it they would parse each document again."""
    x = F.from_xml("xml", F.lit(schema), {"ignoreNamespace": "true"})
    return documents.select("accession", *more, F.inline(F.array(F.struct(x.alias("x")))))


def insider_owners(documents: DataFrame) -> DataFrame:
    """Reporting owners of insider forms with their roles; owner_ordinal from 1 in the order of the form."""
    rows = _parsed(documents, _INSIDER).select("accession", F.posexplode("x.reportingOwner").alias("at", "o"))
    roles = "o.reportingOwnerRelationship"
    flags = {"is_director": "isDirector", "is_officer": "isOfficer", "is_ten_percent": "isTenPercentOwner", "is_other": "isOther"}
    return rows.select(
        "accession", (F.col("at") + 1).alias("owner_ordinal"), fn.unwrap_value(F.col("o.reportingOwnerId.rptOwnerCik")).alias("owner"), fn.unwrap_value(F.col("o.reportingOwnerId.rptOwnerName")).alias("name"),
        *[fn.parse_boolean(F.col(f"{roles}.{x}")).alias(name) for name, x in flags.items()], fn.unwrap_value(F.col(f"{roles}.officerTitle")).alias("officer_title"),
    )


def insider_rows(documents: DataFrame) -> DataFrame:
    """Holdings and transactions of both tables, each row once per owner; row_number runs through the form from 1."""
    x = _parsed(documents, _INSIDER)
    x = x.withColumn("owners", F.transform("x.reportingOwner", lambda o: o["reportingOwnerId"]["rptOwnerCik"]))
    before: Column = F.lit(0)
    out = None
    for table, element, kind, derivative in _PARTS:
        rows = F.coalesce(F.col(f"x.{table}.{element}"), F.array())
        part = x.select("accession", "owners", F.col("x.issuer.issuerCik").alias("issuer"), F.col("x.periodOfReport").alias("report_date"), before.alias("before"), F.posexplode(F.col(f"x.{table}.{element}")).alias("at", "r"))

        def of(path: str, *, trade: bool = False, kind: str = kind) -> Column:
            return fn.unwrap_value(F.col(f"r.{path}")) if not trade or kind == "transaction" else F.lit(None).cast("string")

        part = part.select(
            "accession", "owners", fn.unwrap_value(F.col("issuer")).alias("issuer"), fn.normalize_date(F.col("report_date")).alias("report_date"), (F.col("before") + F.col("at") + 1).alias("row_number"),
            F.lit(kind).alias("kind"), F.lit(derivative).alias("is_derivative"), of("securityTitle.value").alias("security"), of("ownershipNature.directOrIndirectOwnership.value").alias("direct_or_indirect"),
            of("ownershipNature.natureOfOwnership.value").alias("nature"), of("transactionCoding.transactionFormType").alias("form_type"), of("postTransactionAmounts.sharesOwnedFollowingTransaction.value").alias("shares_after"),
            fn.normalize_date(of("transactionDate.value", trade=True)).alias("transaction_date"), of("transactionCoding.transactionCode", trade=True).alias("code"), of("transactionAmounts.transactionShares.value", trade=True).alias("shares"),
            of("transactionAmounts.transactionPricePerShare.value", trade=True).alias("price"), of("transactionAmounts.transactionAcquiredDisposedCode.value", trade=True).alias("acquired_disposed"),
            of("conversionOrExercisePrice.value").alias("exercise_price"), fn.normalize_date(of("exerciseDate.value")).alias("exercise_date"), fn.normalize_date(of("expirationDate.value")).alias("expiration_date"),
            of("underlyingSecurity.underlyingSecurityTitle.value").alias("underlying"), of("underlyingSecurity.underlyingSecurityShares.value").alias("underlying_shares"),
        )
        out = part if out is None else out.unionByName(part)
        before = before + F.size(rows)
    return out.select(F.posexplode("owners").alias("at", "owner"), *[c for c in out.columns if c != "owners"]).withColumn("owner_ordinal", F.col("at") + 1).drop("at")


def insider_notes(documents: DataFrame) -> DataFrame:
    """Footnotes (id, text) and signatures (name, date) of insider forms as lines: accession, kind, key, text."""
    x = _parsed(documents, _INSIDER)
    notes = x.select("accession", F.explode("x.footnotes.footnote").alias("n")).select("accession", F.lit("footnote").alias("kind"), F.col("n._id").alias("key"), F.trim("n._VALUE").alias("text"))
    signed = x.select("accession", F.explode("x.ownerSignature").alias("s")).select("accession", F.lit("signature").alias("kind"), F.trim("s.signatureName").alias("key"), fn.normalize_date(F.col("s.signatureDate")).alias("text"))
    return notes.unionByName(signed)


_PERSON = "reportingPersonCIK:string, reportingPersonName:string, memberOfGroup:string, typeOfReportingPerson:array<string>, fundType:array<string>, aggregateAmountOwned:string, percentOfClass:string, soleVotingPower:string, sharedVotingPower:string, soleDispositivePower:string, sharedDispositivePower:string"
#: The three spellings of the element, in the order in which they count; names that differ in case only are told apart.
_CUSIPS = ["issuerCusipNumber", "issuerCusipCaps", "issuerCusip"]
_SCHEDULE = (
    "headerData struct<submissionType:string>, formData struct<coverPageHeader:struct<securitiesClassTitle:string, dateOfEvent:string, amendmentNo:string, issuerInfo:struct<issuerCIK:string, issuerName:string, "
    + ", ".join(f"{c}:array<string>" for c in _CUSIPS)
    + f">>, reportingPersons:struct<reportingPersonInfo:array<struct<{_PERSON}>>>>"
)


def schedule_reports(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, rejects) of schedules 13D and 13G: one row per reporting person with issuer, security and powers.

    A schedule without an issuer, a cover or persons is rejected with a reason.
    """
    x = _parsed(documents.withColumn("xml", F.replace("xml", F.lit("issuerCUSIP"), F.lit("issuerCusipCaps"))), _SCHEDULE)
    cover = "x.formData.coverPageHeader"
    people = F.col("x.formData.reportingPersons.reportingPersonInfo")
    reason = F.when(F.col(cover).isNull(), "no cover page header").when(F.col(f"{cover}.issuerInfo").isNull(), "no issuer").when(F.coalesce(F.size(people), F.lit(0)) <= 0, "no reporting persons")
    rows = x.withColumn("reason", reason)
    cusips = fn.distinct_ordered(F.concat(*[F.coalesce(F.col(f"{cover}.issuerInfo.{c}"), F.array().cast("array<string>")) for c in _CUSIPS]))
    good = rows.where("reason is null").select(
        "accession", fn.unwrap_value(F.col(f"{cover}.issuerInfo.issuerCIK")).alias("issuer"), fn.unwrap_value(F.col(f"{cover}.issuerInfo.issuerName")).alias("issuer_name"), fn.unwrap_value(F.col(f"{cover}.securitiesClassTitle")).alias("title"),
        fn.normalize_date(F.col(f"{cover}.dateOfEvent")).alias("event_date"), fn.unwrap_value(F.col(f"{cover}.amendmentNo")).alias("amendment_number"), cusips.alias("cusips"), F.posexplode(people).alias("at", "p"),
    )
    plain = {"owner": "reportingPersonCIK", "name": "reportingPersonName", "member_of_group": "memberOfGroup", "shares": "aggregateAmountOwned", "percent": "percentOfClass", "sole_voting": "soleVotingPower", "shared_voting": "sharedVotingPower", "sole_dispositive": "soleDispositivePower", "shared_dispositive": "sharedDispositivePower"}
    reports = good.select(
        *[c for c in good.columns if c not in ("at", "p", "cusips")], (F.col("at") + 1).alias("row_number"), F.get("cusips", F.lit(0)).alias("cusip"), F.slice("cusips", 2, 1000).alias("alternate_cusips"),
        *[fn.unwrap_value(F.col(f"p.{x}")).alias(name) for name, x in plain.items()], fn.join_child_texts(F.coalesce("p.typeOfReportingPerson", F.array())).alias("person_type"), fn.join_child_texts(F.coalesce("p.fundType", F.array())).alias("filer_category"),
    )
    return reports, rows.where("reason is not null").select("accession", "reason")


_NARRATIVE = pa.schema([("accession", pa.string()), ("row_number", pa.int32()), ("item", pa.string()), ("field", pa.string()), ("text", pa.string())])


def item_texts(xml: str) -> list[tuple[str, str, str]]:
    """(item, dotted path, text) of the leaves below a schedule's items; broken XML gives none."""
    try:
        root = ElementTree.fromstring((xml or "").encode())
    except ElementTree.ParseError:
        return []
    found = []
    form = next((n for n in root.iter() if n.tag.rpartition("}")[2] == "formData"), None)
    for item in form if form is not None else ():
        name = item.tag.rpartition("}")[2]
        if not name.startswith("item"):
            continue
        todo = [(item, "")]
        while todo:
            node, path = todo.pop()
            inside = list(node)
            text = (node.text or "").strip()
            if not inside and text:
                found.append((name, path, text))
            todo += [(c, f"{path}.{tag}" if path else tag) for c in reversed(inside) for tag in [c.tag.rpartition("}")[2]]]
    return found


def schedule_narratives(documents: DataFrame) -> DataFrame:
    """accession, row_number, item, field (dotted path), text of schedules, in the order of the document."""

    def run(batches):
        for batch in batches:
            for accession, xml in zip(batch.column(0), batch.column(1), strict=True):  # one document at a time
                rows = [{"accession": accession.as_py(), "row_number": i + 1, "item": a, "field": b, "text": c} for i, (a, b, c) in enumerate(item_texts(xml.as_py()))]
                yield pa.RecordBatch.from_pylist(rows, _NARRATIVE)

    return documents.select("accession", "xml").mapInArrow(run, "accession string, row_number int, item string, field string, text string")


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the repository


_MANAGER = "struct<name:string, form13FFileNumber:string>"
_COVER = (
    "headerData struct<submissionType:string, filerInfo:struct<periodOfReport:string, filer:struct<credentials:struct<cik:string>>>>, "
    "formData struct<coverPage:struct<reportCalendarOrQuarter:string, isAmendment:string, amendmentNo:string, amendmentInfo:struct<amendmentType:string>, filingManager:struct<name:string>, reportType:string, "
    f"otherManagersInfo:struct<otherManager:array<{_MANAGER}>>>, "
    f"summaryPage:struct<tableEntryTotal:string, tableValueTotal:string, otherIncludedManagersCount:string, otherManagers2Info:struct<otherManager2:array<struct<otherManager:{_MANAGER}>>>>>"
)


def holdings_covers(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(covers, rejects) of primary 13F documents (accession, form, xml).

    covers: accession, manager_cik, manager, period, amendment, amendment_type, amendment_number, report_kind, entries, total_value,
    included (as reported), notices (kind, name, file: first the managers that report for this one, then those included). A cover
    without page or manager, or of another type than its submission, is rejected with a reason.
    """
    x = _parsed(documents, _COVER, "form")
    x = x.withColumns({"page": F.col("x.formData.coverPage"), "last": F.col("x.formData.summaryPage"), "head": F.col("x.headerData")})
    kind = fn.normalize_form(F.coalesce("head.submissionType", F.lit("")))
    manager = F.coalesce(F.trim("page.filingManager.name"), F.lit(""))
    reason = F.when(F.col("page").isNull(), "no cover page").when(kind != fn.normalize_form(F.col("form")), "document type differs").when(manager == "", "no filing manager")
    period = F.coalesce(F.nullif(fn.normalize_date(F.col("page.reportCalendarOrQuarter")), F.lit("")), F.nullif(fn.normalize_date(F.col("head.filerInfo.periodOfReport")), F.lit("")))

    def notices(kind: str, managers: Column) -> Column:
        named = F.transform(managers, lambda m: F.struct(F.lit(kind).alias("kind"), F.trim(m["name"]).alias("name"), F.trim(m["form13FFileNumber"]).alias("file")))
        return F.coalesce(named, F.array().cast("array<struct<kind:string, name:string, file:string>>"))

    included = F.filter(F.transform("last.otherManagers2Info.otherManager2", lambda w: w["otherManager"]), lambda m: m.isNotNull())
    out = x.select(
        "accession", reason.alias("reason"), F.trim("head.filerInfo.filer.credentials.cik").alias("manager_cik"), manager.alias("manager"), period.alias("period"), (fn.parse_boolean(F.col("page.isAmendment")) | F.col("form").endswith("/A")).alias("amendment"),
        fn.normalize_amendment(F.col("page.amendmentInfo.amendmentType"), F.col("form")).alias("amendment_type"), F.col("page.amendmentNo").alias("amendment_number"), fn.normalize_form(F.col("page.reportType")).alias("report_kind"),
        F.col("last.tableEntryTotal").alias("entries"), F.col("last.tableValueTotal").alias("total_value"), F.col("last.otherIncludedManagersCount").alias("included"),
        F.concat(notices("reporting", F.col("page.otherManagersInfo.otherManager")), notices("included", included)).alias("notices"),
    )
    missing = (F.col("amendment_type") == "") & F.col("amendment")
    out = out.withColumn("amendment_type", F.when(missing, "RESTATEMENT").otherwise(F.col("amendment_type")))
    return out.where("reason IS NULL").drop("reason"), out.where("reason IS NOT NULL").select("accession", "reason")


def summary_differences(covers: DataFrame, positions: DataFrame) -> DataFrame:
    """accession, entries, found, total_value, found_value: covers whose summary differs from the positions of their tables.

    positions: accession, value. One aggregate by accession, joined once."""
    sums = positions.groupBy("accession").agg(F.count("*").alias("found"), F.sum("value").alias("found_value"))
    said = {c: fn.parse_amount(F.col(c)) for c in ("entries", "total_value")}
    rows = covers.where("entries IS NOT NULL").select("accession", *[v.alias(c) for c, v in said.items()]).join(sums, "accession", "left").na.fill(0, ["found"])
    rows = rows.withColumn("found_value", F.coalesce("found_value", F.lit(0)).cast(rows.schema["total_value"].dataType))
    return rows.where(~F.col("entries").eqNullSafe(F.col("found")) | ~F.col("total_value").eqNullSafe(F.col("found_value"))).select("accession", F.col("entries").cast("long").alias("entries"), "found", F.col("total_value").cast("long").alias("total_value"), F.col("found_value").cast("long").alias("found_value"))
