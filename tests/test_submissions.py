import hashlib
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import facts
from ledgerline.sources import submissions

ENVELOPE = """<SEC-DOCUMENT>a.txt : 20240201
<SEC-HEADER>a.hdr.sgml : 20240201
ACCESSION NUMBER:		0000000001-24-000001
CONFORMED SUBMISSION TYPE:	10-K
PUBLIC DOCUMENT COUNT:		{count}
FILED AS OF DATE:		20240201
COMPANY CONFORMED NAME:	ACME
CENTRAL INDEX KEY:	0000000001
</SEC-HEADER>
<DOCUMENT>
<TYPE>EX-101.INS
<FILENAME>a_htm.xml
<TEXT>
<XBRL>
<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:us-gaap="http://fasb.org/us-gaap/2024" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:x="urn:x" xmlns:iso4217="urn:iso" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
<context id="c1"><entity><identifier scheme="s">1</identifier></entity><period><startDate>2023-01-01</startDate><endDate>2023-12-31</endDate></period></context>
<context id="c2"><entity><identifier scheme="s">1</identifier><segment><xbrldi:explicitMember dimension="x:Axis">x:M</xbrldi:explicitMember></segment></entity><period><instant>2023-12-31</instant></period></context>
<unit id="u1"><measure>iso4217:USD</measure></unit>
<unit id="u2"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>
<us-gaap:Revenues contextRef="c1" unitRef="u1" decimals="-6" id="f1">331839000000</us-gaap:Revenues>
<us-gaap:Assets contextRef="c9" unitRef="u1" decimals="0" id="f2" xsi:nil="true"/>
<us-gaap:Note contextRef="c1" id="f3">R & D</us-gaap:Note>
</xbrl>
</XBRL>
</TEXT>
</DOCUMENT>
</SEC-DOCUMENT>
"""


BODY = ENVELOPE[ENVELOPE.index("<xbrl ") : ENVELOPE.index("</XBRL>")].replace("R & D", "R &amp; D")


def scanned(text, **options):
    return list(submissions.scan_envelope("p", text.encode(), **options))


def test_envelope_to_facts(spark, tmp_path):
    (tmp_path / "a.txt").write_text(ENVELOPE.format(count=1).replace("R & D", "R & l t ; D"))
    (tmp_path / "b.txt").write_text("nothing")
    files = submissions.read_files(spark, str(tmp_path))
    docs = submissions.extract_submissions(spark, str(tmp_path)).cache()
    assert [r.error for r in docs.where("error is not null").collect()] == ["byte 0: unexpected content in start"]
    heads = submissions.submission_headers(files).where("error is null").collect()
    assert [(r.accession, r.form, r.cik, r.company, r.filing_date) for r in heads] == [("0000000001-24-000001", "10-K", "0000000001", "ACME", "20240201")]
    records = submissions.land_records(docs, str(tmp_path / "records")).withColumn("instance", F.lit("i")).cache()
    got = {r.id: r for r in records.where("kind = 'fact'").collect()}
    assert (got["f1"].value, got["f1"].local, got["f1"].namespace) == ("331839000000", "Revenues", "http://fasb.org/us-gaap/2024")
    assert got["f2"].nil and got["f2"].value is None and got["f3"].value == "R < D"
    assert sorted(r.unit for r in records.where("kind = 'unit'").collect()) == ["USD", "USD/shares"]
    assert [(r.id, r.axis, r.member) for r in records.where("kind = 'dimension'").collect()] == [("c2", "x:Axis", "x:M")]
    broken = facts.broken_references(*[records.where(f"kind = '{k}'") for k in ("fact", "context", "unit")])
    assert [(r.ref, r.problem) for r in broken.collect()] == [("c9", "missing context")]
    assert [(r.problem, r.ref, r.n) for r in submissions.reference_errors(records).collect()] == [("missing context", "c9", 1)]
    assert [tuple(r) for r in submissions.file_status(docs, records).collect()] == [("0000000001-24-000001", "partial")]


def test_declared_count_and_broken_instance(spark, tmp_path):
    (tmp_path / "a.txt").write_text(ENVELOPE.format(count=2).replace("</xbrl>", ""))
    docs = submissions.extract_submissions(spark, str(tmp_path)).cache()
    assert docs.where("error = 'document_count: 2 declared, 1 found'").count() == 1
    assert [(r.kind, r.code) for r in submissions.shred_xbrl(docs).collect()] == [("diagnostic", "xbrl_error")]


@pytest.mark.parametrize(
    "change, error",
    [
        (("</SEC-HEADER>\n", ""), "<DOCUMENT> in header"),
        (("</TEXT>\n", ""), "</DOCUMENT> in text"),
        (("<TEXT>\n", ""), "</DOCUMENT> in document"),
        (("</DOCUMENT>\n", ""), "</SEC-DOCUMENT> in written"),
        (("</SEC-DOCUMENT>\n", ""), "truncated in between"),
        (("<SEC-HEADER>", "x\n<SEC-HEADER>"), "unexpected content in opened"),
        (("</XBRL>\n", ""), "unclosed payload wrapper"),
        (("</XBRL>\n", "</XBRL>\nmore\n"), "content after payload wrapper"),
        (("</SEC-DOCUMENT>\n", "</SEC-DOCUMENT>\nmore\n"), "unexpected content in done"),
        (("CONFORMED SUBMISSION TYPE", "OTHER"), "header without accession, CIK or form"),
    ],
)
def test_malformed_envelopes(change, error):
    assert error in scanned(ENVELOPE.format(count=1).replace(*change))[-1]["error"]


def test_ranges_filers_and_marks_inside_text():
    text = ENVELOPE.format(count=1).replace("CENTRAL INDEX KEY:\t0000000001\n", "ITEM INFORMATION: A\nITEM INFORMATION: B\nFILER:\n\tCENTRAL INDEX KEY: 5\n\tCOMPANY CONFORMED NAME: First\nFILER:\n  CENTRAL INDEX KEY: 6\nISSUER:\n CENTRAL INDEX KEY: 7\n")
    text = "\n-----BEGIN PRIVACY-ENHANCED MESSAGE-----\r\nKey\n" + text.replace("<XBRL>\n", "<XBRL>\né <TEXT>\n  <SEC-HEADER>\n") + "\n-----END PRIVACY-ENHANCED MESSAGE-----\n"
    (row,) = scanned(text)
    raw = text.encode()
    assert row["filers"] == [{"cik": "5", "name": "First"}, {"cik": "6", "name": None}] and row["items"] == ["A", "B"] and row["cik"] == "5"
    content = raw[row["content_offset"] : row["content_offset"] + row["content_length"]]
    assert content.decode() == row["body"] and hashlib.sha256(content).hexdigest() == row["content_sha256"]
    assert raw[row["byte_offset"] : row["byte_offset"] + row["byte_length"]].startswith(b"<XBRL>\n") and raw[row["byte_offset"] + row["byte_length"] :].startswith(b"</TEXT>")
    assert scanned(text[: text.index("</SEC-HEADER>") + 14], header_only=True)[0]["cik"] == "5"
    assert scanned("")[0]["error"] == "truncated in start"


def test_a_long_envelope_is_scanned_once():
    many = ENVELOPE.format(count=1).replace("</XBRL>\n", "< / <DOC \n" * 400_000 + "</XBRL>\n")
    began = time.time()
    assert "error" not in scanned(many)[0] and time.time() - began < 20


@pytest.mark.parametrize(
    "change, said",
    [
        (("R &amp; D", "R & a m p ; D"), [("legacy_xbrl_split_entity", 1)]),
        (("</us-gaap:Note>", "< /us-gaap:No\nte>"), [("legacy_xbrl_split_closing_tag", 1)]),
        (("R &amp; D", "R &lt D &gt<!-- --> &gt D"), [("legacy_xbrl_missing_entity_semicolon", 1), ("legacy_xbrl_missing_entity_semicolon", 2)]),
        (("R &amp; D</us-gaap:Note>", "R</DescriptionOfDefinedContributionPensionAndO>"), [("legacy_xbrl_stray_closing_tag", 1)]),
        (("R &amp; D", "R & D"), [("xbrl_error", None)]),
        (("R &amp; D</us-gaap:Note>", "R &lt D</us-gaap:Other>"), [("legacy_xbrl_missing_entity_semicolon", 1), ("xbrl_error", None)]),
        (("<startDate>2023-01-01</startDate>", ""), [("xbrl_error", None)]),
        (("<measure>iso4217:USD</measure></unit>", "</unit>"), [("xbrl_error", None)]),
        (('xsi:nil="true"/>', 'xsi:nil="true">1</us-gaap:Assets>'), [("xbrl_error", None)]),
        (('dimension="x:Axis"', 'dimension="nowhere:Axis"'), [("xbrl_error", None)]),
        (("</xbrl>", "<us-gaap:Tuple/></xbrl>"), [("unsupported_xbrl", None)]),
        (("</xbrl>", "stray</xbrl>"), [("xbrl_error", None)]),
        (("http://www.xbrl.org/2003/instance", "urn:other"), [("xbrl_error", None)]),
        (("", ""), []),
    ],
)
def test_repairs_and_rules_of_instances(change, said):
    body = BODY.replace(*change, 1)
    got = submissions.shred_instance("a", "d", body)
    assert [(r["code"], r.get("replacements")) for r in got if r["kind"] == "diagnostic"] == said
    assert any(r["kind"] == "fact" for r in got) == ("xbrl_error" not in dict(said))


def test_rows_are_handed_on_in_bounded_batches_by_kind():
    schema = submissions._arrow(submissions.RECORD)
    records = submissions.shred_instance("a", "d", BODY)
    batches = list(submissions._batches((r for _ in range(2000) for r in records), schema))
    assert len(batches) < 2000 and max(b.num_rows for b in batches) <= submissions.BATCH_ROWS
    back = [r for b in batches for r in b.to_pylist()]
    by = lambda r: sorted((k, str(v)) for k, v in r.items() if v is not None)
    assert sorted(map(by, back)) == sorted(by(r) for r in records * 2000)
    assert len(list(submissions._batches(({"kind": "fact", "value": "x" * submissions.BATCH_CHARS} for _ in range(3)), schema))) == 3


def test_a_broken_instance_is_told_by_its_root():
    with pytest.raises(submissions.NoInstance):
        submissions._strict("<other><a></other>")
    with pytest.raises(ValueError) as broken:
        submissions._strict(BODY.replace("</xbrl>", ""))
    assert not isinstance(broken.value, submissions.NoInstance)


def test_kinds_are_chosen_from_instances_read_whole():
    whole = submissions.shred_instance("a", "d", BODY)
    for kinds in ({"context", "dimension"}, {"fact"}, {"unit", "diagnostic"}):
        assert submissions.shred_instance("a", "d", BODY, kinds) == [r for r in whole if r["kind"] in kinds]
    broken = BODY.replace("</xbrl>", '<g:X xmlns:g="g" contextRef="c" xmlns:i="http://www.w3.org/2001/XMLSchema-instance" i:nil="true">1</g:X></xbrl>')
    assert submissions.shred_instance("a", "d", broken, {"context", "diagnostic"}) == submissions.shred_instance("a", "d", broken) and submissions.shred_instance("a", "d", broken, {"context"}) == []
