"""Submission envelopes and the facts inside their instances.

An envelope is scanned as bytes: the lines that carry its structure are found by one pattern and walked by a table of
states, so that documents are byte ranges of the file and only one of them is decoded at a time. Instances are shredded
strictly; an instance that breaks gets its known defects repaired in a copy and is tried once more. Only this parsing is
Python, in Arrow batches; rows leave it typed and everything after is a Spark plan.
"""

from __future__ import annotations

import hashlib
import io
import re
import sys
from collections.abc import Collection, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = "path string, accession string, form string, cik string, company string, filing_date string, report_date string, items array<string>, filers array<struct<cik:string,name:string>>, declared int, error string"
DOCUMENT = "path string, accession string, form string, cik string, company string, filing_date string, report_date string, items array<string>, filers array<struct<cik:string,name:string>>, declared int, position int, type string, sequence string, name string, description string, role string, byte_offset bigint, byte_length bigint, content_offset bigint, content_length bigint, content_sha256 string, body string, error string"
RECORD = "accession string, document string, kind string, id string, namespace string, local string, value string, context_ref string, unit_ref string, decimals string, precision string, language string, nil boolean, structured boolean, entity string, scheme string, instant string, start_date string, end_date string, forever boolean, unit string, axis string, member string, typed boolean, code string, replacements int, message string"

_XBRL, _LINK = "{http://www.xbrl.org/2003/instance}", "{http://www.xbrl.org/2003/linkbase}"
_DIMENSION, _XSI, _XML = "{http://xbrl.org/2006/xbrldi}", "{http://www.w3.org/2001/XMLSchema-instance}", "{http://www.w3.org/XML/1998/namespace}"
#: Inline documents name one of these (fixed values).
_INLINE = (b"http://www.xbrl.org/2013/inlineXBRL", b"http://www.xbrl.org/2008/inlineXBRL")

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<struct<cik:string,name:string>>": pa.list_(pa.struct([("cik", pa.string()), ("name", pa.string())]))}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


#: Rows and characters of text that one Arrow batch takes before it is handed on.
BATCH_ROWS, BATCH_CHARS = 4096, 4_000_000


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in bounded batches, those of one kind together: columns that no row of a batch has are nulls made at once."""

    def whole(held: dict) -> Iterator[pa.RecordBatch]:
        for mine in held.values():
            said = set().union(*mine)
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in mine], f.type) if f.name in said else pa.nulls(len(mine), f.type) for f in schema], schema=schema)

    held: dict[str | None, list[dict]] = {}
    n = chars = 0
    for row in rows:
        held.setdefault(row.get("kind"), []).append(row)
        n, chars = n + 1, chars + len(row.get("body") or row.get("value") or "")
        if n >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield from whole(held)
            held, n, chars = {}, 0, 0
    yield from whole(held)


#: A line that is nothing but a mark of structure; the marks of file and header may have text behind them (fixed values).
_MARK = re.compile(rb"(?m)^[ \t]*(?:(<SEC-DOCUMENT>|<SEC-HEADER>)[^\n]*|(</SEC-HEADER>|<DOCUMENT>|</DOCUMENT>|<TEXT>|</TEXT>|</SEC-DOCUMENT>|-----BEGIN PRIVACY-ENHANCED MESSAGE-----|-----END PRIVACY-ENHANCED MESSAGE-----)[ \t\r]*)(?:\n|\Z)")
#: Where each mark leads from each state; a mark that is missing here breaks the envelope.
_STEPS = {
    ("start", b"-----BEGIN PRIVACY-ENHANCED MESSAGE-----"): "privacy",
    ("start", b"<SEC-DOCUMENT>"): "opened",
    ("privacy", b"<SEC-DOCUMENT>"): "opened",
    ("opened", b"<SEC-HEADER>"): "header",
    ("header", b"</SEC-HEADER>"): "between",
    ("between", b"<DOCUMENT>"): "document",
    ("document", b"<TEXT>"): "text",
    ("text", b"</TEXT>"): "written",
    ("written", b"</DOCUMENT>"): "between",
    ("between", b"</SEC-DOCUMENT>"): "done",
    ("done", b"-----END PRIVACY-ENHANCED MESSAGE-----"): "done",
}
#: In these states anything but marks and blanks breaks the envelope.
_BARE = {"start", "opened", "between", "written", "done"}
#: Marks that are plain text in a state; all others end what is open.
_PLAIN = {"header": {b"<TEXT>", b"</TEXT>", b"</DOCUMENT>", b"<SEC-DOCUMENT>", b"<SEC-HEADER>"}, "text": {b"<TEXT>", b"<SEC-DOCUMENT>", b"<SEC-HEADER>", b"</SEC-HEADER>"}, "document": {b"</TEXT>", b"<SEC-DOCUMENT>", b"<SEC-HEADER>", b"</SEC-HEADER>"}}
_TAG = re.compile(rb"(?m)^[ \t]*<(TYPE|SEQUENCE|FILENAME|DESCRIPTION)>([^\r\n]*)")
_WRAPPER = re.compile(rb"\s*^[ \t]*<(XML|XBRL)>[ \t\r]*(?:\n|\Z)", re.M)


class Malformed(ValueError):
    """What breaks an envelope, with its place in bytes."""


def _states(content: bytes) -> Iterator[tuple[str, int, int]]:
    """(state, start, end) of the stretches between marks, in order; ends in Malformed where the envelope breaks."""
    state, at = "start", 0
    for mark in _MARK.finditer(content):
        name = mark[1] or mark[2]
        if state == "privacy" and name != b"<SEC-DOCUMENT>" or name in _PLAIN.get(state, ()) or b"PRIVACY" in name and state not in ("start", "done"):
            continue
        if state in _BARE and content[at : mark.start()].strip():
            break
        to = _STEPS.get((state, name))
        if to is None:
            raise Malformed(f"byte {mark.start()}: {name.decode()} in {state}")
        yield state, at, mark.start()
        state, at = to, mark.end()
    if state in _BARE and content[at:].strip():
        raise Malformed(f"byte {at}: unexpected content in {state}")
    if state != "done":
        raise Malformed(f"truncated in {state}")


def read_header(raw: bytes) -> dict:
    """Fields of a header; filers are the blocks under FILER:, which end at the next label that is not indented."""
    out: dict = {"items": [], "filers": [], "declared": None}
    names = {"ACCESSION NUMBER": "accession", "CONFORMED SUBMISSION TYPE": "form", "FILED AS OF DATE": "filing_date", "CONFORMED PERIOD OF REPORT": "report_date"}
    open_ = None
    for line in raw.decode("utf-8", "replace").splitlines():
        bare = line.strip()
        key, colon, value = bare.partition(":")
        value = value.strip()
        if bare == "FILER:":
            open_ = {"cik": None, "name": None}
            out["filers"].append(open_)
        elif line.rstrip() == bare and bare.endswith(":"):
            open_ = None
        if not colon:
            continue
        if key in names:
            out[names[key]] = value
        elif key == "ITEM INFORMATION":
            out["items"].append(value)
        elif key == "PUBLIC DOCUMENT COUNT":
            out["declared"] = int(value) if value.isdigit() and len(value) < 10 else -1
        elif key == "CENTRAL INDEX KEY":
            out.setdefault("cik", value)
            if open_:
                open_["cik"] = value
        elif key == "COMPANY CONFORMED NAME":
            out.setdefault("company", value)
            if open_:
                open_["name"] = value
    if out["filers"]:
        out["cik"], out["company"] = out["filers"][0]["cik"], out["filers"][0]["name"]
    if not all(out.get(k) for k in ("accession", "cik", "form")):
        raise Malformed("header without accession, CIK or form")
    return out


def _content(content: bytes, start: int, end: int) -> tuple[int, int]:
    """Range of a document's text without its wrapper."""
    wrapper = _WRAPPER.match(content, start, end)
    if not wrapper:
        return start, end
    closing = re.compile(rb"(?m)^[ \t]*</" + wrapper[1] + rb">[ \t\r]*(?:\n|\Z)").search(content, wrapper.end(), end)
    if not closing:
        raise Malformed(f"byte {end}: unclosed payload wrapper")
    if content[closing.end() : end].strip():
        raise Malformed(f"byte {closing.end()}: content after payload wrapper")
    return wrapper.end(), closing.start()


def scan_envelope(path: str, content: bytes, *, header_only: bool = False) -> Iterator[dict]:
    """Rows of one envelope, one document at a time; what breaks it is the last row, with the fields read so far."""
    common: dict = {"path": path}
    found, tags = 0, {}
    try:
        for state, start, end in _states(content):
            if state == "header":
                common |= read_header(content[start:end])
                if header_only:
                    yield common
                    return
            elif state == "document":
                tags = {k.decode(): v.decode("utf-8", "replace").strip() for k, v in _TAG.findall(content, start, end)}
            elif state == "text":
                first, last = _content(content, start, end)
                text = content[first:last]
                inline = any(x in content[start:end] for x in _INLINE)
                yield common | {
                    "position": found, "type": tags.get("TYPE"), "sequence": tags.get("SEQUENCE"), "name": tags.get("FILENAME"), "description": tags.get("DESCRIPTION"),
                    "role": "inline_xbrl" if inline else "attachment", "byte_offset": start, "byte_length": end - start, "content_offset": first, "content_length": last - first,
                    "content_sha256": hashlib.sha256(text).hexdigest(), "body": text.decode("utf-8", "replace"),
                }
                found += 1
    except Malformed as e:
        yield common | {"error": str(e)}
        return
    if common.get("declared") not in (None, found):
        yield common | {"error": f"document_count: {common['declared']} declared, {found} found"}
    elif not found:
        yield common | {"error": "no documents"}


def read_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, content of envelope files."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def _scan(files: DataFrame, ddl: str, header_only: bool) -> DataFrame:
    def run(batches):
        files = (x for batch in batches for x in zip(batch.column(0), batch.column(1), strict=True))
        rows = (row for path, content in files for row in scan_envelope(path.as_py(), content.as_py() or b"", header_only=header_only))
        return _batches(rows, _arrow(ddl))

    return files.select("path", "content").mapInArrow(run, ddl)


def scan_submissions(files: DataFrame) -> DataFrame:
    """One row per document of every envelope (path, content): the header's fields, byte ranges and digest of the text, and
    the text without its wrapper. A malformed envelope ends in a row with an error and its byte; a declared count that differs
    is a row with an error too. A null content is an empty file."""
    return _scan(files, DOCUMENT, False)


def extract_submissions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """scan_submissions over landed files."""
    return scan_submissions(read_files(spark, paths))


def submission_headers(files: DataFrame) -> DataFrame:
    """Header of every envelope (path, content); the scan stops behind it, so later faults don't matter."""
    return _scan(files, HEADER, True)


def source_digests(files: DataFrame) -> DataFrame:
    """path, bytes, sha256 of whole files."""
    return files.select("path", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


# Instances.


def _measures(parent: ElementTree.Element, prefixes: dict[str, str]) -> str:
    """Names of a unit's measures as scalars.normalize_unit gives them."""
    named = []
    for m in parent.findall(f"{_XBRL}measure"):
        space, local = _qname(m.text, prefixes)
        plain = {"usd": "USD", "shares": "shares", "share": "shares", "pure": "pure"}.get(local.lower())
        named.append(plain or (f"{space}#{local}" if space else local))
    if not named:
        raise ValueError("unit missing measures")
    return "*".join(named)


def _qname(text: str | None, prefixes: dict[str, str]) -> tuple[str, str]:
    prefix, colon, local = (text or "").strip().rpartition(":")
    if not local or colon and prefix not in prefixes:
        raise ValueError(f"unknown name {(text or '').strip()!r}")
    return prefixes.get(prefix, "") if colon else prefixes.get("", ""), local


def _context(node: ElementTree.Element, prefixes: dict[str, str]) -> Iterator[dict]:
    entity, period = node.find(f"{_XBRL}entity"), node.find(f"{_XBRL}period")
    if not node.get("id") or entity is None or period is None:
        raise ValueError("context missing id, entity, or period")
    identifier = entity.find(f"{_XBRL}identifier")
    if identifier is None:
        raise ValueError("context missing entity identifier")
    day = {k: (period.findtext(f"{_XBRL}{k}") or "").strip() or None for k in ("instant", "startDate", "endDate")}
    forever = period.find(f"{_XBRL}forever") is not None
    shape = (forever, day["instant"] is not None, day["startDate"] is not None, day["endDate"] is not None)
    if shape not in ((True, False, False, False), (False, True, False, False), (False, False, True, True)):
        raise ValueError("context must have an instant, a duration, or forever")
    yield {"kind": "context", "id": node.get("id"), "entity": "".join(identifier.itertext()).strip(), "scheme": identifier.get("scheme"), "instant": day["instant"], "start_date": day["startDate"], "end_date": day["endDate"], "forever": forever}
    for holder in (entity.find(f"{_XBRL}segment"), node.find(f"{_XBRL}scenario")):
        for m in holder if holder is not None else ():
            if m.tag in (f"{_DIMENSION}explicitMember", f"{_DIMENSION}typedMember"):
                typed = m.tag.endswith("typedMember")
                _qname(m.get("dimension"), prefixes)
                member = "".join(m.itertext()).strip()
                if not typed:
                    _qname(member, prefixes)
                yield {"kind": "dimension", "id": node.get("id"), "axis": m.get("dimension"), "member": member, "typed": typed}


def _unit(node: ElementTree.Element, prefixes: dict[str, str]) -> dict:
    if not node.get("id"):
        raise ValueError("unit missing id")
    divide = node.find(f"{_XBRL}divide")
    if divide is None:
        return {"kind": "unit", "id": node.get("id"), "unit": _measures(node, prefixes)}
    sides = [divide.find(f"{_XBRL}{s}") for s in ("unitNumerator", "unitDenominator")]
    if None in sides:
        raise ValueError("divided unit missing numerator or denominator")
    return {"kind": "unit", "id": node.get("id"), "unit": "/".join(_measures(s, prefixes) for s in sides)}


def _nil(node: ElementTree.Element) -> bool:
    """Whether a fact is nil."""
    said = node.get(f"{_XSI}nil", "")
    if said not in ("", "true", "1", "false", "0"):
        raise ValueError("invalid xsi:nil value")
    nil = said in ("true", "1")
    if nil and (len(node) > 0 or "".join(node.itertext()).strip()):
        raise ValueError("nil fact has content")
    return nil


def _fact(node: ElementTree.Element, language: str | None) -> dict:
    nil, value = _nil(node), "".join(node.itertext()).strip()
    space, local = node.tag[1:].split("}", 1) if node.tag.startswith("{") else ("", node.tag)
    return {"kind": "fact", "id": node.get("id"), "namespace": space, "local": local, "value": None if nil else value, "context_ref": node.get("contextRef"), "unit_ref": node.get("unitRef"), "decimals": node.get("decimals"), "precision": node.get("precision"), "language": node.get(f"{_XML}lang") or language, "nil": nil, "structured": len(node) > 0}


class NoInstance(ValueError):
    """The root is not an instance's."""


def _root_tag(body: str) -> str | None:
    """Tag of the root, where the place that breaks a body is behind it."""
    parser = ElementTree.XMLPullParser(["start"])
    try:
        parser.feed(body.lstrip().encode())
    except ElementTree.ParseError:
        pass
    try:
        return next((node.tag for _, node in parser.read_events()), None)
    except ElementTree.ParseError:
        return None


def _starts(content: bytes) -> Iterator[tuple]:
    """Namespaces and elements as they start; the first element is whole at the end. Read at once, so that no chunks are made."""
    parser = ElementTree.XMLPullParser(["start-ns", "start"])
    parser.feed(content)
    yield from parser.read_events()
    parser.close()
    yield from parser.read_events()


def _strict(body: str, facts: bool = True) -> list[dict]:
    """Records of a well-formed instance; facts are read in any case and left out where they are not asked for."""
    root, prefixes = None, {}
    try:
        for event, x in _starts(body.lstrip().encode()):
            if event == "start-ns":
                prefixes[x[0] or ""] = x[1]
            elif root is None:
                root = x
    except ElementTree.ParseError as e:
        if _root_tag(body) != f"{_XBRL}xbrl":
            raise NoInstance("expected instance has no XBRL root") from e
        raise ValueError(str(e)) from e
    if root.tag != f"{_XBRL}xbrl":
        raise NoInstance("expected instance has no XBRL root")
    out = []
    for node in root:
        if (node.tail or "").strip() or (root.text or "").strip():
            raise ValueError("unexpected text outside XBRL item")
        if node.tag == f"{_XBRL}context":
            out.extend(_context(node, prefixes))
        elif node.tag == f"{_XBRL}unit":
            out.append(_unit(node, prefixes))
        elif node.get("contextRef"):
            if facts:
                out.append(_fact(node, root.get(f"{_XML}lang")))
            else:
                _nil(node)
        elif node.tag not in (f"{_LINK}schemaRef", f"{_LINK}linkbaseRef", f"{_LINK}footnoteLink"):
            out.append({"kind": "unsupported", "local": node.tag.rpartition("}")[2]})
    return out


_WS = r"[ \t\r\n]*"
_ENTITIES = re.compile("|".join(rf"&{_WS}{_WS.join(name)}{_WS};" for name in ("lt", "gt", "amp", "quot", "apos")))
_TAGS = re.compile(rf"<([^ \t\r\n/>?!][^ \t\r\n/>]*)|<({_WS})/([^>]*)>")
#: A closing tag that filers cut off and left in a text (fixed value).
_CUT = "</DescriptionOfDefinedContributionPensionAndO>"


def _split_entities(body: str) -> tuple[str, int]:
    n = 0

    def whole(m: re.Match) -> str:
        nonlocal n
        tight = re.sub(r"[ \t\r\n]", "", m[0])
        n += tight != m[0]
        return tight

    return _ENTITIES.sub(whole, body), n


def _split_closings(body: str) -> tuple[str, int]:
    last, n = None, 0

    def whole(m: re.Match) -> str:
        nonlocal last, n
        if m[1] is not None:
            last = m[1]
            return m[0]
        name = re.sub(r"[ \t\r\n]", "", m[3])
        if name != last or not m[2] and name == m[3]:
            return m[0]
        n += 1
        return f"</{name}>"

    return _TAGS.sub(whole, body), n


def _unended(name: str):
    pattern = re.compile(rf"&{name}(?=[ \t\r\n<])")
    return lambda body: pattern.subn(f"&{name};", body)


def _cut_closings(body: str) -> tuple[str, int]:
    parts = body.split(_CUT)
    out, last = parts[0], None
    for before, after in zip(parts, parts[1:], strict=False):
        opened = [m[1] for m in _TAGS.finditer(before) if m[1] is not None]
        last = opened[-1] if opened else last
        if last is None:
            return body, 0
        out += f"{_CUT.replace('<', '&lt;').replace('>', '&gt;')}</{last}>{after}"
    return out, len(parts) - 1


#: Repairs in the order in which they are applied, under the codes of their diagnostics (fixed values).
REPAIRS = [
    ("legacy_xbrl_split_entity", _split_entities),
    ("legacy_xbrl_split_closing_tag", _split_closings),
    ("legacy_xbrl_missing_entity_semicolon", _unended("lt")),
    ("legacy_xbrl_missing_entity_semicolon", _unended("gt")),
    ("legacy_xbrl_stray_closing_tag", _cut_closings),
]


def repair_legacy_xml(body: str) -> tuple[str, list[dict]]:
    """A repaired copy and a diagnostic with a count for each repair that did something."""
    said = []
    for code, repair in REPAIRS:
        body, n = repair(body)
        if n:
            said.append({"kind": "diagnostic", "code": code, "replacements": n})
    return body, said


def shred_instance(accession: str | None, document: str | None, body: str | None, kinds: Collection[str] | None = None) -> list[dict]:
    """Fact, context, dimension, unit and unsupported records of one instance, or a diagnostic of what breaks it; of the given kinds
    or all.

    Repairs are tried only where the strict reading of a root that is an instance's fails; if they do nothing, or don't
    help, the failure stands and the instance has no records.
    """
    key, said, facts = {"accession": accession, "document": document}, [], kinds is None or "fact" in kinds
    try:
        try:
            records = _strict(body or "", facts)
        except NoInstance:
            raise
        except ValueError:
            fixed, said = repair_legacy_xml(body or "")
            if not said:
                raise
            records = _strict(fixed, facts)
        records.append({"kind": "instance"})
    except ValueError as e:
        records = [{"kind": "diagnostic", "code": "xbrl_error", "message": str(e)}]
    if any(r["kind"] == "unsupported" for r in records):
        said.append({"kind": "diagnostic", "code": "unsupported_xbrl", "message": "unrecognized instance elements"})
    return [key | r for r in [*said, *records] if kinds is None or r["kind"] in kinds]


def is_instance():
    return (F.coalesce("type", F.lit("")) == "EX-101.INS") | F.lower(F.coalesce("name", F.lit(""))).endswith("_htm.xml")


def shred_xbrl(documents: DataFrame, kinds: Collection[str] | None = None) -> DataFrame:
    """Tagged records of all instances: documents of type EX-101.INS or named *_htm.xml. Each instance also gives one record
    of kind instance if it could be read. Instances are always read whole; kinds are those of which records are handed on."""

    def run(batches):
        instances = (x for batch in batches for x in zip(*(batch.column(i) for i in range(3)), strict=True))
        return _batches((r for x in instances for r in shred_instance(*(v.as_py() for v in x), kinds)), _arrow(RECORD))

    return documents.where("error IS NULL").where(is_instance()).select("accession", "name", "body").mapInArrow(run, RECORD)


def land_records(documents: DataFrame, path: str, kinds: Collection[str] | None = None) -> DataFrame:
    """Shred once into Parquet partitioned by kind of record, of the given kinds or all; readers of one kind touch its folder only."""
    shred_xbrl(documents, kinds).write.partitionBy("kind").parquet(path)
    return documents.sparkSession.read.schema(RECORD).parquet(path)


def reference_errors(records: DataFrame) -> DataFrame:
    """accession, document, problem, ref, n: facts whose context or unit is missing in their instance, and ids that stand for several
    contexts, units or facts of it. Made in one grouping by instance and name, without a join."""
    place = ["accession", "document"]

    def named(kinds: list[str], ref: str, what: str) -> DataFrame:
        rows = records.where(F.col("kind").isin(kinds)).where(F.coalesce(ref, F.lit("")) != "")
        return rows.select(*place, F.col(ref).alias("ref"), F.lit(what).alias("what"))

    uses = named(["context"], "id", "context").unionByName(named(["unit"], "id", "unit")).unionByName(named(["fact"], "id", "fact"))
    uses = uses.unionByName(named(["fact"], "context_ref", "of_context")).unionByName(named(["fact"], "unit_ref", "of_unit"))
    n = {w: F.count_if(F.col("what") == w) for w in ("context", "unit", "fact", "of_context", "of_unit")}
    problems = [("missing context", F.when(n["context"] == 0, n["of_context"])), ("missing unit", F.when(n["unit"] == 0, n["of_unit"])), ("duplicate id", n["context"] + n["unit"] + n["fact"] - 1)]
    found = uses.groupBy(*place, "ref").agg(F.array(*[F.struct(F.lit(name).alias("problem"), count.alias("n")) for name, count in problems]).alias("p"))
    return found.select(*place, "ref", F.inline("p")).where("n > 0").select(*place, "problem", "ref", "n")


def file_status(documents: DataFrame, records: DataFrame) -> DataFrame:
    """accession, status: partial with any error in an instance, complete with instances, unsupported with inline documents only, else no_xbrl."""
    bad = records.where("kind = 'diagnostic' AND code IN ('xbrl_error', 'unsupported_xbrl')").select("accession").unionByName(reference_errors(records).select("accession"))
    marks = documents.where("error IS NULL").select("accession", F.when(F.col("role") == "inline_xbrl", 1).otherwise(0).alias("m"))
    marks = marks.unionByName(records.where("kind = 'instance'").select("accession", F.lit(2).alias("m"))).unionByName(bad.select("accession", F.lit(3).alias("m")))
    status = F.element_at(F.array(*map(F.lit, ("no_xbrl", "unsupported", "complete", "partial"))), F.max("m") + 1)
    return marks.groupBy("accession").agg(status.alias("status"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the repository
