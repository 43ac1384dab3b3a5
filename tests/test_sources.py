import json

import pytest

from ledgerline.sources import landed

MEMBERS = [{"cik": "320193", "ticker": " brk.b ", "name": "B"}, {"cik": "0000000001", "ticker": "A", "name": "A"}]
SET = {"name": "s", "as_of": "2024-01-02", "members": MEMBERS}
METRIC = {"key": "revenue", "label": "Revenue", "statement": "income", "tier": "core", "concepts": [{"name": "Revenues", "namespace": "us-gaap", "priority": 1}]}
TAXONOMY = {"schema_version": 1, "taxonomy_version": "v1", "metrics": [METRIC], "ratios": [{"key": "r", "label": "R", "numerator": "a", "denominator": "b", "format": "percent"}]}


def put(path, name, value):
    (path / name).write_text(json.dumps(value))


def reasons(rejects):
    return {r.path.rsplit("/", 1)[1]: r.reason for r in rejects.collect()}


def test_bad_constituent_files_fail_with_their_reason(spark, tmp_path):
    bad = {
        "a.json": (SET | {"name": " "}, "set without name"), "b.json": (SET | {"as_of": "2024-13-01"}, "invalid date"), "c.json": (SET | {"members": []}, "no members"), "d.json": (SET | {"members": [*MEMBERS, {"ticker": "C", "name": "C"}]}, "member without CIK"),
        "e.json": (SET | {"members": [MEMBERS[0] | {"ticker": " "}]}, "member without ticker"), "f.json": (SET | {"members": [MEMBERS[0] | {"name": ""}]}, "member without name"), "g.json": (SET | {"members": [*MEMBERS, MEMBERS[1] | {"ticker": "a "}]}, "duplicate ticker"),
    }
    for name, (value, _) in bad.items():
        put(tmp_path, name, value)
    put(tmp_path, "good.json", SET)
    members, rejects = landed.read_constituents(spark, str(tmp_path))
    assert [(r.set_name, r.cik, r.ticker) for r in members.collect()] == [("s", "0000000001", "A"), ("s", "0000320193", "BRK-B")]
    assert reasons(rejects) == {k: v[1] for k, v in bad.items()}


def test_bad_taxonomy_files_fail_with_their_reason(spark, tmp_path):
    bad = {
        "a.json": (TAXONOMY | {"schema_version": 2}, "unsupported schema"), "b.json": (TAXONOMY | {"taxonomy_version": ""}, "version is empty"), "c.json": (TAXONOMY | {"metrics": [METRIC | {"label": ""}]}, "empty key, label or statement"),
        "d.json": (TAXONOMY | {"metrics": [METRIC, METRIC]}, "duplicate metric"), "e.json": (TAXONOMY | {"metrics": [METRIC | {"concepts": []}]}, "metric without concepts"), "f.json": (TAXONOMY | {"metrics": [METRIC | {"concepts": [{"name": ""}]}]}, "concept without name"),
    }
    for name, (value, _) in bad.items():
        put(tmp_path, name, value)
    put(tmp_path, "good.json", TAXONOMY)
    concepts, ratios, rejects = landed.read_taxonomy(spark, str(tmp_path))
    assert [(r.concept, r.family, r.metric, r.priority, r.position) for r in concepts.collect()] == [("Revenues", "us-gaap", "revenue", 1, 0)]
    assert [(r.ratio, r.style) for r in ratios.collect()] == [("r", "percent")]
    assert reasons(rejects) == {k: v[1] for k, v in bad.items()}


@pytest.mark.parametrize(
    "row, reason",
    [
        ("price,s,AAA,2024-01-03,USD,1,1,1,,,,,", None), ("price,s,AAA,2024-01-02,USD,1,2,1,,,,,", "duplicate price date"), ("action,s,AAA,2024-01-02,USD,,,,split,,2,1,a1", "duplicate action"),
        ("price,s,AAA,2024-01-03,EUR,1,1,1,,,,,", "currency"), ("price,s,BBB,2024-01-03,USD,1,1,1,,,,,", "identity mismatch"), ("other,s,AAA,2024-01-03,USD,1,1,1,,,,,", "record type"), ("action,s,AAA,2024-01-03,USD,,1,,split,,2,1,a2", "action with prices"),
    ],
)
def test_price_batches_reject(spark, tmp_path, row, reason):
    head = ",".join(c.split()[0] for c in landed.BATCH_SCHEMA.split(", "))
    folder = tmp_path / "AAA"
    folder.mkdir()
    (folder / "x.csv").write_text("\n".join([head, "price,s,AAA,2024-01-02,USD,1,1,1,,,,,", "action,s,AAA,2024-01-02,USD,,,,split,,2,1,a1", row]) + "\n")
    good, bad = landed.read_price_batches(spark, str(folder), identity="/([^/]+)/[^/]+$")
    assert {r.reason for r in bad.collect()} == ({reason} if reason else set())
    assert good.count() == (3 if not reason else 1 if "duplicate" in reason else 2)


def test_a_form_is_parsed_once(spark):
    from ledgerline.sources import ownership_forms

    forms = spark.createDataFrame([("a", "<edgarSubmission/>", "13F-HR")], "accession string, xml string, form string")
    for rows in (ownership_forms.schedule_reports(forms)[0], ownership_forms.holdings_covers(forms)[0]):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
