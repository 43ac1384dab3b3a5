"""Facts to statements: joins, best-fact selection, derived values, ratios, identities, history, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as fn
from .predicates import company_extension, small, statement_period, valid_period, valid_period_key

GROUPS = ["Fiscal year", "Quarterly", "Year to date", "Instant"]
#: Result = sum of terms, tried from the most direct; an identity is skipped where one of `unless` has a value (fixed values).
IDENTITIES = [
    ("assets = liabilities_and_equity", ["liabilities_and_equity"], []),
    ("assets = liabilities + equity_including_noncontrolling_interest", ["liabilities", "equity_including_noncontrolling_interest"], ["liabilities_and_equity"]),
    ("assets = liabilities + equity", ["liabilities", "equity"], ["liabilities_and_equity", "equity_including_noncontrolling_interest"]),
]
#: Types of expected values and tolerances, wide enough for the sums of all identities.
SUMS = ("decimal(25,4)", "decimal(26,6)")
#: Metrics that hint at a missing one (fixed values).
RELATED = {"eps_diluted": ["eps_basic"], "liabilities": ["liabilities_and_equity", "current_liabilities"], "equity": ["equity_including_noncontrolling_interest", "liabilities_and_equity"]}


def fact_context(facts: DataFrame, contexts: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Facts with the dates of their context; contexts with dimensions and broken references drop out."""
    plain = contexts.join(dimensions.select("accession", "instance", F.col("context_id").alias("id")), ["accession", "instance", "id"], "left_anti")
    dated = plain.select("accession", "instance", F.col("id").alias("context_ref"), "instant", "start_date", "end_date")
    return facts.join(dated, ["accession", "instance", "context_ref"])


def fact_unit(facts: DataFrame, units: DataFrame) -> DataFrame:
    named = units.select("accession", "instance", F.col("id").alias("unit_ref"), F.col("unit").alias("__unit"))
    out = facts.join(named, ["accession", "instance", "unit_ref"], "left")
    missing = F.when(F.coalesce("unit_ref", F.lit("")) == "", "").otherwise(F.concat(F.lit("unknown:"), F.col("unit_ref")))
    return out.withColumn("unit", F.coalesce("__unit", missing)).drop("__unit")


def fact_metric(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """Facts with the first concept in file order that fits name and namespace."""
    c = concepts.select(F.col("concept").alias("__c"), "family", "metric", "label", "statement", "tier", "priority", "position")
    out = facts.join(small(c), (F.col("local") == F.col("__c")) & fn.namespace_matches(F.col("namespace"), F.col("family")))
    once = concepts.groupBy("concept").count().where("count > 1").isEmpty()
    if not once:  # only a taxonomy that lists a concept twice needs the choice
        w = Window.partitionBy("accession", "instance", "ordinal").orderBy("position")
        out = out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return out.drop("__c", "family", "position")


def best_fact(facts: DataFrame, keys: list[str]) -> DataFrame:
    """One fact per key: lowest priority, non-nil, most precise, then id, names, context and value; order-independent.

    A minimum over a struct: combined on the map side, so repeated facts are not shuffled.
    """
    rank = F.struct(
        F.col("priority"), F.col("nil").cast("int").alias("nil"), (-fn.precision_score(F.col("decimals"), F.col("precision")).cast("long")).alias("score"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("id", "local", "namespace", "context_ref", "value")],
    )
    rest = [c for c in facts.columns if c not in keys]
    best = facts.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])


def mapped_facts(facts: DataFrame, contexts: DataFrame, dimensions: DataFrame, units: DataFrame, concepts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts with metric, unit and period. Facts that no concept fits go first."""
    rows = fact_unit(fact_context(fact_metric(facts, concepts), contexts, dimensions), units)
    rows = rows.join(filings.select("accession", "report_date"), "accession")
    rows = rows.withColumn("__p", fn.classify_period(F.col("instant"), F.col("start_date"), F.col("end_date"), F.col("report_date")))
    return rows.where("__p is not null").withColumns({"group": F.col("__p.group"), "period": F.col("__p.key")}).drop("__p")


KEYS = ["accession", "statement", "group", "metric", "label", "tier", "unit", "period"]


def summary(mapped: DataFrame) -> DataFrame:
    return best_fact(mapped, KEYS)


def statements(mapped: DataFrame) -> DataFrame:
    """Best values whose period suits their statement, with liabilities derived and equity filled in."""
    return stated(summary(mapped))


def stated(best: DataFrame) -> DataFrame:
    """The statements of a summary."""
    return _completed(statement_period(best), liabilities=True, equity=True)


def _has(metric: str) -> Column:
    """Whether the row's accession and unit have the metric among their balances."""
    return F.max((F.col("metric") == metric) & (F.col("statement") == "balance")).over(Window.partitionBy("accession", "unit"))


def _with_rows(values: DataFrame, made: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """values and, for every row where a condition holds, a copy with other columns. Keys of the windows pass through,
    so that rows stay where they are."""
    through = ["accession", "statement", "group", "unit", "period", "context_ref"]
    kinds = F.concat(F.array(F.lit(0)), *[F.when(when, F.array(F.lit(i))).otherwise(F.array().cast("array<int>")) for i, (when, _) in enumerate(made, 1)])

    def shape(c: str) -> Column:
        out = F.col(c)
        for i, (_, other) in enumerate(made, 1):
            if c in other and c not in through:
                out = F.when(F.col("__kind") == i, other[c].cast(values.schema[c].dataType)).otherwise(out)
        return out.alias(c)

    return values.withColumn("__kind", F.explode(kinds)).select(*[shape(c) for c in values.columns])


def _derived(values: DataFrame) -> tuple[DataFrame, Column, dict[str, Column]]:
    """values with helper columns, where liabilities are made from a row, and their columns."""
    amount = F.when((F.col("statement") == "balance") & ~F.col("nil") & (F.col("context_ref") != ""), fn.parse_amount(F.col("value")))
    cell = Window.partitionBy("accession", "unit", "group", "period", "context_ref")
    total, plain, nci = (F.max(F.when(F.col("metric") == m, F.col("__amount"))).over(cell) for m in ("liabilities_and_equity", "equity", "equity_including_noncontrolling_interest"))
    # The finest order comes first, so that one sort serves all windows.
    order = (F.when((F.col("metric") == "liabilities_and_equity") & F.col("__amount").isNotNull(), 0).otherwise(1), "label", "tier")
    rows = values.withColumn("__amount", amount).withColumn("__first", F.row_number().over(cell.orderBy(*order)))
    rows = rows.withColumn("__left", total - F.coalesce(plain, nci)).withColumns({"__liabilities": _has("liabilities"), "__equity": _has("equity")})
    fixed = {"metric": "liabilities", "label": "Liabilities", "tier": "core", "namespace": "derived", "local": "Liabilities", "nil": False}
    columns = {c: F.lit(None) for c in values.columns} | {c: F.lit(v) for c, v in fixed.items()}
    columns["value"] = F.regexp_replace(F.col("__left").cast("string"), r"\.?0+$", "")
    when = (F.col("__first") == 1) & (F.col("statement") == "balance") & (F.col("metric") == "liabilities_and_equity") & F.col("__left").isNotNull() & ~F.col("__liabilities")
    return rows, when, columns


def _filled() -> tuple[Column, dict[str, Column]]:
    nci = (F.col("metric") == "equity_including_noncontrolling_interest") & (F.col("statement") == "balance")
    return nci & ~F.col("__equity"), {"metric": F.lit("equity"), "label": F.lit("Shareholders' equity"), "tier": F.lit("core")}


def _completed(values: DataFrame, *, liabilities: bool, equity: bool) -> DataFrame:
    rows, when, columns = _derived(values)
    made = [(when, columns)] * liabilities + [_filled()] * equity
    return _with_rows(rows, made).select(*values.columns)


def derive_liabilities(values: DataFrame) -> DataFrame:
    """Add total minus equity where a unit has no liabilities: plain equity, else with noncontrolling interest; one context, no nil."""
    return _completed(values, liabilities=True, equity=False)


def equity_fallback(values: DataFrame) -> DataFrame:
    """Copy equity with noncontrolling interest to equity where a unit has no plain equity."""
    return _completed(values, liabilities=False, equity=True)


def ratios(values: DataFrame, specs: DataFrame) -> DataFrame:
    """accession, ratio, group, unit, period, value; one grouping instead of a self-join, then a small broadcast. Of
    several amounts of one metric the largest counts."""
    live = values.where(~F.col("nil")).withColumn("amount", fn.parse_amount(F.col("value")))
    cells = live.groupBy("accession", "group", "unit", "period").agg(F.collect_set(F.struct("metric", "amount")).alias("of"))
    out = cells.crossJoin(small(specs))

    def amount(metric: str) -> Column:
        return F.array_max(F.filter("of", lambda x: x["metric"] == F.col(metric)))["amount"]

    out = out.withColumn("value", fn.ratio_string(amount("numerator"), amount("denominator"), F.col("style")))
    balance = F.col("ratio").isin("current_ratio", "debt_to_equity")
    return out.where(F.col("value").isNotNull() & (balance == (F.col("group") == "Instant"))).select("accession", "ratio", "group", "unit", "period", "value")


def identities(values: DataFrame) -> DataFrame:
    """Status of each accounting identity per accession, unit and period, from one grouping."""
    names = ["assets", "liabilities", "equity", "liabilities_and_equity", "equity_including_noncontrolling_interest"]
    live = values.where((F.col("statement") == "balance") & ~F.col("nil"))
    wide = live.groupBy("accession", "unit", "period").agg(
        *[F.min(F.when(F.col("metric") == m, F.struct(F.trim("value").alias("raw"), fn.parse_amount(F.col("value")).alias("amount"), F.col("context_ref").alias("ctx"), fn.decimals_tolerance(F.col("decimals")).alias("tol")))).alias(m) for m in names]
    )
    made = []
    for name, terms, unless in IDENTITIES:
        used = ["assets", *terms]
        gap = F.lit(None).cast("string")
        for m in reversed(used):
            gap = F.when(F.col(m).isNull(), f"missing {m}").when(F.col(f"{m}.amount").isNull(), f"unparseable {m}").otherwise(gap)
        mixed = F.size(F.array_distinct(F.array(*[F.col(f"{m}.ctx") for m in used]))) > 1
        gap = F.coalesce(gap, F.when(mixed, "formula facts use different contexts"))
        expected = sum((F.col(f"{m}.amount") for m in terms[1:]), F.col(f"{terms[0]}.amount"))
        tolerance = sum((F.col(f"{m}.tol") for m in terms), F.col("assets.tol"))
        holds = F.lit(True)
        for m in unless:
            holds &= F.col(m).isNull() | (F.col(f"{m}.raw") == "")
        off = F.abs(F.col("assets.amount") - expected) > tolerance
        made.append(F.when(holds, F.struct(
            F.lit(name).alias("name"),
            F.when(gap.isNotNull(), "skipped").when(off, "fail").otherwise("pass").alias("status"),
            F.when(gap.isNull(), expected).cast(SUMS[0]).alias("expected"), F.when(gap.isNull(), F.col("assets.amount")).alias("actual"),
            F.when(gap.isNull(), tolerance).cast(SUMS[1]).alias("tolerance"),
            F.coalesce(gap, F.when(off, "reported value differs from identity"), F.lit("")).alias("message"),
        )))
    return wide.select("accession", "unit", "period", F.inline(F.array_compact(F.array(*made))))


def history(values: DataFrame, filings: DataFrame, *, years: int = 10) -> DataFrame:
    """Annual values of a company: the newest filing wins, then accession, latest period, smallest concept; latest years only.

    Accessions and periods are ASCII.
    """
    annual = filings.where(F.col("form").isin("10-K", "10-K/A")).select("accession", "cik", "filing_date")
    rows = values.where(F.col("group").isin("Fiscal year", "Instant") & ~F.col("nil")).join(annual, "accession")
    rows = rows.withColumn("year", fn.history_year(F.col("period"))).where("year != ''")
    keys = ["cik", "statement", "metric", "unit", "year"]
    # One minimum, combined on the map side: newest filing, largest accession, latest period, smallest concept. Texts
    # are inverted character by character, as a minimum has to prefer the largest; an end mark lets longer ones win.
    def down(x: str) -> Column:
        return F.concat(F.transform(F.split(x, ""), lambda c: -F.ascii(c)), F.array(F.lit(1)))

    order = F.struct(-F.unix_date("filing_date"), down("accession"), down("period"), F.col("local"))
    out = rows.groupBy(*keys).agg(F.min_by(F.struct("value", "accession"), order).alias("c"))
    out = out.select(*keys, F.col("c.value").alias("value"), F.col("c.accession").alias("accession"))
    recent = F.dense_rank().over(Window.partitionBy("cik").orderBy(F.desc("year")))
    return out.withColumn("__r", recent).where(F.col("__r") <= years).drop("__r")


def broken_references(facts: DataFrame, contexts: DataFrame, units: DataFrame) -> DataFrame:
    """accession, ref, problem for facts whose context or unit is missing."""
    c = contexts.select("accession", "instance", F.col("id").alias("context_ref"))
    u = units.select("accession", "instance", F.col("id").alias("unit_ref"))
    no_context = facts.join(c, ["accession", "instance", "context_ref"], "left_anti").select("accession", F.col("context_ref").alias("ref"), F.lit("missing context").alias("problem"))
    no_unit = facts.where(F.coalesce("unit_ref", F.lit("")) != "").join(u, ["accession", "instance", "unit_ref"], "left_anti").select("accession", F.col("unit_ref").alias("ref"), F.lit("missing unit").alias("problem"))
    return no_context.unionByName(no_unit).groupBy("accession", "ref", "problem").agg(F.count("*").alias("facts"))


def mapped_by(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """Facts with mapped: true where the taxonomy has a concept of the fact's name whose family fits its namespace (J03's rule)."""
    families = concepts.groupBy(F.col("concept").alias("local")).agg(F.collect_set(F.coalesce("family", F.lit(""))).alias("__families"))  # one row a concept
    fits = F.exists("__families", lambda f: fn.namespace_matches(F.col("namespace"), f))
    return facts.join(small(families), "local", "left").withColumn("mapped", F.coalesce(fits, F.lit(False))).drop("__families")


def source_coverage(facts: DataFrame, contexts: DataFrame, dimensions: DataFrame, concepts: DataFrame) -> DataFrame:
    """Per filing: facts, mapped, unmapped, those of them in a company's own namespace, dimensional, without context, with a
    context of invalid period, mapped non-nil ones without a unit; repeated facts."""
    day = [F.col(c).cast("string") for c in ("instant", "start_date", "end_date")]
    c = contexts.select("accession", "instance", F.col("id").alias("context_ref"), F.lit(True).alias("has_context"), (~valid_period(*day)).alias("bad_period"))
    d = dimensions.select("accession", "instance", F.col("context_id").alias("context_ref"), F.lit(True).alias("has_dimension")).distinct()
    rows = mapped_by(facts, concepts).join(c, ["accession", "instance", "context_ref"], "left").join(d, ["accession", "instance", "context_ref"], "left")
    bare = F.col("mapped") & ~F.col("nil") & (F.coalesce("unit_ref", F.lit("")) == "")
    same = rows.groupBy("accession", "namespace", "local", "context_ref", "unit_ref").agg(
        F.count("*").alias("n"), F.max("mapped").alias("mapped"), F.max("has_context").alias("has_context"), F.max("bad_period").alias("bad_period"), F.max("has_dimension").alias("has_dimension"), F.count_if(bare).alias("bare")
    )

    def total(when: Column | str) -> Column:
        return F.sum(F.when(F.expr(when) if isinstance(when, str) else when, F.col("n")).otherwise(0))

    return same.groupBy("accession").agg(
        F.sum("n").alias("facts"), total("mapped").alias("mapped"), total("not mapped").alias("unmapped"), total(~F.col("mapped") & company_extension(F.col("namespace"))).alias("extension"),
        total("has_dimension").alias("dimensional"), total("has_context is null").alias("missing_context"), total("bad_period").alias("invalid_periods"), F.sum("bare").alias("missing_units"), F.sum(F.col("n") - 1).alias("duplicates"),
    )


def open_terms(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """Facts of concepts that the taxonomy doesn't map in their namespace."""
    return mapped_by(facts, concepts).where("NOT mapped").drop("mapped")


def filing_terms(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """accession, namespace, local, facts, extension: unmapped terms of each filing, and whether they are the company's own."""
    terms = open_terms(facts, concepts).groupBy("accession", "namespace", "local").agg(F.count("*").alias("facts"))
    return terms.withColumn("extension", company_extension(F.col("namespace")))


def facts_by_concept(facts: DataFrame, namespace: str, local: str) -> DataFrame:
    """All facts of one concept."""
    return facts.where((F.col("namespace") == namespace) & (F.col("local") == local))


def by_reference(rows: DataFrame, accession: str, instance: str, id_: str) -> DataFrame:
    """The context or unit of an id in one instance."""
    return rows.where((F.col("accession") == accession) & (F.col("instance") == instance) & (F.col("id") == id_))


def term_counts(facts: DataFrame, concepts: DataFrame, *, k: int = 25) -> DataFrame:
    """The k unmapped concepts with most facts."""
    return open_terms(facts, concepts).groupBy("namespace", "local").agg(F.count("*").alias("facts")).orderBy(F.desc("facts"), "local", "namespace").limit(k)


def _present(values: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """(one row per accession with live values, whether it has each of the named metrics). The metrics of a filing are bits of a few
    numbers, so that they are gathered without a list for each filing; the columns are false where there is no row."""
    words = [names[i : i + 63] for i in range(0, len(names), 63)]
    bits = [reduce(lambda out, b: out.when(F.col("metric") == word[b], F.lit(1 << b)), range(1, len(word)), F.when(F.col("metric") == word[0], F.lit(1))).otherwise(F.lit(0)).cast("long") for word in words]
    there = values.where(~F.col("nil")).groupBy("accession").agg(F.count("*").alias("__n"), *[F.bit_or(x).alias(f"__{i}") for i, x in enumerate(bits)]).drop("__n")
    return there, {m: F.coalesce(F.col(f"__{i}").bitwiseAND(F.lit(1 << b).cast("long")) != 0, F.lit(False)) for i, word in enumerate(words) for b, m in enumerate(word)}


def _metric_status(has: Column, tier: str | None) -> Column:
    return F.when(has, "present").otherwise("supplemental_missing" if tier == "supplemental" else "missing")


def metric_presence(values: DataFrame, metrics: DataFrame, filings: DataFrame) -> DataFrame:
    """Every metric of every filing: present, missing, or supplemental_missing. The list of metrics is read at once (nineteen)."""
    listed = [tuple(r) for r in metrics.select("metric", "tier").collect()]
    there, has = _present(values, sorted({m for m, _ in listed if m is not None}))
    rows = filings.select("accession").join(there, "accession", "left")
    made = [F.struct(F.lit(m).cast("string").alias("metric"), F.lit(t).cast("string").alias("tier"), _metric_status(has.get(m, F.lit(False)), t).alias("status")) for m, t in listed]
    return rows.select("accession", F.inline(F.array(*made).cast("array<struct<metric:string,tier:string,status:string>>")))


def missing_by_tier(presence: DataFrame, tier: str = "core") -> DataFrame:
    gone = presence.where((F.col("tier") == tier) & (F.col("status") == "missing"))
    return gone.groupBy("accession").agg(F.array_join(F.array_sort(F.collect_set("metric")), ",").alias("missing"), F.count("*").alias("n"))


def presence_by_filing(values: DataFrame, metrics: DataFrame, filings: DataFrame) -> DataFrame:
    """One row per filing: metrics (map to present, missing or supplemental_missing), missing (sorted), by_tier (map of the
    missing ones) and related (map of missing metrics to those present that hint at them, as RELATED orders them).

    The list of metrics is read at once (nineteen); those that a filing has are held against it, so filings times metrics are
    never rows.
    """
    listed = sorted({(r.metric, (r.tier or "").strip(" ") or "core") for r in metrics.select("metric", "tier").collect()})
    there, has = _present(values, sorted({m for m, _ in listed} | {r for rs in RELATED.values() for r in rs}))
    rows = filings.select("accession").join(there, "accession", "left")
    status = {m: _metric_status(has[m], t) for m, t in listed}

    def chosen(names: list[tuple[str, Column]], kind: str = "string") -> Column:
        """The names that hold, in their order."""
        return F.array_compact(F.array(*[F.when(when, F.lit(n) if isinstance(n, str) else n) for n, when in names]).cast(f"array<{kind}>"))

    gone = [(m, t, status[m] == "missing") for m, t in listed]
    tiers = [(t, chosen([(m, when) for m, of, when in gone if of == t])) for t in sorted({t for _, t in listed})]
    hints = [(m, when, chosen([(r, has[r]) for r in RELATED[m]])) for m, _, when in gone if m in RELATED]
    lists = "struct<key:string,value:array<string>>"
    return rows.select(
        "accession",
        F.create_map(*[x for m, _ in listed for x in (F.lit(m), status[m])]).cast("map<string,string>").alias("metrics"),
        chosen([(m, when) for m, _, when in gone]).alias("missing"),
        F.map_from_entries(chosen([(F.struct(F.lit(t).alias("key"), some.alias("value")), F.size(some) > 0) for t, some in tiers], lists)).alias("by_tier"),
        F.map_from_entries(chosen([(F.struct(F.lit(m).alias("key"), some.alias("value")), when & (F.size(some) > 0)) for m, when, some in hints], lists)).alias("related"),
    )


def related_evidence(presence: DataFrame) -> DataFrame:
    """Missing metrics whose related metrics are present."""
    pairs = presence.sparkSession.createDataFrame([(m, r) for m, rs in RELATED.items() for r in rs], "metric string, related string")
    gone = presence.where("status = 'missing'").select("accession", "metric").join(F.broadcast(pairs), "metric")
    there = presence.where("status = 'present'").select("accession", F.col("metric").alias("related"))
    return gone.join(there, ["accession", "related"]).groupBy("accession", "metric").agg(F.array_join(F.array_sort(F.collect_set("related")), ",").alias("related"))


def dimensional_basic(facts: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Accessions of filings whose basic EPS is reported under a dimension, once each."""
    d = dimensions.select("accession", "instance", F.col("context_id").alias("context_ref")).distinct()
    basic = facts.where("local = 'EarningsPerShareBasic' and trim(value) != ''").join(d, ["accession", "instance", "context_ref"], "left_semi")
    return basic.select("accession").distinct()


def dimensional_evidence(presence: DataFrame, facts: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Filings without diluted EPS whose basic EPS is reported under a dimension."""
    gone = presence.where("metric = 'eps_diluted' and status != 'present'").select("accession", "metric")
    return gone.join(dimensional_basic(facts, dimensions), "accession", "left_semi").withColumn("evidence", F.lit("eps_basic"))


def top_missing(presence: DataFrame, *, k: int = 12) -> DataFrame:
    return presence.where("status = 'missing'").groupBy("metric").agg(F.count("*").alias("filings")).orderBy(F.desc("filings"), "metric").limit(k)


def missing_hotspots(missing: DataFrame, filings: DataFrame, *, k: int = 20) -> DataFrame:
    rows = missing.join(filings.select("accession", "cik", "company"), "accession")
    return rows.groupBy("cik", "company", "missing").agg(F.count("*").alias("filings")).orderBy(F.desc("filings"), "cik", "missing").limit(k)


def quality_deltas(checks: DataFrame, *, k: int = 20) -> DataFrame:
    failed = checks.where("status = 'fail'").withColumn("delta", F.abs(F.col("actual") - F.col("expected")))
    return failed.orderBy(F.desc("delta"), "accession", "unit", "period", "name").limit(k)


def lint(values: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """Issues per filing: metrics with no value, invalid periods, several units and, given checks, failed identities."""
    bad = F.collect_set(F.when(~valid_period_key(F.col("period")), F.col("period")))
    rows = values.groupBy("accession", "group", "metric").agg(F.size(F.collect_set("unit")).alias("units"), F.count_if((~F.col("nil")) & (F.trim("value") != "")).alias("filled"), bad.alias("bad"))
    many = F.when(F.col("units") > 1, F.concat(F.lit("several units: "), "metric"))
    none = F.when(F.col("filled") == 0, F.concat(F.lit("no values: "), "metric"))
    periods = F.transform("bad", lambda p: F.concat(F.lit("invalid period "), p, F.lit(": "), F.col("metric")))
    out = rows.select("accession", F.explode(F.concat(F.array_compact(F.array(many, none)), periods)).alias("issue"))
    if checks is not None:
        failed = F.concat(F.lit("identity check failed: "), "name", F.lit(" period="), "period", F.lit(" unit="), "unit")
        out = out.union(checks.where("status = 'fail'").select("accession", failed.alias("issue")))
    return out.distinct()


def view_counts(filings: DataFrame, facts: DataFrame, contexts: DataFrame, dimensions: DataFrame) -> DataFrame:
    f = facts.groupBy("accession").agg(F.count("*").alias("facts"), F.count_distinct("instance").alias("instances"))
    c = contexts.groupBy("accession").agg(F.count("*").alias("contexts"))
    d = dimensions.select("accession", "instance", "context_id").distinct()
    x = facts.join(d.withColumnRenamed("context_id", "context_ref"), ["accession", "instance", "context_ref"], "left_semi").groupBy("accession").agg(F.count("*").alias("dimensional"))
    out = filings.select("accession").join(f, "accession", "left").join(c, "accession", "left").join(x, "accession", "left")
    return out.na.fill(0).withColumn("status", F.when(F.col("facts") > 0, "complete").otherwise("no_xbrl"))


def statement_order(values: DataFrame) -> DataFrame:
    """Rows in display order: groups as fixed, labels, units, newest period first."""
    at = F.array_position(F.array(*map(F.lit, GROUPS)), F.col("group"))
    return values.orderBy("accession", "statement", at, "label", "unit", F.desc("period"))


def compare_baseline(expected: DataFrame, actual: DataFrame, *, tolerance: float = 0.05) -> DataFrame:
    """Expected against actual numbers per cik, metric and year; null expectations are skipped."""
    rows = expected.where("expected is not null").join(actual, ["cik", "metric", "year"], "left")
    off = F.abs(F.col("expected") - F.col("actual"))
    return rows.withColumn("status", F.when(F.col("actual").isNull(), "missing").when(off <= tolerance, "match").otherwise("differs"))
