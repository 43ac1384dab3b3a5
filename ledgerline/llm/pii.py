"""Personal data: base patterns, then identifiers that appear in the same lexical contexts.

Base matches are the seeds. The two words before a seed are a pattern, and so are the two after it; tokens that
look like identifiers, short numbers side by side taken as one, are instances. Patterns and instances form a graph scored in rounds: a pattern by the share of its instances that are
believed to be of a kind, an instance by its best patterns. Patterns with enough distinct seeds and a high score
add the other identifiers that they stand beside. All steps are column expressions, joins and sums.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, once, row_key, words

KINDS = ["email", "ip", "card", "phone"]
_DIGIT, _LOCAL = "[0-9]", "[A-Za-z0-9._%+-]"
#: Java patterns that find what the base definitions find, in time linear in the text: a local part or number
#: starts where its run starts (or where the last match ended), and quantifiers that need not give back do not.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_NONSPACE = r"[^\x20\x09-\x0D]"
#: A number of at most six digits, and two to six of them with blanks between, which may be one identifier.
_PART = rf"[+(]?+(?:[0-9][()/-]*+){{1,6}}+(?!{_NONSPACE})"
_JOINED = rf"(?<!{_NONSPACE}){_PART}(?:\x20{_PART}){{1,5}}+"
#: A token with a digit or an at sign, or numbers that stand side by side.
TOKEN = rf"{_JOINED}|(?<!{_NONSPACE})[^\x20\x09-\x0D0-9@]*+[0-9@]{_NONSPACE}*+"

#: Distinct seeds that a pattern needs, the score that patterns and instances need, rounds of scoring.
MIN_SEEDS, MIN_SCORE, ROUNDS = 5, 0.8, 3
#: Matches whose places are summed together.
CHUNK = 128


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _passes(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return _luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _match_passes(kind: str, match):
    return _passes(kind, match["value"])


def _located(rows: DataFrame, text: str, pattern: str, when: Column, out: str, keep, *, in_words: bool = False) -> DataFrame:
    """Add out: array of (start, end, value, first, last) of a pattern's matches: code points, and with in_words the
    numbers of the first and last word of a match that is made of whole words.

    Splitting at the same pattern gives the gaps between matches, so places are running sums of lengths. They are
    formed in chunks, each from the sum of the chunks before it: an array grows by copies, so one that held all
    matches of a long text would cost their square.
    """
    # What a lambda below reads is formed by `once`; else it could be formed again for every element.
    matches = F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = once(rows, __found=matches, __gaps=F.when(when, F.split(text, pattern, -1)))
    found, gaps, zero = F.col("__found"), F.col("__gaps"), F.lit(0)

    def n_words(x: Column) -> Column:
        return F.regexp_count(x, F.lit(f"{_NONSPACE}+")) if in_words else zero

    def step(x: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        return F.struct(i.alias("i"), F.length(gap).alias("gap"), F.length(x).alias("own"), n_words(gap).alias("gap_words"), n_words(x).alias("own_words"))

    rows = once(rows, __steps=F.transform(found, step))
    steps = F.col("__steps")
    chunks = F.when(F.size(found) > 0, F.sequence(zero, F.floor((F.size(found) - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))

    def of_chunk(c: Column) -> Column:
        return F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))

    start = F.struct(zero.alias("at"), zero.alias("word"))
    sums = F.transform(chunks, lambda c: F.aggregate(of_chunk(c), start, lambda a, s: F.struct((a["at"] + s["gap"] + s["own"]).alias("at"), (a["word"] + s["gap_words"] + s["own_words"]).alias("word"))))
    rows = once(rows, __sums=sums)
    base = F.transform(chunks, lambda c: F.aggregate(F.slice("__sums", F.lit(1), c), start, lambda a, s: F.struct((a["at"] + s["at"]).alias("at"), (a["word"] + s["word"]).alias("word"))))
    rows = rows.withColumn("__base", base)
    shape = "array<struct<i:int,start:int,end:int,first:int,last:int>>"

    def add(acc: Column, s: Column) -> Column:
        at, word = acc["at"] + s["gap"], acc["word"] + s["gap_words"]
        end, after = at + s["own"], word + s["own_words"]
        item = F.struct(s["i"].alias("i"), at.alias("start"), end.alias("end"), word.alias("first"), (after - 1).alias("last"))
        return F.struct(end.alias("at"), after.alias("word"), F.array_append(acc["items"], item).alias("items"))

    def placed(b: Column, c: Column) -> Column:
        begun = F.struct(b["at"].alias("at"), b["word"].alias("word"), F.array().cast(shape).alias("items"))
        return F.aggregate(of_chunk(c), begun, add, lambda acc: acc["items"])

    rows = rows.withColumn("__placed", F.flatten(F.transform("__base", placed)))
    named = F.transform("__placed", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.get(found, x["i"]).alias("value"), x["first"].alias("first"), x["last"].alias("last")))
    return rows.withColumn(out, F.filter(named, keep)).drop("__found", "__gaps", "__steps", "__sums", "__base", "__placed")


def _contexts(text_words: Column, first: Column, last: Column) -> Column:
    """Patterns of a token: the two words before it and the two after it, in which a token with a digit or @ is # and
    the ends of the text are ^ and $; a side without any letter is none."""

    def word(at: Column, edge: str) -> Column:
        w = F.when(at >= 0, F.get(text_words, at))
        return F.coalesce(F.when(w.rlike("[0-9@]"), "#").otherwise(F.lower(w)), F.lit(edge))

    left = F.concat_ws(" ", word(first - 2, "^"), word(first - 1, "^"))
    right = F.concat_ws(" ", word(last + 1, "$"), word(last + 2, "$"))
    return F.filter(F.array(F.concat(F.lit("<"), left), F.concat(F.lit(">"), right)), lambda p: p.rlike(r"\p{L}"))


def base_spans(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Add b_email, b_ip, b_card, b_phone: arrays of (start, end, value, ...); null and empty texts have none."""
    rows = docs.withColumn("__text", F.coalesce(docs[text_col], F.lit("")))
    has_digit = F.col("__text").rlike("[0-9]")
    for kind in KINDS:
        when = F.col("__text").contains(_NEEDS[kind]) if kind == "email" else F.col("__text").contains(_NEEDS[kind]) & has_digit
        rows = _located(rows, "__text", PATTERNS[kind], when, f"b_{kind}", partial(_match_passes, kind))
    return rows


def _score(edges: DataFrame, rounds: int) -> DataFrame:
    """pattern, kind, score after the rounds; edges: pattern, value, kind (null: unlabelled), n."""
    kinds = edges.where("kind is not null").groupBy("kind", "value").agg(F.lit(1.0).alias("belief"))
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("values"))
    seeds = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count_distinct("value").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
    places = materialize(edges.select("pattern", "value").distinct().join(sizes, "pattern"), "places")
    strong = materialize(seeds, "strong")
    scored = strong.select("pattern", "kind").withColumn("score", F.lit(0.0))
    for _ in range(rounds if not strong.isEmpty() else 0):
        believed = places.join(kinds, "value").groupBy("pattern", "kind").agg((F.sum("belief") / F.first("values")).alias("score"))
        scored = materialize(believed.join(strong.select("pattern", "kind"), ["pattern", "kind"], "left_semi"), "scored")
        spread = places.join(scored, "pattern").groupBy("kind", "value").agg(F.max("score").alias("belief"))
        kinds = materialize(kinds.unionByName(spread).groupBy("kind", "value").agg(F.max("belief").alias("belief")), "beliefs")
    return scored


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Personal data of every row: id_col, n_email, n_ip, n_card, n_phone (base spans), base and spans
    (kind:start:end strings, comma-joined, by kind then start; code points, end exclusive).

    One row per input row, repeated rows alike; null and empty texts have no spans; other columns are dropped; an
    empty table gives no rows. Offsets of rows that share id and text are found once and given to all of them.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    rows = base_spans(rows).withColumn("key", row_key(F.col("id"), F.col("text")))
    looks = F.col("__text").rlike("[0-9@]")
    rows = _located(rows, "__text", TOKEN, looks, "tokens", lambda x: F.length(x["value"]) > 0, in_words=True)
    rows = once(rows.drop("text"), words=F.when(F.size("tokens") > 0, words(F.col("__text"))))
    rows = rows.withColumn("tokens", F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["value"].alias("value"), _contexts(F.col("words"), t["first"], t["last"]).alias("patterns"))))
    rows = materialize(rows.select("id", "key", *[f"b_{k}" for k in KINDS], "tokens"), "spans")

    # Tokens: one that starts a base span is a seed of its kind, one that touches none is unlabelled.
    per = rows.select("id", "key", *[f"b_{k}" for k in KINDS], F.explode("tokens").alias("t"))

    def touches(kind: str) -> Column:
        return F.exists(f"b_{kind}", lambda s: (s["start"] < F.col("t.end")) & (s["end"] > F.col("t.start")))

    def started(kind: str) -> Column:
        """Value of the base span that starts inside the token."""
        return F.get(F.filter(f"b_{kind}", lambda s: (s["start"] >= F.col("t.start")) & (s["start"] < F.col("t.end"))), F.lit(0))["value"]

    kind = F.coalesce(*[F.when(started(k).isNotNull(), k) for k in KINDS])
    value = F.coalesce(*[started(k) for k in KINDS], F.col("t.value"))
    touched = F.coalesce(*[F.when(touches(k), True) for k in KINDS], F.lit(False))
    tokens = per.select("id", "key", F.col("t.start").alias("start"), F.col("t.end").alias("end"), value.alias("value"), kind.alias("kind"), touched.alias("touched"), F.col("t.patterns").alias("patterns"))
    tokens = tokens.where("kind is not null or not touched").select("id", "key", "start", "end", "value", "kind", F.explode("patterns").alias("pattern"))
    tokens = materialize(tokens, "tokens")
    edges = materialize(tokens.groupBy("pattern", "value", "kind").agg(F.count("*").alias("n")), "edges")
    scores = _score(edges, rounds).where(F.col("score") >= MIN_SCORE)
    enough = {"email": F.col("value").contains("@")} | {k: F.length(_digits(F.col("value"))) >= n for k, n in (("ip", 4), ("card", 12), ("phone", 7))}
    enough["ip"] &= ~F.col("value").rlike(rf"^(?:{_JOINED})$")
    fits = F.coalesce(*[F.when((F.col("found") == k) & ok, True) for k, ok in enough.items()], F.lit(False))
    new = tokens.where("kind is null").join(scores.select("pattern", F.col("kind").alias("found"), "score"), "pattern").where(fits)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("found"))
    new = new.groupBy("key", "start", "end").agg(F.max_by("found", F.struct("score", -order)).alias("found"))
    new = new.groupBy("key").agg(F.collect_list(F.struct("found", "start", "end")).alias("new"))

    rows = rows.drop("tokens").join(new, "key", "left")

    def written(kind: str, extra: bool) -> Column:
        spans = F.transform(f"b_{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        if extra:
            more = F.transform(F.filter("new", lambda s: s["found"] == kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
            spans = F.array_sort(F.concat(spans, F.coalesce(more, F.array().cast("array<struct<start:int,end:int>>"))))
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def joined(extra: bool) -> Column:
        return F.array_join(F.concat(*[written(k, extra) for k in KINDS]), ",")

    counts = [F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(F.col("id").alias(id_col), *counts, joined(False).alias("base"), joined(True).alias("spans"))
