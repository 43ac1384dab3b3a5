"""Line deduplication as an exact set-similarity join: prefix, length and positional filters, then Jaccard.

A line's tokens are ordered from rare to common, by counts over the whole corpus in a fixed number of token
classes, so one order serves all lines with a bounded table. Two lines can be similar only if they share a token
of their short prefixes. Equal token sets are one set. A set first meets the earliest and the preceding
sets of three common tokens of its prefix; most members of a large family of variants match there. Only the others
meet all sets of their prefix tokens, so that a family does not cost the square of its size. The order only decides
which tokens are prefixes, never which pairs are found; every match is verified on the exact sets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from .shared import ASCII_SPACE, Scratch, materialize, once

SIMILARITY = 0.8
#: Token classes whose counts decide the order; so many still fit the fast map of Spark's hash aggregation. The level of
#: a class (quarters of the count's logarithm, at most 127) stands in front of 56 bits of the token's hash.
CLASS_BITS = 16
#: Sets before it that a set meets first, besides the earliest, for each of its three tokens.
PRECEDING = 8
#: Level from which a token's class is common (2**9 words): tokens of fewer words have no family that could cost much.
COMMON = 36
#: Tokens up to which 64 parities of a set tell enough.
SMALL = 80
#: Documents up to which the wanted ones are broadcast.
BROADCAST_ROWS = 200_000


def _class(h: Column) -> Column:
    return F.call_function("shiftrightunsigned", h, F.lit(64 - CLASS_BITS)).cast("int")


def _spaced(text: Column) -> Column:
    """Blanks for the other white space inside lines."""
    other = "\t\x0b\f\r"
    return F.when(reduce(lambda x, y: x | y, [text.contains(c) for c in other]), F.translate(text, other, "    ")).otherwise(text)


def _small_levels(rows: DataFrame) -> Column:
    """Level of every token class from rare to common as a constant array: a number per class, used in one plan.

    The driver keeps the plan as text, again and again, so the numbers are short: shifted ones make it six times as long.
    """
    tokens = rows.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("w")).where("w != ''")
    level = F.least(F.floor(4 * F.log2(F.count("*"))), F.lit(127)).cast("long")
    counts = tokens.groupBy(_class(F.xxhash64("w")).alias("c")).agg(level.alias("level"))
    packed = counts.groupBy(F.call_function("shiftright", F.col("c"), F.lit(10)).alias("part")).agg(F.collect_list(F.col("c").cast("long") * 128 + F.col("level")).alias("of"))
    levels = [0] * (1 << CLASS_BITS)
    for _, of in packed.collect():  # a number per class
        for x in of:
            levels[x >> 7] = x & 127
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")


def _raised(level: Column) -> Column:
    return F.call_function("shiftleft", level, F.lit(56))


def _levels(rows: DataFrame) -> Column:
    """The same, 56 bits up, as they stand in a token's rank."""
    return F.transform(_small_levels(rows), _raised)


def _hashes(line: Column) -> Column:
    """Distinct hashes of a line's words."""
    hashed = F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))
    return F.array_remove(hashed, F.xxhash64(F.lit("")))


def _parity(tokens: str | Column, half: bool = False) -> Column:
    """64 parities of the tokens (of half of all tokens); sets that differ in d tokens differ in at most d of them."""
    one, mask = F.lit(1).cast("long"), F.lit(63).cast("long")

    def bit(t: Column) -> Column:
        of = F.call_function("shiftright", t, F.lit(6)).bitwiseAND(one) if half else one
        return F.call_function("shiftleft", of, t.bitwiseAND(mask).cast("int"))

    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(bit(t)))


def _fits(similarity: float, early: Column, late: Column, of_early: list[Column], of_late: list[Column]) -> Column:
    """Length and parity filters on the sizes of two sets and their parities; a late size below zero fits none. Only sets
    of more than SMALL tokens have parities of a half."""
    sizes = (early >= similarity * late - 1e-9) & (late >= similarity * early - 1e-9)
    most = early + late - 2 * _overlap(similarity, early, late)
    whole, half = (x.bitwiseXOR(y) for x, y in zip(of_early, of_late, strict=True))
    halves = F.bit_count(half) + F.bit_count(whole.bitwiseXOR(half)) <= most  # tokens of either half
    return sizes & (F.bit_count(whole) <= most) & ((early <= SMALL) | (late <= SMALL) | halves)


def _overlap(similarity: float, early: Column, late: Column) -> Column:
    return F.ceil((early + late) * (similarity / (1 + similarity)) - 1e-9)


class Numbering:
    """How documents and the first lines of sets are named.

    Where ids are distinct numbers below 2**31, a document is its id and a line one long in the order of (id, line);
    else a document is (id, digest of the text) and a line a struct, in the order of id, line and token set.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.bits = 0
        if isinstance(docs.schema[id_col].dataType, IntegralType):
            low, high, n, named, distinct = docs.agg(F.min(id_col), F.max(id_col), F.count("*"), F.count(id_col), F.count_distinct(id_col)).first()
            if n and n == named == distinct and 0 <= low and high < 1 << 31:
                self.bits = 31  # no text has more lines

    def doc(self, id_: Column, text: Column) -> Column:
        return id_.cast("long") if self.bits else F.struct(id_.alias("id"), F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"))

    def line(self, doc: str, line: str) -> Column:
        if self.bits:
            return F.call_function("shiftleft", F.col(doc), F.lit(self.bits)).bitwiseOR(F.col(line).cast("long"))
        return F.struct(F.col(f"{doc}.id").alias("id"), F.col(line).alias("line"), F.col("k1"), F.col("k2"), F.col(f"{doc}.d1").alias("d1"), F.col(f"{doc}.d2").alias("d2"))

    def doc_of(self, sid: str) -> Column:
        return F.call_function("shiftright", F.col(sid), F.lit(self.bits)) if self.bits else F.struct(*[F.col(f"{sid}.{c}").alias(c) for c in ("id", "d1", "d2")])

    def line_of(self, sid: str) -> Column:
        return F.col(sid).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int") if self.bits else F.col(f"{sid}.line")


def _line_sets(lines: DataFrame, levels: Column, naming: Numbering, similarity: float, scratch: Scratch) -> DataFrame:
    """sid (first line), n, prefix, number of its common tokens and parities of every distinct token set."""
    low = F.lit((1 << 56) - 1)
    hashed = lines.select("doc", "line", _hashes(F.col("value")).alias("hashed"))
    # Every class has a level; coalesce says so to Spark, which then sorts plain numbers.
    ranked = F.transform("hashed", lambda h: _raised(F.coalesce(F.get(levels, _class(h)), F.lit(0).cast("long"))).bitwiseOR(h.bitwiseAND(low)))
    ranked = hashed.withColumn("tokens", F.sort_array(ranked)).withColumn("n", F.size("tokens"))
    size = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9).cast("int") + 1
    # 31 bits of a token stand for it among the posts: tokens that share them only make more candidates.
    rarest = F.slice("tokens", F.lit(1), size)
    prefix = F.transform(rarest, lambda t: t.bitwiseAND(F.lit((1 << 31) - 1).cast("long")).cast("int"))
    common = F.size(F.filter(rarest, lambda t: t >= F.lit(COMMON << 56)))  # they end the prefix
    half = F.when(F.col("n") > SMALL, _parity("hashed", half=True)).otherwise(F.lit(0).cast("long"))
    of_set = {"k1": F.xxhash64("tokens"), "k2": F.xxhash64(F.lit(1), "tokens"), "parity": _parity("hashed"), "half": half, "prefix": prefix, "common": common}
    drawn = ranked.select("doc", "line", "n", *[c.alias(name) for name, c in of_set.items()]).withColumn("sid", naming.line("doc", "line"))
    # All columns of a set are keys, so that Spark can sum in a hash map before the exchange.
    return scratch.write(drawn.groupBy("n", *of_set).agg(F.min("sid").alias("sid")).drop("k1", "k2"), "line-sets").where("n > 0")  # lines without words are one set


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, Callable[[Column, Column], Column]]:
    """doc and kept (numbers of the lines with words that stay) for rows with such lines, and how doc is formed.

    A line goes if an earlier one, by id, number and token set, has a token set of at least this Jaccard similarity.
    Rows that share id and text are one document. Null ids come first.
    """
    naming, scratch = Numbering(docs, id_col, text_col), Scratch(docs.sparkSession)
    rows = docs.where(docs[text_col].isNotNull()).select(naming.doc(docs[id_col], docs[text_col]).alias("doc"), _spaced(docs[text_col]).alias("text"))
    lines = rows.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "value"))
    sets = _line_sets(lines, _small_levels(rows), naming, similarity, scratch)

    def verified(pairs: DataFrame) -> DataFrame:
        """Sets (late) with an exact match among the pairs (early, late); only the lines in question are read again."""
        wanted = pairs.select(F.explode(F.array("early", "late")).alias("sid")).distinct()
        wanted = scratch.write(wanted.groupBy(naming.doc_of("sid").alias("doc")).agg(F.collect_list(F.struct(naming.line_of("sid").alias("line"), "sid")).alias("of")), "wanted")
        few = wanted.count() <= BROADCAST_ROWS
        again = rows.join(F.broadcast(wanted) if few else wanted, "doc").withColumn("lines", F.split("text", "\n"))
        again = again.select(F.explode(F.transform("of", lambda x: F.struct(x["sid"].alias("sid"), F.get("lines", x["line"]).alias("value")))).alias("x"))
        exact = again.select("x.sid", _hashes(F.col("x.value")).alias("tokens"))
        exact = scratch.write(exact if naming.bits else exact.dropDuplicates(["sid"]), "tokens")
        both = pairs.join(exact.select(F.col("sid").alias("early"), F.col("tokens").alias("a")), "early")
        both = both.join(exact.select(F.col("sid").alias("late"), F.col("tokens").alias("b")), "late")
        common = F.size(F.array_intersect("a", "b"))
        return scratch.write(both.where(common >= similarity * (F.size("a") + F.size("b") - common) - 1e-9).select(F.col("late").alias("sid")).distinct(), "matched")

    # First the earliest and the preceding sets of a few common tokens.
    ends = sets.where("common > 0").withColumn("ends", F.slice("prefix", F.size("prefix") - F.col("common") + 1, F.col("common")))
    kinds = F.explode(F.array_distinct(F.array(F.get("ends", F.lit(0)), F.array_min("ends"), F.array_max("ends")))).alias("token")
    shown = ends.select(kinds, "sid", F.struct("sid", "n", "parity", "half").alias("own"))
    group = Window.partitionBy("token")
    in_order = group.orderBy("sid")
    heads = F.array(F.first("own").over(in_order), *[F.lag("own", i).over(in_order) for i in range(1, PRECEDING + 1)])
    met = shown.select("own", heads.alias("heads")).select("own", F.explode("heads").alias("head"))  # a null head fits no set
    parities = [[F.col(f"{x}.{c}") for c in ("parity", "half")] for x in ("head", "own")]
    met = met.where((F.col("head.sid") < F.col("own.sid")) & _fits(similarity, F.col("head.n"), F.col("own.n"), *parities))
    met = scratch.write(met.select(F.col("head.sid").alias("early"), F.col("own.sid").alias("late")).distinct(), "pairs")
    matched = verified(met)

    # Then the others meet all sets of their prefix tokens. One exchange serves both sides, so all columns are needed on
    # both; `state` is the size of a set, below zero for one that is matched already.
    state = F.when(F.col("open").isNull(), F.col("n")).otherwise(-F.col("n")).alias("state")
    done = matched.withColumn("open", F.lit(False))
    posts = sets.join(F.broadcast(done) if done.count() <= BROADCAST_ROWS else done, "sid", "left")
    posts = posts.select("sid", state, "parity", "half", F.posexplode("prefix").alias("pos", "token"))
    early, late = F.abs("e.state"), F.col("l.state")
    parities = [[F.col(f"{x}.{c}") for c in ("parity", "half")] for x in ("e", "l")]
    near = (F.col("e.sid") < F.col("l.sid")) & _fits(similarity, early, late, *parities)
    near &= F.least(early - F.col("e.pos"), late - F.col("l.pos")) >= _overlap(similarity, early, late)  # what can be common from there on
    pairs = posts.alias("l").join(posts.alias("e"), F.col("l.token") == F.col("e.token")).where(near)
    pairs = scratch.write(pairs.select(F.col("e.sid").alias("early"), F.col("l.sid").alias("late")).distinct(), "more-pairs")
    matched = matched.unionByName(verified(pairs))
    stay = sets.select("sid").join(matched, "sid", "left_anti")
    kept = stay.groupBy(naming.doc_of("sid").alias("doc")).agg(F.collect_list(naming.line_of("sid")).alias("kept"))
    kept = materialize(kept, "kept-lines")
    scratch.release()
    return kept, naming.doc


def remove_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with later similar lines cut from text_col, and l_lines, l_removed (long) beside its columns.

    Lines are the parts between line feeds; a line without words always stays and matches nothing. Null texts stay
    null, with no lines; repeated rows come out alike; an empty table gives no rows.
    """
    kept, doc = repeated_lines(docs, id_col=id_col, text_col=text_col, similarity=similarity)
    rows = docs.withColumn("__doc", doc(docs[id_col], docs[text_col])).join(kept.withColumnsRenamed({"doc": "__doc", "kept": "__kept"}), "__doc", "left")
    rows = rows.withColumn("__lines", F.split(text_col, "\n")).withColumn("__kept", F.coalesce("__kept", F.array().cast("array<int>")))
    # One pass: mark kept numbers by sorting, then keep blank lines and marked ones.
    marked = F.transform("__lines", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    blank = F.transform(F.filter(marked, lambda m: F.btrim(m["x"], F.lit(ASCII_SPACE)) == ""), lambda m: m["i"])
    stay = F.array_sort(F.concat("__kept", blank))
    rows = rows.withColumn("__stay", stay)
    text = F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n")
    lines = F.coalesce(F.size("__lines"), F.lit(0))
    rows = rows.withColumn("l_lines", F.when(F.col(text_col).isNull(), 0).otherwise(lines).cast("long"))
    rows = rows.withColumn("l_removed", F.when(F.col(text_col).isNull(), 0).otherwise(lines - F.size("__stay")).cast("long"))
    rows = rows.withColumn("__text", F.when(F.col("l_removed") > 0, text).otherwise(F.col(text_col)))
    rows = rows.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in ("l_lines", "l_removed")], F.col("l_lines").alias("__n"), F.col("l_removed").alias("__gone"))
    return once(rows, l_lines=F.col("__n"), l_removed=F.col("__gone")).drop("__n", "__gone")
