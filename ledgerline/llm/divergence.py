"""Source divergence audit: how far the term frequencies of each source lie from those of its language and of each other source.

A table of 256 bytes lowers A-Z and blanks every separator in one pass over a text's UTF-8 bytes; splitting at blanks
and counting per document give term and document frequencies, which tasks add up by source before Spark shuffles them.
From there on everything is a sparse table of (language, source, term) cells: terms that a source lacks all share one
probability, so sums over all terms are sums over cells and a remainder.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared
from .shared import Scratch

#: Lowers A-Z, keeps a-z and all bytes above ASCII, blanks the rest.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
TERM_RANKS = 200

#: A text is split in steps of so many bytes, a task hands its counts on at so many entries, pairs of cells are made so many at a time.
STEP_BYTES, HELD_ENTRIES, PAIRS_AT_ONCE = 1 << 20, 300_000, 1 << 20


def document_counts(raw: bytes) -> Counter:
    """Occurrences of each term of one text."""
    blanked, counts, start = raw.translate(TABLE), Counter(), 0
    while start < len(blanked):
        end = blanked.find(b" ", start + STEP_BYTES)
        end = len(blanked) if end < 0 else end
        counts.update(blanked[start:end].split())
        start = end
    return counts


def _counted(batches):
    """(lang, source, term, n, docs) of each task; an empty term tells that the group occurs."""
    terms: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def handed_on():
        for (lang, source), counts in terms.items():
            keys = list(counts)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                    pa.array([source], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                    pa.array(keys, pa.binary()).cast(pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                    pa.array([docs[lang, source][k] for k in keys], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        terms.clear()
        docs.clear()

    held = 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for i, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            counts = document_counts(texts[i].as_py())
            of_group = terms[group]
            held -= len(of_group)
            for term, n in counts.items():
                of_group[term] += n
            of_group[b""] += 0
            docs[group].update(counts.keys())
            held += len(of_group)
            if held >= HELD_ENTRIES:
                yield from handed_on()
                held = 0
    yield from handed_on()


def _probability(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exact beyond 64 bits."""
    parts = [c.cast("decimal(20,0)") for c in (n + 1, total + kept)]
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * parts[0], parts[1]) + 1


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _squares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shared_terms(batches):
    """(g, h, value): what the terms that two sources share add to the sums that take either source alone."""
    for batch in batches:
        cells = batch.column(0)
        size = np.diff(cells.offsets.to_numpy())
        flat = cells.flatten()
        gid, p, rest = (flat.field(name).to_numpy() for name in ("gid", "p", "rest"))
        start, k = np.repeat(np.cumsum(size) - size, size), np.repeat(size, size).astype(np.int64)
        reach = np.cumsum(k)
        at = 0
        while at < len(gid):  # as many cells as make up the pairs allowed at once, one cell at least
            to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            mine = np.repeat(np.arange(at, to), k[at:to])
            first = np.cumsum(k[at:to]) - k[at:to]
            other = np.arange(len(mine)) - np.repeat(first, k[at:to]) + start[mine]
            mine, other = mine[mine != other], other[mine != other]
            gain = _squares(p[mine], p[other]) - _squares(p[mine], rest[other]) - _squares(rest[mine], p[other]) + _squares(rest[mine], rest[other])
            names, place = np.unique(np.stack([gid[mine], gid[other]]), axis=1, return_inverse=True)
            sums = np.zeros(names.shape[1], np.int64)
            np.add.at(sums, place.ravel(), gain)
            yield pa.RecordBatch.from_arrays([pa.array(names[0]), pa.array(names[1]), pa.array(sums)], ["g", "h", "value"])
            at = to


def cell_counts(docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n, lang_n: occurrences of each kept term in each source that has it, and in the language.

    A row with an empty term stands for each source that occurs. Counts reach the shuffle added up by task, at most one
    row per source and term from each; all of a language's cells of a term meet in one place, which are as many as its sources.
    """
    rows = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    cells = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    totals = cells.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"))
    return totals.where((F.col("term") == "") | (F.col("lang_docs") >= min_documents)).select("lang", "source", "term", "n", "lang_n")


def audit(docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Divergence of every source from each other source of its language, and its terms that lie furthest above the language.

    Returns lang, source, part (`pair` or `term`), item, value long, rank int. All values are exact integers. Null lang,
    source and text count as empty; a source without terms has all its language's pairs; a language without kept terms has
    pairs of value 0 and no terms; repeated rows count as often as they stand; an empty table gives no rows; other columns
    are dropped. Equal values rank by item in UTF-8 order. Pairs are as many as the result has; what two sources share of
    terms is added up inside the tasks, so no pair of cells is shuffled.
    """
    passing, scratch = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    cells = passing.write(cell_counts(docs, min_documents=min_documents, lang_col=lang_col, source_col=source_col, text_col=text_col), "cells")
    terms = F.col("term") != ""
    langs = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct(F.when(terms, F.col("term"))).alias("kept"))
    groups = cells.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    rest = F.when(F.col("kept") > 0, _probability(F.lit(0), F.col("total"), F.col("kept")))
    groups = scratch.write(groups.select("*", F.monotonically_increasing_id().alias("gid"), rest.alias("rest")), "groups")
    priced = cells.where(terms).join(groups, ["lang", "source"]).withColumn("p", _probability(F.col("n"), F.col("total"), F.col("kept")))
    priced = scratch.write(priced.select("lang", "source", "term", "n", "lang_n", "lang_total", "kept", "gid", "rest", "p"), "priced")
    passing.release()

    shared_cells = priced.groupBy("lang", "term").agg(F.collect_list(F.struct("gid", "p", "rest")).alias("cells")).where(F.size("cells") > 1)
    both = shared_cells.select("cells").mapInArrow(_shared_terms, "g bigint, h bigint, value bigint").groupBy("g", "h").agg(F.sum("value").alias("both"))
    levels = priced.groupBy("gid", "p").agg(F.count("*").alias("c")).groupBy("gid").agg(F.collect_list(F.struct("p", "c")).alias("levels"))
    sides = groups.join(levels, "gid", "left").select("lang", "source", "gid", "rest", "kept", F.coalesce("levels", F.array()).alias("levels"))
    one, two = sides.alias("one"), sides.alias("two")
    joined = one.join(two, F.expr("one.lang = two.lang AND one.gid <> two.gid"))
    p, q = F.col("one.rest"), F.col("two.rest")
    base = _distance(p, q)

    def summed(levels: str, gain) -> Column:
        return F.aggregate(F.col(levels), F.lit(0).cast("long"), lambda a, x: a + x["c"] * (gain(x["p"]) - base))

    alone = F.when(F.col("one.kept") > 0, base * F.col("one.kept") + summed("one.levels", lambda x: _distance(x, q)) + summed("two.levels", lambda x: _distance(p, x)))
    pairs = joined.select("one.lang", "one.source", F.col("two.source").alias("item"), F.col("one.gid").alias("g"), F.col("two.gid").alias("h"), F.coalesce(alone, F.lit(0)).cast("long").alias("alone"))
    pairs = pairs.join(both, ["g", "h"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("alone") + F.coalesce("both", F.lit(0))).alias("value"))

    q = _probability(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    above = priced.where("n > 0").withColumn("q", q).where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(above.withColumn("rank", rank).where(F.col("rank") <= term_ranks))


shared.by_value(sys.modules[__name__])
