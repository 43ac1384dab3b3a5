"""Near copies of whole documents: word-shingle sets of at least a Jaccard similarity, found exactly.

First SimHash: fingerprints of the same shingles are linked through the vantage-point tree of simhash.py, each set with
one of a fingerprint that it is linked with, and links that hold on the exact sets join groups. Within the radius
that covers similarity 0.8 (23 of 64 bits) lie also about 1.6% of all unrelated pairs, and no vantage point tells such
pairs apart, so the tree takes a small radius, and what it cannot see is found by the shingles: two sets can be similar
only if they share a shingle of their short prefixes, rare shingles first. Equal sets are one node. A set meets the head
of each of its prefix shingles too; after that only sets that are not yet in one group meet each other, so a family of
copies does not cost the square of its size. Every link is verified on the exact sets.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared, simhash
from .components import connected_components
from .shared import Scratch, materialize

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Differing bits up to which the tree links fingerprints, and their seed.
RADIUS, SEED = 2, 42
#: Shingle classes whose counts decide the order of shingles.
CLASS_BITS = 16
#: Rows up to which a table of keys is broadcast.
BROADCAST_ROWS = 500_000


def shingles(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of an A-Z-lower-cased text; fewer words: all of them are one."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return np.array([digest(b" ".join(words), len(words))] if words else [], np.uint64)
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(29)))


def _class(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _keys(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fingerprint_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of sets to verify, a before b, from sid and fp: sets of one fingerprint and of fingerprints linked in the tree."""
    unique = materialize(prints.groupBy("fp").agg(F.min("sid").alias("first")), "unique")
    roots = simhash.link_roots(unique, radius=radius).join(unique.select(F.col("fp").alias("root"), F.col("first").alias("top")), "root")
    # Sets of one fingerprint meet the first of them, firsts the first of the fingerprint that their shard of the tree links them to.
    own = prints.join(unique, "fp").select(F.col("first").alias("a"), F.col("sid").alias("b"))
    linked = roots.join(unique, "fp").select(F.least("top", "first").alias("a"), F.greatest("top", "first").alias("b"))
    return own.unionByName(linked).where("a != b").distinct()


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """key (hash of id and text), id and first (the key that stays) of the rows, one per key.

    Rows are grouped by links between texts whose shingle sets have the similarity; texts without words are
    copies of each other. The first of a group has the smallest id, null ids last, then the smallest key.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def survey(batches):
        import xxhash

        counts = np.zeros(1 << CLASS_BITS, np.int64)
        for batch in batches:
            sets, sizes, fps = [], [], []
            for text in batch.column(2):
                grams = shingles(text.as_py(), shingle_words)
                counts += np.bincount(_class(grams), minlength=len(counts)) if len(grams) > 4096 else 0
                if len(grams) <= 4096:
                    np.add.at(counts, _class(grams), 1)
                sets.append(xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63))
                sizes.append(len(grams))
                fps.append(fingerprint(text.as_py(), shingle_words, SEED) if len(grams) else None)
            none = pa.nulls(len(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.int64()), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), none, none], names)
        at = np.flatnonzero(counts)
        blank = [pa.nulls(len(at), t) for t in (pa.int64(), ids, pa.int64(), pa.int32(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*blank, pa.array(at), pa.array(counts[at])], names)

    from pyspark.sql.pandas.types import to_arrow_type

    fingerprint = simhash.fingerprint  # alone: the tasks get no whole module
    names, ids = ["key", "id", "sid", "n", "fp", "class", "count"], to_arrow_type(rows.schema["id"].dataType)
    surveyed = scratch.write(rows.mapInArrow(survey, f"key bigint, id {id_type}, sid bigint, n int, fp bigint, class bigint, count bigint"), "shingle-sets")
    sets = surveyed.where("class is null").select("key", "id", "sid", "n", "fp").dropDuplicates(["key"])
    levels = np.zeros(1 << CLASS_BITS, np.uint64)
    for c, n in surveyed.where("class is not null").groupBy("class").agg(F.sum("count")).collect():  # a number per class
        levels[c] = int(4 * math.log2(n))

    # One row of each set stands for it; texts of one set may differ in how often a shingle occurs, so in their fingerprints.
    chosen = scratch.write(sets.groupBy("sid").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.count("*").alias("rows")), "chosen")
    copies = scratch.write(sets.join(chosen.where("rows > 1").select("sid", F.col("key").alias("mine")), "sid").where("key != mine").select("key"), "copies")
    texts = rows.select("key", "text").join(_keys(copies), "key", "left_anti")

    def post(batches):
        import xxhash

        for batch in batches:
            grams, sids, sizes = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), shingle_words)
                if not len(found):
                    continue
                size = len(found) - math.ceil(len(found) * similarity - 1e-9) + 1
                order = np.lexsort((found, levels[_class(found)]))[:size]
                grams.append(found[order].view(np.int64))
                sids.append(np.full(size, xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63), np.int64))
                sizes.append(np.full(size, len(found), np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (grams, sids, sizes)], ["gram", "sid", "n"])

    posts = texts.mapInArrow(post, "gram bigint, sid bigint, n int")
    in_order = Window.partitionBy("gram").orderBy("sid")
    late = scratch.write(posts.withColumns({"head": F.first("sid").over(in_order), "head_n": F.first("n").over(in_order)}).where("sid != head"), "late")

    def sizes_fit(a: str, b: str):
        return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9

    def load(batches):
        for batch in batches:
            found = [shingles(t.as_py(), shingle_words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["sid", "grams"])

    def check(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), similarity) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of sets that have the similarity."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        wanted = scratch.write(chosen.join(wanted, "sid", "left_semi").select("key", "sid"), "wanted")
        again = rows.select("key", "text").join(_keys(wanted), "key").dropDuplicates(["sid"]).select("sid", "text")
        own = Scratch(docs.sparkSession)
        exact = own.write(again.mapInArrow(load, "sid bigint, grams binary"), "exact-sets")
        both = pairs.join(exact.select(F.col("sid").alias("a"), F.col("grams").alias("x")), "a").join(exact.select(F.col("sid").alias("b"), F.col("grams").alias("y")), "b")
        good = scratch.write(both.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint"), "verified")
        own.release()
        return good

    # First what the tree finds and heads, then other groups.
    met = late.where(sizes_fit("head_n", "n")).select(F.col("head").alias("a"), F.col("sid").alias("b"))
    near = fingerprint_pairs(chosen.where("fp is not null").select("sid", "fp"))
    met = scratch.write(near.unionByName(met).distinct(), "pairs")
    links = verified(met)
    roots = scratch.write(connected_components(links, "a", "b"), "roots")
    placed = late.select("gram", "sid", "n").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    mixed = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("gram")
    placed = scratch.write(placed.join(mixed, "gram", "left_semi"), "placed")
    other = placed.select("gram", *[F.col(c).alias(f"o_{c}") for c in ("sid", "n", "root")])
    more = placed.join(other, "gram").where((F.col("root") != F.col("o_root")) & (F.col("sid") < F.col("o_sid")) & sizes_fit("n", "o_n"))
    more = more.groupBy(F.col("sid").alias("a"), F.col("o_sid").alias("b"), "n", "o_n").agg(F.count("*").alias("shared"))
    # What is not in both prefixes lies behind the end of that prefix which ends first.
    behind = F.greatest(F.ceil(F.col("n") * similarity - 1e-9), F.ceil(F.col("o_n") * similarity - 1e-9)) - 1
    more = more.where(F.col("shared") + behind >= F.ceil((F.col("n") + F.col("o_n")) * (similarity / (1 + similarity)) - 1e-9))
    more = scratch.write(more.select("a", "b").join(met, ["a", "b"], "left_anti"), "more-pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more))
        roots = scratch.write(connected_components(links, "a", "b"), "roots")

    grouped = sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("first"))
    out = materialize(grouped.join(first, "root").select("key", "id", F.col("first.key").alias("first")), "near-copy-groups")
    scratch.release()
    return out


def remove_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Of each group of near copies the first row, with all its columns; of rows that share id and text one."""
    key = F.xxhash64(docs[id_col], docs[text_col])
    found = groups(docs, id_col=id_col, text_col=text_col, **options)
    gone = materialize(found.where("key != first").select(F.col("key").alias("__key")), "near-copies")
    again = materialize(docs.select(key.alias("__key")).groupBy("__key").agg(F.count("*").alias("n")).where("n > 1").select("__key"), "repeated")
    kept = docs.withColumn("__key", key).join(_keys(gone), "__key", "left_anti")
    once = kept.join(_keys(again), "__key", "left_anti")
    repeated = kept.join(_keys(again), "__key", "left_semi").dropDuplicates(["__key"])
    return once.unionByName(repeated).select(*docs.columns)


shared.by_value(sys.modules[__name__])
