"""SimHash near-duplicates over a vantage-point tree.

Fingerprints are split by their Hamming distance to vantage points. By the triangle inequality two fingerprints
within the radius whose distances to a vantage point lie on either side of its threshold both lie within the
radius of it, so the outer branch also takes the boundary band of the inner one: every linked pair meets in a
branch. The upper levels, fitted on a bounded sample, deal fingerprints to shards; a shard that holds too many is
dealt again by a tree fitted on a sample of its own, until all fit; inside, each goes on splitting the same way. The
trees decide where work is done, never which pairs are found.
"""

from __future__ import annotations

import math
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import connected_components
from .shared import materialize

#: Sampled fingerprints for the upper tree, fingerprints a shard aims at, levels of the upper tree at most.
SAMPLE, SHARD, LEVELS = 8192, 20_000, 12
#: Fingerprints that a leaf inside a shard compares directly.
LEAF = 256


def fingerprint(text: str | None, shingle_words: int, seed: int) -> int:
    """64-bit SimHash of the word shingles of an A-Z-lower-cased text, as a signed integer; no words: zero."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    hashes = np.array([digest(s, seed) for s in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, seed: int = 42) -> DataFrame:
    """id_col, fp long for every row; whole texts, no shuffle."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint").withColumnRenamed("id", id_col)


def differing(a: np.ndarray, b) -> np.ndarray:
    """Differing bits; counted on unsigned values, as numpy counts the bits of a signed number's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def distances(fps: np.ndarray, vantage: int) -> np.ndarray:
    return differing(fps, np.int64(vantage)).astype(np.int16)


def split(fps: np.ndarray, vantage: int, threshold: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the inner branch and of the outer one with the inner's boundary band."""
    d = distances(fps, vantage)
    return d <= threshold, d > threshold - radius


def build_tree(sample: np.ndarray, levels: int, radius: int):
    """Nested (vantage, threshold, inner, outer); None is a shard."""
    if levels == 0 or len(sample) < 64:
        return None
    vantage = int(sample[0])
    threshold = int(np.median(distances(sample, vantage)))
    inner, outer = split(sample, vantage, threshold, radius)
    if max(inner.sum(), outer.sum()) > 0.95 * len(sample):
        return None
    return vantage, threshold, build_tree(sample[1:][inner[1:]], levels - 1, radius), build_tree(sample[1:][outer[1:]], levels - 1, radius)


def route(fps: np.ndarray, tree, radius: int, at: int = 1):
    """(shard, fingerprints) pairs; a fingerprint in a boundary band goes to several shards."""
    if not len(fps):
        return
    if tree is None:
        yield at, fps
        return
    vantage, threshold, inside, outside = tree
    inner, outer = split(fps, vantage, threshold, radius)
    yield from route(fps[inner], inside, radius, 2 * at)
    yield from route(fps[outer], outside, radius, 2 * at + 1)


def _settle(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable over links a-b among n positions."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def local_roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """For sorted distinct fingerprints of a shard: the position of the smallest one linked with each."""
    heads, tails = [], []

    def compare(at: np.ndarray) -> None:
        near = differing(fps[at][:, None], fps[at][None, :]) <= radius
        rows, cols = np.nonzero(np.triu(near, 1))
        heads.append(at[rows])
        tails.append(at[cols])

    def dense(at: np.ndarray) -> None:
        """No vantage point splits these. At radius 2, two are linked exactly if both have one same value within one bit."""
        if radius != 2:
            for i in range(0, len(at), LEAF):
                for j in range(i, len(at), LEAF):
                    compare(np.unique(np.concatenate([at[i : i + LEAF], at[j : j + LEAF]])))
            return
        masks = np.concatenate([[0], 1 << np.arange(64, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
        values = (fps[at][:, None] ^ masks[None, :]).ravel()
        owner = np.repeat(at, len(masks))
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        heads.append(owner[order][:-1][same])
        tails.append(owner[order][1:][same])

    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) <= LEAF:
            if len(at) > 1:
                compare(at)
            continue
        vantage = fps[at[len(at) // 2]]
        threshold = int(np.median(distances(fps[at], vantage)))
        inner, outer = split(fps[at], vantage, threshold, radius)
        if max(inner.sum(), outer.sum()) > 0.9 * len(at):
            dense(at)
        else:
            todo += [at[inner], at[outer]]
    empty = np.zeros(0, np.int64)
    return _settle(len(fps), np.concatenate([empty, *heads]), np.concatenate([empty, *tails]))


def _tree_levels(n: int, shard: int) -> int:
    """Levels that bring n fingerprints to about the size of a shard; a branch keeps some 0.6 of its parent."""
    return min(LEVELS, max(0, math.ceil(math.log(max(n, 1) / shard) / math.log(1 / 0.6)))) if n > shard else 0


def _dealt_again(dealt: DataFrame, radius: int, shard: int, sample: int, turn: int) -> DataFrame:
    """dealt (shard, fp, open) with every open shard above the size split by a tree of its own.

    open is false for a shard that fits or that its tree doesn't split.
    """
    large = materialize(dealt.where("open").groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard), f"large-{turn}")
    rows = dealt.join(large, "shard", "left")
    done = rows.where("n is null").select("shard", "fp", F.lit(False).alias("open"))
    mine = rows.where("n is not null")
    drawn = mine.where(F.pmod(F.xxhash64("fp", F.lit(turn)), "n") < sample).select("shard", "n", "fp")

    def fit(key, got):
        fps = got.column("fp").to_numpy()
        tree = build_tree(fps, _tree_levels(got.column("n")[0].as_py(), shard), radius)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = materialize(drawn.groupBy("shard").applyInArrow(fit, "shard bigint, tree binary"), f"trees-{turn}")

    def deal(batches):
        for batch in batches:
            of = batch.column(0).to_numpy()
            for at in np.unique(of):
                here = np.flatnonzero(of == at)
                tree = pickle.loads(batch.column(2)[int(here[0])].as_py())
                for leaf, fps in route(batch.column(1).to_numpy()[here], tree, radius):
                    # The name of a leaf is a hash; should two agree, they are one larger shard.
                    name = int(at) if tree is None else (int(at) * 0x9E3779B97F4A7C15 + leaf * 0xBF58476D1CE4E5B9 + (1 << 63)) % (1 << 64) - (1 << 63)
                    n = len(fps)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, name), pa.int64()), pa.array(fps, pa.int64()), pa.array(np.full(n, tree is not None))], ["shard", "fp", "open"])

    again = mine.select("shard", "fp").join(trees, "shard").select("shard", "fp", "tree").mapInArrow(deal, "shard bigint, fp bigint, open boolean")
    return done.unionByName(again)


def link_roots(unique: DataFrame, *, radius: int = 2, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Links (fp, root) that join all fingerprints within the radius of each other; unique: fp, distinct."""
    n = unique.count()
    levels = _tree_levels(n, shard)
    picked = [r[0] for r in unique.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()] if levels else []
    tree = build_tree(np.array(picked, np.int64), levels, radius)

    def deal(batches):
        for batch in batches:
            for at, fps in route(batch.column(0).to_numpy(), tree, radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), at), pa.int64()), pa.array(fps, pa.int64())], ["shard", "fp"])

    def solve(got: pa.Table) -> pa.Table:
        fps = np.unique(got.column("fp").to_numpy())
        root = fps[local_roots(fps, radius)]
        linked = root != fps
        return pa.table({"fp": fps[linked], "root": root[linked]})

    dealt = unique.select("fp").mapInArrow(deal, "shard bigint, fp bigint")
    if tree is not None:
        dealt = materialize(dealt.withColumn("open", F.lit(True)), "dealt")
        turn = 0
        while not dealt.where("open").groupBy("shard").count().where(F.col("count") > 2 * shard).isEmpty():
            turn += 1
            dealt = materialize(_dealt_again(dealt, radius, shard, sample, turn), "dealt")
    return dealt.select("shard", "fp").groupBy("shard").applyInArrow(solve, "fp bigint, root bigint")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """Groups of documents linked through fingerprints at most radius bits apart.

    Returns id_col, fp long, component (the smallest id_col of the group; null ids are ignored by the minimum).
    One row per input row; equal texts have equal fingerprints; null, empty and blank texts have fingerprint zero
    and are linked like any other; an empty table gives no rows; other columns are dropped. Equal fingerprints
    are one node, so copies cost one row each.
    """
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, seed=seed), "fingerprints")
    unique = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("first")), "unique")
    roots = connected_components(link_roots(unique, radius=radius), "fp", "root").select(F.col("node").alias("fp"), "root")
    rooted = unique.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    of_fp = rooted.join(smallest, "root").select("fp", "component")
    return fps.join(of_fp, "fp").select(id_col, "fp", "component")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


shared.by_value(sys.modules[__name__])
