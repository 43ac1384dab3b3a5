"""Benchmark decontamination: item-sized windows, SimHash blocks, exact weighted-shingle similarity.

A window as long as a benchmark item can reach the similarity only if enough of its shingles are the item's, so
windows start at shared shingles; the others need no fingerprint. Which items a window is held against is then
decided by its fingerprint alone: fingerprints within the radius agree in at least one of radius + 1 blocks of bits,
so windows and items of one size meet by an equi-join on (block, bits). Pairs within the radius are compared exactly,
by the multisets of shingles. All of it is column expressions and joins.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, once, row_key, words

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Bits that may differ. Windows of similarity 0.8 differ in about ten bits; more blocks than bits keep the guarantee.
RADIUS = 23
#: Rows up to which a side is broadcast: shingles of the benchmark, documents with candidate windows.
BROADCAST_ROWS = 500_000
_LANES = 0x0001000100010001


def _shift(x: Column, by: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", x, F.lit(by) if isinstance(by, int) else by)


def _grams(hashes: Column, n: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of word hashes; fewer words: none."""
    return F.transform(
        F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
    )


def _fingerprint(rows: DataFrame, grams: str, out: str) -> DataFrame:
    """Add the SimHash of an array of hashes; 16-bit lanes count four bits of the hashes at once."""
    n = F.size(grams)
    rows = rows.withColumn("__sums", F.array(*[_lane_sum(grams, j) for j in range(16)]))
    bits = []
    for j in range(16):
        for lane in range(4):
            ones = _shift(F.get("__sums", F.lit(j)), 16 * lane).bitwiseAND(F.lit(0xFFFF).cast("long"))
            bits.append(F.when(ones * 2 > n, F.lit(_signed(1 << (16 * lane + j)))).otherwise(F.lit(0).cast("long")))
    return rows.withColumn(out, reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("__sums")


def _lane(g: Column, j: int) -> Column:
    return _shift(g, j).bitwiseAND(F.lit(_LANES).cast("long"))


def _lane_sum(grams: str, j: int) -> Column:
    return F.aggregate(grams, F.lit(0).cast("long"), lambda a, g: a + _lane(g, j))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _numbered(grams: Column) -> Column:
    """Makes a multiset a set: every hash with the number of its equals before it."""
    return F.transform(grams, lambda g, i: F.struct(g.alias("gram"), F.size(F.filter(F.slice(grams, 1, i), lambda x: x == g)).alias("before")))


def _overlap(a: str, b: str) -> Column:
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.size(F.array_intersect(_numbered(F.col(a)), _numbered(F.col(b)))))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Pairs of documents and benchmark items of which some item-sized window is similar enough.

    Returns id_col, item_col, similarity (of the best window, shingles weighted by how often they occur) and key
    (the id and a digest of the text). Words are lower-cased; shingles have five words, all words of an item that has fewer.
    A document shorter than an item is one window. Null and blank texts match nothing; rows that share id and text
    give one pair; an empty table gives none; other columns are dropped.
    """
    ratio = similarity / (1 + similarity)
    items = benchmark.select(benchmark[item_col].alias("item"), _word_hashes(benchmark[item_text_col]).alias("hashes"))
    items = items.withColumn("n", F.size("hashes")).where("n > 0").withColumn("k", F.least(F.col("n"), F.lit(SHINGLE_WORDS)))
    sizes = [F.when(F.col("k") == k, _grams(F.col("hashes"), F.col("n"), k)) for k in range(1, SHINGLE_WORDS + 1)]
    items = items.select("item", "k", F.coalesce(*sizes).alias("item_grams")).withColumn("m", F.size("item_grams"))
    items = materialize(_fingerprint(items, "item_grams", "item_fp").distinct(), "items")
    seen = materialize(items.select("item", "k", "m", F.explode("item_grams").alias("gram")).distinct(), "item-grams")
    small = seen.count() <= BROADCAST_ROWS
    lengths = [r[0] for r in items.select("k").distinct().collect()]  # at most five values

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    rows = once(rows.withColumn("key", row_key(F.col("id"), F.col("text"))), hashes=_word_hashes(F.col("text"))).withColumn("n", F.size("hashes"))
    hits = None
    for k in lengths:
        at = rows.where(F.col("n") >= k).select("key", "n", "hashes", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("p"))
        at = at.select("key", (F.col("n") - k + 1).alias("size"), "p", F.xxhash64(*[F.get("hashes", F.col("p") + j) for j in range(k)]).alias("gram"))
        mine = seen.where(F.col("k") == k).select("gram", "item", "m")
        found = at.join(F.broadcast(mine) if small else mine, "gram").select("key", F.lit(k).alias("k"), "item", "m", "size", "p")
        hits = found if hits is None else hits.unionByName(found)
    schema = f"{id_col} {rows.schema['id'].dataType.simpleString()}, {item_col} {items.schema['item'].dataType.simpleString()}, similarity double, key {rows.schema['key'].dataType.simpleString()}"
    if hits is None:
        return docs.sparkSession.createDataFrame([], schema)

    # Positions per document and item; a window from hit i holds enough hits if hit i + least - 1 lies inside it.
    placed = hits.groupBy("key", "k", "item", "m", "size").agg(F.sort_array(F.collect_set("p")).alias("at"))
    span = F.least("m", "size")
    least = F.greatest(F.ceil((F.col("m") + span) * ratio - 1e-9).cast("int"), F.lit(1))
    placed = placed.withColumn("span", span).withColumn("least", least).where(F.size("at") >= F.col("least"))
    last = F.col("size") - F.col("span")

    def full(p: Column, i: Column) -> Column:
        return (p <= last) & F.coalesce(F.get("at", i + F.col("least") - 1) < p + F.col("span"), F.lit(False))

    ends = F.when(F.get("at", F.size("at") - F.col("least")) >= last, F.array(last)).otherwise(F.array().cast("array<int>"))
    starts = F.array_distinct(F.concat(F.filter("at", full), ends))
    windows = placed.select("key", "k", "m", "span", F.explode(starts).alias("start")).distinct()
    candidates = materialize(windows.groupBy("key", "k", "m", "span").agg(F.collect_list("start").alias("starts")), "candidates")
    few = candidates.count() <= BROADCAST_ROWS
    texts = rows.select("id", "key", "hashes", "n").join(F.broadcast(candidates) if few else candidates, "key")
    grams = F.coalesce(*[F.when(F.col("k") == k, _grams(F.col("hashes"), F.col("n"), k)) for k in lengths])
    texts = texts.withColumn("grams", grams).select("id", "key", "k", "m", "span", "grams", F.explode("starts").alias("start"))
    windows = texts.withColumn("window", F.slice("grams", F.col("start") + 1, F.col("span"))).drop("grams")
    windows = materialize(_fingerprint(windows, "window", "fp"), "windows")  # else the join repeats the fingerprint's terms

    masks = block_masks(radius + 1)

    def by_block(fingerprints: DataFrame, fp: str) -> DataFrame:
        blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.col(fp).bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
        return fingerprints.select("*", F.inline(blocks))

    index = by_block(items, "item_fp")
    differing = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first_shared = F.coalesce(*[F.when(differing.bitwiseAND(F.lit(m)) == 0, i) for i, m in enumerate(masks)])
    near = by_block(windows.select("id", "key", "k", "m", "start", "window", "fp"), "fp").join(F.broadcast(index) if small else index, ["k", "m", "block", "bits"])
    near = near.where((first_shared == F.col("block")) & (F.bit_count(differing) <= radius))  # a pair once, whatever it shares
    near = near.withColumn("overlap", _overlap("window", "item_grams"))
    near = near.withColumn("similarity", F.col("overlap") / (F.size("window") + F.size("item_grams") - F.col("overlap")))
    best = near.where(F.col("similarity") >= similarity - 1e-9).groupBy("id", "key", "item").agg(F.max("similarity").alias("similarity"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "similarity", "key")


def block_masks(blocks: int) -> list[int]:
    """Signed masks that cut 64 bits into blocks of nearly one size."""
    edges = [math.floor(64 * i / blocks) for i in range(blocks + 1)]
    return [_signed(((1 << (b - a)) - 1) << a) for a, b in zip(edges, edges[1:], strict=False)]


def remove(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of which no window matches a benchmark item, with all their columns."""
    found = materialize(find(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col("key").alias("__leak")).distinct(), "leaks")
    few = found.count() <= BROADCAST_ROWS
    key = row_key(docs[id_col], docs[text_col])
    return docs.join(F.broadcast(found) if few else found, key == F.col("__leak"), "left_anti")
