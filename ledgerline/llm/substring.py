"""Substring deduplication: seeds from winnowed anchors, extended both ways to maximal repeats.

Winnowing picks in every window of `length` words one k-word anchor, by content alone, so equal windows pick the
same anchor at the same offset. The windows around one anchor occurrence form a block: the anchor extended both
ways as far as it stays the chosen one. Occurrences meet on (anchor, block): all but those in the block's first
document repeat the whole block. Where an anchor heads several blocks, the first occurrence of each is compared
window by window. Overlapping repeated windows merge to maximal repeats. Every step meets on a content hash and
takes a minimum, so a passage in m documents costs m rows, never m * m pairs.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .shared import materialize

ANCHOR_WORDS = 10
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a polynomial hash over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any run of a text's words, from prefix sums modulo 2**64."""

    def __init__(self, words: list[bytes]):
        import xxhash

        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(w) for w in words], np.uint64)
        powers = np.full(len(words) + 1, _BASE)
        powers[0] = 1
        self.inverse = np.full(len(words) + 1, _INVERSE)
        self.inverse[0] = 1
        powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(self.inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(hashes * powers[:-1])])

    def runs(self, start: np.ndarray, size) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.inverse[start] + np.asarray(size, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def blocks(words: list[bytes], length: int, k: int):
    """(anchor, block, start, windows) arrays: the runs of window starts with one chosen anchor occurrence."""
    rolling = Rolling(words)
    grams = rolling.runs(np.arange(len(words) - k + 1), k)
    width = length - k + 1
    chosen = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    chosen += np.arange(len(chosen))
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    count = np.diff(np.append(first, len(chosen)))
    anchor, offset = grams[chosen[first]], (chosen[first] - first).astype(np.uint64)
    block = _mix(rolling.runs(first, count + length - 1) + offset)
    return anchor.view(np.int64), block.view(np.int64), first.astype(np.int32), count.astype(np.int32)


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """Remove words covered by a window of `length` words that also starts in a document with a smaller id.

    Windows are judged on the input. Returns id_col, n_words long, n_removed long, kept string (kept words joined
    by one space). One row per input row. A null text has no words; a row with a null id neither loses words nor
    takes any from others; rows that share id and text are judged alike and never by one another; an empty table
    gives no rows; other columns are dropped.
    """
    if length <= anchor_words:
        raise ValueError("length must exceed anchor_words")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    key = F.xxhash64("id", "text")  # rows that share id and text share a key
    rows = rows.withColumn("key", key)
    id_type = rows.schema["id"].dataType.simpleString()
    seeds_schema = f"id {id_type}, key bigint, anchor bigint, block bigint, start int, windows int"

    def seed(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or "").encode().split()
                if len(words) < length or not batch.column(0)[i].is_valid:
                    continue
                anchor, block, start, windows = blocks(words, length, anchor_words)
                n = len(anchor)
                ids = pa.array([batch.column(0)[i].as_py()] * n, batch.schema.field(0).type)
                keys = pa.array(np.full(n, batch.column(2)[i].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, keys, *map(pa.array, (anchor, block, start, windows))], _columns(seeds_schema))

    def seed_gathered(batches):
        """Fewer, larger batches: most texts give a few dozen rows."""
        held, n = [], 0
        for batch in seed(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    seeds = materialize(rows.mapInArrow(seed_gathered, seeds_schema), "seeds")
    firsts = seeds.groupBy("anchor", "block").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    varied = firsts.groupBy("anchor").agg(F.count("*").alias("blocks")).where("blocks > 1").select("anchor", F.lit(True).alias("varied"))
    telling = materialize(firsts.join(varied, "anchor", "left").where("varied or first_id < last_id"), "blocks")
    met = materialize(seeds.join(telling, ["anchor", "block"]).where("varied or first_id < id").select(*_columns(seeds_schema), "first_id"), "met")
    whole = met.where("first_id < id").select("key", "start", "windows")

    # Where an anchor heads several blocks: windows of the first document of each.
    spans = met.where("first_id = id").groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    windows_schema = f"id {id_type}, key bigint, start int, content bigint"

    def extend(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rolling = Rolling(batch.column(1)[i].as_py().encode().split())
                starts = np.concatenate([np.arange(s["start"], s["start"] + s["windows"]) for s in batch.column(3)[i].as_py()])
                n = len(starts)
                ids = pa.array([batch.column(0)[i].as_py()] * n, batch.schema.field(0).type)
                keys = pa.array(np.full(n, batch.column(2)[i].as_py()), pa.int64())
                content = rolling.runs(starts, length).view(np.int64)
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(starts.astype(np.int32)), pa.array(content)], _columns(windows_schema))

    contested = rows.dropDuplicates(["key"]).join(spans, "key").select("id", "text", "key", "spans")
    windows = materialize(contested.mapInArrow(extend, windows_schema), "windows")
    earliest = windows.groupBy("content").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id")
    single = windows.join(earliest, "content").where("first_id < id").select("key", "start", F.lit(1).alias("windows"))

    repeats = whole.unionByName(single).distinct().groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    gone[s["start"]] += 1
                    gone[s["start"] + s["windows"] - 1 + length] -= 1
                keep = gone[:-1].cumsum() == 0
                n_words.append(len(words))
                n_removed.append(len(words) - int(keep.sum()))
                kept.append(b" ".join(words if not spans else [w for w, k in zip(words, keep, strict=True) if k]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    cut_schema = f"id {id_type}, n_words bigint, n_removed bigint, kept string"
    return rows.join(repeats, "key", "left").select("id", "text", "spans").mapInArrow(cut, cut_schema).withColumnRenamed("id", id_col)


shared.by_value(sys.modules[__name__])
