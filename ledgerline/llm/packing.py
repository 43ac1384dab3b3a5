"""Best-fit packing of token sequences by bin completion.

Pieces of equal length are interchangeable, so what has to be packed is a table of at most `capacity` rows: how many
pieces there are of each length. A branch-and-bound search over that table, which does not grow with the corpus, gives
patterns (fillings of one sequence) and how often each is used. Spark numbers the pieces of each length and looks up the
sequence and offset of each number.
"""

from __future__ import annotations

import itertools
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import shared
from .shared import Scratch

CAPACITY = 2048

#: The search opens at most so many nodes, and looks at so many fillings of one; the incumbent is whole at any time.
MAX_NODES, MAX_FILLINGS, MAX_STEPS = 20_000, 64, 20_000

#: Pieces of one length are numbered in so many parts.
PARTS = 512

#: Chunks of at most this many characters are remembered, so many of them at most per worker.
MEMO_CHARS, MEMO_ENTRIES = 40, 800_000

ASCII_BLANKS, MARKS = "\t\n\r\f\v", (".", ",", ";", ":", "!", "?")

Filling = tuple[int, ...]  # lengths in one sequence, descending
Packing = list[tuple[int, Filling]]  # how often each filling is used


class Chunks(dict):
    """Packed ids by chunk of a text between ASCII blanks.

    The vocabulary's normalizer and pre-tokenizer drop blanks and never look across them, so a text's ids are those of
    its chunks one after the other. Long chunks are encoded but not remembered.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Remember new chunks; gives those that are too long to be remembered.

        A letter is never in one pre-token with a mark after it, so a chunk is that of its letters and that of its mark,
        and upper-case ASCII has the ids of lower case.
        """
        parts = {}
        for chunk in chunks:
            core = chunk[:-1] if chunk[-1:] in MARKS and chunk[-2:-1].isalpha() else chunk
            parts[chunk] = core.lower() if core.isascii() and core.isalnum() else core
        cores = [c for c in {*parts.values(), *MARKS} if c not in self]
        packed = {c: struct.pack(f"<{len(got.ids)}I", *got.ids) for c, got in zip(cores, self.tokenizer.encode_batch_fast(cores, add_special_tokens=False), strict=True)}
        self.update((c, ids) for c, ids in packed.items() if len(c) <= MEMO_CHARS)
        long = {}
        for chunk, core in parts.items():
            whole = packed[core] if core in packed else self[core]
            if len(core) != len(chunk):
                whole += self[chunk[-1]]
            (self if len(chunk) <= MEMO_CHARS else long)[chunk] = whole
        return long

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        for blank in ASCII_BLANKS:
            text = text.replace(blank, " ")
        chunks = text.split(" ")
        new = {c for c in chunks if c not in self}
        if len(self) + len(new) > MEMO_ENTRIES:
            self.clear()
            new = {*chunks}
        long = self.learn(new) if new else {}
        if long:
            return b"".join([long[c] if c in long else self[c] for c in chunks])
        return b"".join(map(self.__getitem__, chunks))


def _chunks(spec: str) -> Chunks:
    """One encoder per Python worker and vocabulary, kept between tasks."""
    kept = sys.__dict__.setdefault("_ledgerline_chunks", {})
    key = hash(spec)
    if key not in kept:
        kept.clear()
        kept[key] = Chunks(spec)
    return kept[key]


def token_pieces(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 8_000_000) -> DataFrame:
    """Encode each whole text, end it with end_id and cut what is longer than capacity.

    vocabulary: path of a tokenizers file, read on the driver and broadcast (a few MB, fixed). Returns id_col, piece int
    (from 0), start long (ids of its document before it), length long, ids binary (little-endian unsigned 32-bit). A null or
    empty text is one piece of one id; rows that are equal give equal pieces; an empty table gives no rows; other columns
    are dropped. There is no shuffle.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        chunks, end, step = _chunks(spec.value), struct.pack("<I", end_id), 4 * capacity
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            of, piece, held, size = [], [], [], 0

            def handed_on():
                length = pa.array([len(p) // 4 for p in held], pa.int64())
                number = pa.array(piece, pa.int32())
                start = pa.array(np.array(piece, np.int64) * capacity)
                return pa.RecordBatch.from_arrays([ids.take(pa.array(of, pa.int64())), number, start, length, pa.array(held, pa.binary())], ["id", "piece", "start", "length", "ids"])

            for i in range(len(texts)):
                whole = chunks.encode(texts[i].as_py() or "") + end
                for k, at in enumerate(range(0, len(whole), step)):
                    of.append(i)
                    piece.append(k)
                    held.append(whole[at : at + step])
                    size += len(held[-1])
                    if size >= batch_bytes:
                        yield handed_on()
                        of, piece, held, size = [], [], [], 0
            if held:
                yield handed_on()

    out = rows.mapInArrow(run, f"id {id_type}, piece int, start bigint, length bigint, ids binary")
    return out.withColumnRenamed("id", id_col)


def fewest(counts: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing gets below: for each k, pieces over capacity - k each need one, and those of k or more must fit beside them."""
    lengths = sorted(counts)
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in [n for n in lengths if 2 * n <= capacity] + [0]:
        large = sum(counts[n] for n in lengths if n > capacity - k)
        halves = [n for n in lengths if capacity - k >= n > capacity / 2]
        space = sum(counts[n] * (capacity - n) for n in halves)
        small = sum(n * counts[n] for n in lengths if capacity / 2 >= n >= k)
        best = max(best, large + sum(counts[n] for n in halves) + max(0, -(-(small - space) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing over lengths: each goes into the fullest sequences that take it."""
    open_: dict[int, dict[Filling, int]] = {}  # by room left
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = min(capacity // length, left)
                bins, filling = left // each, (length,) * each
                open_.setdefault(capacity - each * length, {})[filling] = bins
                left -= each * bins
                continue
            filling, bins = open_[room].popitem()
            each = min(room // length, left)
            used = min(bins, left // each)
            if used < bins:
                open_[room][filling] = bins - used
            elif not open_[room]:
                del open_[room]
            taken = filling + (length,) * each
            group = open_.setdefault(room - each * length, {})
            group[taken] = group.get(taken, 0) + used
            left -= used * each
    return [(n, filling) for group in open_.values() for filling, n in group.items()]


def dominated(filling: Filling, waste: int, free: np.ndarray) -> bool:
    """True if one free longer piece could stand for one or two pieces of a filling: whatever the filling allows, that one does too."""
    for few in {*itertools.combinations(filling, 1), *itertools.combinations(filling, 2)}:
        s = sum(few)
        span = free[s + (len(few) == 1) : s + waste + 1].copy()
        for n in filling:  # a length counts as free only if copies beyond those in the filling are left
            if s <= n < s + len(span) and n - s - (len(few) == 1) >= 0:
                span[n - s - (len(few) == 1)] -= filling.count(n)
        if (span > 0).any():
            return True
    return False


def fillings(free: np.ndarray, room: int, most_waste: int) -> Iterator[tuple[int, Filling]]:
    """(waste, lengths) of undominated fillings of the room with the free pieces, least waste first.

    One piece that fills the room dominates all else; two that do need no search.
    """
    if not room or free[room] > 0:
        yield 0, (room,) if room else ()
        return
    half = np.arange(room - 1, (room - 1) // 2, -1)
    for n in half[(free[half] > 0) & (free[room - half] > (2 * half == room))].tolist():
        yield 0, (n, room - n)
    lengths = np.flatnonzero(free[: room + 1])
    reach = 1  # bit s: pieces of free lengths, any number of each, can sum to s
    for n in lengths.tolist():
        if reach >> n & 1:
            continue  # shorter ones sum to it
        step = n
        while step <= room:
            reach |= reach << step
            step *= 2
    mask, steps = (1 << room + 1) - 1, 0
    reach &= mask

    def exact(s: int, top: int) -> Iterator[Filling]:
        nonlocal steps
        if s == 0:
            yield ()
            return
        here = lengths[: np.searchsorted(lengths, min(s, top), side="right")][::-1]
        for n in here.tolist():
            steps += 1
            if steps > MAX_STEPS:
                return
            if free[n] <= 0 or not reach >> (s - n) & 1 or n * (s // n) < s and n == here[-1]:
                continue
            free[n] -= 1
            for tail in exact(s - n, n):
                yield (n, *tail)
            free[n] += 1

    for waste in range(min(room, most_waste) + 1):
        if reach >> (room - waste) & 1:
            for filling in exact(room - waste, room):
                if waste == 0 and len(filling) == 2:
                    continue  # given above
                back = free.copy()
                for n in filling:
                    back[n] += 1
                if not dominated(filling, waste, back):
                    yield waste, filling
        if steps > MAX_STEPS:
            return


def complete_bins(counts: dict[int, int], capacity: int, *, max_nodes: int = MAX_NODES) -> Packing:
    """Packing into as few sequences as the search finds, the best-fit one at worst.

    The longest piece left opens a node; its branches are undominated fillings of the room beside it, least waste first,
    each used as often as the pieces left allow and, as the next branch, once. A branch whose waste so far leaves no way to
    beat the incumbent is pruned. The search ends at the lower bound, at the end of its tree or at max_nodes.
    """
    if not counts:
        return []
    total, bound = sum(n * c for n, c in counts.items()), fewest(counts, capacity)
    incumbent = best_fit(counts, capacity)
    used = sum(n for n, _ in incumbent)
    free = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        free[n] = c
    path: Packing = []
    waste, nodes = 0, 0

    def branches(longest: int) -> Iterator[tuple[int, int, Filling]]:
        """(times, waste of one, filling)"""
        free[longest] -= 1
        snapshot = free.copy()
        free[longest] += 1
        slack = (used - 1) * capacity - total - waste
        for each, filling in itertools.islice(fillings(snapshot, capacity - longest, slack), MAX_FILLINGS):
            whole = (longest, *filling)
            times = min(int(free[n]) // whole.count(n) for n in set(whole))
            yield times, each, whole
            if times > 1:
                yield 1, each, whole

    def place(times: int, each: int, filling: Filling) -> None:
        nonlocal waste
        for n in filling:
            free[n] -= times
        waste += times * each

    def longest_left() -> int:
        left = np.flatnonzero(free)
        return int(left[-1]) if len(left) else 0

    stack = [branches(longest_left())]
    while stack and used > bound and nodes < max_nodes:
        branch = next(stack[-1], None)
        if branch is None:
            stack.pop()
            if path:
                times, filling = path.pop()
                place(-times, capacity - sum(filling), filling)
            continue
        times, each, filling = branch
        if total + waste + times * each > (used - 1) * capacity:
            continue
        nodes += 1
        place(times, each, filling)
        path.append((times, filling))
        longest = longest_left()
        if longest:
            stack.append(branches(longest))
            continue
        if sum(n for n, _ in path) < used:
            incumbent, used = list(path), sum(n for n, _ in path)
        path.pop()
        place(-times, each, filling)
    return incumbent


def _slots(packing: Packing) -> np.ndarray:
    """Sorted rows (length, first number, first sequence, offset): the pieces of a length with these numbers go there one after the other."""
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for times, filling in packing:
        offset = 0
        for n in filling:
            rows.append((n, given.get(n, 0), sequence, offset))
            given[n] = given.get(n, 0) + times
            offset += n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = CAPACITY, *, length_col: str = "length", max_nodes: int = MAX_NODES) -> DataFrame:
    """Add sequence_id long and offset long: a place for every piece in sequences of at most capacity, as few as the search finds.

    Pieces have 1 to capacity units; any columns are carried along (sequence_id, offset and names that start with __pack_ are
    taken); an empty table stays empty; equal rows get different places. Lengths and their counts, at most capacity rows,
    go through the driver; the pieces are shuffled once, in parts of a length, so that a common length is spread.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark)
    pieces = scratch.write(pieces.withColumn("__pack_key", F.monotonically_increasing_id()), "pieces")
    part = F.pmod(F.xxhash64("__pack_key"), F.lit(PARTS)).cast("int")
    sizes = pieces.groupBy(F.col(length_col).cast("int").alias("length"), part.alias("part")).agg(F.count("*").alias("n"))
    sizes = scratch.write(sizes, "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    slots = spark.sparkContext.broadcast(_slots(complete_bins(counts, capacity, max_nodes=max_nodes)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("length").alias("__pack_length"), F.col("part").alias("__pack_part"), F.coalesce(before, F.lit(0)).alias("__pack_before"))
    rows = pieces.select("*", F.col(length_col).cast("int").alias("__pack_length"), part.alias("__pack_part"))
    rows = rows.withColumn("__pack_rank", F.row_number().over(Window.partitionBy("__pack_length", "__pack_part").orderBy("__pack_key")) - 1)
    rows = rows.join(offsets, ["__pack_length", "__pack_part"]).withColumn("__pack_rank", F.col("__pack_rank") + F.col("__pack_before")).drop("__pack_part", "__pack_before", "__pack_key")
    carried = [f for f in rows.schema.fields if not f.name.startswith("__pack_")]

    def run(batches):
        table = slots.value
        starts = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("__pack_length", "__pack_rank"))
            at = np.searchsorted(starts, length.astype(np.int64) << 48 | rank, side="right") - 1
            sequence = table[at, 2] + rank - table[at, 1]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(table[at, 3])], [*(f.name for f in carried), "sequence_id", "offset"])

    places = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    return rows.mapInArrow(run, T.StructType([*carried, *places]))


def pack_documents(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of token_pieces with their ids and places."""
    return pack(token_pieces(docs, vocabulary, capacity=capacity, id_col=id_col, text_col=text_col), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, ids: the token sequences themselves, one row each; packed: sequence_id, offset, ids (hex text is joined, as Spark has no sum of binaries)."""
    inside = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(inside.alias("pieces")).select("sequence_id", F.size("pieces").alias("n_pieces"), F.unhex(F.array_join(F.col("pieces.ids"), "")).alias("ids"))


shared.by_value(sys.modules[__name__])
