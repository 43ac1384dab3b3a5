"""Prefix trie of conversations in balanced parentheses.

Distinct paths of turns are dealt into shards by range, so that a shard holds neighbours of the trie's preorder. A shard
writes its part of the trie as parentheses; findclose over blocks of least excess gives every node's subtree as an
interval, leaves are the adjacent pairs in it, and cumulative arrays give members and savings. Only nodes on a path that
two neighbouring shards share are in several shards; these spines are merged by Spark afterwards.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared
from .shared import Scratch

#: A turn is known by the 128 bits of its digest, so a path is 16 bytes a turn.
TURN_BYTES = 16

#: Bytes of paths in a shard, about; parentheses in a block.
SHARD_BYTES, BLOCK = 16_000_000, 64

NO_ENDS = hashlib.sha256(b"").hexdigest()

NODES = "key binary, parent binary, shared boolean, parent_shared boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, n_text bigint, node_text bigint, ends string"


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with blocks of least excess under a binary tree of minima."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        blocks = max(1, -(-self.n // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        self.excess = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        self.excess[: self.n] = excess
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.least[self.leaves :] = self.excess.reshape(-1, BLOCK).min(axis=1)
        level = self.leaves
        while level > 1:
            self.least[level // 2 : level] = self.least[level : 2 * level].reshape(-1, 2).min(axis=1)
            level //= 2
        opens, follows = bits == 1, np.append(bits[1:], 1)
        #: Opens, and adjacent pairs "()", before each place.
        self.opens_before = np.concatenate([[0], np.cumsum(opens)])
        self.leaves_before = np.concatenate([[0], np.cumsum(opens & (follows == 0))])

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each of these opening ones: the first behind it of less excess."""
        want = self.excess[at] - 1
        found = np.full(len(at), -1, np.int64)
        self._scan(found, np.arange(len(at)), at + 1, (at // BLOCK + 1) * BLOCK, want)
        todo = np.flatnonzero(found < 0)
        node = at[todo] // BLOCK + self.leaves
        climbing = np.arange(len(todo))
        while len(climbing):  # up, until the right neighbour's blocks go low enough
            here = node[climbing]
            right = np.where(here % 2 == 0, here + 1, 0)  # the root's minimum at 1 is never asked for: closes exist
            there = (right > 0) & (self.least[right] <= want[todo[climbing]])
            node[climbing] = np.where(there, right, here // 2)
            climbing = climbing[~there]
        going = np.flatnonzero(node < self.leaves)
        while len(going):  # down, to the left where that goes low enough
            left = 2 * node[going]
            node[going] = np.where(self.least[left] <= want[todo[going]], left, left + 1)
            going = going[node[going] < self.leaves]
        start = (node - self.leaves) * BLOCK
        self._scan(found, todo, start, start + BLOCK, want[todo])
        return found

    def _scan(self, found, which, start, end, want) -> None:
        """Set found[which] to the first place from start to end whose excess is want."""
        place, open_ = start.copy(), np.flatnonzero(start < end)
        while len(open_):
            hit = self.excess[place[open_]] == want[open_]
            found[which[open_[hit]]] = place[open_[hit]]
            open_ = open_[~hit]
            place[open_] += 1
            open_ = open_[place[open_] < end[open_]]


def common_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths share from the start; -1 if one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // TURN_BYTES * TURN_BYTES
    x, y = np.frombuffer(a[:n], np.uint64).reshape(-1, 2), np.frombuffer(b[:n], np.uint64).reshape(-1, 2)
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n // TURN_BYTES


def shard_nodes(paths: list[bytes], sizes: list[np.ndarray], convs: np.ndarray, first: np.ndarray, ends: list[str], before: bytes | None, behind: bytes | None) -> pa.Table:
    """All nodes of a shard. paths: distinct, sorted; sizes: text lengths of a path's turns; convs, first, ends: members that
    end with a path, their smallest id and the digest of all; before, behind: the paths next to the shard's."""
    depth, last, own, least, digest, path_of = [], [], [], [], [], []
    runs: list[np.ndarray] = []
    open_depth, at_path = -1, None
    for i, path in enumerate(paths):
        turns, shared_turns = len(path) // TURN_BYTES, common_turns(at_path, path)
        if open_depth >= 0:
            runs.append(np.zeros(open_depth - shared_turns, np.uint8))
        new = np.arange(max(shared_turns + 1, 0), turns + 1)
        runs.append(np.ones(len(new), np.uint8))
        depth.append(new)
        text = np.concatenate([[0], sizes[i]]).astype(np.int64)
        last.append(text[new])
        of_end = np.zeros(len(new), np.int64)
        of_end[-1] = convs[i]
        own.append(of_end)
        smallest = np.full(len(new), np.iinfo(np.int64).max)
        smallest[-1] = first[i]
        least.append(smallest)
        digest += [None] * (len(new) - 1) + [ends[i]]
        path_of.append(np.full(len(new), i))
        open_depth, at_path = turns, path
    runs.append(np.zeros(open_depth + 1, np.uint8))
    bits = np.concatenate(runs)
    tree = Parentheses(bits)
    depth, last, own, least, path_of = (np.concatenate(x) for x in (depth, last, own, least, path_of))
    opens = np.flatnonzero(bits == 1)
    close = tree.findclose(opens)
    n, me = len(opens), np.arange(len(opens))
    until = tree.opens_before[close]  # preorder numbers of a subtree: from the node's own to here

    def summed(x):
        total = np.concatenate([[0], np.cumsum(x)])
        return total[until] - total[me]

    members = summed(own)
    # A node that the shard before has too is counted there; so is what it alone adds to sums over distinct nodes.
    met_before, met_behind = common_turns(before, paths[0]), common_turns(paths[-1], behind)
    from_before = (path_of == 0) & (depth <= met_before)
    on_last = until == n  # the last path's nodes are those whose subtrees end with the shard
    to_behind = on_last & (depth <= met_behind)
    node_shared = from_before | to_behind
    text = np.where(from_before, members * last, (members - 1) * last)
    leaves = tree.leaves_before[close] - tree.leaves_before[opens]
    goes_on = int(met_behind == len(paths[-1]) // TURN_BYTES)  # the path behind the shard continues its last one, which is no leaf then
    leaves = leaves - on_last * goes_on
    # Nearest open node before each: the last one of less depth.
    parent = np.full(n, -1, np.int64)
    trail: list[int] = []
    for i, d in enumerate(depth.tolist()):
        del trail[d:]
        parent[i] = trail[-1] if trail else -1
        trail.append(i)
    inner = np.flatnonzero((parent >= 0) & ~from_before)
    children = np.bincount(parent[inner], minlength=n)
    # Smallest member: over preorder intervals, which are nested, from the last node to the first.
    smallest = least.copy()
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if smallest[i] < smallest[p]:
            smallest[p] = smallest[i]
    keys: list[bytes | None] = [None] * n
    spine: dict[int, list[int]] = {}
    for i in np.flatnonzero(node_shared).tolist():
        spine.setdefault(int(path_of[i]), []).append(i)
    for which, of in spine.items():
        state, done = hashlib.sha256(), 0
        for i in of:
            state.update(paths[which][done : int(depth[i]) * TURN_BYTES])
            done = int(depth[i]) * TURN_BYTES
            keys[i] = state.digest()
    parent_shared = np.where(parent >= 0, node_shared[parent], False)
    return pa.table(
        {
            "key": pa.array(keys, pa.binary()),
            "parent": pa.array([keys[p] if s else None for p, s in zip(parent.tolist(), parent_shared.tolist(), strict=True)], pa.binary()),
            "shared": node_shared,
            "parent_shared": parent_shared,
            "conv_id": smallest,
            "depth": depth,
            "parent_conv_id": pa.array(np.where(parent >= 0, smallest[parent], 0), pa.int64(), mask=parent < 0),
            "n_convs": members,
            "n_children": children,
            "n_leaves": leaves,
            "n_text": summed(text),
            "node_text": text,
            "ends": pa.array(digest, pa.string()),
        }
    )


def _solved(key, paths: pa.Table, bounds: pa.Table) -> pa.Table:
    order = paths.sort_by("path") if paths.num_rows > 1 else paths
    size = [np.array(x, np.int64) for x in order.column("sizes").to_pylist()]
    columns = (order.column(c).to_numpy() for c in ("n_ends", "first_end"))
    return shard_nodes(order.column("path").to_pylist(), size, *columns, order.column("ends").to_pylist(), *(bounds.column(c)[0].as_py() for c in ("before", "behind")))


def _digested(batches):
    """(path_key, n_ends, first_end, ends) of rows sorted by path_key and conv_id; a hot path passes through without being held."""
    key, n, first, state = None, 0, 0, None
    for batch in batches:
        done = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    done.append((key, n, first, state.hexdigest()))
                key, n, first, state = k, 1, c, hashlib.sha256(str(c).encode())
            else:
                n += 1
                state.update(b",%d" % c)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path_key", "n_ends", "first_end", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (key, n, first, state.hexdigest())], ["path_key", "n_ends", "first_end", "ends"])


def rebuilt(conversations: DataFrame, *, family: int = 100, heads: int = 6, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turns: array of (digest, size) with the first turns of its family's first conversation in place of its own.

    A conversation takes crc32(conv_id) % heads turns from conversation conv_id - conv_id % family. Turns are ordered by
    turn, nulls first, then by digest; rows that are equal are turns of their own. Null role and text count as empty; rows
    without a conv_id belong to no conversation. Texts stay behind: a turn is 128 bits and a length from here on.
    """
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in (role_col, text_col))
    known = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.select(conversations[conv_col].cast("long").alias("conv_id"), conversations[turn_col].alias("turn"), known.alias("digest"), F.length(text).alias("size"))
    own = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("own"))
    own = own.select("conv_id", F.transform("own", lambda x: F.struct(x["digest"], x["size"])).alias("own"))
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, heads - 1).alias("first"))
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(heads)).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base", "left").withColumn("h", h)
    taken = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.filter("own", lambda _: F.lit(False)))
    rest = F.filter("own", lambda _, i: i >= F.col("h"))
    return both.select("conv_id", F.concat(taken, rest).alias("turns"))


def distinct_paths(turned: DataFrame, scratch: Scratch) -> DataFrame:
    """path binary, sizes, n_ends, first_end, ends: each distinct sequence of turns once, with the conversations that are it."""
    path = F.array_join(F.col("turns.digest"), "")
    rows = scratch.write(turned.select("conv_id", F.sha2(path, 256).alias("path_key"), path.alias("path"), F.col("turns.size").alias("sizes")), "rebuilt")
    ends = rows.select("path_key", "conv_id").repartition("path_key").sortWithinPartitions("path_key", "conv_id")
    ends = ends.mapInArrow(_digested, "path_key string, n_ends bigint, first_end bigint, ends string")
    once = rows.groupBy("path_key").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    return once.join(ends, "path_key").select(F.unhex("path").alias("path"), "sizes", "n_ends", "first_end", "ends")


def trie(conversations: DataFrame, *, family: int = 100, heads: int = 6, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Nodes of the prefix trie of rebuilt conversations.

    Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens
    (over its subtree, members but one times code points of the node's last text), ends_sha256 (of the ids that end there).
    An empty table has no nodes; see rebuilt() for nulls, ties and repeated rows; other columns are dropped. Bounds: a shard
    holds about SHARD_BYTES of paths, and a path is 16 bytes and a number for each turn of one conversation.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark)
    turned = rebuilt(conversations, family=family, heads=heads, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    paths = scratch.write(distinct_paths(turned, scratch), "paths")
    if shards is None:
        total = paths.agg(F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()[0]
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    dealt = scratch.write(paths.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()), "dealt")
    edges = dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))  # two paths a shard
    in_order = Window.orderBy("shard")
    bounds = edges.select("shard", F.lag("high").over(in_order).alias("before"), F.lead("low").over(in_order).alias("behind"))
    nodes = scratch.write(dealt.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(_solved, NODES), "nodes")
    return _merged(nodes)


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes of all shards, spines merged; what hangs on a spine learns its parent's smallest member from there."""
    spines = nodes.where("shared").groupBy("key").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "n_text")], F.max("ends").alias("ends"),
    )
    names = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "n_text", "ends"]
    inside = nodes.where("NOT shared AND NOT parent_shared").select(*names, "parent_conv_id")
    hanging = nodes.where("NOT shared AND parent_shared").select(*names, "parent").unionByName(spines.select(*names, "parent"))
    parents = spines.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    every = inside.unionByName(hanging.join(parents, "parent", "left").select(*names, "parent_conv_id"))
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("n_text").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


shared.by_value(sys.modules[__name__])
