"""URL rules and block lists held in Bloom filter cascades.

The corpus's own candidate keys (host suffixes with path prefixes) are the whole universe of questions. Level 1
encodes the listed keys of that universe; level 2 the other keys that level 1 lets through; level 3 the listed
keys that level 2 lets through, and so on until nothing is left. A key then is listed exactly if the first level
that it misses is an even one. The filters are small literals in the plan, so pages are judged in place. A list of
which more keys than a filter of that size holds occur in the corpus is looked up by a join on hosts instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: The rules that decide before any list: (verdict, host, path); a rule is written host + path.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Hosts of spam, blocked with their subdomains where no rule fits.
BLOCKED_HOSTS = ["cheap-pills.example.com", "spam-farm.example.org"]

HASHES, BITS_PER_KEY = 5, 10
#: Keys that one level may hold: 10 bits each come to 1.3 MB in the plan.
MAX_KEYS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """All keys that could be listed for a URL: host suffixes at label borders with path prefixes of listed lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(path_lengths))]))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    a, b = F.xxhash64(key, F.lit(level)), F.xxhash64(F.lit(level), key)
    return [F.pmod(a.bitwiseXOR(F.call_function("shiftright", b, F.lit(i))), F.lit(bits)).cast("int") for i in range(HASHES)]


class Cascade:
    """Levels of (bits, words of 64 bits); no level: nothing is listed."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, list[int]]] = []

    def _in_level(self, key: Column, level: int) -> Column:
        bits, filled = self.levels[level]
        held = F.split(F.lit(",".join(map(str, filled))), ",").cast("array<bigint>")  # folded to a constant

        def is_set(at: Column) -> Column:
            word = F.get(held, F.call_function("shiftright", at, F.lit(6)))
            return F.call_function("shiftright", word, at.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1

        return F.forall(F.array(*_positions(key, level, bits)), is_set)  # the filter stands in the plan once

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe that it was built on."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(~self._in_level(key, level), F.lit(level % 2 == 1)).otherwise(out)
        return out

    def add_level(self, keys: DataFrame, n: int) -> None:
        bits = max(1024, 1 << (n * BITS_PER_KEY - 1).bit_length())
        at = F.explode(F.array(*_positions(F.col("key"), len(self.levels), bits))).alias("at")
        word = F.call_function("shiftright", F.col("at"), F.lit(6))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)))
        filled = dict(keys.select(at).groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect())
        self.levels.append((bits, [filled.get(i, 0) for i in range(bits // 64)]))


def build_cascade(universe: DataFrame, listed: DataFrame, max_keys: int | None = None) -> Cascade | None:
    """Cascade over universe (key, distinct) for the keys of listed (key, distinct). Joins happen here only.

    None if a level would hold more than max_keys keys; then a join has to decide.
    """
    marked = universe.join(listed.withColumn("__listed", F.lit(True)), "key", "left").select("key", F.coalesce("__listed", F.lit(False)).alias("listed"))
    marked = materialize(marked, "universe")
    cascade = Cascade()
    ours, others = marked.where("listed"), marked.where("not listed")
    n = ours.count()
    while n:
        if n > (max_keys or MAX_KEYS):
            return None
        cascade.add_level(ours, n)
        passed = cascade._in_level(F.col("key"), len(cascade.levels) - 1)
        ours, others = others.where(passed), ours
        n = ours.count()
    return cascade


def judge_urls(pages: DataFrame, *, url_col: str = "url", rules=RULES, blocked: DataFrame | None = None, blocked_hosts=BLOCKED_HOSTS, max_keys: int | None = None) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    rules: (verdict, host, path); the longest that fits wins. blocked: more listed hosts (column key) beside
    blocked_hosts; a URL under a listed host is blocked where no rule fits, any other allowed. A null URL or one
    without :// has an empty host and path, fits no rule and is allowed. Rows are judged one by one: repeated rows
    come out alike, other columns stay unless they bear one of the four names, which are replaced.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    rows = pages.withColumns({"host": host, "path": path})
    rule_keys = F.when(F.lit(True), candidates(F.col("host"), F.col("path"), [len(p) for _, _, p in rules]))
    host_keys = F.when(F.lit(True), candidates(F.col("host"), F.col("path"), [0]))
    places = rows.select(rule_keys.alias("r"), host_keys.alias("h"))
    of_rules = places.select(F.explode("r").alias("key")).distinct()
    of_hosts = places.select(F.explode("h").alias("key")).distinct()
    listed = spark.createDataFrame([(v, h + p) for v, h, p in rules] or [("", "")], "verdict string, key string").distinct()
    hosts = spark.createDataFrame([(h,) for h in blocked_hosts], "key string")
    hosts = hosts.unionByName(blocked.select("key")).distinct() if blocked is not None else hosts.distinct()
    any_rule = build_cascade(of_rules, listed.select("key").distinct())
    block_rule = build_cascade(of_rules, listed.where("verdict = 'block'").select("key"))
    block_host = build_cascade(of_hosts, hosts, max_keys)
    fitting = F.filter(rule_keys, any_rule.contains)
    longest = F.aggregate(fitting, F.lit(None).cast("string"), lambda a, x: F.when(a.isNull() | (F.length(x) > F.length(a)), x).otherwise(a))
    rows = rows.withColumn("rule", longest)
    if block_host is None:  # hosts are few beside pages, and their join is split where one is hot
        keys = rows.select("host").distinct().withColumn("key", F.explode(candidates(F.col("host"), F.lit(""), [0])))
        found = materialize(keys.join(hosts, "key", "left_semi").select(F.col("host").alias("__host")).distinct(), "blocked-hosts")
        rows = rows.join(found, rows["host"] == found["__host"], "left")
        by_list = F.col("__host").isNotNull()
    else:
        by_list = F.exists(host_keys, block_host.contains)
    rows = rows.withColumn("verdict", F.when(F.when(F.col("rule").isNotNull(), block_rule.contains(F.col("rule"))).otherwise(by_list), "block").otherwise("allow"))
    return rows.drop("__host")
