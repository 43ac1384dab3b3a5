"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import divergence, packing, prefixtrie, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audited(rows, term_ranks):
    """rows: (lang, source, text)"""
    words, seen, groups = defaultdict(Counter), defaultdict(Counter), {}
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        got = Counter(TERM.findall(lowered(text)))
        groups.setdefault((lang, source), Counter()).update(got)
        words[lang].update(got)
        seen[lang].update(got.keys())
    out = []
    for (lang, source), counts in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= 3]

        def price(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (total + len(kept)) for t in kept}

        mine, whole = price(counts), price(words[lang])
        pairs = []
        for (other_lang, other), theirs in groups.items():
            if other_lang == lang and other != source:
                q = price(theirs)
                pairs.append((other, sum((mine[t] - q[t]) ** 2 // q[t] for t in kept)))
        terms = [(t, (mine[t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, term_ranks)):
            order = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(order)]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    r = random.Random(5)
    vocabulary = ["alpha", "Beta", "BETA", "gämma", "ÄPFEL", "漢字", "x1y", "don't", "Ωmega", "😀z", "and"]
    rows = [(r.choice(["en", "de", None, ""]), r.choice(["a", "b", "c", None]), " ".join(r.choices(vocabulary, k=r.randrange(9)))) for _ in range(90)]
    rows += [("en", "d", None), ("en", "e", "  \x00\t@[`{ 12"), ("xx", "a", "one two"), ("xx", "b", ""), ("xx", "b", ""), ("lone", "only", "q q q"), ("en", "a", "alpha\x1fbeta\u0085ga " * 60_000)]
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").select("*", F.lit(1).alias("n"), F.lit("t").alias("term"), F.lit(2).alias("gid")).repartition(3)
    for ranks in (2, 200):
        assert sorted(map(tuple, divergence.audit(docs, term_ranks=ranks).collect())) == audited(rows, ranks)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_counts_do_not_depend_on_steps_and_hand_overs(spark, monkeypatch):
    text = "ab  Cd é " * 50
    whole = divergence.document_counts(text.encode())
    monkeypatch.setattr(divergence, "STEP_BYTES", 7)
    assert divergence.document_counts(text.encode()) == whole == {b"ab": 50, b"cd": 50, "é".encode(): 50}


def test_shared_terms_in_small_blocks(monkeypatch):
    import pyarrow as pa

    cells = [[{"gid": g, "p": 10 + 7 * g + t, "rest": 3 + g} for g in range(t + 1)] for t in range(1, 6)]
    batch = pa.RecordBatch.from_arrays([pa.array(cells)], ["cells"])

    def total():
        sums = Counter()
        for b in divergence._shared_terms([batch]):
            for x in b.to_pylist():
                sums[x["g"], x["h"]] += x["value"]
        return sums

    want = Counter()
    d = lambda p, q: (p - q) ** 2 // q
    for term in cells:
        for a in term:
            for b in term:
                if a["gid"] != b["gid"]:
                    want[a["gid"], b["gid"]] += d(a["p"], b["p"]) - d(a["p"], b["rest"]) - d(a["rest"], b["p"]) + d(a["rest"], b["rest"])
    assert total() == want
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    assert total() == want


def test_probability_is_exact_beyond_64_bits(spark):
    n, total, kept = 7 * 10**17, 9 * 10**17, 12345
    got = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long").select(divergence._probability(F.col("n"), F.col("total"), F.col("kept"))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + kept)


def optimum(items, capacity):
    """Fewest sequences, over all subsets."""
    best = {0: (1, 0)}
    for mask in range(1 << len(items)):
        used, room = best[mask]
        for i, n in enumerate(items):
            if not mask >> i & 1:
                to = (used, room + n) if room + n <= capacity else (used + 1, n)
                best[mask | 1 << i] = min(best.get(mask | 1 << i, to), to)
    return best[(1 << len(items)) - 1][0]


def test_search_finds_the_fewest_sequences():
    r = random.Random(1)
    for _ in range(250):
        capacity = r.choice([10, 20, 37, 100])
        items = [min(capacity, r.randint(max(1, capacity // r.choice([3, 5, 10])), capacity)) for _ in range(r.randint(1, 9))]
        got, placed = packing.complete_bins(Counter(items), capacity), Counter()
        for times, filling in got:
            assert sum(filling) <= capacity
            for n in filling:
                placed[n] += times
        assert placed == Counter(items)
        assert packing.fewest(Counter(items), capacity) <= sum(n for n, _ in got) == optimum(items, capacity)
    assert packing.complete_bins({}, 10) == []
    # Best fit takes 3 here: 6 3 | 5 4 | 2; two sequences hold 6 4 and 5 3 2.
    assert sum(n for n, _ in packing.complete_bins(Counter([6, 5, 4, 3, 2]), 10)) == 2
    sizes = Counter(np.clip(np.random.default_rng(2).lognormal(6.3, 1, 20_000).astype(int), 1, 2048).tolist())
    assert sum(n for n, _ in packing.complete_bins(sizes, 2048)) == packing.fewest(sizes, 2048) < sum(n for n, _ in packing.best_fit(sizes, 2048))


def test_packing_matches_the_tokenizers_library(spark):
    odd = ["", None, "don't  stop.", "Ça va? NAÏVE <|endoftext|>x.", "a" * 3000, "İstanbul ΣΑΣ. é̂ é. 漢字。 ½1²", "\x1c.\u0085x\xa0.. a.b. .,!", "w " * 5000, "12 345.6 A1. B,", "x.\ny;\tz:\r\n\fq\vr"]
    rows = [(i, t) for i, t in enumerate([*odd, *odd[:3], *[f"Word{i} some, Text." * (i % 7) for i in range(80)]])] + [(3, odd[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("offset", F.lit(0)).repartition(3)
    packed = packing.pack_documents(docs, queries.WORD_VOCABULARY, capacity=64)
    got = packed.collect()
    own = Tokenizer.from_file(queries.WORD_VOCABULARY)
    want = Counter()
    for i, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, len(ids[k : k + 64]), struct.pack(f"<{len(ids[k : k + 64])}I", *ids[k : k + 64])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for pieces in held.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    sizes = Counter(r.length for r in got)
    assert packing.fewest(sizes, 64) <= len(held) <= sum(n for n, _ in packing.best_fit(sizes, 64))
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed.select("sequence_id", "offset", "ids")).collect()}
    assert Counter(map(len, whole.values())) == Counter(4 * sum(x[1] for x in v) for v in held.values())
    assert packing.pack_documents(docs.limit(0), queries.WORD_VOCABULARY).count() == 0


def test_a_forgotten_chunk_is_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 12)
    with open(queries.WORD_VOCABULARY, encoding="utf-8") as f:
        chunks = packing.Chunks(f.read())
    own = Tokenizer.from_file(queries.WORD_VOCABULARY)
    for text in ["a b c d.", "e f g. h i j", "a. B! c d e, f", "z" * 100 + ". a.", "a b"]:
        ids = own.encode(text, add_special_tokens=False).ids
        assert chunks.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_lengths_beyond_the_capacity_are_refused(spark):
    with pytest.raises(ValueError, match="1 to 10"):
        packing.pack(spark.createDataFrame([(11,)], "length long"), 10)


def grown(rows, family=100, heads=6):
    """Nodes of the rebuilt conversations' trie."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in by.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        path = tuple(own.get(c - int(math.fmod(c, family)), [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], digest(p)) for p, m in members.items())


def test_trie_equals_brute_force_over_any_number_of_shards(spark):
    r = random.Random(3)
    ids = [*range(-110, 140), None, 10**12, 10**12 + 7]
    rows = [(c, t if r.random() > 0.1 else None, r.choice("ua") if r.random() > 0.1 else None, r.choice(["x", "yé", "z"]) if r.random() > 0.1 else None) for c in ids for t in range(r.choice([0, 1, 2, 3, 5, 8]))]
    rows += [(7, 3, "u", "tie"), (7, 3, "u", "tie"), (7, 3, "a", "tie"), *[(500, t, "u", "long") for t in range(300)], *[(1000 + c, t, "u", "same") for c in range(60) for t in range(9)]]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("own", F.lit(1)).withColumn("path", F.lit("p")).withColumn("size", F.lit(1)).repartition(3)
    want = grown(rows)
    for shards in (None, 1, 7):
        assert Counter(map(tuple, prefixtrie.trie(talks, shards=shards).collect())) == want
    assert prefixtrie.trie(talks.limit(0)).count() == 0


def test_findclose_over_random_trees(monkeypatch):
    r = random.Random(9)
    for n, lean in [(1, 0.5), (2, 0.5), (40, 0.5), (500, 0.5), (5000, 0.3), (5000, 0.9), (3000, 1.0), (3000, 0.0)]:
        bits, open_, stack, want = [], 0, [], {}
        while len(want) < n:
            more = open_ < n and (not stack or r.random() < lean)
            if more:
                stack.append(len(bits))
                open_ += 1
            else:
                want[stack.pop()] = len(bits)
            bits.append(int(more))
        opens = np.array(sorted(want))
        assert prefixtrie.Parentheses(np.array(bits, np.uint8)).findclose(opens).tolist() == [want[i] for i in opens.tolist()]
