import hashlib
import random
import time
import struct
import zlib

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import bpe, decontaminate, html, linededup, neardup, pii, quality, queries, sharding, simhash, substring, urlfilter

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"w{i}x" for i in range(400)]


def prose(seed, n, *, line=12):
    r = random.Random(seed)
    w = [r.choice(VOCABULARY) for _ in range(n)]
    return "\n".join(" ".join(w[i : i + line]) + "." for i in range(0, n, line))


def edited(text, seed, n):
    r = random.Random(seed)
    w = text.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(999)}"
    return " ".join(w)


def corpus():
    a, b, c = prose(1, 150), prose(2, 300), prose(3, 90)
    texts = [a, a, edited(a, 4, 1), edited(a, 5, 3), b, b + "\n" + c, c, prose(6, 60) + " " + b[:900], "", None, " \n\t ", "one", "one two", "ONE two", "same same same same", prose(7, 4000), a.upper(), c + "\x1f   é 😀", "x" * 30000]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in corpus()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_matches_the_tokenizers_library(spark, docs, none):
    extra = ["<|endoftext|> a <|endoftext|>", "'s 'll don't  \n\n  x", "漢字かな 😀😀 ẞ", "a" * 5000, " " * 700, "\u0085  1²¾"]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    rows = rows.unionByName(rows.limit(1))
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = bpe.encode_decode(rows, queries.VOCABULARY).join(rows.distinct(), "doc_id").collect()
    assert len(got) == rows.count()
    for r in got:
        want = own.encode(r.text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) == want and r.n_tokens == len(want)
        assert r.decoded == own.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(none, queries.VOCABULARY).count() == 0


def test_every_vocabulary_entry_encodes_to_itself():
    with open(queries.VOCABULARY, encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    assert all(codec.encode_piece(raw) == [i] for raw, i in codec.whole.items())


def test_sharding_balances_bytes(spark, docs, none):
    rows = docs.select("doc_id", "text").unionByName(spark.range(100, 3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 90).cast("int")).alias("text")))
    rows = rows.unionByName(rows.where("doc_id in (1, 200)")).withColumn("size", F.lit("clash"))
    got = sharding.assign_shards(rows, 7).collect()
    assert len(got) == rows.count()
    load, places = {}, {}
    for r in got:
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    fullest = max(r["size"] for r in got)
    assert max(load.values()) - min(load.values()) <= fullest
    assert {r.doc_id: r["size"] for r in got}[9] == 16 and {r.doc_id: r.text_crc32 for r in got}[9] == 0
    texts = {r.doc_id: r.text for r in rows.select("doc_id", "text").collect()}
    assert all(r["size"] == len((texts[r.doc_id] or "").encode()) + 16 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in got)
    assert sharding.assign_shards(none, 7).count() == 0


def test_slot_map_is_stored_by_version(spark, docs, tmp_path):
    path = str(tmp_path / "map")
    got = sharding.assign_shards(docs, 5, slots=64, map_path=path).collect()
    first, second = (sharding.read_version(spark, path, v) for v in (0, 1))
    assert first == sharding.initial_map(5, 64) and all(second[r.virtual_slot] == r.shard for r in got)
    sharding.store_version(spark, path, 2, sharding.edit_map(second, dict.fromkeys(range(64), 10), 6))
    third = sharding.read_version(spark, path, 2)
    assert {b for a, b in zip(second, third, strict=True) if a != b} and sharding.read_version(spark, path, 1) == second


def test_map_edits_move_few_slots():
    first = sharding.initial_map(4, 64)
    weights = {s: 10 for s in range(64)} | {0: 50}
    second = sharding.edit_map(first, weights, 4)
    moved = [s for s in range(64) if first[s] != second[s]]
    load = [sum(w for s, w in weights.items() if second[s] == k) for k in range(4)]
    assert 0 < len(moved) < 12 and max(load) - min(load) <= 10
    grown = sharding.edit_map(second, weights, 5)
    load = [sum(w for s, w in weights.items() if grown[s] == k) for k in range(5)]
    assert max(load) - min(load) <= 10


def test_simhash_groups(docs, none):
    fps = [(i, brute.fingerprint(t)) for i, t in corpus()]
    want = {i: (fp, c) for (i, fp), c in zip(fps, brute.components(fps), strict=True)}
    got = simhash.near_duplicates(docs.unionByName(docs.where("doc_id = 3"))).collect()
    assert len(got) == len(want) + 1
    for r in got:
        assert (r.fp % (1 << 64), r.component) == want[r.doc_id]
    assert simhash.near_duplicates(none).count() == 0


def test_tree_finds_all_links_however_it_splits(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(500)]
    fps = sorted({b ^ sum(1 << r.randrange(64) for _ in range(k)) & (1 << 64) - 1 for b in base for k in (0, 1, 2)} | {base[0] ^ 1 << i ^ 1 << j for i in range(40) for j in range(i)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.link_roots(spark.createDataFrame([(x,) for x in signed], "fp long"), shard=200, sample=512)
    got = {row.node: row.root for row in simhash.connected_components(links, "fp", "root").collect()}
    want = brute.components(list(zip(signed, fps, strict=True)))
    assert [got.get(x, x) for x in signed] == want
    # Shards that hold too many are dealt again.
    again = simhash.link_roots(spark.createDataFrame([(x,) for x in signed], "fp long"), shard=20, sample=128)
    got = {row.node: row.root for row in simhash.connected_components(again, "fp", "root").collect()}
    assert [got.get(x, x) for x in signed] == want


def test_substring_removal(docs, none):
    want = dict(zip([i for i, _ in corpus()], brute.removed_words(corpus()), strict=True))
    got = substring.remove_repeats(docs.withColumn("key", F.lit(1))).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want and any(w[1] for w in want.values())
    assert substring.remove_repeats(none).count() == 0


def test_substring_ids_null_and_repeated(spark):
    t = prose(1, 80)
    rows = spark.createDataFrame([(None, t), (1, t), (1, t), (2, t), (2, "short")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring.remove_repeats(rows).collect()) == [(0, 0), (1, 0), (1, 0), (2, 0), (2, 80)]


def test_line_dedup(docs, none, spark):
    texts = corpus() + [(50, "a b c d e\na b c d e f\nz\n\nz"), (51, "q a b c d e"), (52, "a b c d"), (53, "d c b a\nk l m n\nk l m o")]
    rows = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts if i >= 50], SCHEMA)).withColumns({"key": F.lit(1), "l_lines": F.lit(2)})
    want = {i: w for (i, _), w in zip(texts, brute.kept_lines(texts), strict=True)}
    got = {r.doc_id: (r.l_lines, r.l_removed, r.text) for r in linededup.remove_lines(rows).collect()}
    assert got == want
    assert linededup.remove_lines(none).count() == 0


def test_line_dedup_with_text_ids(spark):
    rows = spark.createDataFrame([("b", "a b c d e"), ("a", "e d c b a\nx y"), ("a", "e d c b a\nx y")], "doc_id string, text string")
    assert sorted((r.doc_id, r.l_removed) for r in linededup.remove_lines(rows).collect()) == [("a", 0), ("a", 0), ("b", 1)]


def test_line_dedup_parities_and_plain_tokens(spark):
    """Both parities are those of a plain count, and token ranks hold no nulls, so that Spark sorts them as numbers."""
    r = random.Random(3)
    sets = [[r.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (0, 1, 2, 7, 60)]
    rows = spark.createDataFrame(list(enumerate(sets)), "i long, t array<bigint>")
    got = {x.i: (x.p % (1 << 64), x.h % (1 << 64)) for x in rows.select("i", linededup._parity("t").alias("p"), linededup._parity("t", half=True).alias("h")).collect()}
    for i, of in enumerate(sets):
        want = [0, 0]
        for t in of:
            want[0] ^= 1 << (t & 63)
            want[1] ^= (t >> 6 & 1) << (t & 63)
        assert got[i] == tuple(want)
    levels = linededup._levels(spark.createDataFrame([("a b a",)], "text string"))
    ranks = spark.range(1).select(F.transform(F.array(F.lit("a"), F.lit("b")), lambda w: F.get(levels, linededup._class(F.xxhash64(w)))).alias("x")).first().x
    assert [x >> 56 for x in ranks] == [4, 0] and all(x % (1 << 56) == 0 for x in ranks)


def test_line_dedup_common_tokens_and_halves(spark):
    """Only common tokens lead to the first meeting, only large sets have parities of a half; families on either way are whole."""
    own = [" ".join(f"w{i}x{j}" for j in range(90)) for i in range(2)]
    family = ["often seldom never always " * 600] + [f"often seldom never always again v{i}" for i in range(4)]
    near = own[0].rsplit(" ", 3)[0]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*own, near, *family])], "doc_id long, text string")
    naming, scratch = linededup.Numbering(rows, "doc_id", "text"), linededup.Scratch(spark)
    lines = rows.select(F.col("doc_id").alias("doc"), F.lit(0).alias("line"), F.col("text").alias("value"))
    levels = linededup._small_levels(rows)
    assert len(spark.range(1).select(levels)._jdf.queryExecution().optimizedPlan().toString()) < 400_000  # the driver keeps such texts
    sets = {r.sid >> naming.bits: r for r in linededup._line_sets(lines, levels, naming, 0.8, scratch).collect()}
    assert all((sets[i].half != 0, sets[i].common) == (i < 3, i == 3) for i in sets)
    scratch.release()
    # 5 of 6 tokens of the variants agree with each other only in 5 of 7, with the first in 4 of 6: they stay; `near` goes.
    assert {r.doc_id for r in linededup.remove_lines(rows).collect() if r.l_removed} == {2}


def test_decontamination(spark, docs, none):
    item = prose(50, 40).replace("\n", " ")
    items = [(0, item), (1, "four words only here"), (2, None), (3, ""), (4, "r r r r r r r r r r"), (5, prose(51, 300))]
    planted = [
        (30, prose(60, 50) + " " + item + " " + prose(61, 50)), (31, prose(62, 40) + " " + edited(item, 1, 1).upper()), (32, " ".join(item.split()[:30])), (33, "so FOUR words only here it is"),
        (34, "r " * 12), (35, " ".join(item.split()[:38])), (36, edited(prose(51, 300), 2, 4)), (37, "r r r r r"),
    ]
    texts = corpus() + planted
    rows = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in planted] * 2, SCHEMA)).withColumn("item", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.find(rows, benchmark).collect()}
    want = {k: round(v, 9) for k, v in brute.leaks(texts, items).items()}
    assert got == want and {k[0] for k in want} >= {30, 31, 33, 34, 35}
    left = {r.doc_id for r in decontaminate.remove(rows, benchmark).collect()}
    assert left == {i for i, _ in texts} - {k[0] for k in want}
    assert decontaminate.find(none, benchmark).count() == 0
    assert decontaminate.find(rows, benchmark.limit(0)).count() == 0


def test_blocks_hold_every_pair_within_the_radius():
    r, masks = random.Random(1), decontaminate.block_masks(decontaminate.RADIUS + 1)
    assert sum(m % (1 << 64) for m in masks) == (1 << 64) - 1
    for _ in range(200):
        x = sum(1 << i for i in r.sample(range(64), decontaminate.RADIUS))
        assert any(x & m % (1 << 64) == 0 for m in masks)


def test_pii_base_spans(spark, docs, none):
    texts = ["a@b.c%x@d.e f@g", "1.2.3.4.5.6.7.8 999.1.1.1 0.0.0.00255", "4111 1111 1111 1111 4111-1111-1111-1111-1", "+1 (555) 555-1234.", "1" * 3000, "é 😀 12 34 4111111111111111 a@b.co", "a.b@c.d@e.f@g.h", "00000000000000 +123456789012345 +12"]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    by_id = dict(corpus()) | {100 + i: t for i, t in enumerate(texts)}
    got = {r.doc_id: r.base for r in pii.find(rows).collect()}
    assert got == {i: brute.pii(t) for i, t in by_id.items()}
    assert pii.find(none).count() == 0


def test_pii_contexts_find_unseen_identifiers(spark):
    seeds = [(i, f"{prose(i, 20)} please call +1 555 0100 {1000 + i} now") for i in range(8)]
    unseen = [(90, "well please call 555-0199-77 now"), (91, "we sold 555-0199-78 pieces"), (92, "please call me")]
    got = {r.doc_id: (r.base, r.spans) for r in pii.find(spark.createDataFrame(seeds + unseen, "doc_id long, text string")).collect()}
    assert got[90] == ("", "phone:17:28") and got[91] == ("", "") and got[92] == ("", "")
    assert all(got[i][0] == got[i][1] != "" for i in range(8))


def test_quality_counts(docs, none):
    texts = dict(corpus())
    got = {r.doc_id: r for r in quality.judge(docs.withColumn("q_note", F.lit(1))).collect()}
    for i, r in got.items():
        assert (r.q_words, r.q_word_chars, r.q_symbols, r.q_dup_lines, r.q_repeat_words, r.q_base_failed) == brute.quality(texts[i])
        assert r.q_note == 1
    assert quality.judge(none).where("q_kept").count() == 0


def test_quality_cleans_lines_then_rejects(spark):
    good, nav = prose(9, 120), "Home | News | Sport | Shop | About"
    rows = spark.createDataFrame([(1, good), (2, good + "\n" + nav), (3, "\n".join([nav.replace("N", f"N{i}") for i in range(40)]) + "\n" + good), (4, good.replace(" ", "### ").replace("w", "$w")), (5, None)], "doc_id long, text string")
    got = {r.doc_id: (r.q_kept, r.q_clean) for r in quality.judge(rows).collect()}
    assert got[1] == (True, good) and got[2] == (True, good) and not got[3][0] and not got[4][0] and got[5] == (False, None)


def test_html_wrappers(spark):
    page = "<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><div class='top-menu'><a>Home {0}</a></div><div id=content><h1>Title {0}</h1><p>One &amp; two<br>three {0}<p>four <b>five</b>{0}</div><div class='comments'><p>first! {0}</p></div><div class=legal>Same on all pages</div><form>q<input></form></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format("abc" * (i + 20))) for i in range(6)] + [(50, None, None), (51, "x", ""), (52, "http://o.example/", "<article><h2>A</h2>b<aside>no</aside></article><footer>no</footer>"), (53, "http://h.example/z", "plain &lt;text&gt;")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    for i in range(6):
        x = "abc" * (i + 20)
        assert got[i] == f"Title {x}\nOne & two three {x}\nfour five{x}"
    assert got[50] == got[51] == "" and got[52] == "A\nb" and got[53] == "plain <text>"


def test_url_rules_and_cascade(spark):
    urls = ["http://a.Example.com/en/7?x", "https://com/en/", "http://x.net/de", "http://x.net/de/1#a", "http://example.net/de/81", "ftp://b.org/es/x", "http://my.spam-farm.example.org/", "http://notspam-farm.example.org/", None, "no scheme", "http://", "http://a.com/en", "http://a.com/en/7"]
    want = [("example.com/en/7", "allow"), ("com/en/", "block"), (None, "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("com/en/", "block")]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit(1))
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(rows).collect()}
    assert [got[i] for i in range(len(urls))] == want
    joined = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(rows, blocked=spark.createDataFrame([("b.org",), ("net",)], "key string"), blocked_hosts=urlfilter.BLOCKED_HOSTS, max_keys=1).collect()}
    plain = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(rows, blocked=spark.createDataFrame([("b.org",), ("net",)], "key string")).collect()}
    assert joined == plain and plain != got
    assert urlfilter.judge_urls(rows.limit(0)).count() == 0
    universe = spark.range(20000).select(F.col("id").cast("string").alias("key"))
    cascade = urlfilter.build_cascade(universe, universe.where("key % 7 = 3"))
    assert len(cascade.levels) > 1
    assert universe.where(cascade.contains(F.col("key")) != (F.col("key").cast("int") % 7 == 3)).count() == 0


def test_url_rules_are_the_contract_s(spark, tmp_path):
    """Each rule's word, in the query and in its SQL."""
    words = {"a.com/en/1": "block", "example.com/en/7": "allow", "a.net/de/1": "allow", "example.net/de/8": "block", "a.example.net/de/7": "allow", "a.org/es/": "block"}
    rows = [(i, f"http://{u}") for i, u in enumerate(words)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in queries.op10_urls(spark, str(tmp_path)).collect()}
    sql = "WITH pages AS (SELECT * FROM read_parquet('%s/pages.parquet/*.parquet')) SELECT page_id, verdict FROM (%s)" % (tmp_path, queries.ORACLES["op10_urls"])
    assert got == dict(duckdb.connect().execute(sql).fetchall()) == dict(enumerate(words.values()))


def test_pipeline_against_brute_force(spark):
    """Every stage on what its predecessor kept."""
    item = prose(50, 40)
    texts = [(i, t) for i, t in corpus() if i != 18] + [(40, prose(70, 80) + "\n" + item), (41, prose(71, 80))]
    rows = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in texts], SCHEMA)
    folder = corpus_pipeline.materialize(spark.createDataFrame([(7, item)], "item_id long, text string"), "unused")
    benchmark = folder
    state = rows
    kept = {r.doc_id: r.q_clean for r in quality.judge(rows).where("q_kept").collect()}
    state = corpus_pipeline.materialize(corpus_pipeline.quality_rules(spark, state, ""), "t")
    assert {r.doc_id: r.text for r in state.collect()} == kept and state.columns == rows.columns
    assert {i for i, t in texts if not brute.quality(t)[-1]} >= set(kept)
    cut = {i: x[2] for (i, _), x in zip(sorted(kept.items()), brute.kept_lines(sorted(kept.items())), strict=True) if x[1] == 0 or x[1] < x[0]}
    state = corpus_pipeline.materialize(corpus_pipeline.line_dedup(spark, state, ""), "t")
    assert {r.doc_id: r.text for r in state.collect()} == cut and all(r.n_chars == len(r.text) for r in state.collect())
    ids = sorted(cut)
    groups = brute.components([(i, brute.fingerprint(cut[i])) for i in ids])
    first = {i for i, g in zip(ids, groups, strict=True) if i == g}
    state = corpus_pipeline.materialize(corpus_pipeline.near_dedup(spark, state, ""), "t")
    assert {r.doc_id for r in state.collect()} == first
    clean = first - {k[0] for k in brute.leaks([(i, cut[i]) for i in first], [(7, item)])}
    state = corpus_pipeline.materialize(decontaminate.remove(state, benchmark), "t")
    assert {r.doc_id for r in state.collect()} == clean and 40 not in clean and 41 in clean
    own = Tokenizer.from_file(queries.VOCABULARY)
    for r in corpus_pipeline.bpe_ids(spark, state, "").collect():
        ids = own.encode(cut[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(cut[r.doc_id].encode()).hexdigest()


def test_near_dedup_stage_removes_copies_of_similarity_080(spark):
    base = prose(80, 200)
    near = [edited(base, 81 + i, 3) for i in range(6)]
    texts = [(9, base), *enumerate(near), (20, prose(90, 200)), (20, prose(91, 200)), (21, edited(base, 99, 40)), (None, near[0]), (None, "own words of no one"), (30, "a b c"), (31, "A b C"), (32, ""), (33, None), (34, "d e f")]
    texts += [(40 + i, " ".join(w + str(j) for j, w in enumerate(prose(100, 60).split()[: 60 - 2 * i]))) for i in range(6)]  # a chain: the ends are unlike
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [*texts, texts[7]]], SCHEMA).repartition(3)
    grams = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := (t or "").lower().split()) else set() for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i, a in enumerate(grams):
        for j, b in enumerate(grams[:i]):
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                parent[find(i)] = find(j)
    low = {}
    for i, (k, t) in enumerate(texts):
        low[find(i)] = min(low.get(find(i), (True, 0, t)), (k is None, k or 0, t), key=lambda x: x[:2])
    want = sorted((0 if n else k, t or "") for n, k, t in low.values())
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_dedup(spark, rows, "").collect())
    assert got == want
    radius_2 = {c for c in brute.components([(i, brute.fingerprint(t)) for i, t in enumerate(t for _, t in texts)])}
    assert len(want) < len(radius_2)
    assert corpus_pipeline.near_dedup(spark, rows.limit(0), "").count() == 0


def test_near_dedup_stage_links_fingerprints_through_the_tree(spark, monkeypatch):
    """Long copies with one word changed meet through SimHash; texts of one fingerprint but unlike shingle sets stay."""
    base, often = prose(300, 900), "a b c d e " * 40
    texts = [(i, edited(base, 301 + i, 1)) for i in range(5)] + [(10, often + "x y z u v w"), (11, often + "k l m n o p q r"), (12, prose(310, 200))]
    signed = {i: simhash.fingerprint(t, 5, 42) for i, t in texts}
    prints = spark.createDataFrame(list(signed.items()), "sid long, fp long")
    linked, of = {tuple(r) for r in neardup.fingerprint_pairs(prints).collect()}, [(i, f % (1 << 64)) for i, f in signed.items()]
    groups = brute.components(of)
    parent = {r.node: r.root for r in neardup.connected_components(spark.createDataFrame(sorted(linked), "a long, b long"), "a", "b").collect()}
    assert [parent.get(i, i) for i in signed] == groups and parent[11] == 10
    calls, plain = [], simhash.link_roots
    monkeypatch.setattr(simhash, "link_roots", lambda unique, **o: calls.append(unique.count()) or plain(unique, **o))
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA)
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, rows, "").collect()}
    unlike = len(set(neardup.shingles(texts[5][1])) & set(neardup.shingles(texts[6][1]))) < 0.8 * len(set(neardup.shingles(texts[5][1])) | set(neardup.shingles(texts[6][1])))
    assert calls and unlike and got == {0, 10, 11, 12}


def test_near_dedup_joins_tree_and_shingle_links_at_once(spark, monkeypatch):
    """Tree pairs and head pairs are verified and joined together: one pass over the links where no others are left."""
    base = prose(320, 300)
    rows = spark.createDataFrame([(0, base, "en", "s", 1), (1, edited(base, 321, 1), "en", "s", 1), (2, prose(322, 80), "en", "s", 1), (3, None, "en", "s", 1)], SCHEMA)
    calls, plain = [], neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", lambda *a: calls.append(a) or plain(*a))
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, rows, "").collect()} == {0, 2, 3} and len(calls) == 1


def test_html_keeps_all_sections_rows_and_articles(spark):
    def page(i, kind):
        x = [f"{kind} {i} part {j} " + "word " * (5 + 9 * j) for j in range(3)]
        inner = {
            "sections": "<h1>Head {0}</h1><p>Lead {0}</p>" + "".join(f"<div class=section><p>{t}</p></div>" for t in x),
            "rows": "<table>" + "".join(f"<tr><td>{t}</td></tr>" for t in x) + "</table>",
            "articles": "".join(f"<article><p>{t}</p></article>" for t in x),
        }[kind].format(i)
        want = ([f"Head {i}", f"Lead {i}"] if kind == "sections" else []) + [t.strip() for t in x]
        return f"<html><body><nav>Menu {i}</nav>{inner}<div class=legal>Same</div></body></html>", "\n".join(want)

    made = [(k, i, *page(i, k)) for k in ("sections", "rows", "articles") for i in range(4)]
    rows = [(n, f"http://{k}.example/{i}", h) for n, (k, i, h, _) in enumerate(made)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[n] for n in range(len(made))] == [w for *_, w in made]


def test_html_template_inside_articles_and_beyond_200_texts(spark):
    many = "".join(f"<section class=s{j}><p>fixed {j}</p></section>" for j in range(230))
    page = "<body><article><h1>Head {0}</h1><p class=by>Share this</p><p>Body {0}</p><ul><li>one</li><li>two</li></ul></article>" + many + "</body>"
    rows = [(i, f"http://t.example/{i}", page.format(i)) for i in range(9)] + [(20, "http://u.example/", page.format(20))]
    rows += [(30 + i, "http://v.example/", "<body><p>same</p></body>") for i in range(3)]  # copies of one page show no template
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert [got[i] for i in range(9)] == [f"Head {i}\nBody {i}" for i in range(9)]
    assert got[20] == "Head 20\nShare this\nBody 20\none\ntwo" and got[30] == got[31] == got[32] == "same"


def test_pii_contexts_after_numbers_one_word_and_split_identifiers(spark):
    ask = ["please call +1 555 0100 {0} or +1 555 0101 {0} now", "phone: +1 555 0102 {0} is mine", "the card 41111111111{0} expires soon"]
    cards = ["41111111" + str(x) for x in range(10000000, 10003000) if brute.pii("41111111" + str(x)).startswith("card")][:8]
    seeds = [(10 * i + j, a.format(1000 + i)) for i in range(8) for j, a in enumerate(ask[:2])] + [(200 + i, f"the card {c} expires soon") for i, c in enumerate(cards)]
    unseen = {
        900: ("please call 5550199 or 5550188 now", "phone:12:19,phone:23:30"),
        901: ("Phone: 555-0199", "phone:7:15"),
        902: ("please call 555 010 0199 now", "phone:12:24"),
        903: ("the card 4111 1111 1111 1112 expires soon", "card:9:28"),
        904: ("room 101 please call 5550177 now", "phone:21:28"),
        905: ("sold 12 34 and 5550188 pieces of it", ""),
        906: ("reach 5550166 or well", ""),
    }
    got = {r.doc_id: (r.base, r.spans) for r in pii.find(spark.createDataFrame(seeds + [(i, t) for i, (t, _) in unseen.items()], "doc_id long, text string")).collect()}
    assert {i: got[i][1] for i in unseen} == {i: w for i, (_, w) in unseen.items()}
    assert all(got[i][0] == got[i][1] != "" for i, _ in seeds)


def test_html_deep_wide_and_named_pages():
    deep = "<body>" + "<div>" * 3000 + "<p>x {0}</p>" + "</div>" * 3000
    assert html.induce([deep.format(1), deep.format(2)])[-1].endswith("/div/p") and html.main_text(deep.format(1), frozenset(), frozenset()) == "x 1"
    wide = "<body>" + "".join(f"<div class=a{i % 2}>{{0}} {i}</div>" for i in range(5000))
    assert html.induce([wide.format("p"), wide.format("q")]) == ["/body/div.a0", "/body/div.a1"]
    page = '<article><h1>T</h1><div class="share-price">12</div><div class="share-buttons">s</div><div id="comments">c</div><p>body</p></article>'
    assert html.main_text(page, frozenset(), frozenset()) == "T\n12\nbody"


def test_html_of_unclosed_tags_is_read_once():
    """A megabyte of each takes well under a second; trees are those of short pages."""
    for piece in ("<a ", "<!x", "</"):
        for tail in ("", "<!-- open"):
            start = time.perf_counter()
            root = html.parse("<p>t</p>" + piece * 350000 + tail)
            assert time.perf_counter() - start < 5
            assert root.items[0].items == ["t"] and root.items[1] == piece * 350000


def test_tree_matching_against_all_matchings():
    """Size of the matching equals a plain recursion over all order-preserving matchings."""

    def grown(r, depth):
        shape = html.Shape(r.choice("ab") if depth else "root")
        shape.children = [grown(r, depth + 1) for _ in range(r.randrange(4) if depth < 3 else 0)]
        return shape

    def size(a, b):
        if a.name != b.name:
            return 0

        def best(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            return max(best(i + 1, j), best(i, j + 1), best(i + 1, j + 1) + size(a.children[i], b.children[j]))

        return 1 + best(0, 0)

    r = random.Random(5)
    for _ in range(60):
        a, b = grown(r, 0), grown(r, 0)
        pairs = html.match(a, b)
        assert len(pairs) == size(a, b) and len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert all(x.name == y.name for x, y in pairs)


def test_html_against_pages_made_from_known_text(spark):
    """Brute force: pages of random hosts and templates, of which the text is known."""
    r = random.Random(8)

    def page(host, i):
        own = [" ".join(r.choices(VOCABULARY, k=r.randrange(3, 30))) for _ in range(r.randrange(2, 7))]
        tag = ["div class=body", "section", "article"][host % 3]
        inner = f"<h1>{own[0]}</h1>" + "".join(f"<p>{x}</p>" for x in own[1:])
        menu = "".join(f"<li><a href=/{k}>item {k} of {host}</a></li>" for k in range(4))
        html_text = f"<html><head><title>{own[0]}</title></head><body><div class=hd><ul>{menu}</ul></div><{tag}>{inner}</{tag.split()[0]}><div class=ft>All rights of host {host}</div></body></html>"
        return html_text, "\n".join(own)

    made = [(100 * host + i, f"http://h{host}.example/{i}", *page(host, i)) for host in range(6) for i in range(8)]
    rows = spark.createDataFrame([m[:3] for m in made], "page_id long, url string, html string").repartition(3)
    got = {x.page_id: x.text for x in html.extract(rows).collect()}
    assert got == {m[0]: m[3] for m in made}
    alone = {m[0]: html.main_text(m[2], frozenset(), frozenset()) for m in made}
    assert sum(alone[m[0]] != m[3] for m in made) >= 32  # without the wrapper, menus and footers stay
    assert html.extract(rows.limit(0)).count() == 0


def test_html_slots_are_counted_over_all_pages(spark):
    """A third of each host's pages has another layout; whichever pages a sample would take, the common layout's bar goes."""
    own = lambda h, i: f"Moved {h} {i}" if i % 3 == 0 else f"Own {h} {i}"
    form = lambda i: "<body><p>{0}</p></body>" if i % 3 == 0 else "<body><div class=strip>Fixed strip</div><div class=text><p>{0}</p></div></body>"
    rows = [(100 * h + i, f"http://m{h}.example/{i}", form(i).format(own(h, i))) for h in range(8) for i in range(15)]
    got = {x.page_id: x.text for x in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {100 * h + i: own(h, i) for h in range(8) for i in range(15)}
    pages = [x[2] for x in rows[:15]]
    assert html.induce(pages) == ["/body/div.strip", "/body/div.text/p"]
    for page in pages[1:3]:
        shape = html.Shape.of(html.parse(page))
        assert len(html.match(shape, html.drawn(html.layout(shape)))) == 5


def test_pii_of_a_long_text(spark):
    text = " ".join(f"a{i}x word" for i in range(30000)) + " mail a@b.example now"
    [row] = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.base == brute.pii(text) and row.n_email == 1


def test_pipeline_run_and_repeated_ids(spark, tmp_path):
    """run() equals its stages one by one; rows that share an id are judged by their own texts."""
    texts = [(5, prose(200, 90)), (5, prose(201, 90)), (None, prose(202, 90)), (6, prose(200, 90)), (7, "short"), (8, None), (9, prose(203, 60) + "\n" + prose(50, 40))]
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in texts], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, prose(50, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted((r.doc_id or 0, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    own = Tokenizer.from_file(queries.VOCABULARY)
    want = sorted((i or 0, len(own.encode(t, add_special_tokens=False).ids)) for i, t in texts[:3])
    assert got == want
