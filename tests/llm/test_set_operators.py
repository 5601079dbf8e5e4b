"""Operators on pairs, groups and tables against plain versions."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from check_oracles import connect, difference
from pyspark.sql import functions as F

from homespan.llm import decontaminate, graph, preferences, queries, simhash, suffix_dedup, url_filter

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLE[name]) is None


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps):
    parent = {i: i for i in fps}
    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_simhash_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in docs.items()}
    want = plain_components(fps)
    got = queries.op5_simhash(spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in docs}


def test_golay_keys_miss_no_pair():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    for flips in (0, 1, 2):
        y = x.copy()
        for _ in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
        one = set(zip(*map(np.ndarray.tolist, simhash.golay_keys(x.view(np.int64)))))
        two = zip(*map(np.ndarray.tolist, simhash.golay_keys(y.view(np.int64))))
        assert {r for r, k in two if (r, k) in one} == set(range(len(x)))


@pytest.mark.parametrize("limit", [0, 3, 48])
def test_links_connect_crowded_buckets(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIRWISE_BUCKET", limit)
    rng = random.Random(limit)
    fps = {}
    for i in range(260):
        centre = (0x0123456789ABCDEF, 0xF0F0F0F0F0F0F0F0)[i % 2]
        for _ in range(rng.randint(0, 4)):
            centre ^= 1 << rng.randrange(64)
        fps[i] = centre
    first = {}
    for i, fp in sorted(fps.items()):
        first.setdefault(fp, i)
    nodes = spark.createDataFrame([(fp - (1 << 64) if fp >> 63 else fp, i) for fp, i in first.items()], "fp long, rep long")
    roots = {r.a: r.b for r in graph.components(simhash.links(nodes)).collect()}
    want = plain_components(fps)
    assert {i: roots.get(i, i) for i in first.values()} == {i: want[i] for i in first.values()}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3)]
    found = {r.a: r.b for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 200)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count() and simhash.near_duplicates(no_docs).count() == 0
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[2] == by_id[3] == by_id[4] == 2 and by_id[6] == 5
    kept = simhash.keep_one(odd_docs)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == odd_docs.columns and ids.count(1) == 1 and ids.count(None) == 1 and 6 not in ids and 3 not in ids
    assert simhash.keep_one(no_docs).count() == 0


def plain_leaks(docs, items, threshold=0.8):
    def grams(text, k):
        words = text.lower().split()
        return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}
    out = set()
    for item, text in items:
        k = min(5, len((text or "").split()))
        mine = grams(text or "", k) if k else set()
        for doc, body in docs:
            shared = len(mine & grams(body or "", k)) if mine else 0
            if mine and shared >= threshold * len(mine) - 1e-9:
                out.add((doc, item, shared, len(mine)))
    return out


@pytest.mark.parametrize("bound", [1 << 25, 0])
def test_leaks(spark, odd_docs, no_docs, bound):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 30, 60])))) for i in range(40)]
    docs = []
    for d in range(80):
        words = rng.choices(vocabulary, k=rng.choice([0, 4, 50, 2000]))
        part = items[d % 40][1].split()
        for _ in range(rng.randint(0, len(part) // 12)):
            part[rng.randrange(len(part))] = "changed"
        at = rng.randint(0, len(words))
        docs.append((d, " ".join(words[:at] + part + words[at:])))
    items += [(98, None), (99, "  ")]
    table = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = decontaminate.leaks(table(docs, "doc_id"), table(items, "item_id"), broadcast_bytes=bound).collect()
    assert {tuple(r)[:4] for r in got} == plain_leaks(docs, items) and len(got) == len(set(got))
    assert decontaminate.leaks(odd_docs, table([(1, "two three four")], "item_id"), broadcast_bytes=bound).count() == 2
    assert decontaminate.leaks(no_docs, table(items, "item_id"), broadcast_bytes=bound).count() == 0
    clean = decontaminate.clean(odd_docs, table([(1, "two three four")], "item_id"))
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 2


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_clean_judges_each_row(spark, bound):
    rows = [(5, "one two three four five six"), (5, "nothing of that kind here"), (None, "so one two three four five six"),
            (None, "no id and no leak"), (7, None), (7, "seven plain words")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row long")
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    got = decontaminate.clean(docs, items, broadcast_bytes=bound)
    assert got.columns == docs.columns and sorted(r.row for r in got.collect()) == [1, 3, 4, 5]


def test_leaks_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {tuple(r)[:4] for r in queries.op4_decontamination(spark, FOLDER).collect()} == plain_leaks(docs, items)


def test_suffix_array_is_sorted():
    rng = random.Random(6)
    for _ in range(400):
        s = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain_removal(docs):
    first = {}
    for d in sorted(docs):
        raw = docs[d].encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i: i + 50], d)
    out = {}
    for d, text in docs.items():
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i: i + 50]] < d:
                gone[i: i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_passages(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MEETING_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "GATHERING_BYTES", 1000)
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdé ", k=400))
    docs = {}
    for d in range(60):
        pieces = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randrange(300)
            pieces += ["".join(rng.choices("abcdé ", k=rng.randint(0, 120))), passage[a: a + rng.randint(20, 200)]]
        docs[d] = "".join(pieces)
    docs[60] = docs[61] = "ab" * 400
    docs[62] = "x" * 200 + "ab" * 60
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(table).collect()}
    assert got == plain_removal(docs)


def test_suffix_dedup_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op7_suffix_dedup(spark, FOLDER).collect()}
    assert got == plain_removal(docs)


def test_suffix_dedup_odd_rows(odd_docs, no_docs):
    rows = suffix_dedup.deduplicated(odd_docs).collect()
    assert len(rows) == odd_docs.count() and suffix_dedup.deduplicated(no_docs).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].n_removed == by_id[6].n_bytes and by_id[5].n_removed == 0 and by_id[7].n_removed == 0
    assert by_id[2].n_bytes == 0 and by_id[None].n_removed == 0


def test_url_trie_and_join_agree(spark):
    rng = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "badexample.com", "net", "x.net", "", "com."]
    paths = ["", "/", "/en", "/en/", "/en/x", "/english", "/fr/a/b", "//", "/en//x"]
    rules = [("allow", "com", "/"), ("block", "example.com", "/en"), ("allow", "www.example.com", "/en/"),
             ("block", "net", ""), ("allow", "x.net", "/fr/a"), ("allow", "com", "/"), ("block", "com", "/fr/")]
    urls = [f"http://{h}{p}{rng.choice(['', '?q=/en/', '#/fr/'])}" for h in hosts for p in paths]
    urls += [None, "no scheme/en/", "HTTPS://WWW.Example.COM/en/?x://y", "://net", ""]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    by_trie = url_filter.judge_urls(pages, rules).orderBy("page_id").collect()
    by_join = url_filter.judge_urls(pages, rules, broadcast_chars=0).orderBy("page_id").collect()
    assert by_trie == by_join and len(by_trie) == len(urls)
    def plain(host, path):
        fits = [(h.count("."), len(p), v, h + p) for v, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (max(fits)[3], max(fits)[2]) if fits else (None, "allow")
    assert all((r.rule, r.verdict) == plain(r.host, r.path) for r in by_trie)
    assert url_filter.judge_urls(pages.limit(0), []).count() == 0


def test_preferences_share_a_prefix_and_mask_replies(spark):
    rows = [(1, s, 0, "user", "hi") for s in ("chosen", "rejected")]
    rows += [(1, "chosen", 1, "assistant", "good ✓"), (1, "chosen", 2, "user", "ok"), (1, "chosen", 3, "assistant", "bye"),
             (1, "rejected", 1, "assistant", "bad"), (2, "chosen", 0, "user", None), (2, "rejected", 0, "user", ""),
             (3, "chosen", None, None, "x"), (None, "chosen", 0, "user", "lost"), (4, "other", 0, "user", "lost")]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "pair_id long, side string, turn long, role string, text string, prompt string, k string")
    got = {r.pair_id: r for r in preferences.preference_records(turns).collect()}
    one = got[1]
    assert sorted(got) == [1, 2, 3] and one.n_shared_turns == 1
    assert one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert [one.chosen[a:b] for a, b in one.chosen_mask] == ["good ✓<|im_end|>", "bye<|im_end|>"]
    assert [one.rejected[a:b] for a, b in one.rejected_mask] == ["bad<|im_end|>"]
    assert (got[2].chosen, got[2].rejected, got[2].n_shared_turns) == ("", "", 1)
    assert got[3].prompt == "" and got[3].rejected == "" and got[3].chosen == "<|im_start|>\nx<|im_end|>\n"
    assert preferences.preference_records(turns.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, 0, None, None), (None, 0, "user", "x"), (2, None, "assistant", "y"),
                                 (5, 0, "assistant", None), (6, 0, "assistant", "z")], "conv_id long, turn long, role string, text string")
    assert preferences.preference_records(preferences.reply_pairs(odd)).count() == 1
