"""Token counts, phrase collocations and spelling variants against plain versions, on small tables and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from homespan.llm import queries, token_counts

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_whole_tokens_encode_alone_as_themselves(library):
    whole = token_counts.whole_token_strings(library)
    vocab = library.get_vocab()
    assert len(whole) > 40_000
    sample = random.Random(3).sample(sorted(whole), 2000)
    for piece in sample:
        assert library.encode(whole[piece], add_special_tokens=False).ids == [vocab[piece]]


def test_counts_are_the_librarys_on_odd_spacing(library):
    rng = random.Random(7)
    alphabet = " \n\t\r\x0b\x1c\x85\xa0 　aàéñßÜ1²'sSd.,!?-<>|漢"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", " ", "a ", " a", "a  b", "x\n y", "<|endoftext|> a<|endoftext|>", "q <|endoftext| x", "x" * 5000,
              "it's  they'll", ("word " * 300_000) + "end"]
    counter = token_counts.TokenCounter(queries.tokenizer_path())
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert counter.counts(texts) == want
    assert counter.counts(texts) == want  # again, from the remembered units


def test_query_matches_library_on_the_smallest_table(spark, library):
    got = {r.doc_id: r for r in queries.op11_token_counts(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        assert got[d.doc_id].n_tokens == n
        assert got[d.doc_id].n_bytes == len((d.text or "").encode())
        assert got[d.doc_id].over_limit == (n > 1024)


def test_token_counts_on_odd_rows(spark, odd_docs, no_docs, library):
    rows = token_counts.token_counts(odd_docs, queries.tokenizer_path(), limit=10).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 10)
    assert token_counts.token_counts(no_docs, queries.tokenizer_path()).count() == 0


# ---- phrase collocations ------------------------------------------------------------------------------------------

def _plain_collocations(rows, threshold, top):
    import re
    from collections import Counter, defaultdict

    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i: i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= threshold}
        rows_ = []
        for p, a in cand.items():
            covered = any(len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))
                          and 100 * b >= 80 * a for q, b in cand.items())
            if covered:
                continue
            best = min(((2_000_000 * a) // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            k = best[1]
            rows_.append((best[0], a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        rows_.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, ph, a, l, r, n[lang], s) for i, (s, a, ph, l, r) in enumerate(rows_[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_docs(spark):
    rng = random.Random(11)
    vocab = ["new", "york", "city", "the", "of", "a", "big", "apple", "red", "car", "ÉTÉ", "naïve"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            words[len(words) // 2: len(words) // 2] = ["new", "york", "city"]
        text = " ".join(words)
        if i % 7 == 0:
            text = text.replace(" ", ". ", 2).upper()
        rows.append((i, text if i % 50 else None, rng.choice(["en", "de", None])))
    rows += [(999, "\t new \t york\tcity ;; new york!", "en")] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("shards, broadcast_rows", [(1, 0), (3, 2_000_000)])
def test_collocations_match_a_plain_count(spark, phrase_docs, shards, broadcast_rows):
    from homespan.llm import collocations

    got = collocations.collocations(spark, phrase_docs, threshold=5, shards=shards, top=7,
                                    broadcast_rows=broadcast_rows).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = _plain_collocations([(r.lang, r.text) for r in phrase_docs.collect()], 5, 7)
    assert sorted(tuple(r) for r in got) == want
    assert len(want) > 10


def test_collocations_on_odd_rows(spark, odd_docs, no_docs):
    from homespan.llm import collocations

    got = collocations.collocations(spark, odd_docs, threshold=3, top=None).collect()
    assert got and all(r.score <= 1_000_000 and r.a >= 3 for r in got)
    assert collocations.collocations(spark, no_docs).count() == 0


@pytest.mark.parametrize("shards, broadcast_rows", [(1, 1000), (3, 1000), (3, 0)])
def test_phrases_are_counted_over_one_cycle_only(spark, shards, broadcast_rows):
    from homespan.llm import collocations
    from homespan.session import fresh_path

    vocab = "a b c d e f g h".split()
    rng = random.Random(5)
    texts = [" ".join(rng.choice(vocab) for _ in range(12)) for _ in range(200)]
    path = fresh_path(spark, "test-pieces")
    collocations.pieces(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"), shards=shards) \
        .write.partitionBy("shard").parquet(path)
    got = collocations.count_phrases(spark, path, threshold=2, max_words=4, shards=shards, broadcast_rows=broadcast_rows)
    grams = {}
    for t in texts:
        ws = t.split()
        for k in range(1, 5):
            for i in range(len(ws) - k + 1):
                p = " ".join(ws[i: i + k])
                grams[p] = grams.get(p, 0) + 1
    assert {r.phrase: r.cnt for r in got.phrases.collect()} == {
        p: n for p, n in grams.items() if n >= 2 or " " not in p}
    # all words are at the threshold after step 0, so every pair is finished after one cycle from step 1 on
    assert max(step for step, k in got.counted if k == 2) <= shards + 1
    # and all lengths a cycle after the last sub-phrase got there, with no scan behind it
    assert got.steps <= 3 * (shards + 1) + 1


# ---- spelling variants --------------------------------------------------------------------------------------------

def _plain_variants(rows):
    import re
    import zlib
    from collections import Counter

    def ed1(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    words = {w: c for w, c in n.items() if c >= 2}
    near = {w: [v for v in words if ed1(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v)) if vs else None
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        r = w
        while form[r]:
            r = form[r]
        out.add((w, form[w], r, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def spelling_docs(spark):
    rng = random.Random(4)
    stems = ["reception", "environment", "government", "Straße", "naïveté", "übersetzung", "definitely", "separate"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 25)):
            w = rng.choice(stems)
            if rng.random() < 0.15:
                k, op = rng.randrange(len(w)), rng.randrange(3)
                w = (w[:k] + w[k + 1:], w[:k] + "x" + w[k + 1:], w[:k] + "é" + w[k:])[op]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i if i % 60 else None, " ".join(words) + ", ok.", "en"))
    rows += [(7, "Reception receptio receptiom", None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("block_words", [50_000, 7])
def test_spelling_variants_match_a_plain_search(spark, spelling_docs, block_words):
    from homespan.llm import spelling

    got = spelling.variants(spark, spelling_docs, block_words=block_words).collect()
    want = _plain_variants([(r.doc_id, r.text) for r in spelling_docs.collect()])
    assert {tuple(r) for r in got} == want
    assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want) or any(r[1] for r in want)


def test_fm_index_search_finds_every_near_word():
    from homespan.llm.spelling import FmIndex, search

    rng = random.Random(1)
    letters = "abcdeéàx"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(400)} | {
        "abcdefg", "abcdefgh", "xbcdefg", "bcdefgh", "abcdef"})
    index = FmIndex(words)
    found = {(words[q], words[w]) for q, w in search(index, words, [len(q) - len(q) // 2 for q in words])}
    rev = FmIndex([w[::-1] for w in words])
    found |= {(words[q], rev.words[w][::-1]) for q, w in search(rev, [w[::-1] for w in words], [len(q) // 2 for q in words])}
    plain = {(a, b) for a in words for b in words if a != b and (
        (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)
        or (len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b))))
        or (len(b) + 1 == len(a) and any(a[:i] + a[i + 1:] == b for i in range(len(a)))))}
    assert found == plain and ("abcdefg", "abcdefgh") in found


def test_spelling_on_odd_rows(spark, odd_docs, no_docs):
    from homespan.llm import spelling

    assert spelling.variants(spark, odd_docs).where("n < 2").count() == 0
    assert spelling.variants(spark, no_docs).count() == 0
