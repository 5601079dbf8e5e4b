"""Operators on single texts against plain versions, on the smallest tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from homespan.llm import pii, quality, queries, token_store, toxicity, trie_bpe

FOLDER = "/root/testdata/sf0.001"
ALPHABET = " \n\t\r\x0b\x1c\x85\xa0\u2003\u3000aàéñßÜ1²٣'sSd.,!?-_<>|\u0301\U00030000ሴ漢あ\u200b\u180e\ufeff"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    made += ["", " ", "it's they'll I'D '", "<|endoftext|> a <|endoftext|>b  <|endoftext|>", "  x \n\n y \n z", "a" * 3000]
    stored = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    return made + stored


def test_trie_encoding_is_the_librarys(library, texts):
    bpe = trie_bpe.encoder(queries.tokenizer_path())
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [a.tolist() for a in bpe.encode(texts)] == want
    assert [bpe.decode(ids) for ids in want] == [library.decode(ids, skip_special_tokens=False) for ids in want]
    rng = random.Random(2)
    loose = [[rng.randrange(50257) for _ in range(9)] for _ in range(500)]
    assert [bpe.decode(i) for i in loose] == [library.decode(i, skip_special_tokens=False) for i in loose]


def test_splitter_spaces_and_safe_letters(library):
    """Whatever the library's splitter takes for a space is one to Python; the letters encoded directly are letters to it."""
    split = library.pre_tokenizer.pre_tokenize_str
    for code in (*range(1, 0xD800), *range(0xE000, 0x10000)):
        ch = chr(code)
        if trie_bpe._SIMPLE.fullmatch(ch):
            assert len(split("a" + ch)) == 1
        if len(split("!" + ch)) == 2 and len(split("a" + ch)) == 2 and len(split("1" + ch)) == 2:
            assert ch.isspace() or ch == "'", hex(code)


def test_bpe_columns(spark, odd_docs, no_docs, library):
    path = queries.tokenizer_path()
    rows = odd_docs.select("text", trie_bpe.encoded(F.col("text"), path).alias("ids")).withColumn(
        "back", trie_bpe.decoded(F.col("ids"), path)).collect()
    for r in rows:
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids and r.back == (r.text or "")
    assert no_docs.select(trie_bpe.digests(F.col("text"), path)).count() == 0


def test_bpe_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op6_bpe(spark, FOLDER).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_codes_give_random_access():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 300, 5000), rng.integers(0, 2**32, 700), [0, 255, 256, 65535, 65536]])
    codes = token_store.Codes(token_store.pack(ids))
    assert len(codes) == len(ids) and (codes.all() == ids).all()
    assert [codes[i] for i in range(len(ids))] == ids.tolist()
    assert len(token_store.Codes(token_store.pack(np.empty(0)))) == 0


def test_token_store_query(spark, library):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    start, want = 0, []
    for doc_id, text in docs:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = queries.op2_token_store(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_token_store_odd_rows(spark, odd_docs, no_docs, library, tmp_path):
    path = queries.tokenizer_path()
    token_store.write_store(odd_docs, str(tmp_path / "a"), path, shard_tokens=500)
    found = token_store.read_store(spark, str(tmp_path / "a")).orderBy("start").collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in odd_docs.collect()))
    ids = [library.encode(t, add_special_tokens=False).ids + [0] for *_, t in rows]
    assert [r.doc_id for r in found] == [d if known else None for known, d, *_ in rows]
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    flat = [x for i in ids for x in i]
    wanted = [0, 1, len(flat) // 2, len(flat) - 1]
    assert token_store.tokens_at(spark, str(tmp_path / "a"), wanted) == {p: flat[p] for p in wanted}
    token_store.write_store(no_docs, str(tmp_path / "b"), path)
    assert token_store.read_store(spark, str(tmp_path / "b")).count() == 0


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in range(3)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures(texts):
    for text in [*texts, "a b a b a b c", "x x x x", "q\nq\n q\nq", "a b c a b c d a b c"]:
        assert quality.measure_text(text)[:5] == plain_measures(text)


def test_quality_query_and_thresholds(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op1_quality(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain_measures(docs[r.doc_id].text or "")
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    assert all(r.kept for r in rows if r.doc_id in good and not r.base_failed)


def test_sketch_quantiles_are_close(spark):
    values = [i % 400 / 400 for i in range(3000)]
    text = lambda v: " ".join(["word"] * 0 + [f"w{i}" for i in range(400)]) + "!" * round(400 * v)
    docs = spark.createDataFrame([("en", "a", text(v)) for v in values], "lang string, source string, text string")
    limits = quality.thresholds(quality.sketches(quality.measured(docs))).where("level = 0").first()
    q50, q90 = np.quantile(values, [0.5, 0.9])
    want = q50 + quality.REACH * (q90 - q50 + quality.SLACK["shout_rate"])
    assert limits.shout_rate == pytest.approx(want, rel=0.06)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and quality.keep_good(no_docs).count() == 0
    assert {r.doc_id for r in kept.collect()} >= {100 + i for i in range(40)}
    assert {1, 2, 3, 4, 7} & {r.doc_id for r in kept.collect()} == set()


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        odd = [int(d) for d in digits[::-1]]
        if 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(odd)) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]


def test_plain_personal_data():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice("a1.@+- ()_9255.4242é4111111111111111") for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text
    assert pii.base_spans("1" * 50_000) == [] and pii.base_spans("a" * 50_000 + "@") == []


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op10_pii(spark, FOLDER).collect():
        base = sorted(plain_spans(docs[r.doc_id]))
        assert tuple(r)[1:5] == tuple(sum(k == n for k, *_ in base) for n in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(filter(None, pii.written(base).split(","))) <= set(filter(None, r.spans.split(",")))


def test_trees_find_other_spellings(spark):
    rng = random.Random(9)
    number = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    docs = spark.createDataFrame([(i, f"some words before {number()} and after a{i}@mail.example.com ok, year 1999 4711")
                                  for i in range(300)], "doc_id long, text string")
    model = pii.fit(docs)
    _, spans = pii.find("please call (415) 555-0199 soon", model)
    assert pii.written(spans) == "phone:12:26"
    assert pii.redact("call (415) 555-0199.", [(3, 5, 19)]) == "call [PHONE]."
    _, none = pii.find("in 1999 there were 4711 houses and 12 cats", model)
    assert none == []


def test_personal_data_odd_rows(odd_docs, no_docs):
    out = pii.redacted(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count() and pii.redacted(no_docs).count() == 0
    assert any(r.text and "[EMAIL]" in r.text for r in out.where("doc_id is null").collect())


def test_grammar_tells_aimed_negated_and_reported():
    lexicon = toxicity.Lexicon(toxicity._seed_entries())
    def events(text):
        x = toxicity.clause_features(text, lexicon)
        return {e for e, v in zip(toxicity.EVENTS, x) if v}
    assert events("You are an idiot.") == {"I+"}
    assert events("What an idiot you are!") == {"I", "late"}
    assert events("you are not an idiot") == {"i+"}
    assert events("she said you are an idiot") == {"J+"}
    assert events("I will kill you") == {"H", "late"}
    assert events("A calm day. Nothing else.") == set()


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op9_toxicity(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.9


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    assert toxicity.scored(odd_docs, *toxicity.fit(odd_docs, labels)).count() == odd_docs.count()
    assert toxicity.scored(no_docs, *toxicity.fit(no_docs, labels.limit(0))).count() == 0


def test_pii_address_beyond_ascii():
    class Sure:
        def score(self, features):
            return 1.0

    text = "write to jörg.müller@example.com or ann@example.org today"
    base, spans = pii.find(text, (Sure(), [0.5] * 4))
    assert [text[s:e] for _, s, e in base] == ["ller@example.com", "ann@example.org"] and set(base) < set(spans)
    assert pii.redact(text, spans) == "write to [EMAIL] or [EMAIL] today"
    rows = pii.training_rows("jörg.müller@example.com")
    assert (pii.describe("jörg.müller@example.com", 0, 0, 23), 1.0, 0) in rows


def test_pii_trees_learn_from_every_document(spark):
    rng = random.Random(4)
    card = lambda: "".join(str(rng.randint(0, 9)) for _ in range(16))
    rows = [(i, f"mail to a{i}@mail.example.com or host 10.0.{i % 250}.7 at {i} noon, order {card()} of 2004-11-{i % 28}")
            for i in range(9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, seen = [r for _, t in rows for r in pii.training_rows(t)], []

    class Seen(pii.Trees):
        def __init__(self, *at):
            super().__init__(*at)

        def _split(self, tree, node, cells):
            if node == 1 and not self.trees:
                seen.append(cells[0, :, 2].sum())
            super()._split(tree, node, cells)

    plain, pii.Trees = pii.Trees, Seen
    try:
        trees, limits = pii.fit(docs)
        again, same = pii.fit(docs, local_cells=0)
    finally:
        pii.Trees = plain
    assert seen[0] == seen[1] > 0.6 * len(found) > 20_000  # all but the rows held out, not a sample
    assert limits == same and trees.start == again.start
    x = np.array([f for f, _, _ in found[:2_000]])
    assert (trees.scores(trees.bins(x)) == again.scores(again.bins(x))).all()
    assert list(trees.scores(trees.bins(x[:300]))) == [trees.score(list(r)) for r in x[:300]]
    for text in ("a at b.c", "x@y.z", "jo [at] mail [dot] org", "look at it. So", "q@ w.e", "n (at) m dot k", "at.b", "@a."):
        assert [(0, m.start(), m.end()) for m in pii._WIDE["email"].finditer(text)] == [c for c in pii.candidates(text) if c[0] == 0]


def test_pii_threshold_is_never_below_one_half():
    counts = pd.DataFrame({"score": [0.99, 0.7, 0.001], "n": [900, 100, 5], "good": [900.0, 99.0, 0.0]})
    assert pii.calibrate(counts) == 0.7 and pii.calibrate(counts[2:]) == 1.01
    assert pii.calibrate(counts.assign(good=[900.0, 50.0, 0.0])) == 0.99
