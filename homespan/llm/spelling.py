"""Spelling variants by bidirectional FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Cut a word P of m code
points into a left half A (m // 2) and a right half B (the rest). With a single edit, a near word V either ends with B
(the edit lies in A) or begins with A. So two searches find every near word:

* ``fwd``: on an FM-index of the words, backward search matches a word end, then B exactly, then extends leftwards
  across A allowing one edit, and must end at a word start;
* ``rev``: on an FM-index of the reversed words (the other direction of the bidirectional index), the same search on
  the reversed word matches A exactly and extends rightwards across B.

Every word has at least 7 code points, so B has at least 4 and A at least 3. Words are dealt to buckets by their last
four code points (``fwd``) and their first four (``rev``); a query goes to the bucket of its own last four, and to that
of its first four, or, when A has only 3 code points, to every ``rev`` bucket beginning with A. A bucket larger than
``block_words`` is split into blocks of words and blocks of queries, and every query block meets every word block of
its bucket, so no task holds more than ``block_words`` of either. Each task builds the suffix array (prefix doubling),
the Burrows-Wheeler text and a sorted rank directory, and runs all its queries together, one pattern position a step,
as arrays of suffix-rank intervals.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from homespan.session import fresh_path

MIN_CHARS = 7
MIN_COUNT = 2
#: A form needs at least this many times the word's count.
FORM_FACTOR = 10
#: Words and queries per task at most, in a bucket that is split.
BLOCK_WORDS = 50_000
KEY_CHARS = 4
_RUN = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEP, _END = 1, 0


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
               min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """Distinct words with their occurrence count n: word, n.

    Runs of ``[A-Za-z\\u00C0-\\u00FF]`` with only A-Z lower-cased; when the unsigned crc32 h of
    ``<doc_id>:<run>`` is divisible by 31, the code point h % length is deleted. A null doc_id gives no h and no
    deletion; a null text has no runs. Counted with partial aggregation, so a very frequent word is no hot group.
    """
    runs = docs.select(F.col(doc_id).cast("string").alias("_id"), F.explode(F.regexp_extract_all(
        F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(_RUN), 0)).alias("run"))
    runs = runs.select("_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    word = F.when((h % 31) == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.lit(1 << 30)))) \
        .otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class FmIndex:
    """FM-index of distinct words joined by a separator: suffix array, BWT, counts below each code, rank directory."""

    def __init__(self, words: list[str]):
        self.words = words
        joined = "\x01" + "\x01".join(words) + "\x01\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(points, return_inverse=True)  # \x00 -> 0, \x01 -> 1, letters above
        text = text.astype(np.int64)
        n, self.sigma = len(text), len(self.alphabet)
        self.n = n
        self.sa = _suffix_array(text)
        bwt = text[self.sa - 1]
        counts = np.bincount(text, minlength=self.sigma)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(bwt, kind="stable")
        self.directory = bwt[order] * (n + 1) + order
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(sizes + 1) - sizes  # text position of each word's first code point

    def codes(self, word: str) -> np.ndarray:
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        at[at >= self.sigma] = self.sigma - 1
        return np.where(self.alphabet[at] == points, at, self.sigma)  # unknown code points: sigma, an empty interval

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prepend code c to each matched string: the new suffix-rank intervals."""
        base = c * (self.n + 1)
        return np.searchsorted(self.directory, base + lo), np.searchsorted(self.directory, base + hi)

    def word_at(self, row: np.ndarray) -> np.ndarray:
        """Word index of suffix-array rows that begin at the separator before a word."""
        return np.searchsorted(self.starts, self.sa[row] + 1)


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the text ends with its only 0."""
    n = len(text)
    rank, k = text.copy(), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + nxt
        sa = np.argsort(key, kind="stable")
        ordered = key[sa]
        rank = np.empty(n, np.int64)
        rank[sa] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[sa[-1]] == n - 1 or k >= n:
            return sa
        k *= 2


def search(index: FmIndex, patterns: list[str], exact: list[int]) -> list[tuple[int, int]]:
    """(pattern, word) index pairs where the word is one edit from the pattern and ends with its last ``exact``
    code points. All patterns advance together, one pattern position per step."""
    if not patterns or not index.words:
        return []
    codes = [index.codes(p) for p in patterns]
    m = np.fromiter(map(len, patterns), np.int64, len(patterns))
    width = int(m.max())
    grid = np.full((len(patterns), width), index.sigma, np.int64)
    for q, c in enumerate(codes):
        grid[q, : len(c)] = c
    e = np.asarray(exact, np.int64)
    qid = np.arange(len(patterns))
    lo = np.full(len(patterns), index.below[_SEP])
    hi = np.full(len(patterns), index.below[_SEP + 1])
    for s in range(int(e.max())):  # the exact part, from the end
        go = s < e
        j = m - 1 - s
        c = np.where(go, grid[qid, np.maximum(j, 0)], 0)
        nlo, nhi = index.step(c, lo, hi)
        lo, hi = np.where(go, nlo, lo), np.where(go, nhi, hi)
    keep = hi > lo
    qid, lo, hi = qid[keep], lo[keep], hi[keep]
    j, err = (m - e - 1)[keep], np.zeros(keep.sum(), np.int64)
    letters = np.arange(_SEP + 1, index.sigma)
    found_q, found_w = [], []
    while len(qid):
        done = j < 0
        if done.any():  # the whole pattern is matched: a word start must follow
            flo, fhi = index.step(np.full(done.sum(), _SEP), lo[done], hi[done])
            hit = (fhi > flo) & (err[done] == 1)
            found_q.append(qid[done][hit])
            found_w.append(index.word_at(flo[hit]))
        nq, nlo, nhi, nj, ne = [], [], [], [], []
        live = ~done
        # match the pattern's code
        if live.any():
            c = grid[qid[live], j[live]]
            a, b = index.step(c, lo[live], hi[live])
            nq.append(qid[live]), nlo.append(a), nhi.append(b), nj.append(j[live] - 1), ne.append(err[live])
        fresh = err == 0
        if fresh.any():
            fl = fresh & live
            # deletion: the pattern's code is not in the word
            nq.append(qid[fl]), nlo.append(lo[fl]), nhi.append(hi[fl]), nj.append(j[fl] - 1), ne.append(np.ones(fl.sum(), np.int64))
            # replacement and insertion: any letter before what is matched
            rows = np.flatnonzero(fresh)
            rq = np.repeat(rows, len(letters))
            rc = np.tile(letters, len(rows))
            a, b = index.step(rc, lo[rq], hi[rq])
            ok = b > a
            rq, rc, a, b = rq[ok], rc[ok], a[ok], b[ok]
            sub = j[rq] >= 0
            sub &= rc != grid[qid[rq], np.maximum(j[rq], 0)]
            nq.append(qid[rq][sub]), nlo.append(a[sub]), nhi.append(b[sub]), nj.append(j[rq][sub] - 1)
            ne.append(np.ones(sub.sum(), np.int64))
            nq.append(qid[rq]), nlo.append(a), nhi.append(b), nj.append(j[rq]), ne.append(np.ones(len(rq), np.int64))
        qid, lo, hi, j, err = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (nq, nlo, nhi, nj, ne))
        keep = hi > lo
        qid, lo, hi, j, err = qid[keep], lo[keep], hi[keep], j[keep], err[keep]
    if not found_q:
        return []
    pairs = set(zip(np.concatenate(found_q).tolist(), np.concatenate(found_w).tolist()))
    return [(q, w) for q, w in pairs if patterns[q] != index.words[w]]


def _search_block(words: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if words.empty or queries.empty:
        return pd.DataFrame({"word": pd.Series([], dtype=object), "near": pd.Series([], dtype=object)})
    reverse = words["side"].iloc[0] == "rev"
    flip = (lambda s: s[::-1]) if reverse else (lambda s: s)
    index = FmIndex([flip(w) for w in words["word"].tolist()])
    asked = queries["q_word"].tolist()
    exact = [len(q) // 2 if reverse else len(q) - len(q) // 2 for q in asked]
    pairs = search(index, [flip(q) for q in asked], exact)
    return pd.DataFrame({"word": [asked[q] for q, _ in pairs], "near": [flip(index.words[w]) for _, w in pairs]},
                        dtype=object)


def near_pairs(vocab: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every ordered pair (word, near) of distinct vocabulary words one edit apart."""
    length = F.char_length("word")
    entries = vocab.select("word", F.explode(F.array(
        F.struct(F.lit("fwd").alias("side"), F.col("word").substr(length - (KEY_CHARS - 1), F.lit(KEY_CHARS)).alias("key")),
        F.struct(F.lit("rev").alias("side"), F.col("word").substr(F.lit(1), F.lit(KEY_CHARS)).alias("key")))).alias("e"))
    entries = entries.select("word", "e.side", "e.key")
    count_blocks = lambda df, name: df.groupBy("side", "key").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_words)).cast("int").alias(name))
    wblocks = count_blocks(entries, "wblocks")
    # queries: the own fwd bucket; the own rev bucket, or all rev buckets after a three-code-point left half
    own = entries.where((F.col("side") == "fwd") | (F.floor(length / 2) >= KEY_CHARS))
    short = vocab.where(F.floor(length / 2) < KEY_CHARS).select(
        "word", F.lit("rev").alias("side"), F.col("word").substr(F.lit(1), F.lit(KEY_CHARS - 1)).alias("head"))
    spread = short.join(wblocks.where(F.col("side") == "rev").select(
        "side", "key", F.col("key").substr(F.lit(1), F.lit(KEY_CHARS - 1)).alias("head")), ["side", "head"]).drop("head")
    asked = own.unionByName(spread)
    qblocks = count_blocks(asked, "qblocks")
    blocks = wblocks.join(qblocks, ["side", "key"])
    block_of = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    # words and queries of a bucket are dealt in blocks of at most about block_words; each pair of blocks meets once
    words = entries.join(blocks, ["side", "key"]).select(
        "side", "key", "word", block_of("wblocks").alias("wblock"),
        F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)).alias("qblock"))
    queries = asked.join(blocks, ["side", "key"]).select(
        F.col("side").alias("q_side"), F.col("key").alias("q_key"), F.col("word").alias("q_word"),
        block_of("qblocks").alias("q_qblock"), F.explode(F.sequence(F.lit(0), F.col("wblocks") - 1)).alias("q_wblock"))
    keys = ["side", "key", "wblock", "qblock"]
    found = words.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{k}" for k in keys])).applyInPandas(
        _search_block, "word string, near string")
    both = found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))
    return both.distinct()


def variants(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every vocabulary word (see ``vocabulary``).

    form: the near word of largest n (ties: smallest in code-point order) if that n >= 10 * the word's n, else null;
    root: follow forms to the last (the word itself without one); n_near: number of near words (0 if none); form_n:
    the form's n or null. Forms always have a larger n, so roots are found in at most log10 of the largest n steps.
    An empty table or one without words of 7 code points gives no rows; other input columns are not read.
    """
    path = fresh_path(spark, "spelling-vocabulary")
    vocabulary(docs, text, doc_id).write.parquet(path)
    vocab = spark.read.schema("word string, n long").parquet(path)
    pairs_path = fresh_path(spark, "spelling-pairs")
    near_pairs(vocab, block_words).write.parquet(pairs_path)
    pairs = spark.read.schema("word string, near string").parquet(pairs_path)
    scored = pairs.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = scored.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                      F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("b"))
    forms = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.neg") >= FORM_FACTOR * F.col("n"), F.col("b.near")).alias("form"),
        F.when(-F.col("b.neg") >= FORM_FACTOR * F.col("n"), -F.col("b.neg")).cast("long").alias("form_n"))
    forms_path = fresh_path(spark, "spelling-forms")
    forms.write.parquet(forms_path)
    forms = spark.read.parquet(forms_path)
    links = forms.where(F.col("form").isNotNull()).select(F.col("word").alias("at"), F.col("form").alias("up"))
    roots = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:  # each round follows one more form; chains are short since n grows tenfold a link
        stepped = roots.join(links, roots["root"] == links["at"], "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved"))
        round_path = fresh_path(spark, "spelling-roots")
        stepped.write.parquet(round_path)
        roots = spark.read.parquet(round_path)
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.drop("moved")
    return forms.join(roots.select("word", "root"), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")
