"""Benchmark decontamination: short test items found inside long documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from homespan.llm.text import hash_shingles, hash_words, rows_of, slices, words

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Items are sent to every task only up to this many bytes of text; beyond it the sketches are joined.
BROADCAST_BYTES = 32 << 20
_FILTER_BITS = 20


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> set[bytes]:
    """Distinct word shingles, A-Z lower-cased; a shorter text is one shingle, a text without words none."""
    found = words(text, lower=True)
    k = min(size, len(found))
    return {b" ".join(found[i: i + k]) for i in range(len(found) - k + 1)} if k else set()


def sketch(text: str | None, threshold: float = CONTAINMENT, size: int = SHINGLE_WORDS) -> tuple[int, list[int]]:
    """(words per shingle, bottom MinHash values) of an item.

    Items are partitioned by their number n of distinct shingles into [2^i, 2^(i+1)). In a partition with upper
    bound u the sketch keeps the s = floor((1 - threshold) * u) + 1 smallest hashes. A document that contains
    ``threshold`` of the item lacks fewer than s of its shingles, so it meets the sketch for certain, however long it is:
    the search is one-sided and the document's size needs no estimate.
    """
    found = words(text, lower=True)
    if not found:
        return 0, []
    k = min(size, len(found))
    hashes = np.unique(hash_shingles(hash_words([b" ".join(found)])[0], k))
    upper = (1 << int(len(hashes)).bit_length()) - 1
    keep = min(len(hashes), int((1 - threshold) * upper + 1e-9) + 1)
    return k, hashes[:keep].tolist()


class ItemIndex:
    """Sketches and shingles of bounded items, as each task needs them."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float, size: int):
        self.threshold, self.size = threshold, size
        self.shingles = {}
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]], np.ndarray]] = {}
        owners: dict[int, dict[int, list[int]]] = {}
        for n, (_, text) in enumerate(items):
            k, hashes = sketch(text, threshold, size)
            if k:
                self.shingles[n] = shingles(text, size)
            for h in hashes:
                owners.setdefault(k, {}).setdefault(h, []).append(n)
        for k, table in owners.items():
            sorted_hashes = np.array(sorted(table), np.uint64)
            maybe = np.zeros(1 << _FILTER_BITS, bool)
            maybe[(sorted_hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
            self.by_length[k] = (sorted_hashes, [table[h] for h in sorted_hashes.tolist()], maybe)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text index, item index, shared shingles, shingles of the item) at or above the threshold."""
        raws = [(t or "").encode() for t in texts]
        candidates: set[tuple[int, int]] = set()
        for first, part in slices(raws):
            hashes, owner = hash_words(part)
            for k, (table, items, maybe) in self.by_length.items():
                grams = hash_shingles(hashes, k)
                at = np.flatnonzero(maybe[(grams & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
                at = at[owner[at] == owner[at + k - 1]]
                place = np.minimum(np.searchsorted(table, grams[at]), len(table) - 1)
                hit = table[place] == grams[at]
                for doc, p in zip(owner[at[hit]].tolist(), place[hit].tolist()):
                    candidates.update((first + doc, n) for n in items[p])
        out, last, own = [], None, set()
        for doc, n in sorted(candidates):
            wanted = self.shingles[n]
            k = len(next(iter(wanted)).split(b" "))
            if (doc, k) != last:
                last, own = (doc, k), _contiguous(texts[doc], k)
            shared = len(wanted & own)
            if shared >= self.threshold * len(wanted) - 1e-9:
                out.append((doc, n, shared, len(wanted)))
        return out


def _contiguous(text: str | None, k: int) -> set[bytes]:
    found = words(text, lower=True)
    return {b" ".join(found[i: i + k]) for i in range(len(found) - k + 1)}


_OUT = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def leaks(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT, size: int = SHINGLE_WORDS,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Pairs (doc_id, item_id) where the document holds at least ``threshold`` of the item's distinct shingles.

    Items shorter than a shingle match as one word sequence. Null or wordless texts match nothing; repeated rows of
    either table give repeated pairs. Rows with a null id take part and keep it. Other columns are not read.

    Documents stream past once. While the items' text fits ``broadcast_bytes`` (counted first) their sketches and
    shingles go to every task, which verifies its candidates at once and shuffles nothing. Larger item tables are joined on
    sketch hashes with the documents' shingle hashes, and candidates are verified after joining the texts back.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("item_text") + 16), F.lit(0))).first()[0]
    if total > broadcast_bytes:
        return _joined_leaks(_numbered(docs, "leak-docs"), items, threshold, size)
    rows = [tuple(r) for r in items.collect()]
    ids = [r[0] for r in rows]
    shared = spark.sparkContext.broadcast(ItemIndex(rows, threshold, size))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, start = batch.column(0).to_pylist(), 0
            for texts in rows_of(batch.column(1)):
                found = shared.value.search(texts)
                if found:
                    d, n, s, w = map(list, zip(*found))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_ids[start + i] for i in d], pa.int64()), pa.array([ids[i] for i in n], pa.int64()),
                        pa.array(s, pa.int64()), pa.array(w, pa.int64()), pa.array([a / b for a, b in zip(s, w)])],
                        names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"])
                start += len(texts)

    return docs.mapInArrow(search, _OUT)


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows, stored once with a number of their own, ``row``."""
    from homespan.session import fresh_path

    path = fresh_path(df.sparkSession, name)
    df.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _joined_leaks(docs: DataFrame, items: DataFrame, threshold: float, size: int) -> DataFrame:
    """The same pairs for item tables of any size, by a join on hashes; ``docs`` are numbered so that ids may repeat."""
    items = _numbered(items, "leak-items")

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks, hs, rs = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k, hashes = sketch(text, threshold, size)
                ks += [k] * len(hashes)
                hs += hashes
                rs += [row] * len(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(np.array(hs, np.uint64).view(np.int64)),
                                              pa.array(rs, pa.int64())], names=["k", "h", "item_row"])

    wanted = items.select("row", "item_text").mapInArrow(sketches, "k int, h long, item_row long")
    lengths = sorted(r.k for r in wanted.select("k").distinct().collect())  # at most ``size`` values

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for first, part in slices([(t or "").encode() for t in batch.column(1).to_pylist()]):
                hashes, owner = hash_words(part)
                for k in lengths:
                    g = hash_shingles(hashes, k)
                    at = np.flatnonzero(owner[: len(g)] == owner[k - 1:]) if len(g) else np.empty(0, np.int64)
                    pair = np.unique(np.stack([rows[first + owner[at]], g[at].view(np.int64)], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), k, np.int32)), pa.array(pair[:, 1]),
                                                      pa.array(pair[:, 0])], names=["k", "h", "doc_row"])

    met = docs.select("row", "text").mapInArrow(grams, "k int, h long, doc_row long").join(wanted, ["k", "h"])
    pairs = met.select("doc_row", "item_row").distinct()
    both = (pairs.join(items.withColumnRenamed("row", "item_row"), "item_row")
            .join(docs.withColumnRenamed("row", "doc_row"), "doc_row").select("doc_id", "item_id", "text", "item_text"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, item_id, text, item_text in zip(*(c.to_pylist() for c in batch.columns)):
                mine = shingles(item_text, size)
                n = len(mine & _contiguous(text, len(next(iter(mine)).split(b" "))))
                if n >= threshold * len(mine) - 1e-9:
                    out.append((doc_id, item_id, n, len(mine), n / len(mine)))
            kinds = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

    return both.mapInArrow(verify, _OUT)


def clean(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents that hold no benchmark item; rows with a null id are judged too and keep their columns.

    Each row is judged by itself, also where ids repeat. While the items' text fits ``broadcast_bytes`` the verdict is
    computed beside the row and texts are not shuffled; beyond it the rows are stored once with a number, and the
    numbers of leaking rows are taken out.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("item_text") + 16), F.lit(0))).first()[0]
    if total > broadcast_bytes:
        rows = _numbered(docs.select(F.struct("*").alias("doc")), "clean-docs")
        texts = rows.select("row", F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))
        found = _joined_leaks(texts, wanted, CONTAINMENT, SHINGLE_WORDS).select(F.col("doc_id").alias("leak")).distinct()
        return rows.join(found, F.col("row") == F.col("leak"), "left_anti").select("doc.*")
    shared = spark.sparkContext.broadcast(ItemIndex([tuple(r) for r in wanted.collect()], CONTAINMENT, SHINGLE_WORDS))

    @F.arrow_udf("boolean")
    def leaking(texts: pa.Array) -> pa.Array:
        out = []
        for rows in rows_of(texts):
            hit = {d for d, *_ in shared.value.search(rows)}
            out += [i in hit for i in range(len(rows))]
        return pa.array(out, pa.bool_())

    return docs.where(~leaking.asNondeterministic()(F.col("text")))
