"""SimHash near-duplicates found through Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from homespan.llm.graph import components
from homespan.llm.text import lower_ascii, rows_of
from homespan.session import cut, fresh_path

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Buckets up to this size are compared pair by pair; larger ones go through one-bit neighbourhoods.
PAIRWISE_BUCKET = 48
#: Generator polynomial of the [23,12] binary Golay code (fixed value).
GOLAY = 0xC75


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: a bit is set if over half the shingle hashes (repeats included) have it set."""
    found = lower_ascii((text or "").encode()).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    k = min(shingle_words, len(found))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - k + 1].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())], np.uint64)
    totals = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(totals * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprint_column(shingle_words: int = SHINGLE_WORDS):
    """A column function: text to the fingerprint as a signed long."""
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return _signed([fingerprint(t, shingle_words) for rows in rows_of(texts) for t in rows])

    return fingerprints.asNondeterministic()


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome parity masks, coset leaders): leaders[s] holds the 1 or 6 error patterns of weight up to 4, else -1.

    In the extended [24,12,8] code every word is within 3 bits of one code word or at distance 4 from six, so words at
    distance 1 always share a code word within 4 bits.
    """
    checks = np.zeros(12, np.int64)
    for bit in range(12):  # code word of each unit message: message, remainder, overall parity
        word = (1 << bit) << 11
        rest = word
        for shift in range(22, 10, -1):
            if rest >> shift & 1:
                rest ^= GOLAY << (shift - 11)
        word = (word | rest) << 1
        word |= bin(word).count("1") & 1
        checks[bit] = word & 0xFFF
    def syndrome(words: np.ndarray) -> np.ndarray:
        out = words & 0xFFF
        for bit in range(12):
            out = out ^ np.where(words >> (12 + bit) & 1, checks[bit], 0)
        return out

    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(24), w)], np.int64)
    leaders = np.full((4096, 6), -1, np.int64)
    filled = np.zeros(4096, np.int64)
    weight = np.zeros(4096, np.int64)
    for s, p in zip(syndrome(patterns).tolist(), patterns.tolist()):
        w = bin(p).count("1")
        if not filled[s] or weight[s] == w:
            leaders[s, filled[s]], weight[s] = p, w
            filled[s] += 1
    return checks, leaders


_CHECKS, _LEADERS = _golay_tables()


def golay_indices(segment: np.ndarray) -> np.ndarray:
    """For 24-bit values, the indices of the 1 or 6 nearby code words, padded with -1: shape (n, 6)."""
    s = segment & 0xFFF
    for bit in range(12):
        s = s ^ np.where(segment >> (12 + bit) & 1, _CHECKS[bit], 0)
    errors = _LEADERS[s]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 12)


def golay_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs such that fingerprints at distance 2 or less share a key.

    Segments A and B have 24 bits, C has 16. Of two errors, by pigeonhole: none in C and at most one in each of A and B
    (C with both code word indices), two in A or two in B alone (the other segment and C as they are), or some in C
    and at most one in A or B (one segment as it is, the other's code word index).
    """
    u = fingerprints.view(np.uint64)
    a, b = (u >> np.uint64(40)).astype(np.int64), (u >> np.uint64(16) & np.uint64(0xFFFFFF)).astype(np.int64)
    c = (u & np.uint64(0xFFFF)).astype(np.int64)
    ga, gb = golay_indices(a), golay_indices(b)
    each = np.arange(len(u))
    rows, keys = [], []

    def add(family: int, payload: np.ndarray, valid: np.ndarray) -> None:
        at = np.nonzero(valid)
        rows.append(at[0])
        keys.append(payload[at] | family << 50)

    both = (ga[:, :, None] >= 0) & (gb[:, None, :] >= 0)
    add(1, c[:, None, None] << 24 | ga[:, :, None] << 12 | gb[:, None, :], both)
    add(2, c << 24 | b, each >= 0)
    add(3, c << 24 | a, each >= 0)
    add(4, a[:, None] << 12 | gb, gb >= 0)
    add(5, b[:, None] << 12 | ga, ga >= 0)
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, reps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for at in range(0, len(fps), 4096):
            rows, keys = golay_keys(np.ascontiguousarray(fps[at: at + 4096]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(fps[at: at + 4096][rows]), pa.array(reps[at: at + 4096][rows])],
                names=["key", "fp", "rep"])


def _emit_neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)))
    for batch in batches:
        fps, reps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for at in range(0, len(fps), 4096):
            near = (fps[at: at + 4096].view(np.uint64)[:, None] ^ flips).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.ravel()), pa.array(np.repeat(reps[at: at + 4096], 65))], names=["near", "rep"])


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between representatives whose fingerprints differ in at most two bits, enough to connect them all.

    ``nodes`` has one row per distinct fingerprint: fp, rep. Buckets of up to ``PAIRWISE_BUCKET`` members are joined and
    verified pair by pair. The members of larger buckets, of any size, meet at shared one-bit neighbours instead: two
    values share one exactly if they differ in at most two bits, and each neighbour adds a star, not all pairs.
    """
    keyed = nodes.mapInArrow(_emit_keys, "key long, fp long, rep long")
    busy = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = cut(keyed.join(busy, "key"))
    small = members.where(F.col("members") <= PAIRWISE_BUCKET).drop("members")
    other = small.select("key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    near = small.join(other, "key").where(
        (F.col("rep") > F.col("rep2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= MAX_BITS))
    pairs = near.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    crowded = members.where(F.col("members") > PAIRWISE_BUCKET).select("fp", "rep").distinct()
    met = crowded.mapInArrow(_emit_neighbourhoods, "near long, rep long")
    hubs = met.groupBy("near").agg(F.min("rep").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = met.join(hubs, "near").select(F.col("rep").alias("a"), "b")
    return pairs.unionByName(stars).where("a != b")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest id linked to it, itself included).

    Documents with equal fingerprints are one node, so copies cost nothing after the first shuffle. A null text counts
    as empty; empty texts have fingerprint zero and link like any other. Rows with a null id get the component of
    their fingerprint's smallest id (null if none). Repeated ids stay repeated rows. Other columns are not read.
    """
    path = fresh_path(docs.sparkSession, "fingerprints")
    docs.select(F.col(id_column).cast("long").alias("doc_id"),
                fingerprint_column(shingle_words)(F.col(text_column)).alias("fp")).write.parquet(path)
    marked = docs.sparkSession.read.parquet(path)
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # one id may stand for several fingerprints when ids repeat: those are one node then
    roots = components(links(nodes.where("rep is not null")))
    placed = nodes.join(roots.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
    placed = placed.select("fp", F.coalesce("root", "rep").alias("component_id"))
    return marked.join(placed, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each component the row with its smallest id stays.

    Of rows that repeat this id the one smallest by its columns stays. Rows with a null id are kept: nothing
    identifies them. Columns must be orderable.
    """
    groups = near_duplicates(docs)
    counts = cut(groups.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("_n"), F.min("component_id").alias("_first")).where("doc_id = _first"))
    kept = docs.join(counts.select(F.col("doc_id").alias("_keep_id"), "_n"), F.col("doc_id") == F.col("_keep_id"))
    out = kept.where("_n = 1").select(*docs.columns)
    if counts.where("_n > 1").take(1):
        row = F.struct(*[F.col(c) for c in sorted(docs.columns)])
        once = kept.where("_n > 1").groupBy("_keep_id").agg(F.min(row).alias("row"))
        out = out.unionByName(once.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns]))
    return out.unionByName(docs.where("doc_id is null"))
