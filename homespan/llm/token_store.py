"""Token ids in directly addressable codes: chunk levels, continuation bitmaps and rank directories."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from homespan.llm.text import rows_of
from homespan.llm.trie_bpe import UnitCache

#: Bits of an id stored at each level; an id goes on to the next level while it has bits left.
WIDTHS = (8, 8, 16)
#: Bits of a continuation bitmap between two entries of its rank directory.
RANK_BITS = 512
#: A shard is closed once it has this many ids; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 20
#: Distinct units a worker remembers in each table, at most.
MAX_UNITS = 1_000_000
MAGIC = b"DAC1"
_KINDS = {8: np.dtype("u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def pack(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """MAGIC, number of levels, then per level: width, number of chunks, chunks, bitmap, rank directory.

    A bitmap's bit (least significant first) tells that the id goes on at the next level, at the position given by the
    number of set bits before. The directory holds that number at every ``RANK_BITS`` bits. The last level has neither.
    """
    rest = np.asarray(ids, np.uint64)
    out = [MAGIC, struct.pack("<B", len(widths))]
    for level, width in enumerate(widths):
        out += [struct.pack("<BQ", width, len(rest)), (rest & np.uint64((1 << width) - 1)).astype(_KINDS[width]).tobytes()]
        rest = rest >> np.uint64(width)
        goes_on = rest > 0
        if level == len(widths) - 1:
            if goes_on.any():
                raise ValueError("an id has more bits than the levels hold")
            break
        blocks = -(-len(rest) // RANK_BITS)
        bits = np.zeros(blocks * RANK_BITS, bool)
        bits[: len(rest)] = goes_on
        ones = bits.reshape(blocks, RANK_BITS).sum(axis=1) if blocks else np.empty(0, np.int64)
        before = np.concatenate(([0], np.cumsum(ones)))[:blocks].astype("<u4")
        out += [np.packbits(bits, bitorder="little").tobytes(), before.tobytes()]
        rest = rest[goes_on]
    return b"".join(out)


class Codes:
    """Access to packed ids; ``codes[i]`` touches one chunk and at most one bitmap block per level."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token store")
        self.levels, at = [], 5
        for level in range(raw[4]):
            width, n = struct.unpack_from("<BQ", raw, at)
            at += 9
            chunks = np.frombuffer(raw, _KINDS[width], n, at)
            at += n * width // 8
            bitmap = before = None
            if level < raw[4] - 1:
                blocks = -(-n // RANK_BITS)
                bitmap = np.frombuffer(raw, np.uint8, blocks * RANK_BITS // 8, at)
                at += len(bitmap)
                before = np.frombuffer(raw, "<u4", blocks, at)
                at += 4 * blocks
            self.levels.append((width, chunks, bitmap, before))

    def __len__(self) -> int:
        return len(self.levels[0][1])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for width, chunks, bitmap, before in self.levels:
            value |= int(chunks[i]) << shift
            shift += width
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            whole = bitmap[block * RANK_BITS // 8: i >> 3]
            i = int(before[block]) + int(_ONES[whole].sum()) + int(_ONES[bitmap[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        value = np.empty(0, np.uint32)
        for width, chunks, bitmap, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if bitmap is not None:
                goes_on = np.unpackbits(bitmap, bitorder="little", count=len(here)).view(bool)
                here[goes_on] |= value << np.uint32(width)
            value = here
        return value


_tokenizers: dict[str, UnitCache] = {}


def _tokenizer(path: str) -> UnitCache:
    """The worker's cache of library encodings: the library encodes each distinct unit that comes up."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()

        def alone(units: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch_fast(units, add_special_tokens=False)]

        newline = alone(["\n"])[0]
        end_of_line = np.frombuffer(newline, "<u4")[0]

        def by_line(unit: str) -> bool:
            """Whether the unit keeps its pieces on a line of its own."""
            word = unit[1:] if unit[0] == " " else unit
            return "\n" not in unit and "<|" not in unit and word and not word[0].isspace() and not word[-1].isspace()

        def encode_units(units: list[str]) -> list[bytes]:
            """Many units are encoded as the lines of one text, which saves the library's cost per call."""
            lines, known = [u for u in units if by_line(u)], {}
            for at in range(0, len(lines), 512):
                part = lines[at: at + 512]
                ids = np.array(library.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, "<u4")
                ends = np.append(np.flatnonzero(ids == end_of_line), len(ids))
                starts = np.append(0, ends[:-1] + 1)
                raw = ids.tobytes()
                known.update(zip(part, [raw[4 * a: 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                                 if len(ends) == len(part) else alone(part)))
            rest = [u for u in units if u not in known]
            known.update(zip(rest, alone(rest)))
            return [known[u] for u in units]

        _tokenizers[path] = UnitCache(encode_units, newline, MAX_UNITS)
    return _tokenizers[path]


_SHARD = "part int, seq int, n_tokens long, doc_ids binary, ends binary, codes binary"


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode texts, end each with ``end_id`` and write shards in ascending order of doc_id.

    A shard is one Parquet row: the documents' ids (null as the lowest long, first), where each ends, and the packed codes,
    stored uncompressed so that an id is reached without decoding a block. Texts are range-partitioned by doc_id, so shards of a
    partition follow those of the one before. Rows with the same doc_id stand in order of their text; a null text is empty.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, codes, total = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            ends = np.cumsum([len(c) // 4 for c in codes]).astype("<i8")
            row = [part, seq, int(ends[-1]), np.array(ids, "<i8").tobytes(), ends.tobytes(),
                   pack(np.frombuffer(b"".join(codes), "<u4"))]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["part", "seq", "n_tokens", "doc_ids", "ends", "codes"])

        for batch in batches:
            start = 0
            for texts in rows_of(batch.column(1), 2048):
                doc_ids = batch.column(0).slice(start, len(texts)).to_pylist()
                start += len(texts)
                for doc_id, code in zip(doc_ids, _tokenizer(tokenizer).encode([t or "" for t in texts])):
                    code += end
                    if codes and total + len(code) // 4 > shard_tokens:
                        yield close()
                        seq, ids, codes, total = seq + 1, [], [], 0
                    ids.append(-1 << 63 if doc_id is None else doc_id)
                    codes.append(code)
                    total += len(code) // 4
        if codes:
            yield close()

    ordered.mapInArrow(shards, _SHARD).write.option("compression", "none").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, shard_start): ids of all shards before. Only partition totals, one a partition, reach the driver."""
    shards = spark.read.parquet(path).select("part", "seq", "n_tokens")
    starts, total = [], 0
    for row in sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        starts.append((row.part, total))
        total += row.n
    firsts = spark.createDataFrame(starts, "part int, first long")
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return shards.withColumn("before", before).join(firsts, "part").select(
        "part", "seq", (F.col("first") + F.col("before")).alias("shard_start"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, doc_ids, ends, codes in zip(*(c.to_pylist() for c in batch.columns)):
                ids, ends = Codes(codes).all(), np.frombuffer(ends, "<i8")
                starts = np.concatenate(([0], ends[:-1]))
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                doc_ids = np.frombuffer(doc_ids, "<i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ends), part, np.int32)), pa.array(np.full(len(ends), seq, np.int32)),
                    pa.array(doc_ids, mask=doc_ids == -1 << 63), pa.array(starts), pa.array(ends - starts),
                    pa.array(sums, pa.int64())], names=["part", "seq", "doc_id", "own_start", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(path).select("part", "seq", "doc_ids", "ends", "codes").mapInArrow(
        documents, "part int, seq int, doc_id long, own_start long, n_tokens long, ids_crc32 long")
    return rows.join(shard_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> dict[int, int]:
    """Ids at a request's global positions; only the shards that hold them are read, only their chunks touched."""
    wanted = spark.createDataFrame([(int(p),) for p in positions], "position long")
    shards = spark.read.parquet(path)
    starts = shard_starts(spark, path).join(shards.select("part", "seq", "n_tokens"), ["part", "seq"])
    held = starts.join(F.broadcast(wanted), (F.col("position") >= F.col("shard_start"))
                       & (F.col("position") < F.col("shard_start") + F.col("n_tokens")))

    @F.arrow_udf("long")
    def get(codes: pa.Array, at: pa.Array) -> pa.Array:
        return pa.array([Codes(c)[i] for c, i in zip(codes.to_pylist(), at.to_pylist())], pa.int64())

    found = shards.select("part", "seq", "codes").join(F.broadcast(held), ["part", "seq"]).select(
        "position", get("codes", F.col("position") - F.col("shard_start")).alias("id"))
    return {r.position: r.id for r in found.collect()}
