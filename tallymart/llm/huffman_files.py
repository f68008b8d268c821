"""Token-id files under one canonical, length-limited Huffman code of the whole corpus.

The file format, in three Parquet tables of one folder:

- ``code``: id, bits; the canonical code follows from the lengths, shorter first, then by id;
- ``blocks``: shard, block, doc_ids and counts (packed 64-bit numbers), valid (a bit a document, first bit first; 0: no
  id), payload (the code words, first bit first), checkpoints (packed 64-bit offsets in bits of every ``STRIDE``-th
  id). A block holds whole documents and can be decoded without any other;
- ``index``: shard, block, start: the ids before each block. Shards are ranges of doc_id in ascending order; rows
  under one id, or none, go by a hash of their ids, so that they fill several shards.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import fresh_path, ids_of_texts, rows_of, stored

MOST_BITS = 16
STRIDE = 256
BLOCK_IDS = 1 << 18
SHARD_BYTES = 128 << 20


# ---------------------------------------------------------------- the code


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits, by package-merge; 0 where nothing is counted."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids do not fit codes of {most} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    weights, levels = leaves, []
    for _ in range(most):
        levels.append(weights)
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        weights = np.sort(np.concatenate([leaves, packages]), kind="stable")
    # How many of a level's cheapest entries are leaves follows from the leaves' rank among its packages.
    take, depth = 2 * len(used) - 2, np.zeros(len(used), dtype=np.int64)
    for level in range(most - 1, -1, -1):
        if level:
            below = levels[level - 1]
            packages = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
            ahead = np.searchsorted(packages, leaves, side="left")  # leaves first among equals
            rank = np.arange(len(leaves)) + ahead
            singles = int((rank < take).sum())
        else:
            singles = min(take, len(leaves))
        depth[:singles] += 1
        take = 2 * (take - singles)
        if not take:
            break
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code words by length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    if len(order):
        bits = lengths[order].astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(1 << (MOST_BITS - bits))[:-1]])
        codes[order] = starts >> (MOST_BITS - bits)
    return codes


@functools.lru_cache(maxsize=4)
def _tables(lengths: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, and for each ``MOST_BITS`` bits ahead the id and the bits it takes."""
    size = np.frombuffer(lengths, dtype=np.uint8)
    codes = canonical_codes(size)
    order = np.flatnonzero(size)
    order = order[np.argsort(size[order], kind="stable")]
    spans = 1 << (MOST_BITS - size[order].astype(np.int64))
    ids, taken = np.zeros(1 << MOST_BITS, dtype=np.uint16), np.ones(1 << MOST_BITS, dtype=np.uint8)
    ids[: spans.sum()] = np.repeat(order, spans)
    taken[: spans.sum()] = np.repeat(size[order], spans)
    return codes, ids, taken


def encode(ids: np.ndarray, lengths: bytes) -> tuple[bytes, np.ndarray]:
    """The code words of ids as bytes, and the bit offset of every ``STRIDE``-th id."""
    codes, _, _ = _tables(lengths)
    bits = np.frombuffer(lengths, dtype=np.uint8)[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 32 + 2, dtype=np.uint64)
    if len(ids):
        # A code word lies in one 32-bit word or runs over into the next; the bits of different ones never meet.
        shifted = codes[ids].astype(np.uint64) << (64 - bits - (starts & 31)).astype(np.uint64)
        at = starts >> 5
        first = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
        words[at[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: -(-total // 8)], starts[::STRIDE]


def decode(payload: bytes, checkpoints: np.ndarray, count: int, lengths: bytes) -> np.ndarray:
    """Ids of a block: all stretches between checkpoints advance together, a table look-up for each id."""
    _, symbol, taken = _tables(lengths)
    data = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
    ahead = data[:-3] << 16 | data[1:-2] << 8 | data[2:-1]  # 24 bits from each byte on
    out = np.zeros((STRIDE, len(checkpoints)), dtype=np.uint16)
    at = checkpoints.astype(np.int64)
    last = len(ahead) - 1
    for row in range(min(STRIDE, count)):
        window = (ahead[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[row] = symbol[window]
        at += taken[window]
    return out.T.reshape(-1)[:count]


# ---------------------------------------------------------------- writing and reading


def encoded_rows(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id and its ids with the end id, as packed 16-bit numbers."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end_id], dtype="<u2").tobytes()
        for batch in batches:
            packed = [ids + last for ids in ids_of_texts(path, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "ids"]
            )

    return rows_of(docs).mapInArrow(tokenise, "doc_id long, ids binary")


def id_counts(rows: DataFrame) -> np.ndarray:
    """How often each 16-bit id occurs in all rows; at most 65,536 numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                total += np.bincount(np.frombuffer(ids, dtype="<u2"), minlength=1 << 16) if len(ids) > 4096 else 0
            short = b"".join(x for x in batch.column("ids").to_pylist() if len(x) <= 4096)
            total += np.bincount(np.frombuffer(short, dtype="<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["id", "n"])

    found = rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, dtype=np.int64)
    for row in found.collect():
        counts[row.id] = row.n
    return counts


def write_files(docs: DataFrame, path: str, into: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES) -> str:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order.

    Null or empty texts are the end id alone, null ids come first, repeated rows follow each other, other columns are
    left behind, and an empty table gives files without blocks.
    """
    spark = docs.sparkSession
    rows = stored(encoded_rows(docs, path, end_id), "token-ids")
    counts = id_counts(rows)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths).tolist()
    code = spark.createDataFrame([(k, int(lengths[k])) for k in used], "id int, bits int")
    code.coalesce(1).write.parquet(f"{into}/code")
    table = lengths.tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = ["shard", "block", "n_ids", "doc_ids", "valid", "counts", "payload", "checkpoints"]
        kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 5
        shard, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x for _, x in held), dtype="<u2")
            payload, marks = encode(ids, table)
            own = pa.array([d for d, _ in held], pa.int64())
            doc_ids, valid = own.fill_null(0).to_numpy(), own.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.array([len(x) // 2 for _, x in held], dtype="<i8")
            row = (shard, block, len(ids), doc_ids.astype("<i8").tobytes(), np.packbits(valid).tobytes())
            row = (*row, sizes.tobytes(), payload, marks.astype("<i8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held.append((doc, ids))
                size += len(ids) // 2
                if size >= BLOCK_IDS:
                    yield close()
                    block, held, size = block + 1, [], 0
        if held:
            yield close()

    schema = "shard int, block int, n_ids long, doc_ids binary, valid binary, counts binary, payload binary, "
    schema += "checkpoints binary"
    shards = max(1, -(-2 * int(counts.sum()) // shard_bytes), min(spark.sparkContext.defaultParallelism, len(used)))
    keyed = rows.withColumn("order", F.xxhash64("ids"))
    ordered = keyed.repartitionByRange(shards, "doc_id", "order").sortWithinPartitions("doc_id", "order")
    ordered.select("doc_id", "ids").mapInArrow(blocks, schema).write.option("compression", "uncompressed").parquet(f"{into}/blocks")

    written = spark.read.schema(schema).parquet(f"{into}/blocks").select("shard", "block", "n_ids")
    shard_sums = written.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shard_sums = shard_sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = written.withColumn("start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shard_sums, "shard")
    index.select("shard", "block", (F.col("start") + F.col("base")).alias("start")).write.parquet(f"{into}/index")
    return into


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed 16-bit numbers) of every document in a folder of such files."""
    return _read(spark, folder, with_ids=True)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit numbers) of every document."""
    return _read(spark, folder, with_ids=False)


def _read(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    lengths = np.zeros(1 << 16, dtype=np.uint8)
    for row in spark.read.parquet(f"{folder}/code").collect():  # at most one row an id
        lengths[row.id] = row.bits
    table = lengths.tobytes()
    last, kind = ("ids", pa.binary()) if with_ids else ("ids_crc32", pa.int64())

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                marks = np.frombuffer(row["checkpoints"], dtype="<i8")
                ids = decode(row["payload"], marks, row["n_ids"], table)
                sizes = np.frombuffer(row["counts"], dtype="<i8")
                ends = np.cumsum(sizes)
                parts = np.split(ids, ends[:-1])
                if with_ids:
                    values = [p.astype("<u2").tobytes() for p in parts]
                else:
                    values = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
                docs = np.frombuffer(row["doc_ids"], dtype="<i8")
                n = len(docs)
                valid = np.unpackbits(np.frombuffer(row["valid"], dtype=np.uint8), count=n).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["shard"]), pa.int32()),
                        pa.array(np.full(n, row["block"]), pa.int32()),
                        pa.array(docs, pa.int64(), mask=~valid),
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(values, kind),
                    ],
                    names=["shard", "block", "doc_id", "inside", "n_tokens", last],
                )

    blocks = spark.read.parquet(f"{folder}/blocks")
    schema = f"shard int, block int, doc_id long, inside long, n_tokens long, {last} {'binary' if with_ids else 'long'}"
    rows = blocks.mapInArrow(documents, schema)
    index = spark.read.parquet(f"{folder}/index")
    return rows.join(index, ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", last
    )


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write the documents' id files to the shared folder and give what they hold: ``read_digests``."""
    spark = docs.sparkSession
    return read_digests(spark, write_files(docs, path, fresh_path(spark, "id-files"), end_id))
