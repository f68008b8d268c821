"""Byte-level BPE through a table of distinct words: each word is encoded once, its ids join back by position.

Texts are gathered into blocks. A block's payload is the sequence of its words as numbers in its own list of distinct
words; the lists, not the texts, are shuffled by a hash of the word, encoded once for each word, and sent back. Both
sides cut blocks alike, since they read the same rows in the same order; each block carries a check of its words, and
a block whose two sides differ is an error, never a wrong result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import _special, byte_characters, rows_of, text_bytes, tokenizer

BLOCK_BYTES = 32 << 20
BUCKET_BYTES = 8 << 20  # of text, for each bucket of words
SEAL = (1 << 61) - 1
# A part is white space but its last sign, a single white-space sign, or a word with the space before it. The
# tokenizer's own pattern never matches across two such parts.
PART = r" ?\S+|\s+(?!\S)|\s"


@functools.cache
def _cutter(path: str):
    """Cuts a text into parts; special strings, which the tokenizer takes out first, are parts of their own."""
    import regex

    special = _special(path).pattern
    inside = regex.compile(PART)
    outside = regex.compile(special)

    def cut(text: str) -> list[str]:
        if not outside.search(text):
            return inside.findall(text)
        parts, at = [], 0
        for found in outside.finditer(text):
            parts += inside.findall(text[at : found.start()]) + [found.group()]
            at = found.end()
        return parts + inside.findall(text[at:])

    return cut


@functools.cache
def piece_bytes(path: str) -> pa.Array:
    """Bytes of every id, in order of id: the table that ids are joined with to decode them."""
    own = tokenizer(path)
    spec = json.load(open(path, encoding="utf-8"))
    value = {c: b for b, c in enumerate(byte_characters())}
    added = {t["content"] for t in spec["added_tokens"]}
    vocab = own.get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocab.values()) + 1)
    for token, k in vocab.items():
        found[k] = token.encode() if token in added else bytes(value[c] for c in token)
    return pa.array(found, pa.large_binary())


def _concatenated(parts: pa.Array) -> bytes:
    _, offsets, data = parts.buffers()
    if not len(parts) or data is None:
        return b""
    return data[: np.frombuffer(offsets, dtype="<i8")[len(parts)]].to_pybytes()


def _blocks(path: str, batches: Iterator[pa.RecordBatch], block_bytes: int):
    """(block, doc_ids, words a document, their numbers, distinct words) for each block of a task's rows."""
    from pyspark import TaskContext

    cut, task = _cutter(path), TaskContext.get().partitionId()
    number: dict[str, int] = {}
    docs, sizes, runs, size, block = [], [], [], 0, 0

    def close():
        at = np.concatenate(runs) if runs else np.zeros(0, dtype=np.uint32)
        return (task << 32 | block), docs, np.array(sizes, dtype="<i8"), at, list(number)

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            parts = cut(text)
            run = np.fromiter((number.setdefault(p, len(number)) for p in parts), dtype=np.uint32, count=len(parts))
            docs.append(doc)
            sizes.append(len(parts))
            runs.append(run)
            size += len(text)
            if size >= block_bytes:
                yield close()
                number, docs, sizes, runs, size, block = {}, [], [], [], 0, block + 1
    if docs:
        yield close()


def _marks(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.int64, count=len(words))


def _seal(numbers: np.ndarray, marks: np.ndarray) -> int:
    """One number for words and their places, the sum over any parts of a list; it differs where two lists do, but for
    one chance in billions."""
    return sum(((marks + 1) * (2 * numbers.astype(np.int64) + 1) % SEAL).tolist()) % SEAL


def _compress(*parts: bytes) -> bytes:
    import zstandard

    return zstandard.compress(np.array([len(p) for p in parts], dtype="<i8").tobytes() + b"".join(parts), 3)


def _decompress(packed: bytes, n: int) -> list[bytes]:
    import zstandard

    data = zstandard.decompress(packed)
    ends = np.cumsum([8 * n, *np.frombuffer(data, dtype="<i8", count=n).tolist()]).tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _pack_words(numbers: np.ndarray, words: list[str]) -> bytes:
    coded = [w.encode() for w in words]
    sizes = np.array([len(w) for w in coded], dtype="<u4")
    return _compress(np.diff(numbers, prepend=0).astype("<u4").tobytes(), sizes.tobytes(), b"".join(coded))


def _unpack_words(packed: bytes) -> tuple[np.ndarray, list[str]]:
    steps, sizes, data = _decompress(packed, 3)
    ends = np.cumsum(np.frombuffer(sizes, dtype="<u4").astype(np.int64)).tolist()
    words = [data[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
    return np.cumsum(np.frombuffer(steps, dtype="<u4").astype(np.int64)), words


def _pack_codes(numbers: np.ndarray, codes: list[bytes]) -> bytes:
    sizes = np.array([len(c) // 2 for c in codes], dtype="<u4")
    return _compress(np.diff(numbers, prepend=0).astype("<u4").tobytes(), sizes.tobytes(), b"".join(codes))


def _unpack_codes(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, sizes, data = _decompress(packed, 3)
    numbers = np.cumsum(np.frombuffer(steps, dtype="<u4").astype(np.int64))
    return numbers, np.frombuffer(sizes, dtype="<u4").astype(np.int64), np.frombuffer(data, dtype="<u2")


def encode_and_decode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids (packed 32-bit numbers) and decoded text (UTF-8 bytes) of every document.

    Null and empty texts have no ids and decode to nothing; repeated rows are encoded each; null ids stay; other
    columns are left behind; an empty table gives an empty one. A word that every block holds is sent once a block.
    """
    return _joined(docs, path, block_bytes, "doc_id long, ids binary, decoded binary", lambda ids, text: (ids, text))


def encode_digests(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encode_and_decode``, without moving ids and texts on."""

    def digest(ids: bytes, text: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _joined(docs, path, block_bytes, schema, digest)


def _joined(docs: DataFrame, path: str, block_bytes: int, schema: str, result) -> DataFrame:
    rows = rows_of(docs)

    buckets = max(1, -(-text_bytes(rows) // BUCKET_BYTES))

    def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words in _blocks(path, batches, block_bytes):
            marks = _marks(words)
            home = marks % buckets
            order = np.argsort(home, kind="stable")
            homes, first = np.unique(home[order], return_index=True)
            packed = [_pack_words(part, [words[k] for k in part]) for part in np.split(order, first[1:]) if len(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(homes), pa.array(np.full(len(homes), block), pa.int64()), pa.array(packed, pa.binary())],
                names=["bucket", "block", "words"],
            )

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for block, own, sizes, at, words in _blocks(path, batches, block_bytes):
            # Low and high halves apart: they compress better, and words met early, the frequent ones, need the low one.
            halves = (at & 0xFFFF).astype("<u2").tobytes() + (at >> 16).astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([own], pa.list_(pa.int64())),
                    pa.array([sizes.tobytes()], pa.binary()),
                    pa.array([zstandard.compress(halves, 3)], pa.binary()),
                    pa.array([len(words)], pa.int32()),
                    pa.array([_seal(np.arange(len(words)), _marks(words))], pa.int64()),
                ],
                names=["block", "doc_ids", "sizes", "payload", "n_words", "seal"],
            )

    def encode_bucket(table: pa.Table) -> pa.Table:
        """All blocks' words that fall to one bucket: each distinct one is encoded once."""
        lists = [_unpack_words(x) for x in table.column("words").to_pylist()]
        distinct = list(dict.fromkeys(w for _, words in lists for w in words))
        own = tokenizer(path)
        ids: dict[str, bytes] = {}
        for at in range(0, len(distinct), 1 << 14):
            part = distinct[at : at + (1 << 14)]
            codes = own.encode_batch_fast(part, add_special_tokens=False)
            ids.update((w, np.array(c.ids, dtype="<u2").tobytes()) for w, c in zip(part, codes, strict=True))
        packed = [_pack_codes(numbers, [ids[w] for w in words]) for numbers, words in lists]
        seals = [_seal(numbers, _marks(words)) for numbers, words in lists]
        return pa.table({"block": table.column("block"), "codes": packed, "seal": pa.array(seals, pa.int64())})

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        names = [c.split()[0] for c in schema.split(", ")]
        out: list[tuple] = []
        if left.num_rows != 1:
            raise ValueError(f"a block has {left.num_rows} payloads: its two sides were not cut alike")
        row = left.to_pylist()[0]
        if sum(right.column("seal").to_pylist()) % SEAL != row["seal"]:
            raise ValueError(f"block {row['block']}: other words came back than were sent")
        many = np.zeros(row["n_words"], dtype=np.int64)
        first = np.zeros(row["n_words"], dtype=np.int64)
        flats, total = [np.zeros(0, dtype="<u2")], 0
        for packed in right.column("codes").to_pylist():
            numbers, sizes, ids = _unpack_codes(packed)
            many[numbers] = sizes
            first[numbers] = np.cumsum(sizes) - sizes + total
            flats.append(ids)
            total += len(ids)
        flat = np.concatenate(flats)
        halves = np.frombuffer(zstandard.decompress(row["payload"]), dtype="<u2")
        at = halves[: len(halves) // 2].astype(np.int64) | halves[len(halves) // 2 :].astype(np.int64) << 16
        table = piece_bytes(path)
        done = 0
        for doc, size in zip(row["doc_ids"], np.frombuffer(row["sizes"], dtype="<i8").tolist(), strict=True):
            words = at[done : done + size]
            done += size
            n = many[words]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ids = flat[np.repeat(first[words], n) + within]
            text = _concatenated(table.take(pa.array(ids)))
            text = text.decode("utf-8", errors="replace").encode()
            out.append((doc, *result(ids.astype("<u4").tobytes(), text)))
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in schema.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, types, strict=True)})

    words = rows.mapInArrow(word_lists, "bucket long, block long, words binary")
    codes = words.groupBy("bucket").applyInArrow(encode_bucket, "block long, codes binary, seal long")
    texts = rows.mapInArrow(
        payloads, "block long, doc_ids array<long>, sizes binary, payload binary, n_words int, seal long"
    )
    return texts.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(join_back, schema)
