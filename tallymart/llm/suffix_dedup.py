"""Removal of repeated 400-byte strings by a distributed merge sort of suffixes that knows common prefixes.

Every window of ``length`` bytes is represented by its minimiser: of the short strings (``GRAM`` bytes) in it, the one
with the smallest hash, the last one among equals. Equal windows have equal minimisers at equal places. Windows in a row
with the same minimiser form one entry: the suffix that begins at the minimiser, up to the end of its last window, and
the bytes before it, down to the start of its first.

An entry whose minimiser occurs once has no repeated window. One that occurs elsewhere byte by byte has nothing else.
The others, one copy of each, are sorted: each task sorts its own entries by suffix into runs, which travel front-coded
(the length shared with the entry before, and the rest), all entries of a minimiser to one task. That task merges the
runs with a loser tree that keeps, for each run, how much of its next suffix is shared with the last one put out, so
that known prefixes are never compared again. The merge leaves the shared lengths of neighbours, from which follows
which windows are equal to the right of their minimiser; the same is done to the left, and both together decide.

A minimiser with very many different entries would be one task's work; its windows are compared by 128-bit hash
instead, counted before they are shuffled.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.llm.filters import IdFilter
from tallymart.llm.shared import leave_encoder, rows_of, stored

GRAM = 96
SEGMENT = 1 << 20  # texts are hashed in segments that overlap by one window
PLACE_BITS = 21
BUSY_ENTRIES = 4096
PART_ENTRIES = 8192
SMALL_CLUSTER = 12
BASE = 0x9E3779B97F4A7C15
MIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F))


# ---------------------------------------------------------------- entries of a text


@functools.cache
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers of the base and of its inverse, modulo 2^64."""
    byte = np.random.default_rng(20_011).integers(0, 1 << 64, 256, dtype=np.uint64)
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        power, done = np.ones(size, dtype=np.uint64), 1
        while done < size:
            take = min(done, size - done)
            power[done : done + take] = power[:take] * np.uint64(pow(base, done, 1 << 64))
            done += take
        both.append(power)
    return byte, both[0], both[1]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every string of ``gram`` bytes, the same wherever the string stands."""
    byte, power, inverse = _tables(SEGMENT + 4096)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte[data] * inverse[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * power[: len(data) - gram + 1]
    h = (h ^ h >> np.uint64(32)) * MIX[0]
    return h ^ h >> np.uint64(29)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def entries(text: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(minimiser's hash, its place, first window, last window) of each entry, a segment at a time."""
    step = SEGMENT - length
    for base in range(0, max(1, len(text) - length + 1), step):
        data = np.frombuffer(text, dtype=np.uint8, count=min(len(text) - base, step + length - 1), offset=base)
        if len(data) < length:
            return
        h = gram_hashes(data, gram)
        low = np.uint64((1 << PLACE_BITS) - 1)
        order = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        place = (low - (sliding_least(order, length - gram + 1) & low)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:] - 1, len(place) - 1)
        at = place[first]
        yield h[at].view(np.int64), at + base, first + base, last + base


def _pairs_of_longs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


# ---------------------------------------------------------------- sorted runs


def shared_length(a: bytes, b: bytes, known: int = 0) -> int:
    """Bytes that two strings have in common, of which ``known`` are known."""
    most, step = min(len(a), len(b)), 64
    while known < most:
        if a[known : known + step] == b[known : known + step]:
            known = min(most, known + step)
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return known


def sorted_run(suffixes: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the suffixes, and the length each shares with the one before."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    common = [0] * len(order)
    for k in range(1, len(order)):
        common[k] = shared_length(suffixes[order[k - 1]], suffixes[order[k]])
    return order, common


class LoserTree:
    """Merge of sorted runs of (suffix, length shared with the one before in its run).

    Each run's head carries the length it shares with the last suffix put out. Of two heads the one that shares more is
    smaller; only on a tie are bytes compared, from the shared length on.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.common = [0] * len(runs)
        self.size = 1 << max(1, len(runs) - 1).bit_length()
        self.losers = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            run = node - self.size
            return run if run < len(self.runs) and self.runs[run][0] else -1
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The smaller head goes on; the other stays with what it shares with the winner."""
        if a < 0 or b < 0:
            self.losers[node] = -1
            return max(a, b)
        x, y = self.common[a], self.common[b]
        if x < y:
            a, b = b, a
        elif x == y:
            left, right = self.runs[a][0][self.at[a]], self.runs[b][0][self.at[b]]
            n = shared_length(left, right, x)
            if left[n:] > right[n:] if min(len(left), len(right)) == n else left[n] > right[n]:
                a, b = b, a
            self.common[b] = n
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, number in the run, length shared with the suffix put out before), in order."""
        while self.winner >= 0:
            run = self.winner
            yield run, self.at[run], self.common[run]
            suffixes, common = self.runs[run]
            self.at[run] += 1
            if self.at[run] < len(suffixes):
                self.common[run] = common[self.at[run]]
                going = run
            else:
                going = -1
            node = (run + self.size) // 2
            while node:
                held = self.losers[node]
                going = self._play(node, going, held) if held >= 0 else going
                node //= 2
            self.winner = going


def front_coded(suffixes: list[bytes], lefts: list[bytes], spare: list[int], keys: list[int]) -> bytes:
    """A run as bytes: shared lengths, rests, the bytes before each suffix (reversed), last window's place, key."""
    import zstandard

    order, common = sorted_run(suffixes)
    rests = [suffixes[k][n:] for k, n in zip(order, common, strict=True)]
    before = [lefts[k] for k in order]
    numbers = [common, [len(r) for r in rests], [len(b) for b in before], [spare[k] for k in order]]
    head = np.array([len(order)], dtype="<i4").tobytes() + np.array(numbers, dtype="<i4").tobytes()
    head += np.array([keys[k] for k in order], dtype="<i8").tobytes()
    return zstandard.compress(head + b"".join(rests) + b"".join(before), 1)


def restored(blob: bytes) -> tuple[list[bytes], list[int], list[bytes], list[int], np.ndarray]:
    import zstandard

    data = zstandard.decompress(blob)
    n = int(np.frombuffer(data, dtype="<i4", count=1)[0])
    common, rest, before, spare = np.frombuffer(data, dtype="<i4", count=4 * n, offset=4).reshape(4, n).tolist()
    keys = np.frombuffer(data, dtype="<i8", count=n, offset=4 + 16 * n)
    at, suffixes, last = 4 + 24 * n, [], b""
    for shared, size in zip(common, rest, strict=True):
        last = last[:shared] + data[at : at + size]
        suffixes.append(last)
        at += size
    lefts = []
    for size in before:
        lefts.append(data[at : at + size])
        at += size
    return suffixes, common, lefts, spare, keys


# ---------------------------------------------------------------- decisions


def repeated_windows(
    common: np.ndarray, lefts: list[bytes], spare: np.ndarray, length: int
) -> list[list[tuple[int, int]]]:
    """For entries in suffix order, ranges (least, most) of bytes before the suffix at which repeated windows start.

    ``common`` is the length shared with the suffix before, ``spare`` the bytes before the suffix at which the last
    window starts. A window that starts i bytes before the suffix equals another's if they share i bytes to the left and
    ``length`` - i to the right.
    """
    n = len(lefts)
    sizes = np.array([len(x) for x in lefts])
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n <= SMALL_CLUSTER:
        for a in range(n):
            right = length
            for b in range(a + 1, n):
                right = min(right, int(common[b]))
                if right + max(sizes[a], 0) < length:
                    break
                least = max(length - right, int(spare[a]), int(spare[b]))
                most = shared_length(lefts[a], lefts[b])
                if least <= most:
                    found[a].append((least, most))
                    found[b].append((least, most))
        return found
    order, left_common = sorted_run(lefts)
    back = np.empty(n, dtype=np.int64)
    back[order] = np.arange(n)
    left_common = np.array(left_common)
    hit = np.zeros((n, int(sizes.max()) + 2), dtype=bool)
    for i in range(int(spare.min()), int(sizes.max()) + 1):
        right = np.cumsum(common < length - i)
        left = np.cumsum(left_common < i)[back]
        own = np.flatnonzero((spare <= i) & (sizes >= i))
        if len(own) < 2:
            continue
        _, inverse, times = np.unique(right[own] * (n + 1) + left[own], return_inverse=True, return_counts=True)
        hit[own[times[inverse] > 1], i + 1] = True
    edges = np.diff(hit.astype(np.int8), axis=1, append=0)
    for k, i in zip(*np.nonzero(edges == 1), strict=True):
        found[k].append((int(i), 0))
    for k in range(n):
        ends = np.flatnonzero(edges[k] == -1) - 1
        found[k] = [(least, int(most)) for (least, _), most in zip(found[k], ends, strict=True)]
    return found


# ---------------------------------------------------------------- the operator


def _found(rows: DataFrame, length: int, gram: int, filters: IdFilter | None) -> DataFrame:
    """kh (minimiser), n1 and n2 (the whole entry), key, place, low, high of every entry that may repeat."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        leave_encoder()
        names = ["kh", "n1", "n2", "key", "place", "low", "high"]
        for batch in batches:
            held: list[list[np.ndarray]] = [[] for _ in names]
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = text.encode("utf-8")
                view = memoryview(data)
                for kh, place, low, high in entries(data, length, gram):
                    if filters is not None:
                        own = filters.having(kh)
                        kh, place, low, high = kh[own], place[own], low[own], high[own]
                    digests = [
                        xxhash.xxh3_128_digest(view[a : b + length], seed=p - a)
                        for a, b, p in zip(low.tolist(), high.tolist(), place.tolist(), strict=True)
                    ]
                    n1, n2 = _pairs_of_longs(digests)
                    for into, values in zip(held, (kh, n1, n2, np.full(len(kh), key), place, low, high), strict=True):
                        into.append(values)
            if held[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)) for h in held], names=names)

    return rows.mapInArrow(scan, "kh long, n1 long, n2 long, key long, place long, low long, high long")


def _minimisers(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Minimisers of the entries of all texts, with how often each occurs in a batch of rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        for batch in batches:
            held = [np.zeros(0, dtype=np.int64)]
            for text in batch.column("text").to_pylist():
                held += [kh for kh, _, _, _ in entries(text.encode("utf-8"), length, gram)]
            kh, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kh), pa.array(n.astype(np.int64))], names=["kh", "n"])

    return rows.select("text").mapInArrow(scan, "kh long, n long")


def _runs(rows: DataFrame, length: int, gram: int, wanted: IdFilter, busy: IdFilter, parts: int, hashed: bool):
    """Front-coded runs of the wanted entries by part, or the hashes of the busy entries' windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        leave_encoder()
        for batch in batches:
            held: dict[int, tuple[list, list, list, list]] = {}
            windows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = text.encode("utf-8")
                view = memoryview(data)
                for kh, place, low, high in entries(data, length, gram):
                    own = wanted.having(entry_mark(key, place))
                    own &= busy.having(kh) if hashed else ~busy.having(kh)
                    kh, place, low, high = kh[own], place[own], low[own], high[own]
                    if hashed:
                        starts = [p for a, b in zip(low.tolist(), high.tolist(), strict=True) for p in range(a, b + 1)]
                        n1, n2 = _pairs_of_longs([xxhash.xxh3_128_digest(view[p : p + length]) for p in starts])
                        windows.append((n1, n2, np.full(len(n1), key), np.array(starts, dtype=np.int64)))
                        continue
                    for part, p, a, b in zip((kh % parts).tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True):
                        run = held.setdefault(part, ([], [], [], []))
                        run[0].append(data[p : b + length])
                        run[1].append(data[a:p][::-1])
                        run[2].append(p - b)
                        run[3].append((key, p))
            if hashed:
                columns = [np.concatenate(c) for c in zip(*windows, strict=True)] if windows else []
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["n1", "n2", "key", "start"])
                continue
            if held:
                blobs = [
                    front_coded(s, before, spare, list(range(len(s)))) for s, before, spare, _ in held.values()
                ]
                names = [np.array(marks, dtype="<i8").tobytes() for _, _, _, marks in held.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.int64()), pa.array(blobs, pa.binary()), pa.array(names, pa.binary())],
                    names=["part", "run", "marks"],
                )

    schema = "n1 long, n2 long, key long, start long" if hashed else "part long, run binary, marks binary"
    return rows.mapInArrow(scan, schema)


def entry_mark(key: int, place: np.ndarray) -> np.ndarray:
    """One hash for a text's key and a place in it; ``entry_mark_column`` gives the same in SQL terms."""
    h = (place.astype(np.uint64) + np.uint64(1)) * MIX[0] ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    h = h * MIX[1]
    return (h ^ h >> np.uint64(29)).view(np.int64)


def _merge_part(length: int, gram: int):
    def merge(table: pa.Table) -> pa.Table:
        runs, lefts, spares, marks = [], [], [], []
        for blob, own in zip(table.column("run").to_pylist(), table.column("marks").to_pylist(), strict=True):
            suffixes, common, before, spare, numbers = restored(blob)
            runs.append((suffixes, common))
            lefts.append(before)
            spares.append(spare)
            marks.append(np.frombuffer(own, dtype="<i8").reshape(-1, 2)[numbers])
        out: list[tuple[int, int, int]] = []

        def close(cluster: list[tuple[int, int]], common: list[int]) -> None:
            if len(cluster) < 2:
                return
            before = [lefts[r][k] for r, k in cluster]
            spare = np.array([spares[r][k] for r, k in cluster])
            ranges = repeated_windows(np.array(common), before, spare, length)
            for (r, k), own in zip(cluster, ranges, strict=True):
                key, place = marks[r][k]
                out.extend((int(key), int(place) - most, int(place) - least + length) for least, most in own)

        cluster: list[tuple[int, int]] = []
        common: list[int] = []
        for run, number, shared in LoserTree(runs):
            if shared < gram:
                close(cluster, common)
                cluster, common = [], []
            cluster.append((run, number))
            common.append(shared)
        close(cluster, common)
        columns = list(zip(*sorted(set(out)), strict=True)) if out else [()] * 3
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("key", "first", "last"), columns, strict=True)})

    return merge


def repeated_spans(
    docs: DataFrame, length: int = 400, gram: int = GRAM, busy_entries: int = BUSY_ENTRIES, more: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The rows with a key, and (key, first, last): byte spans, maybe overlapping, that hold all repeated strings."""
    if not 0 < gram < length <= 4096:
        raise ValueError(f"0 < gram < length <= 4096 must hold, not gram {gram}, length {length}")
    rows = rows_of(docs, *more).withColumn("key", F.xxhash64("doc_id", "text"))
    long = rows.select("key", "text").where(F.octet_length("text") >= length)
    counted = _minimisers(long, length, gram).groupBy("kh").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = IdFilter(stored(counted.select("kh"), "minimisers"), "kh")
    found = stored(_found(long, length, gram, repeated), "entries")
    whole = found.groupBy("kh", "n1", "n2").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")
    )
    whole = stored(whole.select("kh", "n1", "n2", "n", "one.key", "one.place"), "distinct-entries")
    twice = whole.where("n > 1").select("n1", "n2")
    spans = found.join(twice, ["n1", "n2"], "left_semi").select(
        "key", F.col("low").alias("first"), (F.col("high") + length).alias("last")
    )
    several = stored(whole.groupBy("kh").agg(F.count("*").alias("m")).where("m > 1"), "contested")
    contested = whole.join(several, "kh", "left_semi").select("key", "place")
    wanted = IdFilter(_marked(contested), "h")
    busy = IdFilter(several.where(F.col("m") > busy_entries), "kh")
    parts = max(1, -(-(several.agg(F.sum("m")).first()[0] or 0) // PART_ENTRIES))
    runs = _runs(long, length, gram, wanted, busy, parts, hashed=False)
    spans = spans.unionByName(
        runs.groupBy("part").applyInArrow(_merge_part(length, gram), "key long, first long, last long")
    )
    windows = _runs(long, length, gram, wanted, busy, parts, hashed=True)
    windows = stored(windows, "busy-windows")
    again = windows.groupBy("n1", "n2").agg(F.count("*").alias("n")).where("n > 1").select("n1", "n2")
    hashed = windows.join(again, ["n1", "n2"], "left_semi")
    spans = spans.unionByName(hashed.select("key", F.col("start").alias("first"), (F.col("start") + length).alias("last")))
    # Rows that are equal share a key and give the same spans, once each.
    return rows, stored(spans.distinct(), "spans")


def _marked(entries_of: DataFrame) -> DataFrame:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, place = batch.column("key").to_numpy(), batch.column("place").to_numpy()
            h = (place.astype(np.uint64) + np.uint64(1)) * MIX[0] ^ key.view(np.uint64)
            h = h * MIX[1]
            yield pa.RecordBatch.from_arrays([pa.array((h ^ h >> np.uint64(29)).view(np.int64))], names=["h"])

    return entries_of.mapInArrow(mark, "h long")


def union_of(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans that do not touch, in order, from packed (first << 32 | last) ones."""
    spans = np.sort(spans)
    first, last = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    opens = np.flatnonzero(np.append(True, first[1:] > last[:-1]))
    return np.stack([first[opens], last[np.append(opens[1:] - 1, len(last) - 1)]], axis=1)


def _applied(rows: DataFrame, schema: str, result) -> DataFrame:
    """``result`` of the bytes and the disjoint spans of every row; only rows with spans meet them in a shuffle."""

    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    others = [n for n in rows.columns if n not in ("key", "text", "spans")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        for batch in batches:
            held = batch.column("spans") if "spans" in batch.schema.names else [None] * batch.num_rows
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), held, strict=True):
                spans = None if spans is None else spans.values
                found = union_of(spans.to_numpy()) if spans is not None and len(spans) else np.zeros((0, 2), np.int64)
                out.append(result(text.encode("utf-8"), found))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(o) for o in others] + [pa.array(c, k) for c, k in zip(columns, types, strict=True)],
                names=others + names,
            )

    own = StructType([f for f in rows.schema if f.name in others])
    for name, kind in (c.split() for c in schema.split(", ")):
        own = own.add(name, kind)
    return rows.mapInArrow(apply, own)


def kept_bytes(data: bytes, spans: np.ndarray) -> bytes:
    ends = [0, *spans[:, 1].tolist()]
    return b"".join(data[a:b] for a, b in zip(ends, [*spans[:, 0].tolist(), len(data)], strict=True))


def _with_spans(docs: DataFrame, length: int, gram: int, busy_entries: int, schema: str, result) -> DataFrame:
    rows, spans = repeated_spans(docs, length, gram, busy_entries)
    return _joined(rows, spans, schema, result)


def _joined(rows: DataFrame, spans: DataFrame, schema: str, result) -> DataFrame:
    packed = spans.select("key", (F.shiftleft("first", 32) + F.col("last")).alias("span"))
    lists = packed.groupBy("key").agg(F.collect_list("span").alias("spans"))
    touched = IdFilter(spans.select("key").distinct(), "key")
    some = touched.passing(rows, "key").join(lists, "key", "left")
    return _applied(some, schema, result).unionByName(
        _applied(touched.passing(rows, "key", member=False), schema, result)
    )


def removal_digests(
    docs: DataFrame, length: int = 400, gram: int = GRAM, busy_entries: int = BUSY_ENTRIES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left, without cut characters) of every row: see
    ``without_repeats``."""

    def digest(data: bytes, spans: np.ndarray):
        left = kept_bytes(data, spans)
        more = hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")
        return len(data), len(data) - len(left), len(spans), *more

    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    return _with_spans(docs, length, gram, busy_entries, schema, digest)


def without_repeats(
    docs: DataFrame, length: int = 400, gram: int = GRAM, busy_entries: int = BUSY_ENTRIES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept (bytes): texts without the bytes of any repeated string.

    A byte goes when a string of ``length`` bytes that covers it also starts elsewhere, in this text or another; all
    copies go, judged on the input. Null texts count as empty; texts shorter than ``length`` stay whole; repeated rows
    are copies of each other; null ids stay; other columns are left behind; an empty table gives an empty one. What is
    left need not be UTF-8: a removed string can begin within a character.
    """

    def keep(data: bytes, spans: np.ndarray):
        left = kept_bytes(data, spans)
        return len(data), len(data) - len(left), left

    return _with_spans(docs, length, gram, busy_entries, "n_bytes long, n_removed long, kept binary", keep)


def texts_without_repeats(
    docs: DataFrame, length: int = 400, gram: int = GRAM, busy_entries: int = BUSY_ENTRIES
) -> DataFrame:
    """The table with its texts so cut, as text: bytes left of a cut character go too; n_chars, if there, follows.

    All rows stay, a text that is all repeats as an empty one, and so do all columns, whatever their names.
    """
    names = docs.columns
    others = [c for c in names if c not in ("doc_id", "text", "n_chars")]
    plain = docs.select("doc_id", "text", *([F.struct(*(F.col(f"`{c}`") for c in others)).alias("more")] if others else []))
    rows, spans = repeated_spans(plain, length, gram, busy_entries, ("more",) if others else ())
    cut = _joined(rows, spans, "kept string", lambda data, found: (kept_bytes(data, found).decode(errors="ignore"),))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept").alias("text")}
    columns["n_chars"] = F.length("kept").cast("long").alias("n_chars")
    return cut.select(*(columns[c] if c in columns else F.col(f"more.`{c}`").alias(c) for c in names))
