"""Packing into sequences of equal length, balanced by estimated attention cost."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import ids_of_texts, leave_encoder, rows_of, text_bytes

#: A row of any length is a piece to place: many short ones make as much work as fewer long ones.
END_BYTES = 64
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def capacities(tokens: int, width: int) -> list[int]:
    """Lengths of the sequences that hold exactly so many tokens: full ones, then powers of two for the rest."""
    rest = tokens % width
    return [width] * (tokens // width) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: np.ndarray, width: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Pieces (document, start, length, sequence) of documents no longer than ``width``.

    A document costs ``linear`` a token and ``quadratic`` a pair of its tokens. In descending order, each goes whole to
    the cheapest sequence that still has room for it; those that fit nowhere are then cut to fill what is left, again
    the cheapest sequence first. The sequences hold exactly the tokens there are, so none is padded.
    """
    room = np.array(capacities(int(lengths.sum()), width), dtype=np.int64)
    cost = np.zeros(len(room))
    placed, left = [], []
    for doc in np.argsort(-lengths, kind="stable"):
        size = int(lengths[doc])
        at = int(np.where(room >= size, cost, np.inf).argmin())
        if room[at] < size:
            left.append(doc)
            continue
        placed.append((int(doc), 0, size, at))
        room[at] -= size
        cost[at] += linear * size + quadratic * size * size
    for doc in left:
        start, size = 0, int(lengths[doc])
        while start < size:
            at = int(np.where(room > 0, cost, np.inf).argmin())
            part = min(size - start, int(room[at]))
            placed.append((int(doc), start, part, at))
            room[at] -= part
            cost[at] += linear * part + quadratic * part * part
            start += part
    return placed


def pack(
    docs: DataFrame,
    path: str,
    width: int = 4096,
    end_id: int = 2,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    group_bytes: int = 8 << 20,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A document is its ids and ``end_id``. Its full stretches of ``width`` ids are sequences of their own at once; the
    rest joins one of the groups, about ``group_bytes`` of text each (an end id counts as ``END_BYTES``), drawn from a hash of id, content and, so that
    equal rows spread too, how many equal ones their task has read before. Groups are
    packed independently, each in one task; their number follows the data. Ids travel once, as 16-bit numbers.

    Null or empty texts are the end id alone; repeated rows are packed each for itself; ties in length go by doc_id
    (nulls first), then content; other columns are left behind; an empty table gives no pieces.
    """
    rows = rows_of(docs)
    groups = max(1, -(-text_bytes(rows, END_BYTES) // group_bytes))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "part", "length", "crc", "doc_tokens", "ids", "before"]
        kinds = [pa.int64()] * 6 + [pa.binary(), pa.int64()]
        met: Counter = Counter()
        for batch in batches:
            out: list[tuple] = []
            coded = ids_of_texts(path, batch.column("text").to_pylist())
            for doc, own in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                ids = np.append(np.frombuffer(own, dtype="<u2"), np.uint16(end_id))
                full = len(ids) - len(ids) % width
                key = hash((doc, len(ids), crc32_of(ids)))
                before, met[key] = met[key], met[key] + 1
                for at in range(0, full, width):
                    out.append((doc, at, at // width, width, crc32_of(ids[at : at + width]), len(ids), None, before))
                if full < len(ids):
                    rest = ids[full:].astype("<u2")
                    out.append((doc, full, -1, len(rest), crc32_of(rest), len(ids), rest.tobytes(), before))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    def pack_group(table: pa.Table) -> pa.Table:
        leave_encoder()
        group = table.column("group")[0].as_py()
        table = table.sort_by([("doc_id", "ascending"), ("crc", "ascending"), ("start", "ascending")])
        full = np.array([part >= 0 for part in table.column("part").to_pylist()], dtype=bool)
        out, number = [], group << 32
        for row in table.filter(pa.array(full)).select(["doc_id", "start", "length", "crc", "doc_tokens"]).to_pylist():
            out.append((*row.values(), number, 0, width))
            number += 1
        rest = table.filter(pa.array(~full))
        ids = [np.frombuffer(b, dtype="<u2") for b in rest.column("ids").to_pylist()]
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        ends = np.zeros(0, dtype=np.int64)
        if len(ids):
            ends = np.array(capacities(int(lengths.sum()), width))
        filled = np.zeros(len(ends), dtype=np.int64)
        own = rest.select(["doc_id", "start", "doc_tokens"]).to_pylist()
        for doc, start, length, at in assign(lengths, width, linear, quadratic) if len(ids) else []:
            row = own[doc]
            crc = crc32_of(ids[doc][start : start + length])
            place = (number + at, int(filled[at]), int(ends[at]))
            out.append((row["doc_id"], row["start"] + start, length, crc, row["doc_tokens"], *place))
            filled[at] += length
        columns = list(zip(*out, strict=True)) if out else [()] * 8
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    items = rows.mapInArrow(
        tokenise, "doc_id long, start long, part long, length long, crc long, doc_tokens long, ids binary, before long"
    )
    spread = F.pmod(F.xxhash64("doc_id", "start", "crc", "before"), F.lit(groups))
    return items.withColumn("group", spread).drop("before").groupBy("group").applyInArrow(pack_group, PIECE_SCHEMA)
