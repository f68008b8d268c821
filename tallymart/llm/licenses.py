"""License scans as an exact set-similarity join of text blocks with templates.

A block is a window of as many words as the template has. It matches when it holds at least ``threshold`` of the
template's distinct words. Words are ordered by their frequency in the whole corpus, rarest first; a matching block must
hold one of the template's first t - o + 1 words (prefix filter, o being the words it needs), must have room for o
distinct words (length filter), and must have its rarest shared word early enough for o - 1 more to follow (positional
filter). Blocks that pass are counted exactly. The templates, a fixed list, are the side that every task holds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import rows_of

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())


@dataclass(frozen=True)
class Template:
    """Words in order, the label they give, the share of distinct words a block needs, and whether order counts."""

    label: str
    phrase: str
    threshold: float = 1.0
    in_order: bool = True

    @property
    def words(self) -> tuple[bytes, ...]:
        return tuple(w.encode() for w in self.phrase.split())

    @property
    def needed(self) -> int:
        distinct = len(set(self.words))
        return max(1, math.ceil(round(self.threshold * distinct, 9)))


# The phrases and labels of the scan.
PHRASES = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)
# Openings of public license notices, in the scan's words.
NOTICES = (
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3", 0.8, False),
    Template("apache-notice", "licensed under the apache license version 2 0", 0.8, False),
    Template("cc-by-notice", "licensed under cc by 4 0", 0.8, False),
    Template("cc-by-nc-notice", "licensed under cc by nc 4 0", 0.8, False),
    Template("mit-notice", "released under the mit license", 0.8, False),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        0.8,
        False,
    ),
    Template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted",
        0.8,
        False,
    ),
)


def words_of(text: str) -> bytes:
    return text.encode("utf-8").translate(LOWER)


def word_frequencies(docs: DataFrame, templates: tuple[Template, ...]) -> dict[bytes, int]:
    """Occurrences in all texts of the templates' words; one number a template word reaches the driver."""
    wanted = {w for t in templates for w in t.words}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(filter(wanted.__contains__, WORD.findall(words_of(text))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {w: 0 for w in wanted} | {bytes(r.word): r.n for r in rows.collect()}


class Matcher:
    """The templates' side of the join: words in global order, prefixes, and the exact count."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[bytes, int]):
        self.templates = templates
        order = {w: k for k, w in enumerate(sorted(frequency, key=lambda w: (frequency[w], w)))}
        self.code = order
        self.sets = [sorted({order[w] for w in t.words}) for t in templates]
        self.prefixes = [s[: len(s) - t.needed + 1] for s, t in zip(self.sets, templates, strict=True)]
        names = {k: w for w, k in order.items()}
        first = sorted({names[k] for p in self.prefixes for k in p}, key=len, reverse=True)
        inside = rb"[0-9a-z\x80-\xff]"
        self.opener = re.compile(rb"(?<!%s)(?:%s)(?!%s)" % (inside, b"|".join(map(re.escape, first)), inside))

    def blocks(self, text: bytes) -> list[tuple[int, int, float]]:
        """(template, first word, share of the template's words) of every matching block that begins with a word of
        the template; a block that begins with another word holds no more than the one that begins later.
        """
        if not self.opener.search(text):
            return []
        words = WORD.findall(text)
        codes = np.fromiter((self.code.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        out = []
        for number, template in enumerate(self.templates):
            own, needed, width = self.sets[number], template.needed, len(template.words)
            at = np.flatnonzero(np.isin(codes, own))
            openers = at[np.isin(codes[at], self.prefixes[number])]
            if not len(openers):
                continue
            near = np.searchsorted(openers, at)  # prefix filter: an opening word within the block
            follows = openers[np.minimum(near, len(openers) - 1)]
            starts = np.flatnonzero((follows >= at) & (follows < at + width))
            ends = np.searchsorted(at, at[starts] + width)
            starts, ends = starts[ends - starts >= needed], ends[ends - starts >= needed]  # length filter
            if not len(starts):
                continue
            kind = np.searchsorted(own, codes[at])
            previous = np.full(len(at), -1)
            for k in range(len(own)):
                same = np.flatnonzero(kind == k)
                previous[same[1:]] = same[:-1]
            rarest, held = np.full(len(starts), len(own)), np.zeros(len(starts), dtype=np.int64)
            for step in range(width):
                j = np.minimum(starts + step, len(at) - 1)
                fresh = (starts + step < ends) & (previous[j] < starts)
                held += fresh
                rarest = np.where(fresh, np.minimum(rarest, kind[j]), rarest)
            possible = len(own) - rarest >= needed  # positional filter
            for k in np.flatnonzero(possible & (held >= needed)):
                first = int(at[starts[k]])
                if not template.in_order or tuple(words[first : first + width]) == template.words:
                    out.append((number, first, float(held[k] / len(own))))
        return out


WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def count_words(text: bytes) -> int:
    inside = WORD_BYTE[np.frombuffer(text, dtype=np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())


def license_blocks(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """doc_id, n_words and the matching blocks (template number, label, first word, share) of every document.

    Null and empty texts have no words and no blocks; repeated rows give repeated results; null ids stay; other columns
    are left behind; an empty table gives an empty one.
    """
    rows = rows_of(docs)
    matcher = Matcher(templates, word_frequencies(rows, templates))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("template", pa.int32()), ("label", pa.string()), ("first", pa.int64()), ("share", pa.float64())])
        )
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text").to_pylist():
                data = words_of(text)
                sizes.append(count_words(data))
                found.append(
                    [
                        {"template": n, "label": templates[n].label, "first": first, "share": share}
                        for n, first, share in matcher.blocks(data)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, kind)],
                names=["doc_id", "n_words", "blocks"],
            )

    return rows.mapInArrow(
        scan,
        "doc_id long, n_words long, blocks array<struct<template: int, label: string, first: long, share: double>>",
    )


def license_digest(docs: DataFrame) -> DataFrame:
    """One row a document: phrase places and labels from the blocks of ``license_blocks``."""
    base = F.filter("blocks", lambda b: b.template < len(PHRASES))
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda b: b.label))), ",")
    places = F.transform(base, lambda b: b.first)
    return license_blocks(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("blocks")).alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b.share)), F.lit(0.0)).alias("score"),
    )
