"""Token counts by a transducer compiled from a word-level BPE: transitions carry the tokens they settle.

A state is the shortest end of the current word on which later tokens can depend. Reading a character may settle
tokens before that end; their number is the transition's output, and the end of the word settles the rest. States and
transitions are compiled when first met, by asking the library's own BPE model about these short strings.

Texts are cut into chunks anywhere. A chunk's map from entry state to (tokens, exit state) is kept as what it says
before its first white space, the tokens of its whole words, and the exit state after its last white space, since every
entry state ends at the first white space. Maps compose, and a pairwise scan gives the tokens before each chunk.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import _odd_space, _special, byte_characters, rows_of, tokenizer

START = ("start", "")
# The tokenizer's contractions, taken whole only where a match begins with the apostrophe.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Transducer:
    """The counting transducer of one tokenizer file, filled in as texts need it.

    Compiled transitions and words are caches: when ``most`` entries are reached they start anew, which bounds memory
    and changes no count.
    """

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import models

        self.path, self.most = path, most
        spec = json.load(open(path, encoding="utf-8"))["model"]
        self.end = spec["end_of_word_suffix"] or ""
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["merges"]]
        self.inner = models.BPE(vocab=spec["vocab"], merges=merges)
        self.whole = tokenizer(path).model
        strings = [t[: -len(self.end)] + "\0" if self.end and t.endswith(self.end) else t for t in spec["vocab"]]
        self.openings = {t[:k] for t in strings for k in range(1, len(t))}
        self.bytes = byte_characters()
        self.kinds: dict[str, str] = {}
        self.settle: dict[tuple[str, str], tuple[str, int]] = {}
        self.moves: dict[tuple, tuple[tuple, int]] = {}
        self.words: dict[str, int] = {}

    # -- one character

    def kind(self, char: str) -> str:
        """letter, digit, space or other, as the library's own splitter treats the character."""
        found = self.kinds.get(char)
        if found is None:
            split = tokenizer(self.path).pre_tokenizer.pre_tokenize_str
            if not split(char):
                found = "space"
            elif len(split("a" + char)) == 1:
                found = "letter"
            else:
                found = "other" if len(split(char + char)) == 1 else "digit"
            self.kinds[char] = found
        return found

    def tokens_of(self, text: str) -> int:
        return len(self.whole.tokenize(text)) if text else 0

    def grow(self, tail: str, symbol: str) -> tuple[str, int]:
        """The tail after one more symbol, and the tokens this settles.

        A later token can begin only where the rest so far opens a vocabulary entry. Tokens that every such beginning
        has in front of it cannot change any more.
        """
        found = self.settle.get((tail, symbol))
        if found is None:
            word = tail + symbol
            live = [k for k in range(len(word)) if word[k:] in self.openings] + [len(word)]
            common: set[int] | None = None
            for k in live:
                at, cuts = 0, {0: 0}
                for count, token in enumerate(self.inner.tokenize(word[:k]) if k else [], 1):
                    at += len(token.value)
                    cuts[at] = count
                common = {c for c in cuts if c <= live[0]} if common is None else common & set(cuts)
                if k == live[-1]:
                    last = cuts
            cut = max(common)
            found = self.settle[tail, symbol] = (word[cut:], last[cut])
        return found

    def take(self, mode: str, tail: str, char: str) -> tuple[tuple, int]:
        settled = 0
        for byte in char.encode("utf-8"):
            tail, more = self.grow(tail, self.bytes[byte])
            settled += more
        return (mode, tail), settled

    def step(self, state: tuple, char: str) -> tuple[tuple, int]:
        found = self.moves.get((state, char))
        if found is None:
            if len(self.moves) >= self.most:
                self.moves.clear()
                self.settle.clear()
            found = self.moves[state, char] = self.compile(state, char)
        return found

    def compile(self, state: tuple, char: str) -> tuple[tuple, int]:
        """One transition: what a run of letters, a run of signs or a possible contraction makes of a character."""
        mode, tail = state
        kind = self.kind(char)
        if mode == "quote":
            said = tail + char
            if said in CONTRACTIONS:
                return START, self.tokens_of(said)
            if any(c.startswith(said) for c in CONTRACTIONS):
                return ("quote", said), 0
            if tail == "'" and kind == "other":
                first, a = self.take("other", "", "'")
                after, b = self.take("other", first[1], char)
                return after, a + b
            after, settled = START, self.tokens_of("'")  # the sign alone, then what followed it
            for c in said[1:]:
                after, more = self.step(after, c)
                settled += more
            return after, settled
        if mode == kind:
            return self.take(mode, tail, char)
        if mode != "start":
            after, settled = self.step(START, char)
            return after, settled + self.tokens_of(tail)
        if kind == "space":
            return START, 0
        if kind == "digit":
            return START, self.tokens_of("".join(self.bytes[b] for b in char.encode("utf-8")))
        if char == "'":
            return ("quote", "'"), 0
        return self.take(kind, "", char)

    # -- strings

    def run(self, state: tuple, text: str) -> tuple[tuple, int]:
        settled = 0
        moves = self.moves
        for char in text:
            found = moves.get((state, char)) or self.step(state, char)
            state = found[0]
            settled += found[1]
        return state, settled

    def finish(self, state: tuple) -> int:
        mode, tail = state
        if mode == "quote" and len(tail) > 1:  # the sign, and letters that did not complete a contraction
            return self.tokens_of("'") + self.tokens_of(tail[1:])
        return self.tokens_of(tail)

    def word(self, text: str) -> int:
        """Tokens of a part between white space: the map from the start state back to it."""
        found = self.words.get(text)
        if found is None:
            if len(self.words) >= self.most:
                self.words.clear()
            state, settled = self.run(START, text)
            found = self.words[text] = settled + self.finish(state)
        return found


@functools.cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


class ChunkMap:
    """A chunk as a function of the entry state; ``tokens`` is None while no white space has been met."""

    __slots__ = ("head", "tokens", "exit")

    def __init__(self, head: str, tokens: int | None, exit: tuple | None):
        self.head, self.tokens, self.exit = head, tokens, exit

    def then(self, other: ChunkMap, using: Transducer) -> ChunkMap:
        if self.tokens is None:
            return ChunkMap(self.head + other.head, other.tokens, other.exit)
        state, settled = using.run(self.exit, other.head)
        if other.tokens is None:
            return ChunkMap(self.head, self.tokens + settled, state)
        return ChunkMap(self.head, self.tokens + settled + using.finish(state) + other.tokens, other.exit)

    def total(self, using: Transducer) -> int:
        if self.tokens is None:
            return using.word(self.head)
        return using.word(self.head) + self.tokens + using.finish(self.exit)


WHITE = re.compile(r"\s")


def chunk_map(chunk: str, using: Transducer) -> ChunkMap:
    first = WHITE.search(chunk)
    if not first:
        return ChunkMap(chunk, None, None)
    words = chunk[first.start() :].split()
    last = "" if chunk[-1].isspace() else words.pop()
    count = using.word
    known = using.words
    tokens = 0
    for w in words:
        n = known.get(w)
        tokens += count(w) if n is None else n
    state, settled = using.run(START, last)
    return ChunkMap(chunk[: first.start()], tokens + settled, state)


def scan(maps: list[ChunkMap], using: Transducer) -> list[ChunkMap]:
    """All prefixes' maps by pairwise doubling: after round r each entry covers the 2^r chunks up to it."""
    reach = 1
    while reach < len(maps):
        maps = maps[:reach] + [maps[k - reach].then(maps[k], using) for k in range(reach, len(maps))]
        reach *= 2
    return maps


def normal(path: str, text: str) -> str:
    """The tokenizer's normal form. Latin-1 texts only need lower case; the library does the others."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return tokenizer(path).normalizer.normalize_str(text)
    return text.lower()


def count_tokens(path: str, text: str, chunk_chars: int) -> int:
    """Tokens of a text as the library counts them, special strings included."""
    using, total, odd = transducer(path), 0, _odd_space(path)
    special = _special(path)
    total += sum(1 for _ in special.finditer(text))
    for part in special.split(text):
        for clean in (p for p in [normal(path, part)] if p):
            if odd.search(clean):  # white space for Python alone: these signs are read one by one
                state, settled = using.run(START, clean)
                total += settled + using.finish(state)
                continue
            maps = [chunk_map(clean[k : k + chunk_chars], using) for k in range(0, len(clean), chunk_chars)]
            total += scan(maps, using)[-1].total(using)
    return total


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk_chars: int = 1 << 16) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row.

    Null and empty texts have no tokens, repeated rows give repeated results, a null id stays null, other columns are
    left behind, an empty table gives an empty one. Nothing is shuffled: a text is one cell and its chunks stay with it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [count_tokens(path, text, chunk_chars) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(numbers, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = rows_of(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
