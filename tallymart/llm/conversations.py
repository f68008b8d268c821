"""Conversation repair: the cheapest edits that give a legal order of roles, found on a grammar of all conversations.

Each row of a conversation is a symbol: the class of its role and its first fault. Reading a symbol, with any insertions
before it, moves between four states of the wanted order: nothing yet, after a system row, after a user row, after an
assistant row. A symbol is therefore a 4 x 4 matrix of least costs, and the symbols of a conversation multiply in min-plus
algebra.

Re-Pair replaces the most frequent pair of neighbouring symbols of all conversations by a new symbol, again and again. Each
of these rules has one matrix, the product of its pair's, made once from the bottom up and used wherever the rule occurs.
A rule's audit is a rope: for each entry the state between its two halves, so the edits of any length are written out
only for the entry that is wanted.

Equal costs are decided by the audits' order without writing them out. Two audits of the same symbols from the same state
hold the same number of row edits and end in one, so neither begins the other; an entry's rank among those of its row
tells them apart, and the ranks of a product follow from those of its factors.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import TwoGenerations, batch_whole_texts, leave_encoder, ship_package, stored

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
CLASSES, FAULTS = "suax", ("sound", "truncated", "blank", "duplicate")
#: The symbol of each class and fault: a letter each.
SYMBOLS = {(c, f): chr(ord("A") + 4 * CLASSES.index(c) + FAULTS.index(f)) for c in CLASSES for f in FAULTS}
#: The rules of the grammar; more of them save work and change nothing else.
MOST_RULES = 128
FIRST_RULE = 0x100
#: Symbols of one cell of the stored sequences; a longer conversation has several.
SEGMENT = 1 << 16
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
NONE = 1 << 60

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: States reached by a role's class.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Fewest insertions from a state to another.
INSERTIONS = {
    START: {START: 0, USER: 1, ASSISTANT: 2},
    SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2},
    USER: {USER: 0, ASSISTANT: 1},
    ASSISTANT: {ASSISTANT: 0, USER: 1},
}
#: Insertions that end a conversation legally.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = ("su", "ua", "au")


# ---------------------------------------------------------------- matrices and rules


@dataclass(frozen=True)
class Transfer:
    """What some symbols in a row do: least cost from state to state, and each entry's rank among its row's audits.

    ``middle`` holds, for a product, the state between its halves; ``audits`` the edits of a single symbol.
    """

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]
    illegal: int
    first: str
    last: str
    middle: tuple[tuple[int, ...], ...] | None = None
    audits: tuple[tuple[str, ...], ...] | None = None


def single(role: str, fault: str) -> Transfer:
    """The matrix of one row: insertions ahead of it, and the edit that it gets itself."""
    late = TRUNCATED if fault == "truncated" else 0
    costs, audits = [], []
    for start in STATES:
        best = {}
        for here, added in INSERTIONS[start].items():
            moves = [("D", DELETE, here)]
            if fault in ("sound", "truncated"):
                moves += [("K", late, STEPS[role][here])] if here in STEPS.get(role, {}) else []
                moves += [("R", REROLE + late, STEPS[to][here]) for to in "ua" if here in STEPS[to]]
            for edit, price, there in moves:
                found = (INSERT * added + price, "I" * added + edit)
                best[there] = min(best.get(there, found), found)
        costs.append(tuple(best[q][0] if q in best else NONE for q in STATES))
        audits.append(tuple(best[q][1] if q in best else "~" for q in STATES))
    rank = tuple(tuple(sorted(STATES, key=row.__getitem__).index(q) for q in STATES) for row in audits)
    return Transfer(tuple(costs), rank, 0, role, role, audits=tuple(audits))


def product(a: Transfer, b: Transfer) -> Transfer:
    costs, ranks, middles = [], [], []
    for p in STATES:
        cost, middle = [], []
        for q in STATES:
            at = min(STATES, key=lambda r: (min(NONE, a.cost[p][r] + b.cost[r][q]), a.rank[p][r]))
            cost.append(min(NONE, a.cost[p][at] + b.cost[at][q]))
            middle.append(at)
        order = sorted(STATES, key=lambda q: (cost[q] >= NONE, a.rank[p][middle[q]], b.rank[middle[q]][q]))
        costs.append(tuple(cost))
        ranks.append(tuple(order.index(q) for q in STATES))
        middles.append(tuple(middle))
    illegal = a.illegal + b.illegal + (a.last + b.first not in LEGAL)
    return Transfer(tuple(costs), tuple(ranks), illegal, a.first, b.last, middle=tuple(middles))


class Grammar:
    """The rules in order, each the pair of earlier symbols that it stands for, with one matrix a symbol."""

    def __init__(self, rules: tuple[str, ...]):
        self.rules = rules
        self.transfers = {symbol: single(*key) for key, symbol in SYMBOLS.items()}
        for number, pair in enumerate(rules):
            self.transfers[chr(FIRST_RULE + number)] = product(*(self.transfers[c] for c in pair))
        self._ropes: dict[tuple[str, int, int], str] = {}

    def compressed(self, symbols: str) -> str:
        for number, pair in enumerate(self.rules):
            if len(symbols) < 2:
                break
            symbols = symbols.replace(pair, chr(FIRST_RULE + number))
        return symbols

    def audit(self, symbol: str, p: int, q: int) -> str:
        """The edits of a symbol between two states; those of a rule are joined from its halves' once."""
        key = (symbol, p, q)
        if key not in self._ropes:
            own = self.transfers[symbol]
            if own.audits is not None:
                self._ropes[key] = own.audits[p][q]
            else:
                left, right = self.rules[ord(symbol) - FIRST_RULE]
                at = own.middle[p][q]
                self._ropes[key] = self.audit(left, p, at) + self.audit(right, at, q)
        return self._ropes[key]

    def solved(self, symbols: str) -> tuple[int, str, int]:
        """Least cost, its ASCII-least audit, and the illegal neighbours of a conversation's symbols."""
        if not symbols:
            return 0, "", 0
        short = self.compressed(symbols)
        cost, rank, back, illegal, last = [0, NONE, NONE, NONE], [0, 1, 2, 3], [], 0, ""
        for symbol in short:
            own = self.transfers[symbol]
            illegal += own.illegal + (bool(last) and last + own.first not in LEGAL)
            last = own.last
            found, middle = [], []
            for q in STATES:
                at = min(STATES, key=lambda r: (min(NONE, cost[r] + own.cost[r][q]), rank[r]))
                found.append(min(NONE, cost[at] + own.cost[at][q]))
                middle.append(at)
            order = sorted(STATES, key=lambda q: (found[q] >= NONE, rank[middle[q]], own.rank[middle[q]][q]))
            cost, rank = found, [order.index(q) for q in STATES]
            back.append(middle)
        at = min(STATES, key=lambda q: (cost[q] + INSERT * CLOSING[q], rank[q]))
        total, tail = cost[at] + INSERT * CLOSING[at], "I" * CLOSING[at]
        parts = [tail]
        for symbol, middle in zip(reversed(short), reversed(back), strict=True):
            parts.append(self.audit(symbol, middle[at], at))
            at = middle[at]
        return total, "".join(reversed(parts)), illegal


@functools.lru_cache(maxsize=4)
def grammar_of(rules: tuple[str, ...]) -> Grammar:
    return Grammar(rules)


def pair_counts(symbols: str) -> Counter:
    """How often each pair of neighbours can be replaced: equal ones must not overlap."""
    found = Counter(map("".join, itertools.pairwise(symbols)))
    for pair in found:
        if pair[0] == pair[1]:
            found[pair] = symbols.count(pair)
    return found


def learned_rules(sequences: DataFrame, most: int = MOST_RULES) -> tuple[str, ...]:
    """Re-Pair over all sequences (``symbols`` and how many times each occurs, ``n``).

    Every round counts the pairs of all sequences in Spark, and turns the most frequent ones that share no symbol into
    rules, until no pair occurs twice. Only pair counts reach the driver: at most one for two symbols of the grammar.
    """
    rules: tuple[str, ...] = ()
    while len(rules) < most:

        def count(batches: Iterator[pa.RecordBatch], rules: tuple[str, ...] = rules) -> Iterator[pa.RecordBatch]:
            grammar, found = grammar_of(rules), Counter()
            for batch in batches:
                for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    for pair, times in pair_counts(grammar.compressed(symbols)).items():
                        found[pair] += n * times
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"]
            )

        counted = sequences.select("symbols", "n").mapInArrow(count, "pair string, n long")
        counted = counted.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").collect()
        used: set[str] = set()
        more = []
        for row in sorted(counted, key=lambda r: (-r.n, r.pair)):
            if len(rules) + len(more) < most and not used & set(row.pair):
                more.append(row.pair)
                used |= set(row.pair)
        if not more:
            break
        rules += tuple(more)
    return rules


# ---------------------------------------------------------------- rows


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, which follow from the id and the turn: some rows lost, emptied, cut, said twice or
    given another role."""
    rows = plain_rows(conversations)
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("int"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def plain_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (null: one space); other columns are left behind."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


KEY = ("conv_id", "role", "digest")
ORDER = ("turn", "role", "digest")


def symbol_sequences(rows: DataFrame) -> DataFrame:
    """conv_id, part, number, symbols: the symbols of each conversation in order, cut where a task or a segment ends.

    Rows travel without their texts. Equal rows are counted first; that a row was seen earlier follows from the first
    turn of its role and text, and rows are put in order by range, so that a conversation may span tasks.
    """
    left = F.rtrim("text", F.lit(WHITE))
    fault = F.when(left == "", "blank").when(~F.right(left, F.lit(1)).isin(*ENDS), "truncated").otherwise("sound")
    initial = F.substring("role", 1, 1)
    known = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest(F.col("text")).alias("digest"),
        fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("class"),
    )
    known = known.groupBy(*known.columns).agg(F.count("*").alias("n"))
    known = stored(known, "turns")
    first = known.groupBy(*KEY).agg(F.min(F.struct("turn")).alias("first"))  # a missing turn is the least
    first = first.select(*(F.col(c).alias(f"first_{c}") for c in KEY), F.col("first.turn").alias("first_turn"))
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"first_{c}"))
    joined = known.join(first, same)
    at_first = F.col("turn").eqNullSafe(F.col("first_turn"))
    again = F.when(F.col("fault") == "blank", "blank").otherwise("duplicate")
    own = F.when(at_first, F.col("fault")).otherwise(again)
    code = F.map_from_arrays(
        F.array(*(F.lit(c + f) for c, f in SYMBOLS)), F.array(*(F.lit(s) for s in SYMBOLS.values()))
    )
    marked = joined.select(
        "conv_id",
        *ORDER,
        "n",
        F.element_at(code, F.concat("class", own)).alias("own"),
        F.element_at(code, F.concat("class", again)).alias("again"),
    )
    marked = stored(marked, "turn-symbols").repartitionByRange("conv_id", *ORDER)
    marked = marked.sortWithinPartitions("conv_id", *ORDER).select("conv_id", "n", "own", "again")

    def joined_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, size, conversation, out = TaskContext.get().partitionId(), 0, [], 0, None, []

        def close() -> None:
            nonlocal number, held, size
            if held:
                out.append((conversation, part, number, "".join(held)))
            number, held, size = number + 1, [], 0

        for batch in batches:
            for own_id, n, own, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own_id != conversation:
                    close()
                    conversation = own_id
                held.append(own)
                size, rest = size + 1, n - 1
                while rest or size >= SEGMENT:
                    if size >= SEGMENT:
                        close()
                        yield rows_made(out)
                        out = []
                    if take := min(rest, SEGMENT - size):
                        held.append(again * take)
                        size, rest = size + take, rest - take
            yield rows_made(out)
            out = []
        close()
        yield rows_made(out)

    def rows_made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "part", "number", "symbols"]
        )

    ship_package(rows.sparkSession)
    return marked.mapInArrow(joined_symbols, "conv_id long, part int, number long, symbols string")


# ---------------------------------------------------------------- repair


class Solved(TwoGenerations):
    """Solutions by symbols; what has left is solved again."""

    def __init__(self, grammar: Grammar, size: int = 20_000):
        super().__init__(size)
        self.grammar = grammar

    def make(self, symbols: str) -> tuple[int, str, int]:
        return self.grammar.solved(symbols)


class Editor:
    """Applies an audit to a conversation's rows as they pass by; ``put`` takes each edit, role and text."""

    def __init__(self, audit: str, put: Callable[[str, str, str], None]):
        self.audit, self.at, self.state, self.put = audit, 0, START, put

    def _added(self, edit: str, text: str = "") -> None:
        role = "assistant" if self.state == USER else "user"
        self.put(edit, role, text)
        self.state = STEPS[role[0]][self.state]

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._added("I")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.put(edit, role, text)
            self.state = STEPS[role[0]][self.state]
        elif edit == "R":
            self._added(edit, text)


def _stream(rows: DataFrame, every: DataFrame, sequences: DataFrame) -> DataFrame:
    """Conversations one after the other within tasks: a mark for each, its symbols in order, then its rows."""
    names = ["conv_id", "kind", "part", "number", "turn", "role", "digest", "body"]
    kinds = ["long", "int", "int", "long", "long", "string", "binary", "string"]

    def side(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(
            *(columns.get(n, F.lit(None)).cast(k).alias(n) for n, k in zip(names, kinds, strict=True))
        )

    conv, zero = F.col("conv_id"), F.lit(0)
    marks = side(every.select(conv.cast("long").alias("conv_id")).distinct(), conv_id=conv, kind=zero)
    held = side(sequences, conv_id=conv, kind=zero + 1, part=F.col("part"), number=F.col("number"), body=F.col("symbols"))
    own = {n: F.col(n) for n in ("turn", "role")}
    texts = side(rows, conv_id=conv, kind=zero + 2, digest=_digest(F.col("text")), body=F.col("text"), **own)
    both = marks.unionByName(held).unionByName(texts).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "part", "number", *ORDER).drop("part", "number", "digest")


def _repaired(rows: DataFrame, every: DataFrame, schema: str, kinds: list, conversation_of) -> DataFrame:
    """Rows that ``conversation_of`` gives for every conversation, in one pass over the sorted stream.

    A task holds the symbols and the audit of one conversation, never its texts: these pass by one batch at a time.
    """
    ship_package(rows.sparkSession)
    batch_whole_texts(rows.sparkSession)
    sequences = stored(symbol_sequences(rows), "symbol-sequences")
    distinct = stored(sequences.groupBy("symbols").agg(F.count("*").alias("n")), "distinct-sequences")
    rules = learned_rules(distinct)
    names = [c.split()[0] for c in schema.split(", ")]

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        solved, out, size, current = Solved(grammar_of(rules)), [], 0, None

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for conv, kind, turn, role, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        current.close()
                    current = conversation_of(conv, solved, out.append)
                if kind == 1:
                    current.symbols.append(body)
                elif kind == 2:
                    current.row(turn, role, body)
                    size += len(body)
                    if size > 8 << 20:
                        yield made()
                        out.clear()
                        size = 0
            yield made()
            out.clear()
            size = 0
        if current is not None:
            current.close()
        yield made()

    return _stream(rows, every, sequences).mapInArrow(repair, schema)


class _Conversation:
    """One conversation of the stream: its solution once the symbols are in, its turns and edits as rows pass."""

    def __init__(self, conv_id: int | None, solved: Solved, out: Callable[[tuple], None]):
        self.conv_id, self.solved, self.out, self.symbols = conv_id, solved, out, []
        self.editor: Editor | None = None
        self.least = self.most = None
        self.turns = 0

    def opened(self) -> Editor:
        if self.editor is None:
            self.known = "".join(self.symbols)
            self.cost, audit, self.illegal = self.solved[self.known]
            self.editor = Editor(audit, self.put)
        return self.editor

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.most:  # rows come by turn
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self.opened().row(role, text)

    def close(self) -> None:
        self.opened().insertions()
        self.finish()

    def faults(self, fault: str) -> int:
        return sum(self.known.count(SYMBOLS[c, fault]) for c in CLASSES)


class _Digest(_Conversation):
    def __init__(self, *more):
        super().__init__(*more)
        self.hash, self.lines = hashlib.sha256(), 0

    def put(self, edit: str, role: str, text: str) -> None:
        self.hash.update(f"\n{role}:{text}".encode()[0 if self.lines else 1 :])
        self.lines += 1

    def finish(self) -> None:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        faults = [self.faults(f) for f in ("blank", "duplicate", "truncated")]
        audit = self.editor.audit
        self.out((self.conv_id, gaps if gaps < 1 << 63 else None, *faults, self.illegal, self.cost, audit, self.hash.hexdigest()))


class _Rows(_Conversation):
    def __init__(self, *more):
        super().__init__(*more)
        self.lines = 0

    def put(self, edit: str, role: str, text: str) -> None:
        self.out((self.conv_id, self.lines, edit, role, text))
        self.lines += 1

    def finish(self) -> None:
        pass


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), edit (K, R or I), role, text: the rows of all repaired conversations.

    See ``repair_digests`` for the order of rows, faults and edits.
    """
    rows = plain_rows(conversations)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _repaired(rows, rows, "conv_id long, turn long, edit string, role string, text string", kinds, _Rows)


def repair_digests(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``every`` may name more conversations, which have no rows: zeros and an empty audit. Rows go by turn (missing ones
    first), then role, then a digest of the text; equal rows stand beside each other. A null role or text is one space.
    Rows without a conv_id are one conversation; other columns are left behind; an empty table gives an empty one. A
    range of turns that leaves 64 bits has null gaps.

    The hash of a conversation is one chain over its rows, so its last pass is one task's work, a batch at a time; the
    rest of a very long conversation is spread.
    """
    rows = plain_rows(conversations)
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    schema += "audit string, repaired_sha256 string"
    return _repaired(rows, rows if every is None else every, schema, kinds, _Digest)
