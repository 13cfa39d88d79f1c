"""Conversation repair: the cheapest edits that give every conversation a legal sequence of roles.

A legal sequence of role initials is ``(s?(ua)+)?``.  Each row is kept (0), given the role user or assistant (1) or
deleted (2, required for blank and duplicate rows); an empty user or assistant row can be
inserted anywhere (5); a truncated row that is not deleted adds 5.  Among the cheapest edits the ASCII-least string of
their initials is taken, in which D < I < K < R.

1. ``faults``: Spark finds the first fault of every row.  Rows are known by the SHA-256 of their text, equal ones
   are counted before they are shuffled, and duplicates are found by (conversation, role, text), so that a
   conversation with very many rows is spread over tasks.
2. ``sequences``: one character for each row, which stands for its role and fault.
3. ``grammar``: Re-Pair rounds over all sequences.  Spark counts the adjacent pairs, the most frequent become rules and
   replace their pairs in the next round.  Their number is bounded by ``ROUNDS`` and ``RULES``; sequences of any
   length are evaluated whatever the rules cover.
4. A rule has one min-plus matrix over the states of the grammar of roles: the least cost from state to state with its
   edits, a rope that shares the ropes of the rule's two parts.  Matrices are built bottom-up once and serve all
   conversations, each of which is a product of the matrices of its symbols.
5. ``repaired``: texts are sorted by conversation and pass once, with the conversation's edits in front.

Cheapest edits can be put together from parts because two different edit strings of one cost for the same rows
and states never begin one with the other: the rest would be insertions, which cost.

Order is by turn (nulls first), then role, then the text's SHA-256.  Nulls in any column count as one space (a null
turn stays null in ``gaps``); a null ``conv_id`` is a conversation of its own.  Equal rows are duplicates of each other.
An empty table gives an empty one.  Other columns than ``conv_id, turn, role, text`` play no part.

A conversation's edits are one string, so its rows are bounded by what a string can hold; its texts are not, and are
hashed as they pass.  SHA-256 runs in sequence, so the texts of one conversation pass through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facilitymetrics.llm.scratch import written

ROUNDS, RULES = 6, 24  # rounds of Re-Pair, new rules in each
MOST_KNOWN = 20_000  # sequences whose result a task remembers

_NO_SPACE = r"[^\x20\x09-\x0D]"
_LAST = r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\z)"

# Symbols of rows: role initial s, u, a or another, whole or truncated; X must be deleted.
WHOLE = {"s": "s", "u": "u", "a": "a", "": "o"}
TRUNCATED = {"s": "S", "u": "U", "a": "A", "": "O"}
MUST_GO = "X"
_FIRST_RULE = 0x100

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# States: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
_DUE = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
_NAMES = {"u": "user", "a": "assistant"}


# ---- rows and their faults

def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with damage by the CRC of their key; ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    crc = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), crc.alias("crc")).select(
        "conv_id",
        "turn",
        F.when(F.col("crc") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("crc") == 1, "")
        .when(F.col("crc") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("crc") == 0, 0).when(F.col("crc") == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(rows: DataFrame) -> DataFrame:
    """The rows as they are, for conversations that are to be repaired without damage."""
    return rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), F.lit(1).alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``, the fault of the first of them, and ``n = 0`` where all are dropped."""
    gone = F.col("copies") == 0
    blank = ~F.col("text").rlike(_NO_SPACE)
    whole = F.regexp_extract("text", _LAST, 0).isin(".", "!", "?")
    light = rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(~gone, F.col("role")).alias("role"),
        F.when(~gone, _digest()).alias("digest"),
        F.when(gone, None).when(blank, "blank").when(~whole, "truncated").otherwise("").alias("fault"),
        "copies",
    )
    counted = light.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("n"))
    # Equal role and text at the least turn first; the others are seen earlier.
    earlier = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    seen = (F.col("n") > 0) & (F.row_number().over(earlier) > 1)
    return counted.withColumn("fault", F.when(seen & (F.col("fault") != "blank"), "duplicate").otherwise(F.col("fault")))


# ---- sequences

_SEQUENCE = (
    "conv_id {id}, sequence string, gaps long, blank long, duplicate long, truncated long, illegal long"
)
_LEGAL = {"su", "ua", "au"}


def sequences(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its symbols and counts, from the rows of ``faults``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None
        for batch in batches:
            for conv, turn, role, fault, n in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                        if len(done) >= 4096:
                            yield _batch(done, schema)
                            done = []
                    now = _Conversation(conv)
                if n:
                    now.add(turn, role, fault, n)
        if now is not None:
            done.append(now.result())
        if done:
            yield _batch(done, schema)

    schema = _SEQUENCE.format(id=rows.schema["conv_id"].dataType.simpleString())
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", "turn", "role", "fault", F.col("n").cast("int")).mapInArrow(build, schema)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32()}
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    columns = [pa.array(list(column), kinds[kind]) for column, (_, kind) in zip(zip(*rows), fields)]
    return pa.record_batch(columns, [name for name, _ in fields])


class _Conversation:
    """Counts of one conversation's rows, which come in order."""

    def __init__(self, conv):
        self.conv = conv
        self.symbols: list[str] = []
        self.turns = self.first = self.last = None
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.initial = 0, None

    def add(self, turn, role: str, fault: str, n: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns = (self.turns or 0) + 1
            self.last = turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.illegal += (n - 1) * (initial * 2 not in _LEGAL)
        self.initial = initial
        if fault:
            self.faults[fault] += 1
        # Further copies of a row are duplicates, or blank as it is.
        self.faults["blank" if fault == "blank" else "duplicate"] += n - 1
        known = initial if initial in WHOLE else ""
        symbol = MUST_GO if fault in ("blank", "duplicate") else (TRUNCATED if fault else WHOLE)[known]
        self.symbols.append(symbol + MUST_GO * (n - 1))

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        f = self.faults
        return (self.conv, "".join(self.symbols), gaps, f["blank"], f["duplicate"], f["truncated"], self.illegal)


# ---- ropes and transfer matrices

class Rope:
    """A string as two shared halves; halves that are the same object are not compared."""

    __slots__ = ("left", "right", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right

    def __add__(self, other: Rope) -> Rope:
        if not other.left and not other.text:
            return self
        if not self.left and not self.text:
            return other
        return Rope(left=self, right=other)

    def leaves(self) -> Iterator[str]:
        waiting = [self]
        while waiting:
            node = waiting.pop()
            while node.left is not None:
                waiting.append(node.right)
                node = node.left
            if node.text:
                yield node.text

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        a, b = self, other
        while a.left is not None and b.left is not None and a.left is b.left:
            a, b = a.right, b.right
        if a is b:
            return False
        ours, theirs = chain.from_iterable(a.leaves()), chain.from_iterable(b.leaves())
        for x in ours:
            y = next(theirs, None)
            if x != y:
                return y is not None and x < y
        return next(theirs, None) is not None


Entry = tuple[int, Rope]
Matrix = dict[tuple[int, int], Entry]


def _least(entries: dict, key, cost: int, rope: Rope) -> None:
    old = entries.get(key)
    if old is None or cost < old[0] or (cost == old[0] and rope < old[1]):
        entries[key] = (cost, rope)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus: the least over the state between, and the first string among the least."""
    out: Matrix = {}
    for (i, m), (cost, rope) in a.items():
        for j in range(4):
            if (entry := b.get((m, j))) is not None:
                _least(out, (i, j), cost + entry[0], rope + entry[1])
    return out


def _insertions() -> Matrix:
    """Up to two rows, after which the role that is due has been any."""
    out: Matrix = {(i, i): (0, Rope()) for i in range(4)}
    for i in range(4):
        state = i
        for n in (1, 2):
            state = _NEXT[state][_DUE[state]]
            _least(out, (i, state), 5 * n, Rope(INSERT * n))
    return out


INSERTIONS = _insertions()


def _edits(symbol: str) -> Matrix:
    """One row: insertions before it, then what is done with it."""
    row: Matrix = {(i, i): (2, Rope(DELETE)) for i in range(4)}
    if symbol != MUST_GO:
        cost, own = 5 * symbol.isupper(), symbol.lower()
        for i in range(4):
            if own in _NEXT[i]:
                _least(row, (i, _NEXT[i][own]), cost, Rope(KEEP))
            due = _NEXT[i][_DUE[i]]
            _least(row, (i, due), cost + 1, Rope(REROLE))
    return product(INSERTIONS, row)


def transfer(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """The matrix of each symbol; rule ``k`` is named by the character ``_FIRST_RULE + k``."""
    of = {symbol: _edits(symbol) for symbol in (*WHOLE.values(), *TRUNCATED.values(), MUST_GO)}
    for k, (a, b) in enumerate(rules):
        of[chr(_FIRST_RULE + k)] = product(of[a], of[b])
    return of


def cheapest(sequence: str, of: dict[str, Matrix], rules: list[tuple[str, str]]) -> tuple[int, str]:
    """Least cost and first cheapest edits of a sequence of row symbols."""
    parts = [*[of[symbol] for symbol in compressed(sequence, rules)], INSERTIONS]
    while len(parts) > 1:  # in pairs, so that ropes stay flat and short ones are compared
        parts = [product(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    ends: dict = {}
    for (i, j), (cost, rope) in parts[0].items():
        if i == START and j in (START, AFTER_A):
            _least(ends, "", cost, rope)
    cost, rope = ends[""]
    return cost, str(rope)


# ---- grammar

def compressed(sequence: str, rules: list[tuple[str, str]]) -> str:
    for k, (a, b) in enumerate(rules):
        sequence = sequence.replace(a + b, chr(_FIRST_RULE + k))
    return sequence


def grammar(found: DataFrame, rounds: int = ROUNDS, most: int = RULES) -> list[tuple[str, str]]:
    """Rules ``(a, b)`` of Re-Pair, the most frequent pairs of each round over all sequences."""
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        known = list(rules)

        def pairs(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            counts: dict[str, int] = {}
            for batch in batches:
                for sequence in batch.column(0).to_pylist():
                    now = compressed(sequence, known)
                    for k in range(len(now) - 1):
                        pair = now[k : k + 2]
                        counts[pair] = counts.get(pair, 0) + 1
            yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pair", "n"])

        counted = (
            found.select("sequence").mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        )
        # A few rows, whatever the input.
        new = [tuple(row["pair"]) for row in counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(most).collect()]
        if not new:
            break
        rules += new
    return rules


# ---- repair

_OUT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _edited(found: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The sequences with ``cost`` and ``audit``."""
    of = transfer(rules)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        for batch in batches:
            results = []
            for sequence in batch.column("sequence").to_pylist():
                result = known.get(sequence) or cheapest(sequence, of, rules)
                if len(sequence) <= 64 and len(known) < MOST_KNOWN:
                    known[sequence] = result
                results.append(result)
            columns = [c for c in batch.schema.names if c != "sequence"]
            cost = pa.array([cost for cost, _ in results], pa.int64())
            audit = pa.array([audit for _, audit in results], pa.string())
            yield pa.record_batch([*[batch.column(c) for c in columns], cost, audit], [*columns, "cost", "audit"])

    kept = [f for f in found.schema.fields if f.name != "sequence"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return found.mapInArrow(edit, f"{schema}, cost long, audit string")


class _Repair:
    """Walks through a conversation's edits as its rows come."""

    def __init__(self, head: tuple, rows: bool):
        self.head, self.audit, self.at = head, head[-1], 0
        self.state, self.hash, self.any = START, hashlib.sha256(), False
        self.rows = [] if rows else None

    def _put(self, role: str, text: str) -> None:
        self.state = _NEXT[self.state][role[:1]]
        if self.any:
            self.hash.update(b"\n")
        self.any = True
        self.hash.update(f"{role}:{text}".encode())
        if self.rows is not None:
            self.rows.append((role, text))

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self._put(_NAMES[_DUE[self.state]], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self._put(role, text)
        elif edit == REROLE:
            self._put(_NAMES[_DUE[self.state]], text)

    def end(self) -> tuple:
        self._insert()
        return (*self.head, self.hash.hexdigest())


def repaired(rows: DataFrame) -> DataFrame:
    """Faults, cost, edits and hash of every conversation, from the rows of ``damaged`` or ``undamaged``."""
    found = written(sequences(faults(rows)), "sequences")
    edits = _edited(found, grammar(found))
    head = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    fronts = edits.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"), F.lit(1).alias("copies"), F.array(*[F.col(c) for c in head]).alias("head"),
    )
    texts = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", _digest().alias("digest"), "text", "copies",
        F.lit(None).cast("array<bigint>").alias("head"),
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv, role, text, copies, counts in zip(*[column.to_pylist() for column in batch.columns]):
                if counts is not None:
                    if now is not None:
                        done.append(now.end())
                    now = _Repair((conv, *counts, text), rows=False)
                else:
                    for _ in range(copies):
                        now.row(role, text)
            if len(done) >= 4096:
                yield _batch(done, schema)
                done = []
        if now is not None:
            done.append(now.end())
        if done:
            yield _batch(done, schema)

    schema = _OUT.format(id=rows.schema["conv_id"].dataType.simpleString())
    return (
        fronts.union(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv_id", "role", "text", "copies", "head")
        .mapInArrow(repair, schema)
    )
