"""Repair of conversation structure by weighted, generalised LR parsing.

The roles of a conversation, by their initials, should read as the grammar

    Conversation -> (nothing) | Pairs | s Pairs        Pairs -> Pair | Pairs Pair
    Pair -> u a

A parser with an LR(0) table over a graph-structured stack reads the rows in order. At each
row every stack may delete the row, keep it, rerole it to user or assistant, or insert an
empty row before it; each edit has a weight. A stack is a node of a state upon the node
below it, and equal stacks are one node; where two ways reach the same node, the way with
the smaller (cost, audit) stays. The audit is the edits' initials: D, I, K, R. As inserts
count to the row that follows, no audit at a row is the beginning of another one, so the
order of two audits never changes once they differ: a rank per stack stands for them, and
the way back is kept as one byte per row and stack. The grammar has eight stacks.

Faults: a row is blank (no word), else a duplicate (role and text were seen before in the
conversation), else truncated (its last character is none of ``.!?``, white space aside).
Blank and duplicate rows must be deleted; truncated rows that stay add to the cost.

Rows are shuffled once, by conversation; duplicates are numbered by a window over the same
partitioning, then rows are sorted on disk and streamed through the parser, which holds no
texts: each stack carries the running hash of its repaired text. So a conversation takes
memory for one byte per row and stack, and its audit, however long it is. One conversation
is parsed in one task, as its audit and its hash are chains over its rows in order.

Defined cases: a null role or text counts as one space; rows are ordered by turn (nulls
first), then role, then text, so equal rows are adjacent and ties have one order; an empty
role has no initial and is never kept; a null id is a conversation like any other; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import WORD, chunks

# The LR(0) table of the grammar above. State 2 follows u, 3 follows u a,
# 5 and 7 hold a Pair; what is reduced is popped, and the state below goes to the next.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 2, (6, "u"): 2}
REDUCE = {3: (2, "Pair"), 5: (1, "Pairs"), 7: (2, "Pairs")}
GOTO = {
    (0, "Pair"): 5,
    (1, "Pair"): 5,
    (4, "Pair"): 7,
    (6, "Pair"): 7,
    (0, "Pairs"): 4,
    (1, "Pairs"): 6,
}
ACCEPTING = (0, 4, 6)

ROLES = {"u": "user", "a": "assistant"}
_CHUNK = 1 << 22


@dataclass(frozen=True)
class Weights:
    """What an edit costs; inserting costs more than nothing, or it would not end."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self) -> None:
        if min(self.keep, self.rerole, self.delete, self.truncated) < 0 or self.insert <= 0:
            raise ValueError("weights may not be negative, and inserting must cost something")


class Stacks:
    """The graph of stacks, and the ways over a row from each; nodes are made once."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self.nodes: list[tuple[int, int | None]] = [(0, None)]
        self._ways: dict[tuple, list[tuple]] = {}
        #: What a way is, from which node, with which initials and letters, by its code.
        self.codes: list[tuple[int, str, str]] = []
        self._code: dict[tuple[int, str, str], int] = {}
        for node, _ in enumerate(self.nodes):  # grows as it runs
            for symbol in "sua":
                self.after(node, symbol)

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.nodes:
            self.nodes.append((state, below))
        return self.nodes.index((state, below))

    def accepts(self, node: int) -> bool:
        return self.nodes[node][0] in ACCEPTING

    def after(self, node: int, symbol: str) -> int | None:
        """The stack after a shift and all reductions that follow; None if there is none."""
        state = SHIFT.get((self.nodes[node][0], symbol))
        if state is None:
            return None
        below = node
        while state in REDUCE:
            length, symbol = REDUCE[state]
            for _ in range(length - 1):
                below = self.nodes[below][1]
            state = GOTO[self.nodes[below][0], symbol]
        return self._node(state, below)

    def inserted(self, node: int) -> dict[int, str]:
        """Stacks that inserted rows lead to, with the initials of these; itself too."""
        found, queue = {node: ""}, [node]
        for at in queue:
            for symbol in ROLES:
                to = self.after(at, symbol)
                if to is not None and to not in found:
                    found[to] = found[at] + symbol
                    queue.append(to)
        return found

    def ways(self, node: int, initial: str, fault: str | None) -> list[tuple]:
        """(to, cost, letters, code): the best way to each stack that a row allows."""
        if (node, initial, fault) not in self._ways:
            best: dict[int, tuple] = {}
            for to, *way in self._offers(node, initial, fault):
                if to is not None and (to not in best or way < best[to]):
                    best[to] = way
            self._ways[node, initial, fault] = [
                (to, cost, letters, self._coded(node, symbols, letters))
                for to, (cost, letters, symbols) in best.items()
            ]
        return self._ways[node, initial, fault]

    def _offers(self, node: int, initial: str, fault: str | None) -> Iterator[tuple]:
        w = self.weights
        for at, new in self.inserted(node).items():
            cost, letters = w.insert * len(new), "I" * len(new)
            yield at, cost + w.delete, letters + "D", new + "-"
            if fault not in ("blank", "duplicate"):
                cost += w.truncated if fault == "truncated" else 0
                if initial:
                    yield self.after(at, initial), cost + w.keep, letters + "K", new + initial
                for symbol in ROLES:
                    yield self.after(at, symbol), cost + w.rerole, letters + "R", new + symbol

    def _coded(self, *way) -> int:
        if way not in self._code:
            self._code[way] = len(self.codes)
            self.codes.append(way)
        return self._code[way]


@lru_cache(maxsize=4)
def stacks(weights: Weights) -> Stacks:
    return Stacks(weights)


def _say(said, role: str, text: str):
    """The running hash after one more row; hashes are copied, never changed."""
    line = f"{role}:{text}".encode()
    if said is None:
        return hashlib.sha256(line)
    said = said.copy()
    said.update(b"\n" + line)
    return said


class Parse:
    """One conversation: feed its rows in order, then take the result.

    A top is the best way to a stack: its cost, the rank of its audit, and the running hash
    of its repaired rows.
    """

    def __init__(self, weights: Weights) -> None:
        self.stacks = stacks(weights)
        self.tops = {0: (0, 0, None)}
        #: A byte per row and stack: the code of the way that led there.
        self.steps = bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.least, self.turn = 0, None, None
        self.initial: str | None = None

    def feed(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn

        known = initial if initial in ("s", "u", "a") else ""
        best: dict[int, tuple] = {}
        for node, (cost, rank, _) in self.tops.items():
            for to, more, letters, code in self.stacks.ways(node, known, fault):
                way = (cost + more, rank, letters, code)
                if to not in best or way < best[to]:
                    best[to] = way
        order = sorted(best, key=lambda to: best[to][1:3])
        step = bytearray(len(self.stacks.nodes))
        tops = {}
        for rank, to in enumerate(order):
            cost, _, letters, code = best[to]
            node, symbols, _ = self.stacks.codes[code]
            said = self.tops[node][2]
            for symbol in symbols[:-1]:
                said = _say(said, ROLES[symbol], "")
            if letters[-1] != "D":
                said = _say(said, role if letters[-1] == "K" else ROLES[symbols[-1]], text)
            step[to] = code
            tops[to] = (cost, rank, said)
        self.tops = tops
        self.steps += step

    def result(self) -> tuple:
        """gaps, the four counts, cost, audit, initials after the edits, hash."""
        graph, ends = self.stacks, []
        for node, (cost, rank, _) in self.tops.items():
            for at, new in graph.inserted(node).items():
                if graph.accepts(at):
                    price = graph.weights.insert * len(new)
                    ends.append((cost + price, rank, "I" * len(new), node, new))
        cost, _, letters, node, new = min(ends)
        said = self.tops[node][2]
        for symbol in new:
            said = _say(said, ROLES[symbol], "")
        audit, symbols = [letters], [new]
        width = len(graph.nodes)
        for at in range(len(self.steps) - width, -1, -width):
            node, row_symbols, row_letters = graph.codes[self.steps[at + node]]
            audit.append(row_letters)
            symbols.append(row_symbols)
        digest = (said or hashlib.sha256()).hexdigest()
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        counts = [self.counts[name] for name in ("blank", "duplicate", "truncated", "illegal")]
        return (gaps, *counts, cost, "".join(audit[::-1]), "".join(symbols[::-1]), digest)


RESULT = T.StructType(
    [
        *[
            T.StructField(name, T.LongType())
            for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        ],
        T.StructField("audit", T.StringType()),
        T.StructField("symbols", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ]
)

#: Within a conversation: by turn, nulls first; the rest only orders ties.
_ORDER = ("turn", "role", "text", "copy")


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def _rows(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(id, turn, role, text, copy), one shuffle; ``copy`` numbers equal (role, text)."""
    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        _filled(role_col).alias("role"),
        _filled(text_col).alias("text"),
    ).repartition("id")
    equal = Window.partitionBy("id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return rows.withColumn("copy", F.row_number().over(equal))


def faults(text: Column, copy: Column) -> Column:
    """The first fault of a row; null for none."""
    whole = text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return (
        F.when(~text.rlike(WORD), "blank")
        .when(copy > 1, "duplicate")
        .when(~whole, "truncated")
    )


def repair(
    conversations: DataFrame,
    weights: Weights = Weights(),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation its faults and its cheapest repair.

    Returns id, gaps (turns missing between the first and the last), blank, duplicate,
    truncated, illegal (neighbours that the grammar has not), cost, audit, symbols (for each
    letter of the audit the initial of the row's role then, ``-`` if deleted), and
    repaired_sha256 over the repaired rows as ``role:text`` lines.
    """
    rows = _rows(conversations, id_col, turn_col, role_col, text_col)
    rows = rows.select(
        "id", "turn", "role", "text", faults(F.col("text"), F.col("copy")).alias("fault"), "copy"
    ).sortWithinPartitions("id", *[F.col(name).asc_nulls_first() for name in _ORDER])
    given = rows.drop("copy")
    id_field = given.schema["id"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parse, done = None, None, []

        def results() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            ids = pa.array(columns[0], kind)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [ids, *[pa.array(column) for column in columns[1:]]], ["id", *RESULT.names]
            )

        for batch in batches:
            kind = batch.schema.field("id").type
            for start, end in chunks(batch["text"], _CHUNK):
                part = batch.slice(start, end - start)
                for id_, *row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if parse is None or id_ != current:
                        if parse is not None:
                            done.append((current, *parse.result()))
                        current, parse = id_, Parse(weights)
                    parse.feed(*row)
                if len(done) >= 1000:
                    yield results()
        if parse is not None:
            done.append((current, *parse.result()))
            yield results()

    found = given.mapInArrow(compute, T.StructType([id_field, *RESULT]))
    return found.withColumnRenamed("id", id_col)


def repaired_rows(
    conversations: DataFrame,
    repairs: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The rows of the repaired conversations: id, place (from 1), role, text, edit.

    ``repairs`` comes from :func:`repair`. Its audits are split into single edits, which
    meet the rows they are of by number.
    """
    in_order = Window.partitionBy("id").orderBy(
        *[F.col(name).asc_nulls_first() for name in _ORDER]
    )
    rows = _rows(conversations, id_col, turn_col, role_col, text_col)
    rows = rows.withColumn("row", F.row_number().over(in_order))
    letters = F.transform(
        F.sequence(F.lit(1), F.length("audit")),
        lambda n: F.struct(
            F.substr("audit", n, F.lit(1)).alias("edit"),
            F.substr("symbols", n, F.lit(1)).alias("symbol"),
        ),
    )
    edits = (
        repairs.filter(F.length("audit") > 0)
        .select(F.col(id_col).alias("id"), F.posexplode(letters).alias("at", "one"))
        .select("id", "at", "one.*")
    )
    past = Window.partitionBy("id").orderBy("at")
    before = past.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edits = edits.withColumns(
        {
            "row": F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(before)),
            "place": F.count_if(F.col("edit") != "D").over(before),
        }
    ).filter("edit <> 'D'")
    named = F.when(F.col("symbol") == "u", ROLES["u"]).when(F.col("symbol") == "a", ROLES["a"])
    rows = rows.withColumnsRenamed({"id": "of", "row": "number"})
    met = edits.join(
        rows, edits["id"].eqNullSafe(rows["of"]) & (edits["row"] == rows["number"]), "left"
    )
    return met.select(
        F.col("id").alias(id_col),
        F.col("place"),
        F.when(F.col("edit") == "K", F.col("role")).otherwise(named).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "edit",
    )
