"""Conversations put right with the fewest edits, by a generalised LR parse of their roles.

The grammar of roles, by initials, is ``(s?(ua)+)?``:

    Conversation -> Turns |          Turns -> Turns Pair | s Pair | Pair          Pair -> u a

A row of a conversation may be kept (K), given another role (R, 3), deleted (D, 4), and turns without text may be inserted
anywhere (I, 3). A blank row or one that was there before must go; one that breaks off in mid-sentence costs 3 more if it
stays. The parser holds a graph-structured stack: all stacks that an input so far can lead to, under one node per
stack top. Stacks of equal top are merged, and the one of least (cost, audit) stays, where the audit is the string of edits.
As ``Pair`` reduces to ``Turns`` whatever lies below it, equal tops have equal continuations, so nothing else is needed of
the rest of a stack; and two audits of one cost that reach one place can't be a beginning of each other, so the least
stays the least whatever follows.

Rows are dealt out by ranges of (conversation, turn), so a conversation with a third of all rows is spread over tasks.
What a task has of a conversation is parsed from every stack top (a piece); pieces are put together in order afterwards,
as steps from top to top. Conversations that lie in one piece, which are nearly all, are finished at once.

What rows may hold: NULL conversations are one conversation; NULL roles and texts count as one space; NULL turns come first.
Rows of equal turn are ordered by role, then text. A role whose initial is none of ``s``, ``u``, ``a`` (also an empty one)
fits nowhere, so it is given another or deleted. Rows that repeat are all kept apart: the second is a duplicate. Long texts are
whole. No rows give no conversations. Columns beside the four are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.llm.common import BATCH_ROWS, ready, written

# Costs of edits, what counts as white space and as the end of a sentence, and initials that may follow another.
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3
WHITE, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

#: Stack tops, and the top after an initial was shifted and all that can be reduced was.
START, SYSTEM, TURNS, USER = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (TURNS, "u"): USER, (USER, "a"): TURNS}
ACCEPT = (START, TURNS)

#: Rows and characters of a conversation that a piece holds at most (one row at least).
PIECE_ROWS, PIECE_CHARS = 4096, 8 << 20
#: Characters of a text that rows of one turn and role are dealt by.
HEAD = 64
#: Parses that a task remembers, and rows of a conversation that it remembers one of at most.
KNOWN, KNOWN_ROWS = 50_000, 16

Tops = dict[int, tuple[int, str]]


# The parser. Faults of a row: "b" blank, "d" duplicate, "t" truncated, "." none.


def _offer(tops: Tops, top: int, cost: int, audit: str) -> bool:
    if top in tops and tops[top] <= (cost, audit):
        return False
    tops[top] = (cost, audit)
    return True


def _inserted(tops: Tops) -> Tops:
    """With all that inserted turns lead to."""
    reached, news = dict(tops), list(tops)
    while news:
        top = news.pop()
        for initial in ROLES:
            after = NEXT.get((top, initial))
            if after is not None and _offer(reached, after, reached[top][0] + INSERT, reached[top][1] + "I"):
                news.append(after)
    return reached


def _step(tops: Tops, initial: str, fault: str) -> Tops:
    after: Tops = {}
    for top, (cost, audit) in _inserted(tops).items():
        _offer(after, top, cost + DELETE, audit + "D")
        if fault in "bd":
            continue
        extra = BROKEN if fault == "t" else 0
        if (top, initial) in NEXT:
            _offer(after, NEXT[top, initial], cost + extra, audit + "K")
        for other in ROLES:
            if (top, other) in NEXT:
                _offer(after, NEXT[top, other], cost + REROLE + extra, audit + "R")
    return after


def parse(rows: Iterable[tuple[str, str]], start: int = START) -> Tops:
    """The tops after ``(initial, fault)`` rows, each with its least (cost, audit)."""
    tops: Tops = {start: (0, "")}
    for initial, fault in rows:
        tops = _step(tops, initial, fault)
    return tops


def finish(tops: Tops) -> tuple[int, str, int]:
    """Cost and audit of the cheapest complete parse, and the top before the turns it inserts at the end."""
    ends = ((_inserted({top: found}), top) for top, found in tops.items())
    return min((*reached[end], top) for reached, top in ends for end in ACCEPT if end in reached)


def apply(audit: str, roles: list[str], texts: list[str], top: int = START) -> list[tuple[str, str, str]]:
    """Turns ``(role, text, edit)`` that an audit makes of rows after stack top ``top``."""
    turns, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, initial = roles[at], roles[at][:1]
        else:
            [initial] = (other for other in ROLES if (top, other) in NEXT)
            role = ROLES[initial]
        turns.append((role, "" if edit == "I" else texts[at], edit))
        top = NEXT[top, initial]
        at += edit != "I"
    return turns


# Pieces


@dataclass
class Piece:
    """Rows of one conversation in order, with their faults and the turns they span."""

    conv: object
    open: bool
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[str] = field(default_factory=list)
    turns: list[int] = field(default_factory=list)
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.chars += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def full(self) -> bool:
        return len(self.roles) >= PIECE_ROWS or self.chars >= PIECE_CHARS


def _illegal(initials: list[str]) -> int:
    return sum(one + two not in LEGAL for one, two in zip(initials, initials[1:]))


_TURN = T.StructType().add("role", "string").add("text", "string").add("edit", "string")


_STEP = T.StructType().add("top", "integer").add("after", "integer").add("cost", "long").add("audit", "string")


def _pieces_schema(conv: T.DataType) -> T.StructType:
    schema = T.StructType().add("conv_id", conv).add("part", "integer").add("piece", "integer").add("open", "boolean")
    for name in ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "n_turns", "cost"):
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("turns", T.ArrayType(_TURN))
    for name in ("roles", "texts"):
        schema = schema.add(name, T.ArrayType(T.StringType()))
    return schema.add("first_initial", "string").add("last_initial", "string").add("steps", T.ArrayType(_STEP))


def _row(piece: Piece, part: int, number: int, known: dict) -> dict:
    initials = [role[:1] for role in piece.roles]
    row = {
        "conv_id": piece.conv, "part": part, "piece": number, "open": piece.open,
        "blank": piece.faults.count("b"), "duplicate": piece.faults.count("d"), "truncated": piece.faults.count("t"),
        "illegal": _illegal(initials), "n_turns": len(piece.turns),
        "first_turn": piece.turns[0] if piece.turns else None, "last_turn": piece.turns[-1] if piece.turns else None,
        "first_initial": initials[0], "last_initial": initials[-1],
    }
    rows = tuple(zip(initials, piece.faults))
    if piece.open:
        starts = {top: parse(rows, top) for top in range(4)}
        steps = [(top, after, *found) for top, tops in starts.items() for after, found in tops.items()]
        row["steps"] = [dict(zip(_STEP.names, step)) for step in steps]
        return row | {"roles": piece.roles, "texts": piece.texts}
    best = known.get(rows)
    if best is None:
        best = finish(parse(rows))
        if len(rows) <= KNOWN_ROWS and len(known) < KNOWN:
            known[rows] = best
    row["cost"], row["audit"], _ = best
    return row | {"turns": _turns(row["audit"], piece.roles, piece.texts)}


def _turns(audit: str, roles: list[str], texts: list[str], top: int = START) -> list[dict]:
    return [dict(zip(_TURN.names, turn)) for turn in apply(audit, roles, texts, top)]


def _fault(text: str, copied: bool) -> str:
    filled = text.rstrip(WHITE)
    return "b" if not filled else "d" if copied else "t" if filled[-1] not in ENDS else "."


def _parser(fields: T.StructType):
    """Rows of one task, in order, as pieces. The first and the last conversation of a task may go on in another, so
    their pieces stay open, and so do those of a conversation too long for one piece."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, out, held, schema = TaskContext.get().partitionId(), {}, [], 0, None
        piece, number, group, marks, before = None, 0, None, set(), None
        for batch in batches:
            schema = schema or _arrow(fields, batch.schema.field(0).type)
            columns = [column.to_pylist() for column in batch.columns]
            for conv, turn, role, head, is_row, digest, text in zip(*columns):
                new = piece is None or conv != piece.conv
                if not new and is_row and piece.full():
                    piece.open = True
                    out.append(_row(piece, part, number, known))
                    held, piece, number = held + piece.chars, Piece(conv, True), number + 1
                elif new:
                    if piece is not None:
                        out.append(_row(piece, part, number, known))
                        held += piece.chars
                    piece, number = Piece(conv, piece is None), number + 1
                if len(out) >= BATCH_ROWS or held >= PIECE_CHARS:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
                if new or (turn, role, head) != group:
                    group, marks, before = (turn, role, head), set(), None
                if not is_row:
                    marks.add(digest)
                    continue
                piece.add(turn, role, text, _fault(text, text == before or digest in marks))
                before = text
        if piece is not None:
            piece.open = True
            yield pa.RecordBatch.from_pylist([*out, _row(piece, part, number, known)], schema)

    return run


def _ordered(turns: DataFrame) -> DataFrame:
    """All rows in order, dealt over tasks by range. A row that repeats one of an earlier turn has a mark before it."""
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").try_cast("long").alias("turn"),
        role.alias("role"),
        F.left(text, F.lit(HEAD)).alias("head"),
        F.lit(1).alias("is_row"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        text.alias("text"),
    )
    # Counting first: however often a turn repeats a row, it is one row in the join.
    each = rows.groupBy("conv", "digest", "turn").agg(F.any_value("role").alias("role"), F.any_value("head").alias("head"))
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = each.groupBy(F.col("conv").alias("of"), F.col("digest").alias("same")).agg(
        F.min(order).alias("first"), F.count("*").alias("n")
    )
    alike = F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same"))
    later = each.join(firsts.where("n > 1"), alike).where(order > F.col("first"))
    none = F.lit(None).cast("string").alias("text")
    marks = later.select("conv", "turn", "role", "head", F.lit(0).alias("is_row"), "digest", none)
    dealt = rows.unionByName(marks).repartitionByRange("conv", "turn", "role", "head")
    return dealt.sortWithinPartitions("conv", "turn", "role", "head", "is_row", "text")


# Conversations in several pieces


@dataclass
class _Chain:
    """Pieces of one conversation, in order, put together."""

    conv: object
    tops: Tops
    pieces: list[tuple]
    totals: dict
    last_initial: str | None = None

    def add(self, row: dict) -> None:
        after, came = {}, {}
        for step in row["steps"]:
            if step["top"] in self.tops:
                cost, audit = self.tops[step["top"]]
                if _offer(after, step["after"], cost + step["cost"], audit + step["audit"]):
                    came[step["after"]] = (step["top"], step["audit"])
        self.tops = after
        self.pieces.append((row["part"], row["piece"], came))
        for name in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
            self.totals[name] = self.totals.get(name, 0) + row[name]
        if self.last_initial is not None and self.last_initial + row["first_initial"] not in LEGAL:
            self.totals["illegal"] += 1
        self.last_initial = row["last_initial"]
        if row["n_turns"]:
            if self.totals.get("last_turn") == row["first_turn"]:
                self.totals["n_turns"] -= 1
            self.totals.setdefault("first_turn", row["first_turn"])
            self.totals["last_turn"] = row["last_turn"]

    def rows(self) -> Iterator[dict]:
        """Per piece the edits of the best audit and the top before them; the first piece has the conversation's totals."""
        cost, audit, top = finish(self.tops)
        rest, chosen = audit[len(self.tops[top][1]) :], []
        for part, number, came in reversed(self.pieces):
            top, edits = came[top]
            chosen.append({"conv_id": self.conv, "part": part, "piece": number, "top": top, "edits": edits + rest})
            rest = ""
        chosen[-1] |= self.totals | {"cost": cost, "audit": audit}
        return reversed(chosen)


def _chained(fields: T.StructType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = schema = None
        for batch in batches:
            schema = schema or _arrow(fields, batch.schema.field("conv_id").type)
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                if chain is not None and chain.conv != row["conv_id"]:
                    yield pa.RecordBatch.from_pylist(list(chain.rows()), schema)
                    chain = None
                chain = chain or _Chain(row["conv_id"], {START: (0, "")}, [], {})
                chain.add(row)
        if chain is not None:
            yield pa.RecordBatch.from_pylist(list(chain.rows()), schema)

    return run


def _applied(fields: T.StructType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = _arrow(fields, batch.schema.field("conv_id").type)
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                done = {name: row[name] for name in ("conv_id", "part", "piece")}
                done["turns"] = _turns(row["edits"], row["roles"], row["texts"], row["top"])
                yield pa.RecordBatch.from_pylist([done], schema)

    return run


def _arrow(fields: T.StructType, conv: pa.DataType) -> pa.Schema:
    """``fields`` for Arrow; the type of conversations comes from the rows."""

    def kind(of: T.DataType) -> pa.DataType:
        if isinstance(of, T.ArrayType):
            return pa.list_(kind(of.elementType))
        if isinstance(of, T.StructType):
            return pa.struct([(field.name, kind(field.dataType)) for field in of])
        return {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[of.simpleString()]

    return pa.schema([(f.name, conv if f.name == "conv_id" else kind(f.dataType)) for f in fields])


@dataclass(frozen=True)
class Repaired:
    """``conversations``: per ``conv_id`` what was wrong, and the cost and audit of the repair. ``pieces``: the repaired
    turns, as arrays of (role, text, edit) in the order of (part, piece); ``whole`` tells that a conversation has one only."""

    conversations: DataFrame
    pieces: DataFrame


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def repair(turns: DataFrame) -> Repaired:
    """Repair conversations given as rows (conv_id, turn, role, text); see the module for what they may hold."""
    ready(turns.sparkSession)
    schema = _pieces_schema(turns.schema["conv_id"].dataType)
    found, _ = written(_ordered(turns).mapInArrow(_parser(schema), schema), "pieces")

    key = [schema[name] for name in ("conv_id", "part", "piece")]
    totals = [schema[name] for name in (*_COUNTS, "first_turn", "last_turn", "n_turns", "audit")]
    chosen = T.StructType([*key, T.StructField("top", T.IntegerType()), T.StructField("edits", T.StringType()), *totals])
    steps = found.where("open").drop("turns", "roles", "texts", "open", "cost", "audit")
    chains = steps.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    chains, _ = written(chains.mapInArrow(_chained(chosen), chosen), "chains")

    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0).cast("long")).alias("gaps")
    summary = ("conv_id", gaps, *_COUNTS, "audit")
    closed = found.where("not open")
    conversations = closed.select(*summary).unionByName(chains.where("cost is not null").select(*summary))

    turned = T.StructType([*key, schema["turns"]])
    texts = found.where("open").select("part", "piece", "roles", "texts")
    longer = chains.select("conv_id", "part", "piece", "top", "edits").join(texts, ["part", "piece"])
    longer = longer.mapInArrow(_applied(turned), turned)
    pieces = closed.select(*turned.names, F.lit(True).alias("whole"))
    return Repaired(conversations, pieces.unionByName(longer.withColumn("whole", F.lit(False))))


def digests(pieces: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: SHA-256 of the lines ``role:text`` of each repaired conversation.

    A conversation in several pieces is read in order by one task, as its digest must be, which holds one piece at a time.
    """
    line = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    lines = pieces.select("conv_id", "part", "piece", "whole", F.array_join(line, "\n").alias("lines"), F.size("turns").alias("n"))
    short = lines.where("whole").select("conv_id", F.sha2("lines", 256).alias("repaired_sha256"))
    dealt = lines.where("not whole and n > 0").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    schema = T.StructType([pieces.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    return short.unionByName(dealt.select("conv_id", "lines").mapInArrow(_hashed, schema))


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, kind = None, None, None
    for batch in batches:
        kind = batch.schema.field(0).type
        for at in range(batch.num_rows):
            now, lines = (column[at].as_py() for column in batch.columns)
            if digest is not None and now == conv:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield _digest_row(conv, digest, kind)
                conv, digest = now, hashlib.sha256()
            digest.update(lines.encode())
    if digest is not None:
        yield _digest_row(conv, digest, kind)


def _digest_row(conv, digest, kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([conv], kind), pa.array([digest.hexdigest()])]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])
