"""Repair of conversations: the cheapest edits that make the roles of a conversation a legal sequence.

Legal is an optional system row followed by one or more pairs of user and assistant, or nothing. A row may be kept,
given another role or deleted, and empty rows may be inserted; each edit has a cost. The repair is a weighted interval
parse: the grammar below is in Chomsky normal form, one symbol for each pair of places (p, q) in the legal sequence, with
a rule (p, q) -> (p, r) (r, q) for each r. A cell of a span holds, for each symbol, the least (cost, audit) of the edits
that lead from p to q over its rows, where the audit spells the edits' initials. A span of one row is closed under
insertion: rows inserted before and after it are part of its cell. Longer spans are combined from shorter ones bottom-up.
As every symbol can be split after any row, a span needs one split only; spans of 1, 2, 4, … rows are combined like
the digits of a binary counter. Edits of one span with equal cost never have one audit begin another (the rest would be
insertions, which cost), so the least audit of a span is made of least audits of its parts.

Scale: faults are found and rows are brought into order on narrow rows (a hash stands for role and text); the
texts are shuffled once, to meet the audits. A conversation is read as a stream in both steps: a task holds its audits
(eleven letters a row), not its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import slices, staged

#: What counts as white space in a text, and what ends a sentence.
BLANK, STOPS = r"[\x20\x09-\x0D]", ".!?"
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Places in a legal sequence: its start, after the system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Steps of the legal sequence by a role's initial.
STEPS = {
    "s": ((START, SYSTEM),),
    "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)),
    "a": ((USER, ASSISTANT),),
}
#: A cell: (cost, audit) by symbol.
Cell = dict[tuple[int, int], tuple[int, str]]
#: Rows that go through one step of a Python worker.
ROWS_AT_ONCE = 2_000


def _better(cell: Cell, symbol: tuple[int, int], found: tuple[int, str]) -> None:
    if symbol not in cell or found < cell[symbol]:
        cell[symbol] = found


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans, one after the other."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(r, 4) if r < USER else (USER, ASSISTANT):
            rest = right.get((r, q))
            if rest is not None:
                _better(out, (p, q), (cost + rest[0], audit + rest[1]))
    return out


def inserted() -> Cell:
    """The cell of no rows: what insertions alone do."""
    step: Cell = {(p, p): (0, "") for p in range(4)}
    for initial in "ua":
        for symbol in STEPS[initial]:
            step[symbol] = (INSERT, "I")
    return combined(step, step)


def row_cell(initial: str, fault: str) -> Cell:
    """The cell of one row, by its role's initial and its fault, closed under insertion."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in ("blank", "duplicate"):
        more = CUT_OFF if fault == "truncated" else 0
        for wanted in "ua":
            for symbol in STEPS[wanted]:
                _better(cell, symbol, (REROLE + more, "R"))
        for symbol in STEPS.get(initial, ()):
            _better(cell, symbol, (more, "K"))
    return combined(combined(inserted(), cell), inserted())


class Parse:
    """The chart of one conversation, fed row by row."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        rows = 1
        while self.spans and self.spans[-1][0] == rows:
            cell = combined(self.spans.pop()[1], cell)
            rows *= 2
        self.spans.append((rows, cell))

    def best(self) -> tuple[int, str]:
        """(cost, audit) of the whole."""
        if not self.spans:
            return 0, ""
        cell = self.spans[-1][1]
        for _, before in reversed(self.spans[:-1]):
            cell = combined(before, cell)
        return min(cell[symbol] for symbol in ((START, START), (START, ASSISTANT)) if symbol in cell)


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage; a conversation's dropped rows leave one with ``gone`` set.

    The crc32 of ``conv_id:turn`` (nulls: one space) modulo 20 decides: 0 drops the row, 1 empties its text, 2 takes the
    ends of sentences out of it, 3 repeats it, 4 makes it the user's.
    """
    key = F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = _spaced(F.col("text"))
    # rlike keeps translate, which goes letter by letter, from most texts.
    cut = F.when(kind == 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text)
    copies = F.when(kind == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(_spaced(F.col("role"))).alias("role"),
        cut.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """Narrow rows, one conversation after the other, by turn (nulls first), then role, then hash of the text."""
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"
    )


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, n_rows long"


def audits(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of rows (conv_id, turn, role, text, and ``gone`` where a row counts as not there).

    The columns are those of :data:`AUDIT`: the counts of faults, the cost and audit of the cheapest repair (of equally
    cheap ones that with the least audit), and how many rows there are.
    """
    last = F.regexp_extract("text", f"([^\\x20\\x09-\\x0D]){BLANK}*+\\z", 1)
    narrow = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.md5(F.col("text").cast("binary")).alias("digest"),
        "gone",
        F.when(~F.col("text").rlike("[^\\x20\\x09-\\x0D]"), "blank")
        .when(~F.instr(F.lit(STOPS), last).cast("boolean"), "truncated")
        .alias("fault"),
    )
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("gone"), F.col("turn").asc_nulls_first())
    seen = F.row_number().over(same) > 1
    # Dealt by conversation first: the window then needs no shuffle of its own.
    judged = _in_order(
        narrow.repartition("conv_id").withColumn(
            "fault", F.when(F.col("fault") == "blank", "blank").when(seen, "duplicate").otherwise(F.col("fault"))
        )
    ).select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "gone", "fault")
    kind = f"conv_id {dict(rows.dtypes)['conv_id']}, {AUDIT}"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple[str, str], Cell] = {}
        legal = {"su", "ua", "au"}
        out: list[tuple] = []
        chart, of, began, before = Parse(), None, False, ""
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        first = end = None
        turns = n = 0

        def closed() -> tuple:
            gaps = 0 if first is None else end - first + 1 - turns
            return (of, gaps, *counts.values(), *chart.best(), n)

        send, rows_of = _sender(batches, AUDIT)
        for conv, turn, initial, gone, fault in rows_of:
            if not began or conv != of:
                if began:
                    out.append(closed())
                    if len(out) >= ROWS_AT_ONCE:
                        yield send(out)
                        out = []
                chart, of, began, before = Parse(), conv, True, ""
                counts = dict.fromkeys(counts, 0)
                first = end = None
                turns = n = 0
            if gone:
                continue
            if turn is not None:
                first = turn if first is None else first
                turns += turn != end
                end = turn
            n += 1
            if n > 1 and before + initial not in legal:
                counts["illegal"] += 1
            before = initial
            if fault:
                counts[fault] += 1
            cell = cells.get((initial, fault or ""))
            if cell is None:
                cell = row_cell(initial, fault or "")
                if len(cells) < ROWS_AT_ONCE:
                    cells[initial, fault or ""] = cell
            chart.add(cell)
        if began:
            out.append(closed())
        if out:
            yield send(out)

    return judged.mapInArrow(parse, kind)


def _followed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The texts of each conversation in order, each conversation led by a row with its audit."""
    texts = rows.filter("NOT gone").select(
        "conv_id",
        F.lit(1).alias("leads"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.md5(F.col("text").cast("binary")).alias("digest"),
        "text",
    )
    heads = found.select(
        "conv_id",
        F.lit(0).alias("leads"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit("").alias("digest"),
        F.col("audit").alias("text"),
    )
    return (
        heads.unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "leads", F.col("turn").asc_nulls_first(), "role", "digest")
        .select("conv_id", "leads", "turn", "role", "text")
    )


def applied(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, turn, role, text) of a repaired conversation, from its audit and its rows (turn, role, text) in order."""
    place = START
    for edit in audit:
        turn, role, text = (None, "", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if place == USER else "user"
        place = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        yield edit, turn, role, text


def _sender(
    batches: Iterator[pa.RecordBatch], columns: str
) -> tuple[Callable[[list[tuple]], pa.RecordBatch], Iterator[tuple]]:
    """What makes a batch of tuples (conv_id and columns), and the tuples of the batches, some at a time."""
    first = next(batches, None)
    types = {"long": pa.int64(), "string": pa.string()}
    fields = [(name, types[kind]) for name, kind in (c.split() for c in columns.split(", "))]
    schema = pa.schema([("conv_id", pa.null() if first is None else first.schema.field(0).type), *fields])

    def send(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), schema.types, strict=True)],
            schema=schema,
        )

    def tuples() -> Iterator[tuple]:
        for batch in () if first is None else chain([first], batches):
            bounded = slices(batch, "text") if "text" in batch.schema.names else [batch]
            for part in bounded:
                for begin in range(0, part.num_rows, ROWS_AT_ONCE):
                    columns_of = part.slice(begin, ROWS_AT_ONCE).columns
                    yield from zip(*(c.to_pylist() for c in columns_of), strict=True)

    return send, tuples()


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, edit, turn, role, text) of all conversations; edit is null in the row that begins one."""
    for conv, _, _, _, audit in rows:  # a leading row; the audit says how many rows follow it
        yield conv, None, None, None, None
        for edited in applied(audit, (row[2:] for row in rows)):
            yield conv, *edited


EDITED = "place long, edit string, turn long, role string, text string"


def repair_rows(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), turn (null if inserted), role, text.

    ``rows`` holds conv_id, turn, role, text and maybe ``gone`` (rows that are not there); null roles and texts count as
    one space. Rows come by turn, null turns first, and rows of one turn by role, then by a hash of the text. A null
    conv_id is a conversation like any other. Conversations without rows, or whose rows all go, have no rows.
    """
    rows = _prepared(rows)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send, streamed = _sender(batches, EDITED)
        out, place = [], 0
        for conv, edit, turn, role, text in _repaired(streamed):
            if edit is None:
                place = 0
                continue
            out.append((conv, place, edit, turn, role, text))
            place += 1
            if len(out) >= ROWS_AT_ONCE:
                yield send(out)
                out = []
        if out:
            yield send(out)

    kind = f"conv_id {dict(rows.dtypes)['conv_id']}, {EDITED}"
    return _followed(rows, audits(rows) if found is None else found).mapInArrow(edit, kind)


def repair_hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256``: the SHA-256 of ``role:text`` of the repaired rows, joined by newlines."""
    rows = _prepared(rows)
    hashed_as = "repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send, streamed = _sender(batches, hashed_as)
        out: list[tuple] = []
        began, of, hashed, joint = False, None, hashlib.sha256(), b""
        for conv, edit, _, role, text in _repaired(streamed):
            if edit is None:
                if began:
                    out.append((of, hashed.hexdigest()))
                    if len(out) >= ROWS_AT_ONCE:
                        yield send(out)
                        out = []
                began, of, hashed, joint = True, conv, hashlib.sha256(), b""
                continue
            hashed.update(joint + f"{role}:{text}".encode())
            joint = b"\n"
        if began:
            out.append((of, hashed.hexdigest()))
            yield send(out)

    return _followed(rows, found).mapInArrow(digest, f"conv_id {dict(rows.dtypes)['conv_id']}, {hashed_as}")


def _prepared(rows: DataFrame) -> DataFrame:
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    return rows.select(
        "conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"), gone.alias("gone")
    )


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the columns of :data:`AUDIT` and ``repaired_sha256``.

    See :func:`repair_rows` for the rows that are taken. A conversation all of whose rows are ``gone`` has zeros, an
    empty audit and the hash of nothing; a table without rows gives none. Equal rows of a conversation are duplicates of
    the first; other columns of rows play no part.
    """
    rows = _prepared(rows)
    found = staged(audits(rows), "audits")
    hashes = repair_hashes(rows, found)
    same = found["conv_id"].eqNullSafe(hashes["conv_id"])
    return found.join(hashes, same).select(found["*"], hashes["repaired_sha256"])
