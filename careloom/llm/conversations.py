"""Repair of the structure of conversations: the cheapest edits, found depth first with bounds and tables of dominance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, prepare, stage

WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
RELABEL_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
# rows of a conversation that are searched at a time; a longer one is put together from pieces
PIECE = 128
# what has been kept so far: nothing, the system's turn only, up to a user's turn, up to an assistant's turn
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
AWAITED = "uuau"
AFTER = (USER, USER, ASSISTANT, USER)
ENDS = (NOTHING, ASSISTANT)
INFINITE = 1 << 60


def _bounds(initials: str, faults: str, ends: tuple[int, ...], trailing: bool) -> list[tuple[int, int]]:
    """For every row, what the rows from it on cost at least, if a user's turn is awaited and if an assistant's is.

    Looser than the rules in one thing only: a system's turn may be kept wherever a user's is awaited.
    """
    last = [0 if any(AWAITED[s] == w for s in ends) else INFINITE for w in "ua"]
    if trailing:
        last = [min(last[0], INSERT_COST + last[1]), min(last[1], INSERT_COST + last[0])]
    out = [(last[0], last[1])]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        user, other = out[-1]
        costs = [DELETE_COST + user, DELETE_COST + other]
        if fault in (SOUND, TRUNCATED):
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            costs[0] = min(costs[0], extra + (other if initial == "u" else user if initial == "s" else INFINITE), extra + RELABEL_COST + other)
            costs[1] = min(costs[1], extra + (user if initial == "a" else INFINITE), extra + RELABEL_COST + user)
        out.append((min(costs[0], INSERT_COST + costs[1]), min(costs[1], INSERT_COST + costs[0])))
    return out[::-1]


def cheapest(initials: str, faults: str, entry: int = NOTHING, ends: tuple[int, ...] = ENDS, trailing: bool = True) -> tuple[int, str, int] | None:
    """Cost, audit and last state of the cheapest edits, of equal costs the ASCII-least audit; None if there are none.

    Depth-first branch and bound on a stack.  A node is a row and a state; its table keeps the best prefix (cost,
    audit) that came there, which all others lose to, since no audit of a node continues another of the same cost.
    A prefix also ends where its cost and the bound of the rows to come exceed the incumbent, or equal it with
    letters that are greater already.  The stack is empty when the incumbent is proved.
    """
    size, bounds = len(initials), _bounds(initials, faults, ends, trailing)
    best: tuple[int, str] | None = None
    last = entry
    table: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if table[at, state] < (cost, audit):
            continue
        if best is not None and _beyond(cost + bounds[at][state == USER], audit, best):
            continue
        if at == size and state in ends and (best is None or (cost, audit) < best):
            best, last = (cost, audit), state
        steps = [(at, AFTER[state], cost + INSERT_COST, "I")] if at < size or trailing else []
        if at < size:
            initial, fault = initials[at], faults[at]
            steps.append((at + 1, state, cost + DELETE_COST, "D"))
            if fault in (SOUND, TRUNCATED):
                kept = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
                if initial == AWAITED[state]:
                    steps.append((at + 1, AFTER[state], kept, "K"))
                elif initial == "s" and state == NOTHING:
                    steps.append((at + 1, SYSTEM, kept, "K"))
                steps.append((at + 1, AFTER[state], kept + RELABEL_COST, "R"))
        hopeful = []
        for row, to, price, letter in steps:
            bound, prefix = price + bounds[row][to == USER], audit + letter
            if bound >= INFINITE or (best is not None and _beyond(bound, prefix, best)):
                continue
            known = table.get((row, to))
            if known is None or (price, prefix) < known:
                table[row, to] = (price, prefix)
                hopeful.append((bound, letter, (row, to, price, prefix)))
        # the most hopeful is on top
        stack += [step for _, _, step in sorted(hopeful, reverse=True)]
    return None if best is None else (*best, last)


def _beyond(bound: int, prefix: str, best: tuple[int, str]) -> bool:
    return bound > best[0] or (bound == best[0] and prefix > best[1][: len(prefix)])


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """Role and text of what the edits of an audit leave, from a state on."""
    row = 0
    for letter in audit:
        if letter == "I":
            yield ROLES[AWAITED[state]], ""
            state = AFTER[state]
            continue
        if letter == "K":
            yield roles[row], texts[row]
            state = SYSTEM if roles[row][0] == "s" else AFTER[state]
        elif letter == "R":
            yield ROLES[AWAITED[state]], texts[row]
            state = AFTER[state]
        row += 1


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with planted faults, by ``crc32(id:turn) % 20``: 0 drops a row, 1 empties its text, 2 takes its ``[.!?]``
    away, 3 repeats it, 4 makes its role user.  A null counts as one space; ids and turns stay null."""
    ident, turn = F.col(f"`{id_col}`"), F.col(f"`{turn_col}`")
    named = F.concat(F.coalesce(ident.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    fault = F.crc32(named.cast("binary")) % 20
    role, text = _spaced(role_col), _spaced(text_col)
    role = F.when(fault == 4, "user").otherwise(role)
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return rows.where(fault != 0).select(ident.alias(id_col), turn.alias(turn_col), role.alias(role_col), text.alias(text_col), copies).drop("copy")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


SUMS = ["blank", "duplicate", "truncated", "illegal", "turns"]
PIECE_COLUMNS = "part BIGINT, seq BIGINT, whole BOOLEAN, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, turns BIGINT, first_turn BIGINT, last_turn BIGINT, initials STRING, faults STRING, cost BIGINT, audit STRING, roles ARRAY<STRING>, texts ARRAY<STRING>"


class _Piece:
    """Rows of a conversation that follow each other."""

    def __init__(self, conv):
        self.conv, self.turns, self.roles, self.texts, self.faults = conv, [], [], [], []

    def row(self, part: int, seq: int, whole: bool) -> tuple:
        initials = "".join(r[:1] or " " for r in self.roles)
        faults = "".join(self.faults)
        known = [t for t in self.turns if t is not None]
        sums = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        sums += [sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), len(set(known))]
        cost, audit, roles, texts = None, None, self.roles, self.texts
        if whole:
            cost, audit, _ = cheapest(initials, faults)
            left = list(repaired(self.roles, self.texts, audit, NOTHING))
            roles, texts = [r for r, _ in left], [t for _, t in left]
        return (self.conv, part, seq, whole, *sums, known[0] if known else None, known[-1] if known else None, initials, faults, cost, audit, roles, texts)


def _pieces(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Pieces of conversations in order of ``part`` and ``seq``; a conversation that is one piece is repaired already."""
    kind = ddl_type(rows, id_col)
    plain = rows.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), _spaced(role_col).alias("role"), _spaced(text_col).alias("text"))
    plain = plain.withColumn("digest", F.when(F.trim("text", F.lit(WHITE)) != "", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    # where a role and text come again, the first turn that has them
    met = plain.where("digest IS NOT NULL").groupBy(F.col("conv").alias("met_conv"), F.col("digest").alias("met_digest"))
    met = met.agg(F.count("*").alias("n"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unknown")).where("n > 1")
    met = stage(met.select("met_conv", "met_digest", F.when(~F.col("unknown"), F.col("first")).alias("first"), F.lit(True).alias("again")), "met-again")
    joined = plain.join(met, F.col("conv").eqNullSafe(F.col("met_conv")) & (F.col("digest") == F.col("met_digest")), "left")
    later = F.coalesce(F.col("again") & ~F.col("turn").eqNullSafe(F.col("first")), F.lit(False))
    joined = joined.select("conv", "turn", "role", "text", later.alias("later"))
    order = ["conv", F.asc_nulls_first("turn"), "role"]
    dealt = joined.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, made, size = TaskContext.get().partitionId(), 0, [], 0
        piece: _Piece | None = None
        before, opened, id_type = None, True, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, turn, role, text, later in zip(*(c.to_pylist() for c in batch.columns)):
                fresh = piece is None or piece.conv != conv
                if fresh or len(piece.roles) >= PIECE:
                    if piece is not None:
                        made.append(piece.row(part, seq, fresh and not opened))
                        seq += 1
                        # the first conversation of a part may have begun in the one before
                        opened = not fresh
                    piece = _Piece(conv)
                    before = None if fresh else before
                end = text.rstrip(WHITE)
                row = (turn, role, text)
                fault = BLANK if not end else DUPLICATE if later or row == before else TRUNCATED if end[-1] not in ".!?" else SOUND
                for column, value in zip((piece.turns, piece.roles, piece.texts, piece.faults), (*row, fault)):
                    column.append(value)
                before = row
                size += len(text)
                if len(made) >= 256 or (made and size >= 1 << 22):
                    yield _rows(made, id_type)
                    made, size = [], 0
        if piece is not None:
            made.append(piece.row(part, seq, False))
            yield _rows(made, id_type)

    return stage(dealt.mapInArrow(cut, f"conv {kind}, {PIECE_COLUMNS}"), "pieces")


_KINDS = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
_NAMES = ["conv", *[c.split()[0] for c in PIECE_COLUMNS.split(", ")]]


def _rows(made: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), [id_type, *_KINDS])], _NAMES)


def _routes(pieces: DataFrame) -> DataFrame:
    """``(part, seq, entry, audit, cost, end)`` of the pieces of conversations of several: how each is entered and edited at the least cost.

    A piece gives the least cost from every state to every other, and the order of these audits; inserts stand before
    rows, so of two audits of a piece none continues the other and the first piece in which routes differ decides.
    A conversation is put together from these numbers only, 256 bytes for ``PIECE`` rows.
    """

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for part, seq, initials, faults in zip(*(c.to_pylist() for c in batch.columns)):
                found = [[cheapest(initials, faults, e, (x,), trailing=False) for x in STATES] for e in STATES]
                ranks = [sorted(f[1] for f in row if f) for row in found]
                made.append((part, seq, [f[0] if f else -1 for row in found for f in row], [ranks[e].index(f[1]) if f else -1 for e, row in enumerate(found) for f in row], [f[1] if f else None for row in found for f in row]))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), kinds)], ["part", "seq", "costs", "ranks", "audits"])

    several = pieces.where("NOT whole")
    tables = several.select("part", "seq", "initials", "faults").mapInArrow(table, "part BIGINT, seq BIGINT, costs ARRAY<BIGINT>, ranks ARRAY<BIGINT>, audits ARRAY<STRING>")
    tables = stage(tables, "piece-tables")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield _chosen(held)
                    held = []
                held.append(row)
        if held:
            yield _chosen(held)

    ordered = several.select("conv", "part", "seq").join(tables, ["part", "seq"]).select("conv", "part", "seq", "costs", "ranks")
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    chosen = ordered.mapInArrow(route, "part BIGINT, seq BIGINT, entry BIGINT, exit BIGINT, cost BIGINT, end STRING")
    chosen = chosen.join(tables.select("part", "seq", "audits"), ["part", "seq"])
    return stage(chosen.select("part", "seq", "entry", "cost", "end", F.element_at("audits", (4 * F.col("entry") + F.col("exit") + 1).cast("int")).alias("audit")), "routes")


def _chosen(held: list[tuple]) -> pa.RecordBatch:
    """The cheapest route through the pieces of a conversation."""
    closing = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    ahead = [[INSERT_COST * len(closing[s]) for s in STATES]]
    for _, _, _, costs, _ in reversed(held):
        ahead.append([min([costs[4 * e + x] + ahead[-1][x] for x in STATES if costs[4 * e + x] >= 0], default=INFINITE) for e in STATES])
    ahead.reverse()
    state, made = NOTHING, []
    for k, (_, part, seq, costs, ranks) in enumerate(held):
        ways = [(ranks[4 * state + x], x) for x in STATES if costs[4 * state + x] >= 0 and costs[4 * state + x] + ahead[k + 1][x] == ahead[k][state]]
        to = min(ways)[1]
        made.append((part, seq, state, to, costs[4 * state + to], closing[to] if k == len(held) - 1 else ""))
        state = to
    kinds = [pa.int64()] * 5 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), kinds)], ["part", "seq", "entry", "exit", "cost", "end"])


class Repairs:
    """What the cheapest edits make of conversations: ``summary`` has a row for each, ``turns`` the repaired turns.

    A conversation's rows stand by turn, null turns first, and those of one turn by role and text.  A row's fault is
    that it is blank, else that role and text came before in its conversation, else that it is truncated: its last
    character that is no white space is not one of ``.!?``.  Kept rows cost 0, those with a new role (user or
    assistant) 1, deleted ones 2, and blank and duplicate ones have to be deleted; an inserted turn without text costs
    5, and so does a truncated row that stays.  The cheapest edits that leave the initials ``(s?(ua)+)?`` are chosen;
    their initials are the audit, and of equal costs it is the ASCII-least.

    Rows are dealt by ranges of conversation, turn and role, so one of any size is spread over tasks, and each task
    goes along its range once.  Conversations that lie within a range and have up to ``PIECE`` rows are done there;
    the pieces of others are searched from every state to every other and put together from their costs.  Only a
    conversation's text digest needs its turns in one task, one after the other and none held.

    Null ids are one conversation; null roles and texts count as one space; an empty role has no initial and is never
    kept; repeated rows are duplicates; other columns are not looked at; an empty table gives no rows.
    """

    def __init__(self, rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        prepare(rows.sparkSession)
        self.id_col, self.kind = id_col, ddl_type(rows, id_col)
        self.pieces = _pieces(rows, id_col, turn_col, role_col, text_col)
        self.routes = _routes(self.pieces)

    def _several(self) -> DataFrame:
        return self.pieces.where("NOT whole").drop("cost", "audit").join(self.routes, ["part", "seq"])

    def summary(self) -> DataFrame:
        """``(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``; the digest is that of ``role:text`` of the repaired turns, one a line."""
        gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
        lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
        counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        whole = self.pieces.where("whole").select("conv", gaps.cast("bigint").alias("gaps"), *counts, F.sha2(lines, 256).alias("repaired_sha256"))

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = None
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if own is None or own.conv != row[0]:
                        if own is not None:
                            yield own.row(batch.schema.field(0).type)
                        own = _Sum(row[0])
                    own.add(*row[1:])
            if own is not None:
                yield own.row(batch.schema.field(0).type)

        columns = ["conv", *SUMS, "first_turn", "last_turn", "initials", "roles", "texts", "entry", "cost", "audit", "end"]
        ordered = self._several().repartition("conv").sortWithinPartitions("conv", "part", "seq").select(*columns)
        schema = f"conv {self.kind}, gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING, repaired_sha256 STRING"
        return whole.unionByName(ordered.mapInArrow(add_up, schema)).withColumnRenamed("conv", self.id_col)

    def turns(self) -> DataFrame:
        """``(id, part, seq, place, role, text)``: the repaired turns, which stand in the order of part, seq and place."""
        plain = self.pieces.where("whole").select("conv", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn"))
        plain = plain.select("conv", "part", "seq", F.col("place").cast("bigint").alias("place"), F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for conv, part, seq, roles, texts, audit, entry in zip(*(c.to_pylist() for c in batch.columns)):
                    left = list(repaired(roles, texts, audit, entry))
                    if left:
                        made = [(conv, part, seq, k, *turn) for k, turn in enumerate(left)]
                        kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), kinds)], ["conv", "part", "seq", "place", "role", "text"])

        edited = self._several().select("conv", "part", "seq", "roles", "texts", F.concat("audit", "end").alias("audit"), "entry")
        several = edited.mapInArrow(apply, f"conv {self.kind}, part BIGINT, seq BIGINT, place BIGINT, role STRING, text STRING")
        return plain.unionByName(several).withColumnRenamed("conv", self.id_col)


class _Sum:
    """A conversation put together from its pieces."""

    def __init__(self, conv):
        self.conv, self.sums, self.cost, self.audit, self.digest, self.lines = conv, [0] * len(SUMS), 0, [], hashlib.sha256(), 0
        self.first = self.last = None
        self.initial = ""

    def add(self, *values) -> None:
        sums, (first, last, initials, roles, texts, entry, cost, audit, end) = values[: len(SUMS)], values[len(SUMS) :]
        self.sums = [a + b for a, b in zip(self.sums, sums)]
        if self.initial and self.initial + initials[0] not in LEGAL:
            self.sums[3] += 1
        self.initial = initials[-1]
        if first is not None:
            self.sums[4] -= first == self.last
            self.first = first if self.first is None else self.first
            self.last = last
        self.cost += cost + INSERT_COST * len(end)
        self.audit.append(audit + end)
        for role, text in repaired(roles, texts, audit + end, entry):
            self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
            self.lines += 1

    def row(self, id_type: pa.DataType) -> pa.RecordBatch:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.sums[4]
        values = (self.conv, gaps, *self.sums[:4], self.cost, "".join(self.audit), self.digest.hexdigest())
        kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])
