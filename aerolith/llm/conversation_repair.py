"""Conversation structure repair by the auction shortest-path algorithm.

A conversation's rows, by turn, are edited until the initials of their roles
read (s?(ua)+)?: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert
of an empty user or assistant row 5, and a truncated row that stays 5 more.
Blank rows and repeats of an earlier role and text have to be deleted.

Lattice. A node is (rows passed, what was said last: nothing, system, user or
assistant), an arc is one edit. Blocks of eight rows are solved from the last to
the first: a block's exits carry the exact costs from there on.

Auction. Every node has a price. A path starts at an entry; if its last node's
price is below the cheapest arc's cost plus the price beyond, the price rises to
that and the path contracts by one node, otherwise it extends along that arc. At
the sink the price of the entry is its exact cost. Prices never exceed cost plus
price beyond on any arc, so all cheapest paths consist of tight arcs (price =
cost + price beyond); they are followed by the least initial, through nodes from
which tight arcs lead on to the sink. A state and an edit have one successor, so
this is the least of all cheapest audits. Solved blocks are kept in a bounded table.

Long conversations (over `LONG_ROWS` rows or `LONG_BYTES` of text) take another
way to the same result: equal rows are counted first, repeats are found by an
aggregate, one byte per row goes through the lattice, and the texts pass in order
a second time for the repaired lines. Nothing but the audit, which the result
holds as one value, is kept whole.

Null roles and texts count as one space, a null turn comes first, a null id is a
conversation of its own. Rows of one turn are ordered by role, then text; equal
rows are neighbours, the later ones repeats. Empty tables give no rows. Columns
other than the four named ones are not read. Texts have no length limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.common import slices, written

SPACE = " \t\n\x0b\x0c\r"
BLOCK = 8
KEPT = 100_000
LONG_ROWS = 4096
LONG_BYTES = 4 << 20
MANY = 1_000_000
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 3  # initial classes: s, u, a, other
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # a row's code is 4 * initial class + fault
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def edits(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of one row."""
    role, fault = divmod(code, 4)
    yield "D", 2, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = 5 if fault == TRUNCATED else 0
    reply = ASSISTANT if state == USER else USER
    yield "R", 1 + extra, reply
    if (role, state) == (0, START):
        yield "K", extra, SYSTEM
    elif (role == 1 and reply == USER) or (role == 2 and reply == ASSISTANT):
        yield "K", extra, reply


class Block:
    """A few rows' lattice with the costs beyond its exits, solved for all four entries."""

    def __init__(self, codes: bytes, exits: tuple, last: bool):
        n = len(codes)
        self.n, self.sink = n, 4 * (n + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []
        for at in range(n + 1):
            for state in range(4):
                out = []
                if at < n:
                    out = [(e, c, 4 * (at + 1) + to) for e, c, to in edits(codes[at], state)]
                elif exits[state] is not None:
                    out = [("", exits[state], self.sink)]
                if at < n or last:
                    out.append(("I", 5, 4 * at + (ASSISTANT if state == USER else USER)))
                self.arcs.append(out)
        self.prices = [0] * (self.sink + 1)
        for entry in range(4):
            self.auction(entry)
        self.costs = self.prices[:4]
        self.paths: dict[int, tuple[str, int]] = {}

    def auction(self, entry: int) -> None:
        """Raise prices until the path from the entry reaches the sink."""
        prices, arcs, path = self.prices, self.arcs, [entry]
        while path[-1] != self.sink:
            node = path[-1]
            level, beyond = min((cost + prices[to], to) for _, cost, to in arcs[node])
            if prices[node] < level:
                prices[node] = level
                if len(path) > 1:
                    path.pop()
            else:
                path.append(beyond)

    def least_path(self, entry: int) -> tuple[str, int]:
        """The least initials among the tight paths from an entry, and the state they end in."""
        if entry not in self.paths:
            dead: set[int] = set()
            nodes, letters = [entry], []
            while nodes[-1] != self.sink:
                node = nodes[-1]
                tight = sorted(
                    (e, to) for e, cost, to in self.arcs[node]
                    if to not in dead and self.prices[node] == cost + self.prices[to]
                )
                if tight:
                    letters.append(tight[0][0])
                    nodes.append(tight[0][1])
                else:
                    dead.add(nodes.pop())
                    letters.pop()
            self.paths[entry] = "".join(letters), nodes[-2] % 4
        return self.paths[entry]


class Solver:
    """Cheapest edits of whole conversations; blocks met before are looked up."""

    def __init__(self):
        self.known: dict[tuple, Block] = {}

    def block(self, codes: bytes, exits: tuple, last: bool) -> Block:
        key = codes, exits, last
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KEPT:
                self.known.clear()
            found = self.known[key] = Block(codes, exits, last)
        return found

    def solve(self, codes: bytes) -> tuple[int, str]:
        """(cost, audit) of the rows with these codes."""
        starts = list(range(0, len(codes), BLOCK)) or [0]
        exits, total, blocks = (0, None, None, 0), 0, []
        for at in reversed(starts):
            block = self.block(codes[at : at + BLOCK], exits, at == starts[-1])
            low = min(block.costs)
            total += low
            exits = tuple(c - low for c in block.costs)
            blocks.append(block)
        state, audit = START, []
        for block in reversed(blocks):
            letters, state = block.least_path(state)
            audit.append(letters)
        return total + exits[START], "".join(audit)


class Tally:
    """Codes and counts of one conversation whose rows arrive in order."""

    def __init__(self):
        self.codes = bytearray()
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turn, code: int) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1

    def report(self, solver: Solver) -> dict:
        codes = bytes(self.codes)
        faults, roles = codes.translate(FAULTS), codes.translate(ROLES)
        legal = sum(count_pairs(roles, pair) for pair in (b"\0\1", b"\1\2", b"\2\1"))
        cost, audit = solver.solve(codes) if codes else (0, "")
        return {
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns,
            "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED),
            "illegal": max(0, len(codes) - 1) - legal,
            "cost": cost,
            "audit": audit,
        }


FAULTS = bytes(b % 4 for b in range(256))
ROLES = bytes(b // 4 for b in range(256))


def count_pairs(roles: bytes, pair: bytes) -> int:
    """Neighbours equal to `pair`, whose two bytes differ."""
    return roles.count(pair)


class Replay:
    """Applies an audit to rows that arrive in order; gives the rows of the repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self.reply(), ""

    def reply(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Rows said up to and with the next row of the conversation."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield edit, self.reply(), text
        elif edit == "K":
            if role[:1] == "s":
                self.state = SYSTEM
            else:
                self.reply()
            yield edit, role, text


class Digests:
    """Output of one row per conversation: its report and the hash of its repaired lines."""

    ddl = f"{REPORT}, repaired_sha256 string"

    def __init__(self):
        self.hash = None

    def start(self) -> None:
        self.hash, self.first = hashlib.sha256(), True

    def line(self, edit: str, role: str, text: str) -> list[dict]:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False
        return []

    def end(self, report: dict) -> list[dict]:
        return [{**report, "repaired_sha256": self.hash.hexdigest()}]


class Lines:
    """Output of the repaired rows themselves."""

    ddl = "step int, edit string, role string, text string"

    def start(self) -> None:
        self.step = 0

    def line(self, edit: str, role: str, text: str) -> list[dict]:
        self.step += 1
        return [{"step": self.step - 1, "edit": edit, "role": role, "text": text}]

    def end(self, report: dict) -> list[dict]:
        return []


def bare_code(role: Column, text: Column) -> Column:
    """Code of a row as far as it shows without the other rows."""
    kept = F.rtrim(text, F.lit(SPACE))
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = F.when(kept == "", BLANK).when(F.substring(kept, -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return (4 * kind + fault).cast("int")


def damaged(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """df with its rows damaged by the hash of id and turn; `copies` tells how often a row stands there."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col)]
    kind = F.crc32(F.concat_ws(":", *named)) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return df.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield from part.to_pylist()


def emitted(made: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, size = [], 0
    for row in made:
        held.append(row)
        size += 64 + sum(len(v) for v in row.values() if isinstance(v, str))
        if size > 1 << 21:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def by_conversation(rows: Iterator[dict]) -> Iterator[tuple[bool, dict]]:
    """(is the first row of its conversation, row) for rows sorted by conv_id."""
    known, before = False, None
    for row in rows:
        yield not known or row["conv_id"] != before, row
        known, before = True, row["conv_id"]


def solve_short(rows: Iterator[dict], output) -> Iterator[dict]:
    """Output rows of conversations that fit in memory, from rows sorted by conversation, turn, role and text."""
    solver = Solver()

    def finish(conv_id, held: list[dict]) -> Iterator[dict]:
        tally, seen, said = Tally(), set(), []
        for row in held:
            for _ in range(row["copies"]):
                code, line = row["code"], (row["role"], row["text"])
                if code % 4 != BLANK and line in seen:
                    code = code - code % 4 + DUPLICATE
                seen.add(line)
                tally.add(row["turn"], code)
                said.append(line)
        report = tally.report(solver)
        output.start()
        replay = Replay(report["audit"])
        for role, text in said:
            for line in replay.row(role, text):
                yield from with_id(conv_id, output.line(*line))
        for line in replay.inserted():
            yield from with_id(conv_id, output.line(*line))
        yield from with_id(conv_id, output.end(report))

    held: list[dict] = []
    for new, row in by_conversation(rows):
        if new and held:
            yield from finish(held[0]["conv_id"], held)
            held = []
        held.append(row)
    if held:
        yield from finish(held[0]["conv_id"], held)


def with_id(conv_id, made: list[dict]) -> Iterator[dict]:
    for row in made:
        yield {"conv_id": conv_id, **row}


def report_long(rows: Iterator[dict]) -> Iterator[dict]:
    """Reports of conversations of any length, from sorted rows without texts; one byte per row is held."""
    solver, tally, conv_id = Solver(), None, None
    for new, row in by_conversation(rows):
        if new:
            if tally is not None:
                yield {"conv_id": conv_id, **tally.report(solver)}
            tally, conv_id = Tally(), row["conv_id"]
        again = row["code"] if row["code"] % 4 == BLANK else row["code"] - row["code"] % 4 + DUPLICATE
        for k in range(row["copies"]):
            tally.add(row["turn"], again if k or row["repeated"] else row["code"])
    if tally is not None:
        yield {"conv_id": conv_id, **tally.report(solver)}


def replay_long(rows: Iterator[dict], output) -> Iterator[dict]:
    """Output rows of long conversations: each one's report comes first, then its rows in order."""
    replay = report = None

    def finish() -> Iterator[dict]:
        for line in replay.inserted():
            yield from with_id(report["conv_id"], output.line(*line))
        yield from with_id(report["conv_id"], output.end({k: report[k] for k in REPORT_NAMES}))

    for new, row in by_conversation(rows):
        if new:
            if replay is not None:
                yield from finish()
            replay, report = Replay(row["audit"]), row
            output.start()
            continue
        for _ in range(row["copies"]):
            for line in replay.row(row["role"], row["text"]):
                yield from with_id(row["conv_id"], output.line(*line))
    if replay is not None:
        yield from finish()


REPORT_NAMES = [part.split()[0] for part in REPORT.split(", ")]


def streamed(df: DataFrame, ddl: str, make: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """Rows made from the rows of each partition in their order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType)])
    for field in T.StructType.fromDDL(ddl).fields:
        schema = schema.add(field)
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: emitted(make(arrow_rows(batches)), arrow), schema)


def repaired(df: DataFrame, output, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """`output` of all conversations of rows (conv_id, turn, role, text[, copies])."""
    copies = F.col("copies") if "copies" in df.columns else F.lit(1)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                     copies.alias("copies"))
    coded = rows.withColumn("code", bare_code(F.col("role"), F.col("text")))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]

    sizes = rows.groupBy("conv_id").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("bytes")
    )
    long = written(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("conv_id"), "long")
    n_long = long.count()
    if n_long == 0:
        return streamed(coded.repartition("conv_id").sortWithinPartitions(*order), output.ddl,
                        lambda found: solve_short(found, output))
    found_long = F.broadcast(long) if n_long <= MANY else long
    match = coded["conv_id"].eqNullSafe(found_long["conv_id"])
    short = coded.join(found_long, match, "left_anti").repartition("conv_id").sortWithinPartitions(*order)
    made = streamed(short, output.ddl, lambda found: solve_short(found, output))

    units = written(
        coded.join(found_long, match, "left_semi").where("copies > 0")
        .groupBy("conv_id", "turn", "role", "text", "code").agg(F.sum("copies").alias("copies")), "units"
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = units.groupBy("conv_id", "role", "text").agg(F.min(place).alias("first")).select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "first"
    )
    flagged = units.join(
        first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    ).withColumn("repeated", place != F.col("first"))
    sorted_units = flagged.repartition("conv_id").sortWithinPartitions(*order)
    light = sorted_units.select("conv_id", "turn", F.lit("").alias("text"), "code", "copies", "repeated")
    reports = written(streamed(light, REPORT, report_long), "reports")
    lines = reports.select("conv_id", F.lit(0).alias("kind"), *REPORT_NAMES).unionByName(
        units.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies"), allowMissingColumns=True
    )
    again = lines.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order[1:])
    return made.unionByName(streamed(again, output.ddl, lambda found: replay_long(found, output)))


def reports(df: DataFrame, **limits) -> DataFrame:
    """One row per conversation: faults, cost, audit and the hash of its repaired lines.

    A conversation whose rows all have no copies gets zeros, an empty audit and the hash of an empty string.
    """
    return repaired(df, Digests(), **limits)


def repaired_rows(df: DataFrame, **limits) -> DataFrame:
    """The repaired conversations: conv_id, step, edit, role, text."""
    return repaired(df, Lines(), **limits)
