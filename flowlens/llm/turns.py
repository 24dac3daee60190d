"""Conversation structure repair by a run-length min-plus program.

A conversation's rows, in order, are faulty or not and have a role. The cheapest edits are sought after which the roles read as an
optional system row and then pairs of user and assistant. Where a repaired conversation stands (at its beginning, behind a system,
user or assistant row) is a state; what a row may do to it depends on its symbol alone, its role and fault. So a symbol is a 4 x 4
matrix of costs whose product adds and takes minima. Equal consecutive symbols are one run; a run is applied through powers of
its matrix by doubling, which tasks keep. Costs are carried from the end to the beginning, and then the edits are read off from the
beginning: of those that keep the cost least, the one whose initial comes first.

Rows are put in order by ranges of (conversation, turn, role, text), so a conversation that holds many rows lies in several ranges. A
range's rows of one conversation are a segment. Segments are solved for each state they may begin in; between them only their matrices
and states travel. Texts are left out of all this; only the last step reads them, to hash what is left of a conversation in order. That
hash is of one text by contract, so a conversation's texts pass one task; they are streamed, none is held.

Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate rows), Insert an empty user or
assistant row 5. A truncated row that is not deleted costs 5 more. Ties go to the audit that is least in ASCII.

Nulls: a null role or text is one space; a null turn comes first; a null conversation is a conversation. Rows that share a turn are
ordered by role, then by the MD5 of the text; equal rows stand together, and all but the first are duplicates. A conversation
without rows has an empty audit. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import shuffle_partitions, small_side, stored, workers_find_package

# Faults of a row, first one first.
SOUND, BLANK_ROW, DUPLICATE, TRUNCATED = range(4)
# States: at the beginning, behind a system, a user, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: What the next repaired row is in each state, and whether a conversation may end there.
FOLLOWS = (USER, USER, ASSISTANT, USER)
MAY_END = (True, False, False, True)
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
NEVER = 1 << 60
#: Roles as they matter: others can be neither kept nor left as they are.
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
#: Repeated texts of a conversation up to this many are sent to every task (about 60 bytes each); more are joined.
BROADCAST_ROWS = 500_000
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

#: Initials of rows that may stand side by side.
LEGAL = ("su", "ua", "au")
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def symbol(role: int, fault: int) -> int:
    """Rows that must go are alike whatever their role."""
    return 0 if fault in (BLANK_ROW, DUPLICATE) else 1 + role + 4 * (fault == TRUNCATED)


def row_edits(sign: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up a row."""
    edits = [("D", DELETE, state)]
    if sign:
        role, extra, follows = (sign - 1) % 4, UNFINISHED * (sign > 4), FOLLOWS[state]
        if role == follows or (role == SYSTEM and state == START):
            edits.append(("K", extra, role))
        if role != follows:
            edits.append(("R", REROLE + extra, follows))
    return edits


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of matrices, or of a matrix and a vector: sums for products and least for sums."""
    return np.minimum((left[:, :, None] + right[None, :, :]).min(axis=1), NEVER) if right.ndim == 2 else np.minimum((left + right).min(axis=1), NEVER)


@cache
def insertions() -> np.ndarray:
    """Cost from each state to each other by inserting rows."""
    cost = np.full((STATES, STATES), NEVER)
    for state in range(STATES):
        at, paid = state, 0
        for _ in range(STATES):
            cost[state, at] = min(cost[state, at], paid)
            at, paid = FOLLOWS[at], paid + INSERT
    return cost


@cache
def power(sign: int, k: int) -> np.ndarray:
    """Costs of 2 ** k rows with one symbol, insertions before each included."""
    if k:
        half = power(sign, k - 1)
        return product(half, half)
    row = np.full((STATES, STATES), NEVER)
    for state in range(STATES):
        for _, cost, after in row_edits(sign, state):
            row[state, after] = min(row[state, after], cost)
    return product(insertions(), row)


def ahead(sign: int, n: int, costs: np.ndarray) -> np.ndarray:
    """Least costs from before a run to the end, from those behind it: a vector, or a matrix for segments."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            costs = product(power(sign, k), costs)
    return costs


def at_end() -> np.ndarray:
    """Least costs behind the last row."""
    final = np.array([0 if ok else NEVER for ok in MAY_END])
    return product(insertions(), final)


def read_off(sign: int, n: int, state: int, behind: np.ndarray, out: list[str]) -> int:
    """Append the edits of a run of n equal rows and give the state behind it. Halves are entered with the costs behind them, so
    the run is unrolled through the kept powers and never as a list of vectors."""
    if n > 1:
        half = 1 << ((n - 1).bit_length() - 1)
        state = read_off(sign, n - half, state, ahead(sign, half, behind), out)
        return read_off(sign, half, state, behind, out)
    here = ahead(sign, 1, behind)
    while True:
        # an insertion leaves the row to come; its initial stands between those of Delete and Keep
        choices = [(initial, cost + behind[after], after, True) for initial, cost, after in row_edits(sign, state)]
        choices.append(("I", INSERT + here[FOLLOWS[state]], FOLLOWS[state], False))
        initial, _, state, done = min(c for c in choices if c[1] == here[state])
        out.append(initial)
        if done:
            return state


def closing(state: int) -> tuple[str, int]:
    """Insertions behind the last row."""
    edits = ""
    while not MAY_END[state]:
        edits, state = edits + "I", FOLLOWS[state]
    return edits, state


# --- rows ------------------------------------------------------------------------------------------


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage of the contract: a row's own hash decides what happens to it."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    what = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    rows = df.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), what.alias("_what")
    ).filter("_what != 0")
    text = F.when(F.col("_what") == 1, "").when(F.col("_what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_what") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_n")).drop("_n")


def looked_at(rows: DataFrame) -> DataFrame:
    """What the order and the faults of a row depend on, without its text."""
    text = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return rows.select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("hash"), (F.length(text) == 0).alias("blank"),
        (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def seen_earlier(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with `later`: their conversation has the role and text at an earlier turn. `known` are the texts at several turns."""
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("hash") == F.col("_hash"))
    first = F.struct(F.col("turn").isNotNull(), F.col("turn")) > F.col("_first")
    return rows.join(known, same, "left").select(*rows.columns, F.coalesce(first, F.lit(False)).alias("later"))


def several_turns(rows: DataFrame) -> DataFrame:
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    held = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("hash").alias("_hash"))
    return held.agg(F.min(when).alias("_first"), F.max(when).alias("_last")).filter("_first < _last").drop("_last")


# --- segments --------------------------------------------------------------------------------------


@dataclass
class Segment:
    """Rows of one conversation that lie in one range, as runs."""

    key: tuple
    rows: int = 0
    signs: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    first: str = ""
    last: str = ""

    def add(self, initial: str, fault: int, times: int) -> None:
        if self.rows and self.last + initial not in LEGAL:
            self.counts[3] += 1
        self.first, self.last = (self.first if self.rows else initial), initial
        sign = symbol(ROLES.get(initial, OTHER), fault)
        if self.signs and self.signs[-1] == sign:
            self.sizes[-1] += times
        else:
            self.signs.append(sign)
            self.sizes.append(times)
        self.rows += times
        if fault:
            self.counts[fault - 1] += times

    def matrix(self) -> np.ndarray:
        costs = np.where(np.eye(STATES, dtype=bool), 0, NEVER)
        for sign, n in zip(reversed(self.signs), reversed(self.sizes), strict=True):
            costs = ahead(sign, n, costs)
        return costs


def read_runs(signs: list[int], sizes: list[int], state: int, behind: np.ndarray) -> tuple[str, int]:
    """Edits of a segment's runs and the state behind them."""
    stops = [behind]
    for sign, n in zip(reversed(signs), reversed(sizes), strict=True):
        stops.append(ahead(sign, n, stops[-1]))
    out: list[str] = []
    for i, (sign, n) in enumerate(zip(signs, sizes, strict=True)):
        state = read_off(sign, n, state, stops[len(signs) - 1 - i], out)
    return "".join(out), state


def segment_schema(conv: str, turn: str) -> str:
    return (
        f"conv_id {conv}, block int, turn {turn}, role string, hash binary, n_rows long, blank long, duplicate long, truncated long, "
        "illegal long, first string, last string, signs array<int>, sizes array<long>, costs array<long>"
    )


def make_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of a range's sorted rows. Equal rows stand together with their number; all but the first are duplicates."""
    held: Segment | None = None
    done: list[Segment] = []
    schema = None

    def out() -> pa.RecordBatch:
        keys = list(zip(*[s.key for s in done], strict=True))
        arrays = [pa.array(k, schema.field(i).type) for i, k in enumerate(keys)]
        arrays.append(pa.array([s.rows for s in done], pa.int64()))
        arrays += [pa.array([s.counts[i] for s in done], pa.int64()) for i in range(4)]
        arrays += [pa.array([s.first for s in done], pa.string()), pa.array([s.last for s in done], pa.string())]
        arrays.append(pa.array([s.signs for s in done], pa.list_(pa.int32())))
        arrays.append(pa.array([s.sizes for s in done], pa.list_(pa.int64())))
        arrays.append(pa.array([s.matrix().ravel() for s in done], pa.list_(pa.int64())))
        names = ["conv_id", "block", "turn", "role", "hash", "n_rows", *COUNTS, "first", "last", "signs", "sizes", "costs"]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        schema = batch.schema
        for conv, block, turn, role, hashed, blank, cut, later, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held is None or held.key[0] != conv:
                if held:
                    done.append(held)
                held = Segment((conv, block, turn, role, hashed))
                if len(done) >= 5000:
                    yield out()
                    done = []
            initial = role[:1]
            fault = BLANK_ROW if blank else DUPLICATE if later else TRUNCATED if cut else SOUND
            held.add(initial, fault, 1)
            again = BLANK_ROW if blank else DUPLICATE
            if times > 1:
                held.add(initial, again, times - 1)
                # between equal rows, too, roles stand side by side
                held.counts[3] += times - 2
    if held:
        done.append(held)
        yield out()


def segments(rows: DataFrame) -> DataFrame:
    """One row for each conversation and range: its runs, matrix, counts, and the key of its first row."""
    spark = rows.sparkSession
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    counted = rows.groupBy("conv_id", "turn", "role", "hash", "blank", "cut", "later").agg(F.count("*").alias("times"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "hash"]
    ranged = counted.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    fields = ["conv_id", F.spark_partition_id().alias("block"), "turn", "role", "hash", "blank", "cut", "later", "times"]
    return stored(ranged.select(*fields).mapInArrow(make_segments, segment_schema(conv, turn)), "turn-segments")


def chain_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the segments of each conversation, last one first: the costs behind each, and the least from its first row on."""
    conv, costs, begun = None, None, False
    for batch in batches:
        behind, total = [], []
        for here, matrix in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not begun or here != conv:
                conv, costs, begun = here, at_end(), True
            behind.append(costs)
            costs = product(np.array(matrix).reshape(STATES, STATES), costs)
            total.append(int(costs[START]))
        arrays = [batch.column(0), batch.column(1), pa.array(behind, pa.list_(pa.int64())), pa.array(total, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "behind", "cost"])


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state a segment can begin in: its edits and the state behind it. A conversation's first one begins at START."""
    for batch in batches:
        edits, after = [], []
        for signs, sizes, behind, opens in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True):
            found = [read_runs(signs, sizes, s, np.array(behind)) for s in range(1 if opens else STATES)]
            edits.append([e for e, _ in found])
            after.append([s for _, s in found])
        arrays = [batch.column(0), batch.column(1), pa.array(edits, pa.list_(pa.string())), pa.array(after, pa.list_(pa.int32())), *batch.columns[6:]]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "edits", "after", "first", "last"])


def chain_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the segments of each conversation in order: the state each begins in, and whether its first row may not follow the row before."""
    conv, state, last, begun = None, START, None, False
    for batch in batches:
        starts, illegal = [], []
        for here, after, first, final in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)], strict=True):
            if not begun or here != conv:
                conv, state, last, begun = here, START, None, True
            starts.append(state)
            illegal.append(int(last is not None and last + first not in LEGAL))
            state, last = after[state], final
        arrays = [batch.column(0), batch.column(1), pa.array(starts, pa.int32()), pa.array(illegal, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "state", "seam"])


def solved(parts: DataFrame) -> DataFrame:
    """The segments with `state`, in which each begins, and its `edits`; `cost` of the whole conversation in its first one, else 0;
    `illegal` with the seam before it. Of a conversation only matrices and states meet in one task, as a stream."""
    spark = parts.sparkSession
    kind = parts.schema["conv_id"].dataType.simpleString()
    n, by_conv = shuffle_partitions(spark), F.col("conv_id").asc()
    same = F.col("conv_id").eqNullSafe(F.col("_of")) & (F.col("block") == F.col("_at"))
    named = {"conv_id": "_of", "block": "_at"}

    back = parts.select("conv_id", "block", "costs").repartition(n, "conv_id").sortWithinPartitions(by_conv, F.col("block").desc())
    costs = back.mapInArrow(chain_back, f"conv_id {kind}, block int, behind array<long>, cost long").withColumnsRenamed(named)
    ends = parts.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("block").alias("_first"), F.max("block").alias("_final"))
    met = parts.join(costs, same).join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")))
    at_first, at_last = F.col("block") == F.col("_first"), F.col("block") == F.col("_final")
    met = met.select(*[c for c in parts.columns if c != "costs"], "behind", F.when(at_first, F.col("cost")).otherwise(F.lit(0).cast("long")).alias("cost"),
                     at_first.alias("opens"), at_last.alias("closes"))
    met = stored(met, "turn-costs")

    rows = met.select("conv_id", "block", "signs", "sizes", "behind", "opens", "first", "last")
    edits = rows.mapInArrow(solve, f"conv_id {kind}, block int, edits array<string>, after array<int>, first string, last string")
    edits = stored(edits, "turn-edits")
    on = edits.select("conv_id", "block", "after", "first", "last").repartition(n, "conv_id").sortWithinPartitions(by_conv, "block")
    begins = on.mapInArrow(chain_on, f"conv_id {kind}, block int, state int, seam long").withColumnsRenamed(named)
    found = edits.select("conv_id", "block", "edits", "after").join(begins, same).select("_of", "_at", "edits", "after", "state", "seam")
    full = met.drop("signs", "sizes", "behind").join(found, same)
    # insertions behind the last row belong to the last segment
    tail = F.element_at(F.lit([closing(s)[0] for s in range(STATES)]), F.get("after", F.col("state")) + 1)
    chosen = F.concat(F.get("edits", F.col("state")), F.when(F.col("closes"), tail).otherwise(F.lit("")))
    keys = ["conv_id", "block", "turn", "role", "hash"]
    return stored(
        full.select(*keys, "state", "cost", *COUNTS[:3], (F.col("illegal") + F.col("seam")).alias("illegal"), chosen.alias("edits")), "turn-solved"
    )


# --- repaired texts ----------------------------------------------------------------------------------


class Repair:
    """Applies a conversation's edits to its rows, one after another, and hashes what is left."""

    def __init__(self):
        self.hash, self.audit, self.edits, self.at, self.state, self.empty = hashlib.sha256(), [], "", 0, START, True

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def insert_here(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self.state, self.at = FOLLOWS[self.state], self.at + 1
            self.write(NAMES[self.state], "")

    def segment(self, edits: str) -> None:
        self.insert_here()
        self.audit.append(edits)
        self.edits, self.at = edits, 0

    def row(self, role: str, text: str) -> None:
        self.insert_here()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit == "K":
            self.state = ROLES[role[0]]
            self.write(role, text)
        elif edit == "R":
            self.state = FOLLOWS[self.state]
            self.write(NAMES[self.state], text)

    def result(self) -> tuple[str, str]:
        self.insert_here()
        return "".join(self.audit), self.hash.hexdigest()


def apply_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, audit, repaired_sha256) from rows in order, each segment's edits before its first row."""
    conv, repair, done = None, None, []
    names = ["conv_id", "audit", "repaired_sha256"]

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], names)

    for batch in batches:
        kind = batch.schema.field(0).type
        for here, role, text, edits in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if repair is None or here != conv:
                if repair:
                    done.append((conv, *repair.result()))
                conv, repair = here, Repair()
                if len(done) >= 5000:
                    yield out()
                    done = []
            if edits is None:
                repair.row(role, text)
            else:
                repair.segment(edits)
    if repair:
        done.append((conv, *repair.result()))
        yield out()


def repaired(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256). The one step that shuffles texts."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    nothing = F.lit(None).cast("string")
    texts = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("hash"), F.lit(1).alias("kind"), "text", nothing.alias("edits"))
    heads = parts.select("conv_id", "turn", "role", "hash", F.lit(0).alias("kind"), nothing.alias("text"), "edits")
    both = texts.unionByName(heads).repartition(shuffle_partitions(rows.sparkSession), "conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "hash", "kind")
    return ordered.select("conv_id", "role", "text", "edits").mapInArrow(apply_edits, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair_rows(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """One row for each conv_id of `everyone`: what is wrong with its `rows` (conv_id, turn, role, text), and its repair."""
    workers_find_package(rows.sparkSession)
    seen = stored(looked_at(rows), "turn-rows")
    known = small_side(stored(several_turns(seen), "turn-texts"), BROADCAST_ROWS)
    parts = solved(segments(seen_earlier(seen, known)))
    turns = seen.groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"), F.count_distinct("turn").alias("n"))
    gaps = turns.select("conv_id", F.coalesce(F.col("b") - F.col("a") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"))
    hashed = repaired(rows, parts)
    columns = ["gaps", *COUNTS, "cost"]
    # one grouping instead of joins: each source gives its columns, the rest adds nothing
    pieces = [everyone.select("conv_id").distinct(), gaps, parts.select("conv_id", *COUNTS, "cost"), hashed]
    filled = [
        p.select("conv_id", *[p[c] if c in p.columns else F.lit(0).cast("long").alias(c) for c in columns],
                 *[p[c] if c in p.columns else F.lit(None).cast("string").alias(c) for c in ("audit", "repaired_sha256")])
        for p in pieces
    ]
    whole = filled[0].unionByName(filled[1]).unionByName(filled[2]).unionByName(filled[3])
    return whole.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in columns], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_HASH)).alias("repaired_sha256"),
    )


def damage_and_repair(df: DataFrame) -> DataFrame:
    """Damage the rows as the contract says, then audit and repair each conversation."""
    return repair_rows(damaged(df), df)
