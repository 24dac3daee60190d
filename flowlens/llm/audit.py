"""Filter interaction audit by wide packed counters.

Five filters, applied in each of their 120 orders, have 600 steps. What a step does to a document follows from the mask of
filters that the document fails and from its two labels. So each of the 128 masks maps to one big integer made of fields of FIELD
bits, one for each step and measure. Tasks add the integers of their documents by part, parts add those of the tasks, and the sum is
cut into fields again. A field counts documents of one part, of which there are fewer than 2^56 (120 orders
add up to a `shapley` below 2^63), so no field reaches the next one.

Words are runs of characters other than ASCII blanks. A null text is empty, a null part is the empty one. Equal texts are found by
their SHA-256 over the whole table: a row fails E if a row with a smaller id has its text, removed or not; a null id is neither
smaller nor larger. Repeated rows count each; rows with one id and text don't make each other duplicates. A document is good or toxic
if any label row of its id says so; without one, or with nulls, it is neither. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import BLANK, let, shuffle_partitions, small_side, stored, workers_find_package

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of one counter.
FIELD = 64
#: Bits of the mask behind the filters'.
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
MASKS = 4 << len(FILTERS)
#: Parts whose counts a task holds before it hands them on.
HELD_PARTS = 1000
#: Texts found again, and labels, up to this many rows are sent to every task (about 40 bytes each); more are joined.
BROADCAST_ROWS = 500_000

PACKED = "part string, packed binary"
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in (*MEASURES, "shapley"))


def failures(text: Column) -> Column:
    """The bits of the filters A to D that a text fails; a projection."""
    words = F.array_remove(F.split(text, f"{BLANK}+", -1), "")
    sizes = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))

    def bits(s: Column) -> Column:
        conditions = (
            s["n"] < 100,
            100 * s["d"].cast("long") < 80 * s["n"].cast("long"),
            100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
            F.rlike(text, F.lit("[#$%&*|]")),
        )
        total = F.lit(0)
        for i, fails in enumerate(conditions):
            total = total + F.when(fails, 1 << i).otherwise(0)
        return total

    return let(sizes, bits)


def masks(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask) of every row. Texts are read once and never shuffled: from then on a row is its id, mask and hash."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        failures(content).alias("fails"), F.unhex(F.sha2(content, 256)).alias("hash"),
    )
    rows = stored(rows, "audit-rows")
    again = rows.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    again = small_side(stored(again.drop("last"), "audit-again"), BROADCAST_ROWS)
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marks = small_side(stored(marks.filter("good OR toxic"), "audit-labels"), BROADCAST_ROWS)
    joined = rows.join(again, "hash", "left").join(marks, "id", "left")
    later = F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    good = F.when(F.col("good"), GOOD).otherwise(0)
    toxic = F.when(F.col("toxic"), TOXIC).otherwise(0)
    return joined.select("part", (F.col("fails") + later + good + toxic).alias("mask"))


@cache
def packed_outcomes() -> list[int]:
    """For every mask, what all steps do to a document with it, as one integer: a field for each step and measure."""
    table = []
    for mask in range(MASKS):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        fields = []
        for order, step in STEPS:
            earlier, here = fails & set(order[: step - 1]), order[step - 1] in fails
            removed = here and not earlier
            fields += [
                not earlier and not here, removed, here and bool(earlier), fails == {order[step - 1]},
                removed and bool(mask & GOOD), removed and bool(mask & TOXIC),
            ]
        table.append(int.from_bytes(np.array(fields, "<u8").tobytes(), "little"))
    return table


def as_bytes(total: int) -> bytes:
    return total.to_bytes(len(STEPS) * len(MEASURES) * FIELD // 8, "little")


def sum_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, packed): the sum of the integers of a task's documents, by part. Equal masks are counted before they are added."""
    integers, totals = packed_outcomes(), {}

    def hand_on() -> pa.RecordBatch:
        sums = [as_bytes(sum(int(n) * integers[m] for m, n in enumerate(counts) if n)) for counts in totals.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(sums, pa.binary())], ["part", "packed"])

    for batch in batches:
        names = batch.column(0).dictionary_encode()
        place, mask = names.indices.to_numpy(), batch.column(1).to_numpy()
        counts = np.bincount(place * MASKS + mask, minlength=len(names.dictionary) * MASKS).reshape(-1, MASKS)
        for name, row in zip(names.dictionary.to_pylist(), counts, strict=True):
            totals[name] = totals[name] + row if name in totals else row
        if len(totals) > HELD_PARTS:
            yield hand_on()
            totals = {}
    if totals:
        yield hand_on()


def unpack(part: str, total: int) -> pa.RecordBatch:
    """The 600 rows of a part."""
    fields = np.frombuffer(as_bytes(total), "<i8").reshape(len(STEPS), len(MEASURES))
    removed = {f: sum(int(row[1]) for (order, step), row in zip(STEPS, fields, strict=True) if order[step - 1] == f) for f in FILTERS}
    columns = [
        pa.array([part] * len(STEPS), pa.string()), pa.array([o for o, _ in STEPS], pa.string()),
        pa.array([s for _, s in STEPS], pa.int32()), *[pa.array(fields[:, i], pa.int64()) for i in range(len(MEASURES))],
        pa.array([removed[o[s - 1]] for o, s in STEPS], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *MEASURES, "shapley"])


def sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the integers of each part, which come one after another, and unpack the sum."""
    part, total = None, 0
    for batch in batches:
        for name, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if part is not None and name != part:
                yield unpack(part, total)
                total = 0
            part, total = name, total + int.from_bytes(packed.as_py(), "little")
    if part is not None:
        yield unpack(part, total)


def audit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, counts of MEASURES, shapley): one row for each part, order and step."""
    spark = df.sparkSession
    workers_find_package(spark)
    sums = masks(df, labels, doc_id, text, part).mapInArrow(sum_tasks, PACKED)
    by_part = sums.repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part")
    return by_part.mapInArrow(sum_parts, RESULT)
