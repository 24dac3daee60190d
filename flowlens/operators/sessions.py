"""Session windows that survive a session holding a large part of all rows.

A session is one (src_port, dst_port, protocol). Ordinary sessions go through one exchange on the session key and a window. Where
a probe of the keys finds a session too large for one task, all rows are sorted once by ranges of (session, order, tie) instead, so a
session of any size, even one of a single second, lies in as many ranges as its rows need; nothing is counted or cut on the driver.
Each range is streamed in order:

- a row's last three rows come from its own range, but for the first three rows of a range. Those are seen again together with the
  last three rows of every range (the halo): a window over these few rows gives each its last three, across ranges of one row as well;
- a session that begins and ends within a range is done there. The first and the last one of a range, and one that outgrows the
  buffer, are left open, aggregated by key from what was written, and joined back.

The probe only chooses the way; both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, workers_find_package

SESSION_KEYS = ("src_port", "dst_port", "protocol")
FRAME = 3
#: Open sessions up to this many are sent to every task; more are joined. There are two for each range, and rows / buffer_rows.
BROADCAST_SESSIONS = 500_000

ROLLING = ("prev_bytes_mean_3", "prev_packet_mean_3", "prev_event_count_3")
TOTALS = ("session_bytes_max", "session_bytes_min", "session_packet_mean")
_PLACE = "_block int, _row long, _head boolean, _edge boolean, _open boolean"


@dataclass(frozen=True)
class SkewOptions:
    """`hot_rows`: rows one task may sort for one session. `probe_fraction`: share of keys probed. `ranges`: how many
    (default: the session's shuffle partitions). `buffer_rows`: rows of a session that a task holds at once."""

    hot_rows: int = 5_000_000
    probe_fraction: float = 0.01
    seed: int = 42
    ranges: int | None = None
    buffer_rows: int = 1 << 16


def has_hot_session(df: DataFrame, keys: tuple[str, ...], options: SkewOptions) -> bool:
    """Whether some session is estimated to hold more than `hot_rows` rows: one number comes back."""
    probe = df.select(*keys)
    if options.probe_fraction < 1.0:
        probe = probe.sample(options.probe_fraction, seed=options.seed)
    largest = probe.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return largest / min(1.0, options.probe_fraction) > options.hot_rows


def _ascending(name: str) -> Column:
    return F.col(name).asc_nulls_first()


def rolling_columns(frame) -> dict[str, Column]:
    return {
        "prev_bytes_mean_3": F.coalesce(F.avg("bytes_log").over(frame), F.lit(0.0)),
        "prev_packet_mean_3": F.coalesce(F.avg("packet_log").over(frame), F.lit(0.0)),
        "prev_event_count_3": F.count("packet_count").over(frame),
    }


def total_columns() -> dict[str, Column]:
    return {
        "session_bytes_max": F.max("bytes_log"),
        "session_bytes_min": F.min("bytes_log"),
        "session_packet_mean": F.avg("packet_log"),
    }


# --- one range ---------------------------------------------------------------------------------------


def session_starts(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where a row's keys differ from those of the row before; nulls are equal to each other."""
    n = table.num_rows
    changed = np.zeros(n, bool)
    changed[0] = True
    for key in keys:
        here, before = table.column(key).slice(1), table.column(key).slice(0, n - 1)
        other = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
        changed[1:] |= other.to_numpy()
    return np.flatnonzero(changed)


def values(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A measure as doubles, and where it is known."""
    column = table.column(name)
    known = pc.is_valid(column).to_numpy()
    return pc.fill_null(column.cast(pa.float64()), 0.0).to_numpy(), known


def previous_rows(table: pa.Table, begin: np.ndarray) -> list[pa.Array]:
    """ROLLING of every row from the rows before it back to `begin`, oldest first, as a window adds them up."""
    at = np.arange(len(begin))

    def look_back(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, n = np.zeros(len(at)), np.zeros(len(at), np.int64)
        for k in range(FRAME, 0, -1):
            there = np.maximum(at - k, 0)
            seen = (at - k >= begin) & known[there]
            total, n = total + np.where(seen, x[there], 0.0), n + seen
        return total, n

    means = []
    for name in ("bytes_log", "packet_log"):
        total, n = look_back(*values(table, name))
        means.append(pa.array(np.where(n > 0, total / np.maximum(n, 1), 0.0)))
    known = pc.is_valid(table.column("packet_count")).to_numpy()
    return [*means, pa.array(look_back(np.zeros(len(at)), known)[1])]


def session_totals(table: pa.Table, starts: np.ndarray, session: np.ndarray, is_open: np.ndarray) -> list[pa.Array]:
    """TOTALS of every row's session; null in open ones."""
    logs, known = values(table, "bytes_log")
    packets, counted = values(table, "packet_log")
    n_logs, n_packets = (np.add.reduceat(x.astype(np.int64), starts) for x in (known, counted))
    high = np.maximum.reduceat(np.where(known, logs, -np.inf), starts)
    low = np.fmin.reduceat(np.where(known, logs, np.nan), starts)
    mean = np.add.reduceat(np.where(counted, packets, 0.0), starts) / np.maximum(n_packets, 1)
    hidden = [(n_logs == 0) | is_open, (n_logs == 0) | is_open, (n_packets == 0) | is_open]
    return [pa.array(x[session], mask=no[session]) for x, no in zip((high, low, mean), hidden, strict=True)]


def stream_range(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rolling: bool, totals: bool, buffer_rows: int):
    """Add the features that a range knows of its sorted rows, with the rows' places and what is left open.

    Held are the rows of the session at the end of what was read, before them up to FRAME rows that were given out already.
    """
    held: pa.Table | None = None
    given, row, in_first, begun = 0, 0, True, False

    def give(table: pa.Table, starts: np.ndarray, stop: int, final: bool) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        session = np.searchsorted(starts, np.arange(n), "right") - 1
        is_open = np.zeros(len(starts), bool)
        is_open[0] = in_first or begun
        is_open[-1] |= final
        if stop > starts[-1]:
            is_open[-1] = True
        at = np.arange(n) - given + row
        head = (at < FRAME) & (session == 0) & in_first
        tail = (np.arange(n) >= max(n - FRAME, starts[-1])) & final
        extra = previous_rows(table, starts[session]) if rolling else []
        extra += session_totals(table, starts, session, is_open) if totals else []
        extra += [pa.array(at), pa.array(head), pa.array(head | tail), pa.array(is_open[session])]
        names = [*(ROLLING if rolling else ()), *(TOTALS if totals else ()), "_row", "_head", "_edge", "_open"]
        for name, column in zip(names, extra, strict=True):
            table = table.append_column(name, column)
        yield from table.slice(given, stop - given).to_batches(max_chunksize=10_000)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        starts, n = session_starts(table, keys), table.num_rows
        last = int(starts[-1])
        if n - last > buffer_rows:
            # the last session goes out but for FRAME rows, and stays open
            stop = n - FRAME
            yield from give(table, starts, stop, final=False)
            keep = max(last, stop - FRAME)
            in_first, begun = in_first and last == 0, True
        elif last > given:
            stop = keep = last
            yield from give(table, starts, stop, final=False)
            in_first, begun = False, False
        else:
            stop, keep = given, 0
        row, held, given = row + stop - given, table.slice(keep), stop - keep
    if held is not None:
        yield from give(held, session_starts(held, keys), held.num_rows, final=True)


# --- all ranges --------------------------------------------------------------------------------------


def in_ranges(df: DataFrame, keys: tuple[str, ...], ordering: list[str], options: SkewOptions) -> DataFrame:
    """Rows sorted by ranges of (keys, ordering), with `_block`, the range. Rows equal in all that may be told apart by
    their place in the input, so that even those can be split."""
    n = options.ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*(_ascending(k) for k in keys), *(_ascending(o) for o in ordering), F.col("_place")]
    ranged = df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.drop("_place").withColumn("_block", F.spark_partition_id())


def null_safe(keys: tuple[str, ...], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def ranged_features(
    df: DataFrame, keys: tuple[str, ...], ordering: list[str], rolling: bool, totals: bool, options: SkewOptions
) -> DataFrame:
    """The features by ranges and halos. Rows pass one exchange and are written once; later steps read what they need of it."""
    spark = df.sparkSession
    workers_find_package(spark)
    kinds = [*([("double", "double", "long")] if rolling else []), *([("double",) * 3] if totals else [])]
    names = [*(ROLLING if rolling else ()), *(TOTALS if totals else ())]
    added = [f"{n} {k}" for n, k in zip(names, [k for group in kinds for k in group], strict=True)]
    rows = in_ranges(df, keys, ordering, options)
    extra = T.StructType.fromDDL(", ".join([*added, *[p for p in _PLACE.split(", ") if not p.startswith("_block")]]))
    step = partial(stream_range, keys=keys, rolling=rolling, totals=totals, buffer_rows=options.buffer_rows)
    path = scratch_path(spark, "sessions")
    rows.mapInArrow(step, T.StructType([*rows.schema.fields, *extra.fields])).write.parquet(path)
    done = spark.read.parquet(path)
    columns = [*df.columns, *names]

    if rolling:
        frame = Window.partitionBy(*keys).orderBy("_block", "_row").rowsBetween(-FRAME, -1)
        heads = done.where("_edge").withColumns(rolling_columns(frame)).where("_head")
        parts = [done.where("NOT _head"), heads]
    else:
        parts = [done]
    if not totals:
        return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])

    aliased = done.where("_open").groupBy(*keys).agg(*[c.alias(f"_{n}") for n, c in total_columns().items()])
    path = scratch_path(spark, "open-sessions")
    aliased.withColumnsRenamed({k: f"_of_{k}" for k in keys}).write.parquet(path)
    found = spark.read.parquet(path)
    found = F.broadcast(found) if found.count() <= BROADCAST_SESSIONS else found
    complete = []
    for part in parts:
        complete.append(part.where("NOT _open").select(*columns))
        met = part.where("_open").join(found, null_safe(keys, "_of_"))
        complete.append(met.select(*[F.col(f"_{c}").alias(c) if c in TOTALS else F.col(c) for c in columns]))
    return reduce(DataFrame.unionByName, complete)


def add_session_features(
    df: DataFrame,
    keys: tuple[str, ...] = SESSION_KEYS,
    order: str = "timestamp",
    tie: str | None = "flow_id",
    rolling: bool = True,
    aggregates: bool = True,
    options: SkewOptions = SkewOptions(),
) -> DataFrame:
    """Add the previous-three means and count, and the whole-session max, min and mean.

    Needs `bytes_log`, `packet_log` and `packet_count`. Rolling means of the first event are 0. Rows of a session are ordered by
    `order`, then `tie`, of any types that sort; without such a column by all other columns, so that the physical order of the rows
    does not matter. Runs one small job, the key probe.
    """
    if tie and tie in df.columns:
        ordering = [order, tie]
    else:
        sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        ordering = [order, *(c for c in sortable if c not in keys and c != order)]
    if has_hot_session(df, keys, options):
        return ranged_features(df, keys, ordering, rolling, aggregates, options)
    added: dict[str, Column] = {}
    if rolling:
        frame = Window.partitionBy(*keys).orderBy(*[_ascending(o) for o in ordering]).rowsBetween(-FRAME, -1)
        added |= rolling_columns(frame)
    if aggregates:
        added |= {n: c.over(Window.partitionBy(*keys)) for n, c in total_columns().items()}
    return df.withColumns(added)
