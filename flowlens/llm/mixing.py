"""Mix sources to target weights by systematic sampling.

A source's target is its share by weight of all words, at most `cap` times what it has; the excess is shared again by
weight (water filling). Every document of a source expects target / size copies. The prefix sum of that along the source's
documents, ordered by size, then id, plus one offset per source, gives a document one copy for each integer it
crosses. Ordering by size keeps the words taken close to the target.

A null text has size 0. The null source is a source of its own, last. A source without words has target 0 and gets no
copies. Rows with one id are ranked by a hash of their text; equal rows share what they get. An empty table gives an empty
result. Columns named like results are replaced. The offset depends on seed and source alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import shuffle_partitions, stored, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
RESULTS = ("size", "source_size", "target", "taken")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) with each source's weight and target; one row per source meets in one window.

    In order of cap / weight, the level at which the rest would be shared rises until the first source that can take
    its share, and falls after it: the final level is the largest.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy("room", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    rows = totals.select("source", "source_size", F.element_at(F.lit(list(weights)), turn).cast("long").alias("weight"))
    rows = rows.withColumn("room", cap * F.col("source_size") / F.col("weight"))
    before = F.sum(cap * F.col("source_size")).over(by_room) - cap * F.col("source_size")
    after = F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(by_room) + F.col("weight")
    everything = F.sum("source_size").over(Window.partitionBy())
    rows = rows.withColumn("level", (everything - before).cast("double") / after.cast("double"))
    level = F.max("level").over(Window.partitionBy())
    return rows.select(
        "source", "source_size", "weight",
        F.least((cap * F.col("source_size")).cast("double"), level * F.col("weight")).alias("target"),
    )


def offset(source: Column, seed: str = SEED) -> Column:
    """In [0, 1), from the source's name."""
    name = F.concat(F.lit(seed), F.when(source.isNull(), ":n:").otherwise(":s:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mix(
    df: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows (columns `keep`, or all) with size, source_size, target, copies and taken.

    Rows are sorted once by ranges of (source, size, id), which also splits a hot source; a document's rank is its place
    in its partition plus the rows of its source in earlier partitions.
    """
    spark = df.sparkSession
    kept = [c for c in (keep or df.columns) if c not in (*RESULTS, "copies")]
    tie = F.xxhash64(F.col(text)).alias("_tie")
    rows = df.select(*kept, F.col(source).alias("_source"), F.col(doc_id).alias("_id"), word_count(F.col(text)).alias("size"), tie)
    order = [F.col("_source").isNull(), F.col("_source"), F.col("size"), F.col("_id"), F.col("_tie")]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "mixing")
    block = F.shiftright(F.col("_at"), 33).alias("_block")

    runs = placed.groupBy("_source", block).agg(F.min("_at").alias("begin"), F.count("*").alias("n"), F.sum("size").alias("words"))
    runs = stored(runs, "mixing-runs")
    totals = runs.groupBy("_source").agg(F.sum("words").alias("source_size"))
    wanted = targets(totals.withColumnRenamed("_source", "source"), weights, cap).withColumnRenamed("source", "of")
    earlier = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("skip", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("begin"))
    starts = starts.join(wanted, F.col("_source").eqNullSafe(F.col("of")))
    starts = starts.select(F.col("_source").alias("of"), "_block", "skip", "source_size", "target")

    at_home = F.col("_source").eqNullSafe(F.col("of")) & (F.shiftright(F.col("_at"), 33) == F.col("_block"))
    ranked = placed.join(starts, at_home)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank, start = F.col("_at") + F.col("skip"), offset(F.col("_source"), seed)
    copies = F.floor((rank + 1) * rate + start) - F.floor(rank * rate + start)
    out = ranked.withColumn("copies", copies.cast("long"))
    return out.select(*kept, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as it was chosen."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    rest = [c for c in mixed.columns if c not in (*RESULTS, "copies")]
    return mixed.filter(F.col("copies") > 0).withColumn("_turn", times).select(*rest)
