"""Category encoders: fit once, apply anywhere.

Small vocabularies travel as map literals inside the plan (no shuffle, no join). Vocabularies above
`INLINE_LIMIT` stay distributed as a table and are applied with a join: broadcast when the table is
known to be small; otherwise hot values are looked up in place, so that none of them lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import rank_distinct

INLINE_LIMIT = 1000
BROADCAST_VALUES = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Values looked up in place because many rows hold them, at most, and items that a task's sketch of them tracks.
HOT_VALUES = 1000
SKETCH_ITEMS = 10_000
UNSEEN = -1


@dataclass
class Vocabulary:
    """Values of one column: inline, or a table (value, idx) with its row and byte counts."""

    values: list[str] | None = None
    table: DataFrame | None = None
    size: int = 0
    bytes: int = 0

    @property
    def inline(self) -> bool:
        return self.values is not None

    @property
    def broadcastable(self) -> bool:
        return self.size <= BROADCAST_VALUES and self.bytes <= BROADCAST_BYTES


@dataclass
class Encoders:
    columns: dict[str, Vocabulary] = field(default_factory=dict)

    def to_maps(self) -> dict[str, dict[str, int]]:
        return {
            c: {value: i for i, value in enumerate(v.values)}
            for c, v in self.columns.items()
            if v.inline
        }

    @classmethod
    def from_maps(cls, maps: dict[str, dict[str, int]]) -> "Encoders":
        return cls(
            {
                c: Vocabulary(values=sorted(m, key=m.get), size=len(m))
                for c, m in maps.items()
            }
        )


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, value, n) of all columns in one scan and one pre-aggregated shuffle; nulls left out."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def rank_values(counts: DataFrame, by: str = "value") -> DataFrame:
    """(column, value, idx): alphabetical, or by descending frequency with alphabetical ties."""
    order = [F.col("value").asc()] if by == "value" else [F.col("n").desc(), F.col("value").asc()]
    return rank_distinct(counts, "column", order)


def fit_encoders(
    df: DataFrame, columns: list[str], by: str = "value", inline_limit: int = INLINE_LIMIT
) -> Encoders:
    """Index the distinct values of each column 0..k-1, sorted by value or by frequency."""
    counts = value_counts(df, columns)
    # One row more than could ever be inlined tells the two cases apart with a bounded result.
    sample = counts.limit(inline_limit * len(columns) + 1).collect()
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for row in sample:
        found[row["column"]].append((row["value"], row["n"]))
    complete = len(sample) <= inline_limit * len(columns)
    if complete and all(len(v) <= inline_limit for v in found.values()):
        key = (lambda p: p[0]) if by == "value" else (lambda p: (-p[1], p[0]))
        return Encoders(
            {
                c: Vocabulary(values=[v for v, _ in sorted(pairs, key=key)], size=len(pairs))
                for c, pairs in found.items()
            }
        )
    ranked = rank_values(counts, by)
    sizes = {
        r["column"]: r
        for r in ranked.groupBy("column")
        .agg(F.count("*").alias("size"), F.sum(F.octet_length("value") + 8).alias("bytes"))
        .collect()
    }
    encoders = Encoders()
    for c in columns:
        table = ranked.where(F.col("column") == c).select("value", "idx")
        if c not in sizes:
            encoders.columns[c] = Vocabulary(values=[])
        elif sizes[c]["size"] <= inline_limit:
            rows = table.orderBy("idx").collect()
            encoders.columns[c] = Vocabulary(values=[r["value"] for r in rows], size=len(rows))
        else:
            encoders.columns[c] = Vocabulary(table=table, size=sizes[c]["size"], bytes=sizes[c]["bytes"])
    return encoders


def index_column(column: str, vocabulary: Vocabulary) -> Column:
    """Index by map literal; unseen and null give -1."""
    if not vocabulary.values:
        return F.lit(UNSEEN)
    pairs = [F.lit(x) for i, value in enumerate(vocabulary.values) for x in (value, i)]
    found = F.try_element_at(F.create_map(*pairs), F.col(column).cast("string"))
    return F.coalesce(found, F.lit(UNSEEN))


def hot_values(df: DataFrame, column: str, least: int | None = None) -> list[str]:
    """Values held by so many rows that they would overload a task: at most HOT_VALUES, from a bounded sketch that every task
    fills and that is merged. `least`: rows from which a value is hot, else a fair partition's share."""
    text = F.col(column).cast("string")
    sketch = F.expr(f"approx_top_k(_text, {HOT_VALUES}, {SKETCH_ITEMS})").alias("top")
    found = df.select(text.alias("_text")).where("_text IS NOT NULL").agg(F.count("*").alias("n"), sketch).first()
    if not found["n"]:
        return []
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = least or max(1, found["n"] // partitions)
    return [r["item"] for r in found["top"] if r["count"] >= bound]


def index_by_join(
    df: DataFrame, column: str, vocabulary: Vocabulary, output: str, broadcast: bool | None = None, least: int | None = None
) -> DataFrame:
    """Index by a left join; unseen and null give -1.

    A vocabulary too large to be sent is joined by value. Hot values are taken out before: they get their index from a map literal
    where they are, as do nulls, and only the rest is shuffled, of which no value fills a partition.
    """
    keyed = df.withColumn("_value", F.col(column).cast("string"))
    table = vocabulary.table.select(F.col("value").alias("_value"), F.col("idx").alias("_idx"))
    if vocabulary.broadcastable if broadcast is None else broadcast:
        joined = keyed.join(F.broadcast(table), "_value", "left")
        return joined.withColumn(output, F.coalesce("_idx", F.lit(UNSEEN))).drop("_idx", "_value")
    hot = hot_values(df, column, least)
    known = {r["_value"]: r["_idx"] for r in table.where(F.col("_value").isin(hot)).collect()} if hot else {}
    is_hot = F.coalesce(F.col("_value").isin(hot), F.lit(True)) if hot else F.col("_value").isNull()
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    index = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("_value")), F.lit(UNSEEN)) if pairs else F.lit(UNSEEN)
    here = keyed.where(is_hot).withColumn(output, index.cast("int"))
    rest = keyed.where(~is_hot).join(table, "_value", "left").withColumn(output, F.coalesce("_idx", F.lit(UNSEEN)).cast("int"))
    columns = [*(c for c in df.columns if c != output), output]
    return here.select(*columns).unionByName(rest.select(*columns))


def apply_encoders(
    df: DataFrame, encoders: Encoders, suffix: str = "_idx", in_place: bool = False
) -> DataFrame:
    """Add `<column>_idx` for each fitted column, or replace the column itself."""
    names = {c: c if in_place else f"{c}{suffix}" for c in encoders.columns}
    inline = {
        names[c]: index_column(c, v) for c, v in encoders.columns.items() if v.table is None
    }
    order = df.columns
    df = df.withColumns(inline) if inline else df
    for c, v in encoders.columns.items():
        if v.table is not None:
            df = index_by_join(df, c, v, names[c])
    extra = [n for n in names.values() if n not in order]
    return df.select(*order, *extra)


def encoder_table(encoders: Encoders, df: DataFrame) -> DataFrame:
    """Tidy (column, value, idx) of the inline vocabularies plus every table."""
    spark = df.sparkSession
    rows = [(c, v, i) for c, m in encoders.to_maps().items() for v, i in m.items()]
    tidy = spark.createDataFrame(rows, "column string, value string, idx int")
    for c, v in encoders.columns.items():
        if v.table is not None:
            tidy = tidy.unionByName(v.table.select(F.lit(c).alias("column"), "value", "idx"))
    return tidy
