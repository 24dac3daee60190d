"""Line dedup by site-relative frequency.

A line is boilerplate on a site if it stands in at least `min_pages` of its pages and in more than `ratio` of all of them;
every copy of it on that site is dropped. Lines are the \\n-separated pieces of a text, compared as they are; lines
without a word are kept. A page counts once for each line, however often the line repeats there.

A null text stays null and counts as a page without lines; an empty one stays empty. Rows without a site form one
site. Repeated rows count as pages. An empty table gives an empty result. Columns named n_lines or n_dropped are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import WORD, stored

RATIO = 0.05
MIN_PAGES = 5
#: Boilerplate lines up to this many (24 bytes each) are sent to every task; more are joined.
BROADCAST_LINES = 500_000


def line_key(line: Column) -> Column:
    """128 bits of hash."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(df: DataFrame, site: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines): the keys of each site's boilerplate lines.

    Lines are counted by key before they are shuffled. A site has at most (lines a page has on average) / ratio of them.
    """
    lines = F.filter(F.array_distinct(F.split(F.col(text), "\n", -1)), lambda x: F.rlike(x, F.lit(WORD)))
    keys = df.select(F.col(site).alias("site"), F.explode(F.transform(lines, line_key)).alias("key"))
    counts = keys.groupBy("site", "key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    totals = df.groupBy(F.col(site).alias("of")).agg(F.count("*").alias("total"))
    often = counts.join(totals, F.col("site").eqNullSafe(F.col("of"))).filter(F.col("pages") > ratio * F.col("total"))
    return often.groupBy("site").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(
    df: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The rows with boilerplate lines taken out of the text, and n_lines, n_dropped (long; null text: 0)."""
    found = stored(boilerplate(df, site, text, ratio, min_pages).withColumnRenamed("site", "_site"), "line-keys")
    n = found.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    found = F.broadcast(found) if n <= BROADCAST_LINES else found
    rows = df.drop("n_lines", "n_dropped").join(found, F.col(site).eqNullSafe(F.col("_site")), "left")

    pieces = F.split(F.col(text), "\n", -1)
    kept = F.when(
        F.col("keys").isNotNull(),
        F.filter(pieces, lambda x: ~F.array_contains(F.col("keys"), line_key(x)) | ~F.rlike(x, F.lit(WORD))),
    ).otherwise(pieces)
    rows = rows.withColumn("_kept", kept)
    before = F.when(F.col(text).isNull(), 0).otherwise(F.size(pieces))
    after = F.when(F.col(text).isNull(), 0).otherwise(F.size("_kept"))
    columns = [F.array_join("_kept", "\n").alias(text) if c == text else F.col(c) for c in df.columns if c not in ("n_lines", "n_dropped")]
    return rows.select(*columns, before.cast("long").alias("n_lines"), (before - after).cast("long").alias("n_dropped"))
