"""Quality rules as a short-circuit cascade.

Every row gets its base counts. Rows that the base rules pass go through further rules, one after another, until one
rejects them; a rule behind that one isn't evaluated. The order is by rejection per cost, both measured on a sample; it
changes the time, never the verdict.

Words are runs of characters other than ASCII blanks. A null text has no words, so it fails the base rules; so does an
empty one. Repeated rows are judged alike. An empty table gives an empty result. Columns named like results are replaced.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import WORD, let, stored

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Rows the costs are measured on.
SAMPLE_ROWS = 1000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Up to this many words, a window's hash and place share one 64-bit number (48 bits of hash, at least).
PACKED_WORDS = 1 << 16


@dataclass(frozen=True)
class Rule:
    """Rejects a row when the SQL condition over text and base counts holds."""

    name: str
    condition: str


# Thresholds are shares of words or characters that prose stays far away from.
RULES = (
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 4 AND 2 * n_dup_lines > regexp_count(text, '\\n') + 1"),
    Rule("bullets", "10 * regexp_count(text, '(?m)^[ \\t]*[-*\\u2022]') > 9 * (regexp_count(text, '\\n') + 1)"),
    Rule("ellipses", "10 * regexp_count(text, '(?m)(\\\\.\\\\.\\\\.|\\u2026)[ \\t]*$') > 6 * (regexp_count(text, '\\n') + 1)"),
    Rule("few_letters", "2 * regexp_count(text, '[\\\\p{L}]') < word_chars"),
    Rule("digits", "5 * regexp_count(text, '[0-9]') > 2 * word_chars"),
)


def repeated_words(words: Column, n: Column, size: int = 3) -> Column:
    """Words that lie in windows of `size` words found more than once.

    Sort the windows' hashes with their places; equal neighbours repeat; add up what their places cover.
    """

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(size), p - F.coalesce(F.get(places, j - 1), F.lit(-size))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def equal_neighbours(ordered: Column, value) -> Column:
        def repeats(x: Column, j: Column) -> Column:
            return F.coalesce(value(F.get(ordered, j - 1)) == value(x), F.lit(False)) | F.coalesce(
                value(F.get(ordered, j + 1)) == value(x), F.lit(False)
            )

        return F.filter(ordered, repeats)

    def window(h: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(h, i + j) for j in range(size)])

    def packed(h: Column) -> Column:
        low, high = F.lit(PACKED_WORDS - 1).cast("long"), F.lit(-PACKED_WORDS).cast("long")
        spots = F.sequence(F.lit(0), F.size(h) - size)
        pairs = F.transform(spots, lambda i: window(h, i).bitwiseAND(high).bitwiseOR(i.cast("long")))

        def places(s: Column) -> Column:
            return F.sort_array(F.transform(equal_neighbours(s, lambda x: F.shiftright(x, 16)), lambda x: x.bitwiseAND(low)))

        return let(F.sort_array(pairs), lambda s: let(places(s), covered))

    def wide(h: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.struct(window(h, i).alias("h"), i.cast("long").alias("i")))

        def places(s: Column) -> Column:
            return F.sort_array(F.transform(equal_neighbours(s, lambda x: x["h"]), lambda x: x["i"]))

        return let(F.sort_array(pairs), lambda s: let(places(s), covered))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return (
        F.when(n < size, F.lit(0).cast("long"))
        .when(n <= PACKED_WORDS, let(hashes, packed))
        .otherwise(let(hashes, wide))
    )


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with COUNTS and base_failed; a projection."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))

    def counts(w: Column) -> Column:
        n = F.size(w)
        return F.struct(n.cast("long").alias("n"), repeated_words(w, n).alias("r"))

    rest = [c for c in df.columns if c not in (*COUNTS, "base_failed", "kept")]
    rows = df.select(*rest, let(words, counts).alias("_w"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("_d"))
    n, r = F.col("_w.n"), F.col("_w.r")
    return rows.select(
        *rest, n.alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("_d").cast("long").alias("n_dup_lines"), r.alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * r > 50 * n)).alias("base_failed"),
    )


def cascade_order(counted: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by share rejected per second on a stored sample of rows that pass the base rules."""
    sample = stored(counted.filter(~F.col("base_failed")).limit(sample_rows), "quality-sample").coalesce(1)
    measured = []
    sample.count()
    for rule in rules:
        began = time.perf_counter()
        rejected = sample.agg(F.avg(F.when(F.expr(rule.condition), 1.0).otherwise(0.0))).first()[0] or 0.0
        measured.append(((rejected + 1e-4) / (time.perf_counter() - began), rule))
    return [rule for _, rule in sorted(measured, key=lambda x: -x[0])]


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with COUNTS, base_failed and kept. `rules` speak of the text as `text`."""
    counted = base_counts(df, text)
    named = counted if text == "text" else counted.withColumn("text", F.col(text))
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for rule in cascade_order(named, rules):
        verdict = verdict.when(F.expr(rule.condition), F.lit(False))
    return named.withColumn("kept", verdict.otherwise(F.lit(True)))
