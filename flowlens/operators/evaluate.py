"""Multiclass evaluation from a confusion table.

The row data is aggregated once, to at most C x C counts; every metric is derived from those counts
and may be grouped (`by`) by split, scenario or run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CLASS_NAMES, NUM_CLASSES

LABEL, PREDICTION = "label", "prediction"


def confusion_matrix(
    scored: DataFrame,
    label: str = "attack",
    prediction: str = "prediction",
    classes: int = NUM_CLASSES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Dense (by..., label, prediction, n): one row per cell, zero where nothing fell.

    Out-of-range and missing classes are left out after counting: a filter on the prediction would be
    pushed below the model and evaluate it twice.
    """
    return dense_matrix(pair_counts(scored, label, prediction, by), classes, by)


def pair_counts(
    scored: DataFrame, label: str, prediction: str, by: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """(by..., label, prediction, n, extra...): the one aggregate over the rows."""
    keys = [F.col(label).cast("long").alias(LABEL), F.col(prediction).cast("long").alias(PREDICTION)]
    return scored.groupBy(*by, *keys).agg(F.count("*").alias("n"), *extra)


def dense_matrix(counts: DataFrame, classes: int = NUM_CLASSES, by: Sequence[str] = ()) -> DataFrame:
    inside = F.col(LABEL).between(0, classes - 1) & F.col(PREDICTION).between(0, classes - 1)
    # Counts per group as a map, then one row per cell: no grid join.
    cell = F.when(inside, F.struct((F.col(LABEL) * classes + F.col(PREDICTION)).alias("cell"), "n"))
    grouped = counts.groupBy(*by) if by else counts.groupBy()
    dense = grouped.agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    cells = F.sequence(F.lit(0).cast("long"), F.lit(classes * classes - 1).cast("long"))
    place = dense.select(*by, "cells", F.explode(cells).alias("place"))
    return place.select(
        *by,
        F.floor(F.col("place") / classes).cast("long").alias(LABEL),
        (F.col("place") % classes).alias(PREDICTION),
        F.coalesce(F.try_element_at("cells", F.col("place")), F.lit(0).cast("long")).alias("n"),
    )


def as_array(confusion: DataFrame, classes: int = NUM_CLASSES) -> DataFrame:
    """The confusion table as one array of arrays, rows = true labels."""
    ordered = F.array_sort(F.collect_list(F.struct(LABEL, PREDICTION, "n")))
    flat = F.transform(ordered, lambda s: s["n"])
    rows = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.slice("flat", i * classes + 1, classes))
    return confusion.agg(flat.alias("flat")).select(rows.alias("matrix"))


def class_metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., class, precision, recall, f1, support); empty classes score 0."""
    hit = F.when(F.col(LABEL) == F.col(PREDICTION), F.col("n")).otherwise(0)
    # Each cell counts once for its true class and once for its predicted class.
    none = F.lit(0).cast("long")

    def side(place: str, tp: Column, true_n: Column, pred_n: Column) -> Column:
        return F.struct(F.col(place).alias("class"), tp.alias("tp"), true_n.alias("true_n"), pred_n.alias("pred_n"))

    sides = F.array(side(LABEL, hit, F.col("n"), none), side(PREDICTION, none, none, F.col("n")))
    totals = (
        confusion.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("true_n").alias("support"), F.sum("pred_n").alias("predicted"))
    )
    precision = F.col("tp") / F.greatest(F.col("predicted"), F.lit(1))
    recall = F.col("tp") / F.greatest(F.col("support"), F.lit(1))
    scored = totals.withColumns({"precision": precision, "recall": recall})
    f1 = 2 * F.col("precision") * F.col("recall") / F.greatest(
        F.col("precision") + F.col("recall"), F.lit(1e-12)
    )
    return scored.select(*by, "class", "precision", "recall", f1.alias("f1"), "support", "tp")


SCORES = ("precision", "recall", "f1")


def _accuracy() -> Column:
    return F.sum("tp") / F.greatest(F.sum("support"), F.lit(1))


def _weighted(score: str) -> Column:
    return F.sum(F.col(score) * F.col("support")) / F.greatest(F.sum("support"), F.lit(1))


def summary_columns(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One wide row per group: accuracy, macro and support-weighted scores."""
    aggregates = [_accuracy().alias("accuracy"), F.sum("support").alias("support")]
    aggregates += [F.avg(s).alias(f"{s}_macro") for s in SCORES]
    aggregates += [_weighted(s).alias(f"{s}_weighted") for s in SCORES]
    grouped = per_class.groupBy(*by) if by else per_class.groupBy()
    return grouped.agg(*aggregates)


def summary_metrics(per_class: DataFrame, by: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Tidy (by..., metric, value): accuracy, error, macro (also as `_avg`) and weighted scores."""
    wide = summary_columns(per_class, by)
    named = {"accuracy": F.col("accuracy"), "error_rate": 1 - F.col("accuracy")}
    for s in SCORES:
        named[f"{s}_macro"] = F.col(f"{s}_macro")
        named[f"{s}_avg"] = F.col(f"{s}_macro")
        named[f"{s}_weighted"] = F.col(f"{s}_weighted")
    rows = [F.struct(F.lit(prefix + m).alias("metric"), v.alias("value")) for m, v in named.items()]
    return wide.select(*by, F.inline(F.array(*rows)))


def class_metric_rows(per_class: DataFrame, by: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Tidy (by..., metric, value) with one row per class and score, e.g. `recall_class_3`."""
    rows = [
        F.struct(
            F.concat(F.lit(f"{prefix}{s}_class_"), F.col("class").cast("string")).alias("metric"),
            F.col(s).cast("double").alias("value"),
        )
        for s in (*SCORES, "support")
    ]
    return per_class.select(*by, F.inline(F.array(*rows)))


def classification_report(
    per_class: DataFrame, names: list[str] | None = None, by: Sequence[str] = (), digits: int = 4
) -> DataFrame:
    """(by..., row, precision, recall, f1, support): classes, accuracy, macro avg, weighted avg.

    Exact: derived from counts, whatever their total.
    """
    names = CLASS_NAMES if names is None else names
    labels = F.try_element_at(F.array(*[F.lit(n) for n in names]), (F.col("class") + 1).cast("int"))
    classes = per_class.select(*by, labels.alias("row"), *SCORES, "support")
    wide = summary_columns(per_class, by)
    missing = F.lit(None).cast("double")

    def line(name: str, scores: list[Column]) -> Column:
        fields = [v.alias(s) for s, v in zip(SCORES, scores)]
        return F.struct(F.lit(name).alias("row"), *fields, F.col("support"))

    lines = F.array(
        line("accuracy", [missing, missing, F.col("accuracy")]),
        line("macro avg", [F.col(f"{s}_macro") for s in SCORES]),
        line("weighted avg", [F.col(f"{s}_weighted") for s in SCORES]),
    )
    report = classes.unionByName(wide.select(*by, F.inline(lines)))
    return report.withColumns({s: F.round(s, digits) for s in SCORES})


def confusion_normalised(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the share of each true class, and the cell text of a confusion plot."""
    row_total = F.sum("n").over(Window.partitionBy(*by, LABEL))
    share = F.when(row_total == 0, F.lit(0.0)).otherwise(F.col("n") / row_total)
    return confusion.withColumn("share", share).withColumn(
        "cell_text", F.concat(F.col("n").cast("string"), F.lit("\n"), F.format_string("%.1f%%", F.col("share") * 100))
    )


# Fixed value: probabilities are kept this far from 0 before the logarithm.
LOG_LOSS_FLOOR = 1e-15


def row_loss(label: str, probabilities: str) -> Column:
    """Negative log of the probability given to the true class; null without a label."""
    chosen = F.try_element_at(F.col(probabilities), (F.col(label) + 1).cast("int"))
    loss = -F.log(F.greatest(F.coalesce(chosen, F.lit(0.0)), F.lit(LOG_LOSS_FLOOR)))
    return F.when(F.col(label).isNotNull(), loss)


def log_loss(scored: DataFrame, label: str, probabilities: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean loss; rows without a label are left out."""
    loss = row_loss(label, probabilities)
    grouped = scored.groupBy(*by) if by else scored.groupBy()
    return grouped.agg(F.avg(loss).alias("log_loss"))
