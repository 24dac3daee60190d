"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k smallest distinct 64-bit hashes of a text's five-word shingles (lower-cased A-Z, words between ASCII
blanks; a shorter text is one shingle). It merges across parts of a text or corpus and estimates resemblance,
containment and the number of distinct shingles. As a string it is URL-safe base64 of the hashes, ascending.

Null and blank texts have the empty sketch "": like each other (1.0), unlike everything else (0.0). Equal texts have equal
fingerprints. A null document id orders before all others; rows with one id order by their text. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import shuffle_partitions, small_batches, slices, text_column
from flowlens.llm.words import distinct_sets, find_words

SHINGLE = 5
SIZE = 256
_RANGE = float(2**64)


def encode(sketch: np.ndarray) -> str:
    return base64.urlsafe_b64encode(sketch.astype(">u8").tobytes()).decode("ascii")


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.urlsafe_b64decode(fingerprint), dtype=">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Sketch of the union."""
    return np.union1d(a, b)[:size]


def distinct_shingles(sketch: np.ndarray, size: int = SIZE) -> float:
    """Exact while the sketch isn't full."""
    if len(sketch) < size:
        return float(len(sketch))
    return (size - 1) * _RANGE / float(sketch[-1])


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity: the share of the union's sketch that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    twice = both[1:] == both[:-1]
    keep = np.flatnonzero(np.concatenate(([True], ~twice)))[:size]
    last = both[keep[-1]]
    return float(np.count_nonzero(both[1:][twice] <= last)) / len(keep)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge(a, b, size), size)
    return min(1.0, resemblance(a, b, size) * union / distinct_shingles(a, size))


def sketches(column: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    return [s[:size] for s in distinct_sets(find_words(column, lower=True), SHINGLE)]


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", size: int = SIZE) -> DataFrame:
    """Each row with the fingerprint of its text; no shuffle."""
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        found: list[str] = []
        for part in slices(iter([pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string())})]), "t"):
            found += [encode(s) for s in sketches(text_column(part, "t"), size)]
        return pd.Series(found, dtype=object)

    return df.withColumn(name, of(F.col(text)))


def merge_fingerprints(df: DataFrame, key: str, fingerprint: str = "fingerprint", size: int = SIZE) -> DataFrame:
    """One merged sketch per key. Each task merges its own rows first, so a key gets a row per task at most and then
    meets in two steps."""

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            for k, f in zip(frame[key], frame[fingerprint], strict=True):
                s = decode(f or "")
                k = None if pd.isna(k) else k
                held[k] = merge(held[k], s, size) if k in held else s
            if len(held) > 50_000:
                yield out(held)
                held = {}
        yield out(held)

    def out(held: dict) -> pd.DataFrame:
        return pd.DataFrame({key: list(held), fingerprint: [encode(s) for s in held.values()]}, dtype=object)

    rows = df.select(key, fingerprint)
    some = rows.mapInPandas(combine, rows.schema).repartition(key, (F.rand(7) * 16).cast("int"))
    return some.mapInPandas(combine, rows.schema).repartition(key).mapInPandas(combine, rows.schema)


def in_order(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(part, borrowed, at, doc_id, text): parts hold consecutive ids; the first row of each part also comes,
    borrowed, at the end of the part before (of the last, for the first). Cuts are ids, as many as shuffle partitions."""
    n = shuffle_partitions(df.sparkSession)
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("at"),
    )
    ask = [i / n for i in range(n)]
    row = rows.agg(F.min("at").alias("low"), F.percentile_approx("at", ask, max(10_000, 20 * n)).alias("cuts")).first()
    cuts = np.unique(np.array([row.low, *row.cuts] if row and row.low is not None else [0], dtype=np.int64))
    last = len(cuts) - 1

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(cuts, ids.to_numpy(np.int64), "right") - 1
        head = cuts[found] == ids.to_numpy(np.int64)
        return pd.Series([[p, -1 - (p - 1 if p else last)] if h else [p] for p, h in zip(found.tolist(), head, strict=True)])

    place = F.col("place")
    placed = rows.withColumn("place", F.explode(places("at")))
    return placed.select(
        F.when(place < 0, -1 - place).otherwise(place).alias("part"), (place < 0).alias("borrowed"), "at", "doc_id", "text"
    )


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Fingerprint every text, its edited text and the likeness of both to it, next by ascending id.

    Whole texts are shuffled once, by ranges of ids, and streamed in order; a task holds one batch and one text more.
    """
    small_batches(df.sparkSession)
    rows = in_order(df, doc_id, text)
    kind = dict(rows.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, distinct_shingles double"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts = None, [], []
        for batch in slices(batches, "text"):
            parts, borrowed = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            new_ids, new_texts = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for p, b, i, t in zip(parts, borrowed, new_ids, new_texts, strict=True):
                if p != part:
                    part, done = p, False
                    assert not ids, "each part ends with a borrowed row"
                if done:
                    continue  # other rows with the id of the next part's first
                ids.append(i)
                texts.append(t)
                if b:
                    done = True
                    yield result(ids, texts)
                    ids, texts = [], []
            if len(ids) > 1:
                yield result(ids, texts)
                ids, texts = ids[-1:], texts[-1:]

    def result(ids: list, texts: list[str]) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        own = sketches(pa.array(texts, pa.large_string()), size)
        new = sketches(pa.array(changed, pa.large_string()), size)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids[:-1], batch_type),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed],
            "fingerprint": pa.array([encode(s) for s in own[:-1]], pa.string()),
            "edited_fingerprint": pa.array([encode(s) for s in new], pa.string()),
            "near_edited": pa.array([resemblance(a, b, size) for a, b in zip(own, new, strict=False)], pa.float64()),
            "near_next": pa.array([resemblance(a, b, size) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            "distinct_shingles": pa.array([distinct_shingles(s, size) for s in own[:-1]], pa.float64()),
        })

    batch_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    sorted_rows = rows.repartition("part").sortWithinPartitions("part", "borrowed", "at", "text")
    return sorted_rows.mapInArrow(work, schema)


