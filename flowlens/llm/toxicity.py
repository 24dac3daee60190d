"""Toxicity by multiple-instance learning.

Only documents are labelled; their sentences are the instances. A sentence's probability is logistic in the words and word
beginnings it holds; a document's is the noisy-or of its sentences: toxic unless every sentence is clean. The weights maximise the
likelihood of the document labels through the noisy-or, so blame goes to the sentences that explain the labels, and the model then
names those in any text.

Learning takes labelled rows outside the held-out fold alone, of either label about SAMPLE_DOCS chosen by a hash of the id, weighed
by the share taken. Features whose documents' labels differ from the rest by chance only are left out. Each step of the ascent is a
Spark job over the stored features that adds up one gradient per task. Scores use the text and nothing else.

Words are runs of ASCII letters, digits and bytes above 127, lower-cased A-Z; sentences end at [.!?\\n]. Texts are scored whole. A
null or empty text has no sentence and scores 0. Equal texts score alike. Rows with a null id are held out; of rows that share a labelled
id the least text is learnt from. Without labels of both kinds all scores come from the base rate alone. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.hashing import in_share
from flowlens.llm.common import slices, stored, text_column, workers_find_package
from flowlens.llm.words import Words, find_words, mix, word_hashes

#: Documents of either label that are learnt from, at most about.
SAMPLE_DOCS = 10_000
#: Bits of a feature's slot; lengths in bytes of the word beginnings that are features besides the word.
SLOT_BITS = 20
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: A feature is kept if it stands in so many sampled documents, and their share of toxic ones is so many deviations off.
LEAST_DOCS, DEVIATIONS = 5, 3.0
STEPS, RATE, RIDGE = 40, 1.0, 0.1
#: Tasks of a gradient job, each of which sends one number per kept feature to the driver.
TASKS = 8
#: Probability from which a sentence or document is called toxic.
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 33, 46, 63]] = True
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], dtype=np.uint64)
_STATS = "slot int, docs long, toxic long"
_EXAMPLES = "toxic int, weight double, n_sentences int, sentence array<int>, feature array<int>"
_SUMS = "loss double, bias double, gradient binary"
_SCORED = "score double, offending array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Model:
    """Weights of the kept slots, which are sorted, and the weight every sentence has."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float


class Sentences:
    """Sentences of many texts: the text each belongs to, and (sentence, slot) of their features without repeats."""

    def __init__(self, column: pa.Array):
        self.words: Words = find_words(column, True, _IS_WORD)
        words = self.words
        owner = words.owner
        ends_before = np.cumsum(_ENDS[words.data])[words.starts] if len(words.starts) else words.starts
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (ends_before[1:] != ends_before[:-1])
        self.first = np.flatnonzero(fresh)
        self.text = owner[self.first]
        sentence = np.cumsum(fresh) - 1
        found = [(sentence.astype(np.int64) << SLOT_BITS) | slots(word_hashes(words))]
        eights = np.ndarray(shape=(len(words.data) - 7,), dtype="<u8", buffer=words.data, strides=(1,))
        heads, length = eights[words.starts], words.ends - words.starts
        for n in BEGINNINGS:
            long = np.flatnonzero(length > n)
            names = mix(mix(heads[long] & _MASKS[n]) + np.uint64(n))
            found.append((sentence[long].astype(np.int64) << SLOT_BITS) | slots(names))
        pairs = np.unique(np.concatenate(found))
        self.sentence, self.slot = pairs >> SLOT_BITS, pairs & ((1 << SLOT_BITS) - 1)

    def bounds(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of each sentence in its text in code points, from its first word to its last."""
        words = self.words
        points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        last = np.concatenate((self.first[1:], [len(words.starts)]))[: len(self.first)] - 1
        base = points[words.offsets[self.text]]
        return points[words.starts[self.first]] - base, points[words.ends[last]] - base


def slots(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def noisy_or(z: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """1 - product of the sentences' probabilities of being clean, through the sum of their logarithms."""
    return -np.expm1(-np.bincount(text, weights=np.logaddexp(0.0, z), minlength=n))


def learnable(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS != HELD_OUT


def sample(df: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, float]:
    """(text, toxic, weight) of the documents to learn from, stored; and the share of toxic labels."""
    known = labels.filter(learnable(F.col("doc_id")) & F.col("toxic").isNotNull())
    known = stored(known.groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") == 1).cast("int").alias("toxic")), "toxic-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    shares = {k: min(1.0, SAMPLE_DOCS / n) for k, n in counts.items()}
    parts = [
        known.filter((F.col("toxic") == k) & in_share("toxicity", F.col("_id"), share)).withColumn("weight", F.lit(1.0 / share))
        for k, share in sorted(shares.items())
    ]
    chosen = parts[0] if parts else known.withColumn("weight", F.lit(1.0))
    chosen = chosen if len(parts) < 2 else chosen.union(parts[1])
    rows = df.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    drawn = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "toxic", "weight").agg(F.min("text").alias("text"))
    rate = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1.0)
    return stored(drawn.repartition(TASKS, "_id").select("text", "toxic", "weight"), "toxic-sample"), rate


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the task, and how many toxic ones, hold each slot."""
    docs, toxic = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, np.int64)
    for batch in slices(batches, "text"):
        found = Sentences(text_column(batch, "text"))
        label = batch.column(batch.schema.get_field_index("toxic")).to_numpy()
        pairs = np.unique(found.text[found.sentence].astype(np.int64) << SLOT_BITS | found.slot)
        slot = pairs & ((1 << SLOT_BITS) - 1)
        docs += np.bincount(slot, minlength=1 << SLOT_BITS)
        toxic += np.bincount(slot[label[pairs >> SLOT_BITS] == 1], minlength=1 << SLOT_BITS)
    seen = np.flatnonzero(docs)
    columns = [pa.array(seen, pa.int32()), pa.array(docs[seen], pa.int64()), pa.array(toxic[seen], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["slot", "docs", "toxic"])


def choose_features(drawn: DataFrame) -> np.ndarray:
    """The slots, sorted, that tell toxic documents from others: at most 2 ** SLOT_BITS numbers."""
    n, p = drawn.agg(F.count("*"), F.coalesce(F.avg("toxic"), F.lit(0.0))).first()
    if not n:
        return np.empty(0, np.int64)
    stats = drawn.mapInArrow(count_features, _STATS).groupBy("slot").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    off = F.abs(F.col("toxic") - F.col("docs") * p) / F.sqrt(F.col("docs") * (p * (1 - p)) + 1.0)
    kept = stats.filter((F.col("docs") >= LEAST_DOCS) & (off > DEVIATIONS)).select("slot").collect()
    return np.sort(np.array([r[0] for r in kept], np.int64))


def featured(batches: Iterator[pa.RecordBatch], kept: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Kept features of each document by sentence; sentences without any are but counted."""
    for batch in slices(batches, "text"):
        found = Sentences(text_column(batch, "text"))
        place, known = positions(kept, found.slot)
        sentence, place = found.sentence[known], place[known]
        n = batch.num_rows
        totals = np.bincount(found.text, minlength=n)
        inside = sentence - np.concatenate(([0], np.cumsum(totals)))[found.text[sentence]]
        cuts = pa.array(np.searchsorted(found.text[sentence], np.arange(n + 1)), pa.int32())
        arrays = [
            batch.column(batch.schema.get_field_index("toxic")), batch.column(batch.schema.get_field_index("weight")),
            pa.array(totals, pa.int32()),
            *[pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (inside, place)],
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["toxic", "weight", "n_sentences", "sentence", "feature"])


def positions(kept: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each slot stands among the kept ones, and whether it is one."""
    if not len(kept):
        return np.zeros(len(slot), np.int64), np.zeros(len(slot), bool)
    place = np.minimum(np.searchsorted(kept, slot), len(kept) - 1)
    return place, kept[place] == slot


def gradient(batches: Iterator[pa.RecordBatch], weights: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    """Loss and gradient of the task's documents.

    With P = 1 - prod(1 - p_s), the log-likelihood of a label y changes with the logit of sentence s by p_s (y - P) / P.
    """
    loss, by_bias, total = 0.0, 0.0, np.zeros(len(weights))
    for batch in batches:
        toxic, share, n_sentences = (batch.column(i).to_numpy() for i in range(3))
        n, first = len(toxic), np.concatenate(([0], np.cumsum(n_sentences)))
        text = np.repeat(np.arange(n), n_sentences)
        holders = np.repeat(np.arange(n), np.diff(batch.column(3).offsets.to_numpy()))
        sentence = batch.column(3).flatten().to_numpy() + first[holders]
        feature = batch.column(4).flatten().to_numpy()
        z = np.bincount(sentence, weights=weights[feature], minlength=len(text)) + bias
        whole = noisy_or(z, text, n)
        p = 1.0 / (1.0 + np.exp(-z))
        slope = p * (share * (toxic - whole) / np.maximum(whole, 1e-9))[text]
        loss -= float(np.sum(share * np.log(np.clip(np.where(toxic == 1, whole, 1.0 - whole), 1e-12, 1.0))))
        by_bias += float(slope.sum())
        total += np.bincount(feature, weights=slope[sentence], minlength=len(total))
    columns = [pa.array([loss]), pa.array([by_bias]), pa.array([total.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["loss", "bias", "gradient"])


def fit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Ascend the likelihood with steps that shrink, for each weight, with the slopes it has seen."""
    workers_find_package(df.sparkSession)
    drawn, rate = sample(df, labels, doc_id, text)
    kept = choose_features(drawn)
    examples = stored(drawn.mapInArrow(partial(featured, kept=kept), _EXAMPLES), "toxic-examples")
    sentences = examples.agg(F.coalesce(F.avg("n_sentences"), F.lit(1.0))).first()[0]
    weights, bias = np.zeros(len(kept)), float(np.log(rate / max(1.0, sentences)))
    seen, seen_bias = np.full(len(kept), 1e-6), 1e-6
    for _ in range(STEPS if len(kept) else 0):
        # one row of each of the TASKS tasks, in an order that the sums' last digits don't depend on
        sums = sorted(tuple(r) for r in examples.coalesce(TASKS).mapInArrow(partial(gradient, weights=weights, bias=bias), _SUMS).collect())
        slope = np.sum([np.frombuffer(g, np.float64) for _, _, g in sums], axis=0) - RIDGE * weights
        slope_bias = float(sum(b for _, b, _ in sums))
        seen, seen_bias = seen + slope * slope, seen_bias + slope_bias**2
        weights = weights + RATE * slope / np.sqrt(seen)
        bias += RATE * slope_bias / float(np.sqrt(seen_bias))
    return Model(kept, weights, bias)


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        column = text_column(batch, "_text")
        found = Sentences(column)
        place, known = positions(model.slots, found.slot)
        z = np.bincount(found.sentence[known], weights=model.weights[place[known]], minlength=len(found.text)) + model.bias
        score = noisy_or(z, found.text, batch.num_rows)
        p = 1.0 / (1.0 + np.exp(-z))
        # sentences called toxic; in a toxic document without one, the likeliest
        called = p >= THRESHOLD
        best = np.zeros(batch.num_rows)
        np.maximum.at(best, found.text, p)
        alone = (score >= THRESHOLD) & (best < THRESHOLD)
        called |= alone[found.text] & (p == best[found.text])
        which = np.flatnonzero(called)
        start, end = (x[which] for x in found.bounds(column))
        spans = pa.StructArray.from_arrays(
            [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(p[which], pa.float64())], ["start", "end", "score"]
        )
        cuts = pa.array(np.searchsorted(found.text[which], np.arange(batch.num_rows + 1)), pa.int32())
        rest = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_text"]
        names = [f.name for f in batch.schema if f.name != "_text"]
        offending = pa.ListArray.from_arrays(cuts, spans)
        yield pa.RecordBatch.from_arrays([*rest, pa.array(score), offending], [*names, "score", "offending"])


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, offending): offending sentences by their code points (end exclusive) and scores."""
    workers_find_package(df.sparkSession)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    kind = df.schema[doc_id].dataType.simpleString()
    scored = rows.mapInArrow(partial(score_batches, model=model), f"doc_id {kind}, {_SCORED}")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score", predicted, "offending")


def score_texts(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold, and score all."""
    return score(df, fit(df, labels))
