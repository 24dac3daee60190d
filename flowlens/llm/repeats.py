"""Substring dedup by recompression.

Every word that lies in a window of `WINDOW` words found again anywhere, in another text or the same, is removed. Words
are runs of characters other than ASCII blanks, compared as they are; windows are judged on the input.

Recompression names words, then ROUNDS times names maximal runs of one symbol and pairs of neighbours, the first from one half of the
alphabet and the second from the other. Names are hashes and so are the halves, so that all tasks give equal
word sequences equal symbols without asking each other, but for symbols at their edges, whose naming looked beyond. Each symbol keeps
the span of words that its naming looked at; a window that holds the span has the symbol wherever the window stands. Of
the symbols of a window the one with the smallest name stands for it; symbols that do are grouped by what their spans hold. Only
windows whose symbol is found twice can be repeats; they are verified by grouping the windows themselves. The few windows
without any symbol of their own are grouped directly.

Texts with equal word sequences are one class, and windows of a class with two texts are repeats. Null and
blank texts have no words; nothing is removed from texts shorter than a window. Null and repeated ids are kept as rows. An
empty table gives an empty result; other columns are ignored. Sequences are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import slices, small_batches, stored, text_column
from flowlens.llm.words import Words, find_words, mix, window_hashes, word_hashes

WINDOW = 35
ROUNDS = 4
#: Classes up to this many are looked up in every task; more are joined.
BROADCAST_CLASSES = 1 << 20
_FAR = 1 << 40
# Odd multipliers that keep the uses of a hash apart.
_RUN, _PAIR, _ODD = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), 0xD6E8FEB86659FD93
EMPTY = hashlib.sha256(b"").hexdigest()


def sequence_names(words: Words, hashes: np.ndarray) -> np.ndarray:
    """64 bits for each text's whole word sequence, as signed numbers."""
    places = np.arange(len(hashes), dtype=np.uint64) - np.repeat(words.first[:-1], words.counts).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ mix(places + _RUN)), dtype=np.uint64)))
    return mix(sums[words.first[1:]] - sums[words.first[:-1]] + mix(words.counts.astype(np.uint64))).view(np.int64)


def recompress(hashes: np.ndarray, owner: np.ndarray, rounds: int = ROUNDS):
    """Symbols after the rounds: name, first word, word behind, and the span of words their naming looked at.

    Spans reach far out where naming met the end of a text."""
    n = len(hashes)
    name, begin, text = hashes, np.arange(n), owner
    end = begin + 1
    low, high = begin.copy(), end.copy()
    for r in range(rounds):
        # maximal runs
        same = np.zeros(len(name), bool)
        same[1:] = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
        first = np.flatnonzero(~same)
        last = np.concatenate((first[1:], [len(name)])) - 1
        many = (last - first + 1).astype(np.uint64)
        base, owns = name[first], text[first]
        half = (mix(base + np.uint64((r + 1) * int(_PAIR) % 2**64)) & np.uint64(1)).astype(bool)
        runs = np.where(many > 1, mix(base ^ (many * _RUN)), base)
        # pairs of neighbouring runs, the first from one half and the second from the other
        beside = owns[1:] == owns[:-1]
        opens = np.zeros(len(base), bool)
        opens[:-1] = half[:-1] & ~half[1:] & beside
        closes = np.concatenate(([False], opens[:-1]))
        left = np.flatnonzero(~closes)
        right = left + opens[left]
        paired = opens[left]
        new = np.where(paired, mix(runs[left] + mix(runs[right] ^ _PAIR)), runs[left])
        # naming looked one symbol beyond on both sides
        a, b = first[left], last[right]
        before, behind = np.maximum(a - 1, 0), np.minimum(b + 1, len(name) - 1)
        inside_a, inside_b = (a > 0) & (text[before] == owns[left]), (b + 1 < len(name)) & (text[behind] == owns[left])
        new_low = np.where(inside_a, np.minimum(low[before], low[a]), -_FAR)
        new_high = np.where(inside_b, np.maximum(high[behind], high[b]), _FAR)
        name, begin, end, text, low, high = new, begin[a], end[b], owns[left], new_low, new_high
    return name, begin, end, low, high


def span_names(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of the word spans, alike wherever they stand."""
    n = len(hashes)
    powers, back = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    powers[1:], back[1:] = np.uint64(_ODD), np.uint64(pow(_ODD, -1, 2**64))
    powers, back = np.cumprod(powers, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:n], dtype=np.uint64)))
    return mix((sums[high] - sums[low]) * back[low] + mix((high - low).astype(np.uint64)))


def anchors(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW):
    """For each window start: the start, the anchor's name and place (its span's first word); place -1: a window without
    one, under its own name. `first` bounds the texts' words."""
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    spots = np.flatnonzero(np.arange(len(hashes)) + window <= first[1:][owner]) if len(hashes) else np.empty(0, np.int64)
    if not len(spots):
        return spots, np.empty(0, np.uint64), spots
    _, _, _, low, high = recompress(hashes, owner)
    usable = (low >= 0) & (high <= len(hashes)) & (high - low <= window)
    low, high = low[usable], high[usable]
    names = span_names(hashes, low, high)
    best, place = np.full(len(spots), np.uint64(2**64 - 1)), np.full(len(spots), -1)
    if len(low):
        at = np.searchsorted(low, spots, "left")
        stop = np.searchsorted(high, spots + window, "right")
        who = np.arange(len(spots))
        while True:
            ok = at < stop
            if not ok.any():
                break
            at, stop, who = at[ok], stop[ok], who[ok]
            better = (names[at] < best[who]) | (place[who] < 0)
            best[who[better]], place[who[better]] = names[at[better]], low[at[better]]
            at = at + 1
    poor = place < 0
    best[poor] = window_hashes(hashes, window)[spots[poor]]
    return spots, best, place


def _texts(batches: Iterator[pa.RecordBatch]):
    """Batches with their words, hashes, class names, and which texts are new to this task."""
    seen: set[int] = set()
    for batch in slices(batches, "text"):
        words = find_words(text_column(batch, "text"), lower=False)
        hashes = word_hashes(words)
        names = sequence_names(words, hashes)
        new = np.zeros(len(names), bool)
        for i, x in enumerate(names.tolist()):
            if x not in seen:
                seen.add(x)
                new[i] = True
        yield batch, words, hashes, names, new


def classes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, class, n_words, whole): whole is the hash of all words joined by blanks."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, _, names, _ in _texts(batches):
            raw = words.data.tobytes()
            bounds = words.offsets.tolist()
            whole = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
            arrays = [batch.column(0), pa.array(names), pa.array(words.counts, pa.int64()), pa.array(whole, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "class", "n_words", "whole"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, class long, n_words long, whole string")


def found_twice(keyed: DataFrame) -> DataFrame:
    """(class, place) of the rows (name, class, place) whose name stands in two places; groups are streamed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: name, class, place, and whether it went out
        for batch in batches:
            name, group, place = (batch.column(i).to_numpy() for i in range(3))
            if not len(name):
                continue
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (group[1:] != group[:-1]) | (place[1:] != place[:-1])
            if held is not None:
                new[0] = (name[0], group[0], place[0]) != held[:3]
            name, group, place = name[new], group[new], place[new]
            if not len(name):
                continue
            like = np.zeros(len(name) + 1, bool)
            like[1:-1] = name[1:] == name[:-1]
            again = held is not None and name[0] == held[0]
            like[0] = again
            out = like[:-1] | like[1:]
            groups, places = group[out], place[out]
            if again and not held[3]:
                groups, places = np.concatenate(([held[1]], groups)), np.concatenate(([held[2]], places))
            held = (name[-1], group[-1], place[-1], bool(out[-1]))
            if len(groups):
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(places, pa.int32())], names=["class", "place"])

    ordered = keyed.repartition("name").sortWithinPartitions("name", "class", "place").select("name", "class", "place")
    return ordered.mapInArrow(work, "class long, place int")


def anchor_rows(texts: DataFrame, window: int) -> DataFrame:
    """(name, class, place) of the anchors; windows without one have place -1 - start."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, hashes, names, new in _texts(batches):
            owner = words.owner
            spots, found, place = anchors(hashes, words.first, window)
            ok = new[owner[spots]] if len(spots) else np.zeros(0, bool)
            spots, found, place = spots[ok], found[ok], place[ok]
            # an anchor stands for a row of windows: one row for it
            once = np.ones(len(spots), bool)
            once[1:] = (place[1:] != place[:-1]) | (place[1:] < 0)
            spots, found, place = spots[once], found[once], place[once]
            texts_of = owner[spots] if len(spots) else spots
            local = np.where(place < 0, -1 - (spots - words.first[texts_of]), place - words.first[texts_of])
            tagged = np.where(place < 0, mix(found ^ _RUN), found)
            arrays = [pa.array(tagged.view(np.int64)), pa.array(names[texts_of]), pa.array(local.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["name", "class", "place"])

    return texts.mapInArrow(work, "name long, class long, place int")


def class_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, text) of the wanted classes, one row each."""
    few = wanted.count() <= BROADCAST_CLASSES
    known = np.sort(wanted.toPandas()["class"].to_numpy(np.int64)) if few else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, names, new in _texts(batches):
            if known is not None:
                at = np.minimum(np.searchsorted(known, names), max(len(known) - 1, 0))
                new &= known[at] == names if len(known) else False
            column = text_column(batch, "text").filter(pa.array(new))
            yield pa.RecordBatch.from_arrays([pa.array(names[new]), column], names=["class", "text"])

    made = texts.mapInArrow(work, "class long, text string")
    if not few:
        made = made.join(wanted, "class", "left_semi")
    return made.dropDuplicates(["class"])


def window_rows(marked: DataFrame, window: int) -> DataFrame:
    """(name, class, place) of windows whose anchor stands in `places`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = find_words(text_column(batch, "text"), lower=False)
            hashes, owner = word_hashes(words), words.owner
            spots, _, place = anchors(hashes, words.first, window)
            if not len(spots):
                continue
            shared = np.zeros(len(hashes) + 1, bool)
            lists = batch.column(2)
            at = lists.flatten().to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            shared[at + np.repeat(words.first[:-1], lengths)] = True
            ok = (place >= 0) & shared[place]
            spots = spots[ok]
            names = window_hashes(hashes, window)[spots].view(np.int64)
            group = batch.column(0).to_numpy()[owner[spots]]
            local = (spots - words.first[owner[spots]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(group), pa.array(local)], names=["name", "class", "place"])

    return marked.select("class", "text", "places").mapInArrow(work, "name long, class long, place int")


def without_repeats(hit: DataFrame, window: int) -> DataFrame:
    """(class, n_removed, kept, text) for rows (class, text, starts): words in the windows are taken out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = find_words(text_column(batch, "text"), lower=False)
            raw = words.data.tobytes()
            removed, kept = [], []
            for i, starts in enumerate(batch.column(2).to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                steps = np.zeros(b - a + 1, np.int64)
                np.add.at(steps, np.array(starts), 1)
                np.add.at(steps, np.array(starts) + window, -1)
                stays = np.flatnonzero(np.cumsum(steps[:-1]) == 0) + a
                removed.append(int(b - a) - len(stays))
                pairs = zip(words.starts[stays].tolist(), words.ends[stays].tolist(), strict=True)
                kept.append(b" ".join([raw[x:y] for x, y in pairs]).decode("utf-8"))
            arrays = [batch.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["class", "n_removed", "kept"])

    return hit.select("class", "text", "starts").mapInArrow(work, "class long, n_removed long, kept string")


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by blanks), and, where words were
    removed, the kept text (else null: the text stands)."""
    small_batches(df.sparkSession)
    texts = df.select(F.col(text).alias("text"))
    rows = stored(classes(df, doc_id, text), "classes")
    copied = rows.groupBy("class").agg(F.count("*").alias("copies"))

    shared = stored(found_twice(anchor_rows(texts, window)), "anchors")
    places = shared.filter("place >= 0").groupBy("class").agg(F.collect_set("place").alias("places"))
    direct = shared.filter("place < 0").selectExpr("class", "-1 - place AS place")
    own = stored(class_texts(texts, shared.select("class").distinct()), "class-texts")
    repeated = found_twice(window_rows(own.join(places, "class"), window)).union(direct)
    starts = repeated.groupBy("class").agg(F.collect_set("place").alias("starts"))
    cut = without_repeats(own.join(starts, "class"), window)

    out = rows.join(copied, "class").join(cut, "class", "left")
    everywhere = (F.col("copies") > 1) & (F.col("n_words") >= window)
    digest = F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2("kept", 256))
    return out.select(
        "doc_id", "n_words",
        F.when(everywhere, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(everywhere, F.lit(EMPTY)).otherwise(digest).alias("kept_sha256"),
        F.when(everywhere, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
