"""Language-model scores by a hierarchical Pitman-Yor model.

Tokens are words (lower-cased A-Z, between ASCII blanks) and one end per text. Every word that precedes a token, and the start of a text,
has a context restaurant of its own. Their parent is the root restaurant, whose customers are their tables; it draws from a uniform base over
the vocabulary and one unknown token. Tables are sampled by Gibbs: given the parent's
predictive probability and everybody else's seating, the number of tables of a dish with c customers has the weight S(c, t) P^t
times the rising product of strength and discount, S being generalised Stirling numbers. Predictive probabilities are averaged over
the last SAMPLES sweeps; discounts are n1 / (n1 + 2 n2) of the counts at each level.

Up to COMMON words have codes: their totals, as words and as contexts, are vectors of that length that every task gets. Up to FREQUENT pairs
of them stay with their texts and are seated by the driver. All other tokens go to shards: those of a word without a code by word,
so that its seat at the root is known there, the others by pair. What a shard doesn't know are the tables in the
restaurants of contexts without a code. It asks homes for them, each of which adds up a range of contexts over all shards after every sweep. Sweeps see only
dishes with two customers or more, for one customer has one table; tokens are read again when they are scored, WAVES parts one after the other.

Texts learn or are held out by crc32 of their id as text. A null id counts as the empty text, a null text as an empty
one: one end. Repeated rows are rows. Without training tokens only the uniform base is left. An empty table gives an empty
result; other columns are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import shuffle_partitions, small_batches, stored, text_bytes, text_column
from flowlens.llm.words import find_words, mix, word_hashes

SWEEPS, SAMPLES = 3, 2
STRENGTH = 1.0
#: Words with codes and pairs that stay with their texts, at most; chosen by counts in a part of the texts, which decides where work is done, not what comes out.
COMMON, FREQUENT = 65_000, 65_000
OTHER = 65_535
CODES = 65_536
#: Of so many pieces of a task one is counted for that choice.
COUNTED = 4
#: Tokens of a shard, about, at most and, unless there are few, at least; shards for one home.
SHARD_TOKENS, LEAST_TOKENS = 1_000_000, 100_000
SHARDS_PER_HOME = 16
WAVES = 2
#: Parts in which vectors are added up.
SLOTS = 16
#: Bytes of text that are cut into shards together.
PIECE_BYTES = 2 << 20
#: Up to this many customers of a dish the weights of all table numbers are summed; beyond, customers are seated in turn, in growing parties.
STIRLING = 40
END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
#: Rows of megabytes are compressed one by one, not a hundred together.
PACKED = {"compression": "zstd", "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
# kinds of stored rows
TEXTS, STATE, ASK, DENSE, TOKENS = 0, 1, 2, 3, 4


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return b"".join([head.tobytes(), *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)])


def unpack(payload: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    head = np.frombuffer(payload, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 * (1 + 2 * n), []
    for code, size in head.tolist():
        array = np.frombuffer(payload, np.dtype(chr(code)), size, at)
        out.append(array)
        at += array.nbytes + -array.nbytes % 8
    return out


def small(a: np.ndarray) -> np.ndarray:
    """The same whole numbers, none negative, in as few bytes as the largest needs."""
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, hash of the one before (its context) and text number of every token."""
    words = find_words(column, lower=True)
    counts = words.counts
    total = len(words.starts) + len(counts)
    ends = words.first[1:] + np.arange(len(counts))
    found = np.full(total, END)
    is_word = np.ones(total, bool)
    is_word[ends] = False
    found[is_word] = word_hashes(words)
    before = np.empty(total, np.uint64)
    before[1:] = found[:-1]
    before[ends - counts] = _START
    return found, before, np.repeat(np.arange(len(counts)), counts + 1)


def text_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order, about PIECE_BYTES of text and less than 65,536 rows together."""
    held, size, rows = [], 0, 0
    for batch in batches:
        offsets, _ = text_bytes(text_column(batch, "text"))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES - size, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows, at + 65_000 - rows)
            held.append(batch.slice(at, end - at))
            size, rows, at = size + int(offsets[end] - offsets[at]), rows + end - at, end
            if size >= PIECE_BYTES or rows >= 65_000 or at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def column_of(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.fill_null("") if pa.types.is_string(column.type) and column.null_count else column


def codes_of(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    return np.where(common[at] == hashes, at, OTHER).astype(np.uint16)


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes, ascending, of the words with codes; pairs (code of the word << 16 | code of its context), ascending; number of tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for i, table in enumerate(text_pieces(batches)):
            column = column_of(table, "text")
            if i % COUNTED:
                total += len(find_words(column, lower=True).starts) + len(column)
                continue
            found, before, _ = tokens(column)
            total += len(found)
            names, counts = np.unique(found, return_counts=True)
            often = counts > 2 + len(found) // 100_000
            yield out(1, names[often], names[often], counts[often])
            both = mix(before) ^ found
            _, first, counts = np.unique(both, return_index=True, return_counts=True)
            often = counts > 7 + len(found) // 100_000
            yield out(2, found[first[often]], before[first[often]], counts[often])
        nothing = np.zeros(1, np.uint64)
        yield out(0, nothing, nothing, np.array([total]))

    def out(kind: int, names: np.ndarray, before: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(np.full(len(n), kind, np.int32)), pa.array(names.view(np.int64)), pa.array(before.view(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "name", "before", "n"])

    counts = rows.select("text").mapInArrow(work, "kind int, name long, before long, n long")
    sums = stored(counts.groupBy("kind", "name", "before").agg(F.sum("n").alias("n")), "frequent")
    total = sums.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    first = [sums.filter(F.col("kind") == kind).orderBy(F.desc("n"), "name", "before").limit(most).toPandas() for kind, most in ((1, COMMON - 2), (2, FREQUENT))]
    words, contexts = (first[1][c].to_numpy(np.int64).astype(np.uint64) for c in ("name", "before"))
    common = np.unique(np.concatenate((first[0]["name"].to_numpy(np.int64).astype(np.uint64), [END, _START])))
    words, contexts = codes_of(words, common).astype(np.uint32), codes_of(contexts, common).astype(np.uint32)
    pairs = (words << np.uint32(16) | contexts)[(words != OTHER) & (contexts != OTHER)]
    return common, np.unique(pairs), total


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows that follow one another with the same first column: it, and their other columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[0] != key and held:
                yield key, held
                held = []
            key = row[0]
            held.append(row[1:])
    if held:
        yield key, held


def runs_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else np.empty(0, np.int64)


def shards_and_texts(rows: DataFrame, common: np.ndarray, pairs: np.ndarray, shards: int, homes: int, partitions: int) -> DataFrame:
    """(kind, shard, home, base, payload, ids, held_out): per piece of texts its frequent pairs (TEXTS); per shard the state its sweeps
    start from (STATE), its tokens (from TOKENS on, by wave) and per home the contexts without a code it asks for (ASK)."""
    kind_of_id = dict(rows.dtypes)["doc_id"]
    id_type = {"string": pa.string(), "int": pa.int32()}.get(kind_of_id, pa.int64())
    schema = f"kind int, shard int, home int, base long, payload binary, ids array<{kind_of_id}>, held_out array<boolean>"
    edges = np.array([i * (2**64 // homes) for i in range(1, homes)], np.uint64)

    def out(rows: list[tuple], table: pa.Table | None = None) -> pa.RecordBatch:
        """Rows (kind, shard, home, base, payload); the first one is that of the texts, if there are."""
        kind, shard, home, base, payload = zip(*rows, strict=True)
        rest = [None] * (len(rows) - 1)
        ids = pa.array([table.column("doc_id").to_pylist() if table else None, *rest], pa.list_(id_type))
        held = pa.array([table.column("held_out").to_pylist() if table else None, *rest], pa.list_(pa.bool_()))
        arrays = [*(pa.array(x, pa.int32()) for x in (kind, shard, home)), pa.array(base, pa.int64()), pa.array(payload, pa.binary()), ids, held]
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "shard", "home", "base", "payload", "ids", "held_out"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_pieces(batches):
            found, before, text = tokens(column_of(table, "text"))
            base = int(table.column("base")[0].as_py())
            learns = ~np.array(table.column("held_out").to_numpy(zero_copy_only=False), dtype=bool)
            word = codes_of(found, common)
            context = np.empty_like(word)
            context[1:] = word[:-1]
            context[runs_of(text)] = np.searchsorted(common, _START)
            both = word.astype(np.uint32) << np.uint32(16) | context
            at = np.minimum(np.searchsorted(pairs, both), max(len(pairs) - 1, 0))
            often = pairs[at] == both if len(pairs) else np.zeros(len(both), bool)
            known = pack(text[often].astype(np.uint16), at[often].astype(np.uint16), np.bincount(text, minlength=len(learns)).astype(np.uint32))

            rest = np.flatnonzero(~often)
            coded = word[rest] != OTHER
            deal = found[rest]
            deal[coded] ^= mix(before[rest[coded]])
            own = (mix(deal) % np.uint64(shards)).astype(np.uint16 if shards < CODES else np.int64)
            order = np.argsort(own, kind="stable")
            rest, bounds = rest[order], np.searchsorted(own[order], np.arange(shards + 1))
            word, context, text, found, before = word[rest], context[rest], text[rest].astype(np.uint16), found[rest], before[rest]
            words, contexts = (np.concatenate(([0], np.cumsum(x == OTHER)))[bounds] for x in (word, context))
            found, before = found[word == OTHER], before[context == OTHER]
            flags, size = np.packbits(learns), np.array([len(learns)])
            made = [(TEXTS, base % shards, 0, base, known)]
            for s in np.flatnonzero(np.diff(bounds)).tolist():
                a, b = bounds[s], bounds[s + 1]
                payload = pack(word[a:b], context[a:b], text[a:b], found[words[s] : words[s + 1]], before[contexts[s] : contexts[s + 1]], flags, size)
                made.append((TOKENS, s, 0, base, payload))
            yield out(made, table)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a shard follow one another, after the texts' of the same place."""
        shard, held = -1, []
        for batch in batches:
            for i, kind in enumerate(batch.column(0).to_pylist()):
                s = batch.column(1)[i].as_py()
                if s != shard and held:
                    yield joined(shard, held)
                    held = []
                shard = s
                if kind == TEXTS:
                    yield batch.slice(i, 1)
                else:
                    held.append((batch.column(3)[i].as_py(), unpack(batch.column(4)[i].as_py())))
        if held:
            yield joined(shard, held)

    def keys(codes: list[np.ndarray], hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of tokens, the code or CODES + the place among the hashes of those without one, and these hashes."""
        key = np.concatenate(codes).astype(np.int64)
        names, place = np.unique(np.concatenate(hashes), return_inverse=True)
        key[key == OTHER] = CODES + place
        return key, names

    def joined(shard: int, held: list) -> pa.RecordBatch:
        word, _ = keys([x[0] for _, x in held], [x[3] for _, x in held])
        context, names = keys([x[1] for _, x in held], [x[4] for _, x in held])
        text = np.concatenate([x[2] for _, x in held])
        piece = np.repeat(np.arange(len(held)), [len(x[2]) for _, x in held])
        learns = np.concatenate([np.unpackbits(x[5])[: x[6][0]][x[2]] for _, x in held])
        both = word << 32 | context
        order = np.argsort(both)
        both = both[order]
        first = runs_of(both)
        runs = np.diff(np.append(first, len(both)))
        customers = np.add.reduceat(learns[order].astype(np.int64), first)
        words, pair_word = np.unique(both[first] >> 32, return_inverse=True)
        contexts, pair_context = np.unique(both[first] & 0xFFFFFFFF, return_inverse=True)
        bases, texts = np.array([b for b, _ in held], np.int64), np.array([x[6][0] for _, x in held])
        coded = [words[: np.searchsorted(words, CODES)], contexts[: np.searchsorted(contexts, CODES)]]
        sizes = np.array([len(words), len(contexts)])
        payload = pack(
            *(small(x) for x in coded), sizes, small(np.bincount(pair_word)), small(pair_context), small(customers), small(runs),
            small(piece[order]), text[order], bases, texts,
        )
        one, more = customers == 1, customers > 1
        cuts = np.concatenate(([0], np.searchsorted(names, edges), [len(names)]))
        served = np.bincount(pair_context, customers, len(contexts)).astype(np.int64)
        state = pack(
            *(small(x) for x in coded), sizes, cuts, small(np.bincount(pair_word[one], minlength=len(words))),
            small(np.bincount(pair_context[one], minlength=len(contexts))), small(np.bincount(pair_word, customers, len(words)).astype(np.int64)),
            small(served), small(pair_word[more]), small(pair_context[more]), small(customers[more]),
        )
        served = served[len(coded[1]) :]
        made = [(STATE, shard, 0, -1, state), (TOKENS + shard % WAVES, shard, 0, -1, payload)]
        for h in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[h], cuts[h + 1]
            made.append((ASK, shard, h, -1, pack(names[a:b], small(served[a:b]))))
        return out(made)

    made = rows.mapInArrow(cut, schema).repartition(partitions, "shard").sortWithinPartitions("shard", "kind", "base")
    return made.mapInArrow(join, schema)


class Totals(NamedTuple):
    """What all shards share: by code a context's tables and customers, a word's probability at the root and count; all tables, those of the root."""

    tables: np.ndarray
    customers: np.ndarray
    parent: np.ndarray
    counts: np.ndarray
    all_tables: float
    root_tables: float
    words: int
    train_tokens: int
    discount: float
    root_discount: float


def root_chance(customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
    """The root's predictive probability of words with so many customers and tables there."""
    below = STRENGTH + totals.all_tables
    base = (STRENGTH + totals.root_discount * totals.root_tables) / below / (totals.words + 1)
    return np.maximum(customers - totals.root_discount * tables, 0) / below + base


def log_stirling(size: int, discount: float) -> np.ndarray:
    table = np.full((size + 1, size + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(size):
        t = np.arange(c + 1)
        grow = np.log(np.maximum(c - t * discount, 1e-300))
        table[c + 1, : c + 1] = np.where(c - t * discount > 0, table[c, : c + 1] + grow, -np.inf)
        table[c + 1, 1 : c + 2] = np.logaddexp(table[c + 1, 1 : c + 2], table[c, : c + 1])
    return table


def sample_tables(
    customers: np.ndarray, parent: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish, given the parent's probability of it and the other dishes' tables in its restaurant."""
    out = np.ones(len(customers), np.int64)
    stirling = log_stirling(STIRLING, discount)
    for c in range(2, STIRLING + 1):
        rows = np.flatnonzero(customers == c)
        if len(rows):
            t = np.arange(1, c + 1)
            rising = np.cumsum(np.log(strength + discount * (others[rows][:, None] + t - 1)), axis=1)
            weight = stirling[c, 1 : c + 1] + t * np.log(parent[rows])[:, None] + rising
            out[rows] = (weight + rng.gumbel(size=weight.shape)).argmax(axis=1) + 1
    rows = np.flatnonzero(customers > STIRLING)
    if len(rows):
        left, seated, tables = customers[rows] - 1, np.ones(len(rows)), np.ones(len(rows), np.int64)
        while left.any():
            party = np.minimum(left, np.maximum(1, seated.astype(np.int64) // 64))
            fresh = (strength + discount * (others[rows] + tables)) * parent[rows]
            opened = rng.binomial(party, fresh / (fresh + np.maximum(seated - discount * tables, 1e-9)))
            tables, seated, left = tables + opened, seated + party, left - party
        out[rows] = tables
    return out


def seat_root(customers: np.ndarray, tables: np.ndarray, totals: Totals, rng: np.random.Generator) -> np.ndarray:
    """New tables of words at the root, given their customers there and the tables they had."""
    out = np.where(customers > 0, np.minimum(tables, np.maximum(customers, 1)), 0)
    known = np.flatnonzero(customers > 0)
    others = np.maximum(totals.root_tables - out[known], 0)
    base = np.full(len(known), 1.0 / (totals.words + 1))
    out[known] = sample_tables(customers[known], base, others, totals.root_discount, STRENGTH, rng)
    return out


class Shard:
    """Dishes of one shard with two customers or more, what the others add up to, and their seating."""

    def __init__(self, payload: bytes):
        words, contexts, (n_words, n_contexts), cuts, one_word, one_context, counts, served, self.word, self.context, customers = unpack(payload)
        self.words, self.contexts, self.n_words, self.n_contexts, self.cuts = words, contexts, int(n_words), int(n_contexts), cuts
        self.one_word, self.one_context, self.counts, self.served = (x.astype(np.int64) for x in (one_word, one_context, counts, served))
        self.customers = customers.astype(np.int64)
        self.seat(np.ones(len(customers), np.int64))
        self.root_tables = (self.root_customers[len(words) :] > 0).astype(np.int64)

    def seat(self, tables: np.ndarray) -> None:
        self.tables = tables.astype(np.int64)
        self.root_customers = np.bincount(self.word, self.tables, self.n_words).astype(np.int64) + self.one_word
        self.in_context = np.bincount(self.context, self.tables, self.n_contexts).astype(np.int64) + self.one_context

    def sweep(self, asked: np.ndarray, totals: Totals, rng: np.random.Generator) -> None:
        """`asked` are all tables of the contexts without a code."""
        n = len(self.words)
        in_context = np.concatenate((totals.tables[self.contexts], asked))
        parent = np.concatenate((totals.parent[self.words], root_chance(self.root_customers[n:], self.root_tables, totals)))
        others = np.maximum(in_context[self.context] - self.tables, 0)
        self.seat(sample_tables(self.customers, parent[self.word], others, totals.discount, STRENGTH, rng))
        self.root_tables = seat_root(self.root_customers[n:], self.root_tables, totals, rng)

    def shares(self) -> list[tuple[int, bytes]]:
        """Per home the shard's tables in the contexts it asks for."""
        mine = self.in_context[len(self.contexts) :]
        return [(h, pack(small(mine[self.cuts[h] : self.cuts[h + 1]]))) for h in np.flatnonzero(np.diff(self.cuts)).tolist()]


_STEP = "kind int, shard int, home int, payload binary"


def step_rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kind, shard, home, payload = zip(*rows, strict=True)
    arrays = [*(pa.array(x, pa.int32()) for x in (kind, shard, home)), pa.array(payload, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "shard", "home", "payload"])


def dense_rows(vectors: list[np.ndarray], numbers: np.ndarray) -> pa.RecordBatch:
    """A task's sums: SLOTS parts of vectors by code, and some numbers."""
    parts = zip(*(np.array_split(v, SLOTS) for v in vectors), strict=True)
    return step_rows([*((DENSE, -1, i, pack(*(small(p) for p in part))) for i, part in enumerate(parts)), (DENSE, -1, SLOTS, pack(numbers))])


def added_up(table: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The sums of all tasks' vectors and numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, held in groups(batches):
            sums: list = []
            for (payload,) in held:
                arrays = [x.astype(float) for x in unpack(payload)]
                sums = [a + b for a, b in zip(sums, arrays, strict=True)] if sums else arrays
            yield step_rows([(DENSE, -1, slot, pack(*sums))])

    rows = table.filter(F.col("kind") == DENSE).select("home", "payload").repartition(SLOTS, "home").sortWithinPartitions("home")
    found = {r["home"]: unpack(r["payload"]) for r in rows.mapInArrow(work, _STEP).collect()}  # SLOTS + 1 rows
    if not found:
        return [], np.empty(0)
    return [np.concatenate(parts) for parts in zip(*(found[i] for i in range(SLOTS)), strict=True)], found[SLOTS][0]


def begin(table: DataFrame, pairs: int) -> DataFrame:
    """First sums and shares, with one table for each dish; frequent pairs are counted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, customers, root, counts, often = (np.zeros(CODES, np.int64) for _ in range(5))
        numbers = np.zeros(8)
        for batch in batches:
            for i, (kind, number, payload) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                if kind == TEXTS:
                    text, at, _ = unpack(payload)
                    learns = ~np.array(batch.column(3)[i].as_py(), dtype=bool)
                    often += np.bincount(at[learns[text]], minlength=CODES)
                    continue
                s = Shard(payload)
                n, m = len(s.words), len(s.contexts)
                tables[s.contexts] += s.in_context[:m]
                customers[s.contexts] += s.served[:m]
                root[s.words] += s.root_customers[:n]
                counts[s.words] += s.counts[:n]
                own = s.root_customers[n:]
                numbers += [
                    s.in_context.sum(), s.root_tables.sum(), (s.counts[n:] > 0).sum(), s.one_word.sum(), (s.customers == 2).sum(),
                    (own == 1).sum(), (own == 2).sum(), s.served.sum(),
                ]
                if shares := s.shares():
                    yield step_rows([(ASK, number, h, share) for h, share in shares])
        yield dense_rows([tables, customers, root, counts, often], numbers)

    return stored(table.filter(F.col("kind").isin(TEXTS, STATE)).select("kind", "shard", "payload", "held_out").mapInArrow(work, _STEP), "begun", "kind")


def answers(table: DataFrame, steps: list[DataFrame], partitions: int) -> DataFrame:
    """(shard, turn, home, payload): for the contexts a shard asks a home for, their customers and their tables after each of the steps."""
    turns = range(1, len(steps) + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, held in groups(batches):
            got = [(shard, turn, unpack(payload)) for shard, turn, payload in held]
            asks = [(shard, *x) for shard, turn, x in got if turn == 0]
            names, place = np.unique(np.concatenate([x[1] for x in asks]), return_inverse=True)
            sums = [np.bincount(place, np.concatenate([x[2] for x in asks]), len(names))]
            for step in turns:
                sums.append(np.bincount(place, np.concatenate([x[0] for _, turn, x in got if turn == step]), len(names)))
            at = 0
            for shard, mine, _ in asks:
                where = place[at : at + len(mine)]
                at += len(mine)
                yield step_rows([(2, shard, home, pack(*(small(x[where].astype(np.int64)) for x in sums)))])

    rows = table.filter(F.col("kind") == ASK).selectExpr("home", "shard", "0 AS turn", "payload")
    for i, step in enumerate(steps, 1):
        rows = rows.unionByName(step.filter(F.col("kind") == ASK).selectExpr("home", "shard", f"{i} AS turn", "payload"))
    made = rows.repartition(partitions, "home").sortWithinPartitions("home", "shard", "turn").mapInArrow(work, _STEP)
    return made.selectExpr("shard", "kind AS turn", "home", "payload")


def asked(held: list[tuple], steps: int) -> list[np.ndarray]:
    """Customers, and tables after each step, of a shard's contexts without a code: its answers follow in order of the homes."""
    got = [unpack(payload) for turn, _, payload in held if turn == 2]
    return [np.concatenate([x[i] for x in got]).astype(np.int64) if got else np.empty(0, np.int64) for i in range(steps + 1)]


def sweep(table: DataFrame, before: DataFrame, totals: Totals, number: int, partitions: int) -> DataFrame:
    """A sweep over all shards: their seating, their shares for the homes, and sums."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, root, numbers = np.zeros(CODES, np.int64), np.zeros(CODES, np.int64), np.zeros(2)
        for shard, held in groups(batches):
            s = Shard(held[0][2])
            for turn, _, payload in held[1:2]:
                if turn == 1:
                    seating, s.root_tables = unpack(payload)
                    s.seat(seating)
                    s.root_tables = s.root_tables.astype(np.int64)
            s.sweep(asked(held, 1)[1], totals, np.random.default_rng([shard, number]))
            tables[s.contexts] += s.in_context[: len(s.contexts)]
            root[s.words] += s.root_customers[: len(s.words)]
            numbers += [s.in_context.sum(), s.root_tables.sum()]
            yield step_rows([(STATE, shard, 0, pack(small(s.tables), small(s.root_tables))), *((ASK, shard, h, share) for h, share in s.shares())])
        yield dense_rows([tables, root], numbers)

    rows = table.filter(F.col("kind") == STATE).selectExpr("shard", "0 AS turn", "home", "payload")
    rows = rows.unionByName(before.filter(F.col("kind") == STATE).selectExpr("shard", "1 AS turn", "home", "payload"))
    rows = rows.unionByName(answers(table, [before], partitions))
    return stored(rows.repartition(partitions, "shard").sortWithinPartitions("shard", "turn", "home").mapInArrow(work, _STEP), "sweep", "kind")


class Coded:
    """The driver's part: frequent pairs and, at the root, the words with codes. Its size is bounded by FREQUENT and COMMON."""

    def __init__(self, pairs: np.ndarray, vectors: list[np.ndarray], numbers: np.ndarray):
        self.word, self.context = (pairs >> np.uint32(16)).astype(np.int64), (pairs & np.uint32(0xFFFF)).astype(np.int64)
        if not vectors:
            vectors, numbers = [np.zeros(CODES) for _ in range(5)], np.zeros(8)
        tables, customers, root, counts, often = vectors
        self.counts = often[: len(pairs)].astype(np.int64)
        self.tables = (self.counts > 0).astype(np.int64)
        counts = counts + np.bincount(self.word, self.counts, CODES)
        self.root_customers = self.at_root(root)
        self.root_tables = (self.root_customers > 0).astype(np.int64)
        n, at = numbers, self.root_customers
        ones = [(n[3] + (self.counts == 1).sum(), n[4] + (self.counts == 2).sum()), (n[5] + (at == 1).sum(), n[6] + (at == 2).sum())]
        discount, root_discount = (float(np.clip(a / max(a + 2 * b, 1), 0.1, 0.95)) for a, b in ones)
        words, train_tokens = int(n[2] + (counts > 0).sum()), int(n[7] + self.counts.sum())
        customers = customers + np.bincount(self.context, self.counts, CODES)
        empty = np.empty(0)
        self.totals = self.with_root(Totals(empty, customers, empty, counts, 0, 0, words, train_tokens, discount, root_discount), tables, n[0], n[1])

    def at_root(self, root: np.ndarray) -> np.ndarray:
        return (root + np.bincount(self.word, self.tables, CODES)).astype(np.int64)

    def with_root(self, totals: Totals, tables: np.ndarray, all_tables: float, root_tables: float) -> Totals:
        tables = tables + np.bincount(self.context, self.tables, CODES)
        totals = totals._replace(tables=tables, all_tables=all_tables + self.tables.sum(), root_tables=root_tables + self.root_tables.sum())
        return totals._replace(parent=root_chance(self.root_customers, self.root_tables, totals))

    def sweep(self, rng: np.random.Generator) -> None:
        """Seats the frequent pairs; the root follows when the shards' tables are known."""
        more = np.flatnonzero(self.counts > 1)
        others = np.maximum(self.totals.tables[self.context[more]] - self.tables[more], 0)
        parent = self.totals.parent[self.word[more]]
        self.tables[more] = sample_tables(self.counts[more], parent, others, self.totals.discount, STRENGTH, rng)

    def follow(self, vectors: list[np.ndarray], numbers: np.ndarray, rng: np.random.Generator) -> None:
        tables, root = vectors or [np.zeros(CODES)] * 2
        self.root_customers = self.at_root(root)
        self.root_tables = seat_root(self.root_customers, self.root_tables, self.totals, rng)
        self.totals = self.with_root(self.totals, tables, *(numbers if len(numbers) else (0, 0)))

    def chances(self) -> np.ndarray:
        x = self.totals
        new = (STRENGTH + x.discount * x.tables[self.context]) * x.parent[self.word]
        return (new + np.maximum(self.counts - x.discount * self.tables, 0)) / (STRENGTH + x.customers[self.context])


def shard_scores(tokens: DataFrame, messages: DataFrame, after: list[Totals], partitions: int) -> DataFrame:
    """(base, payload): per piece of texts the sums over the task's shards. `after` are the totals after each of the last sweeps."""

    def chances(parts: list[np.ndarray], held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Probability and training count of the word of every pair."""
        words, contexts, (n_words, n_contexts), word_pairs, pair_context, customers = parts[:6]
        n, pair_word = len(words), np.repeat(np.arange(n_words), word_pairs)
        customers = customers.astype(np.int64)
        served, *tables = asked(held, len(after))
        below = STRENGTH + np.concatenate((after[0].customers[contexts], served))[pair_context]
        seatings = [unpack(payload) for turn, _, payload in held if turn == 1]
        chance = np.zeros(len(pair_word))
        for totals, in_context, (seating, root_tables) in zip(after, tables, seatings, strict=True):
            seated = (customers > 0).astype(np.int64)
            seated[customers > 1] = seating
            at_root = np.bincount(pair_word, seated, int(n_words))[n:]
            parent = np.concatenate((totals.parent[words], root_chance(at_root, root_tables, totals)))
            new = (STRENGTH + totals.discount * np.concatenate((totals.tables[contexts], in_context)))[pair_context] * parent[pair_word]
            chance += (new + np.maximum(customers - totals.discount * seated, 0)) / below / len(after)
        counts = np.concatenate((after[0].counts[words], np.bincount(pair_word, customers, int(n_words))[n:]))
        return chance, counts[pair_word]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        size = 0
        for _, held in groups(batches):
            parts = unpack(held[0][2])
            chance, count = chances(parts, held)
            runs, piece, text, bases, texts = parts[6:]
            starts = np.concatenate(([0], np.cumsum(texts)))
            at = starts[piece] + text
            found = [np.bincount(at, np.repeat(w, runs), starts[-1]) for w in (np.log10(count + 0.5), np.log10(chance), (count > 0).astype(float))]
            for b, x, y in zip(bases.tolist(), starts, starts[1:], strict=False):
                if b in sums:
                    for old, new in zip(sums[b], found, strict=True):
                        old += new[x:y]
                else:
                    sums[b] = [p[x:y].copy() for p in found]
                    size += y - x
            if size > 2_000_000:
                yield out(sums)
                sums, size = {}, 0
        if sums:
            yield out(sums)

    def out(sums: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        payload = [pack(p, q, small(k.round().astype(np.int64))) for p, q, k in sums.values()]
        return pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), pa.array(payload, pa.binary())], names=["base", "payload"])

    rows = tokens.selectExpr("shard", "0 AS turn", "home", "payload").unionByName(messages)
    return rows.repartition(partitions, "shard").sortWithinPartitions("shard", "turn", "home").mapInArrow(work, "base long, payload binary")


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = df.sparkSession
    small_batches(spark, 250)
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (F.crc32(name.cast("binary")) % 5 == 1).alias("held_out"),
        F.monotonically_increasing_id().alias("base"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    common, pairs, n = frequent(rows)
    partitions = shuffle_partitions(spark)
    shards = max(8, min(8 * partitions, n // LEAST_TOKENS), n // SHARD_TOKENS)
    homes = max(1, shards // SHARDS_PER_HOME)
    small_batches(spark, 64)  # rows are packed pieces from here on
    table = stored(shards_and_texts(rows, common, pairs, shards, homes, partitions), "shards", "kind", **PACKED)

    small_batches(spark, 16)
    steps = [begin(table, len(pairs))]
    coded = Coded(pairs, *added_up(steps[0]))
    after, frequent_chance = [], np.zeros(len(pairs))
    for i in range(1, SWEEPS + 1):
        steps.append(sweep(table, steps[-1], coded.totals, i, partitions))
        rng = np.random.default_rng([shards, i])
        coded.sweep(rng)
        coded.follow(*added_up(steps[-1]), rng)
        if i > SWEEPS - SAMPLES:
            after.append(coded.totals)
            frequent_chance += coded.chances() / SAMPLES
    small_batches(spark, 4)
    messages = answers(table, steps[-SAMPLES:], partitions)
    for i, step in enumerate(steps[-SAMPLES:]):
        messages = messages.unionByName(step.filter(F.col("kind") == STATE).selectExpr("shard", "1 AS turn", f"{i} AS home", "payload"))
    scored = []
    for wave in range(WAVES):
        tokens_of, own = table.filter(F.col("kind") == TOKENS + wave), messages.filter(F.col("shard") % WAVES == wave)
        scored.append(stored(shard_scores(tokens_of, own, after, -(-partitions // WAVES)), "scores"))

    totals = coded.totals
    logs, counts = np.log10(frequent_chance), totals.counts[coded.word]
    train_tokens, below = totals.train_tokens, float(np.log10(totals.train_tokens + 0.5 * (totals.words + 1)))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a piece follow one another, its texts first."""
        base, held, sums = None, None, None
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(batch.num_rows)):
                b, payload = one.column(0)[0].as_py(), unpack(one.column(2)[0].as_py())
                if b != base:
                    if held is not None:
                        yield result(held, sums)
                    base, held = b, one
                    at, pair, n_tokens = payload
                    known = counts[pair]
                    sums = [np.bincount(at, w, len(n_tokens)).astype(float) for w in (np.log10(known + 0.5), logs[pair], known > 0)]
                    sums.append(n_tokens)
                else:
                    for old, new in zip(sums, payload, strict=False):
                        old += new
        if held is not None:
            yield result(held, sums)

    def result(one: pa.RecordBatch, sums: list[np.ndarray]) -> pa.RecordBatch:
        base_sum, score, known, n_tokens = sums
        arrays = [
            one.column(3).flatten(), one.column(4).flatten(), pa.array(n_tokens.astype(np.int64)), pa.array(known.round().astype(np.int64)),
            pa.array(np.full(len(score), train_tokens, np.int64)), pa.array(base_sum - n_tokens * below), pa.array(score), pa.array(10 ** (-score / n_tokens)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    small_batches(spark, 64)
    both = table.filter(F.col("kind") == TEXTS).selectExpr("base", "0 AS turn", "payload", "ids", "held_out")
    for part in scored:
        both = both.unionByName(part.selectExpr("base", "1 AS turn", "payload"), allowMissingColumns=True)
    return both.repartition("base").sortWithinPartitions("base", "turn").mapInArrow(add_up, schema)
