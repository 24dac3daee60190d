"""Filter audit, toxicity and conversation repair beside brute-force versions, with nulls, long texts, ties, repeats, extra columns."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from flowlens.llm import audit, toxicity, turns

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = {"part": "p", "mask": "m", "hash": "h", "id": "i", "first": "f", "_text": "t", "_id": "x", "weight": "w", "score": "s"}


# --- op11 ------------------------------------------------------------------------------------------

TEXTS = [
    " ".join(f"w{i}" for i in range(120)), " ".join(["again"] * 130), "SHOUT " * 110, "few words", "", None, "a # b " * 60,
    " ".join(f"w{i}" for i in range(120)), "few words", " ".join(f"A{i}x" for i in range(150)), "x" * 1_200_000, "\t\n ",
]
DOCS = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(TEXTS)] + [(8, "few words", "en"), (None, "few words", "en"), (None, None, None)]
LABELS = [(0, 1, 0), (1, 0, 1), (3, 1, 1), (3, None, None), (7, 1, None), (8, None, 1), (99, 1, 1), (None, 1, 1)]


def brute_audit(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    fails, parts = [], [p or "" for _, _, p in docs]
    for d, text, _ in docs:
        t = text or ""
        w = WORD.findall(t)
        earlier = any(o is not None and d is not None and o < d and (x or "") == t for o, x, _ in docs)
        bad = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), earlier]
        fails.append({f for f, b in zip("ABCDE", bad, strict=True) if b})
    out = {}
    for part in set(parts):
        rows = [i for i, p in enumerate(parts) if p == part]
        removed = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive, gone = set(rows), set()
            for step, f in enumerate(order, 1):
                here = {i for i in alive if f in fails[i]}
                again = sum(f in fails[i] for i in gone)
                alive, gone = alive - here, gone | here
                removed[f] += len(here)
                unique = sum(fails[i] == {f} for i in rows)
                out[part, "".join(order), step] = [
                    len(alive), len(here), again, unique, sum(docs[i][0] in good for i in here), sum(docs[i][0] in toxic for i in here),
                ]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(removed[f])
    return out


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in df.columns})


@pytest.mark.parametrize("broadcast", [True, False], ids=["sent", "joined"])
def test_filter_audit(spark, monkeypatch, broadcast):
    monkeypatch.setattr(audit, "BROADCAST_ROWS", 1000 if broadcast else 0)
    docs = with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string, lang string").repartition(3))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in audit.audit(docs, labels).collect()}
    assert got == brute_audit(DOCS, LABELS)


def test_filter_audit_takes_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x", "en"), ("a", "x", "en")], "doc_id string, text string, lang string")
    labels = spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")
    rows = [r for r in audit.audit(docs, labels).collect() if r.filter_order == "EABCD"]
    assert [(r.removed, r.good_lost) for r in sorted(rows, key=lambda r: r.step)][:2] == [(1, 1), (1, 0)]
    assert audit.audit(docs.limit(0), labels).collect() == []
    assert len(audit.audit(docs, labels.limit(0)).collect()) == 600


def test_packed_counters_do_not_reach_each_other():
    """Sums near the width of a field leave the neighbours alone."""
    integers, many = audit.packed_outcomes(), 2**56
    fields = audit.unpack("p", many * integers[audit.MASKS - 1] + 5 * integers[0]).to_pylist()
    first = next(r for r in fields if r["step"] == 1)
    last = next(r for r in fields if r["step"] == 5)
    assert (first["kept"], first["removed"], first["good_lost"], last["kept"], last["redundant"]) == (5, many, many, 5, many)


def test_parts_handed_on_early_add_up(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(audit, "HELD_PARTS", 2)
    batches = [pa.RecordBatch.from_pydict({"part": pa.array(["a", "b", "c", "a"]), "mask": pa.array([1, 2, 3, 1], pa.int32())})] * 3
    sums = sorted((r["part"], r["packed"]) for b in audit.sum_tasks(iter(batches)) for r in b.to_pylist())
    joined = pa.RecordBatch.from_pydict({"part": [p for p, _ in sums], "packed": pa.array([x for _, x in sums], pa.binary())})
    found = {b.to_pylist()[0]["part"]: b.to_pylist()[0] for b in audit.sum_parts(iter([joined]))}
    assert (found["a"]["filter_order"], found["a"]["removed"], found["c"]["unique_fails"]) == ("ABCDE", 6, 0)


# --- op12 ------------------------------------------------------------------------------------------


def toxic_corpus(n, seed=5):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(plain, k=rng.randint(4, 12))) for _ in range(rng.randint(1, 8))]
        bad = i % 4 == 0
        if bad:
            at = rng.randrange(len(sentences))
            words = sentences[at].split()
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vile", "brutish"]))
            sentences[at] = " ".join(words)
        rows.append((i, ". ".join(sentences) + ".", "en"))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = toxic_corpus(600)
    extra = [(1000, None, None), (1001, "", "en"), (1002, ". " * 5, "en"), (None, "vile nasty", "en"), (1003, "so nasty. " + "plain word. " * 100_000, "en")]
    docs = with_clashes(spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").repartition(3))
    known = spark.createDataFrame([*labels, (7, None, None), (None, 1, 1), (1000, 1, 1)], "doc_id long, quality int, toxic int")
    texts = {d: t for d, t, _ in rows + extra}
    return texts, dict((d, t) for d, _, t in labels), {r.doc_id: r for r in toxicity.score_texts(docs, known).collect()}


def test_toxicity_learns_from_document_labels(scored):
    texts, labels, got = scored
    assert set(got) == set(texts)
    for d, r in got.items():
        key = "" if d is None else str(d)
        assert r.held_out == (zlib.crc32(key.encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [d for d, r in got.items() if r.held_out and d in labels]
    right = [got[d].predicted == labels[d] for d in held]
    assert len(held) > 60 and np.mean(right) > 0.97


def test_toxic_sentences_are_located(scored):
    texts, labels, got = scored
    named = 0
    for d, bad in labels.items():
        spans = [texts[d][o.start : o.end] for o in got[d].offending]
        if bad and got[d].predicted:
            named += any(re.search("nasty|vile|brutish", s) for s in spans)
            assert all("." not in s for s in spans)
    assert named > 140
    assert got[1000].score == got[1001].score == got[1002].score == 0
    assert got[1003].predicted == 1 and texts[1003][got[1003].offending[0].start : got[1003].offending[0].end] == "so nasty"


def test_noisy_or_and_its_gradient():
    import pyarrow as pa

    z, text = np.array([0.3, -1.0, 2.0]), np.array([0, 0, 2])
    p = 1 / (1 + np.exp(-z))
    assert np.allclose(toxicity.noisy_or(z, text, 3), [1 - (1 - p[0]) * (1 - p[1]), 0, p[2]])
    batch = pa.RecordBatch.from_pydict({
        "toxic": pa.array([1, 0], pa.int32()), "weight": [1.0, 2.0], "n_sentences": pa.array([2, 1], pa.int32()),
        "sentence": pa.array([[0, 1], [0]], pa.list_(pa.int32())), "feature": pa.array([[0, 1], [1]], pa.list_(pa.int32())),
    })

    def run(w, b):
        row = next(toxicity.gradient(iter([batch]), np.array(w), b)).to_pylist()[0]
        return row["loss"], row["bias"], np.frombuffer(row["gradient"])

    w, b, e = [0.4, -0.7], -0.2, 1e-6
    _, slope_b, slope = run(w, b)
    assert abs((run(w, b - e)[0] - run(w, b + e)[0]) / (2 * e) - slope_b) < 1e-5
    for i in range(2):
        up, down = list(w), list(w)
        up[i], down[i] = up[i] + e, down[i] - e
        assert abs((run(down, b)[0] - run(up, b)[0]) / (2 * e) - slope[i]) < 1e-5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b. c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_texts(docs, none).collect()}
    assert got[2].score == 0 and 0 < got[1].score < 1
    assert toxicity.score_texts(docs.limit(0), none).collect() == []


def test_toxicity_uses_the_text_alone(spark):
    """Labels of held-out rows, and other columns, change no score."""
    rows, labels = toxic_corpus(200)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    frames = [spark.createDataFrame(x, "doc_id long, quality int, toxic int") for x in (labels, flipped)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = ({r.doc_id: r.score for r in toxicity.score_texts(d, f).collect()} for d, f in ((docs, frames[0]), (docs.drop("lang"), frames[1])))
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


# --- op13 ------------------------------------------------------------------------------------------


def cheapest(rows):
    """(cost, audit, repaired rows): least first search over (row, role behind it), where each edit is tried."""
    follows = {"": ("user", "system"), "s": ("user",), "u": ("assistant",), "a": ("user",)}
    todo, settled = [(0, "", 0, "", None)], set()
    while True:
        cost, audit_, i, last, out = heapq.heappop(todo)
        if (i, last) in settled:
            continue
        settled.add((i, last))
        if i == len(rows) and last in ("", "a"):
            kept = []
            while out:
                out, row = out
                kept.append(row)
            return cost, audit_, kept[::-1]
        for role in follows[last]:
            if role != "system":
                heapq.heappush(todo, (cost + 5, audit_ + "I", i, role[0], (out, (role, ""))))
        if i < len(rows):
            role, text, goes, cut = rows[i]
            heapq.heappush(todo, (cost + 2, audit_ + "D", i + 1, last, out))
            if not goes:
                extra = 5 if cut else 0
                if role[:1] in [r[0] for r in follows[last]]:
                    heapq.heappush(todo, (cost + extra, audit_ + "K", i + 1, role[0], (out, (role, text))))
                for new in follows[last]:
                    if new != "system" and role[:1] != new[0]:
                        heapq.heappush(todo, (cost + 1 + extra, audit_ + "R", i + 1, new[0], (out, (new, text))))


def brute_repair(conversation):
    """What op13 says of the rows of one conversation, given after damage."""
    order = sorted(conversation, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    counts, seen, rows = [0, 0, 0], set(), []
    for _, role, text in order:
        last = re.search(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)", text)
        fault = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        rows.append((role, text, fault in (0, 1), fault == 2))
    known = [t for t, _, _ in order if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for _, r, _ in order]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit_, out = cheapest(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit_, digest)


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if what == 1:
            text = ""
        elif what == 2:
            text = re.sub("[.!?]", "", text)
        elif what == 4:
            role = "user"
        if what:
            out[conv] += [(turn, role, text)] * (2 if what == 3 else 1)
    return out


def chat(rng, conv, n):
    turn_of = lambda i: rng.choice([i, i, i, i + rng.randint(0, 3), None])
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "umpire"]
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \n", None, "é. ", "Yes.\x0b"]
    return [(conv, turn_of(i), rng.choice(roles[:5] if rng.random() < 0.8 else roles), rng.choice(texts[:4] if rng.random() < 0.7 else texts)) for i in range(n)]


CHAT = "conv_id long, turn long, role string, text string"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_conversations(spark, partitions):
    """Many ranges cut conversations into segments; results are those of the whole."""
    rng = random.Random(partitions)
    rows = [r for conv in range(60) for r in chat(rng, conv, rng.randint(1, 9))] + chat(rng, None, 7) + [(500, None, None, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(rows, CHAT).selectExpr("*", "1 AS block", "2 AS hash", "3 AS edits", "4 AS later").repartition(3)
        got = {r.conv_id: tuple(r[c] for c in FIELDS) for r in turns.damage_and_repair(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {conv: brute_repair(c) for conv, c in damage(rows).items()}


@pytest.mark.parametrize("broadcast", [True, False], ids=["sent", "joined"])
def test_one_long_conversation_in_many_segments(spark, monkeypatch, broadcast):
    """One conversation holds most rows; its segments' states hang together, and runs are long."""
    monkeypatch.setattr(turns, "BROADCAST_ROWS", 1000 if broadcast else 0)
    rng = random.Random(3)
    rows = [(1, i // 3 if i < 300 else i, rng.choice(["user", "user", "assistant"]), rng.choice(["Say.", "Go on!", "no end", f"{i}."])) for i in range(700)]
    rows += [(1, None, "user", "Same.")] * 50 + [(2, 0, "user", "Hello."), (2, 1, "assistant", "x" * 1_000_000 + ".")]
    clean = {c: [(t, r, x) for k, t, r, x in rows if k == c] for c in (1, 2)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame(rows, CHAT)
        got = {r.conv_id: tuple(r[c] for c in FIELDS) for r in turns.repair_rows(df, df).collect()}
        parts = turns.segments(turns.looked_at(df).selectExpr("*", "false AS later")).filter("conv_id = 1").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts > 4
    assert got == {c: brute_repair(x) for c, x in clean.items()}


def test_conversations_empty(spark):
    assert turns.damage_and_repair(spark.createDataFrame([], CHAT)).collect() == []


def test_runs_equal_rows_one_by_one():
    """Powers by doubling give what single rows give, for every symbol and length."""
    for sign in range(9):
        costs = turns.at_end()
        for n in range(1, 40):
            costs = turns.product(turns.power(sign, 0), costs)
            assert (turns.ahead(sign, n, turns.at_end()) == costs).all()
