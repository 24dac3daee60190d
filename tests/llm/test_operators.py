"""Operators beside brute-force versions on small frames with nulls, empty and long texts, ties, repeated rows and extra columns."""

import collections
import hashlib
import math
import os
import random
import re
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from flowlens.llm import fingerprints, graph, jaccard, licenses, lines, mixing, personal, pieces, pitman_yor, quality, repeats
from flowlens.llm.common import scratch_scope, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"word{i} of line" for i in range(60))
PASSAGE = " ".join(f"shared{i}" for i in range(50))
ROWS = [
    (0, PROSE, "a", 7),
    (1, PROSE, "a", 7),
    (2, PROSE.replace("word59", "other"), "b", 7),
    (3, None, None, None),
    (4, "", "a", None),
    (5, " \n\t ", "b", 1),
    (6, "Short Text", None, 1),
    (7, "one two three " * 400, "a", 1),
    (8, f"begin {PASSAGE} end é🙂", "c", 1),
    (9, f"{PASSAGE}\nmore text behind it", "c", 1),
    (10, "x" * 20000 + " 4111 1111 1111 1111 a.b@c.de 10.0.0.1 +1 (555) 123-4567 MIT License", "a", 1),
    (11, "nav\nhome\n" + PROSE, "b", 1),
    (11, "nav\nhome\n" + PROSE, "b", 1),
    (12, "Short Text", None, 1),
]
SCHEMA = "doc_id long, text string, source string, size int"


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "rows")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(empty):
    for run in (
        fingerprints.compare_with_next, jaccard.similar_groups, licenses.scan, lines.drop_boilerplate, mixing.mix,
        personal.find_personal, pieces.encode, pitman_yor.score_texts, quality.judge, repeats.remove_repeats,
    ):
        assert run(empty).collect() == []


def test_fingerprints(frame):
    got = {r.doc_id: r for r in fingerprints.compare_with_next(frame).collect()}
    ordered = sorted(ROWS, key=lambda r: (r[0], r[1] or ""))
    for (i, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        if i != 11:
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            assert got[i].n_chars == len(text)
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            for other, near in ((edited, got[i].near_edited), (following, got[i].near_next)):
                a, b = shingles(text), shingles(other)
                assert near == pytest.approx(len(a & b) / len(a | b) if a and b else float(a == b), abs=0.1)
    assert got[0].fingerprint == got[1].fingerprint and got[3].fingerprint == ""
    assert len(fingerprints.compare_with_next(frame).collect()) == len(ROWS)


def test_sketches_merge_and_estimate():
    a, b = (np.unique(np.random.default_rng(s).integers(0, 2**63, 5000).astype(np.uint64)) for s in (1, 2))
    both = np.union1d(a, b)
    k = fingerprints.SIZE
    assert (fingerprints.merge(a[:k], b[:k]) == both[:k]).all()
    assert fingerprints.distinct_shingles(both[:k]) == pytest.approx(2 * 10000 / 2, rel=1.2)
    half = np.unique(a[::2])
    assert fingerprints.resemblance(half[:k], a[:k]) == pytest.approx(0.5, abs=0.12)
    assert fingerprints.containment(half[:k], a[:k]) == pytest.approx(1.0, abs=0.2)
    assert (fingerprints.decode(fingerprints.encode(a[:k])) == a[:k]).all()


def test_merged_fingerprints(frame):
    rows = fingerprints.fingerprints(frame).withColumnRenamed("source", "key")
    merged = {r.key: fingerprints.decode(r.fingerprint) for r in fingerprints.merge_fingerprints(rows, "key").collect()}
    for key in {r[2] for r in ROWS}:
        texts = pa.array([r[1] or "" for r in ROWS if r[2] == key])
        whole = np.unique(np.concatenate(fingerprints.distinct_sets(fingerprints.find_words(texts, True))))
        assert (merged[key] == whole[: fingerprints.SIZE]).all()


def brute_groups(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    least = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group)}
    return sorted((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group, strict=True))


def test_jaccard_groups(frame):
    got = jaccard.similar_groups(frame).collect()
    assert sorted(map(tuple, got)) == brute_groups(ROWS)


def test_jaccard_large_blocks(spark, monkeypatch):
    """Many near copies: frequent shingles, chunks of blocks and both verifying steps."""
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        w = [f"w{i % 2}-{k}" for k in range(80)]
        for k in rng.choice(80, int(rng.integers(0, 4)), replace=False):
            w[k] = f"new{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(w)))
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, got)) == brute_groups(rows)


def test_jaccard_deals_blocks_by_their_size(spark, monkeypatch):
    """Near copies whose shared shingles are mostly past the counted part: no block holds much more than a chunk."""
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "CHUNK", 64)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        w = [f"w{k}" for k in range(200)]
        for k in rng.choice(200, int(rng.integers(1, 6)), replace=False):
            w[k] = f"new{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(w[: 200 - 40 * (i % 20 == 0)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = jaccard.node_sets(jaccard.shingle_nodes(docs, "doc_id", "text"))
    found = jaccard.blocks(sets, jaccard.frequent_shingles(sets)).collect()
    assert max(len(r.nodes) for r in found) < 2 * 64
    assert sorted(map(tuple, jaccard.similar_groups(docs).collect())) == brute_groups(rows)


def test_jaccard_large_blocks_of_one_passage_are_joined_once(spark, monkeypatch):
    """Near copies that share many shingles, of which not all are in each prefix: blocks overlap, and their rows stay near one a node."""
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(150):
        w = [f"w{i % 3}-{k}" for k in range(100)]
        for k in rng.choice(100, int(rng.integers(0, 5)), replace=False):
            w[k] = f"new{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = jaccard.node_sets(stored(jaccard.shingle_nodes(docs, "doc_id", "text"), "nodes"))
    large = stored(jaccard.blocks(sets, jaccard.frequent_shingles(sets)), "blocks").filter(f"size(nodes) > {jaccard.SMALL_BLOCK}")
    before = {r.block: set(r.nodes) for r in large.collect()}

    def joined():
        held = {}
        for r in jaccard.joined_blocks(large).collect():
            held.setdefault(r.block, set()).add(r.node)
        assert all(any(nodes <= other for other in held.values()) for nodes in before.values())
        return held

    assert sum(map(len, joined().values())) < sum(map(len, before.values())) / 2
    monkeypatch.setattr(jaccard, "CHUNK", 20)
    assert joined()
    monkeypatch.setattr(jaccard, "CHUNK", 4096)
    expected = brute_groups(rows)
    assert sorted(map(tuple, jaccard.similar_groups(docs).collect())) == expected
    monkeypatch.setattr(jaccard, "TEXTS_PER_PAIR", 10**9)
    assert sorted(map(tuple, jaccard.similar_groups(docs).collect())) == expected


def test_jaccard_group_of_near_copies_makes_no_table_of_its_pairs(spark, monkeypatch):
    """Near copies of which those with few edits link: tables grow with the nodes that are still apart, not with their pairs."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        w = [f"w{k}" for k in range(200)]
        for k in rng.choice(200, int(rng.integers(1, 7)), replace=False):
            w[k] = f"new{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(w)))
    made = {}

    def counted(df, purpose, *args, **options):
        out = stored(df, purpose, *args, **options)
        made[purpose] = max(made.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "LEADERS", 0)
    monkeypatch.setattr(jaccard, "stored", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.similar_groups(docs).collect())) == brute_groups(rows)
    assert max(made[x] for x in ("pairs", "links")) < 5 * len(rows), made


def test_components_of_several_tasks(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 2) for i in range(60)], "u long, v long").repartition(8)
    expected = {i: i % 2 for i in range(62)}
    assert dict(map(tuple, graph.components(edges).collect())) == expected
    monkeypatch.setattr(graph, "TASK_EDGES", 10)
    assert dict(map(tuple, graph.components(edges).collect())) == expected


def test_scratch_tables_go_with_their_scope(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as inner:
            gone = stored(rows, "gone").inputFiles()
            result = inner(stored(rows, "result"))
        assert not any(os.path.exists(urlparse(f).path) for f in gone)
        assert result.count() == 2
        files = result.inputFiles()
        copy = outer(stored(result, "copy"))
    assert files and not any(os.path.exists(urlparse(f).path) for f in files)
    assert copy.count() == 2


def test_cells_let_all_nodes_that_are_apart_meet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    rng = random.Random(6)
    rows = [(d, rng.randrange(2**40) << jaccard.SIZE_BITS | rng.randrange(40), c) for d in (1, 2) for c in [0] * 60 + [1] * 30 + list(range(2, 40))]
    met = {}
    for r in jaccard.cell_blocks(spark.createDataFrame(rows, "dealt long, node long, component long")).collect():
        met.setdefault(r.block, []).append((r.node, r.component))
    pairs = {frozenset((a, b)) for nodes in met.values() for a, _ in nodes for b, _ in nodes}
    for d, a, c in rows:
        for e, b, f in rows:
            if d == e and c != f and abs((a & 1023) - (b & 1023)) <= jaccard.REACH:
                assert frozenset((a, b)) in pairs
    assert all(len({c for _, c in nodes}) > 1 or nodes[0][1] > 1 for nodes in met.values())


def test_tree_bound_loses_nothing():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 4, (200, 32)).astype(np.int32)
    sizes = points.sum(axis=1).astype(np.int64)
    found = {tuple(sorted(p)) for i, j in jaccard.CountTree(points, sizes).pairs() for p in zip(i.tolist(), j.tolist(), strict=True)}
    for i in range(200):
        for j in range(i):
            within = 5 * min(sizes[i], sizes[j]) >= 4 * max(sizes[i], sizes[j])
            if within and np.minimum(points[i], points[j]).sum() >= jaccard.needed(sizes[i], sizes[j]):
                assert (j, i) in found


def test_pieces_agree_with_the_library(frame):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    machine = pieces.Machine(pieces.MODEL)
    rng = np.random.default_rng(4)
    texts = [r[1] or "" for r in ROWS] + ["".join(rng.choice(list("abC  \n\t.é中🙂▁<s>0"), 30)) for _ in range(300)]
    assert [machine.encode(t).tolist() for t in texts] == library.encode(texts)
    rows = pieces.encode(frame, check=True).collect()
    assert all(r.round_trip for r in rows) and len(rows) == len(ROWS)
    decoded = pieces.decode(pieces.encode(frame)).collect()
    assert all(r.decoded == (r.text or "") for r in decoded)


def test_unigram_path_is_the_best():
    machine = pieces.Machine(pieces.MODEL, pieces.UNIGRAM)

    def best(text):
        if not text:
            return 0.0
        options = [(machine.ids[text[:k]], k) for k in range(1, len(text) + 1) if text[:k] in machine.ids]
        return min(-machine.scores[i] + best(text[k:]) for i, k in options)

    for text in ("▁hello", "▁the", "▁abcab"):
        assert sum(-machine.scores[i] for i in machine.unigram_path(text)) == pytest.approx(best(text))


def test_boilerplate_lines(spark):
    rows = [(i, f"menu\nown {i}\n\nmenu", "s" if i % 2 else None, 1) for i in range(20)] + [(20, None, "s", 1), (21, "menu", "t", 1)]
    got = {r.doc_id: r for r in lines.drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].text == f"own {i}\n" and (got[i].n_lines, got[i].n_dropped) == (4, 2) for i in range(20))
    assert (got[20].text, got[20].n_lines) == (None, 0)
    assert got[21].text == "menu"


def test_licenses(spark):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "mit-License and MIT\nlicense"), (3, None),
        (4, "GNU Lesser General Public License v3"), (5, "admit license"), (6, "SPDX-License-Identifier: MPL-2.0"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].base_labels, got[1].labels, got[1].first_word) == ("apache", "apache", 3)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].n_words) == (2, 0, 3, 5)
    assert (got[3].n_words, got[3].labels, got[3].score, got[3].first_word) == (0, "", 0.0, None)
    assert got[4].base_labels == "gpl" and got[4].labels == "gpl,lgpl"
    assert got[5].n_base == 0 and got[6].labels == "mpl"
    assert len(licenses.rules()) > 300


def test_quality_counts(frame):
    for r in quality.judge(frame).collect():
        w = words(r.text)
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
        own = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(own) - len(set(own)), len(again))
        assert tuple(r[c] for c in quality.COUNTS) == counts
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_wide_path(spark, monkeypatch):
    monkeypatch.setattr(quality, "PACKED_WORDS", 4)
    row = quality.base_counts(spark.createDataFrame([("a b c d a b c e",)], "text string")).first()
    assert row.n_repeat_words == 6


def test_rule_order_never_changes_a_verdict(frame):
    verdicts = [
        sorted(map(str, quality.judge(frame, rules=rules).select("doc_id", "kept").collect()))
        for rules in (quality.RULES, quality.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        out += [("card", *m.span())] if 13 <= len(d) <= 19 and luhn(d) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_personal_base_spans(spark):
    texts = [r[1] for r in ROWS] + [
        "a@b.c_x@d.e x@y a@b..c@d.e 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255", "+12 4111 1111 1111 1111 4111-1111-1111-1112 é🙂a.b+c@d-e.f.g.",
        "@@..a@b.c.", "4" * 30 + " 1.2.3.4.", "+1234567890123456 +9 9 9 9 9 9 9 9 9 9", "1 2 " * 3000, "a@" + "b." * 3000 + "c",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = personal.find_personal(frame).collect()
    for r in found:
        assert r.base == base_spans(texts[r.doc_id] or "")
        assert r.spans.startswith(r.base)
    redacted = {r.doc_id: r.text for r in personal.redact(personal.find_personal(frame)).collect()}
    assert "a.b@c.de" not in redacted[10] and redacted[0] == texts[0] and redacted[3] is None


def test_boosted_candidates_learn_formats(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        if i % 2:
            rows.append((i, f"call +1 (555) {rng.integers(100, 999)}-{rng.integers(1000, 9999)} now"))
        else:
            rows.append((i, f"item {rng.integers(10**7, 10**8)} sold on"))
    learnt = personal.learn(spark.createDataFrame(rows, "doc_id int, text string"), "text")
    assert learnt and 2 in learnt[1]


def test_every_text_is_an_example(spark):
    """Proposals of all texts count, those with equal features as one example with a weight."""
    df = spark.range(30_000).selectExpr("concat(if(id % 3 = 0, 'call ', 'item '), 10000000 + id, ' sold') AS text")
    found = personal.examples(df, "text")
    assert found.groupBy("label").agg({"n": "sum"}).orderBy("label").collect() == [(0.0, 20_000), (1.0, 10_000)]
    assert found.count() < 3_000


def test_personal_data_the_base_does_not_know_is_added(spark):
    """IBANs by their checksum; secrets, spelt addresses and phones without + by trees that don't see the words beside them."""
    rng = np.random.default_rng(9)
    texts = []
    for i in range(1200):
        digits = "".join(map(str, rng.integers(0, 10, 40)))
        secret = "".join(rng.choice(list("0123456789abcdef"), 40))
        texts.append([
            f"the token is {secret} here", f"the checksum is {secret[:24]} here",
            f"please write to ann{i} at host{i} dot com today", f"phone ({digits[:3]}) {digits[3:6]}-{digits[6:10]} now", f"item 1{digits[:7]} sold",
        ][i % 5])
    plants = {
        "pay DE89370400440532013000 soon": "code:4:26", "pay GB82 WEST 1234 5698 7654 32 soon": "code:4:31", "pay DE89370400440532013001 soon": "",
        "see (555) 123-4567 there": "number:4:18", "it was 7c9e13b0a8f2564ed07b3c91fa6258e4d1b09c37 once": "code:7:47", "saw bob at home dot com once": "address:4:23",
        "item 12345678 sold": "",
    }
    few = spark.createDataFrame([(t,) for t in plants], "text string")
    only = {r.text: r.spans for r in personal.find_personal(few).collect()}
    assert [only[t] for t in list(plants)[:3]] == ["code:4:26", "code:4:31", ""]
    found = personal.find_personal(spark.createDataFrame([(t,) for t in texts + list(plants)], "text string")).collect()
    got = {r.text: (r.base, r.spans) for r in found}
    assert {t: got[t] for t in plants} == {t: ("", s) for t, s in plants.items()}


def brute_repeats(rows, window):
    all_words = [words(t) for _, t, *_ in rows]
    seen = collections.Counter(tuple(w[k : k + window]) for w in all_words for k in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, all_words, strict=True):
        gone = {k + j for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [35, 12])
def test_repeats(frame, window):
    got = repeats.remove_repeats(frame, window=window).drop("kept").collect()
    assert sorted(map(tuple, got)) == brute_repeats(ROWS, window)


def test_repeats_inside_runs_and_random_texts(spark):
    rng = np.random.default_rng(6)
    parts = [" ".join(rng.choice(list("abcd"), 40)) for _ in range(6)] + ["a " * 50, "a b " * 30]
    rows = [(i, " ".join(rng.choice(parts, 3))) for i in range(40)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).drop("kept").collect()
    assert sorted(map(tuple, got)) == brute_repeats(rows, 35)


def test_language_model(frame):
    got = pitman_yor.score_texts(frame).collect()
    tokens = {i: words(lowered(t)) + ["\n"] for i, t, *_ in ROWS}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = collections.Counter(w for i, *_ in ROWS if not held[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(ROWS)
    for r in got:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0


def test_language_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pitman_yor.score_texts(documents).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_has_a_restaurant_for_every_context(spark, monkeypatch):
    """Words that always follow one another are foretold, however many of them there are, with codes or without."""
    monkeypatch.setattr(pitman_yor, "SHARDS_PER_HOME", 2)
    monkeypatch.setattr(pitman_yor, "COMMON", 1000)
    chain = " ".join(f"w{i}" for i in range(4000))
    rows = pitman_yor.score_texts(spark.createDataFrame([(i, chain) for i in range(8)], "doc_id long, text string").repartition(3)).collect()
    assert all(r.score / r.n_tokens > math.log10(0.5) for r in rows)


def test_language_model_probabilities(spark):
    """One training text of distinct words: every dish has one table, so all probabilities are known."""
    ids = {held: [i for i in range(50) if (zlib.crc32(str(i).encode()) % 5 == 1) == held] for held in (False, True)}
    n = 700
    rows = [(ids[False][0], " ".join(f"w{i}" for i in range(n))), (ids[True][0], "w1 w2 new w7 w5"), (ids[True][1], None)]
    got = {r.doc_id: r for r in pitman_yor.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    tables, d = n + 1, 0.95
    base = (1 + d * tables) / (1 + tables) / (tables + 1)
    root = (1 - d) / (1 + tables) + base
    seen, other = ((1 - d) + (1 + d) * root) / 2, (1 + d) * root / 2
    first = ids[False][0]
    assert got[first].score == pytest.approx(tables * math.log10(seen))
    # start: w1, w1: w2, w2: new, new: w7, w7: w5, w5: end
    chances = [other, seen, (1 + d) * base / 2, root, other, other]
    assert got[ids[True][0]].score == pytest.approx(sum(map(math.log10, chances)))
    assert got[ids[True][1]].score == pytest.approx(math.log10(other))
    assert (got[ids[True][0]].n_known, got[first].train_tokens) == (5, tables)


def test_seating_follows_its_distribution():
    """Tables of c customers when the dish is all the parent serves: the mean of the restaurant process."""
    rng, c, d, strength = np.random.default_rng(1), 30, 0.5, 1.0
    n = 4000
    tables = pitman_yor.sample_tables(np.full(n, c), np.ones(n), np.zeros(n), d, strength, rng)
    mean = np.prod([(strength + d + k) / (strength + k) for k in range(c)]) * strength / d - strength / d
    assert tables.mean() == pytest.approx(mean, rel=0.05)


def test_mixing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 60)), f"s{i % 7}" if i % 7 else None, i) for i in range(3000)]
    rows += [(5000, None, "empty", 1), (5001, "", "empty", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mix(frame).toPandas()
    names = sorted({r[2] for r in rows if r[2]}) + [None]
    sizes = {s: sum(len(words(t)) for _, t, x, _ in rows if x == s) for s in names}
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            open_.discard(s)
    key = {r[0]: r[2] for r in rows}
    got["name"] = [key[i] for i in got.doc_id]
    for s, g in got.groupby(got["name"].fillna("null")):
        s = None if s == "null" else s
        assert g["source_size"].iloc[0] == sizes[s]
        assert g["target"].iloc[0] == pytest.approx(target[s])
        assert abs(g["taken"].sum() - target[s]) <= max(180, 0.02 * target[s])
    assert (got["taken"] <= 3 * got["size"]).all()
    again = mixing.mix(frame.repartition(2)).toPandas()
    assert dict(zip(got.doc_id, got["copies"], strict=True)) == dict(zip(again.doc_id, again["copies"], strict=True))
    assert mixing.emit(mixing.mix(frame)).count() == got["copies"].sum()


def test_components_and_later_edges(spark):
    """Groups of all edges at once, and of some edges with the rest added between components, are those of a plain walk."""
    rng = random.Random(5)
    edges = sorted({tuple(rng.sample(range(120), 2)) for _ in range(90)})
    leader = {n: n for e in edges for n in e}
    for _ in leader:
        for u, v in edges:
            leader[u] = leader[v] = min(leader[u], leader[v])
    whole = spark.createDataFrame(edges, "u long, v long")
    assert dict(map(tuple, graph.components(whole).collect())) == leader
    first = graph.components(spark.createDataFrame(edges[:50], "u long, v long"))
    named = dict(map(tuple, first.collect()))
    later = [(named.get(u, u), named.get(v, v)) for u, v in edges[50:]]
    both = graph.merged(first, spark.createDataFrame(later, "u long, v long")).collect()
    assert len(both) == len(leader) and {r[0]: r[1] for r in both} == leader
