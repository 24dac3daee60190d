"""Corpus queries beside their SQL, and the pipeline beside a version of its stages in SQL and plain Python."""

import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from compare import differences, duck

import corpus_pipeline
from flowlens.llm import pieces
from flowlens.llm.queries import QUERIES
from flowlens.llm.sql import SQL, dropped_lines, judged, mixed


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(found, duck(sf_dir).execute(SQL[name]).df()) is None


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def groups_of(frame):
    def shingles(text):
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = dict(zip(frame.doc_id, map(shingles, frame.text), strict=True))
    group = {i: i for i in sets}
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = max(group[i], group[j]), min(group[i], group[j])
                group = {d: y if g == x else g for d, g in group.items()}
    return group


def test_pipeline_agrees_with_its_stages_done_plainly(spark, sf_dir):
    connection = duck(sf_dir)

    def stage(table: pd.DataFrame, ctes, last):
        connection.register("held", table)
        connection.execute("CREATE OR REPLACE TABLE held_rows AS SELECT row_number() OVER () AS rid, * FROM held")
        return connection.execute(f"WITH {ctes('held_rows')} {last}").df()

    docs = connection.execute("SELECT * FROM documents ORDER BY doc_id").df()
    docs = stage(docs, judged, "SELECT d.* EXCLUDE (rid) FROM held_rows d JOIN verdicts USING (rid) WHERE kept")
    docs = stage(docs, dropped_lines, "SELECT d.* REPLACE (c.text AS text) EXCLUDE (rid) FROM held_rows d JOIN cleaned c USING (rid)".replace(
        "d.* REPLACE (c.text AS text) EXCLUDE (rid)", "doc_id, c.text, source"))
    group = groups_of(docs)
    docs = docs[[group[i] == i for i in docs.doc_id]]
    taken = stage(docs, mixed, "SELECT d.doc_id, d.source, d.text, copies FROM held_rows d JOIN chosen USING (rid)")

    machine = pieces.Machine(pieces.MODEL)
    wanted = Counter()
    for row in taken.itertuples():
        wanted[(row.doc_id, row.source, tuple(machine.encode(row.text).tolist()))] += int(row.copies)
    found = Counter((r.doc_id, r.source, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert found == +wanted
    assert duckdb.__version__


def test_near_copies_are_dropped_by_row(spark, tmp_path):
    """Repeated and null ids: one row of each group stays, and no row goes for another's id."""
    prose = " ".join(f"word{i}" for i in range(60))
    unlike = " ".join(f"other{i}" for i in range(60))
    rows = [(1, prose), (2, prose + " more"), (2, unlike), (3, "same text twice"), (3, "same text twice"), (None, "no id"), (None, "no id"), (4, None)]
    rows += [(None, "null id last here"), (9, "null id last here"), (5, "")]
    spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, source string").write.parquet(str(tmp_path / "rows"))
    found = corpus_pipeline.ngram_jaccard(spark, spark.read.parquet(str(tmp_path / "rows")), "").collect()
    wanted = [(1, prose), (2, unlike), (3, "same text twice"), (None, "no id"), (4, None), (9, "null id last here"), (5, "")]
    assert Counter((r.doc_id, r.text) for r in found) == Counter(wanted)


def test_stages_take_empty_tables_and_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, run in corpus_pipeline.STAGES:
        out = run(spark, docs, sf_dir)
        assert out.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
