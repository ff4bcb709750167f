"""Operator 6: equal texts, the persistent index, edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from auditlens.llm.common import fresh_path
from auditlens.llm.exact_dedup import DigestIndex, dedup_rows, keep_first, text_digest

ROWS = [(3, "a  b"), (1, "a\tb"), (2, "a b"), (5, None), (4, ""), (9, "x" * 100_000), (7, " "), (8, "a b"), (10, "a b")]


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    return {(i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}


def test_against_brute_force(spark, table):
    got = dedup_rows(spark, table(ROWS, extra=["digest", "keep_id"])).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in got} == brute(ROWS)


def test_repeated_rows_keep_one_copy(spark, table):
    got = dedup_rows(spark, table([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "n")])).collect()
    kept = [(r.doc_id, r.digest) for r in got if r.kept]
    assert len(got) == 5 and len(kept) == 3 and len(set(kept)) == 3
    assert {r.group_size for r in got if r.keep_id == 1 and r.digest == hashlib.sha256(b"a").hexdigest()} == {3}


def test_keep_first_returns_all_columns(spark, table):
    docs = table([*ROWS, (1, "a\tb")])
    got = keep_first(spark, docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 4, 7, 9]


def test_index_persists_over_batches(spark, table):
    path = fresh_path(spark, "index-test")
    first = DigestIndex(spark, path, 4)
    first.append(table([(1, "a"), (2, "b"), (3, "a")]).select("doc_id", text_digest().alias("digest")))
    again = DigestIndex(spark, path, 4)
    again.append(table([(0, "a"), (4, "c"), (5, "c")]).select("doc_id", text_digest().alias("digest")))
    again.append(table([]).select("doc_id", text_digest().alias("digest")))
    assert sorted(r.keep_id for r in again.entries().collect()) == [1, 2, 4]
    plan = again.bucketed().groupBy("digest").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_deciding_does_not_shuffle_the_index(spark, table, monkeypatch):
    from auditlens.llm import exact_dedup

    plans = {}
    plain = exact_dedup.written

    def noted(df, name="llm"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    index = DigestIndex(spark, fresh_path(spark, "index-test"), 4)
    batch = table([(1, "a"), (2, "b"), (3, "a")]).select("doc_id", text_digest().alias("digest"))
    index.append(batch)
    monkeypatch.setattr(exact_dedup, "written", noted)
    assert index.decide(batch).count() == 3
    lines = plans["exact-groups"].splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lambda line: len(line) - len(line.lstrip(" +-:"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[join:scan]):  # the operators from the scan up to the join
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    assert not any("Exchange" in line for line in above)
    index.close()
    assert not spark.catalog.tableExists(index.table)


def test_a_row_repeated_often_stays_once(spark, table):
    docs = table([(1, "same text")] * 500 + [(None, "n")] * 200 + [(2, "same  text"), (3, "other"), (4, None)], extra=["_digest", "_k0", "kept", "_n"])
    got = keep_first(spark, docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, "same text"), (None, "n"), (3, "other"), (4, None)], key=repr)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty(spark, table, rows):
    got = dedup_rows(spark, table(rows)).collect()
    assert len(got) == len(rows) and all(r.kept for r in got)
