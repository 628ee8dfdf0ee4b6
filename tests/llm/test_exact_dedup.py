from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import awkward, no_rows, pairs, sha

from reviewlake.llm.exact_dedup import (
    drop_copies, exact_groups, rice_decode, rice_encode, row_keys, send_blocks, suspects, text_groups,
)


@given(st.sets(st.integers(0, 2**40 - 1), max_size=300))
@settings(max_examples=50, deadline=None)
def test_rice_round_trip(values):
    ordered = np.array(sorted(values), np.int64)
    k, code = rice_encode(ordered, 40)
    assert rice_decode(code, len(ordered), k).tolist() == ordered.tolist()


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    rows = Counter()
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = max(known) if known else None
        for n, d in enumerate(sorted(ids, key=lambda d: (d is not None, d or 0), reverse=True)):
            rows[(d, keep, len(ids), n == 0, sha(text.encode()))] += 1
    return rows


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = exact_groups(docs).drop("uid").collect()
    assert Counter(tuple(r) for r in got) == brute(pairs(docs))


def test_empty_table(spark):
    assert exact_groups(no_rows(awkward(spark))).count() == 0
    assert drop_copies(no_rows(awkward(spark))).count() == 0


def test_many_blocks_and_owners(spark, monkeypatch):
    monkeypatch.setattr("reviewlake.llm.exact_dedup.BLOCK_ROWS", 7)
    docs = spark.range(0, 400, 1, 6).selectExpr("id as doc_id", "cast(id % 150 as string) as text")
    rows = exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows) == brute(
        [(i, str(i % 150)) for i in range(400)])


def test_one_row_stays_per_text(spark):
    docs = awkward(spark)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r["text"] or "") for r in kept.collect()) == Counter({(t or "") for _, t in pairs(docs)})
    assert {r["doc_id"] for r in kept.collect() if (r["text"] or "").startswith("the same")} == {3}


def test_columns_without_an_order(spark):
    docs = spark.createDataFrame([(1, "a", {"x": 1}), (1, "a", {"x": 2}), (2, "b", None)],
                                 "doc_id long, text string, more map<string,int>")
    assert Counter((r["doc_id"], str(r["more"])) for r in drop_copies(docs).collect()) == Counter(
        [(1, "{'x': 2}"), (2, "None")])


def test_large_sides_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr("reviewlake.llm.decontam.SEND_BYTES", 0)
    docs = awkward(spark)
    assert Counter(tuple(r) for r in exact_groups(docs).drop("uid").collect()) == brute(pairs(docs))


def test_only_suspects_are_sent_to_the_grouping(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["one", "two", "two", "", None, "three"])],
                                 "doc_id long, text string")
    keys = row_keys(docs, "doc_id", "text")
    few = suspects(send_blocks(keys, 3), 3)
    assert few.count() == 2
    assert Counter((r["keep_id"], r["group_size"]) for r in text_groups(docs, few, "doc_id", "text").collect()) == Counter(
        [(2, 2), (4, 2)])
    plan = text_groups(docs, few, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
