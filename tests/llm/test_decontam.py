import random
from collections import Counter

from llm import brute
from llm.brute import awkward, no_rows, pairs

from reviewlake.llm.decontam import build_index, contamination, drop_contaminated, item_words, near_matches

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
TEXTS = [(30, f"before, {PASSAGE.upper()} after"), (31, "alpha beta gamma delta epsilon zeta eta theta iota lambda"),
         (32, f"{PASSAGE}. {PASSAGE}; {PASSAGE}"), (33, "the " * 40), (34, "x beta gamma delta epsilon zeta eta theta iota kappa lambda"),
         (35, "say one two now one  Two"), (None, PASSAGE), (36, "été 9 " * 12)]
ITEMS = [(1, PASSAGE), (1, PASSAGE), (2, "One two"), (10, "the " * 11), (None, "one two"), (3, None), (4, "..."),
         (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda nu xi"), (6, "été 9 " * 5)]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "item_id long, text string, word string, uid int")


def test_against_brute_force(spark):
    docs = awkward(spark, TEXTS)
    got = Counter(tuple(r) for r in contamination(docs, items(spark)).drop("text_hash").collect())
    assert got == Counter(brute.contamination(pairs(docs), ITEMS))


def test_documents_that_begin_inside_an_item(spark):
    words = [f"w{i}" for i in range(14)]
    texts = [(i, " ".join(words[i:])) for i in range(7)] + [(7, " ".join(words[2:13] + ["pad"] + words[3:]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    item_rows = [(1, " ".join(words))]
    got = Counter(tuple(r) for r in contamination(docs, items(spark, item_rows)).drop("text_hash").collect())
    assert got == Counter(brute.contamination(texts, item_rows))
    assert {r[0]: r[2] for r in got} == {0: 14, 1: 13, 2: 12, 3: 11, 4: 10, 5: 0, 6: 0, 7: 22}


def test_large_sides_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr("reviewlake.llm.decontam.SEND_ROWS", 0)
    docs = awkward(spark, TEXTS)
    got = Counter(tuple(r) for r in contamination(docs, items(spark)).drop("text_hash").collect())
    assert got == Counter(brute.contamination(pairs(docs), ITEMS))


def test_empty_tables(spark):
    docs = awkward(spark, TEXTS)
    assert contamination(no_rows(docs), items(spark)).count() == 0
    got = Counter(tuple(r) for r in contamination(docs, items(spark, [])).drop("text_hash").collect())
    assert got == Counter(brute.contamination(pairs(docs), []))


def test_clean_documents_stay(spark):
    docs = awkward(spark, TEXTS)
    kept = drop_contaminated(docs, items(spark))
    bad = [r[5] for r in brute.contamination(pairs(docs), ITEMS)]
    assert kept.columns == docs.columns
    assert Counter(pairs(kept)) == Counter(p for p, b in zip(pairs(docs), bad) if not b)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue"), (2, "blue " + "x " * 30 + "red"), (3, "red"), (4, "blue red")],
                                 "doc_id long, text string")
    terms = item_words(spark.createDataFrame([(1, "red blue")], "item_id long, text string"))
    index = build_index(docs, terms)
    near = near_matches(index, terms, 3).join(index.where("word = ''").select("uid", "id"), "uid")
    assert {r["id"] for r in near.collect()} == {1, 4}


def test_proximity_against_brute_force(spark):
    rng = random.Random(4)
    names = [f"w{i}" for i in range(60)]
    item_rows = [(i, " ".join(rng.choices(names, k=rng.choice([1, 2, 5, 10, 14, 27, 40])))) for i in range(30)] + ITEMS
    texts = list(TEXTS)
    for i in range(60):
        some = rng.choice(item_rows)[1] or ""
        body = some.split()
        rng.shuffle(body)
        kept = [t for t in body if rng.random() < 0.9]
        filler = rng.choices(names + ["pad"] * 200, k=rng.choice([0, 5, 60, 150]))
        texts.append((100 + i, " ".join(filler[:30] + kept + filler[30:])))
    docs = awkward(spark, texts)
    got = contamination(docs, items(spark, item_rows), distance=20)
    want = Counter((r[0], r[1], n) for r, n in zip(brute.contamination(pairs(docs), item_rows),
                                                   brute.near_items(pairs(docs), item_rows)))
    assert Counter((r["doc_id"], r["n_words"], r["n_near"]) for r in got.collect()) == want
    assert sum(n for _, _, n in want) > 20


def test_proximity_leaves_words_far_apart_or_unknown(spark):
    docs = spark.createDataFrame([(1, "red sky blue " + "x " * 30 + "sea green"), (2, "the the the"), (3, "sea red green sky blue")],
                                 "doc_id long, text string")
    item_rows = [(1, "red sky blue sea green"), (2, "the the"), (3, "never seen words the x")]
    got = contamination(docs, items(spark, item_rows), distance=20)
    assert {r["doc_id"]: r["n_near"] for r in got.collect()} == {1: 0, 2: 0, 3: 1}
