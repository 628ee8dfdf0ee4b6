from collections import Counter

import numpy as np
import pytest
from llm import brute
from llm.brute import awkward, no_rows, pairs

from conftest import SF_DIR
from reviewlake.llm import simhash
from reviewlake.llm.common import table
from reviewlake.llm.components import connected_components
from reviewlake.llm.simhash import drop_near_copies, drop_similar, links, near_groups, signed

BASE = " ".join(f"w{i % 37}x{i % 11}" for i in range(400))
NEAR = [(40 + i, BASE.replace(f" w{i}x{i % 11} ", f" changed{i} ", 1)) for i in range(8)]


def test_against_brute_force(spark):
    docs = awkward(spark, NEAR)
    got = Counter(tuple(r) for r in near_groups(docs).collect())
    assert got == Counter(brute.near_groups(pairs(docs)))
    assert near_groups(no_rows(docs)).count() == 0


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    assert Counter(tuple(r) for r in near_groups(docs).collect()) == Counter(brute.near_groups(pairs(docs)))


def test_links_reach_all_within_the_radius(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ 7, base ^ 1 << 63 ^ 1 << 20, base ^ 0xFF << 30, base ^ 0xFF << 30 ^ 1]
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(links(df)).collect()}
    groups = {frozenset(n for n in roots if roots[n] == r) for r in roots.values()}
    assert groups == {frozenset(map(signed, prints[:5])), frozenset(map(signed, prints[5:]))}
    with pytest.raises(ValueError):
        links(df, 3)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(chain + star + [(500, 400)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, 500: 400, 400: 400}


def test_one_of_each_group_stays(spark):
    docs = awkward(spark, NEAR).dropDuplicates(["doc_id"])
    kept = {r["doc_id"] for r in drop_near_copies(docs).collect()}
    assert kept == {c for d, _, c in brute.near_groups(pairs(docs)) if d == c}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def kept_of_similar(docs):
    """Smallest ids of the components of all pairs of texts with Jaccard 0.8 of five-word shingles."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sets:
            if b < a and root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return {d for d, r in root.items() if d == r}


def test_planted_copies_of_similarity_80_to_95_go(spark):
    rows = []
    for g in range(30):
        words = [f"g{g}w{i}" for i in range(404)]
        rows.append((100 * g, " ".join(words)))
        for j in range(1, 4):  # the last words differ: (400 - k) / (400 + k) shingles are shared
            k = 10 + (g + 8 * j) % 35
            rows.append((100 * g + j, " ".join(words[:-k] + [f"g{g}v{j}x{i}" for i in range(k)])))
        rows.append((100 * g + 50, " ".join(words[:-60] + [f"g{g}far{i}" for i in range(60)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in drop_similar(docs).collect()}
    assert kept == kept_of_similar(rows) == {d for d, _ in rows if d % 50 == 0}


def test_one_large_group_and_awkward_rows(spark):
    """Links within a bucket beyond a chunk, whose smallest text is no near copy of most others."""
    words = [f"w{i}" for i in range(204)]
    ring = [(1000 + i, " ".join(words[:i % 40] + [f"y{i}z{j}" for j in range(8)] + words[i % 40 + 8:])) for i in range(150)]
    docs = awkward(spark, ring).dropDuplicates(["doc_id"]).where("doc_id is not null")
    kept = {r["doc_id"] for r in drop_similar(docs).collect()}
    assert kept == kept_of_similar(pairs(docs))
    assert drop_similar(no_rows(docs)).count() == 0


def test_repeated_texts_under_many_ids(spark):
    """Copies are folded before anything is compared."""
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words), " ".join(words[:-5] + ["other"] * 5), "quite another text of a few words"]
    docs = spark.createDataFrame([(10 * i + t, texts[t]) for i in range(200) for t in range(3)], "doc_id long, text string")
    assert {r["doc_id"] for r in drop_similar(docs).collect()} == {0, 2}


def test_thousands_of_near_copies(spark):
    """Every copy differs from the others in a window of its own, so that few pairs but those with the first match."""
    words = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(words))]
    rows += [(n, " ".join(words[:n % 290] + [f"v{n}x{j}" for j in range(10)] + words[n % 290 + 10:])) for n in range(1, 1201)]
    rows += [(5000 + n, " ".join(f"u{n}y{i}" for i in range(40))) for n in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    kept = {r["doc_id"] for r in drop_similar(docs).collect()}
    assert kept == {0} | {5000 + n for n in range(50)}


def test_a_common_passage_pairs_few_texts(spark, monkeypatch):
    """Texts that share a passage of most of their words, but no similar ones, meet a number of times that grows with them."""
    met = []
    real = simhash.similar_pairs
    monkeypatch.setattr(simhash, "similar_pairs", lambda pairs, hashes: met.append(pairs.count()) or real(pairs, hashes))
    passage = [f"p{i}" for i in range(80)]
    rows = [(n, " ".join(passage + [f"t{n}w{i}" for i in range(20)])) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert drop_similar(docs).count() == len(rows)
    assert sum(met) < 10 * len(rows)


def test_all_links_between_components_are_candidates(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    sets = [np.unique(rng.choice(np.concatenate([base, rng.integers(-(1 << 62), 1 << 62, 6)]), rng.integers(45, 66), False))
            for _ in range(150)]
    sets += [np.array([5]), np.array([5, 6]), np.array([5, 6, 7, 8]), np.array([5, 6, 7, 8, 9])]
    nodes = [bytes([n]) for n in range(len(sets))]
    roots = [nodes[n % 3 if n < 100 else n] for n in range(len(sets))]
    hashes = spark.createDataFrame([(n, s.tobytes()) for n, s in zip(nodes, sets)], "node binary, hashes binary")
    apart = spark.createDataFrame([(1, n, r) for n, r in zip(nodes, roots)], "key long, node binary, root binary")
    got = {tuple(sorted((bytes(r["node"]), bytes(r["other"])))) for r in simhash.to_alike(apart, hashes).collect()}
    want = {(nodes[a], nodes[b]) for b in range(len(sets)) for a in range(b) if roots[a] != roots[b]
            and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert len(want) > 50 and want <= got
    assert all(roots[a[0]] != roots[b[0]] for a, b in got)
    linked = {tuple(map(bytes, r)) for r in simhash.similar_pairs(spark.createDataFrame(sorted(got), "a binary, b binary"), hashes).collect()}
    assert linked == want


def test_nearly_similar_texts_make_few_pairs(spark):
    """Texts that share their rarest shingles, but too few for a link, are told apart before they are paired."""
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(-(1 << 62), 1 << 62, 100))
    sets = [np.sort(rng.choice(base, 84, replace=False)) for _ in range(200)]
    nodes = [bytes([n]) for n in range(len(sets))]
    hashes = spark.createDataFrame([(n, s.tobytes()) for n, s in zip(nodes, sets)], "node binary, hashes binary")
    apart = spark.createDataFrame([(1, n, n) for n in nodes], "key long, node binary, root binary")
    got = {tuple(sorted((bytes(r["node"]), bytes(r["other"])))) for r in simhash.to_alike(apart, hashes).collect()}
    want = {(nodes[a], nodes[b]) for b in range(len(sets)) for a in range(b)
            if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert want <= got and len(got) < 10 * len(sets)


def test_parities_bound_the_shingles_of_one_text_alone():
    rng = np.random.default_rng(5)
    for n in (1, 40, 3000):
        a = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        b = np.unique(np.concatenate([a[n // 9:], rng.integers(-(1 << 62), 1 << 62, n // 9)]))
        cells = np.bitwise_count((simhash.parities(a) ^ simhash.parities(b)).view(np.uint64)).sum()
        assert cells <= len(np.setxor1d(a, b)) and cells % 2 == len(np.setxor1d(a, b)) % 2
