from collections import Counter

import numpy as np
import pytest
import xxhash
from llm.brute import awkward, no_rows, pairs

from reviewlake.llm import pseudo_likelihood as lm


def cell(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) % lm.CELLS


def numbered(spark, texts, partitions):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(partitions)


def log_softmax(logits, at):
    logits = logits - logits.max()
    return logits[at] - np.log(np.exp(logits).sum())


def plain_log_likelihood(codes, parts):
    """Word by word; ``codes`` are (first step, second, third), the digits ``DIGITS`` where there are none."""
    end = (0, lm.DIGITS, lm.DIGITS)
    padded, total = [end] * lm.SIDE + codes + [end] * lm.SIDE, 0.0
    for at, (first, two, three) in enumerate(codes):
        around = [padded[at + lm.SIDE + o] for o in (-2, -1, 1, 2)]
        mixed = parts["b"] + sum((parts["E"][a] + parts["E2"][b] + parts["E3"][c]) @ parts["W"][j]
                                 for j, (a, b, c) in enumerate(around))
        total += log_softmax(np.tanh(mixed) @ parts["V"] + parts["c"], first)
        if first > lm.FREQUENT:
            bucket = first - 1 - lm.FREQUENT
            total += log_softmax(np.tanh(mixed + parts["A2"][bucket]) @ parts["V2"] + parts["c2"], two)
            total += log_softmax(np.tanh(mixed + parts["A3"][bucket] + parts["B3"][two]) @ parts["V3"] + parts["c3"], three)
    return total


def plain_codes(text, frequent):
    codes = []
    for word in text.encode().lower().split():
        if word in frequent:
            codes.append((1 + frequent.index(word), lm.DIGITS, lm.DIGITS))
        else:
            rest, three = divmod(cell(word), lm.DIGITS)
            bucket, two = divmod(rest, lm.DIGITS)
            codes.append((1 + lm.FREQUENT + bucket, two, three))
    return codes


def random_codes(rng, n):
    first = rng.integers(0, lm.SIZE, n).astype(np.uint8)
    digits = np.where(first > lm.FREQUENT, rng.integers(0, lm.NO_DIGITS, n), lm.NO_DIGITS).astype(np.uint16)
    return first, digits


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    flat = lm.begin() + 0.05 * rng.standard_normal(len(lm.begin()))
    first, digits = random_codes(rng, 30)
    places = np.array([2, 5, 9, 14, 20, 26])
    windows = places[:, None] + lm.OFFSETS
    assert (first[places] > lm.FREQUENT).any() and (first[places] <= lm.FREQUENT).any()

    def loss(f):
        parts, total = lm.named_parts(f), 0.0
        two, three = lm.split_digits(digits)
        for p in places:
            codes = [(int(first[i]), int(two[i]), int(three[i])) for i in range(p - 2, p + 3)]
            mixed = parts["b"] + sum((parts["E"][a] + parts["E2"][b] + parts["E3"][c]) @ parts["W"][j]
                                     for j, (a, b, c) in enumerate(codes[:2] + codes[3:]))
            a, b, c = codes[2]
            total -= log_softmax(np.tanh(mixed) @ parts["V"] + parts["c"], a)
            if a > lm.FREQUENT:
                k = a - 1 - lm.FREQUENT
                total -= log_softmax(np.tanh(mixed + parts["A2"][k]) @ parts["V2"] + parts["c2"], b)
                total -= log_softmax(np.tanh(mixed + parts["A3"][k] + parts["B3"][b]) @ parts["V3"] + parts["c3"], c)
        return total / len(places)

    squares, moved = np.zeros_like(flat), flat.copy()
    lm.train_step(moved, squares, first[windows], digits[windows], first[places], digits[places])
    at, steepest = 0, []
    for shape in lm.SHAPES.values():
        size = int(np.prod(shape))
        steepest += (at + np.argsort(-squares[at:at + size])[:2]).tolist()
        at += size
    for i in steepest:
        step = np.zeros_like(flat)
        step[i] = 1e-5
        slope = (loss(flat + step) - loss(flat - step)) / 2e-5
        assert abs(abs(slope) - np.sqrt(squares[i])) < 1e-3 * max(1, abs(slope)) + 1e-4
        assert np.sign(slope) == -np.sign(moved[i] - flat[i])


def test_every_word_is_scored_from_both_sides():
    parts = lm.named_parts(lm.begin().astype(np.float32))
    rng = np.random.default_rng(1)
    texts = []
    for n in (0, 1, 3, 2500, 0, 40):
        first, digits = random_codes(rng, n)
        first = np.maximum(first, 1)
        texts.append((first, np.where(first > lm.FREQUENT, digits % lm.NO_DIGITS, lm.NO_DIGITS).astype(np.uint16)))
    got = lm.log_likelihoods(texts, lm.with_tables(parts))
    for (first, digits), value in zip(texts, got):
        codes = list(zip(first.tolist(), *(d.tolist() for d in lm.split_digits(digits))))
        assert abs(plain_log_likelihood(codes, parts) - value) < 1e-5 * max(1, -value)


def test_training_tells_text_from_shuffled_text(spark):
    rng = np.random.default_rng(3)
    line = "the cat sat on the mat and the dog ran to the house by the lake ".split()
    docs = numbered(spark, [" ".join(np.roll(line, i % len(line)).tolist() * 12) for i in range(2000)], 2)
    counts = lm.word_counts(docs)
    words = lm.vocabulary_of(counts)
    flat = lm.train(lm.encode_words(docs, words))
    mixed = lm.encode_words(numbered(spark, [" ".join(line * 12), " ".join(rng.permutation(line * 12).tolist())], 1), words)
    scored = lm.score(mixed, flat, lm.asked_shares(mixed, counts, words))
    clean, shuffled = (r["mean_log_likelihood"] for r in scored.orderBy("doc_id").collect())
    assert clean > shuffled + 0.5 and clean > -2


def test_training_tells_rare_words_of_one_bucket_apart(spark):
    """Two words outside the frequent ones, of one bucket, each in its own surroundings: exchanging them costs."""
    names = [f"word{i}" for i in range(20_000)]
    bucket = cell(names[0].encode()) // lm.NO_DIGITS
    one, other, *_ = [w for w in names if cell(w.encode()) // lm.NO_DIGITS == bucket]
    top = " ".join(f"top{i}" for i in range(lm.FREQUENT))
    text = " ".join
    docs = numbered(spark, [top + " " + text(["top1 top2", one, "top3 top4"] * 8) for _ in range(400)]
                    + [top + " " + text(["top5 top6", other, "top7 top8"] * 8) for _ in range(400)]
                    + [top * 1 + " " + top for _ in range(8000)], 2)
    counts = lm.word_counts(docs)
    words = lm.vocabulary_of(counts)
    assert not {xxhash.xxh64_intdigest(w.encode()) for w in (one, other)} & set(words.frequent.tolist())
    flat = lm.train(lm.encode_words(docs, words))
    asked = lm.encode_words(numbered(spark, [f"top1 top2 {one} top3 top4", f"top1 top2 {other} top3 top4",
                                             f"top5 top6 {other} top7 top8", f"top5 top6 {one} top7 top8"], 1), words)
    got = [r["log_likelihood"] for r in lm.score(asked, flat, lm.asked_shares(asked, counts, words)).orderBy("doc_id").collect()]
    assert got[0] > got[1] + 1 and got[2] > got[3] + 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = lm.score_corpus(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"]) for r in rows) == sorted(
        (d or -1, len((t or "").encode().split())) for d, t in pairs(docs))
    assert all((r["mean_log_likelihood"] is None) == (r["n_words"] == 0) for r in rows)
    assert lm.score_corpus(no_rows(docs)).count() == 0


def test_long_text(spark):
    docs = numbered(spark, ["a few words and more " * 60_000, "a few words"], 2)
    assert {r["doc_id"]: r["n_words"] for r in lm.score_corpus(docs).collect()} == {0: 300_000, 1: 3}


@pytest.mark.parametrize("known", [0, 100, 1 << 17])
def test_rows_against_a_plain_version(spark, monkeypatch, known):
    """All scores, for one trained network: however many counts the tasks hold, the rest is looked up."""
    monkeypatch.setattr(lm, "KNOWN", known)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(n)}" for n in rng.zipf(1.3, 50) % 5000) for _ in range(300)] + ["", "w1"]
    docs = numbered(spark, texts, 3)
    counts = lm.word_counts(docs)
    words = lm.vocabulary_of(counts)
    assert len(words.known) <= known
    n = Counter(w for t in texts for w in t.encode().split())
    common = [w for w in sorted(n, key=lambda w: (-n[w], xxhash.xxh64_intdigest(w))) if n[w] >= words.least]
    assert len(common) == len(words.known)
    frequent = sorted(common[:lm.FREQUENT], key=xxhash.xxh64_intdigest)
    totals = Counter()
    for w, times in n.items():
        if w not in frequent:
            totals[cell(w)] += times
    coded = lm.encode_words(docs, words)
    flat = lm.train(coded)
    parts = lm.named_parts(flat)
    got = {r["doc_id"]: r["log_likelihood"] for r in lm.score(coded, flat, lm.asked_shares(coded, counts, words)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        shares = sum(np.log(n[w] / totals[cell(w)]) for w in t.encode().split() if w not in frequent)
        assert abs(got[i] - plain_log_likelihood(plain_codes(t, frequent), parts) - shares) < 0.005


def test_every_place_is_masked_once_over_the_rounds():
    rng = np.random.default_rng(2)
    texts = [b"", bytes([1]) * 7, rng.integers(0, lm.SIZE, 9000, np.uint8).tobytes(), bytes([1]) * 600]
    rounds = np.array([lm.masked(texts, number) for number in range(lm.ROUNDS)])
    assert (rounds.sum(axis=0) == 1).all()
    assert abs(rounds[0].mean() - 1 / lm.ROUNDS) < 0.03
    # What is masked follows from the text alone, not from its neighbours.
    assert (lm.masked(texts[2:3], 0) == rounds[0][7:9007]).all() and lm.masked([], 0).shape == (0,)
