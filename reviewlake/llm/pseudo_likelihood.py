"""Document scores from a masked language model: pseudo-log-likelihood.

A small window network reads the words left and right of a place and predicts
the word there. It is trained in numpy on places masked at random in every
document, in rounds that mask every place once: each partition trains from the
shared parameters, and their mean, weighted by the places seen, is the next
round's start. A document's score is the sum over all its words of their
log-probability given both sides.

A word is predicted in steps. The first names one of the most frequent words or
a bucket; the second and third, each given both sides and the steps before, name
digits of the word's 64-bit hash, 131,072 cells in all. The last factor is the
word's share of its cell, counted over all documents. The network reads the same
codes, so it tells words apart that share a bucket. Its parameters are a fixed
number, summed by place in a shuffle; the words' counts are a table that grows
with the documents. The counts of the commonest words, a bounded table, go to
every task; a text's other words are looked up by a join on their hashes. Words
whose 64-bit hashes are equal count as one word.

The parameters are means over partitions, so scores depend slightly on how the
documents are partitioned.

Defined results: a null, empty or blank text has no words, score 0 and a null
mean; ids may be null or repeat, each row keeps its own result; an empty table
gives an empty result; columns other than id and text are never read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, sql_type, stored

FREQUENT, BUCKETS, DIGITS = 31, 32, 64
#: First steps: 0 beyond the text's ends, then frequent words, then buckets.
SIZE = 1 + FREQUENT + BUCKETS
CELLS = BUCKETS * DIGITS * DIGITS
#: Both digits as one number; this one for words that have none.
NO_DIGITS = DIGITS * DIGITS
SIDE, WIDTH, HIDDEN = 2, 16, 32
#: Rounds (each place is masked in one of them), places per step, learning rate.
ROUNDS, STEP, RATE = 2, 1024, 0.15
SEED = 7
PLACES = 1024
#: Distinct words held in a worker's memory at once.
HELD = 100_000
#: Words whose counts every task holds, at most.
KNOWN = 1 << 17
FIXED_POINT = 1 << 20


@dataclass
class Vocabulary:
    """The bounded part of the counts: hashes in ascending order, their counts, and the total of every cell."""

    frequent: np.ndarray
    known: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    #: Words with a smaller count are not among ``known``.
    least: int


def hash_cell(hashes: np.ndarray) -> np.ndarray:
    """The cell of a word: the hash's lowest bits, bucket first."""
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


class Words(dict):
    """Word -> its number among the words held, whose codes are kept in arrays."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh = []
        self.hashes = np.empty(0, np.uint64)
        self.first, self.digits = np.empty(0, np.uint8), np.empty(0, np.uint16)
        self.share, self.asked = np.empty(0, np.int64), np.empty(0, bool)

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        self.fresh.append(xxhash.xxh64_intdigest(word))
        return found

    def learn(self) -> None:
        """Codes of the words met since the last call."""
        h, known = np.array(self.fresh, np.uint64), self.vocabulary
        self.fresh = []
        cell = hash_cell(h)
        rank = np.searchsorted(known.frequent, h)
        often = np.append(known.frequent, 0)[rank] == h if len(known.frequent) else np.zeros(len(h), bool)
        often &= rank < len(known.frequent)
        place = np.searchsorted(known.known, h)
        held = (np.append(known.known, 0)[place] == h) & (place < len(known.known))
        n = np.where(held, np.append(known.counts, 1)[place], 1)
        share = np.rint((np.log(n) - np.log(np.maximum(known.totals[cell], 1))) * FIXED_POINT).astype(np.int64)
        self.hashes = np.concatenate([self.hashes, h])
        self.first = np.concatenate([self.first, np.where(often, 1 + rank, 1 + FREQUENT + cell // NO_DIGITS).astype(np.uint8)])
        self.digits = np.concatenate([self.digits, np.where(often, NO_DIGITS, cell % NO_DIGITS).astype(np.uint16)])
        self.share = np.concatenate([self.share, np.where(often, 0, share)])
        self.asked = np.concatenate([self.asked, ~often & ~held])

    def of(self, texts: list[str]) -> list[tuple[bytes, bytes, int, np.ndarray]]:
        """Per text the first steps, the digits, the sum of the shares as far as known, and the hashes to look up."""
        if len(self) >= HELD:
            self.forget()
        numbers = []
        for text in texts:
            words = text.encode().lower().split()
            numbers.append(np.fromiter(map(self.__getitem__, words), np.int32, len(words)))
        if self.fresh:
            self.learn()
        return [(self.first[n].tobytes(), self.digits[n].tobytes(), int(self.share[n].sum()),
                 self.hashes[n[self.asked[n]]].view(np.int64)) for n in numbers]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Stored (hash, n): every word of the documents by its hash and how often it occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
            rows = pa.record_batch({"hash": pa.array(hashes), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return rows

        for batch in batches:
            for text in batch["body"]:
                counts.update(text.as_py().encode().lower().split())
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    small_batches(docs)
    return stored(docs.select(body(text_col).alias("body")).mapInArrow(work, "hash bigint, n bigint")
                  .groupBy("hash").agg(F.sum("n").alias("n")), "word-counts")


def size_of_count(n: Column) -> Column:
    """Counts in at most 256 classes, four for each doubling."""
    return F.floor(4 * F.log2(n))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """The commonest words, as many classes of counts as ``KNOWN`` words hold, and the totals of the cells.

    The frequent words are the first of them, ties by the hash.
    """
    least, words = 1 << 62, 0
    sizes = (counts.groupBy(size_of_count(F.col("n")).alias("size"))
             .agg(F.count("*").alias("words"), F.min("n").alias("least")).collect())
    for row in sorted(sizes, key=lambda r: -r["size"]):
        words += row["words"]
        if words > KNOWN:
            break
        least = row["least"]
    common = counts.where(F.col("n") >= least).toArrow()
    hashes, n = common["hash"].to_numpy().view(np.uint64), common["n"].to_numpy()
    order = np.lexsort((hashes, -n))
    frequent, frequent_n = hashes[order[:FREQUENT]], n[order[:FREQUENT]]
    cell = F.col("hash").bitwiseAND(F.lit(CELLS - 1))
    rows = counts.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(CELLS, np.int64)
    totals[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    np.subtract.at(totals, hash_cell(frequent), frequent_n)
    order = np.argsort(hashes)
    return Vocabulary(np.sort(frequent), hashes[order], n[order], totals, least)


SHAPES = {
    # What is read: first steps and digits of the words around, and how they are mixed.
    "E": (SIZE, WIDTH), "E2": (DIGITS + 1, WIDTH), "E3": (DIGITS + 1, WIDTH), "W": (2 * SIDE, WIDTH, HIDDEN), "b": (HIDDEN,),
    # What is predicted, step by step: earlier steps are added to the mixture.
    "V": (HIDDEN, SIZE), "c": (SIZE,),
    "A2": (BUCKETS, HIDDEN), "V2": (HIDDEN, DIGITS), "c2": (DIGITS,),
    "A3": (BUCKETS, HIDDEN), "B3": (DIGITS, HIDDEN), "V3": (HIDDEN, DIGITS), "c3": (DIGITS,)}


def begin() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return np.concatenate([(rng.standard_normal(s) * (0.0 if len(s) == 1 else 1 / np.sqrt(s[-2]))).ravel()
                           for s in SHAPES.values()])


def named_parts(flat: np.ndarray) -> dict[str, np.ndarray]:
    parts, at = {}, 0
    for name, shape in SHAPES.items():
        size = math.prod(shape)
        parts[name] = flat[at:at + size].reshape(shape)
        at += size
    return parts


def split_digits(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Second and third step; both are ``DIGITS`` for words without."""
    third = (digits % DIGITS).astype(np.uint8)
    third[digits == NO_DIGITS] = DIGITS
    return (digits // DIGITS).astype(np.uint8), third


def joined(texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after another with the ends' codes between them, and the places of their words."""
    ends, none = np.zeros(SIDE, np.uint8), np.full(SIDE, NO_DIGITS, np.uint16)
    first = np.concatenate([a for f, _ in texts for a in (ends, f)] + [ends])
    digits = np.concatenate([a for _, d in texts for a in (none, d)] + [none])
    return first, digits, np.flatnonzero(first)


def decoded(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(f, np.uint8), np.frombuffer(d, np.uint16))
            for f, d in zip(batch["first"].to_pylist(), batch["digits"].to_pylist())]


OFFSETS = np.array([o for o in range(-SIDE, SIDE + 1) if o])


def add_rows(total: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Sums the rows of every id into ``total``."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    if len(ids):
        firsts = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
        total[ids[firsts]] += np.add.reduceat(np.take(rows, order, axis=0), firsts, axis=0)


def may_overflow(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether a logit may be too large to be raised; the hidden layer lies between -1 and 1, so sums of weights bound it."""
    return np.abs(weights).sum(axis=0).max() + np.abs(bias).max() >= 60


def train_step(flat: np.ndarray, squares: np.ndarray, around: np.ndarray, around_digits: np.ndarray,
               target: np.ndarray, target_digits: np.ndarray) -> None:
    """One Adagrad step in place."""
    parts, n = named_parts(flat), len(target)
    second, third = split_digits(around_digits)
    inputs = np.take(parts["E"], around, axis=0)
    inputs += np.take(parts["E2"], second, axis=0)
    inputs += np.take(parts["E3"], third, axis=0)
    inputs = inputs.reshape(n, -1)
    mixing = parts["W"].reshape(-1, HIDDEN)
    mixture = inputs @ mixing + parts["b"]
    change = np.zeros_like(flat)
    grads = named_parts(change)

    def step(mixed: np.ndarray, step_target: np.ndarray, weights: str, bias: str) -> np.ndarray:
        """Adds a step's gradients and gives that of what it mixes."""
        hidden = np.tanh(mixed)
        slope = hidden @ parts[weights]
        slope += parts[bias]
        if may_overflow(parts[weights], parts[bias]):
            slope -= slope.max(axis=1, keepdims=True)
        np.exp(slope, out=slope)
        # Products with ones are sums, and faster than ``sum``.
        slope *= (1 / (n * (slope @ np.ones(slope.shape[1], slope.dtype))))[:, None]
        slope[np.arange(len(slope)), step_target] -= 1 / n
        grads[weights][:] = hidden.T @ slope
        grads[bias][:] = np.ones(len(slope), slope.dtype) @ slope
        down = slope @ parts[weights].T
        hidden *= hidden
        np.subtract(1, hidden, out=hidden)
        down *= hidden
        return down

    down = step(mixture, target, "V", "c")
    rare = np.flatnonzero(target > FREQUENT)
    if len(rare):
        bucket = (target[rare] - 1 - FREQUENT).astype(np.uint8)
        two, three = split_digits(target_digits[rare])
        down2 = step(mixture[rare] + parts["A2"][bucket], two, "V2", "c2")
        down3 = step(mixture[rare] + parts["A3"][bucket] + parts["B3"][two], three, "V3", "c3")
        add_rows(grads["A2"], bucket, down2)
        add_rows(grads["A3"], bucket, down3)
        add_rows(grads["B3"], two, down3)
        down[rare] += down2 + down3
    grads["b"][:] = down.sum(axis=0)
    grads["W"][:] = (inputs.T @ down).reshape(grads["W"].shape)
    read = (down @ mixing.T).reshape(-1, WIDTH)
    add_rows(grads["E"], around.ravel(), read)
    add_rows(grads["E2"], second.ravel(), read)
    add_rows(grads["E3"], third.ravel(), read)
    squares += change ** 2
    flat -= RATE * change / (np.sqrt(squares) + 1e-6)


def encode_words(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (row, id, first, digits, share, asked), read by all rounds and the scoring.

    ``row`` numbers the rows, ``first`` has a byte per word and ``digits`` two; ``share`` is the fixed-point sum of the
    logarithms of the words' shares of their cells, where the words in ``asked`` (by hash) count as if they occurred once.
    """
    kind = sql_type(docs, id_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = Words(vocabulary), TaskContext.get().partitionId() << 32
        for batch in slices(batches, 64):
            first, digits, share, asked = zip(*words.of(batch["body"].to_pylist()))
            yield pa.record_batch({
                "row": pa.array(np.arange(row, row + batch.num_rows)), "id": batch["id"],
                "first": pa.array(first, pa.binary()), "digits": pa.array(digits, pa.binary()),
                "share": pa.array(share, pa.int64()), "asked": pa.array(asked, pa.list_(pa.int64()))})
            row += batch.num_rows

    small_batches(docs)
    texts = docs.select(named(id_col).alias("id"), body(text_col).alias("body"))
    return stored(texts.mapInArrow(work, f"row bigint, id {kind}, first binary, digits binary, share bigint, asked array<bigint>"),
                  "word-ids")


def asked_shares(coded: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, more): what the counts of the words looked up add to ``share``; words that occur once add nothing.

    The words asked for are not among the commonest, so no key of the join is hot.
    """
    n = F.col("n")
    answers = counts.where((n >= 2) & (n < vocabulary.least)).select(
        "hash", F.round(F.log(n) * FIXED_POINT).cast("bigint").alias("more"))
    asked = coded.select("row", F.explode("asked").alias("hash"))
    return asked.join(answers, "hash").groupBy("row").agg(F.sum("more").alias("more"))


def masked(texts: list[bytes], number: int) -> np.ndarray:
    """Whether the round masks a place, for all places of the texts one after another; over all rounds, every place once.

    It follows from the text's bytes and the place in it alone, mixed as in MurmurHash3's last step.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    seeds = np.array([zlib.crc32(t, SEED) for t in texts], np.uint32)
    mixed = np.arange(sizes.sum(), dtype=np.uint32) + np.repeat(seeds - starts.astype(np.uint32), sizes)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        mixed ^= mixed >> np.uint32(shift)
        mixed *= np.uint32(factor)
    mixed ^= mixed >> np.uint32(16)
    return mixed % np.uint32(ROUNDS) == number


def train_round(coded: DataFrame, start: np.ndarray, number: int) -> np.ndarray:
    """The mean of what the partitions learn from ``start`` on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = start.astype(np.float32)
        squares, seen, waiting, held = np.full_like(flat, 0.01), 0, [], 0

        def learn() -> int:
            around, around_digits, target, target_digits = (np.concatenate(a) for a in zip(*waiting))
            for at in range(0, len(target), STEP):
                part = slice(at, at + STEP)
                train_step(flat, squares, around[part], around_digits[part], target[part], target_digits[part])
            waiting.clear()
            return len(target)

        for batch in slices(batches, 32):
            texts = batch["first"].to_pylist()
            first, digits, places = joined(decoded(batch))
            places = places[masked(texts, number)]
            for at in range(0, len(places), STEP):
                some = places[at:at + STEP]
                windows = some[:, None] + OFFSETS
                waiting.append((first[windows], digits[windows], first[some], digits[some]))
                held += len(some)
                if held >= STEP:
                    seen, held = seen + learn(), 0
        if held:
            seen += learn()
        if seen:
            whole = np.rint(flat.astype(np.float64) * FIXED_POINT).astype(np.int64)
            yield pa.record_batch({"place": pa.array(np.arange(len(flat), dtype=np.int32)),
                                   "value": pa.array(whole), "seen": pa.array(np.full(len(flat), seen, np.int64))})

    weight = F.col("seen").cast("decimal(19,0)")
    rows = (coded.select("first", "digits").mapInArrow(work, "place int, value bigint, seen bigint")
            .groupBy("place").agg(F.sum(F.col("value").cast("decimal(19,0)") * weight).cast("double").alias("total"),
                                  F.sum(weight).cast("double").alias("seen"))
            .orderBy("place").collect())
    if not rows:
        return start
    return np.array([r["total"] / r["seen"] / FIXED_POINT for r in rows])


def train(coded: DataFrame) -> np.ndarray:
    flat = begin()
    for number in range(ROUNDS):
        flat = train_round(coded, flat, number)
    return flat


def with_tables(parts: dict) -> dict:
    """Adds what each code adds to the mixture per place of the window, both digits in one table."""
    first, second, third = (np.einsum("vw,jwh->jvh", parts[e], parts["W"]).astype(np.float32) for e in ("E", "E2", "E3"))
    both = (second[:, :DIGITS, None] + third[:, None, :DIGITS]).reshape(2 * SIDE, -1, HIDDEN)
    none = second[:, DIGITS:] + third[:, DIGITS:]
    return parts | {"T": first, "U": np.concatenate([both, none], axis=1)}


def step_likelihood(mixed: np.ndarray, target: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Log-probabilities of the targets; changes ``mixed``."""
    logits = np.tanh(mixed, out=mixed) @ weights
    logits += bias
    if may_overflow(weights, bias):
        logits -= logits.max(axis=1, keepdims=True)
    named_logits = logits[np.arange(len(target)), target]
    return named_logits - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype))


def log_likelihoods(texts: list[tuple[np.ndarray, np.ndarray]], parts: dict) -> np.ndarray:
    """Per text the sum over all words of their log-probability, up to the cell, given the words on both sides."""
    first, digits, places = joined(texts)
    found = np.empty(len(places), np.float64)
    for at in range(0, len(places), PLACES):
        some = places[at:at + PLACES]
        mixture = np.repeat(parts["b"][None], len(some), axis=0)
        for j, offset in enumerate(OFFSETS):
            mixture += np.take(parts["T"][j], first[some + offset], axis=0)
            mixture += np.take(parts["U"][j], digits[some + offset], axis=0)
        target = first[some]
        rare = np.flatnonzero(target > FREQUENT)
        bucket, pair = target[rare] - (1 + FREQUENT), digits[some[rare]]
        two, three = pair // DIGITS, pair % DIGITS
        deeper = mixture[rare]
        sums = step_likelihood(mixture, target, parts["V"], parts["c"])
        sums[rare] += step_likelihood(deeper + parts["A2"][bucket], two, parts["V2"], parts["c2"])
        sums[rare] += step_likelihood(deeper + parts["A3"][bucket] + parts["B3"][two], three, parts["V3"], parts["c3"])
        found[at:at + PLACES] = sums
    text = np.repeat(np.arange(len(texts)), [len(f) for f, _ in texts])
    return np.bincount(text, found, len(texts)).astype(np.float64)


def score(coded: DataFrame, flat: np.ndarray, more: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_words, log_likelihood, mean_log_likelihood."""
    small = flat.astype(np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = with_tables(named_parts(small))
        for batch in slices(batches, 32):
            texts = decoded(batch)
            yield pa.record_batch({
                "row": batch["row"], "id": batch["id"], "n_words": pa.array([len(f) for f, _ in texts], pa.int64()),
                "sum": pa.array(log_likelihoods(texts, parts)), "share": batch["share"]})

    kind = coded.schema["id"].dataType.simpleString()
    scored = (coded.select("row", "id", "first", "digits", "share")
              .mapInArrow(work, f"row bigint, id {kind}, n_words bigint, sum double, share bigint").join(more, "row", "left"))
    total = F.round(F.col("sum") + (F.col("share") + F.coalesce("more", F.lit(0))) / FIXED_POINT, 3)
    scored = scored.select(F.col("id").alias(id_col), "n_words", total.alias("log_likelihood"))
    return scored.withColumn("mean_log_likelihood",
                             F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains on all documents and scores them."""
    counts = word_counts(docs, text_col)
    vocabulary = vocabulary_of(counts)
    coded = encode_words(docs, vocabulary, id_col, text_col)
    return score(coded, train(coded), asked_shares(coded, counts, vocabulary), id_col)
