"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. Three letters in a row are bound
into one vector by permuting (rotating) by place and multiplying; a text's
vector is the bundle (sum) of its trigram vectors, and so is a language's
prototype, to which every learning document adds with equal weight. A document
gets the language whose prototype has the largest cosine with its own vector.

The vectors are of fixed length, so what is gathered per language does not
grow with the data. Bundles are sums of whole numbers: any partitioning gives
the same prototypes.

Defined results: ``und`` with score 0 for texts that are null or have no
letter, and for all texts where nothing could be learnt; ties go to the
language first in order; null languages teach nothing; repeated rows count as
often as they are; an empty table gives an empty result; columns other than
id, text and lang are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, small_batches, sql_type

#: Length of the vectors, and the seed the letters' vectors come from.
DIMENSIONS = 1024
SEED = 20250
#: What one document adds to its language, divided among its trigrams.
WEIGHT = 1 << 20
#: The most languages that may be learnt; prototypes are this many vectors at most.
LANGUAGES = 4096
#: Characters, trigrams and documents worked on at once.
SLICE = 1 << 20
COLUMNS = 4096
ROWS = 256
HELD_OUT = 2
UNDETERMINED = "und"


class Letters:
    """Vectors of letters, made from their code points; a bounded number is held."""

    def __init__(self, dimensions: int = DIMENSIONS, held: int = 4096):
        self.dimensions, self.held, self.known = dimensions, held, {}

    def __call__(self, points: np.ndarray) -> np.ndarray:
        if len(self.known) > self.held:
            self.known.clear()
        for p in points.tolist():
            if p not in self.known:
                bits = np.random.Generator(np.random.PCG64([SEED, p])).integers(0, 2, self.dimensions)
                self.known[p] = (2 * bits - 1).astype(np.int8)
        return np.stack([self.known[p] for p in points.tolist()])


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of lower-cased letters (packed code points) and their counts.

    Everything else is one blank, also before the first and after the last word.
    """
    found: dict[int, int] = {}
    codes, counts, carry = [], [], np.array([32], np.int64)
    any_letter = False
    for at in range(0, len(text), SLICE):
        part = text[at:at + SLICE].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols, where = np.unique(points, return_inverse=True)
        letter = np.array([chr(s).isalpha() for s in symbols.tolist()], bool)[where]
        any_letter |= bool(letter.any())
        points = np.concatenate([carry, np.where(letter, points, 32)])
        points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
        last = at + SLICE >= len(text)
        if last and points[-1] != 32:
            points = np.append(points, 32)
        grams = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
        c, n = np.unique(grams, return_counts=True)
        codes.append(c)
        counts.append(n)
        carry = points[-2:]
    if not any_letter:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    c, where = np.unique(np.concatenate(codes), return_inverse=True)
    return c, np.bincount(where, np.concatenate(counts)).astype(np.int64)


def gram_vectors(grams: np.ndarray, letters: Letters) -> np.ndarray:
    """Bound vectors: the first letter's rotated twice, times the second's rotated once, times the third's."""
    bound = None
    for shift, turn in ((42, 2), (21, 1), (0, 0)):
        points, where = np.unique((grams >> shift) & 0x1FFFFF, return_inverse=True)
        vectors = np.roll(letters(points), turn, axis=1)[where]
        bound = vectors if bound is None else bound * vectors
    return bound


def bundle(rows: list[tuple[np.ndarray, np.ndarray]], letters: Letters) -> np.ndarray:
    """The bundles of (trigrams, weights) as rows of one matrix."""
    total = np.zeros((len(rows), letters.dimensions))
    if not rows:
        return total
    grams, where = np.unique(np.concatenate([g for g, _ in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(g) for g, _ in rows])
    weights = np.concatenate([w for _, w in rows]).astype(np.float64)
    for at in range(0, len(grams), COLUMNS):
        here = (where >= at) & (where < at + COLUMNS)
        block = np.zeros((len(rows), min(COLUMNS, len(grams) - at)), np.float32)
        block[owner[here], where[here] - at] = weights[here]
        total += block @ gram_vectors(grams[at:at + COLUMNS], letters).astype(np.float32)
    return total


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for null ids."""
    return F.coalesce(F.crc32(named(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Language -> prototype, from documents that have a language and are not held out."""
    small_batches(docs)
    lessons = docs.where(named(lang_col).isNotNull() & ~held_out(id_col)).select(
        named(lang_col).cast("string").alias("lang"), body(text_col).alias("body"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(), {}
        for batch in (b.slice(at, 4 * ROWS) for b in batches for at in range(0, b.num_rows, 4 * ROWS)):
            weighted: dict[str, list] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["body"].to_pylist()):
                grams, counts = trigrams(text)
                if len(grams):
                    seen = weighted.setdefault(lang, [[], []])
                    seen[0].append(grams)
                    seen[1].append(counts * WEIGHT // counts.sum())
            rows = []
            for grams, weights in weighted.values():
                distinct, where = np.unique(np.concatenate(grams), return_inverse=True)
                rows.append((distinct, np.bincount(where, np.concatenate(weights))))
            for lang, vector in zip(weighted, exact_bundle(rows, letters)):
                sums[lang] = sums.get(lang, 0) + vector
        for lang, vector in sums.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(vector)),
                                   "place": pa.array(np.arange(len(vector), dtype=np.int32)),
                                   "value": pa.array(vector)})

    sums = (lessons.mapInArrow(work, "lang string, place int, value bigint")
            .groupBy("lang", "place").agg(F.sum("value").alias("value")).groupBy("lang")
            .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
            .select("lang", "v.value").orderBy("lang"))
    found = sums.limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    return {row["lang"]: np.array(row["value"], np.float64) for row in found}


def exact_bundle(rows: list[tuple[np.ndarray, np.ndarray]], letters: Letters) -> np.ndarray:
    """As ``bundle``, in whole numbers."""
    total = np.zeros((len(rows), letters.dimensions), np.int64)
    for i, (grams, weights) in enumerate(rows):
        for at in range(0, len(grams), COLUMNS):
            total[i] += np.rint(weights[at:at + COLUMNS].astype(np.float64)
                                @ gram_vectors(grams[at:at + COLUMNS], letters).astype(np.float64)).astype(np.int64)
    return total


class Classifier:
    """Languages and cosines of texts, for a dictionary of prototypes."""

    def __init__(self, prototypes: dict):
        self.names = sorted(prototypes)
        matrix = np.stack([prototypes[n] for n in self.names]) if self.names else np.zeros((1, DIMENSIONS))
        self.unit, self.letters = unit_rows(matrix), Letters()

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        rows = [trigrams(t) for t in texts]
        cosines = np.round(unit_rows(bundle(rows, self.letters)) @ self.unit.T, 9)
        best = cosines.argmax(axis=1)
        known = [bool(len(grams) and self.names) for grams, _ in rows]
        score = np.where(known, np.clip(cosines[np.arange(len(rows)), best], 0, 1), 0.0)
        return [self.names[b] if k else UNDETERMINED for b, k in zip(best, known)], score


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def predict(docs: DataFrame, prototypes: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, lang_pred, score (the cosine, 0 if it is negative)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(prototypes)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                lang, score = classify(batch["body"].to_pylist())
                yield pa.record_batch({"id": batch["id"], "held_out": batch["held_out"],
                                       "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    small_batches(docs)
    texts = docs.select(named(id_col).alias("id"), held_out(id_col).alias("held_out"), body(text_col).alias("body"))
    found = texts.mapInArrow(work, f"id {sql_type(docs, id_col)}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return predict(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)


def drop_undetermined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` for which ``identify`` gives a language, or would if any could be learnt.

    So only texts without a letter go, also where no row has a language. Rows are judged where they are read, so no text is shuffled.
    """
    prototypes = learn(docs, id_col, text_col, lang_col)

    @F.pandas_udf("boolean")
    def determined(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Without prototypes, texts with a letter are called by an empty name.
        classify = Classifier(prototypes or {"": np.ones(DIMENSIONS)})
        for texts in parts:
            found = [lang != UNDETERMINED for at in range(0, len(texts), ROWS)
                     for lang in classify(texts.iloc[at:at + ROWS].tolist())[0]]
            yield pd.Series(found, dtype=bool)

    return docs.where(determined(body(text_col)))
