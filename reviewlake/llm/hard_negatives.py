"""Hard-negative mining over an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own; the pair of
codes is a row's cell. The rows are dealt by id into shards of a bounded size,
and every shard keeps its rows in cell order with the largest distance of its
rows from each code (the radius). A half query scores at most
``query . centre + |query| * radius`` against the rows of a code, so the sum of
two half bounds bounds a cell. A heap over the two descending lists of half
bounds visits cells in descending order of that sum and stops once everything
asked for is certified: nothing unvisited can still enter.

1. Positives: the best rows of the anchor's own label. Certified when as many
   are found as asked for and the next cell's bound is below the last of them.
2. Negatives: for each positive a window of scores, and its best rows of other
   labels. A window is certified when it is full above the next bound, or the
   next bound lies below its lower end.

Anchors travel in blocks to shards: a grid of (shard, block) pairs, so a task
holds one shard and one block. Each shard answers with at most the rows asked
for, and the answers are ranked per anchor. A common vector, label or cell only
makes rows of a shard alike; shards stay equal in size.

The codebooks come from ``SAMPLE`` rows (those with the smallest hashes of
their ids); they decide how soon a search stops, never what it returns.

Defined results: rows with a null id, label or vector, a null or non-finite
component, or a vector of another length than most rows have take no part; rows
that repeat an id count once (of differing ones, the smallest label and vector);
ties go to the smaller id; an anchor without positives, or a positive without a
row in its window, gives no rows; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import named, small_batches, stored

SCALE = 256
#: Rows the codebooks are learnt from, codes per half, rounds of k-means.
SAMPLE, CODES, ROUNDS, SEED = 20_000, 16, 8, 11
#: Rows of a shard, anchors of a block, blocks that meet one copy of a shard.
SHARD_ROWS, BLOCK_ANCHORS, BLOCKS = 16_384, 256, 8
#: Rows scored between two looks at what is certified.
STEP_ROWS = 2_048
POSITIVES, NEGATIVES = 5, 10
#: Per cent of the positive's score between which a hard negative lies.
LOW, HIGH = 30, 90


# --- rows --------------------------------------------------------------------

def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """Stored (id, label, vec): one row per id, components scaled and floored, as doubles."""
    vector = named(vector_col)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = rows.select(named(id_col).cast("long").alias("id"), named(label_col).alias("label"),
                       vector.cast("array<double>").alias("vec"), bad.alias("bad"))
    kept = kept.where("id is not null and label is not null and vec is not null and not bad and size(vec) > 0")

    def whole_part(x: Column) -> Column:
        """``floor`` gives a long; a double beyond 2**52 has no fraction and stays."""
        return F.when(F.abs(x) < 2 ** 52, F.floor(x).cast("double")).otherwise(x)

    whole = F.transform("vec", lambda x: whole_part(x * SCALE))
    one = kept.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")
    held = stored(one.select("id", "label", whole.alias("vec")), "negatives-rows")
    lengths = held.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return held.where(F.size("vec") == (most["d"] if most else 0))


def codebooks(rows: DataFrame) -> list[np.ndarray]:
    """The centres of both halves."""
    few = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()["vec"]
    flat = few.combine_chunks().values.to_numpy() if len(few) else np.empty(0)
    whole = flat.reshape(len(few), -1) if len(few) else np.zeros((1, 2))
    rng = np.random.default_rng(SEED)
    return [k_means(half, rng) for half in halves(whole)]


def halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = vectors.shape[1] // 2
    return vectors[:, :cut], vectors[:, cut:]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * (points @ centres.T)).argmin(axis=1)


def k_means(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:CODES]].astype(float)
    for _ in range(ROUNDS):
        code = nearest(points, centres)
        sizes = np.bincount(code, minlength=len(centres))
        for c in np.flatnonzero(sizes):
            centres[c] = points[code == c].mean(axis=0)
    return centres


# --- shards ------------------------------------------------------------------

def packed_shards(rows: DataFrame, books: list[np.ndarray], shards: int) -> DataFrame:
    """Stored (shard, n, ids, labels, vectors, cells): the rows of a shard in cell order, labels as numbers."""

    def pack(group: pa.Table) -> pa.Table:
        n = group.num_rows
        vectors = group["vec"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        codes = [nearest(h, b) for h, b in zip(halves(vectors), books)]
        cell = codes[0] * len(books[1]) + codes[1]
        order = np.lexsort((group["id"].to_numpy(), cell))
        return pa.table({
            "shard": group["shard"].slice(0, 1), "n": pa.array([n], pa.int32()),
            "ids": pa.array([group["id"].to_numpy()[order].tobytes()], pa.binary()),
            "labels": pa.array([group["label_hash"].to_numpy()[order].tobytes()], pa.binary()),
            "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
            "cells": pa.array([cell[order].astype(np.int32).tobytes()], pa.binary())})

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "vec", "label_hash")
    return stored(dealt.groupBy("shard").applyInArrow(
        pack, "shard int, n int, ids binary, labels binary, vectors binary, cells binary"), "negatives-shards")


class Shard:
    """One shard with its cells and radii."""

    def __init__(self, row: dict, books: list[np.ndarray]):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], -1)
        self.cells = np.frombuffer(row["cells"], np.int32)
        self.books, self.width = books, len(books[1])
        found, starts = np.unique(self.cells, return_index=True)
        self.spans = dict(zip(found.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), row["n"]])))
        self.radii = []
        for half, book, code in zip(halves(self.vectors), books, (self.cells // self.width, self.cells % self.width)):
            far = np.zeros(len(book))
            np.maximum.at(far, code, np.sqrt(((half - book[code]) ** 2).sum(axis=1)))
            self.radii.append(far)
        self.largest = np.abs(self.vectors).max(initial=0.0)
        self.norm = np.sqrt((self.vectors ** 2).sum(axis=1).max(initial=0.0))

    def bounds(self, query: np.ndarray) -> list[np.ndarray]:
        """Per half, the most a row of each code can score; a little more, to be safe from rounding."""
        slack = 1e-9 * np.sqrt(query @ query) * self.norm + 1e-6
        return [book @ part + np.sqrt(part @ part) * far + slack
                for part, book, far in zip(np.split(query, [len(query) // 2]), self.books, self.radii)]

    def scores(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products as whole numbers, exact also where doubles are not."""
        if self.largest * np.abs(query).max(initial=0.0) * len(query) < 2 ** 53:
            return (self.vectors[places] @ query).astype(np.int64)
        exact = [[int(x) for x in row] for row in self.vectors[places].tolist()]
        mine = [int(x) for x in query.tolist()]
        return np.array([sum(x * y for x, y in zip(row, mine)) for row in exact], np.int64)

    def visited(self, query: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Places of rows in steps, each with the bound on all rows still to come (minus infinity at the end)."""
        first, second = self.bounds(query)
        rank = [np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()]
        first, second = first.tolist(), second.tolist()
        heap, seen = [(-(first[rank[0][0]] + second[rank[1][0]]), 0, 0)], {(0, 0)}
        places, held = [], 0
        while heap:
            _, i, j = heapq.heappop(heap)
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(first) and y < len(second) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(first[rank[0][x]] + second[rank[1][y]]), x, y))
            span = self.spans.get(rank[0][i] * self.width + rank[1][j])
            if span:
                places.append(np.arange(*span))
                held += span[1] - span[0]
            if held >= STEP_ROWS or held and not heap:
                yield np.concatenate(places), -heap[0][0] if heap else -np.inf
                places, held = [], 0


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The places of the first ``n`` by descending score, ties by id."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class Best:
    """The first ``n`` rows seen so far whose scores lie within [low, high]."""

    def __init__(self, n: int, low: float = -np.inf, high: float = np.inf):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if len(self.scores) == self.n:
            inside &= scores >= self.scores[-1]
        if inside.any():
            scores, ids = np.append(self.scores, scores[inside]), np.append(self.ids, ids[inside])
            chosen = best(scores, ids, self.n)
            self.scores, self.ids = scores[chosen], ids[chosen]

    def certified(self, bound: float) -> bool:
        return bound < self.low or len(self.scores) == self.n and self.scores[-1] > bound


def search(shard: Shard, query: np.ndarray, wanted: list[Best], takes) -> int:
    """Fills ``wanted`` from the rows that ``takes(labels, ids)`` lets through; returns how many rows were scored."""
    scored = 0
    for places, bound in shard.visited(query):
        ids = shard.ids[places]
        keep = takes(shard.labels[places], ids)
        scored += len(places)
        if keep.any():
            found = shard.scores(places[keep], query)
            for each in wanted:
                each.add(found, ids[keep])
        if all(each.certified(bound) for each in wanted):
            break
    return scored


# --- anchors -----------------------------------------------------------------

def grid(anchors: DataFrame, shards: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """Every block of anchors beside every shard; a shard is copied once per ``BLOCKS`` blocks."""
    copies = -(-n_blocks // BLOCKS)
    block = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(n_blocks)).cast("int")
    asked = (anchors.groupBy(block.alias("block")).agg(F.collect_list(F.struct(*anchors.columns)).alias("anchors"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
             .withColumn("copy", F.col("block") % copies))
    copied = shards.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return asked.drop("block").join(copied, ["shard", "copy"])


def answered(pairs: DataFrame, books: list[np.ndarray], ask, schema: str) -> DataFrame:
    """``ask(shard, anchor)`` gives rows for every anchor of every pair."""
    names = [part.split()[0] for part in schema.split(", ")]
    whole = pa.schema([(name, pa.int64()) for name in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch["shard"][i].as_py(), batch["copy"][i].as_py())
                if here != number:
                    row = {c: batch[c][i].as_py() for c in ("n", "ids", "labels", "vectors", "cells")}
                    number, shard = here, Shard(row, books)
                found = [r for anchor in batch["anchors"][i].as_py() for r in ask(shard, anchor)]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in found], schema=whole)

    return pairs.mapInArrow(work, schema)


def nearest_positives(shard: Shard, anchor: dict) -> list[tuple]:
    mine = Best(POSITIVES)
    search(shard, np.array(anchor["vec"]), [mine],
           lambda labels, ids: (labels == anchor["label_hash"]) & (ids != anchor["id"]))
    return [(anchor["id"], p, s) for p, s in zip(mine.ids.tolist(), mine.scores.tolist())]


def nearest_negatives(shard: Shard, anchor: dict) -> list[tuple]:
    """For each positive (id, score), the first rows of other labels with scores inside its window."""
    windows = [Best(NEGATIVES, -(-LOW * p["score"] // 100), HIGH * p["score"] // 100) for p in anchor["positives"]]
    search(shard, np.array(anchor["vec"]), windows, lambda labels, ids: labels != anchor["label_hash"])
    return [(anchor["id"], p["id"], p["score"], n, s) for p, w in zip(anchor["positives"], windows)
            for n, s in zip(w.ids.tolist(), w.scores.tolist())]


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is the condition on ``id`` that makes a row an anchor.
    """
    small_batches(rows)
    held = usable(rows, id_col, label_col, vector_col)
    # Labels are compared as hashes of their text; labels that are whole numbers keep their value.
    kind = held.schema["label"].dataType.typeName()
    code = F.col("label").cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64("label")
    held = held.withColumn("label_hash", code)
    anchors = held.where(anchor).select("id", "label_hash", "vec")
    n_shards = max(1, -(-held.count() // SHARD_ROWS))
    n_blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    books = codebooks(held)
    shards = packed_shards(held, books, n_shards)
    found = answered(grid(anchors, shards, n_shards, n_blocks), books, nearest_positives,
                     "anchor_id long, positive_id long, score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    positives = (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= POSITIVES)
                 .groupBy("anchor_id").agg(F.collect_list(
                     F.struct(F.col("positive_id").alias("id"), "score")).alias("positives")))
    positives = stored(positives, "negatives-positives")
    asking = anchors.join(positives, anchors["id"] == positives["anchor_id"]).select(
        "id", "label_hash", "vec", "positives")
    found = answered(grid(asking, shards, n_shards, n_blocks), books, nearest_negatives,
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= NEGATIVES)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(rows: DataFrame) -> DataFrame:
    """The given table with wrong labels where 7 divides the id, as a miner meets them."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", moved.alias("label"), "embedding")
