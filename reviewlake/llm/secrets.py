"""Secret scan: fixed patterns, and character Markov models for what they miss.

Two first-order models over the characters of tokens, one of random strings and
one of ordinary identifiers and words, are compared by the logarithm of their
likelihood ratio. They are trained from labelled samples. In ``find_secrets``
the labels come from the documents themselves: the values of pattern matches are
samples of random strings, tokens too short to be scored are ordinary. Transitions are counted
in every document; counts of a model are a fixed number of cells, summed in a
shuffle. Half of the random model is a uniform choice of characters, so that
secrets of an alphabet the samples lack are not ruled out. Ordinary words make
identifiers: the ends and beginnings counted give the transitions of words joined
by capitals, underscores, hyphens or slashes, and of all capitals; a share each is
left to repeated and to consecutive characters (rulers, alphabets, counters).

One pass over the texts finds the pattern spans, the long tokens outside them
and the counts; only these are stored and scored, never the texts again. A token
is a secret if its ratio is large in sum and per character.

Spans are ``kind:start:end`` in code points, the end exclusive. The kinds are
``assign`` (a named secret set to a value of 12 characters or more), ``access``
(an access key id of 18 or more), ``hex`` (16 hex digits or more) and ``markov``.

Defined results: a null or empty text has no spans; ids may be null or repeat,
each row keeps its own result; without samples the models are their priors; an empty
table gives an empty result; columns other than id and text are never read.
Texts of any length are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, sql_type, stored

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Whole runs only, so that asking for the least length finds what dropping short matches would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_VALUE = 12

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1
#: Byte -> 1 + place in the alphabet; 0 ends a token.
CODES = bytes(ALPHABET.find(bytes([b])) + 1 for b in range(256))
CODE_OF = np.frombuffer(CODES, np.uint8).astype(np.int32)
JOINERS = (b"_", b"-", b"/")
#: Shortest token that is scored, share of the uniform choice in the random model, shares of repeated and of
#: consecutive characters in the ordinary model, transitions per character taken as seen beforehand.
LEAST_TOKEN, UNIFORM, REGULAR, PSEUDO = 20, 0.5, 0.05, 10
TOKEN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_TOKEN},}}")
#: Least log-likelihood ratio in sum and per transition (nats).
LEAST_SUM, LEAST_MEAN = 20.0, 1.0


# --- patterns ----------------------------------------------------------------

def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[str]]:
    """The pattern spans (start, kind, end) in order, and the secret values in them, each once."""
    spans = []
    low = text.lower()
    if any(name in low for name in NAMES):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        spans += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text)]
    spans.sort()
    values, reach = [], 0
    for start, _, end, value in spans:
        if start >= reach:
            values.append(value)
        reach = max(reach, end)
    return [span[:3] for span in spans], values


def other_tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The long tokens that no pattern span touches."""
    found = [m.span() for m in TOKEN.finditer(text)]
    if not found or not spans:
        return found
    starts = np.array([s for s, _, _ in spans])
    reach = np.maximum.accumulate([e for _, _, e in spans])
    last = np.searchsorted(starts, [e for _, e in found]) - 1
    return [t for t, i in zip(found, last) if i < 0 or reach[i] <= t[0]]


# --- models ------------------------------------------------------------------

def transitions(data: bytes) -> np.ndarray:
    """How often each character of the alphabet follows each other one; 0 stands for what lies between tokens."""
    codes = np.frombuffer(b"\0" + data + b"\0", np.uint8)
    codes = CODE_OF[codes]
    return np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE).reshape(SIZE, SIZE)


def identifiers(counts: np.ndarray) -> np.ndarray:
    """The transitions of ordinary tokens, and of identifiers made of them."""
    inner, begin, end = counts[1:, 1:].astype(float), counts[0, 1:], counts[1:, 0]
    whole = inner.copy()
    upper = np.array([ALPHABET.index(bytes([c]).upper()) for c in ALPHABET])
    letters = np.array([chr(c).isalpha() for c in ALPHABET])
    # All capitals: one word in ten.
    np.add.at(whole, np.ix_(upper[letters], upper[letters]), inner[np.ix_(letters, letters)] / 10)
    words = max(1, begin.sum())
    np.add.at(whole.T, upper, (end[:, None] * begin[None, :] / words / 4).T)
    for joiner in JOINERS:
        whole[:, ALPHABET.index(joiner)] += end / 4
        whole[ALPHABET.index(joiner)] += begin / 4
    return whole


def usual() -> np.ndarray:
    """What ordinary transitions are taken to be before any is seen: mostly within a kind of character, or from a
    capital to a small letter."""
    kind = np.array([0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in ALPHABET.decode()])
    likely = (kind[:, None] == kind) | ((kind[:, None] == 0) & (kind == 1)) | (kind[:, None] == 3)
    return np.where(likely, 0.9 / likely.sum(axis=1, keepdims=True), 0.1 / np.maximum(1, (~likely).sum(axis=1, keepdims=True)))


class Ratio:
    """The two models, as the logarithm of their likelihood ratio per transition."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray):
        letters = SIZE - 1

        def chances(counts: np.ndarray, before: np.ndarray | float) -> np.ndarray:
            return (counts + PSEUDO * before) / (counts.sum(axis=1, keepdims=True) + PSEUDO)

        plain = (1 - 2 * REGULAR) * chances(identifiers(ordinary), usual())
        plain += REGULAR * (np.eye(letters) + np.eye(letters, k=1))
        drawn = UNIFORM / letters + (1 - UNIFORM) * chances(random[1:, 1:], 1 / letters)
        self.table = np.zeros((SIZE, SIZE))
        self.table[1:, 1:] = np.log(drawn) - np.log(plain)

    def of(self, token: str) -> float:
        codes = np.frombuffer(token.encode().translate(CODES), np.uint8)
        return float(self.table[codes[:-1], codes[1:]].sum())

    def is_secret(self, token: str) -> bool:
        ratio = self.of(token)
        return ratio >= LEAST_SUM and ratio >= LEAST_MEAN * (len(token) - 1)


def count_rows(random: np.ndarray, ordinary: np.ndarray) -> pa.Array:
    return pa.array([np.stack([random, ordinary]).tobytes()], pa.binary())


def learnt(counted: DataFrame) -> Ratio:
    """The models from rows of ``counts``, one per task."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SIZE * SIZE, np.int64)
        for batch in batches:
            for counts in batch["counts"].to_pylist():
                total += np.frombuffer(counts, np.int64)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": pa.array(cells.astype(np.int32)), "n": pa.array(total[cells])})

    cells = (counted.mapInArrow(add, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
             .collect())  # at most 2 * SIZE * SIZE rows
    whole = np.zeros(2 * SIZE * SIZE, np.int64)
    for row in cells:
        whole[row["cell"]] = row["n"]
    return Ratio(*whole.reshape(2, SIZE, SIZE))


def train(samples: DataFrame, value_col: str = "value", secret_col: str = "secret") -> Ratio:
    """The models from labelled samples: a string and whether it is a secret; null rows are passed over."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((SIZE, SIZE), np.int64), np.zeros((SIZE, SIZE), np.int64)]
        for batch in batches:
            secret = np.array(batch["secret"].to_pylist(), bool)
            values = batch["value"].to_pylist()
            for which, wanted in ((0, True), (1, False)):
                joined = "\0".join(v for v, s in zip(values, secret) if s == wanted)
                totals[which] += transitions(joined.encode())
        yield pa.record_batch({"counts": count_rows(*totals)})

    rows = samples.select(named(value_col).alias("value"), named(secret_col).alias("secret")).dropna()
    return learnt(rows.mapInArrow(count, "counts binary"))


# --- documents ---------------------------------------------------------------

def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (id, base, tokens) per document, and one row of ``counts`` per task."""
    kind = sql_type(docs, id_col)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    token_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, ordinary = np.zeros((SIZE, SIZE), np.int64), np.zeros((SIZE, SIZE), np.int64)
        id_type = None
        for batch in slices(batches):
            base, tokens, secret, judged = [], [], [], []
            texts = batch["body"].to_pylist()
            for text in texts:
                spans, values = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                tokens.append([{"start": s, "end": e, "value": text[s:e]} for s, e in other_tokens(text, spans)])
                secret += values
                judged += [t["value"] for t in tokens[-1]]
                ordinary += transitions(text.encode())
            held = transitions("\0".join(secret).encode())
            random += held
            ordinary -= held + transitions("\0".join(judged).encode())
            id_type = batch["id"].type
            yield pa.record_batch({"id": batch["id"], "base": pa.array(base, spans_type),
                                   "tokens": pa.array(tokens, token_type), "counts": pa.nulls(len(texts), pa.binary())})
        if id_type is not None:
            yield pa.record_batch({"id": pa.nulls(1, id_type), "base": pa.nulls(1, spans_type),
                                   "tokens": pa.nulls(1, token_type),
                                   "counts": count_rows(random, np.maximum(ordinary, 0))})

    rows = docs.select(named(id_col).alias("id"), body(text_col).alias("body"))
    return stored(rows.mapInArrow(
        work, f"id {kind}, base array<struct<start int, kind int, end int>>, "
              "tokens array<struct<start int, end int, value string>>, counts binary"), "secret-scan")


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: Ratio | None = None) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, spans; ``ratio`` replaces models from these documents."""
    small_batches(docs)
    found = scanned(docs, id_col, text_col)
    model = ratio or learnt(found.where("counts is not null").select("counts"))
    kind = sql_type(docs, id_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for base, tokens in zip(batch["base"].to_pylist(), batch["tokens"].to_pylist()):
                fixed = [(s["start"], s["kind"], s["end"]) for s in base]
                more = [(t["start"], 3, t["end"]) for t in tokens if model.is_secret(t["value"])]
                text = written(fixed)
                kinds = [k for _, k, _ in fixed]
                rows.append({"n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2),
                             "base_sha256": hashlib.sha256(text.encode()).hexdigest(),
                             "spans": written(fixed + more) if more else text})
            whole = pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                ("base_sha256", pa.string()), ("spans", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch["id"], *whole.columns], names=["id", *whole.schema.names])

    rows = found.where("counts is null").select("id", "base", "tokens")
    return rows.mapInArrow(judge, f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
                                  "spans string").withColumnRenamed("id", id_col)
