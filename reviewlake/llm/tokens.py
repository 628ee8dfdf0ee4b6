"""Token ids of whole texts from a tokenizer file, fast for streams of similar texts.

A byte-level BPE splits before every single space between two other
characters, whatever surrounds it. So ids are looked up word by word in a
bounded memo and the library encodes only words the memo lacks. Texts in which
such splits would not be sure (added tokens, other normalisers or splitters)
go to the library whole.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from collections.abc import Callable

#: Words held per Python worker, and the longest word worth holding.
MEMO_WORDS = 300_000
#: Words held for rank files, whose library is fast enough to hold fewer.
MEMO_RANKED = 100_000
MEMO_WORD_CHARS = 48

SURE_SPLIT = re.compile(r"(?<=\S) (?=\S)")
#: Runs between which the pattern always splits, whatever stands beside them; no apostrophes.
RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[!-&(-/:-@\[-`{-~]+|\n(?!\n)")

Ids = Callable[[str], list]


def packed(ids: list) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return array("I", ids).tobytes()


class Memo(dict):
    """Ids of texts short enough to be held; a bounded number of them."""

    def __init__(self, encode: Callable[[str], bytes | None], most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, text: str) -> bytes | None:
        ids = self.encode(text)
        if ids is not None and len(text) <= MEMO_WORD_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[text] = ids
        return ids


def by_words(encode: Ids, run: Ids | None = None, most: int = MEMO_WORDS) -> Callable[[str], bytes]:
    """An encoder of whole texts for a tokenizer that splits as the GPT-2 pattern does.

    ``run``, where it is faster, encodes what is known to be one pre-token.
    """
    runs = Memo(lambda text: packed(run(text)), most)

    def word(text: str) -> bytes | None:
        """Ids of ' ' + text; None where a split at its ends is not sure."""
        if not text or text[0].isspace() or text[-1].isspace():
            return None
        parts = RUNS.findall(text) if run else []
        if sum(map(len, parts)) != len(text):
            return packed(encode(" " + text))
        parts[0] = " " + parts[0]
        return b"".join(map(runs.__getitem__, parts))

    held = Memo(word, most).__getitem__

    def whole(text: str) -> bytes:
        first, *words = text.split(" ")
        if not first or not first[-1].isspace():
            try:
                return packed(encode(first)) + b"".join(map(held, words))
            except TypeError:
                pass
        first, *words = SURE_SPLIT.split(text)
        return packed(encode(first)) + b"".join(held(w) or packed(encode(" " + w)) for w in words)

    return whole


def byte_alphabet() -> dict[int, str]:
    """Byte value -> the printable character byte-level vocabularies write for it."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def json_encoder(path: str) -> Callable[[str], bytes]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(text: str) -> list:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def whole(text: str) -> bytes:
        return packed(encode(text))

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    splitter, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if not (spec.get("normalizer") is None and splitter.get("type") == "ByteLevel"
            and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
            and model.get("type") == "BPE" and not model.get("dropout")):
        return whole
    added = [t["content"] for t in spec.get("added_tokens") or []]
    letters, bpe = byte_alphabet(), tokenizer.model

    def run(text: str) -> list:
        return [t.id for t in bpe.tokenize(text.encode().decode("latin-1").translate(letters))]

    words = by_words(encode, run)
    return lambda text: whole(text) if any(t in text for t in added) else words(text)


def model_encoder(path: str) -> Callable[[str], bytes]:
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    return lambda text: packed(processor.encode(text, num_threads=1))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def rank_encoder(path: str, pattern: str) -> Callable[[str], bytes]:
    """For rank files; words only where ``pattern`` is the one that splits before single spaces."""
    import tiktoken

    coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return by_words(coding.encode_ordinary, most=MEMO_RANKED)


def library_encoder(path: str) -> Callable[[str], bytes]:
    """The encoder a tokenizer file calls for: tokenizers for .json, sentencepiece for .model."""
    return json_encoder(path) if path.endswith(".json") else model_encoder(path)
