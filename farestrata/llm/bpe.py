"""Byte-pair encoding and decoding with a public vocabulary.

A text is cut at special tokens, then into words by the vocabulary's pattern. A short word is merged in a contiguous
array: its part ids and the ranks of adjacent pairs stand side by side, the smallest rank is found by scanning, one
boundary is deleted and only the two neighbouring ranks are looked up again. Words of more than ``SHORT`` bytes give
the same parts by a heap over linked parts, since scanning them over and over would take quadratic time. Every worker
keeps the words it has seen, up to ``CACHE`` of them, and starts afresh when they are more.

NULL and empty texts have no tokens and decode to the empty text. The strings of special tokens in a text become
special ids. Repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from farestrata.llm.common import map_rows

#: Fixed value: the published pattern of byte-level vocabularies.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SHORT = 128
CACHE = 200_000
NO_RANK = 1 << 60


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """The vocabulary of one tokenizer file, ready to encode and decode."""

    def __init__(self, content: str):
        described = json.loads(content)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        alphabet = _byte_alphabet()
        self.specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = 1 + max([*vocabulary.values(), *self.specials.values()])
        self.bytes_of = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token) if token not in self.specials else token.encode()
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.single = [0] * 256
        for char, byte in alphabet.items():
            self.single[byte] = vocabulary[char]
        self.rank: dict[tuple[int, int], int] = {}
        self.joined: list[int] = []
        for n, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault((vocabulary[left], vocabulary[right]), n)
            self.joined.append(vocabulary[left + right])
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words: dict[str, array] = {}

    def merge(self, word: bytes) -> list[int]:
        parts = [self.single[b] for b in word]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank, joined = self.rank, self.joined
        ranks = [rank.get(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            at = ranks.index(best)
            parts[at] = joined[best]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank.get((parts[at - 1], parts[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank.get((parts[at], parts[at + 1]), NO_RANK)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        rank, joined, n = self.rank, self.joined, len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        queue = [(r, i) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if parts[i] < 0 or j >= n or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = joined[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(queue, (s, i))
            if (h := before[i]) >= 0 and (s := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(queue, (s, h))
        return [p for p in parts if p >= 0]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        ids = array("I")
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.specials:
                ids.append(self.specials[piece])
                continue
            words = self.words
            for word in PATTERN.findall(piece):
                known = words.get(word)
                if known is None:
                    known = array("I", self.merge(word.encode()))
                    if len(words) >= CACHE:
                        words.clear()
                    if len(known) <= SHORT:
                        words[word] = known
                ids += known
        return np.frombuffer(ids, "u4").astype("<u4").tobytes() if len(ids) else b""

    def decode(self, ids: bytes | None) -> str:
        tokens = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _codec(content: str) -> Codec:
    return Codec(content)


def _shipped(docs: DataFrame, tokenizer_path: str):
    """The tokenizer file, read once by the driver; a vocabulary has a few megabytes, whatever the corpus."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids``: the ids as little-endian unsigned 32-bit integers in one binary per document."""
    shipped = _shipped(docs, tokenizer_path)

    def run(batches) -> Iterator:
        codec = _codec(shipped.value)
        for keys, texts in batches:
            ids = [codec.encode(text) for text in texts]
            yield keys, [len(i) // 4 for i in ids], ids

    kind = dict(docs.dtypes)[id_col]
    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id") -> DataFrame:
    """``id, text`` from the output of :func:`encode_documents`."""
    shipped = _shipped(encoded, tokenizer_path)

    def run(batches) -> Iterator:
        codec = _codec(shipped.value)
        for keys, ids in batches:
            yield keys, [codec.decode(i) for i in ids]

    kind = dict(encoded.dtypes)[id_col]
    return map_rows(encoded.select(id_col, "ids"), run, f"`{id_col}` {kind}, text string")


def encode_and_check(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids, decoded_sha256, same_text``: :func:`encode_documents` and, in the same pass, the ids decoded.

    ``same_text`` tells whether they decode to the text, NULL counting as empty.
    """
    shipped = _shipped(docs, tokenizer_path)

    def run(batches) -> Iterator:
        codec = _codec(shipped.value)
        for keys, texts in batches:
            ids = [codec.encode(text) for text in texts]
            back = [codec.decode(i) for i in ids]
            yield (
                keys,
                [len(i) // 4 for i in ids],
                ids,
                [hashlib.sha256(text.encode()).hexdigest() for text in back],
                [text == (given or "") for text, given in zip(back, texts, strict=True)],
            )

    kind = dict(docs.dtypes)[id_col]
    return map_rows(
        docs.select(id_col, text_col),
        run,
        f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded_sha256 string, same_text boolean",
    )


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass and keep the digests: ``id, n_tokens, ids_sha256, decoded_sha256``."""
    shipped = _shipped(docs, tokenizer_path)

    def run(batches) -> Iterator:
        codec = _codec(shipped.value)
        for keys, texts in batches:
            ids = [codec.encode(text) for text in texts]
            back = [codec.decode(i) for i in ids]
            yield (
                keys,
                [len(i) // 4 for i in ids],
                [hashlib.sha256(i).hexdigest() for i in ids],
                [hashlib.sha256(text.encode()).hexdigest() for text in back],
            )

    kind = dict(docs.dtypes)[id_col]
    return map_rows(
        docs.select(id_col, text_col),
        run,
        f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
