"""Byte-level BPE encoding and decoding, equal to the tokenizers library's for the same tokenizer file.

A word's parts are held as one contiguous array of boundaries with the ranks of adjacent pairs beside it: scan for the
least rank, delete that boundary, refresh the two neighbouring ranks, until no pair has a rank. Words over LONG bytes
go through a heap instead, where scanning would take quadratic time; the result is the same.

Defined results: a null text is an empty text and has no ids; special tokens written out in a text become their ids;
repeated rows and ids stay; an empty table gives an empty table; other columns pass through, but those named as an
output are replaced. Letters are those of the regex library's Unicode version; code points that only newer or older
versions assign may be split otherwise than by the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from gridclim.llm.common import map_texts

#: Fixed: how byte-level tokenizers split text before merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONG = 400
#: Words whose ids a task remembers; the memory is emptied when full.
REMEMBERED = 300_000
NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself if printable, else 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder made from a tokenizer file's vocabulary and merges."""

    def __init__(self, spec: dict):
        byte_of = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.first = [0] * 256
        for letter, b in byte_of.items():
            self.first[b] = vocab[letter]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.rank.setdefault((vocab[left], vocab[right]), len(self.merged))
            self.merged.append(vocab[left + right])
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        parts = [self.first[b] for b in word]
        if len(parts) > LONG:
            return self._merge_long(parts)
        rank, merged = self.rank, self.merged
        ranks = [rank.get(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), NEVER)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, rank = len(parts), self.rank
        before, after, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
        heap = [(rank[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in rank]
        heapq.heapify(heap)
        while heap:
            least, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or rank.get((parts[i], parts[j])) != least:
                continue
            parts[i], alive[j], after[i] = self.merged[least], False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := rank.get((parts[i], parts[after[j]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank.get((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [p for p, a in zip(parts, alive) if a]

    def _plain(self, text: str) -> bytes:
        known = self.known
        words = WORDS.findall(text)
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = np.array(self.merge(w.encode()), "<u4").tobytes()
            return b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit integers."""
        if not self.special or not self.split_special.search(text):
            return self._plain(text)
        return b"".join(
            np.array([self.special[x]], "<u4").tobytes() if x in self.special else self._plain(x)
            for x in self.split_special.split(text)
        )

    def decode(self, ids: bytes) -> str:
        of = self.bytes_of
        return b"".join([of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """The codec of a tokenizer file, made once in each Python process."""
    with open(path, encoding="utf-8") as f:
        return ByteBPE(json.load(f))


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """docs without `column`, with `ids` (binary, little-endian unsigned 32-bit) in its place."""
    return map_texts(docs, lambda batch: [[load(path).encode(t) for t in batch]], {"ids": "binary"}, column, done=lambda: load(path).known.clear())


def round_trip_digests(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """Encode each text, decode the ids, and give the digests of both: n_tokens, ids_sha256, decoded_sha256."""

    def make(batch: list[str]) -> list:
        codec = load(path)
        n_tokens, ids_digest, text_digest = [], [], []
        for text in batch:
            ids = codec.encode(text)
            n_tokens.append(len(ids) // 4)
            ids_digest.append(hashlib.sha256(ids).hexdigest())
            text_digest.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        return [n_tokens, ids_digest, text_digest]

    return map_texts(docs, make, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, column, done=lambda: load(path).known.clear())
