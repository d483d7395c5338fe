"""Packing of tokenised documents into windows of a fixed number of tokens.

Documents are tokenised, closed by an end id, and cut: full windows first, then the rest. Pieces are dealt evenly to
shards of bounded size. Each shard is packed on its own by best-fit decreasing: a segment tree over remaining
capacities finds the tightest open window that still takes the piece. A sequence id carries its shard.

Defined results: a null or empty text is its end id alone; repeated rows and repeated ids are packed as documents of
their own; an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridclim.llm.common import map_texts, stage

#: Pieces that one shard packs; the padding that shards cost is a part of a window each.
SHARD_PIECES = 20_000
#: Words whose ids a task remembers; the memory is emptied when full, and after the task.
REMEMBERED = 1_000_000
#: A comma or full stop between a letter and a blank is a word of its own for the tokenizer.
WORD_END = re.compile(rb"(?<=[a-z])([,.])(?=[\t-\r ])")
#: Byte-level vocabularies write each byte as a printable letter: itself if printable, else 256 and on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*PRINTABLE}))}


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """A lower-casing byte-level tokenizer that never merges across white space or from letters into signs: remembered
    ids of single words make up a text's. Texts are lower-cased and freed of commas and full stops at word ends first,
    so that fewer words are unknown; unknown words of plain letters go straight to the tokenizer's merges."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model.tokenize
        self.mark, self.mark_id = next((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items())
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.start, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, words: list[bytes], flat: np.ndarray, length: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, flat])
        self.index.update(zip(words, range(len(self.length) - len(words), len(self.length))))

    def _learn(self, words: set[bytes]) -> None:
        plain, joined, marked = [], [], []
        flat, length = [], []
        for w in words:
            text = w.decode()
            if text.isalpha() and (text.isascii() or max(text) < "\u0180") and text == text.lower():
                ids = [t.id for t in self.merges(w.decode("latin-1").translate(BYTE_LETTERS))]
                plain.append(w)
                flat += ids
                length.append(len(ids))
            else:
                (marked if "<|" in text else joined).append(w)
        self._add(plain, np.array(flat, np.uint32), np.array(length, np.int64))
        if joined:  # one call for all, each closed by a special token, which nothing merges across
            whole = self.mark.join([w.decode() for w in joined]) + self.mark
            ids = np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.uint32)
            self._add(joined, ids[ids != self.mark_id], np.diff(np.flatnonzero(ids == self.mark_id), prepend=-1) - 1)
        for w in marked:
            ids = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32)
            self._add([w], ids, np.array([len(ids)], np.int64))

    @staticmethod
    def _words(text: str) -> list[bytes]:
        raw = text.encode()
        # special tokens, and marks that compose with some small letters only, need the text as it is
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = WORD_END.sub(rb" \1", raw.lower())
        return raw.split()

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        words = [self._words(t) for t in batch]
        if len(self.index) > REMEMBERED:
            self.forget()
        flat_words = list(chain.from_iterable(words))
        at = np.fromiter(map(self.index.get, flat_words, repeat(-1)), np.int64, len(flat_words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            missing = [flat_words[i] for i in unknown]
            self._learn(set(missing))
            at[unknown] = np.fromiter(map(self.index.__getitem__, missing), np.int64, len(missing))
        length = self.length[at]
        flat = self.flat[_ragged(self.start[at], length)]
        word_ends = np.cumsum([len(x) for x in words])
        ends = np.concatenate([[0], np.cumsum(length)])
        return np.split(flat, ends[word_ends][:-1])


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    """The word tokenizer of a file, made once in each Python process."""
    return WordIds(path)


def pieces(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """docs(doc_id, text) -> doc_id, start, length, ids_crc32, doc_tokens[, ids]: full windows, then the rest."""

    def cut(batch: list[str]) -> tuple:
        at, start, length, crc, tokens, kept = [], [], [], [], [], []
        for i, ids in enumerate(load(path).encode(batch)):
            raw = np.append(ids, np.uint32(end_id)).astype("<u4")
            for a in range(0, len(raw), window):
                piece = raw[a : a + window].tobytes()
                at.append(i)
                start.append(a)
                length.append(len(piece) // 4)
                crc.append(zlib.crc32(piece))
                tokens.append(len(raw))
                kept.append(piece)
        return at, [start, length, crc, tokens, *([kept] if with_ids else [])]

    added = {"start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long"}
    return map_texts(docs.select("doc_id", "text"), cut, added | ({"ids": "binary"} if with_ids else {}), done=lambda: load(path).forget())


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the least capacity that suffices."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.some = [False] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.windows[room].append(sequence)
        node = room + self.size
        while node and not self.some[node]:
            self.some[node] = True
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove the tightest window with room for `least`: its room and number."""
        some, node = self.some, least + self.size
        while not some[node]:  # to the next subtree on the right that holds a window
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if some[2 * node] else 2 * node + 1
        room = node - self.size
        sequence = self.windows[room].pop()
        if not self.windows[room]:
            some[node] = False
            node >>= 1
            while node and not (some[2 * node] or some[2 * node + 1]):
                some[node] = False
                node >>= 1
        return room, sequence


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Sequence and offset of each length (given in decreasing order), and how many sequences there are."""
    tree, sequences, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, used = (window, used), used + 1
        room, sequence = found
        sequences.append(sequence)
        offsets.append(window - room)
        if room > length:
            tree.add(room - length, sequence)
    return sequences, offsets, used


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """docs(doc_id, text) -> a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]."""
    cut, _ = stage(pieces(docs, path, window, end_id, with_ids), "pieces")
    shards = max(1, -(-cut.count() // SHARD_PIECES))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        held = pa.Table.from_batches(batches)
        order = np.lexsort([held[c].to_numpy() for c in ("start", "ids_crc32")] + [-held["length"].to_numpy()])
        own = held.take(pa.array(order))
        chosen, offsets, _ = best_fit_decreasing(own["length"].to_pylist(), window)
        first = TaskContext.get().partitionId() << 32
        own = own.append_column("sequence_id", pa.array([first + s for s in chosen], pa.int64()))
        yield from own.append_column("offset", pa.array(offsets, pa.int64())).to_batches(max_chunksize=10_000)

    schema = [*(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema), "sequence_id long", "offset long"]
    # dealt round-robin, so that no id or length can fill a shard
    return cut.repartition(shards).mapInArrow(apply, ", ".join(schema))


def sequences(packed: DataFrame) -> DataFrame:
    """pack(with_ids=True) -> sequence_id, ids (binary, little-endian unsigned 32-bit), n_tokens; a window's rows at most meet."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda got, part: F.concat(got, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
