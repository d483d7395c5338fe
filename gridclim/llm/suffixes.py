"""Removal of long repeats with run-length compressed suffix indexes.

A repeat is a string of `length` bytes that starts at two places. Every such window of a text belongs to one anchor:
its k-mer with the smallest hash, the leftmost if it occurs twice. Equal windows have equal anchors at equal offsets, so
only windows whose anchor hash occurs elsewhere can repeat. The windows of one anchor occurrence form a snippet; each
window lies in exactly one snippet, and two snippets share no window of a text.

Spark counts anchors and groups equal snippets, which match over their whole length. Different snippets of one anchor are gathered by
anchor; for each batch of anchors a task builds the Burrows-Wheeler transform, of which it keeps the runs with the suffix positions
at their ends, and streams through the text: the match length falls by one at each byte until the next sampled run end sets it
anew. Windows with matches of `length` bytes or more are repeats. An anchor with more than MOST_SNIPPETS different snippets is
not gathered, as its group grows with the corpus: its snippets are cut into pieces of fewer windows, which are grouped by more of the
bytes around the anchor, and again where a group is still too large; the groups go through the index like all others.

Defined results: a null or empty text has no bytes; texts shorter than `length` stay; a row repeated as a whole is a
repeat of itself; rows may share a doc_id, whatever their texts are; rows with a null doc_id match nothing and stay as
they are; an empty table gives an empty table; other columns pass through, but `kept`, `n_bytes`, `n_removed`
and `n_spans` are replaced. Texts may have up to 2^31 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, stage

LENGTH, KMER = 200, 48
#: No more different snippets are gathered under one anchor; those of a larger group are cut into so many parts at each step.
MOST_SNIPPETS, PARTS = 2_000, 4
#: An index takes so many bytes of snippets, and the rest of its last anchor.
INDEX_BYTES = 1 << 19
#: Anchors are found in pieces of so many windows, which bounds the memory for long texts.
PIECE = 1 << 20
PLACE_BITS = np.uint64(PIECE.bit_length() + 1)
LETTER = np.random.Generator(np.random.PCG64(10)).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and of its inverse, modulo 2 ** 64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE_INVERSE, k, 1 << 64))])
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes at each place."""
    up, down = POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTER[data] * up[:-1], out=total[1:])
    h = (total[k:] - total[:-k]) * down[: len(data) - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def snippets(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, and anchor hash of each snippet of a text. An anchor depends on its window alone, so a long
    text is taken in pieces; where two meet, a snippet may be cut in two."""
    found = []
    for start in range(0, max(0, len(data) - length + 1), PIECE):
        first, windows, anchor = _snippets(data[start : start + PIECE + length - 1], length, k)
        found.append((first + start, windows, anchor))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _snippets(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = kmer_hashes(np.frombuffer(data, np.uint8), k)
    least = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    width, step = length - k + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[: step - width], least[width - step :])
    anchor = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    return first, np.diff(first, append=len(anchor)), h[anchor[first]].view(np.int64)


#: A row is known by its id and its text, as ids may repeat.
ROW = ["doc_id", "_text_hash"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text_hash", F.xxhash64("text"))


def occurrences(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """docs(doc_id, text) -> doc_id, _text_hash, first, windows, anchor, digest: a row per snippet."""

    def make(batch: list[str]) -> tuple:
        at, columns = [], []
        for i, text in enumerate(batch):
            data = text.encode()
            first, windows, anchor = snippets(data, length, k)
            ends = (first + windows + length - 1).tolist()
            digest = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), ends)), np.uint64, len(first))
            at.append(np.full(len(first), i))
            columns.append((first, windows, anchor, digest.view(np.int64)))
        first, windows, anchor, digest = (np.concatenate(x) for x in zip(*columns))
        return np.concatenate(at), [first.astype(np.int32), windows.astype(np.int32), anchor, digest]

    added = {"first": "int", "windows": "int", "anchor": "long", "digest": "long"}
    return map_texts(_rows(docs.where(F.col("doc_id").isNotNull())).select(*ROW, "text"), make, added)


def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of each place the rank of its key; equal keys have equal ranks."""
    k = key[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], k[1:] != k[:-1]]))
    return rank


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """The places of `text` in order of their suffixes up to the snippet's end, equal ones in order of place. `longest`: the length
    of the longest snippet with its separator. Ranks by as many symbols as fit 63 bits come first, then by three times as many
    at each step."""
    n, bits = len(text), int(text.max(initial=1)).bit_length()
    width = 63 // bits
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(width, text.dtype)]).astype(np.uint64)
    for i in range(width):
        key = key << np.uint64(bits) | padded[i : n + i]
    rank = _ranks(np.argsort(key), key)
    times = 3 if (n + 1) ** 3 < 1 << 63 else 2
    while width < longest and rank.max(initial=0) < n - 1:
        key = rank
        for i in range(1, times):  # 0: the end of the text comes first
            later = np.zeros(n, np.int64)
            later[: max(0, n - i * width)] = rank[i * width :] + 1
            key = key * (n + 1) + later
        rank = _ranks(np.argsort(key), key)
        width *= times
    return np.argsort(rank * n + np.arange(n))


class RunIndex:
    """The runs of a text's Burrows-Wheeler transform with the suffix positions at both ends of each run. Nothing as long as the text
    is kept beside the text itself."""

    def __init__(self, snippets: list[bytes]):
        """The text is all snippets, each closed by a separator that comes before all bytes."""
        self.longest = max(map(len, snippets), default=0) + 1
        raw = np.concatenate([np.append(np.frombuffer(x, np.uint8).astype(np.int16) + 1, np.int16(0)) for x in snippets])
        used = np.zeros(257, bool)
        used[raw] = used[0] = True
        self.text = (np.cumsum(used) - 1)[raw].astype(np.uint8 if used.sum() <= 256 else np.uint16)  # UTF-8 never has all 256 bytes
        order = suffix_order(self.text, self.longest)
        before = self.text[order - 1].astype(np.int64)
        # separators count as different, so that every snippet's start is sampled and no match is followed beyond it
        before = np.where((order == 0) | (before == 0), -1 - order, before)
        change = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.symbols = before[np.concatenate([[0], change])]
        self.starts, self.ends = order[np.concatenate([[0], change])], order[np.concatenate([change - 1, [len(order) - 1]])]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at p and q, as far as snippets go: eight bytes at a time."""
        size, n = self.text.itemsize, len(self.text)
        step = 8 // size
        padded = np.concatenate([self.text, np.zeros(self.longest + 8, self.text.dtype)])
        eight = np.ndarray((len(padded) - step + 1,), "<u8", padded.tobytes(), strides=(size,))  # at each place what begins there
        got, left = np.zeros(len(p), np.int64), np.arange(len(p))
        while len(left):
            differ = eight[p[left] + got[left]] ^ eight[q[left] + got[left]]
            same = differ == 0
            low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
            got[left] += np.where(same, step, np.bitwise_count(low - np.uint64(1)) // (8 * size))
            left = left[same]
            left = left[got[left] < self.longest]
        return np.minimum(got, n - np.maximum(p, q))

    def _stream(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Match lengths of all places from those sampled: one less at each place up to the next sample."""
        known = np.full(len(self.text), -1, np.int64)
        known[at] = np.arange(len(at))
        last = np.maximum.accumulate(np.where(known >= 0, np.arange(len(self.text)), -1))
        found = np.where(last >= 0, value[known[last]] - (np.arange(len(self.text)) - last), 0)
        return np.maximum(found, 0)

    def match_lengths(self) -> np.ndarray:
        """For each place, the longest match with any other place. The neighbours in suffix order decide: both are
        sampled where a run starts or ends, and elsewhere move along with the place."""
        shared = self.common(self.starts[1:], self.ends[:-1])
        ahead = self._stream(np.concatenate([self.starts[:1], self.starts[1:]]), np.concatenate([[0], shared]))
        behind = self._stream(np.concatenate([self.ends[:-1], self.ends[-1:]]), np.concatenate([shared, [0]]))
        return np.maximum(ahead, behind)


def repeated_windows(batch: list[bytes], length: int) -> list[np.ndarray]:
    """For each snippet, which of its windows start anywhere else in the batch."""
    found = RunIndex(batch).match_lengths() >= length
    ends = np.cumsum([len(x) + 1 for x in batch])
    return [found[e - len(x) - 1 : e - length] for x, e in zip(batch, ends)]


def _snippet_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted(doc_id, _text_hash, first, windows, anchor, digest) -> anchor, digest, data, each once."""
    listed = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("first", "windows", "anchor", "digest")).alias("_list"))

    def make(batch: list[str], lists: list) -> tuple:
        at, anchor, digest, data = [], [], [], []
        for i, (text, parts) in enumerate(zip(batch, lists)):
            raw = text.encode()
            for x in parts:
                at.append(i)
                anchor.append(x["anchor"])
                digest.append(x["digest"])
                data.append(raw[x["first"] : x["first"] + x["windows"] + length - 1])
        return at, [anchor, digest, data]

    joined = _rows(docs).select(*ROW, "text").join(listed, ROW)
    found = map_texts(joined, make, {"anchor": "long", "digest": "long", "data": "binary"}, "text", ("_list",)).drop(*ROW)
    return found.dropDuplicates(["anchor", "digest"])  # a row that is there twice gives its snippets twice


def _index_anchors(data: DataFrame, length: int) -> DataFrame:
    """data(anchor, digest, data) -> digest, anchor, bits: which windows repeat, decided by an index for each batch of anchors."""

    def decide(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_windows([x for _, _, x in rows], length)
        bits = [np.packbits(f).tobytes() for f in found]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(bits, pa.binary())], ["anchor", "digest", "bits"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "data"))):
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield decide(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield decide(held)

    placed = data.repartition("anchor").sortWithinPartitions("anchor")
    return placed.select("anchor", "digest", "data").mapInArrow(apply, "anchor long, digest long, bits binary")


def _cut_pieces(left: DataFrame, width: int, length: int, k: int) -> DataFrame:
    """left(anchor, digest, start, data) -> pieces of so many neighbouring windows at most: anchor, digest, start, windows, group, mark,
    data. Pieces end at fixed distances from the anchor; `group` names the bytes around it that all windows of such a piece have."""

    def make(batch: list[bytes], anchors: list, starts: list) -> tuple:
        at, rows = [], []
        for i, (data, anchor, start) in enumerate(zip(batch, anchors, starts)):
            place = int(np.flatnonzero(kmer_hashes(np.frombuffer(data, np.uint8), k).view(np.int64) == anchor)[0])
            least = place - (len(data) - length)  # windows start from `place` to `least` bytes before the anchor
            for cell in range(least // width, place // width + 1):
                near, far = cell * width, min(cell * width + width, length - k + 1) - 1
                a, b = place - min(place, far), place - max(least, near)
                piece = data[a : b + length]
                group = xxhash.xxh3_64_intdigest(data[place - near : place - far + length], seed=cell)
                at.append(i)
                rows.append((start + a, b - a + 1, group, xxhash.xxh3_64_intdigest(piece), piece))
        first, windows, group, mark, data = zip(*rows)
        return at, [first, windows, np.array(group, np.uint64).view(np.int64), np.array(mark, np.uint64).view(np.int64), data]

    copied = left.withColumns({"_anchor": F.col("anchor"), "_start": F.col("start")})
    added = {"start": "int", "windows": "int", "group": "long", "mark": "long", "data": "binary"}
    return map_texts(copied, make, added, "data", ("_anchor", "_start"))


def _split_anchors(data: DataFrame, length: int, k: int) -> DataFrame:
    """data(anchor, digest, data): snippets of anchors that have too many of them -> anchor, digest, bits. They are cut into pieces, which
    meet only where more bytes around the anchor are equal; groups that are still too large are cut again, down to single windows."""
    left, width, found = data.select("anchor", "digest", F.lit(0).alias("start"), "data"), length - k + 1, None
    while width > 1:
        width = -(-width // PARTS)
        pieces, _ = stage(_cut_pieces(left, width, length, k), "pieces")
        kinds = pieces.groupBy("group", "mark").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("anchor", "digest", "start")).alias("at"))
        kinds, _ = stage(kinds, "kinds-of-pieces")
        groups = kinds.groupBy("group").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        groups, _ = stage(groups.select("group", (F.col("k") > MOST_SNIPPETS).alias("many")), "groups-of-pieces")
        ours = F.struct("anchor", "digest", "start") == F.col("at")
        chosen, _ = stage(pieces.join(kinds.join(groups, "group").select("group", "mark", "at", "many"), ["group", "mark"]).where(ours), "pieces-to-decide")
        decided = _index_anchors(chosen.where("not many").select(F.col("group").alias("anchor"), F.col("mark").alias("digest"), "data"), length)
        twice = kinds.where("n > 1").select("group", "mark", F.lit(True).alias("twice"))
        verdict = twice.join(decided.withColumnsRenamed({"anchor": "group", "digest": "mark"}), ["group", "mark"], "full")
        verdict = verdict.select("group", "mark", F.when(F.col("twice").isNull(), F.col("bits")).alias("bits"))
        part = pieces.drop("data").join(verdict, ["group", "mark"]).select("anchor", "digest", F.struct("start", "windows", "bits").alias("piece"))
        found = part if found is None else found.unionByName(part)
        left = chosen.where("many").select("anchor", "digest", "start", "data")
        if left.isEmpty():
            break

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for parts in batch.column("pieces").to_pylist():
                repeated = np.zeros(max(x["start"] + x["windows"] for x in parts), bool)
                for x in parts:  # a piece found twice has no bits: all of it repeats
                    bits = True if x["bits"] is None else np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["windows"]).astype(bool)
                    repeated[x["start"] : x["start"] + x["windows"]] |= bits
                packed.append(np.packbits(repeated).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("digest"), pa.array(packed, pa.binary())], ["anchor", "digest", "bits"])

    return found.groupBy("anchor", "digest").agg(F.collect_list("piece").alias("pieces")).mapInArrow(pack, "anchor long, digest long, bits binary")


def marks(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """doc_id, _text_hash, whole, parts: snippets all of whose windows repeat, and the windows of others; a snippet is written as its
    first window, moved up by 32 bits, and its number of windows."""
    found = occurrences(docs, length, k)
    # smallest and largest digest tell whether all snippets of an anchor are equal
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    # both tables that meet frequent anchors are written first: then Spark can split the frequent ones in the joins
    repeated, _ = stage(anchors.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
    rows, _ = stage(found.join(repeated, "anchor"), "repeated-anchors")
    mixed = rows.where("mixed").groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*ROW, "first", "windows")).alias("at")
    )
    mixed, _ = stage(mixed, "snippets")
    # anchors with too many snippets are few: a row for every MOST_SNIPPETS rows of mixed at most. They are written, so that Spark
    # knows their size; the snippets of a frequent anchor are not gathered for the join
    many, _ = stage(mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > MOST_SNIPPETS).select("anchor", F.lit(True).alias("many")), "frequent-anchors")
    wanted = mixed.join(many, "anchor", "left").select("at.*", "anchor", "digest", F.coalesce("many", F.lit(False)).alias("many"))
    decided = _index_anchors(_snippet_bytes(docs, wanted.where("not many").drop("many"), length), length)
    if not many.isEmpty():
        decided = decided.unionByName(_split_anchors(_snippet_bytes(docs, wanted.where("many").drop("many"), length), length, k))
    # a snippet found twice repeats as a whole, whatever the index says of its windows
    twice = mixed.where("n > 1").select("anchor", "digest", F.lit(True).alias("twice"))
    verdict = twice.join(decided, ["anchor", "digest"], "full").select("anchor", "digest", F.when(F.col("twice").isNull(), F.col("bits")).alias("bits"))
    verdict, _ = stage(verdict, "repeated-windows")
    whole = rows.where("not mixed").select(*ROW, "first", "windows", F.lit(None).cast("binary").alias("bits"))
    parts = rows.where("mixed").join(verdict, ["anchor", "digest"]).select(*ROW, "first", "windows", "bits")
    place = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("windows").cast("long"))
    return whole.unionByName(parts).groupBy(*ROW).agg(
        F.collect_list(F.when(F.col("bits").isNull(), place)).alias("whole"),
        F.collect_list(F.when(F.col("bits").isNotNull(), F.struct(place.alias("place"), "bits"))).alias("parts"),
    )


def cut_repeats(docs: DataFrame, length: int = LENGTH, k: int = KMER, as_text: bool = False) -> DataFrame:
    """docs without `text`, with kept (binary: the bytes that no repeated window covers), n_bytes, n_removed, n_spans.
    as_text: `text` in place of `kept`; characters of which only a part is left go."""
    found = marks(docs, length, k).select(*ROW, F.col("whole").alias("_whole"), F.col("parts").alias("_parts"))
    joined = _rows(docs).join(found, ROW, "left").drop("_text_hash")

    def make(batch: list[str], wholes: list, lists: list) -> list:
        kept, n_bytes, n_removed, n_spans = [], [], [], []
        for text, whole, parts in zip(batch, wholes, lists):
            rest = data = text.encode()
            removed = spans = 0
            if whole or parts:
                change = np.zeros(len(data) + 1, np.int64)
                place = np.array(whole, np.int64)
                np.add.at(change, place >> 32, 1)
                np.add.at(change, np.minimum((place >> 32) + (place & 0xFFFFFFFF) - 1 + length, len(data)), -1)
                for x in parts:
                    bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["place"] & 0xFFFFFFFF)
                    at = (x["place"] >> 32) + np.flatnonzero(bits)
                    change[at] += 1
                    change[at + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                removed = int(np.count_nonzero(gone))
                spans = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
                if removed:
                    rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            n_bytes.append(len(data))
            n_removed.append(removed)
            n_spans.append(spans)
        return [kept, n_bytes, n_removed, n_spans]

    first = {"text": "string"} if as_text else {"kept": "binary"}
    return map_texts(joined, make, first | {"n_bytes": "long", "n_removed": "long", "n_spans": "long"}, "text", ("_whole", "_parts"))
