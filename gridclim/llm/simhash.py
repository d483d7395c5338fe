"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are sorted into tiles by the population counts of their four 16-bit parts, large tiles being cut
into blocks. Two fingerprints within `radius` bits have part counts that differ by `radius` in all at most, so only such
pairs of tiles are compared: in numpy, by exclusive-or and bit counts, all against all. A pair of tiles yields a
spanning forest of its links, never more links than fingerprints, which leaves the components as they are.

Defined results: a text without words (null, empty, blank) has fingerprint zero and links like any other; copies share
a fingerprint and so a component; repeated rows stay; rows with a null doc_id are grouped, but never name a component
unless it has no other; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, stage
from gridclim.llm.components import components

PARTS = 4
#: Fingerprints in a block of a tile at most, about; a comparison holds the square of it in bytes.
BLOCK = 2048


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The bits set in over half of the XXH64 hashes of all word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(shingle)))], ">u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65_000):
        ones += np.unpackbits(hashes[a : a + 65_000].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """docs without `text`, with `fp`: the fingerprint as a signed 64-bit integer."""

    def make(batch: list[str]) -> list:
        return [np.array([fingerprint(t, shingle, seed) for t in batch], np.uint64).view(np.int64)]

    return map_texts(docs, make, {"fp": "long"})


def _offsets(radius: int) -> list[list[int]]:
    """Differences of part counts that links can have; of each and its negative, one."""
    near = [v for v in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, v)) <= radius]
    return [list(v) for v in near if v >= (0,) * PARTS]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the two sets within the radius, or a spanning forest of them where they are many."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    i, j = np.nonzero(near)
    if len(i) <= len(left) + len(right):
        return left[i], right[j]
    label = np.arange(len(left) + len(right))
    a, b = [], []
    for row in np.flatnonzero(near.any(axis=1)):
        cols = np.flatnonzero(near[row])
        labels, first = np.unique(label[len(left) + cols], return_index=True)
        new = labels != label[row]
        a.append(np.full(new.sum(), left[row]))
        b.append(right[cols[first[new]]])
        label[np.isin(label, labels[new])] = label[row]
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """distinct(fp) -> a, b: links within the radius that connect what all of them connect."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF)).cast("int") for k in range(PARTS)]
    placed = distinct.select("fp", F.array(*counts).alias("tile"))
    sizes = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))  # each tile has its own
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    tiles = placed.join(sizes, "tile").groupBy("tile", block.alias("block")).agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    tiles, _ = stage(tiles, "tiles")
    # pairs are made of keys alone; the fingerprints of a block are moved once for each pair that there is, and not for others
    keys = tiles.select("tile", "block")
    away = F.array(*(F.array(*map(F.lit, v)) for v in _offsets(radius)))
    asked = keys.select(F.col("tile").alias("own"), F.col("block").alias("own_block"), F.explode(away).alias("offset"))
    asked = asked.select("own", "own_block", F.zip_with("own", "offset", lambda x, y: x + y).alias("tile"))
    pairs = asked.join(keys, "tile").where((F.col("own") != F.col("tile")) | (F.col("own_block") <= F.col("block")))
    own = tiles.select(F.col("tile").alias("own"), F.col("block").alias("own_block"), F.col("fps").alias("own_fps"))
    pairs = pairs.join(tiles, ["tile", "block"]).join(own, ["own", "own_block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for left, right in zip(batch["own_fps"], batch["fps"]):
                left, right = (x.values.to_numpy().view(np.uint64) for x in (left, right))
                got.append(forest(left, right, radius))
            if got:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*got))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return pairs.select("own_fps", "fps").mapInArrow(compare, "a long, b long").where("a != b")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def grouped(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """docs without `text`, with `fp`, `root` (the smallest fingerprint reachable, which names the group) and `component_id`."""
    rows, _ = stage(fingerprints(docs.drop("fp", "root", "component_id"), shingle, seed), "fingerprints")
    distinct, _ = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp, _ = stage(rooted.join(named, "root").select("fp", "root", "component_id"), "components")
    return rows.join(of_fp, "fp")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """docs without `text`, with `fingerprint` (16 hex digits) and `component_id`: the smallest doc_id reachable."""
    named = {c: f"_kept_{c}" for c in docs.columns if c in ("fp", "root")}
    found = grouped(docs.drop("fingerprint").withColumnsRenamed(named), radius, shingle, seed)
    found = found.withColumn("fingerprint", hexadecimal(F.col("fp"))).drop("fp", "root")
    return found.withColumnsRenamed({v: k for k, v in named.items()})


def one_of_each(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row of each group of near-duplicates: the smallest doc_id (null last), of its texts the one with the smallest hash, and of
    rows equal in both the smallest by its other columns. Two texts that share a doc_id and are no near-duplicates both stay."""
    columns = docs.columns
    key = F.xxhash64("text")  # a row is known by its id and its text: ids may repeat
    found = grouped(docs.select("doc_id", "text", key.alias("_key")), radius, shingle, seed)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")).alias("_first"))
    first = first.select(F.col("_first.doc_id").alias("_id"), F.col("_first._key").alias("_hash"))
    held = docs.withColumn("_key", key).join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(F.col("_hash")), "left_semi")
    return held.groupBy("doc_id", "_key").agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
