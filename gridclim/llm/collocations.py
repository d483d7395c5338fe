"""Phrase collocations of each language by best-first branch and bound over prefixes.

Texts are stored once as hashed words. One pass counts words and pairs of words. A prefix q whose first word occurs c times, and that at
most A occurrences can go on from, bounds every phrase that begins with it: its first cut has l = c and r >= a, so the score is at most
floor(2,000,000 A / (c + A)), where A is the lesser of f(q) and the largest count of a pair that begins with q's last word. In each round
the frontier's best prefixes of each language, those whose bound reaches the score of its k-th best candidate, are expanded by counting
what follows them; candidates of that score are settled by what precedes and follows them, as a phrase is dropped if and only if it is
dropped for a phrase one word longer. Prefixes below that bar wait in the frontier. The bar of a language falls until as many candidates
survive as are wanted, with all ties of the last one.

What tasks get for an expansion is a bit map of fixed size. It lets other phrases through as well, which are counted whole and right, so
that they do no harm.

Defined results: null text is empty, null lang is `und`; repeated rows and ids count each time; without candidates there are no rows;
ties go by count, then by phrase in byte order; other columns are not used. Words are known by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.llm.common import small_batches, stage

LONGEST = 4
#: Twice a phrase's count over its parts' counts, in millionths.
UNIT = 2_000_000
#: Bits of the map that a pass gets.
MAP_BITS = 1 << 23
#: Words that are stored, and counted, together.
CHUNK = 1_000_000

_PIECE = re.compile(rb"[.,;:!?\x0A-\x0D]")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _pair(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    h = h * _M1 + following
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def _keys(words: np.ndarray, m: int) -> np.ndarray:
    """A hash of each run of m words."""
    made = np.full(len(words) - m + 1, m, np.uint64)
    for i in range(m):
        made = _pair(made, words[i : len(words) - m + 1 + i])
    return made


class _Hashes(dict):
    """The hash of each word, made once; 0 stands between pieces."""

    def __init__(self):
        super().__init__({None: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word) or 1
        return h


def encode(docs: DataFrame) -> DataFrame:
    """lang, words (hashes as bytes, 0 between pieces) in chunks, and the chunk's different words with their counts; stored."""
    small_batches(docs.sparkSession)

    def pack(lang: str, known: _Hashes, parts: list[np.ndarray]) -> pa.RecordBatch:
        words = np.concatenate(parts)
        ids, n = np.unique(words[words > 0], return_counts=True)
        name = {h: w for w, h in known.items()}
        of = lambda x: pa.array([x.tolist()], pa.list_(pa.int64()))
        seen = pa.array([[name[h].decode() for h in ids.tolist()]], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([words.tobytes()], pa.binary()), seen, of(ids.view(np.int64)), of(n)], ["lang", "words", "seen", "ids", "n"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Hashes, list[np.ndarray]]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for part in _cut(text.as_buffer().to_pybytes().lower() if text.is_valid else b""):
                    known, parts = held.setdefault(lang, (_Hashes(), []))
                    flat = [known[w] for piece in _PIECE.split(part) for w in (*piece.split(), None)]
                    parts.append(np.array(flat, np.uint64))
                    size += len(flat)
                    if size >= CHUNK:
                        yield from (pack(x, *held[x]) for x in held)
                        held, size = {}, 0
        yield from (pack(x, *held[x]) for x in held)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return stage(rows.mapInArrow(apply, "lang string, words binary, seen array<string>, ids array<long>, n array<long>"), "collocation-words")[0]


def _cut(text: bytes) -> Iterator[bytes]:
    """Long texts by pieces of many words, so that no list holds all words of one; cuts lie where pieces end."""
    most, a = 4_000_000, 0
    while len(text) - a > most:
        found = _PIECE.search(text, a + most)
        if found is None:
            break
        yield text[a : found.start()]
        a = found.end()
    yield text[a:]


def count_words(stored: DataFrame) -> DataFrame:
    """lang, w1, word, a."""
    each = stored.select("lang", F.explode(F.arrays_zip("ids", "seen", "n")).alias("e"))
    return each.groupBy("lang", F.col("e.ids").alias("w1")).agg(F.min("e.seen").alias("word"), F.sum("e.n").alias("a"))


def _names(m: int, first: int = 1) -> list[str]:
    return [f"w{i}" for i in range(first, first + m)]


def count_phrases(stored: DataFrame, m: int, wanted: np.ndarray | None = None) -> DataFrame:
    """lang, w1..wm, a: all phrases of m words, or those whose first or last m - 1 words are in the bit map `wanted`."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch["lang"].to_pylist(), batch["words"]):
                words = np.frombuffer(blob.as_buffer(), np.uint64)
                if len(words) < m:
                    continue
                whole = np.lib.stride_tricks.sliding_window_view(words > 0, m).all(axis=1)
                if wanted is not None:
                    place = _keys(words, m - 1) % np.uint64(MAP_BITS)
                    hit = (wanted[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                    whole &= (hit[:-1] | hit[1:]).astype(bool)
                at = np.flatnonzero(whole)
                _, first, n = np.unique(_keys(words, m)[at], return_index=True, return_counts=True)
                at = at[first]
                columns = [pa.array(words[at + i].view(np.int64)) for i in range(m)]
                yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(at), np.int64))), *columns, pa.array(n)], ["lang", *_names(m), "a"])

    schema = ", ".join(["lang string", *(f"{w} long" for w in _names(m)), "a long"])
    return stored.select("lang", "words").mapInArrow(apply, schema).groupBy("lang", *_names(m)).agg(F.sum("a").alias("a"))


def bit_map(prefixes: DataFrame, m: int) -> np.ndarray:
    """prefixes(w1..wm) as bits by their hash: MAP_BITS / 8 bytes, however many there are."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(MAP_BITS, bool)
        for batch in batches:
            made = np.full(batch.num_rows, m, np.uint64)
            for w in _names(m):
                made = _pair(made, batch[w].to_numpy().view(np.uint64))
            bits[made % np.uint64(MAP_BITS)] = True
        packed = np.packbits(bits, bitorder="little")
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at].astype(np.int64))], ["at", "bits"])

    parts = prefixes.select(*_names(m)).mapInArrow(apply, "at long, bits long")
    made = np.zeros(MAP_BITS // 8, np.uint8)
    found = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    made[found["at"].to_numpy()] = found["bits"].to_numpy().astype(np.uint8)
    return made


def score(a: Column, parts: Column) -> Column:
    """floor(UNIT a / parts), exact however large the counts are."""
    return F.call_function("div", UNIT * a.cast("decimal(20,0)"), parts.cast("decimal(20,0)"))


def _scored(phrases: DataFrame, m: int, counts: dict[int, DataFrame], least: int) -> DataFrame:
    """phrases(lang, w1..wm, a) with l, r and score of the lowest cut."""
    rows = phrases.where(F.col("a") >= least)
    for k in range(1, m):
        rows = rows.join(counts[k].select("lang", *_names(k), F.col("a").alias(f"l{k}")), ["lang", *_names(k)])
        rest = counts[m - k].select("lang", *(F.col(w).alias(v) for w, v in zip(_names(m - k), _names(m - k, k + 1))), F.col("a").alias(f"r{k}"))
        rows = rows.join(rest, ["lang", *_names(m - k, k + 1)])
    cut = F.array_min(F.array(*(F.struct(score(F.col("a"), F.col(f"l{k}") + F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, m))))
    empty = [F.lit(None).cast("long").alias(w) for w in _names(LONGEST - m, m + 1)]
    return rows.select("lang", *_names(m), *empty, F.lit(m).alias("m"), "a", cut.alias("c")).select("lang", *_names(LONGEST), "m", "a", "c.l", "c.r", "c.score")


def _bounded(prefixes: DataFrame, counts: dict[int, DataFrame], m: int, least: int) -> DataFrame:
    """prefixes(lang, w1..wm, a) with the bound of all phrases that begin with them, of those that can go on at all."""
    first = counts[1].select("lang", "w1", F.col("a").alias("c"))
    after = counts[2].groupBy("lang", F.col("w1").alias(f"w{m}")).agg(F.max("a").alias("_after"))
    most = F.least("a", "_after")
    held = prefixes.join(first, ["lang", "w1"]).join(after, ["lang", f"w{m}"]).where(most >= least)
    return held.select("lang", *_names(m), score(most, F.col("c") + most).alias("bound"))


def _bars(known: DataFrame, goal: int) -> DataFrame:
    """lang, bar: the score of each language's goal-th best candidate, 0 where it has fewer. Scores are counted first: there are no more
    than UNIT / 2 of them."""
    by_score = known.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    reached = by_score.withColumn("n", F.sum("n").over(W.partitionBy("lang").orderBy(F.desc("score"))))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("n") >= goal, F.col("score"))), F.lit(0)).alias("bar"))


def _surviving(candidates: DataFrame, counts: dict[int, DataFrame], covered: int) -> DataFrame:
    """Candidates that no phrase one word longer covers. What a phrase of two more words covers, one in between covers as well."""
    kept = candidates.where(F.col("m") == LONGEST)
    for m in range(2, LONGEST):
        longer = counts[m + 1]
        sides = (longer.select("lang", *(F.col(w).alias(v) for w, v in zip(_names(m, k), _names(m))), "a") for k in (1, 2))
        most = reduce(DataFrame.unionByName, sides).groupBy("lang", *_names(m)).agg(F.max("a").alias("_longer"))
        held = candidates.where(F.col("m") == m).join(most, ["lang", *_names(m)], "left")
        open_ = F.col("_longer").isNull() | (100 * F.col("_longer") < covered * F.col("a"))
        kept = kept.unionByName(held.where(open_).drop("_longer"))
    return kept


def _ranked(kept: DataFrame, words: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    for w in _names(LONGEST):
        kept = kept.join(words.select("lang", F.col("w1").alias(w), F.col("word").alias(f"_{w}")), ["lang", w], "left")
    named = kept.withColumn("phrase", F.concat_ws(" ", *(f"_{w}" for w in _names(LONGEST))))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, top: int = 2000, least: int = 30, covered: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first `top` phrases of 2 to 4 words that occur `least` times and whose
    occurrences are not to `covered` percent within a longer one."""
    stored = encode(docs)
    words, _ = stage(count_words(stored), "collocation-1")
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    often = F.col("a") >= least
    counts = {1: words.where(often)}
    counts[2], _ = stage(count_phrases(stored, 2).where(often), "collocation-2")
    pairs, _ = stage(_scored(counts[2], 2, counts, least), "collocation-scored-2")
    goal, known = 2 * top, pairs
    bars, _ = stage(_bars(known, goal), "collocation-bars")
    open_pairs, _ = stage(_bounded(counts[2], counts, 2, least), "collocation-frontier")
    reached = lambda rows, what, m: rows.join(bars, "lang").where(F.col(what) >= F.col("bar")).select("lang", *_names(m))
    while True:
        # three words: what goes on from the best prefixes, and what settles the best pairs
        wanted = bit_map(reached(open_pairs, "bound", 2).unionByName(reached(pairs, "score", 2)), 2)
        counts[3], _ = stage(count_phrases(stored, 3, wanted).where(often), "collocation-3")
        open_triples, _ = stage(reached(_bounded(counts[3], counts, 3, least), "bound", 3), "collocation-frontier")
        # the rest of a phrase of four words may begin with a pair that is not among the best
        wanted |= bit_map(open_triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2")), 2)
        counts[3], _ = stage(count_phrases(stored, 3, wanted).where(often), "collocation-3")
        triples, _ = stage(_scored(counts[3], 3, counts, least), "collocation-scored-3")
        wanted = bit_map(open_triples.unionByName(reached(triples, "score", 3)), 3)
        counts[4], _ = stage(count_phrases(stored, 4, wanted).where(often), "collocation-4")
        fours, _ = stage(_scored(counts[4], 4, counts, least), "collocation-scored-4")
        known = pairs.unionByName(triples).unionByName(fours)
        best = known.join(bars, "lang").where("score >= bar").drop("bar")
        kept, _ = stage(_surviving(best, counts, covered), "collocation-kept")
        survivors = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
        settled = bars.join(survivors, "lang", "left").select("lang", "bar", ((F.coalesce("kept", F.lit(0)) >= top) | (F.col("bar") == 0)).alias("settled"))
        if settled.where(~F.col("settled")).isEmpty():
            return _ranked(kept, words, sizes, top)
        goal *= 4
        lower = _bars(known, goal).withColumnRenamed("bar", "_bar")
        bars, _ = stage(settled.join(lower, "lang").select("lang", F.when(F.col("settled"), F.col("bar")).otherwise(F.least("bar", "_bar")).alias("bar")), "collocation-bars")
