"""Quality rules: plain text measures, and perplexity under a modified Kneser-Ney model of character n-grams.

Spark counts the LENGTH-grams of true characters of all texts, over no closed alphabet, so that what is gathered grows
with the input; discounts, shares and the lower orders are aggregates and joins on Spark. The probabilities stay a table.
Only the HEAD most frequent n-grams, a bounded number, are also broadcast; texts meet all others by a join, so that every
n-gram counts with its exact probability. The perplexities of each language give a lower and an upper band from their
observed spread; texts outside the band of their language are rejected, texts that fail the plain rules too.

Defined results: a null or empty text has no words, fails the plain rules and has no perplexity; rows whose language is
null form a language of their own; a text without LENGTH characters has no perplexity and passes the bands; repeated
rows stay and count each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, segment_sums, slices, small_batches, stage

#: Characters of an n-gram of the model. An n-gram is kept in two longs of CHAR_BITS a character: its last three in lo.
LENGTH, CHAR_BITS, CHARS = 5, 21, 0x110000
#: n-grams that are broadcast beside the table; those of the same count as the last of them are left to the join.
HEAD = 1 << 20
#: A task packs n-grams by numbers of the characters that it has met, up to so many bits each, and hands on its counts
#: when it holds so many n-grams.
ID_BITS, MOST_HELD = 12, 4_000_000
#: Order and bits of the numpy model over classes.
ORDER, CLASS_BITS = 4, 6
#: A band reaches so many median deviations from the median of the log perplexity (both for texts of that length, as the
#: deviation falls with the root of the length), and at least LEAST_REACH, as long texts differ by more than that.
REACH, LEAST_REACH = 6.0, 0.08
WORDS = regex.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = str.maketrans("", "", "#*$%&|<>")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 0 blanks and controls, 1 digits, 2-27 a-z, 28-39 other ASCII signs, 40-63 the rest."""
    codes = np.arange(0x110000)
    found = 40 + (codes * 2654435761 >> 7) % 24
    found[:128] = 28 + codes[:128] % 12
    found[:33] = 0
    found[48:58] = 1
    found[97:123] = np.arange(2, 28)
    found[65:91] = np.arange(2, 28)
    return found.astype(np.int32)


def grams_of(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed ORDER-grams of all texts in order, none across texts, and how many each text has."""
    codes = np.frombuffer("".join(batch).encode("utf-32-le", "replace"), "<u4")
    c = _classes()[codes]
    lengths = np.array([len(t) for t in batch], np.int64)
    packed = np.zeros(max(0, len(c) - ORDER + 1), np.int32)
    for k in range(ORDER):
        packed = (packed << CLASS_BITS) | c[k : len(c) - ORDER + 1 + k]
    counts = np.maximum(lengths - ORDER + 1, 0)
    starts = np.cumsum(lengths) - lengths
    keep = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return packed[keep], counts


def _inside(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of `size` characters lie that cross no border of texts, and how many each text has."""
    counts = np.maximum(lengths - size + 1, 0)
    starts = np.cumsum(lengths) - lengths
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum()), counts


def _join(chars: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """hi, lo of n-grams from the columns of their characters."""
    hi, lo = (np.zeros(len(chars[0]), np.int64) for _ in range(2))
    for c in chars[:-3]:
        hi = (hi << CHAR_BITS) | c
    for c in chars[-3:]:
        lo = (lo << CHAR_BITS) | c
    return hi, lo


def _points(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(batch).encode("utf-32-le", "replace"), "<u4").astype(np.int64), np.array([len(t) for t in batch], np.int64)


def windows_of(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hi, lo of the LENGTH-grams of all texts in order, none across texts, and how many each text has."""
    codes, lengths = _points(batch)
    at, counts = _inside(lengths, LENGTH)
    hi, lo = _join([codes[k : max(0, len(codes) - LENGTH + 1) + k] for k in range(LENGTH)])
    return hi[at], lo[at], counts


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


class Tally:
    """Counts of n-grams, under numbers of the characters met so far."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number, self.chars = np.full(CHARS, -1, np.int64), np.zeros(0, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, batch: list[str]) -> bool:
        """Count the batch; False, and nothing done, where its characters are too many beside those before."""
        codes, lengths = _points(batch)
        seen = np.zeros(CHARS, bool)
        seen[codes] = True
        new = np.flatnonzero(seen & (self.number < 0))
        if len(self.chars) + len(new) > 1 << ID_BITS:
            return False
        self.number[new] = len(self.chars) + np.arange(len(new))
        self.chars = np.concatenate([self.chars, new])
        ids = self.number[codes]
        packed = np.zeros(max(0, len(ids) - LENGTH + 1), np.int64)
        for k in range(LENGTH):
            packed = (packed << ID_BITS) | ids[k : len(packed) + k]
        self.held.append(np.unique(packed[_inside(lengths, LENGTH)[0]], return_counts=True))
        if sum(len(k) for k, _ in self.held) > MOST_HELD:
            self.held = [self.sums()]
        return True

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        return _summed(*(np.concatenate(x) for x in zip(*self.held))) if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def full(self) -> bool:
        return bool(self.held) and len(self.held[0][0]) > MOST_HELD // 2

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """hi, lo, n of what was counted, which is forgotten."""
        keys, n = self.sums()
        columns = [self.chars[(keys >> ID_BITS * (LENGTH - 1 - k)) & ((1 << ID_BITS) - 1)] for k in range(LENGTH)] if len(keys) else [keys] * LENGTH
        self.clear()
        return *_join(columns), n


def count_grams(docs: DataFrame) -> DataFrame:
    """docs(text) -> hi, lo, n over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def out(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(n), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000].astype(np.int64)) for x in (hi, lo, n)], ["hi", "lo", "n"])

        for batch in batches:
            found = [x or "" for x in batch.column(0).to_pylist()]
            for a, b in slices(found):
                if not tally.add(found[a:b]):
                    yield from out(*tally.counts())
                    if not tally.add(found[a:b]):  # too many different characters in this slice alone
                        hi, lo, _ = windows_of(found[a:b])
                        yield from out(hi, lo, np.ones(len(hi), np.int64))
                if tally.full():
                    yield from out(*tally.counts())
        yield from out(*tally.counts())

    small_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(count, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """One order: sorted grams with their discounted share, and sorted contexts with the mass left for lower orders."""

    grams: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), default)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], default)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of one, two, and more, from the counts of counts."""
    n1, n2, n3, n4 = (max(1, n or 0) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [1, 0.95, 1.9, 2.85])


def _level(grams: np.ndarray, counts: np.ndarray, bits: int) -> Level:
    discount = _discounts(*(int((counts == k).sum()) for k in (1, 2, 3, 4)))
    own = discount[np.minimum(counts, 3).astype(int)]
    contexts, at = np.unique(grams >> bits, return_inverse=True)
    total = np.bincount(at, counts)
    return Level(grams, (counts - own) / total[at], contexts, np.bincount(at, own) / total)


class KneserNey:
    """Interpolated modified Kneser-Ney over packed grams in numpy, for counts that fit one process: what fit() does on
    Spark, and what tests compare it with. Levels from the longest to the single class; `base` is the chance of a class
    of which nothing is known."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER, bits: int = CLASS_BITS, base: float = 2.0**-CLASS_BITS):
        self.levels, self.bits, self.base = [], bits, base
        for k in range(order, 0, -1):
            self.levels.append(_level(grams, counts, bits))
            if k > 1:  # a shorter gram counts as often as there are classes before it
                grams, counts = np.unique(grams & ((1 << bits * (k - 1)) - 1), return_counts=True)

    def log_prob(self, asked: np.ndarray) -> np.ndarray:
        prob = np.full(len(asked), self.base)
        for k, level in zip(range(1, len(self.levels) + 1), reversed(self.levels)):
            gram = asked & ((1 << self.bits * k) - 1)
            prob = _look_up(level.grams, level.share, gram, 0.0) + _look_up(level.contexts, level.left, gram >> self.bits, 1.0) * prob
        return np.log(prob)


def _mask(chars: int) -> int:
    return (1 << CHAR_BITS * chars) - 1


def fit(docs: DataFrame) -> DataFrame:
    """hi, lo, n, log_prob of every LENGTH-gram of the texts."""
    levels = [stage(count_grams(docs), "quality-grams")[0]]
    for k in range(LENGTH - 1, 0, -1):  # a shorter gram counts as often as there are characters before it
        shorter = levels[-1].select(F.col("hi").bitwiseAND(_mask(max(0, k - 3))).alias("hi"), F.col("lo").bitwiseAND(_mask(min(3, k))).alias("lo"))
        levels.append(stage(shorter.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")), "quality-grams")[0])
    prob = None
    for k, level in zip(range(1, LENGTH + 1), reversed(levels)):
        seen = level.agg(*(F.count(F.when(F.col("n") == c, 1)).alias(f"n{c}") for c in (1, 2, 3, 4))).first()
        d = _discounts(*seen)
        own = F.when(F.col("n") == 1, float(d[1])).when(F.col("n") == 2, float(d[2])).otherwise(float(d[3]))
        level = level.withColumn("own", own)
        if k == 1:
            sums = level.agg(F.sum("n").alias("total"), F.sum("own").alias("mass"))
            prob = level.crossJoin(sums).select("hi", "lo", "n", ((F.col("n") - F.col("own") + F.col("mass") / CHARS) / F.col("total")).alias("prob"))
            continue
        before = {"_phi": F.shiftright("hi", CHAR_BITS), "_plo": F.shiftleft(F.col("hi").bitwiseAND(_mask(1)), 2 * CHAR_BITS).bitwiseOR(F.shiftright("lo", CHAR_BITS))}
        after = {"_shi": F.col("hi").bitwiseAND(_mask(max(0, k - 4))), "_slo": F.col("lo").bitwiseAND(_mask(min(3, k - 1)))}
        level = level.withColumns(before | after)
        context = level.groupBy("_phi", "_plo").agg(F.sum("n").alias("total"), F.sum("own").alias("mass"))
        lower = prob.select(F.col("hi").alias("_shi"), F.col("lo").alias("_slo"), F.col("prob").alias("_lower"))
        joined = level.join(context, ["_phi", "_plo"]).join(lower, ["_shi", "_slo"])
        prob = joined.select("hi", "lo", "n", ((F.col("n") - F.col("own") + F.col("mass") * F.col("_lower")) / F.col("total")).alias("prob"))
    return stage(prob.select("hi", "lo", "n", F.log("prob").alias("log_prob")), "quality-model")[0]


def _mixed(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    h = hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ lo.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0x94D049BB133111EB)


class Head:
    """n-grams in order of their hashes, with where each hash prefix starts."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, log_prob: np.ndarray):
        h = _mixed(hi, lo)
        order = np.argsort(h)
        self.hi, self.lo, self.log_prob = hi[order], lo[order], log_prob[order]
        self.shift = np.uint64(64 - len(h).bit_length() - 2)
        slots = 1 << (64 - int(self.shift))
        self.starts = np.searchsorted(h[order] >> self.shift, np.arange(slots + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Places of n-grams; -1 where unknown."""
        found = np.full(len(hi), -1, np.int64)
        slot = (_mixed(hi, lo) >> self.shift).astype(np.int64)
        left, at, end = np.arange(len(hi)), self.starts[slot], self.starts[slot + 1]
        while len(left):
            go = at < end
            left, at, end = left[go], at[go], end[go]
            same = (self.lo[at] == lo[left]) & (self.hi[at] == hi[left])
            found[left[same]] = at[same]
            left, at, end = left[~same], at[~same] + 1, end[~same]
        return found


def head_of(model: DataFrame, most: int) -> tuple[Head, bool]:
    """The most frequent n-grams, at most `most`, down to a count that is a power of two; and whether these are all."""
    sizes = {r["e"]: r["count"] for r in model.groupBy(F.floor(F.log2("n") + 1e-9).cast("int").alias("e")).count().collect()}
    taken, least = 0, 64
    for e in sorted(sizes, reverse=True):
        if taken + sizes[e] > most:
            break
        taken, least = taken + sizes[e], e
    found = model.where(F.floor(F.log2("n") + 1e-9) >= least).select("hi", "lo", "log_prob").toArrow()
    return Head(*(found[c].to_numpy() for c in ("hi", "lo", "log_prob"))), taken == sum(sizes.values())


def measures(text: str, window: int = 8) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    repeats = 0
    if len(words) > window:
        number: dict[str, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
        mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = np.zeros(len(words) - window + 1, np.uint64)
        for k in range(window):
            h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : len(h) + k]
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        if same.any():
            maybe = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
            seen = Counter(tuple(words[i : i + window]) for i in maybe)
            covered = np.zeros(len(words) + 1, np.int64)
            for i in maybe:
                if seen[tuple(words[i : i + window])] > 1:
                    covered[i] += 1
                    covered[min(i + window, len(words))] -= 1
            repeats = int((np.cumsum(covered) > 0).sum())
    return len(words), sum(map(len, words)), len(text) - len(text.translate(SYMBOLS)), len(lines) - len(set(lines)), repeats


def score(docs: DataFrame, model: DataFrame, head: int = HEAD) -> DataFrame:
    """docs without `text`, with the plain measures, n_grams, and log_ppl (null where a text is too short for it)."""
    frequent, whole = head_of(model, head)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def make(batch: list[str]) -> list:
        hi, lo, counts = windows_of(batch)
        at = shared.value.find(hi, lo)
        ends = np.cumsum(counts)
        value = np.zeros(len(at))
        value[at >= 0] = shared.value.log_prob[at[at >= 0]]
        rare = np.flatnonzero(at < 0)
        borders = np.searchsorted(rare, ends)[:-1]
        return [*zip(*map(measures, batch)), counts, segment_sums(value, ends - counts, ends), *(np.split(x[rare], borders) for x in (hi, lo))]

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    made = map_texts(docs, make, dict.fromkeys([*names, "n_grams"], "long") | {"_sum": "double", "_hi": "array<long>", "_lo": "array<long>"})
    done, _ = stage(made.withColumn("_row", F.monotonically_increasing_id()), "quality")
    total = F.col("_sum")
    if not whole:
        rare = done.select("_row", F.explode(F.arrays_zip("_hi", "_lo")).alias("_g")).groupBy("_row", F.col("_g._hi").alias("hi"), F.col("_g._lo").alias("lo")).count()
        more = rare.join(model.drop("n"), ["hi", "lo"]).groupBy("_row").agg(F.sum(F.col("count") * F.col("log_prob")).alias("_rare"))
        done, total = done.join(more, "_row", "left"), total + F.coalesce("_rare", F.lit(0.0))
    done = done.withColumn("log_ppl", F.when(F.col("n_grams") > 0, -total / F.col("n_grams"))).drop("_sum", "_hi", "_lo", "_row", "_rare")
    return done if whole else stage(done, "quality-scored")[0]


def _medians(rows: DataFrame, keys: list[str], value: Column, step: float, name: str) -> DataFrame:
    """keys and the lower median of a value, exact to its step: values are counted by steps, so that no group is gathered and the
    result does not depend on how rows are dealt out."""
    counted = rows.where(value.isNotNull()).groupBy(*keys, F.round(value / step).cast("long").alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    of = W.partitionBy(*keys)
    placed = counted.withColumns({"_up_to": F.sum("_n").over(of.orderBy("_bin")), "_all": F.sum("_n").over(of)})
    return placed.where(2 * F.col("_up_to") >= F.col("_all")).groupBy(*keys).agg((F.min("_bin") * step).alias(name))


#: Steps of log perplexities, and of their distances from the middle times the root of the length.
STEP, AWAY_STEP = 1e-4, 1e-2


def bands(scored: DataFrame) -> DataFrame:
    """_lang, middle, below, above: of each language's texts that pass the plain rules, the median log perplexity and
    the median deviations on either side, times the root of the length."""
    passed = scored.where(~F.col("base_failed") & F.col("log_ppl").isNotNull()).select(F.col("lang").alias("_lang"), "log_ppl", "n_grams")
    # a row for each language: written, so that Spark knows its size and need not deal out all rows by language to join it
    middle, _ = stage(_medians(passed, ["_lang"], F.col("log_ppl"), STEP, "middle").withColumnRenamed("_lang", "_of"), "quality-middles")
    held = passed.join(middle, F.col("_lang").eqNullSafe(F.col("_of")))
    away = (F.col("log_ppl") - F.col("middle")) * F.sqrt("n_grams")
    sides = [_medians(held, ["_lang"], F.when(x > 0, x), AWAY_STEP, n).withColumnRenamed("_lang", f"_{n}") for x, n in ((-away, "below"), (away, "above"))]
    for side, n in zip(sides, ("below", "above")):
        middle = middle.join(side, F.col("_of").eqNullSafe(F.col(f"_{n}")), "left").drop(f"_{n}")
    return stage(middle.withColumnRenamed("_of", "_lang"), "quality-bands")[0]


def judge(docs: DataFrame) -> DataFrame:
    """docs(doc_id, lang, text) -> doc_id, lang, the measures, log_ppl, base_failed, kept."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = score(docs, fit(docs)).withColumn("base_failed", failed)
    reach = lambda side: F.greatest(F.lit(LEAST_REACH), REACH * F.coalesce(side, F.lit(0.0)) / F.sqrt("n_grams"))
    banded = scored.join(bands(scored), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    inside = F.col("log_ppl").between(F.col("middle") - reach(F.col("below")), F.col("middle") + reach(F.col("above")))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return banded.withColumn("kept", kept).drop("_lang", "middle", "below", "above", "n_grams")
