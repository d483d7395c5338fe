"""Near-duplicates by the Jaccard similarity of word shingles: prefixes of single tokens and of token combinations.

A token is a shingle's 64-bit hash. Tokens are ordered by how many sets have them, rare ones first. Two sets that link lack at most
`spare` tokens of each other, so some class of tokens, of which k must be shared to count, shares k in both prefixes if the prefixes
are long enough: classes are made by frequency and hash, and a prefix goes on until its tokens exceed the spare ones after k - 1 are
written off in each class. Rare tokens are indexed one by one (k = 1), frequent ones in pairs and very frequent ones in triples within
their class, so that a passage of many documents alone doesn't make candidates. How many classes there are depends on the size of the
smaller set, so a set is indexed for the sizes that its partners can have, two at most.

Before that, sets are left out that cannot link: of the tokens of smallest hash (a quarter), enough must occur in another set. Equal
sets are one. Candidates are compared exactly: first each set of an index entry with one of them, then those that are not yet connected,
by pairs in small entries and block by block in large ones, where a block yields a spanning forest of its links.

Defined results: documents are linked by whole texts; a text without words (null, empty, blank) has an empty set, links with nothing
and is its own component; equal sets link; a row with a null doc_id never names a component unless it has no other; repeated rows stay;
an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, stage
from gridclim.llm.components import components

#: Percent of a set's tokens that the first look takes beyond the spare ones.
HEAD = 10
#: In how many sets a token must be to be indexed in pairs, and in triples.
FREQUENT = (16, 1024)
#: Sets of fewer tokens than this are indexed by single tokens only.
SMALL = 32
#: An index entry of more sets than this is compared block by block; a block holds about so many tokens.
PAIRED = 64
BLOCK_TOKENS = 100_000
#: Ids of at most so many sets (16 bytes each) are broadcast to find their texts.
BROADCAST = 1_000_000
#: Tokens that a comparison of blocks spreads out at once.
WIDTH = 8192

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    """The hash of each word, made once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * _M2
    return a ^ (a >> np.uint64(29))


def tokens(text: str, shingle: int, known: dict | None = None) -> np.ndarray:
    """The sorted distinct tokens of a text."""
    words = text.encode().lower().split()
    known = _Hashes() if known is None else known
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    size = min(shingle, len(h))
    made = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        made = _mix(made * _M1 + h[i : len(h) - size + 1 + i])
    return np.unique(made)


def spare(n: int, percent: int) -> int:
    """How many of n tokens a partner may lack."""
    return n - (percent * n + 99) // 100


def _sets(docs: DataFrame, percent: int, shingle: int, whole: bool) -> DataFrame:
    """docs without text, with n_shingles, set_id (null for an empty set) and tokens: all of them, or those of the first look."""

    def make(batch: list[str]) -> list:
        known, found = _Hashes(), []
        for text in batch:
            t = tokens(text, shingle, known)
            n = len(t)
            most = n if whole else min(n, spare(n, percent) + n * HEAD // 100 + 1)
            found.append((n, int(np.uint64(xxhash.xxh3_64_intdigest(t.tobytes())).astype(np.int64)) if n else None, t[:most].view(np.int64)))
        return [list(c) for c in zip(*found)]

    return map_texts(docs, make, {"n_shingles": "long", "set_id": "long", "tokens": "array<long>"})


def _size_class(n: int) -> int:
    return n.bit_length() - 1


def signatures(ordered: list[int], df: list[int], n: int, percent: int) -> list[int]:
    """Index entries of a set of n tokens, of which `ordered` are in other sets too, rarest first, in df sets each."""
    found = []
    left_out = spare(n, percent)
    for size in {_size_class(n), _size_class((percent * n + 99) // 100)}:
        classes = max(1, spare(1 << size, percent) // 4)
        held: dict[tuple[int, int], list[int]] = {}
        gained = n - len(ordered)  # tokens of no other set come first
        for token, sets in zip(ordered, df):
            if gained > left_out:
                break
            k = 1 if 1 << size < SMALL else 1 + sum(sets >= f for f in FREQUENT)
            own = held.setdefault((k, 0 if k == 1 else token % classes), [])
            own.append(token)
            gained += len(own) >= k
        for (k, c), own in held.items():
            at = np.array(list(combinations(own, k)), np.int64).view(np.uint64).reshape(-1, k)
            made = np.full(len(at), (size << 32) + (k << 24) + c, np.uint64)
            for i in range(k):
                made = _mix(made * _M1 + at[:, i])
            found.append(made)
    return np.unique(np.concatenate(found)).view(np.int64).tolist() if found else []


def _alive(rows: DataFrame, percent: int) -> DataFrame:
    """Sets with enough tokens of the first look in other sets: set_id, n_shingles, and the row that stands for it."""
    held = rows.where("set_id is not null")
    seen = held.select("set_id", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("set_id").alias("set_id"), F.max("set_id").alias("_last"))
    single = seen.where(F.col("set_id") == F.col("_last")).groupBy("set_id").agg(F.count(F.lit(1)).alias("_single"))
    row = F.min(F.struct("doc_id", "_key")).alias("_row")
    sets = held.groupBy("set_id").agg(F.max("n_shingles").alias("n_shingles"), F.max(F.size("tokens")).alias("_looked"), row)
    least = F.floor(F.floor((percent * F.col("n_shingles") + 99) / 100) * HEAD / 100) + 1
    return sets.join(single, "set_id", "left").where(F.col("_looked") - F.coalesce("_single", F.lit(0)) >= least).select("set_id", "_row.doc_id", "_row._key")


def _indexed(docs: DataFrame, alive: DataFrame, percent: int, shingle: int) -> DataFrame:
    """set_id, n, tokens (those in other sets too, sorted, as bytes) and sigs of the sets that are alive."""
    of, _ = stage(alive.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_hash")), "jaccard-alive")
    if of.count() <= BROADCAST:  # else the texts are shuffled
        of = F.broadcast(of)
    chosen = docs.join(of, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash")), "left_semi").select("text")
    whole, _ = stage(_sets(chosen, percent, shingle, True).dropDuplicates(["set_id"]), "jaccard-sets")
    each = whole.select("set_id", F.col("n_shingles").alias("n"), F.explode("tokens").alias("token"))
    held = each.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("token"))).where("df > 1")
    shared = held.groupBy("set_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, sigs = [], []
            for n, row in zip(batch["n"].to_pylist(), batch["shared"]):
                token, df = row.values.field("token").to_numpy(), row.values.field("df").to_numpy()
                sigs.append(signatures(token.tolist(), df.tolist(), n, percent))
                held.append(np.sort(token).tobytes())
            yield pa.RecordBatch.from_arrays([batch["set_id"], batch["n"], pa.array(held, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))], ["set_id", "n", "tokens", "sigs"])

    return stage(shared.select("set_id", "n", "shared").mapInArrow(index, "set_id long, n long, tokens binary, sigs array<long>"), "jaccard-index")[0]


def _fit(a: str, b: str, percent: int) -> Column:
    """Whether sets can link that have n tokens each, `held` of which are in other sets: they share the lesser `held` at most."""
    return (100 + percent) * F.least(f"{a}.held", f"{b}.held") >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) that link."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True)) for x, y in zip(batch["t_a"], batch["t_b"])]
            total = batch["n_a"].to_numpy() + batch["n_b"].to_numpy()
            near = pa.array((100 + percent) * np.array(same, np.int64) >= percent * total)
            yield batch.select(["a", "b"]).filter(near)

    return both.mapInArrow(check, "a long, b long")


def _overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each left and each right set share."""
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    both = np.intersect1d(sides[0][0], sides[1][0])
    found = np.zeros((len(left), len(right)), np.float32)
    placed = []
    for token, row in sides:
        at = np.searchsorted(both, token)
        known = at < len(both)
        known[known] = both[at[known]] == token[known]
        order = np.argsort(at[known], kind="stable")
        placed.append((at[known][order], row[known][order]))
    for a in range(0, len(both), WIDTH):
        spread = []
        for (at, row), s in zip(placed, (left, right)):
            i, j = np.searchsorted(at, [a, a + WIDTH])
            m = np.zeros((len(s), min(WIDTH, len(both) - a)), np.float32)
            m[row[i:j], at[i:j] - a] = 1
            spread.append(m)
        found += spread[0] @ spread[1].T
    return found


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all the links of a comparison connect."""
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    label = np.arange(len(ids))
    a, b = [], []
    for i in np.flatnonzero(near.any(axis=1)):
        cols = at[len(left) + np.flatnonzero(near[i])]
        labels, first = np.unique(label[cols], return_index=True)
        new = labels != label[at[i]]
        a += [left[i]] * int(new.sum())
        b += ids[cols[first[new]]].tolist()
        label[np.isin(label, labels[new])] = label[at[i]]
    return np.array(a, np.int64), np.array(b, np.int64)


def _merged(members: DataFrame) -> DataFrame:
    """members(sig, set_id, comp, n) with entries that have the same smallest member made one, where comparing all sets of those at
    once is no more work than comparing each entry by itself: near copies share many entries of nearly the same sets. A set and a
    group meet once however many entries they share: joins see those rows, and the members of entries that stay apart."""
    grouped, _ = stage(members.withColumn("group", F.min("set_id").over(W.partitionBy("sig"))), "jaccard-grouped")
    square = F.pow(F.sum("n").cast("double"), 2)
    alone = grouped.groupBy("group", "sig").agg(square.alias("_alone")).groupBy("group").agg(F.sum("_alone").alias("_alone"))
    once, _ = stage(grouped.select("group", "set_id", "comp", "n").distinct(), "jaccard-once")
    together = once.groupBy("group").agg(square.alias("_together"))
    apart, _ = stage(alone.join(together, "group").where("_together > _alone").select("group"), "jaccard-apart")
    if apart.count() <= BROADCAST:  # else rows are shuffled by group
        apart = F.broadcast(apart)
    one = once.join(apart, "group", "left_anti").withColumn("sig", F.xxhash64(F.lit(True), "group"))
    rest = grouped.join(apart, "group", "left_semi").withColumn("sig", F.xxhash64(F.lit(False), "sig"))
    return one.unionByName(rest).select("sig", "set_id", "comp", "n")


def _blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """members(sig, set_id, comp, n) of large entries -> links between sets of different components, by pairs of blocks."""
    merged, _ = stage(_merged(members), "jaccard-merged")
    count = merged.groupBy("sig").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    placed = merged.join(count, "sig").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")).join(sets.select("set_id", "tokens"), "set_id")
    held, _ = stage(placed.groupBy("sig", "block").agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct("set_id", "comp", "n", "tokens")).alias("sets")), "jaccard-blocks")
    pairs = held.select("sig", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    side = lambda x, name: held.select("sig", F.col("block").alias(x), F.col("sets").alias(name))
    both = pairs.join(side("i", "left"), ["sig", "i"]).join(side("j", "right"), ["sig", "j"]).select("left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in zip(batch["left"], batch["right"]):
                (a, comp_a, n_a, t_a), (b, comp_b, n_b, t_b) = (
                    (*(x.values.field(c).to_numpy() for c in ("set_id", "comp", "n")), [np.frombuffer(t.as_buffer(), np.int64) for t in x.values.field("tokens")]) for x in pair)
                near = (100 + percent) * _overlap(t_a, t_b).astype(np.int64) >= percent * (n_a[:, None] + n_b[None, :])
                x, y = _forest(near & (comp_a[:, None] != comp_b[None, :]), a, b)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links of set ids that connect what all links connect. Members of entries outnumber the sets by far, so they learn by windows
    what their entry holds; joins are by sets and pairs of sets."""
    entry = W.partitionBy("sig")
    one = sets.select(F.struct("set_id", "n", (F.length("tokens") / 8).cast("long").alias("held")).alias("x"), "sigs")
    first = F.min("x").over(entry).alias("first")
    seen = one.select("x", F.explode("sigs").alias("sig")).select("x", first).where((F.col("x.set_id") != F.col("first.set_id")) & _fit("x", "first", percent))
    stars = seen.select(F.col("first.set_id").alias("a"), F.col("x.set_id").alias("b")).distinct()
    linked, _ = stage(_verified(stars, sets, percent), "jaccard-stars")
    labelled = one.join(components(linked), F.col("x.set_id") == F.col("node"), "left").select("x", F.coalesce("root", "x.set_id").alias("comp"), F.explode("sigs").alias("sig"))
    who = [F.bit_xor(F.xxhash64("x.set_id", F.lit(i))).over(entry).alias(f"who_{i}") for i in (0, 1)]
    held = labelled.select("x", "comp", first, F.count(F.lit(1)).over(entry).alias("m"), F.min("comp").over(entry).alias("lo"), F.max("comp").over(entry).alias("hi"), *who)
    same = F.xxhash64("m", "first", "who_0", "who_1").alias("sig")  # entries with the same sets are one
    rest, _ = stage(held.where("lo < hi").select(same, "m", F.col("x.set_id").alias("set_id"), "x", "comp", "first").dropDuplicates(["sig", "set_id"]), "jaccard-rest")
    few = rest.where((F.col("m") <= PAIRED) & (F.col("set_id") != F.col("first.set_id"))).select("sig", "x", "comp")  # the first has been compared with all
    pairs = few.join(few.toDF("sig", "y", "comp_y"), "sig").where(F.col("x.set_id") < F.col("y.set_id")).where((F.col("comp") != F.col("comp_y")) & _fit("x", "y", percent))
    found = _verified(pairs.select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b")).distinct(), sets, percent)
    return linked.unionByName(found).unionByName(_blocks(rest.where(F.col("m") > PAIRED).select("sig", "set_id", "comp", F.col("x.n").alias("n")), sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """docs without `text`, with `n_shingles` (distinct shingles) and `component_id`: the smallest doc_id reachable by links of documents
    whose shared shingles are at least `percent` (50 to 100) of all that the two have."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    made = {"_key", "set_id", "tokens"}
    docs = docs.drop("n_shingles", "component_id")
    names = {c: f"_kept_{c}" for c in docs.columns if c in made}
    docs = docs.withColumnsRenamed(names).withColumn("_key", F.xxhash64("text"))
    rows, _ = stage(_sets(docs, percent, shingle, False), "jaccard-looked")
    sets = _indexed(docs.select("doc_id", "_key", "text"), _alive(rows, percent), percent, shingle)
    roots = components(_links(sets, percent)).withColumnRenamed("node", "set_id")
    first = rows.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("_first"))
    rooted = first.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    of_set, _ = stage(rooted.join(rooted.groupBy("root").agg(F.min("_first").alias("component_id")), "root").select("set_id", "component_id"), "jaccard-components")
    found = rows.drop("_key", "tokens").join(of_set, "set_id", "left").withColumn("component_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return found.drop("set_id").withColumnsRenamed({v: k for k, v in names.items()})
