"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Learning takes a bounded sample of labelled rows (PER_CLASS of each label, by hash of the id). Every word of every example is a
term, weighed by TF-IDF with the number of all documents that have it, counted on Spark, and by its relevance frequency among
the examples; no term of an example is left out, and words that no example has are in no vector. Examples stand in blocks, alike ones side by side. Postings of rare terms are short and are added up for all examples;
those of frequent terms are kept by block with the largest weight of each, which bounds what a block can add: blocks whose bound
stays below the K-th best cosine are skipped, and the K nearest are still exact. Texts are split into words once, and scored a batch at a time. The votes of
the nearest, weighted by nearness, are calibrated by a logistic curve fitted on the sample with each example left out.

Defined results: texts that are null, empty or share no term with any example get the calibrated score of no votes;
without labelled rows, or with one label only, every score is the share of that label (0 without rows); a document
labelled twice counts as toxic if either label says so; labelled rows that share a doc_id are examples each; repeated rows stay;
ties, cosines that agree to nine decimals, go to the example first in the index; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, small_batches, stage

PER_CLASS = 2_000
BLOCK, K, SEED_BLOCKS = 64, 10, 4
#: A term that so large a share of the examples has is frequent: its weights are kept by block.
FREQUENT = 1 / 16
#: Texts that are scored at once; a batch holds a number for each of them and each example.
BATCH = 48
WORDS = re.compile(r"\w+")
#: A vote of no example weighs so much against the votes of the nearest.
DOUBT = 1.0


def terms_of(text: str) -> list[str]:
    """The words of a text."""
    return WORDS.findall(text.lower())


def count_terms(batch: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which text, which term of the vocabulary, and how often, of all texts in order."""
    words = [terms_of(t) for t in batch]
    of = np.repeat(np.arange(len(batch)), [len(w) for w in words])
    term = np.fromiter(map(vocabulary.get, chain.from_iterable(words), repeat(-1)), np.int64, len(of))
    size = max(1, len(vocabulary))
    keys, counts = np.unique((of * size + term)[term >= 0], return_counts=True)
    return keys // size, keys % size, counts


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class ToxicIndex:
    """Examples in blocks: postings of rare terms, and of frequent terms the weights by block with each block's largest."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weight_of: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: float = 0.0
    curve: tuple[float, float] | None = None

    def vectors(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which text, which term, and the weight, of all texts in order; a text's weights have length one."""
        return self.weighed(len(batch), *count_terms(batch, self.vocabulary))

    def weighed(self, n: int, of: np.ndarray, term: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        weight = (1 + np.log(counts)) * self.weight_of[term]
        length = np.sqrt(np.bincount(of, weight * weight, n))
        return of, term, weight / length[of]

    def weigh_terms(self, documents: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> None:
        """Weights of the terms: inverse document frequency (documents: how many have a term, and last how many there are) times
        relevance frequency, which rises where more toxic examples than clean ones have the term. No term has weight zero."""
        idf = np.log((documents[-1] + 1) / (documents[:-1] + 1)) + 1
        self.weight_of = idf * np.log2(2 + toxic / np.maximum(1, clean))

    def build(self, n: int, example: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        """From the vectors of n examples, as vectors() gives them."""
        size = len(self.weight_of)
        order = np.lexsort((example, term))
        example, weight, term = example[order], weight[order], term[order]
        count = np.bincount(term, minlength=size)
        frequent = np.flatnonzero(count > n * FREQUENT)
        self.row = np.full(size, -1, np.int64)  # of a frequent term, in the tables below
        self.row[frequent] = np.arange(len(frequent))
        held = self.row[term] >= 0
        self.blocks = -(-n // BLOCK)
        self.dense = np.zeros((len(frequent), self.blocks * BLOCK))
        self.dense[self.row[term[held]], example[held]] = weight[held]
        self.block_max = self.dense.reshape(len(frequent), self.blocks, BLOCK).max(axis=2)
        self.example, self.weight = example[~held], weight[~held]
        self.start = np.searchsorted(term[~held], np.arange(size + 1))
        self.size = n

    def nearest(self, n: int, of: np.ndarray, term: np.ndarray, weight: np.ndarray, leave: np.ndarray | None = None, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of n vectors, given as vectors() gives them, the k examples with the largest positive cosine, exactly, and the
        cosines; leave: an example that each vector doesn't meet."""
        width = self.blocks * BLOCK
        row = self.row[term]
        rare = row < 0
        length = (self.start[term + 1] - self.start[term])[rare]
        postings = _ragged(self.start[term[rare]], length)
        added = np.bincount(np.repeat(of[rare] * width, length) + self.example[postings], np.repeat(weight[rare], length) * self.weight[postings], n * width)
        cosine = added.reshape(n, width)
        queries = np.zeros((n, len(self.block_max)))
        queries[of[~rare], row[~rare]] = weight[~rare]
        bound = cosine.reshape(n, self.blocks, BLOCK).max(axis=2) + queries @ self.block_max
        seeds = np.argsort(-bound, axis=1, kind="stable")[:, :SEED_BLOCKS]
        best = np.zeros((n, seeds.shape[1], BLOCK))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def look(b: int, rows: np.ndarray) -> np.ndarray:
            columns = slice(b * BLOCK, (b + 1) * BLOCK)
            exact = np.round(cosine[rows, columns] + queries[rows] @ self.dense[:, columns], 9)
            if leave is not None:
                own = np.flatnonzero(leave[rows] // BLOCK == b)
                exact[own, leave[rows[own]] % BLOCK] = 0
            return exact

        def keep(b: int, rows: np.ndarray, exact: np.ndarray) -> None:
            i, j = np.nonzero(exact >= np.maximum(least[rows], 1e-9)[:, None])
            found.append((rows[i], b * BLOCK + j, exact[i, j]))

        for b in np.unique(seeds):
            rows, place = np.nonzero(seeds == b)
            best[rows, place] = look(b, rows)
        flat = best.reshape(n, -1)
        kth = min(k, flat.shape[1])
        least = np.partition(flat, flat.shape[1] - kth, axis=1)[:, flat.shape[1] - kth]  # the k-th best so far
        for place in range(seeds.shape[1]):
            for b in np.unique(seeds[:, place]):
                rows = np.flatnonzero(seeds[:, place] == b)
                keep(b, rows, best[rows, place])
        todo = (bound + 1e-8 >= np.maximum(least, 1e-9)[:, None])
        np.put_along_axis(todo, seeds, False, axis=1)
        for b in np.flatnonzero(todo.any(axis=0)):
            rows = np.flatnonzero(todo[:, b])
            keep(b, rows, look(b, rows))
        of, example, exact = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((example, -exact, of))
        of, example, exact = of[order], example[order], np.minimum(exact[order], 1.0)
        starts = np.searchsorted(of, np.arange(n + 1))
        return [(example[a : min(a + k, e)], exact[a : min(a + k, e)]) for a, e in zip(starts[:-1].tolist(), starts[1:].tolist())]

    def vote(self, ids: np.ndarray, cosine: np.ndarray) -> float:
        """Votes of the nearest for toxic, weighted by nearness, between 0 and 1."""
        nearness = 1 / (1.05 - cosine)
        return float((nearness * self.labels[ids]).sum() / (nearness.sum() + DOUBT))

    def scores(self, n: int, of: np.ndarray, term: np.ndarray, counts: np.ndarray) -> tuple[list[float], list[str]]:
        """Of n texts, given as count_terms() gives them, the calibrated scores, and the nearest three examples as id:label:cosine."""
        if self.curve is None:
            return [self.share] * n, [""] * n
        a, b = self.curve
        scores, evidence = [], []
        ends = np.searchsorted(of, np.arange(0, n + BATCH, BATCH))
        for start, left, right in zip(range(0, n, BATCH), ends, ends[1:]):
            size, part = min(BATCH, n - start), slice(left, right)
            for ids, cosine in self.nearest(size, *self.weighed(size, of[part] - start, term[part], counts[part])):
                scores.append(1 / (1 + math.exp(-(a * self.vote(ids, cosine) + b))))
                evidence.append(";".join(f"{self.ids[i]}:{int(self.labels[i])}:{c:.4f}" for i, c in zip(ids[:3].tolist(), cosine.tolist())))
        return scores, evidence


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, slightly damped."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (w * (y - p)) - 0.05 * beta
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(beta[0]), float(beta[1])


def _unpack(terms: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What count_terms() gave, from the rows of code()."""
    of = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
    return of, np.frombuffer(b"".join(terms), "<i4").astype(np.int64), np.frombuffer(b"".join(counts), "<i4").astype(np.int64)


def code(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """docs without `text`, with `_terms` and `_counts`: numbers of the text's terms in order and how often each occurs, as
    little-endian 32-bit integers. A text is split into words here and nowhere else."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make(batch: list[str]) -> list:
        of, term, counts = count_terms(batch, shared.value)
        ends = np.searchsorted(of, np.arange(len(batch) + 1)).tolist()
        terms, counts = term.astype("<i4").tobytes(), counts.astype("<i4").tobytes()
        return [[x[4 * a : 4 * b] for a, b in zip(ends, ends[1:])] for x in (terms, counts)]

    return map_texts(docs, make, {"_terms": "binary", "_counts": "binary"})


def sample_labels(labels: DataFrame, per_class: int) -> tuple[list[tuple[int, int]], float]:
    """At most per_class ids of each label, by hash of the id, with their labels; and the share of toxic ones among all."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return [(r["doc_id"], r["toxic"]) for c in chosen for r in c.collect()], count.get(1, 0) / max(1, sum(count.values()))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[ToxicIndex, DataFrame]:
    """Learn from labels(doc_id, toxic) and the texts of docs(doc_id, text, ...), with at most 2 * per_class examples; and docs as
    code() makes it, written, as its texts have been split for the counts already."""
    spark = docs.sparkSession
    chosen, share = sample_labels(labels, per_class)
    index = ToxicIndex(share=share)
    # at most 2 * per_class ids and labels: bounded, so they may be broadcast
    rows = spark.createDataFrame(chosen, "_id long, _toxic int")
    # of texts that share an id the one of smallest hash is the example, so that examples are no more than ids
    docs = docs.withColumns({"_text_null": F.col("text").isNull(), "_text_hash": F.xxhash64("text")})
    sample = docs.where("not _text_null").select("doc_id", "text", "_text_hash").join(F.broadcast(rows), F.col("doc_id") == F.col("_id"))
    sample = sample.groupBy("doc_id", "_toxic").agg(F.min_by("text", "_text_hash").alias("text"))

    def listed(batch: list[str]) -> tuple:
        words = [sorted({*terms_of(t)}) for t in batch]
        return np.repeat(np.arange(len(batch)), [len(w) for w in words]), [list(chain.from_iterable(words))]

    own = map_texts(sample.select("_toxic", "text"), listed, {"term": "string"})
    own = own.groupBy("term").agg(F.sum("_toxic").alias("toxic"), F.sum(1 - F.col("_toxic")).alias("clean"))
    found = own.orderBy("term").toArrow()  # bounded by the examples, not by the documents
    index.vocabulary = {t: i for i, t in enumerate(found["term"].to_pylist())}
    size = len(index.vocabulary)
    coded, _ = stage(code(docs, index.vocabulary), "toxicity-terms")

    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each term, in how many of the task's documents it occurs; at -1 the number of these."""
        held, seen = np.zeros(size, np.int64), 0
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
            seen += batch.num_rows
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(held[at], seen))], ["term", "n"])

    counted = coded.where("not _text_null").select("_terms").mapInArrow(occur, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(size + 1)
    n[counted["term"].to_numpy()] = counted["n"].to_numpy()
    labelled = [y for _, y in chosen]
    if 0 not in labelled or 1 not in labelled:
        return index, coded.drop("_text_null", "_text_hash")
    index.weigh_terms(n, found["toxic"].to_numpy(), found["clean"].to_numpy())
    # a row per sampled document, with the terms of its text
    chosen_rows = coded.where("not _text_null").join(F.broadcast(rows), F.col("doc_id") == F.col("_id"))
    chosen_rows = chosen_rows.groupBy("doc_id", "_toxic").agg(F.min(F.struct("_text_hash", "_terms", "_counts")).alias("_row"))
    got = chosen_rows.select("doc_id", "_toxic", "_row._terms", "_row._counts").collect()
    if not got:
        return index, coded.drop("_text_null", "_text_hash")
    # alike examples stand in the same blocks: by label, then by their heaviest term
    got.sort(key=lambda r: (r["_toxic"], r["doc_id"], bytes(r["_terms"]), bytes(r["_counts"])))
    of, term, weight = index.weighed(len(got), *_unpack([bytes(r["_terms"]) for r in got], [bytes(r["_counts"]) for r in got]))
    heaviest = np.full(len(got), -1)
    order = np.argsort(weight, kind="stable")
    heaviest[of[order]] = term[order]
    place = np.lexsort((np.arange(len(got)), heaviest, [r["_toxic"] for r in got]))
    moved = np.argsort(place)[of]
    order = np.lexsort((term, moved))
    of, term, weight = moved[order], term[order], weight[order]
    index.ids, index.labels = np.array([got[i]["doc_id"] for i in place]), np.array([float(got[i]["_toxic"]) for i in place])
    index.build(len(got), of, term, weight)
    votes = []
    for start in range(0, len(got), BATCH):
        n_part = min(BATCH, len(got) - start)
        part = slice(*np.searchsorted(of, (start, start + n_part)))
        votes += [index.vote(*x) for x in index.nearest(n_part, of[part] - start, term[part], weight[part], np.arange(start, start + n_part))]
    n1 = sum(labelled)
    balance = np.where(index.labels == 1, index.share / max(1, n1), (1 - index.share) / max(1, len(labelled) - n1)) * len(got)
    index.curve = _logistic(np.array(votes), index.labels, balance)
    return index, coded.drop("_text_null", "_text_hash")


def score_coded(coded: DataFrame, index: ToxicIndex) -> DataFrame:
    """Rows of code() with score (0 to 1), predicted (1 if score >= 0.5) and evidence instead of the terms."""
    shared = coded.sparkSession.sparkContext.broadcast(index)
    added = {"score": "double", "predicted": "int", "evidence": "string"}
    kept = [f for f in coded.schema if f.name not in {"_terms", "_counts", *added}]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = shared.value.scores(batch.num_rows, *_unpack(batch.column("_terms").to_pylist(), batch.column("_counts").to_pylist()))
            new = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(evidence, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], [*(f.name for f in kept), *added])

    small_batches(coded.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} {t}" for n, t in added.items())])
    return coded.mapInArrow(apply, schema)


def predict(docs: DataFrame, index: ToxicIndex) -> DataFrame:
    """docs without `text`, with score, predicted and evidence. Only the text is looked at."""
    return score_coded(code(docs, index.vocabulary), index)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """predict() for the documents that the words are counted in, whose texts are split once for both."""
    index, coded = fit(docs, labels, per_class)
    return score_coded(coded, index)
