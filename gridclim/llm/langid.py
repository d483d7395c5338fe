"""Language ID: multinomial naive Bayes over hashed character n-grams.

Spark counts the documents and the n-grams of each language; the log-probability matrix (BUCKETS x languages) is broadcast in
blocks of at most MOST_LANGUAGES languages, so that a broadcast is bounded however many languages there are. A text is a sparse
vector of bucket counts, which numpy multiplies with the matrix. N-grams are the letter itself, the letter with its left
neighbour, and with both neighbours; anything but a letter counts as a space. The score is the model's posterior, with the
languages' shares of the training documents as prior.

Defined results: a text that is null or has no letter gives `und` with score 0; with no training rows every text is
`und`; equal scores go to the language first by name; repeated rows stay; an empty table gives an empty table; other
columns of the input pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, slices, small_batches, stage, texts

BUCKETS = 1 << 16
#: Languages that one matrix may have; this bounds what is broadcast (256 x 65536 floats are 64 MB). Further ones have their own.
MOST_LANGUAGES = 256
#: Floats that a task gathers from the matrix at once.
GATHERED = 4_000_000
UNKNOWN = "und"
#: The bucket under which documents are counted.
DOCUMENTS = -1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_buckets(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (letters x 3) of all letters of the texts in order, and how many letters each text has."""
    codes = np.frombuffer("  ".join(["", *(t.lower() for t in batch), ""]).encode("utf-32-le", "replace"), "<u4")
    lengths = np.array([len(t.lower()) for t in batch], np.int64)
    ends = np.cumsum(lengths + 2)
    letter = _letters()[codes]
    at = np.flatnonzero(letter)
    c = np.where(letter, codes, 32).astype(np.uint32)
    left, mid, right = c[at - 1], c[at], c[at + 1]
    one = mid * np.uint32(2654435761)
    two = (one ^ (left * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two ^ (right * np.uint32(668265263)) ^ np.uint32(0x5BD1E995)) * np.uint32(374761393)
    shift = np.uint32(16)
    grams = np.stack([one >> shift, two >> shift, three >> shift], axis=1)
    counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
    return grams, counts


def sparse_counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text's n-grams, each once, and how often they occur."""
    if len(grams) * 4 < BUCKETS:
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class LanguageModel:
    """Languages in order, the log-probabilities of their n-grams, and of the languages themselves."""

    languages: list[str]
    log_prob: np.ndarray  # BUCKETS x languages
    prior: np.ndarray  # logarithms

    def log_scores(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts x languages: log of prior times likelihood; and how many n-grams each text has."""
        grams, counts = ngram_buckets(batch)
        ends = np.cumsum(counts)
        done = np.tile(self.prior, (len(batch), 1))
        step = max(1, GATHERED // max(1, len(self.languages)))
        for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
            if a < b:
                at, n = sparse_counts(grams[a:b].ravel())
                for k in range(0, len(at), step):
                    done[i] += n[k : k + step] @ self.log_prob[at[k : k + step]]
        return done, 3 * counts


class LanguageModels(list):
    """Blocks of languages, each a LanguageModel; together they are one model."""

    @property
    def languages(self) -> list[str]:
        return [x for m in self for x in m.languages]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5, most: int = MOST_LANGUAGES) -> LanguageModels:
    """Count the documents and n-grams of every row whose lang is not null, and make the log-probability matrix, in blocks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        seen: Counter = Counter()
        for pdf in batches:
            for name, rows in pdf.groupby("lang", sort=False):
                found = texts(rows)
                seen[name] += len(found)
                counts = held.setdefault(name, np.zeros(BUCKETS, np.int64))
                for a, b in slices(found):
                    counts += np.bincount(ngram_buckets(found[a:b])[0].ravel(), minlength=BUCKETS)
            if len(held) > most:  # many languages in one task: hand on what is counted
                yield from _listed(held, seen)
                held, seen = {}, Counter()
        yield from _listed(held, seen)

    small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = rows.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted, _ = stage(counted, "language-counts")
    documents = {r["lang"]: r["n"] for r in counted.where(F.col("bucket") == DOCUMENTS).collect()}  # a row per language
    languages, total = sorted(documents), sum(documents.values())
    made = LanguageModels()
    for k in range(0, len(languages), most):
        block = languages[k : k + most]
        # at most `most` x BUCKETS rows come back at once
        found = counted.where((F.col("bucket") >= 0) & F.col("lang").between(block[0], block[-1])).toPandas()
        counts = np.full((BUCKETS, len(block)), smoothing)
        index = {x: i for i, x in enumerate(block)}
        np.add.at(counts, (found["bucket"].to_numpy(), found["lang"].map(index).to_numpy(dtype=int)), found["n"].to_numpy())
        prior = np.log(np.array([documents[x] for x in block]) / total)
        made.append(LanguageModel(block, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32), prior))
    return made


def _listed(held: dict[str, np.ndarray], seen: Counter) -> Iterator[pd.DataFrame]:
    for name, counts in held.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": name, "bucket": np.append(at, DOCUMENTS), "n": np.append(counts[at], seen[name])})


def predict(docs: DataFrame, models: LanguageModels, text: str = "text", keep_text: bool = False) -> DataFrame:
    """docs with lang_pred, score, and fit: by how much an n-gram is likelier in that language than if all buckets were equally
    likely, in nats, on average. The text itself stays only if asked for. Nothing but the text is looked at."""
    held = docs.drop("lang_pred", "score", "fit")
    if not models:
        done = held.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "fit": F.lit(0.0)})
        return done if keep_text else done.drop(text)
    for i, model in enumerate(models):  # mostly one block
        held = _scored(held, model, text, f"_{i}")
    best = lambda i: F.col(f"_best_{i}")
    top = F.greatest(*(best(i) for i in range(len(models))), F.lit(-float("inf")))
    name = F.coalesce(*(F.when(best(i) == top, F.col(f"_name_{i}")) for i in range(len(models))))
    mass = sum((F.exp(F.col(f"_mass_{i}") - top) for i in range(1, len(models))), F.exp(F.col("_mass_0") - top))
    some = F.col("_n_0") > 0
    done = held.withColumns({
        "lang_pred": F.when(some, name).otherwise(UNKNOWN), "score": F.when(some, F.least(F.lit(1.0), 1 / mass)).otherwise(0.0),
        "fit": F.when(some, (top - F.coalesce(*(F.when(best(i) == top, F.col(f"_prior_{i}")) for i in range(len(models))))) / F.col("_n_0") + float(np.log(BUCKETS))).otherwise(0.0),
    }).drop(*(f"_{c}_{i}" for i in range(len(models)) for c in ("name", "best", "mass", "prior", "n")))
    return done if keep_text else done.drop(text)


def _scored(docs: DataFrame, model: LanguageModel, text: str, mark: str) -> DataFrame:
    """docs with the block's best language, its log score and prior, the log of the sum of all scores, and the number of n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: list[str]) -> list:
        m = shared.value
        scores, n = m.log_scores(batch)
        best = scores.argmax(axis=1)
        top = scores.max(axis=1)
        mass = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return [[m.languages[b] for b in best], top, mass, m.prior[best], n]

    added = {f"_name{mark}": "string", f"_best{mark}": "double", f"_mass{mark}": "double", f"_prior{mark}": "double", f"_n{mark}": "long"}
    return map_texts(docs.withColumn("_read", F.col(text)), make, added, "_read")
