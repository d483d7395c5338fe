"""The pipeline's rows against the same steps in plain Python."""

import collections

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import brute_fingerprint, brute_lines, brute_repeats, components_of

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_steps(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = [(i, t) for i, t in zip(docs.doc_id, docs.text) if any(c.isalpha() for c in t)]  # all languages are sure here
    rows = sorted(brute_lines(rows).items())
    prints = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    ids = [i for i, _ in rows]
    label = components_of(ids, np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    rows = [r for r, k in zip(rows, label) if r[0] == k]
    kept = [(i, x[2].decode("utf-8", "ignore")) for (i, _), x in zip(rows, brute_repeats([t.encode() for _, t in rows], 200))]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == want
    lengths = collections.Counter(got.length)
    assert lengths[2048] == sum(n // 2048 for n in want.values())
