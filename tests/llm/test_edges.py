"""Every operator and stage on nulls, blanks, long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest

import corpus_pipeline
from gridclim.llm import bpe, chat, chunks, langid, linededup, packing, quality, simhash, suffixes, toxicity

LONG = "Some words that fill a very long text, line after line of it. " * 4000
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", None, None), (3, " \n\t ", None, "a", 1), (4, "A b.", "en", "a", 4), (4, "A b.", "en", "a", 4), (5, LONG, "en", "a", 9),
    (6, LONG + " end", "de", "a", 9), (7, "été où ça", "fr", "a", 9), (8, "123 !!! \n", "fr", "a", 9), (9, "<|endoftext|> 漢字 \U0001f600", None, "b", 2), (None, "A b.", "en", "a", 4),
]
EXTRA = ("score", "fingerprint", "n_lines", "ids", "n_bytes", "hi", "seq", "anchor", "first", "digest", "component_id", "lang_pred", "fp", "n_words", "keeper")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def toxic(docs):
    labels = docs.selectExpr("doc_id", "case when doc_id % 2 = 0 then 1 else 0 end as toxic")
    return toxicity.classify(docs, labels)


OPERATORS = {
    "langid": lambda d: langid.predict(d, langid.fit(d)), "simhash": simhash.near_duplicates, "bpe": lambda d: bpe.round_trip_digests(d, BYTES), "bpe_ids": lambda d: bpe.encode(d, BYTES),
    "lines": linededup.dedup_lines, "quality": quality.judge, "toxicity": toxic, "chunks": lambda d: chunks.read(chunks.store(d)), "packing": lambda d: packing.pack(d, WORDS), "suffixes": suffixes.cut_repeats,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    clashing = docs.withColumns({c: docs["doc_id"].cast("string") for c in EXTRA})
    plain, more = OPERATORS[name](docs).collect(), OPERATORS[name](clashing).collect()
    ids = lambda rows: sorted(str(r.doc_id) for r in rows)
    assert ids(plain) == ids(more)
    assert set(ids(plain)) == {str(r[0]) for r in ROWS}
    if name != "packing":
        assert len(plain) == len(ROWS)
    if name == "langid":
        found = {r.doc_id: r.lang_pred for r in plain}
        assert [found[i] for i in (1, 2, 3, 8)] == ["und"] * 4 and found[7] == "fr"
    if name == "simhash":
        assert {r.doc_id: r.component_id for r in plain if r.doc_id in (1, 2, 3, 4)} == {1: 1, 2: 1, 3: 1, 4: 4}
        assert next(r.fingerprint for r in plain if r.doc_id == 1) == "0" * 16
    if name == "lines":
        assert {(r.doc_id, r.text, r.n_lines) for r in plain if r.doc_id in (1, 2)} == {(1, "", 1), (2, "", 1)}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_chats(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 1, "assistant", "b<|im_end|>", "x"), (1, 0, "user", None, "x"), (1, 2, "assistant", "<||", "x"), (1, 2, "assistant", "<||", "x"), (2, None, None, "a", "x"), (None, 0, "a\n<|", "t", "x")]
    done = chat.format_chats(spark.createDataFrame(rows, schema))
    got = {r.conv_id: (r.formatted, [tuple(t) for t in r.turns], r.loss) for r in done.select("conv_id", "formatted", chat.read_turns(done.formatted).alias("turns"), chat.loss_text(done.segments).alias("loss")).collect()}
    assert got[1][1] == [("user", ""), ("assistant", "b<|im_end|>"), ("assistant", "<||"), ("assistant", "<||")] and got[1][2] == "b<|im_end|><||<||"
    assert got[1][0].count(chat.START) == 2 and got[2][1] == [("", "a")] and got[None][1] == [("a\n<|", "t")]
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


def test_texts_that_share_an_id_are_not_lost(spark):
    """Two texts under one id and rows without an id go through all stages that judge texts alone."""
    texts = ["".join(chr(97 + (i * 7 + k * k) % 26) if k % 6 else " " for k in range(400)) for i in range(4)]
    rows = [(1, texts[0], "en", "a", 0), (1, texts[1], "en", "a", 0), (None, texts[2], "en", "a", 0), (2, texts[3], "en", "a", 0), (2, texts[3], "en", "b", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = step(spark, docs, "")
        assert {r.text for r in docs.collect()} == set(texts), name
    assert sorted((str(r.doc_id), r.source) for r in docs.collect()) == [("1", "a"), ("1", "a"), ("2", "a"), ("None", "a")]


def test_stages_on_odd_rows_and_empty_tables(spark):
    for rows in (ROWS, []):
        docs = spark.createDataFrame(rows, SCHEMA)
        columns = docs.columns
        for name, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, "").cache()
            if name != "packing":
                assert docs.columns == columns
            docs.count()
        assert (docs.count() > 0) == bool(rows)
