"""Chunks bounded by several tokenizers' counts."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.operators import token_chunks as tc
from corpusloom.operators.chunking import chunk_sentences
from corpusloom.plans import chat

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = [
    (1, "One sentence here. Another one there! And a third? " * 40),
    (2, ""),
    (3, None),
    (4, "x" * 5000),
    (5, "no end of words " * 400),
    (6, "  Short.  "),
    (7, "ünïcödé 😀 words, and signs: #$%! " * 50),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)


def tiktoken_like():
    """A counter whose counts of joined texts exceed those of their parts."""

    def count(texts):
        return [list(range(1, len(t) + 1)) + [len(t)] * (t.count(" ") * 3) for t in texts]

    return count


@pytest.mark.parametrize(
    "make", [tc.pattern_counter(r"\w+|[^\w\s]"), tc.width_counter(4), tc.pattern_counter("."), lambda: tiktoken_like()]
)
@pytest.mark.parametrize("overlap", [0, 7])
def test_no_chunk_is_over_the_bound_and_no_text_is_lost(docs, make, overlap):
    rows = tc.chunk_by_tokens(docs, make, max_tokens=60, overlap=overlap).orderBy("doc_id", "chunk_idx").collect()
    counter = make()
    assert all(r.n_tokens == len(counter([r.content])[0]) <= 60 for r in rows)
    for doc_id, text in TEXTS:
        own = [r for r in rows if r.doc_id == doc_id]
        assert [r.chunk_idx for r in own] == list(range(len(own)))
        if overlap == 0:
            assert "".join("".join(r.content.split()) for r in own) == "".join((text or "").split())


def test_counting_words_gives_the_chunks_of_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    plain = chunk_sentences(docs, max_tokens=200, overlap=10)
    # A long sentence is cut one token shorter here, as a tokenizer may count a space.
    short = docs.where(F.size(F.split("text", " ")) < 150)
    ids = [r.doc_id for r in short.select("doc_id").collect()]
    counted = tc.chunk_by_tokens(docs, tc.pattern_counter(r"\S+"), max_tokens=200, overlap=10)
    both = [sorted(map(tuple, f.where(F.col("doc_id").isin(ids)).collect())) for f in (plain, counted)]
    assert both[0] == both[1] and len(both[0]) >= len(ids) > 20


def test_a_models_tokenizer(docs):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public.path("byte_bpe_50k.json")
    rows = tc.chunk_by_tokens(docs, tc.tokenizer_counter(path), max_tokens=50, overlap=5).collect()
    model = tokenizers.Tokenizer.from_file(path)
    assert len(rows) > 20
    for r in rows:
        assert r.n_tokens == len(model.encode(r.content, add_special_tokens=False).ids) <= 50


def test_budget_by_a_counter(spark):
    rows = spark.createDataFrame([(1, "abcdefgh"), (1, None), (2, "abc" * 9)], "conv_id long, content string")
    got = {r.conv_id: (r.prompt_tokens, r.fits) for r in chat.prompt_budget(rows, 4, 8, tc.width_counter(4)).collect()}
    assert got == {1: (2, True), 2: (7, False)}


def test_wrong_counters_and_bounds(docs):
    with pytest.raises(Exception, match="counter gave"):
        tc.chunk_by_tokens(docs, lambda: lambda texts: []).collect()
    with pytest.raises(ValueError, match="no room"):
        tc.chunk_by_tokens(docs, tc.width_counter(4), max_tokens=10, overlap=10)


def test_tokens_of_a_batch_are_counted_in_slices(spark):
    """A counter gives a number per token; it was asked for those of a whole batch at once."""

    def make():
        count = tc.width_counter(4)()

        def bounded(texts):
            if sum(map(len, texts)) > 2_000_000:
                raise ValueError("too much text at once")
            return count(texts)

        return bounded

    text = "Some words make a sentence of some length. " * 250
    docs = spark.range(300).select("id", F.concat(F.lit(text), F.col("id").cast("string")).alias("text")).coalesce(1)
    sliced, whole = (tc.chunk_by_tokens(docs, m) for m in (make, tc.width_counter(4)))
    assert sliced.exceptAll(whole).isEmpty() and sliced.count() == whole.count() > 300
    assert docs.select(tc.tokens_in(F.col("text"), make).alias("n")).where("n > 2000").count() == 300
