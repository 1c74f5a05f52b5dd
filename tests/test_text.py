import random

import pytest
from brute import clean, element, sentence_chunks
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    clean_text,
    join_pages,
    decode_entities,
    nested_element,
    strip_prompt,
    token_count,
)
from corpusloom.operators.chunking import chunk_sentences, chunk_windows
from corpusloom.sources.web import article, article_body

EDGE = [
    "inter-\nnational  law , ok ?",
    "A - B",
    "--  z",
    "  -  ",
    "",
    "a  b　c\x1cd​e",
    "\x85x y \t\r\n z",
    "one .two ;three:four - - five",
    "tail-   ",
]


def column(spark, df, col, key="i"):
    return [r[1] for r in df.select(key, col).orderBy(key).collect()]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i long, text string")


def test_clean_text_equals_plain_python(spark):
    df = texts(spark, EDGE)
    assert column(spark, df, clean_text(F.col("text"))) == [clean(t) for t in EDGE]


def test_clean_text_order_of_steps(spark):
    got = column(spark, texts(spark, EDGE[:4]), clean_text(F.col("text")))
    assert got == ["international law, ok?", "A B", "-z", ""]


def test_join_pages_cleans_each_page(spark):
    df = spark.createDataFrame([(1, ["a  b", " c ,d "])], "i long, pages array<string>")
    assert column(spark, df, join_pages(F.col("pages"))) == ["a b\n\nc,d"]


def random_text(rng):
    words = ["a", "bb", "ccc.", "d!", "e?!", "...", "f-", "3.14", "\n", "Größe", "x."]
    return " ".join(rng.choice(words) for _ in range(rng.randrange(0, 120)))


@pytest.mark.parametrize("tokens,overlap", [(500, 10), (12, 3), (5, 4), (7, 0)])
def test_sentence_chunks_equal_plain_python(spark, tokens, overlap):
    rng = random.Random(tokens)
    values = [random_text(rng) for _ in range(60)]
    values += ["", "word " * 5000, "...!? lead", "w " * tokens, "w " * (tokens - overlap) + ". x"]
    rows = chunk_sentences(texts(spark, values), "text", tokens, overlap).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.i, r.chunk_idx)):
        got.setdefault(r.i, []).append(r.content)
        assert r.n_tokens == len(r.content.split()) <= tokens
    assert [got.get(i, []) for i in range(len(values))] == [
        sentence_chunks(v, tokens, overlap) for v in values
    ]


def test_sentence_chunks_of_given_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {}
    for r in chunk_sentences(df, "text", 60, 10).orderBy("doc_id", "chunk_idx").collect():
        got.setdefault(r.doc_id, []).append(r.content)
    for doc_id, text in df.collect():
        assert got.get(doc_id, []) == sentence_chunks(text, 60, 10)


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 18, 19, 100])
def test_window_chunks_cover_every_word(spark, n):
    words = [f"w{i}" for i in range(n)]
    rows = (
        chunk_windows(texts(spark, [" ".join(words)]), "text", 10, 2).orderBy("chunk_idx").collect()
    )
    got = [r.content.split() for r in rows]
    assert [w for i, c in enumerate(got) for w in (c[2:] if i else c)] == words
    assert all(len(c) <= 10 for c in got)
    assert all(a[-2:] == b[:2] for a, b in zip(got, got[1:]))


def test_chunks_keep_other_columns(spark):
    df = spark.createDataFrame([("p", 7, "One. Two.")], "path string, length long, text string")
    assert chunk_sentences(df).columns == ["path", "length", "chunk_idx", "content", "n_tokens"]


def test_article_flat_and_missing(spark):
    df = texts(spark, ['x<article id="a"> hi <b>you</b></article>y<article>2</article>', "<p>no</p>"])
    assert column(spark, df, article(F.col("text"))) == [
        '<article id="a"> hi <b>you</b></article>',
        None,
    ]
    assert column(spark, df, article(F.col("text"), "text")) == ["hi you", None]


def test_nested_article_body(spark):
    body = '<div class="x" itemprop="articleBody">\n a<div>b<br><div/></div>c</div>'
    df = texts(spark, [f"<div>no</div>\n{body}<div>d</div>", "<div>none</div>", None, ""])
    assert column(spark, df, article_body(F.col("text"))) == [body, None, None, None]


def test_nested_element_of_another_tag(spark):
    df = texts(spark, ['<p id="k">1</p><p id="q">2</p>'])
    assert column(spark, df, nested_element(F.col("text"), "p", "id", "q")) == ['<p id="q">2</p>']


def test_nested_elements_equal_the_standard_parser(spark, sf):
    rng = random.Random(12)
    parts = [
        "<div>", "</div>", "<div itemprop='articleBody'>", '<DIV class="a>b" itemprop="articleBody" >', "</DIV >", "<div/>",
        "text\n", "<p>", "</p>", "<!-- <div> -->", "<script>if (a<b) '<div>'</script>", "<style>div {}</style>", "<divan>",
        "<div itemprop=articleBody>", "<div data-x='itemprop'>", "a < b", "&lt;div&gt;", "é😀", "<br/>",
    ]
    pages = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(400)]
    html = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()]
    pages += [h.replace("<article>", '<div itemprop="articleBody"><div>').replace("</article>", "</div></div>") for h in html]
    got = column(spark, texts(spark, pages), article_body(F.col("text")))
    assert got == [element(p, "div", "itemprop", "articleBody") for p in pages]
    assert sum(g is not None for g in got) > 200


def test_odd_markup_is_harmless(spark):
    pages = [
        '<![foo[x]]><div itemprop="articleBody">a</div>',
        '<div itemprop="articleBody">never closed <div>',
        "<div itemprop=" + "x" * 100_000,
        "<" * 50_000,
        '<div itemprop="articleBody">' + "<div>" * 3000 + "</div>" * 3001 + "rest",
    ]
    got = column(spark, texts(spark, pages), article_body(F.col("text")))
    assert got[0] == '<div itemprop="articleBody">a</div>' and got[1] == pages[1] and got[2] is None and got[3] is None
    assert got[4] == pages[4][:-4]


def test_character_references(spark):
    values = [
        "a&nbsp;b &copy; &#39;q&#39; &#x1F600; &amp;lt; &hellip;&Eacute;", "&#150; &#x80;", "&unknown; &amp &; & &#0; &#xD800; &#9999999;",
        "", "none", "&NotEqualTilde;&lt", "&&amp;&",
    ]
    want = ["a\xa0b © 'q' \U0001f600 &lt; …É", "– €", "&unknown; &amp &; & &#0; &#xD800; &#9999999;", "", "none", "≂̸&lt", "&&&"]
    assert column(spark, texts(spark, values), decode_entities(F.col("text"))) == want


def test_strip_prompt(spark):
    df = spark.createDataFrame(
        [(1, "Q: a. answer", "Q: a. "), (2, "other", "Q"), (3, "Q", "Q")],
        "i long, out string, prompt string",
    )
    assert column(spark, df, strip_prompt(F.col("out"), F.col("prompt"))) == ["answer", "other", ""]


def test_token_count(spark):
    assert column(spark, texts(spark, ["", " a  b\nc ", "x"]), token_count(F.col("text"))) == [0, 3, 1]
