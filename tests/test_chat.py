import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import prompts
from corpusloom.functions.vectors import HashEmbedder
from corpusloom.operators.embedding import embed
from corpusloom.operators.models import extract_text, generate, generate_streamed, parsed, quarantined
from corpusloom.plans import chat
from corpusloom.session import setting

TALKS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "What is {question}?"),
    (1, 2, "assistant", "A word."),
    (1, 3, "user", "And then?"),
    (2, 0, "user", "Only one"),
    (3, 0, "system", "Rules"),
    (3, 1, "user", "hello"),
    (4, 0, "user", "first"),
    (4, 1, "assistant", "last"),
    (5, 0, "system", "alone"),
]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string")


def by_id(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select(*cols).collect()}


def test_question_is_the_last_message_of_any_role(talks):
    got = by_id(chat.chat_heads(talks), "conv_id", "question", "has_history")
    assert got == {
        1: ("And then?", True),
        2: ("Only one", False),
        3: ("hello", True),
        4: ("last", True),
        5: ("alone", False),
    }


def test_question_of_last_user_on_request(talks):
    got = by_id(chat.chat_heads(talks, last_user=True), "conv_id", "question", "has_history")
    assert got[4] == ("first", False) and 5 not in got


def test_history_drops_other_roles_but_counts_them(talks):
    split = chat.chat_split(talks).where("part = 'history'")
    assert {(r.conv_id, r.turn) for r in split.collect()} == {(1, 1), (1, 2), (4, 0)}
    asked = by_id(chat.rewrite_prompts(talks), "conv_id", "text")
    # System-only history counts for the branch.
    assert asked[3][0].endswith("Chat history: system: Rules\n\nQuestion: hello")
    assert 2 not in asked and 5 not in asked


def test_pieces_of_a_long_prompt_make_up_the_prompt(talks):
    whole = by_id(chat.rewrite_prompts(talks), "conv_id", "text")
    pieces = chat.rewrite_prompts(talks, piece_turns=1).orderBy("conv_id", "piece").collect()
    joined = {}
    for row in pieces:
        joined[row.conv_id] = joined.get(row.conv_id, "") + row.text
    assert joined == {k: v[0] for k, v in whole.items()}
    assert len([r for r in pieces if r.conv_id == 1]) == 3


def tail(length):
    """A model that writes the end of its prompt and counts what it read."""

    def make():
        def write(texts, request):
            read, kept = 0, ""
            for text in texts:
                read, kept = read + len(text), (kept + text)[-length:]
            return f"{read}:{kept}"

        return write

    return make


def test_search_text_follows_the_branch(talks):
    plain = by_id(chat.search_texts(talks), "conv_id", "search_text")
    assert plain[2] == ("Only one",) and plain[3] == ("Rules\nhello",)
    short = by_id(chat.search_texts(talks, tail(5)), "conv_id", "search_text")
    whole = by_id(chat.rewrite_prompts(talks), "conv_id", "text")
    assert short[2] == ("Only one",) and short[3] == (f"{len(whole[3][0])}:hello",)


def test_a_long_talk_is_rewritten(spark):
    talk = [(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(700)] + [(2, 0, "user", "short")]
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    pieces = chat.rewrite_prompts(frame).orderBy("piece").collect()
    assert len(pieces) == 3
    whole = "".join(r.text for r in pieces)
    got = by_id(chat.search_texts(frame, tail(18)), "conv_id", "search_text")
    assert got == {1: (f"{len(whole)}:{whole[-18:]}",), 2: ("short",)} and whole.endswith("Question: turn 699")


def test_a_prompt_of_a_million_characters_is_answered(spark, monkeypatch):
    talk = [(1, t, "assistant" if t % 2 else "user", f"{t} " + "word " * 500) for t in range(601)]
    frame = spark.createDataFrame(talk + [(2, 0, "user", "Hi")], "conv_id long, turn long, role string, text string")
    none = spark.createDataFrame([], "conv_id long, context string")
    pieces = chat.prompt_pieces(chat.assemble_prompts(frame, none))
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", 50):
        got = by_id(generate_streamed(pieces, "conv_id", "piece", tail(8)), "conv_id", "output")
    read, _, end = got[1][0].partition(":")
    assert int(read) > 1_500_000 and end == "[/INST]\n" and got[2][0].endswith("[/INST]\n")
    rows = pieces.where("conv_id = 2").orderBy("piece").collect()
    system = chat.assemble_prompts(frame, none).where("conv_id = 2 and seq = 0").first().content
    assert "".join(r.text for r in rows) == f"<s>[INST]<<SYS>>\n{system}\n<</SYS>>\n\n\nuser: Hi[/INST]\n"


def test_streamed_calls_take_their_parameters(spark):
    rows = [(1, 0, "a", 0.5, None), (1, 1, None, None, 9), (2, 0, "b", None, 7), (None, 0, "c", None, None)]
    frame = spark.createDataFrame(rows, "k long, i int, text string, temperature double, max_new_tokens long")

    def make():
        # Leaves pieces unread, which must not disturb the next call.
        return lambda texts, request: f"{next(texts)}|{request['temperature']}|{request['max_new_tokens']}"

    got = by_id(generate_streamed(frame, "k", "i", make), "k", "output")
    assert got == {1: ("a|0.5|100",), 2: ("b|1.0|7",), None: ("c|1.0|100",)}
    bare = by_id(generate_streamed(frame.select("k", "i", "text"), "k", "i", make), "k", "output")
    assert bare[2] == ("b|1.0|100",)


def test_templates_are_checked_when_given(spark):
    with pytest.raises(ValueError, match="unknown slot 'contxt'"):
        prompts.PromptTexts(answer="{contxt}")
    with pytest.raises(ValueError, match="lone brace"):
        prompts.PromptTexts(passage="{chunk_text} }")
    with pytest.raises(ValueError, match="chat_history"):
        prompts.PromptTexts(rewrite="{question}")
    with pytest.raises(ValueError, match="unknown templates"):
        prompts.PromptTexts.from_config({"greeting": "hi"})
    row = spark.range(1).select(prompts.fill("{{{a}}} {b}{a}", a=F.lit("{b}"), b=F.lit(2).cast("string"))).first()
    assert row[0] == "{{b}} 2{b}"


def test_values_that_look_like_placeholders_stay(spark, talks):
    contexts = spark.createDataFrame([(4, "see {question} {context}")], "conv_id long, context string")
    rows = chat.assemble_prompts(talks, contexts).where("conv_id = 4").orderBy("seq").collect()
    assert [r.role for r in rows] == ["system", "user", "user"]
    assert "help you answer: see {question} {context}.  Answer" in rows[0].content
    assert rows[0].content.endswith("answer this question: last")


def test_context_lists_passages_in_rank_order(spark):
    hits = spark.createDataFrame(
        [(1, r, f"c{r}", "u") for r in (10, 2, 1)], "query_id long, rank int, content string, url string"
    )
    assert chat.format_context(hits).first().context == "Passage: c1\nPassage: c2\nPassage: c10\n"
    with_url = chat.format_context(hits, "{document_uri}:{chunk_text};")
    assert with_url.first().context == "u:c1;u:c2;u:c10;"


def test_instruct_prompt(spark):
    row = spark.range(1).select(prompts.instruct_prompt(F.lit("S"), F.lit("I"))).first()
    assert row[0] == "<s>[INST]<<SYS>>\nS\n<</SYS>>\n\n\nI[/INST]\n"


def test_prompt_budget_limit(spark):
    rows = spark.createDataFrame(
        [(1, "a b"), (1, "c"), (2, "a b c d")], "conv_id long, content string"
    )
    got = by_id(chat.prompt_budget(rows, 10, 13), "conv_id", "prompt_tokens", "fits")
    assert got == {1: (3, True), 2: (4, False)}


def test_equal_texts_are_embedded_once_and_answered_each(spark):
    calls = spark.sparkContext.accumulator(0)
    inner = HashEmbedder(16)

    def counting(texts):
        calls.add(len(texts))
        return inner(texts)

    texts = spark.createDataFrame(
        [(i, "u", f"word{i} common") for i in range(5)], "id long, url string, content string"
    )
    corpus = embed(texts, "content", inner, 16).cache()
    queries = spark.createDataFrame([(i, "word3 common") for i in range(50)], "query_id long, text string")
    hits = chat.retrieve(queries, corpus, counting, 16, 1).collect()
    assert len(hits) == 50 and {r.id for r in hits} == {3}
    # Staged once, sized once.
    assert calls.value <= 2


def test_chain_end_to_end(spark, talks):
    texts = spark.createDataFrame(
        [(1, "u1", "nothing here"), (2, "u2", "And then what follows"), (3, "u3", "hello world")],
        "id long, url string, content string",
    )
    corpus = embed(texts, "content", HashEmbedder(64), 64).cache()
    rows = chat.rag_prompts(talks, corpus, HashEmbedder(64), 64, k=1)
    system = by_id(rows.where("seq = 0"), "conv_id", "content")
    assert "Passage: hello world\n" in system[3][0]
    pieces = chat.prompt_pieces(rows).where("conv_id = 1 and piece > 0").orderBy("piece")
    assert "".join(r.text for r in pieces.collect()) == (
        "user: What is {question}?\nassistant: A word.\nuser: And then?[/INST]\n"
    )


def test_generate_defaults_row_by_row(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.1, None), (2, "b", None, 7), (3, "c", None, None)],
        "i long, prompt string, t double, n long",
    ).coalesce(1)

    def make():
        return lambda q: [f"{p}|{s}|{t}|{n}" for p, s, t, n in q.itertuples(index=False)]

    out = generate(df, make, F.col("prompt"), F.lit("sys"), F.col("t"), F.col("n"))
    assert [r.output for r in out.orderBy("i").collect()] == [
        "a|sys|0.1|100",
        "b|sys|1.0|7",
        "c|sys|1.0|100",
    ]
    bare = generate(df, make, F.col("prompt"), F.lit("sys"))
    assert bare.where("i = 2").first().output == "b|sys|1.0|100"


def test_generate_checks_the_number_of_replies(spark):
    df = spark.createDataFrame([(1, "a")], "i long, prompt string")
    with pytest.raises(Exception, match="0 replies for 1 requests"):
        generate(df, lambda: lambda q: [], F.col("prompt"), F.lit("s")).collect()


def test_unparseable_files_are_quarantined(spark):
    df = spark.createDataFrame(
        [("a", bytearray(b"x  y\fz")), ("b", bytearray(b"\xff")), ("c", None)], "path string, content binary"
    )
    out = extract_text(df, lambda: lambda b: b.decode("utf-8").split("\f")).cache()
    assert [tuple(r) for r in parsed(out).collect()] == [("a", "x y\n\nz")]
    bad = {r.path: r.error for r in quarantined(out).collect()}
    assert set(bad) == {"b", "c"} and bad["b"].startswith("UnicodeDecodeError")


def test_parser_is_made_once_per_task(spark):
    made = spark.sparkContext.accumulator(0)

    def make():
        made.add(1)
        return lambda b: [b.decode()]

    df = spark.range(100).select(F.col("id").cast("string").cast("binary").alias("content")).coalesce(1)
    assert extract_text(df, make).where("error is null").count() == 100
    assert np.all(made.value <= 2)
