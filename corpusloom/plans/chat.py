"""Retrieval-augmented prompts for whole tables of conversations.

A conversation is rows of ``(conv_id, turn, role, text)``. Prompts stay rows of
messages as well: a conversation of any length passes through without being
gathered in one task. Text is folded into one string only in pieces of some
turns, and a model call reads the pieces of its prompt one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import prompts
from corpusloom.functions.prompts import HISTORY_ROLES, PASSAGES, PromptTexts
from corpusloom.functions.text import token_count
from corpusloom.functions.vectors import BatchEmbedder
from corpusloom.operators.embedding import embed
from corpusloom.operators.models import StreamGenerator, generate_streamed
from corpusloom.operators.named_index import PROBES, NamedIndex
from corpusloom.operators.search import knn, with_payload
from corpusloom.operators.token_chunks import MakeCounter, tokens_in
from corpusloom.session import stage

# Turns per piece of a rewrite prompt.
PIECE_TURNS = 256
TEXTS = PromptTexts()


def _line() -> Column:
    return F.concat("role", F.lit(": "), "text")


def chat_heads(messages: DataFrame, last_user: bool = False) -> DataFrame:
    """``(conv_id, question, opening, last_turn, has_history)`` per conversation.

    The question is the last message whatever its role; with ``last_user`` it is
    the last message of the user. ``opening`` is the first message.
    """
    asked = F.when(F.col("role") == "user", F.col("turn")) if last_user else F.col("turn")
    return (
        messages.groupBy("conv_id")
        .agg(
            F.max_by("text", asked).alias("question"),
            F.max(asked).alias("last_turn"),
            F.min("turn").alias("first_turn"),
            F.min_by("text", "turn").alias("opening"),
        )
        .where(F.col("last_turn").isNotNull())
        .select(
            "conv_id",
            "question",
            "opening",
            "last_turn",
            (F.col("first_turn") < F.col("last_turn")).alias("has_history"),
        )
    )


def chat_history(messages: DataFrame, heads: DataFrame) -> DataFrame:
    """Every message before the question, all roles."""
    return messages.join(heads.select("conv_id", "last_turn"), "conv_id").where(
        F.col("turn") < F.col("last_turn")
    )


def spoken(history: DataFrame) -> DataFrame:
    """The history as it enters the prompt: user and assistant turns only."""
    return history.where(F.col("role").isin(*HISTORY_ROLES))


def chat_split(messages: DataFrame, last_user: bool = False) -> DataFrame:
    """Messages marked as ``question`` or ``history``; other roles are left out."""
    heads = chat_heads(messages, last_user)
    columns = ["conv_id", "turn", "role", "text"]
    history = spoken(chat_history(messages, heads)).select(
        *columns, F.lit("history").alias("part")
    )
    question = messages.join(
        heads.select("conv_id", F.col("last_turn").alias("turn")), ["conv_id", "turn"]
    ).select(*columns, F.lit("question").alias("part"))
    return history.unionByName(question)


def _fold(*keys: str | Column):
    """Lines ``role: text`` in order of turn, one string per group."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", _line().alias("line"))))
    return lambda turns: turns.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda m: m["line"]), "\n").alias("lines")
    )


def rewrite_prompts(
    messages: DataFrame,
    last_user: bool = False,
    piece_turns: int = PIECE_TURNS,
    texts: PromptTexts = TEXTS,
) -> DataFrame:
    """``(conv_id, piece, text)``: the prompt that asks a model for a search query.

    It exists only where there is a history, system messages counted; otherwise
    the question itself is the query. The pieces of a conversation, in order,
    make up its prompt. A piece spans ``piece_turns`` turns, so an ordinary
    prompt is one row and a very long one never has to fit one value.
    """
    heads = chat_heads(messages, last_user)
    piece = F.floor(F.col("turn") / piece_turns).alias("piece")
    pieces = _fold("conv_id", piece)(chat_history(messages, heads))
    ends = pieces.groupBy("conv_id").agg(
        F.min("piece").alias("first"), F.max("piece").alias("last")
    )
    before, after = (prompts.filled(p, question=F.col("question")) for p in texts.around_history())
    opening = F.when(F.col("piece") == F.col("first"), before).otherwise("\n")
    closing = F.when(F.col("piece") == F.col("last"), after).otherwise("")
    return (
        pieces.join(ends, "conv_id")
        .join(heads.select("conv_id", "question"), "conv_id")
        .select("conv_id", "piece", F.concat(opening, "lines", closing).alias("text"))
    )


MakeRewriter = Callable[[], StreamGenerator]


def search_texts(
    messages: DataFrame,
    make_rewriter: MakeRewriter | None = None,
    last_user: bool = False,
    texts: PromptTexts = TEXTS,
) -> DataFrame:
    """``(conv_id, search_text)``, rewritten where there is a history.

    The model that ``make_rewriter`` makes, once per task, reads the pieces of a prompt and
    writes the query, however many pieces there are. Without one the opening message and
    the question stand in for what a model would write.
    """
    heads = chat_heads(messages, last_user)
    if make_rewriter is None:
        rewritten = F.when(
            F.col("has_history"), F.concat_ws("\n", F.col("opening"), F.col("question"))
        )
        return heads.select("conv_id", F.coalesce(rewritten, "question").alias("search_text"))
    pieces = rewrite_prompts(messages, last_user, texts=texts)
    written = generate_streamed(pieces, "conv_id", "piece", make_rewriter, "rewritten")
    return heads.join(stage(written, "rewritten"), "conv_id", "left").select(
        "conv_id", F.coalesce("rewritten", "question").alias("search_text")
    )


def retrieve(
    queries: DataFrame,
    corpus: DataFrame | NamedIndex,
    embedder: BatchEmbedder,
    dim: int,
    k: int = PASSAGES,
    where: Column | None = None,
    nprobe: int = PROBES,
) -> DataFrame:
    """The k best passages ``(query_id, rank, id, url, content, score)`` per query text.

    ``queries`` is ``(query_id, text)``. A ``corpus (id, url, content, embedding)`` is
    searched exactly; an index with the payload ``url, content`` is probed in ``nprobe``
    cells, and ``where`` is over its attributes. Equal texts are embedded and searched
    once, however many queries share one.
    """
    asked = stage(queries.select("query_id", "text", F.md5("text").alias("digest")), "asked")
    distinct = asked.groupBy("digest").agg(
        F.min("query_id").alias("first_id"), F.min("text").alias("text")
    )
    distinct = stage(embed(distinct, "text", embedder, dim).drop("text"), "distinct")
    vectors = distinct.select(F.col("first_id").alias("query_id"), "embedding")
    if isinstance(corpus, NamedIndex):
        found = corpus.search(vectors, k, nprobe, where)
    else:
        found = knn(vectors, corpus, k, where, stored=True)
    found = found.withColumnRenamed("query_id", "first_id")
    same = asked.select("query_id", "digest").join(
        distinct.select("digest", "first_id"), "digest"
    )
    hits = same.join(found, "first_id").drop("first_id", "digest")
    if isinstance(corpus, NamedIndex):
        paid = corpus.with_payload(hits)
    else:
        paid = with_payload(hits, corpus, "url", "content")
    return paid.select("query_id", "rank", "id", "url", "content", "score")


def format_context(hits: DataFrame, template: str = prompts.PASSAGE_TEMPLATE) -> DataFrame:
    """``(query_id, context)``: the passages of a query in rank order."""
    passage = prompts.fill(template, chunk_text=F.col("content"), document_uri=F.col("url"))
    # At most k rows per query.
    ordered = F.array_sort(F.collect_list(F.struct("rank", passage.alias("passage"))))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["passage"]), "").alias("context")
    )


def assemble_prompts(
    messages: DataFrame,
    contexts: DataFrame,
    last_user: bool = False,
    texts: PromptTexts = TEXTS,
) -> DataFrame:
    """Message rows ``(conv_id, seq, role, content)`` for a chat model.

    System message with context and question, the spoken history, the question.
    ``contexts`` is ``(conv_id, context)``; a conversation without one gets an
    empty context.
    """
    heads = chat_heads(messages, last_user)
    filled = heads.join(contexts, "conv_id", "left").withColumn(
        "context", F.coalesce("context", F.lit(""))
    )
    framing = filled.select(
        "conv_id",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).cast("long").alias("seq"),
                    F.lit("system").alias("role"),
                    texts.system_message(F.col("context"), F.col("question")).alias("content"),
                ),
                F.struct(
                    (F.col("last_turn") + 1).alias("seq"),
                    F.lit("user").alias("role"),
                    F.col("question").alias("content"),
                ),
            )
        ),
    )
    history = spoken(chat_history(messages, heads)).select(
        "conv_id", (F.col("turn") + 1).alias("seq"), "role", F.col("text").alias("content")
    )
    return framing.unionByName(history)


def prompt_budget(
    prompt_rows: DataFrame,
    max_tokens: int = prompts.MAX_ANSWER_TOKENS,
    window: int = prompts.MODEL_WINDOW,
    make_counter: MakeCounter | None = None,
) -> DataFrame:
    """``(conv_id, prompt_tokens, fits)``: does prompt plus answer fit the model?

    Tokens are those of the counter, or words.
    """
    content = F.col("content")
    tokens = token_count(content) if make_counter is None else tokens_in(content, make_counter)
    counted = prompt_rows.select("conv_id", tokens.alias("tokens"))
    return counted.groupBy("conv_id").agg(
        F.sum("tokens").alias("prompt_tokens"), (F.sum("tokens") + max_tokens <= window).alias("fits")
    )


def rag_prompts(
    messages: DataFrame,
    corpus: DataFrame | NamedIndex,
    embedder: BatchEmbedder,
    dim: int,
    k: int = PASSAGES,
    make_rewriter: MakeRewriter | None = None,
    last_user: bool = False,
    nprobe: int = PROBES,
    texts: PromptTexts = TEXTS,
) -> DataFrame:
    """The whole chain up to the model call, one prompt per conversation."""
    asked = search_texts(messages, make_rewriter, last_user, texts)
    queries = asked.select(
        F.col("conv_id").alias("query_id"), F.col("search_text").alias("text")
    )
    hits = retrieve(queries, corpus, embedder, dim, k, nprobe=nprobe)
    contexts = format_context(hits, texts.passage).withColumnRenamed("query_id", "conv_id")
    return assemble_prompts(messages, contexts, last_user, texts)


def prompt_pieces(prompt_rows: DataFrame, texts: PromptTexts = TEXTS) -> DataFrame:
    """``(conv_id, piece, text)``: prompts wrapped for an instruction model, a piece per message.

    In order, the pieces of a conversation are its prompt: the system message in its
    frame, then ``role: text`` lines. ``operators.models.generate_streamed`` reads them.
    """
    before, after = texts.around_instruction()
    # Either side may show the system message.
    systems = prompt_rows.where(F.col("seq") == 0).select("conv_id", F.col("content").alias("_system"))
    ends = prompt_rows.where(F.col("seq") > 0).groupBy("conv_id").agg(
        F.min("seq").alias("_first"), F.max("seq").alias("_last")
    )
    rows = prompt_rows.join(systems.join(ends, "conv_id"), "conv_id")
    opening, closing = (prompts.filled(p, system_prompt=F.col("_system")) for p in (before, after))
    line = F.concat(
        F.when(F.col("seq") == F.col("_first"), F.lit("")).otherwise(F.lit("\n")),
        F.concat("role", F.lit(": "), "content"),
        F.when(F.col("seq") == F.col("_last"), closing).otherwise(F.lit("")),
    )
    text = F.when(F.col("seq") == 0, opening).otherwise(line)
    return rows.select("conv_id", F.col("seq").alias("piece"), text.alias("text"))
