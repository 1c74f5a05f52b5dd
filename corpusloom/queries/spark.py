"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import prompts
from corpusloom.functions.text import clean_text as clean
from corpusloom.functions.text import join_pages as joined_pages
from corpusloom.functions.text import strip_prompt as without_prompt
from corpusloom.functions.vectors import HashEmbedder
from corpusloom.operators import chunking, evaluation, feedback, index, keys, models, search, token_chunks
from corpusloom.operators.embedding import embed
from corpusloom.operators.named_index import create_index, open_index
from corpusloom.plans import chat
from corpusloom.plans.corpus import CorpusJob, embedded_chunks
from corpusloom.plans.feed import CorpusFeed
from corpusloom.queries.logs import assessment_log, request_log
from corpusloom.session import new_path, publish_views, require_rows, spread, stage, table_exists
from corpusloom.sources import web
from corpusloom.sources.files import binary_files, catalog_stream, land_texts, table, table_stream
from corpusloom.streaming.drain import drain

DIM = 64
EMBEDDER = HashEmbedder(DIM)

# What users of an application store once and read many times: the embedded
# corpus, the vector index, the landed files.
_stored: dict[tuple[str, str, str], object] = {}


def stored_once(spark: SparkSession, folder: str, name: str, build):
    key = spark.sparkContext.applicationId, folder, name
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def document_url(doc_id: str = "doc_id") -> Column:
    return F.concat(F.lit("doc/"), F.col(doc_id))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder).select(document_url().alias("url"), "text")
    return stored_once(spark, folder, "corpus", lambda: embedded_chunks(texts, EMBEDDER, DIM))


def micro(vector: str) -> Column:
    """A vector as text of integer millionths, equal in every engine."""
    parts = F.transform(F.col(vector), lambda x: F.round(x.cast("double") * 1_000_000).cast("long"))
    return F.array_join(parts.cast("array<string>"), ",")


# Text


def clean_text(spark, folder):
    texts = spread(documents(spark, folder).select("doc_id", "text"))
    return texts.select("doc_id", clean(F.col("text")).alias("text"))


def join_pages(spark, folder):
    texts = spread(documents(spark, folder).select("doc_id", "text"))
    return texts.select("doc_id", joined_pages(F.split("text", "\n")).alias("text"))


def chunk_sentences(spark, folder):
    return chunking.chunk_sentences(spread(documents(spark, folder).select("doc_id", "text")))


def chunk_tokens(spark, folder):
    """Sentences packed by another counter than words."""
    texts = spread(documents(spark, folder).select("doc_id", "text"))
    return token_chunks.chunk_by_tokens(texts, token_chunks.width_counter(4))


def chunk_windows(spark, folder):
    return chunking.chunk_windows(
        spread(documents(spark, folder).select("doc_id", "text")), max_tokens=100, overlap=10
    )


def extract_article(spark, folder):
    pages = spread(table(spark, folder, "pages").select("page_id", "html"))
    return pages.select(
        "page_id",
        web.article(F.col("html")).alias("article"),
        web.article(F.col("html"), "text").alias("article_text"),
    )


def nested_article(spark, folder):
    """Article bodies as marked-up ``div`` elements, nested ones included."""
    pages = table(spark, folder, "pages")
    body = F.regexp_replace("html", r"<article>", '<div itemprop="articleBody"><div>')
    body = F.regexp_replace(body, r"</article>", "</div></div>")
    return spread(pages.select("page_id", body.alias("html"))).select(
        "page_id", web.article_body(F.col("html")).alias("article")
    )


def text_parser():
    """Decodes UTF-8 and splits pages at line ends; refuses other content types."""

    def parse(content: bytes) -> list[str]:
        text = content.decode("utf-8")
        if "%%%" in text:
            raise ValueError("unreadable characters")
        return text.split("\n")

    return parse


def extract_text(spark, folder):
    files = spread(
        table(spark, folder, "pages").select("page_id", F.encode("html", "utf-8").alias("content"))
    )
    return models.extract_text(files, text_parser)


# Web


def pages_corpus(spark, folder):
    fetched = spread(table(spark, folder, "pages").select("url", "html"))
    return require_rows(web.page_corpus(fetched), "no page has an article")


def _sitemaps(spark, folder):
    """Site maps of at most 1,000 addresses each, made of the page table."""
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    loc = F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>"))
    entries = F.array_sort(F.collect_list(F.struct("page_id", loc.alias("loc"))))
    xml = F.concat(
        F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
        F.array_join(F.transform(entries, lambda e: e["loc"]), ""),
        F.lit("</urlset>"),
    )
    number = F.floor(F.col("page_id") / 1000).alias("sitemap")
    return table(spark, folder, "pages").groupBy(number).agg(xml.alias("xml"))


def sitemap_urls(spark, folder):
    return web.sitemap_urls(_sitemaps(spark, folder), "sitemap")


def sitemap_head(spark, folder):
    return web.sitemap_urls(_sitemaps(spark, folder), "sitemap", max_documents=100)


def listing_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return web.listing(pages, without="html")


def preview_like(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return web.preview(pages, "%.html", "page_id")


# Embedding and search


def embed_batch(spark, folder):
    texts = spread(documents(spark, folder).select("doc_id", "text"))
    embedded = embed(texts, "text", EMBEDDER, DIM).withColumn("path", document_url())
    return embedded.selectExpr("path as url", "text as content", "embedding").select(
        "url", F.length("content").cast("long").alias("n_chars"), micro("embedding").alias("embedding")
    )


def embed_query(spark, folder):
    texts = spread(table(spark, folder, "benchmark"))
    return embed(texts, "text", EMBEDDER, DIM).select("item_id", micro("embedding").alias("embedding"))


def _queries(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", "label"
    )


def _as_queries(vectors):
    return vectors.withColumnRenamed("id", "query_id")


def knn_exact(spark, folder):
    """The vectors nearest to the mean vector of every label."""
    vectors = _vectors(spark, folder)
    means = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("means"))
        .select(
            F.col("label").cast("long").alias("query_id"),
            F.transform("means", lambda m: m["x"]).alias("embedding"),
        )
    )
    return search.knn(means, vectors, 3)


def knn_filtered(spark, folder):
    """Benchmark texts against documents labelled good and harmless only."""
    allowed = table(spark, folder, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    texts = spread(documents(spark, folder).select("doc_id", "text")).join(allowed, "doc_id", "left_semi")
    vectors = stage(embed(texts, "text", EMBEDDER, DIM), "vectors").withColumnRenamed("doc_id", "id")
    queries = embed(_queries(spark, folder), "text", EMBEDDER, DIM)
    return search.knn(queries, vectors, 3)


def knn_within(spark, folder):
    """Every vector against those it may see: the ones with its label."""
    vectors = _vectors(spark, folder)
    return search.knn_within(_as_queries(vectors), vectors, "label", 3)


def _build(spark, folder):
    return index.build_index(_vectors(spark, folder), DIM, cells=16)


def _index(spark, folder):
    return stored_once(spark, folder, "index", lambda: _build(spark, folder))


def _given_cells(spark, folder):
    """An index over given centroids: sixteen of the vectors."""

    def build():
        vectors = _vectors(spark, folder)
        given = vectors.where("id < 496 AND id % 31 = 0").orderBy("id").select("embedding").toArrow()
        return index.build_index(vectors, DIM, centroids=search.matrix(given["embedding"]))

    return stored_once(spark, folder, "given cells", build)


def index_build(spark, folder):
    rows = _given_cells(spark, folder).rows
    return rows.select("id", "cell", F.round("distance", 6).alias("distance"))


def knn_ivf(spark, folder):
    """The nearest vectors in the eight nearest cells."""
    vectors = _vectors(spark, folder)
    return index.knn_probed(_as_queries(vectors), _given_cells(spark, folder), 3, nprobe=8)


def knn_pruned(spark, folder):
    """Exact search of every vector through the index."""
    vectors = _vectors(spark, folder)
    return index.knn_pruned(_as_queries(vectors), _index(spark, folder), 3)


def retrieve_text(spark, folder):
    return chat.retrieve(_queries(spark, folder), corpus(spark, folder), EMBEDDER, DIM)


ALL_CELLS = 1 << 40


def _named(spark, folder):
    """The corpus as an index that later steps open by its name."""

    def build():
        root = new_path(spark, "indexes")
        create_index(root, "passages", corpus(spark, folder), DIM, ["n_tokens"], ["url", "content"], rows_per_cell=50)
        return root

    return open_index(spark, stored_once(spark, folder, "named", build), "passages")


def retrieve_ann(spark, folder):
    """Through the index, all cells probed, which must equal exact search."""
    return chat.retrieve(_queries(spark, folder), _named(spark, folder), EMBEDDER, DIM, nprobe=ALL_CELLS)


def retrieve_filtered(spark, folder):
    """Through the index, among passages of some length only."""
    long_enough = F.col("n_tokens") >= 120
    return chat.retrieve(
        _queries(spark, folder), _named(spark, folder), EMBEDDER, DIM, where=long_enough, nprobe=ALL_CELLS
    )


def index_sync(spark, folder):
    """An index of some old vectors, brought up to date, merged and opened again."""
    vectors = _vectors(spark, folder)
    turned = F.when(F.col("id") % 5 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    old = vectors.where("id % 7 <> 0").withColumn("embedding", turned)
    new = vectors.where("id % 11 <> 0")
    root = new_path(spark, "indexes")
    create_index(root, "vectors", old, DIM, ["label"], rows_per_cell=25)
    diff = index.index_diff(old, new, "id", "embedding", "label")
    open_index(spark, root, "vectors").sync(diff, mark="first")
    open_index(spark, root, "vectors").sync(diff, mark="first").merge()
    return open_index(spark, root, "vectors").table().select("id", "label", micro("embedding").alias("embedding"))


def format_context(spark, folder):
    return chat.format_context(retrieve_text(spark, folder))


# Keys, appends, index changes


def _chunks(spark, folder):
    texts = documents(spark, folder).select(document_url().alias("url"), "text")
    return chunking.chunk_sentences(spread(texts))


def assign_ids(spark, folder):
    chunks = stage(_chunks(spark, folder), "chunks")
    return keys.assign_ids(chunks, ["url", "chunk_idx"]).select("id", "url", "chunk_idx")


def append_new_chunks(spark, folder):
    """Chunks to add when those of labelled documents are stored already."""
    labelled = table(spark, folder, "labels").select(document_url().alias("url")).distinct()
    chunks = stage(_chunks(spark, folder), "chunks")
    stored = stage(chunks.join(labelled, "url", "left_semi"), "stored")
    return keys.new_rows(chunks, stored, ["url", "chunk_idx"])


def index_diff(spark, folder):
    """From the raw labelled documents to all clean ones that are not toxic."""
    texts = documents(spark, folder)
    labels = table(spark, folder, "labels")
    old = texts.join(labels, "doc_id", "left_semi").select("doc_id", "text")
    toxic = labels.where(F.col("toxic") == 1)
    new = texts.join(toxic, "doc_id", "left_anti").select(
        "doc_id", clean(F.col("text")).alias("text")
    )
    return index.index_diff(old, new, "doc_id", "text")


# Conversations


def _turns(spark, folder):
    return table(spark, folder, "conversations")


def chat_split(spark, folder):
    return chat.chat_split(_turns(spark, folder))


def rewrite_prompt(spark, folder):
    return chat.rewrite_prompts(_turns(spark, folder))


def _labelled_context(spark, folder):
    """Contexts without retrieval: the first message of the conversation."""
    turns = _turns(spark, folder)
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("content"))
    hits = first.select(
        F.col("conv_id").alias("query_id"), F.lit(1).alias("rank"), "content", F.lit("").alias("url")
    )
    return chat.format_context(hits).withColumnRenamed("query_id", "conv_id")


def assemble_prompt(spark, folder):
    return chat.assemble_prompts(_turns(spark, folder), _labelled_context(spark, folder))


def prompt_budget(spark, folder):
    return chat.prompt_budget(assemble_prompt(spark, folder))


def prompt_budget_tokens(spark, folder):
    return chat.prompt_budget(assemble_prompt(spark, folder), make_counter=token_chunks.width_counter(4))


def rag_prompts(spark, folder):
    return chat.rag_prompts(_turns(spark, folder), corpus(spark, folder), EMBEDDER, DIM)


def rag_prompts_ann(spark, folder):
    """The chain over the index, all cells probed."""
    return chat.rag_prompts(_turns(spark, folder), _named(spark, folder), EMBEDDER, DIM, nprobe=ALL_CELLS)


def echo_generator():
    """Stand-in model: repeats the prompt, then answers with its first words."""

    def generate(requests):
        return [
            prompt + " ".join([f"t={temperature:.2f}", *prompt.split()[:limit]])
            for prompt, temperature, limit in zip(
                requests["prompt"], requests["temperature"], requests["max_new_tokens"]
            )
        ]

    return generate


def first_words_generator():
    """Stand-in model: answers with the first words of a prompt and reads no further."""

    def generate(texts, request):
        read, wanted = "", request["max_new_tokens"]
        for text in texts:
            read += text
            if len(read.split()) > wanted:
                break
        return " ".join([f"t={request['temperature']:.2f}", *read.split()[:wanted]])

    return generate


def rag_answers(spark, folder):
    pieces = chat.prompt_pieces(stage(rag_prompts(spark, folder), "prompts"))
    asked = pieces.withColumns({"temperature": F.lit(0.01), "max_new_tokens": F.lit(40)})
    return models.generate_streamed(asked, "conv_id", "piece", first_words_generator, "answer")


def last_words_rewriter():
    """Stand-in model: reads all pieces of a prompt and writes its last words."""

    def rewrite(texts, request):
        kept = ""
        for text in texts:
            kept = (kept + text)[-200:]
        return " ".join(kept.split()[-5:])

    return rewrite


def rewritten_search(spark, folder):
    return chat.search_texts(_turns(spark, folder), last_words_rewriter)


SHORT_TEXTS = prompts.PromptTexts.from_config(
    {
        "answer": "Q: {question}\nUse {{only}} this: {context}\nQ again: {question}",
        "rewrite": "{question}\n--\n{chat_history}\n--\nShorter, please.",
        "passage": "[{document_uri}] {chunk_text} ",
        "instruct": "{instruction} ({system_prompt})",
    }
)


def assemble_short_prompt(spark, folder):
    """Prompts by templates from a configuration."""
    return chat.assemble_prompts(_turns(spark, folder), _labelled_context(spark, folder), texts=SHORT_TEXTS)


def rewrite_short_prompt(spark, folder):
    return chat.rewrite_prompts(_turns(spark, folder), texts=SHORT_TEXTS)


def instruct_prompt(spark, folder):
    system = F.concat(F.lit("Answer in "), "lang", F.lit("."))
    return documents(spark, folder).select(
        "doc_id", prompts.instruct_prompt(system, F.col("text")).alias("prompt")
    )


def strip_prompt(spark, folder):
    """Turns of the assistant read as output of a model that repeats its prompt."""
    turns = _turns(spark, folder)
    prompt = F.concat("role", F.lit(": "))
    output = F.when(F.col("role") == "assistant", F.concat(prompt, "text")).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", without_prompt(output, prompt).alias("answer"))


def generate_batch(spark, folder):
    """Parameters vary by row; where they are missing the defaults hold."""
    turns = spread(_turns(spark, folder))
    temperature = F.when(F.col("role") == "user", F.lit(0.25))
    limit = F.when(F.col("role") != "system", F.col("turn") + 1)
    out = models.generate(
        turns, echo_generator, F.col("text"), F.col("role"), temperature, limit
    )
    return out.select("conv_id", "turn", "output")


# Feedback and evaluation


def _list_text() -> Column:
    entries = F.transform(
        "retrieval_assessments",
        lambda e: F.concat_ws(
            ":", e["assessment"]["doc_uri"], e["assessment"]["value"], e["n"].cast("string")
        ),
    )
    return F.array_join(entries, ",")


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _latest(spark, folder):
    return feedback.latest_text_assessment(assessment_log(spark, folder), "event_id")


def _collected(spark, folder):
    return feedback.collect_retrieval(assessment_log(spark, folder))


def _merged(spark, folder):
    return feedback.merge_assessments(_latest(spark, folder), _collected(spark, folder))


def dedup_latest(spark, folder):
    return _latest(spark, folder).select(
        "request_id",
        F.col("source.id").alias("user_id"),
        _stamp("timestamp"),
        feedback.verdict(F.col("text_assessment")).alias("verdict"),
        F.col("text_assessment.suggested_output").alias("suggested_output"),
        "schema_version",
    )


def collect_retrieval(spark, folder):
    return feedback.retrieval_steps(_collected(spark, folder)).select(
        "request_id",
        "user_id",
        "step_id",
        "n_assessments",
        "n_distinct",
        _stamp("timestamp"),
        _list_text().alias("passages"),
    )


def merge_assessments(spark, folder):
    return _merged(spark, folder).select(
        "request_id",
        F.col("source.id").alias("user_id"),
        feedback.verdict(F.col("text_assessment")).alias("verdict"),
        "step_id",
        "n_assessments",
        "n_distinct",
        _list_text().alias("passages"),
    )


def requests_with_feedback(spark, folder):
    # Read twice by the join, hence stored.
    merged = stage(_merged(spark, folder), "merged")
    joined = feedback.requests_with_feedback(request_log(spark, folder), merged)
    return joined.select(
        "log_id",
        "request",
        "request_id",
        F.col("source.id").alias("user_id"),
        feedback.verdict(F.col("text_assessment")).alias("verdict"),
        "step_id",
        "n_assessments",
        "n_distinct",
        _list_text().alias("passages"),
    )


def eval_set_as_coded(spark, folder):
    return feedback.eval_set(request_log(spark, folder), _merged(spark, folder))


def eval_set_documented(spark, folder):
    return feedback.eval_set_documented(
        request_log(spark, folder), _merged(spark, folder), assessment_log(spark, folder)
    )


def expected_context(spark, folder):
    return feedback.expected_context(assessment_log(spark, folder))


def latest_per_key(spark, folder):
    """Pages as versions: the site is the key, the number in the path the version."""
    pages = table(spark, folder, "pages").select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("site"),
        F.regexp_extract("url", "/([0-9]+)", 1).alias("version"),
        "page_id",
        "url",
    )
    return evaluation.latest_per_key(pages, ["site"], "version", "page_id")


def _run(spark, folder):
    """Ranked passage sources for every logged request, and the best passage as answer."""
    requests = request_log(spark, folder).select(
        F.substring("log_id", 2, 20).cast("long").alias("query_id"),
        F.col("request").alias("text"),
    )
    hits = stage(
        chat.retrieve(requests, corpus(spark, folder), EMBEDDER, DIM), "hits"
    ).withColumn("request_id", F.concat(F.lit("r"), F.col("query_id")))
    answers = hits.where(F.col("rank") == 1).select("request_id", F.col("content").alias("answer"))
    sources = documents(spark, folder).select(document_url().alias("url"), F.col("source").alias("doc_uri"))
    return answers, hits.join(sources, "url").select("request_id", "rank", "doc_uri")


def eval_metrics(spark, folder):
    answers, hits = _run(spark, folder)
    rows = stage(eval_set_as_coded(spark, folder), "evaluation")
    return evaluation.eval_metrics(rows, answers, hits, expected_context(spark, folder))


def eval_compare(spark, folder):
    """The retrieval run against the logged responses with one passage each."""
    logged = request_log(spark, folder).where(F.col("response").isNotNull()).select(
        F.col("log_id").alias("request_id"), F.col("response").alias("answer")
    )
    answers, hits = _run(spark, folder)
    rows = stage(eval_set_as_coded(spark, folder), "evaluation")
    expected = expected_context(spark, folder)
    return evaluation.eval_compare(
        evaluation.eval_metrics(rows, answers, hits, expected),
        evaluation.eval_metrics(rows, logged, hits.where(F.col("rank") == 1), expected),
    )


# Streams


def landed_pages(spark, folder):
    """The web pages, one file each, in a folder of the shared work area."""

    def write():
        path = new_path(spark, "landing")
        land_texts(spread(table(spark, folder, "pages").select("html")), path)
        return path

    return stored_once(spark, folder, "landing", write)


def ingest_files(spark, folder):
    landing, raw = landed_pages(spark, folder), new_path(spark, "raw")
    progress = new_path(spark, "progress")
    # The second run finds nothing new and adds nothing.
    for _ in range(2):
        drain(binary_files(spark, landing, "*.txt"), progress, path=raw)
    return spark.read.parquet(raw).select("length", F.md5("content").alias("digest"))


def embed_stream(spark, folder):
    source, target = new_path(spark, "texts"), new_path(spark, "embedded")
    texts = spread(documents(spark, folder).select(document_url().alias("path"), "text"))
    texts.write.parquet(source)
    stream = table_stream(spark, source, texts.schema)
    embedded = embed(stream, "text", EMBEDDER, DIM)
    drain(
        embedded.selectExpr("path as url", "text as content", "embedding"),
        new_path(spark, "progress"),
        path=target,
    )
    return spark.read.parquet(target).select(
        "url", F.length("content").cast("long").alias("n_chars"), micro("embedding").alias("embedding")
    )


def stream_table(spark, folder):
    """Texts from a catalog table to a catalog table, in batches of two of its files."""
    name = f"texts_{uuid.uuid4().hex}"
    texts = documents(spark, folder).select("doc_id", "text").repartition(5)
    texts.write.option("path", new_path(spark, "texts")).saveAsTable(name)
    stream = catalog_stream(spark, name, files_per_batch=2)
    cleaned = stream.select("doc_id", clean(F.col("text")).alias("text"))
    drain(cleaned, new_path(spark, "progress"), new_path(spark, "cleaned"), f"cleaned_{name}")
    return spark.table(f"cleaned_{name}")


def corpus_changes(spark, folder):
    """Files of pages through the feed to the index, before and after a third of them change."""
    landing = new_path(spark, "landing")
    pages = table(spark, folder, "pages").select("page_id", "html", (F.col("page_id") % 50).alias("part"))

    def land(rows, mode):
        ordered = rows.repartition("part").sortWithinPartitions("part", "page_id").drop("page_id")
        ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("part").text(landing)

    feed = CorpusFeed(
        spark, landing, new_path(spark, "feed"), html_parser, EMBEDDER, DIM, glob="*.txt", batch_files=40,
        rows_per_cell=50,
    )
    land(pages, "overwrite")
    feed.run()
    land(pages.where("part % 3 = 0").withColumn("html", F.replace("html", F.lit("e"), F.lit("o"))), "overwrite")
    rows = feed.run().table()
    return rows.select(
        "chunk_idx", "n_tokens", F.md5("content").alias("digest"), micro("embedding").alias("embedding")
    )


def published_view(spark, folder):
    """Rows per language, counted by SQL over a frame that was published under a name."""
    name = f"documents_{uuid.uuid4().hex}"
    publish_views(**{name: documents(spark, folder)})
    if not table_exists(spark, name) or table_exists(spark, f"no_{name}"):
        raise RuntimeError("the catalog does not know its views")
    return spark.sql(f"SELECT lang, count(*) AS documents, sum(n_chars) AS chars FROM {name} GROUP BY lang")


def html_parser():
    def parse(content: bytes) -> list[str]:
        return content.decode("utf-8").split("\n")

    return parse


def corpus_to_index(spark, folder):
    """Page files through every stage to an index; compared up to the embeddings."""
    job = CorpusJob(
        spark,
        landed_pages(spark, folder),
        new_path(spark, "corpus-job"),
        html_parser,
        EMBEDDER,
        DIM,
        glob="*.txt",
    )
    rows = job.run()
    indexed = index.build_index(rows, DIM, cells=16).rows
    return rows.join(indexed.select("id", "vector"), "id").select(
        "chunk_idx", "n_tokens", F.md5("content").alias("digest"), micro("vector").alias("embedding")
    )


QUERIES = {
    f.__name__: f
    for f in (
        clean_text,
        join_pages,
        chunk_sentences,
        chunk_tokens,
        chunk_windows,
        extract_article,
        nested_article,
        extract_text,
        pages_corpus,
        sitemap_urls,
        sitemap_head,
        listing_filter,
        preview_like,
        embed_batch,
        embed_query,
        knn_exact,
        knn_filtered,
        knn_within,
        index_build,
        knn_ivf,
        knn_pruned,
        retrieve_text,
        retrieve_ann,
        retrieve_filtered,
        index_sync,
        format_context,
        assign_ids,
        append_new_chunks,
        index_diff,
        chat_split,
        rewrite_prompt,
        assemble_prompt,
        prompt_budget,
        prompt_budget_tokens,
        rag_prompts,
        rag_prompts_ann,
        rag_answers,
        rewritten_search,
        assemble_short_prompt,
        rewrite_short_prompt,
        instruct_prompt,
        strip_prompt,
        generate_batch,
        dedup_latest,
        collect_retrieval,
        merge_assessments,
        requests_with_feedback,
        eval_set_as_coded,
        eval_set_documented,
        expected_context,
        latest_per_key,
        eval_metrics,
        eval_compare,
        ingest_files,
        embed_stream,
        stream_table,
        published_view,
        corpus_to_index,
        corpus_changes,
    )
}
