"""DuckDB twins of the registered queries, over the same parquet tables."""

from __future__ import annotations

from corpusloom.functions.prompts import ANSWER_TEMPLATE, REWRITE_TEMPLATE

DIM = 64


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, **values: str) -> str:
    """SQL for a template filled in one pass."""
    pieces, rest = [], template
    while "{" in rest:
        literal, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [quoted(literal), values[name]]
    return " || ".join(p for p in [*pieces, quoted(rest)] if p != "''")


def clean(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace({text}, '\\s+', ' ', 'g'), "
        "'- +', '', 'g'), ' +([.,;:!?])', '\\1', 'g'))"
    )


def with_clause(*parts: tuple[str, str]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n"


def chunk_parts(source: str, key: str, max_tokens: int = 500, overlap: int = 10):
    """CTEs that end in ``chunks (key, chunk_idx, content, n_tokens)`` of ``source (key, text)``."""
    budget = max_tokens - overlap
    return [
        ("cleaned", f"SELECT {key}, {clean('text')} AS t FROM {source}"),
        (
            "sentences",
            f"SELECT {key}, unnest(s) AS sentence, generate_subscripts(s, 1) AS si FROM (SELECT {key}, "
            "list_filter(list_transform(regexp_extract_all(t, '[^.!?]*[.!?]+|[^.!?]+'), "
            "lambda x: trim(x)), lambda x: x <> '') AS s FROM cleaned)",
        ),
        ("worded", f"SELECT {key}, si, string_split(sentence, ' ') AS w FROM sentences"),
        (
            "cut",
            f"SELECT {key}, si, w, unnest(range(0, (len(w) + {budget - 1}) // {budget})) AS p FROM worded",
        ),
        (
            "pieces",
            f"SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY si, p) AS i, "
            f"w[p * {budget} + 1 : (p + 1) * {budget}] AS w FROM cut",
        ),
        ("sized", f"SELECT {key}, i, w, len(w) AS n FROM pieces"),
        (
            "packed",
            f"SELECT {key}, i, n AS used, 0 AS c FROM sized WHERE i = 1 UNION ALL "
            f"SELECT s.{key}, s.i, CASE WHEN p.used + s.n > {budget} THEN s.n ELSE p.used + s.n END, "
            f"CASE WHEN p.used + s.n > {budget} THEN p.c + 1 ELSE p.c END "
            f"FROM packed p JOIN sized s ON s.{key} = p.{key} AND s.i = p.i + 1",
        ),
        (
            "body",
            f"SELECT s.{key}, s.i, s.w, p.c, sum(s.n) OVER (PARTITION BY s.{key}, p.c ORDER BY s.i DESC) "
            f"AS suffix, max(p.c) OVER (PARTITION BY s.{key}) AS last_c "
            f"FROM sized s JOIN packed p ON s.{key} = p.{key} AND s.i = p.i",
        ),
        (
            "members",
            f"SELECT {key}, c, i, w FROM body UNION ALL "
            f"SELECT {key}, c + 1, i, w FROM body WHERE suffix <= {overlap} AND c < last_c",
        ),
        (
            "chunks",
            f"SELECT {key}, c::BIGINT AS chunk_idx, array_to_string(flatten(list(w ORDER BY i)), ' ') AS content, "
            f"len(flatten(list(w ORDER BY i)))::BIGINT AS n_tokens FROM members GROUP BY {key}, c",
        ),
    ]


def hash_parts(source: str, keys: str, text: str, out: str):
    """CTEs that end in ``out (keys, v)``: the hash embedding as floats."""
    return [
        (
            f"{out}_words",
            f"SELECT {keys}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS word FROM {source}",
        ),
        (
            f"{out}_slots",
            f"SELECT {keys}, ('0x' || substr(md5(word), 1, 8))::BIGINT % {DIM} AS d, "
            f"sum(CASE WHEN substr(md5(word), 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS x "
            f"FROM {out}_words GROUP BY ALL",
        ),
        (f"{out}_all", f"SELECT {keys}, unnest(range({DIM})) AS d FROM {source}"),
        (
            f"{out}_raw",
            f"SELECT {keys}, list(coalesce(x, 0.0) ORDER BY d) AS v FROM {out}_all LEFT JOIN {out}_slots "
            f"USING ({keys}, d) GROUP BY {keys}",
        ),
        (
            out,
            f"SELECT {keys}, CASE WHEN list_sum(list_transform(v, lambda x: x * x)) = 0 THEN v::FLOAT[] ELSE "
            f"list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT[] "
            f"END AS v FROM {out}_raw",
        ),
    ]


def micro(vector: str) -> str:
    return (
        f"array_to_string(list_transform({vector}, "
        "lambda x: round(x::DOUBLE * 1000000)::BIGINT::VARCHAR), ',')"
    )


def near_parts(queries: str, corpus: str, k: int, out: str, on: str = "TRUE"):
    """CTEs that end in ``out (query_id, rank, id, score)``; both sides have ``v``."""
    return [
        (f"{out}_q", f"SELECT *, sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS len FROM {queries}"),
        (f"{out}_c", f"SELECT *, sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS len FROM {corpus}"),
        (
            f"{out}_scored",
            "SELECT q.query_id, c.id, CASE WHEN q.len * c.len = 0 THEN 0.0 ELSE "
            "round(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) / (q.len * c.len), 6) END AS score "
            f"FROM {out}_q q JOIN {out}_c c ON {on}",
        ),
        (
            f"{out}_ranked",
            "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank "
            f"FROM {out}_scored",
        ),
        (out, f"SELECT query_id, rank::INTEGER AS rank, id, score + 0.0 AS score FROM {out}_ranked WHERE rank <= {k}"),
    ]


GIVEN_CELLS = [
    ("sized", "SELECT vec_id AS id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) "
     "AS len FROM embeddings"),
    ("centers", "SELECT row_number() OVER (ORDER BY id) - 1 AS cell, v AS c, len AS c_len FROM sized WHERE id < 496 AND id % 31 = 0"),
    ("away", "SELECT id, cell, sqrt(greatest(0, 2 - 2 * list_dot_product(v, c) / (len * c_len))) AS distance FROM sized, centers"),
    ("nearest", "SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, cell) AS place FROM away"),
]
VECTORS = ("vectors", "SELECT vec_id AS id, vec_id AS query_id, embedding AS v, label FROM embeddings")
NEAR = "SELECT query_id, rank, id, score FROM near"

# Numbered, embedded chunks of the documents.
ADDRESSED = ("addressed", "SELECT 'doc/' || doc_id AS url, text FROM documents")
NUMBERED = [
    ADDRESSED,
    *chunk_parts("addressed", "url"),
    (
        "numbered",
        "SELECT row_number() OVER (ORDER BY md5(url || chr(1) || chunk_idx), url, chunk_idx) AS id, "
        "url, chunk_idx, content FROM chunks",
    ),
]
CORPUS = [*NUMBERED, *hash_parts("numbered", "id", "content", "corpus")]


def retrieval_parts(queries: str, k: int = 3):
    """CTEs that end in ``near`` for ``queries (query_id, text)`` over the corpus."""
    return [
        *CORPUS,
        *hash_parts(queries, "query_id", "text", "asked"),
        *near_parts("asked", "corpus", k, "near"),
    ]


BENCHMARK = ("texts", "SELECT item_id AS query_id, text FROM benchmark")
CONTEXT = (
    "contexts",
    "SELECT query_id, string_agg('Passage: ' || content || chr(10), '' ORDER BY rank) AS context "
    "FROM near JOIN numbered USING (id) GROUP BY query_id",
)

HEADS = (
    "heads",
    "SELECT conv_id, arg_max(text, turn) AS question, arg_min(text, turn) AS opening, max(turn) AS last_turn, min(turn) < max(turn) AS has_history "
    "FROM conversations GROUP BY conv_id",
)
HISTORY = (
    "history",
    "SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN heads h "
    "ON c.conv_id = h.conv_id AND c.turn < h.last_turn",
)
PIECES = (
    "pieces",
    "SELECT conv_id, turn // 256 AS piece, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS lines "
    "FROM history GROUP BY ALL",
)
REWRITE_BEFORE, REWRITE_AFTER = REWRITE_TEMPLATE.split("{chat_history}")


def assembled(contexts: str) -> str:
    system = filled(ANSWER_TEMPLATE, context="coalesce(context, '')", question="question")
    return (
        f"SELECT conv_id, 0::BIGINT AS seq, 'system' AS role, {system} AS content "
        f"FROM heads LEFT JOIN {contexts} USING (conv_id) "
        "UNION ALL SELECT conv_id, turn + 1, role, text FROM history WHERE role IN ('user', 'assistant') "
        "UNION ALL SELECT conv_id, last_turn + 1, 'user', question FROM heads"
    )


FIRST_CONTEXT = (
    "first_context",
    "SELECT conv_id, 'Passage: ' || arg_min(text, turn) || chr(10) AS context FROM conversations GROUP BY conv_id",
)
RAG = [
    HEADS,
    HISTORY,
    (
        "texts",
        "SELECT conv_id AS query_id, CASE WHEN has_history THEN opening || chr(10) || question ELSE question END "
        "AS text FROM heads",
    ),
    *retrieval_parts("texts"),
    CONTEXT,
    ("named", "SELECT query_id AS conv_id, context FROM contexts"),
]

REQUESTS = (
    "requests",
    "SELECT 'r' || conv_id AS log_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS request, "
    "arg_max(text, turn) FILTER (WHERE role = 'assistant') AS response FROM conversations GROUP BY conv_id",
)
LOG = (
    "log",
    """SELECT event_id, 'r' || user_id AS request_id, 'u' || (hour(ts) // 8) AS user_id, ts,
    CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' WHEN 'view' THEN 'unsure' END AS verdict,
    CASE WHEN value > 60 THEN 'edit' || event_id ELSE '' END AS suggested_output,
    CASE event_type WHEN 'click' THEN 'positive' WHEN 'signup' THEN 'negative' END AS passage_verdict,
    'src' || right(regexp_extract(props, '[0-9]+'), 1) AS doc_uri,
    's' || (regexp_extract(props, '[0-9]+')::INT // 25) AS step_id
    FROM events WHERE event_type IN ('purchase', 'error', 'view', 'click', 'signup')""",
)
LATEST = (
    "latest",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) AS rn "
    "FROM log WHERE verdict IS NOT NULL) WHERE rn = 1",
)
COLLECTED = (
    "collected",
    "SELECT request_id, user_id, step_id, doc_uri, passage_verdict AS value, count(*) AS n, max(ts) AS ts "
    "FROM log WHERE passage_verdict IS NOT NULL GROUP BY ALL",
)
STEPS = (
    "steps",
    "SELECT request_id, user_id, step_id, sum(n)::BIGINT AS n_assessments, count(*) AS n_distinct, max(ts) AS ts, "
    "string_agg(concat_ws(':', doc_uri, value, n), ',' ORDER BY doc_uri NULLS FIRST, value) AS passages FROM collected GROUP BY ALL",
)
MERGED = (
    "merged",
    "SELECT l.request_id, l.user_id, l.verdict, l.suggested_output, c.step_id, c.n_assessments, c.n_distinct, c.passages FROM latest l FULL JOIN steps c "
    "ON l.request_id = c.request_id AND l.user_id = c.user_id",
)
# What a verdict makes of a rated row: its label, and whose text is expected. Any other
# verdict counts as the last one.
VERDICTS = (
    "verdicts",
    "SELECT unnest(['positive', 'negative', 'other']) AS kind, unnest(['model', 'editor', 'editor']) AS author, "
    "unnest(['thumbs_up', 'thumbs_down', 'no_feedback_provided']) AS label",
)
CODED = """SELECT rated.request_id, request, if(author = 'model', response, nullif(suggested_output, '')) AS expected_response,
label AS type, user_id FROM (SELECT *, if(verdict IN ('positive', 'negative'), verdict, 'other') AS kind
FROM merged WHERE verdict IS NOT NULL) rated JOIN verdicts USING (kind) JOIN requests ON log_id = rated.request_id"""
FEEDBACK = [REQUESTS, LOG, LATEST, COLLECTED, STEPS, MERGED, VERDICTS]
DOCUMENTED = """SELECT a.request_id, r.request, CASE WHEN a.suggested_output <> '' THEN a.suggested_output
WHEN a.verdict = 'positive' THEN r.response END AS expected_response,
CASE a.verdict WHEN 'positive' THEN 'thumbs_up' WHEN 'negative' THEN 'thumbs_down' ELSE 'no_feedback_provided' END AS type, a.user_id
FROM merged a JOIN requests r ON a.request_id = r.log_id WHERE a.verdict IS NOT NULL
UNION ALL SELECT log_id, request, NULL, 'no_feedback_provided', NULL FROM requests
WHERE log_id NOT IN (SELECT request_id FROM log)"""
EXPECTED = "SELECT DISTINCT request_id, doc_uri FROM log WHERE passage_verdict = 'positive'"


def words_of(text: str) -> str:
    return f"list_filter(string_split({clean(f'lower({text})')}, ' '), lambda w: w <> '')"


def metric_parts(run: str, near: str, answers: str):
    """CTEs that end in ``run (type, metric, value)``."""
    names = ["exact_match", "token_f1", "recall_at_k", "precision_at_k"]
    means = ", ".join(
        f"round(sum({n} * n) / sum(n) FILTER (WHERE {n} IS NOT NULL), 6) AS {n}" for n in names
    )
    return [
        (f"{run}_answers", answers),
        (
            f"{run}_pairs",
            f"SELECT DISTINCT request_id, expected_response, answer FROM coded LEFT JOIN {run}_answers USING (request_id) "
            "WHERE expected_response IS NOT NULL",
        ),
        (
            f"{run}_left",
            f"SELECT request_id, expected_response, w, count(*) AS a FROM (SELECT request_id, expected_response, "
            f"unnest({words_of('answer')}) AS w FROM {run}_pairs) GROUP BY ALL",
        ),
        (
            f"{run}_right",
            f"SELECT request_id, expected_response, w, count(*) AS b FROM (SELECT request_id, expected_response, "
            f"unnest({words_of('expected_response')}) AS w FROM {run}_pairs) GROUP BY ALL",
        ),
        (
            f"{run}_overlap",
            f"SELECT request_id, expected_response, 2.0 * sum(least(coalesce(a, 0), coalesce(b, 0))) / "
            f"(sum(coalesce(a, 0)) + sum(coalesce(b, 0))) AS f1 FROM {run}_left FULL JOIN {run}_right "
            "USING (request_id, expected_response, w) GROUP BY ALL",
        ),
        (
            f"{run}_scores",
            f"SELECT request_id, expected_response, coalesce(answer = expected_response, FALSE)::INT::DOUBLE AS exact_match, "
            f"coalesce(f1, 0.0) AS token_f1 FROM {run}_pairs LEFT JOIN {run}_overlap "
            "USING (request_id, expected_response)",
        ),
        (
            f"{run}_hits",
            f"SELECT DISTINCT 'r' || query_id AS request_id, d.source AS doc_uri FROM {near} JOIN numbered USING (id) "
            "JOIN documents d ON 'doc/' || d.doc_id = url",
        ),
        (
            f"{run}_retrieval",
            f"SELECT e.request_id, count(h.doc_uri) / count(*) AS recall_at_k, coalesce(count(h.doc_uri) / any_value(m), 0.0) "
            f"AS precision_at_k FROM expected e LEFT JOIN {run}_hits h USING (request_id, doc_uri) LEFT JOIN "
            f"(SELECT request_id, count(*) AS m FROM {run}_hits GROUP BY 1) USING (request_id) GROUP BY 1",
        ),
        (
            f"{run}_rows",
            f"SELECT * FROM (SELECT request_id, type, expected_response, count(*) AS n FROM coded GROUP BY ALL) LEFT JOIN "
            f"{run}_scores USING (request_id, expected_response) LEFT JOIN {run}_retrieval USING (request_id)",
        ),
        (f"{run}_wide", f"SELECT type, sum(n)::DOUBLE AS rows, {means} FROM {run}_rows GROUP BY type"),
        (
            run,
            " UNION ALL ".join(
                f"SELECT type, '{n}' AS metric, {n}::DOUBLE AS value FROM {run}_wide" for n in ["rows", *names]
            ),
        ),
    ]


EVALUATED = [
    *FEEDBACK,
    ("coded", CODED),
    ("expected", EXPECTED),
    ("texts", "SELECT substr(log_id, 2)::BIGINT AS query_id, request AS text FROM requests"),
    *retrieval_parts("texts"),
    ("near_first", "SELECT * FROM near WHERE rank = 1"),
]
BEST_PASSAGE = "SELECT 'r' || query_id AS request_id, content AS answer FROM near_first JOIN numbered USING (id)"
LOGGED = "SELECT log_id AS request_id, response AS answer FROM requests WHERE response IS NOT NULL"

ARTICLE = "trim(regexp_extract(html, '(?s)<article(?:\\s[^>]*)?>.*?</article>'))"


def visible(html: str) -> str:
    no_code = f"regexp_replace({html}, '(?s)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g')"
    text = f"regexp_replace({no_code}, '<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return clean(text)


LINES = f"array_to_string(list_transform(string_split({{}}, chr(10)), lambda p: {clean('p')}), chr(10) || chr(10))"
SITEMAP = "SELECT page_id // 1000 AS sitemap, row_number() OVER (PARTITION BY page_id // 1000 ORDER BY page_id) - 1 AS pos, url FROM pages"

ORACLE = {
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "join_pages": f"SELECT doc_id, {LINES.format('text')} AS text FROM documents",
    "chunk_sentences": with_clause(*chunk_parts("documents", "doc_id"))
    + "SELECT doc_id, chunk_idx, content, n_tokens FROM chunks",
    "chunk_tokens": with_clause(
        *chunk_parts("documents", "doc_id")[:2],
        (
            "cut",
            "SELECT doc_id, si, sentence, unnest(CASE WHEN (length(sentence) + 4) // 4 <= 490 THEN [0] ELSE "
            "range(0, (length(sentence) + 1955) // 1956) END) AS p, (length(sentence) + 4) // 4 <= 490 AS whole FROM sentences",
        ),
        (
            "pieces",
            "SELECT * FROM (SELECT doc_id, si, p, CASE WHEN whole THEN sentence ELSE trim(substr(sentence, p * 1956 + 1, 1956)) END AS t "
            "FROM cut) WHERE t <> ''",
        ),
        ("sized", "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY si, p) AS i, t, (length(t) + 4) // 4 AS n FROM pieces"),
        (
            "packed",
            "SELECT doc_id, i, n AS used, 0 AS c FROM sized WHERE i = 1 UNION ALL SELECT s.doc_id, s.i, "
            "CASE WHEN k.used + s.n > 490 THEN s.n ELSE k.used + s.n END, CASE WHEN k.used + s.n > 490 THEN k.c + 1 ELSE k.c END "
            "FROM packed k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i + 1",
        ),
        (
            "body",
            "SELECT doc_id, i, t, c, sum(n) OVER (PARTITION BY doc_id, c ORDER BY i DESC) AS suffix, "
            "max(c) OVER (PARTITION BY doc_id) AS last_c FROM sized JOIN packed USING (doc_id, i)",
        ),
        (
            "members",
            "SELECT doc_id, c, i, t FROM body UNION ALL SELECT doc_id, c + 1, i, t FROM body WHERE suffix <= 10 AND c < last_c",
        ),
        ("joined", "SELECT doc_id, c::BIGINT AS chunk_idx, string_agg(t, ' ' ORDER BY i) AS content FROM members GROUP BY doc_id, c"),
    )
    + "SELECT doc_id, chunk_idx, content, (length(content) + 3) // 4 AS n_tokens FROM joined",
    "prompt_budget_tokens": with_clause(HEADS, HISTORY, FIRST_CONTEXT, ("rows_", assembled("first_context")))
    + "SELECT conv_id, sum((length(content) + 3) // 4)::BIGINT AS prompt_tokens, "
    "sum((length(content) + 3) // 4) + 1500 <= 4096 AS fits FROM rows_ GROUP BY conv_id",
    "chunk_windows": with_clause(
        ("worded", f"SELECT doc_id, string_split({clean('text')}, ' ') AS w FROM documents WHERE {clean('text')} <> ''"),
        (
            "cut",
            "SELECT doc_id, w, unnest(range(0, greatest(1, ceil((len(w) - 10) / 90.0)::BIGINT))) AS p FROM worded",
        ),
    )
    + "SELECT doc_id, p AS chunk_idx, array_to_string(w[p * 90 + 1 : p * 90 + 100], ' ') AS content, "
    "len(w[p * 90 + 1 : p * 90 + 100])::BIGINT AS n_tokens FROM cut",
    "extract_article": f"SELECT page_id, nullif(article, '') AS article, {visible('nullif(article, chr(0))')} AS article_text "
    f"FROM (SELECT page_id, {ARTICLE} AS article FROM pages)",
    "nested_article": "SELECT page_id, '<div itemprop=\"articleBody\"><div>' || substr(article, 10, length(article) - 19) "
    f"|| '</div></div>' AS article FROM (SELECT page_id, {ARTICLE} AS article FROM pages)",
    "extract_text": f"SELECT page_id, CASE WHEN NOT contains(html, '%%%') THEN {LINES.format('html')} END AS text, "
    "CASE WHEN contains(html, '%%%') THEN 'ValueError: unreadable characters' END AS error FROM pages",
    "pages_corpus": f"SELECT url, text FROM (SELECT url, {ARTICLE} AS text FROM pages) WHERE text <> ''",
    "sitemap_urls": SITEMAP,
    "sitemap_head": f"SELECT * FROM ({SITEMAP}) ORDER BY sitemap, pos LIMIT 100",
    "listing_filter": "SELECT page_id, url, file_name FROM (SELECT page_id, url, string_split(url, '/')[-1] AS file_name "
    "FROM pages) WHERE NOT contains(file_name, 'html')",
    "preview_like": "SELECT page_id, url FROM pages WHERE url LIKE '%.html' ORDER BY page_id LIMIT 10",
    "embed_batch": with_clause(*hash_parts("documents", "doc_id", "text", "embedded"))
    + f"SELECT 'doc/' || doc_id AS url, length(text) AS n_chars, {micro('v')} AS embedding "
    "FROM embedded JOIN documents USING (doc_id)",
    "embed_query": with_clause(*hash_parts("benchmark", "item_id", "text", "embedded"))
    + f"SELECT item_id, {micro('v')} AS embedding FROM embedded",
    "knn_exact": with_clause(
        VECTORS,
        (
            "means",
            "SELECT label::BIGINT AS query_id, list(x ORDER BY pos) AS v FROM (SELECT label, pos, avg(x::DOUBLE) AS x FROM "
            "(SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vectors) GROUP BY ALL) GROUP BY label",
        ),
        *near_parts("means", "vectors", 3, "near"),
    )
    + NEAR,
    "knn_filtered": with_clause(
        ("allowed", "SELECT doc_id AS id, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0"),
        BENCHMARK,
        *hash_parts("allowed", "id", "text", "corpus"),
        *hash_parts("texts", "query_id", "text", "asked"),
        *near_parts("asked", "corpus", 3, "near"),
    )
    + NEAR,
    "knn_within": with_clause(VECTORS, *near_parts("vectors", "vectors", 3, "near", "q.label = c.label")) + NEAR,
    "knn_pruned": with_clause(VECTORS, *near_parts("vectors", "vectors", 3, "near")) + NEAR,
    "index_build": with_clause(*GIVEN_CELLS)
    + "SELECT id, cell::BIGINT AS cell, round(distance, 6) + 0.0 AS distance FROM nearest WHERE place = 1",
    "knn_ivf": with_clause(
        *GIVEN_CELLS,
        ("held", "SELECT s.id, s.v, n.cell FROM sized s JOIN nearest n ON s.id = n.id AND place = 1"),
        ("asked", "SELECT s.id AS query_id, s.v, n.cell FROM sized s JOIN nearest n ON s.id = n.id AND place <= 8"),
        *near_parts("asked", "held", 3, "near", "q.cell = c.cell"),
    )
    + NEAR,
    "index_sync": f"SELECT vec_id AS id, label, {micro('embedding')} AS embedding FROM embeddings WHERE vec_id % 11 <> 0",
    "retrieve_filtered": with_clause(
        BENCHMARK,
        *CORPUS,
        ("long_enough", "SELECT corpus.* FROM corpus JOIN numbered USING (id) WHERE len(string_split(content, ' ')) >= 120"),
        *hash_parts("texts", "query_id", "text", "asked"),
        *near_parts("asked", "long_enough", 3, "near"),
    )
    + "SELECT query_id, rank, id, url, content, score FROM near JOIN numbered USING (id)",
    "retrieve_text": with_clause(BENCHMARK, *retrieval_parts("texts"))
    + "SELECT query_id, rank, id, url, content, score FROM near JOIN numbered USING (id)",
    "format_context": with_clause(BENCHMARK, *retrieval_parts("texts"), CONTEXT) + "SELECT query_id, context FROM contexts",
    "assign_ids": with_clause(*NUMBERED) + "SELECT id, url, chunk_idx FROM numbered",
    "append_new_chunks": with_clause(ADDRESSED, *chunk_parts("addressed", "url"))
    + "SELECT url, chunk_idx, content, n_tokens FROM chunks WHERE url NOT IN (SELECT 'doc/' || doc_id FROM labels)",
    "index_diff": with_clause(
        ("older", "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"),
        (
            "newer",
            f"SELECT doc_id, {clean('text')} AS text FROM documents WHERE doc_id NOT IN "
            "(SELECT doc_id FROM labels WHERE toxic = 1)",
        ),
    )
    + "SELECT doc_id, CASE WHEN o.text IS NULL THEN 'insert' WHEN n.text IS NULL THEN 'delete' ELSE 'update' END AS change, "
    "n.text AS text FROM older o FULL JOIN newer n USING (doc_id) WHERE o.text IS DISTINCT FROM n.text",
    "chat_split": with_clause(HEADS, HISTORY)
    + "SELECT conv_id, turn, role, text, 'history' AS part FROM history WHERE role IN ('user', 'assistant') UNION ALL "
    "SELECT c.conv_id, turn, role, text, 'question' FROM conversations c JOIN heads h ON c.conv_id = h.conv_id AND turn = last_turn",
    "rewrite_prompt": with_clause(HEADS, HISTORY, PIECES)
    + f"SELECT conv_id, piece, CASE WHEN piece = min(piece) OVER (PARTITION BY conv_id) THEN {quoted(REWRITE_BEFORE)} "
    f"ELSE chr(10) END || lines || CASE WHEN piece = max(piece) OVER (PARTITION BY conv_id) THEN "
    f"{filled(REWRITE_AFTER, question='question')} ELSE '' END AS text FROM pieces JOIN heads USING (conv_id)",
    "assemble_prompt": with_clause(HEADS, HISTORY, FIRST_CONTEXT) + assembled("first_context"),
    "prompt_budget": with_clause(HEADS, HISTORY, FIRST_CONTEXT, ("rows_", assembled("first_context")))
    + "SELECT conv_id, sum(len(regexp_extract_all(content, '\\S+')))::BIGINT AS prompt_tokens, "
    "sum(len(regexp_extract_all(content, '\\S+'))) + 1500 <= 4096 AS fits FROM rows_ GROUP BY conv_id",
    "rag_prompts": with_clause(*RAG) + assembled("named"),
    "rag_answers": with_clause(
        *RAG,
        ("rows_", assembled("named")),
        (
            "requests",
            "SELECT conv_id, max(content) FILTER (WHERE seq = 0) AS s, "
            "string_agg(role || ': ' || content, chr(10) ORDER BY seq) FILTER (WHERE seq > 0) AS p FROM rows_ GROUP BY conv_id",
        ),
        ("wrapped", "SELECT conv_id, '<s>[INST]<<SYS>>' || chr(10) || s || chr(10) || '<</SYS>>' || chr(10) || chr(10) || chr(10) || p || '[/INST]' || chr(10) AS f FROM requests"),
    )
    + "SELECT conv_id, 't=0.01 ' || array_to_string(list_slice(regexp_extract_all(f, '\\S+'), 1, 40), ' ') AS answer FROM wrapped",
    "rewritten_search": with_clause(
        HEADS,
        HISTORY,
        ("told", "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS lines FROM history GROUP BY conv_id"),
        (
            "ends",
            "SELECT conv_id, regexp_extract_all(right('Chat history: ' || lines || chr(10) || chr(10) || 'Question: ' || question, 200), "
            "'\\S+') AS w FROM told JOIN heads USING (conv_id)",
        ),
    )
    + "SELECT conv_id, coalesce(array_to_string(w[greatest(1, len(w) - 4):len(w)], ' '), question) AS search_text "
    "FROM heads LEFT JOIN ends USING (conv_id)",
    "assemble_short_prompt": with_clause(HEADS, HISTORY, FIRST_CONTEXT)
    + "SELECT conv_id, 0::BIGINT AS seq, 'system' AS role, 'Q: ' || question || chr(10) || 'Use {only} this: ' || context || chr(10) "
    "|| 'Q again: ' || question AS content FROM heads JOIN first_context USING (conv_id) "
    "UNION ALL SELECT conv_id, turn + 1, role, text FROM history WHERE role IN ('user', 'assistant') "
    "UNION ALL SELECT conv_id, last_turn + 1, 'user', question FROM heads",
    "rewrite_short_prompt": with_clause(HEADS, HISTORY, PIECES)
    + "SELECT conv_id, piece, CASE WHEN piece = min(piece) OVER (PARTITION BY conv_id) THEN question || chr(10) || '--' || chr(10) "
    "ELSE chr(10) END || lines || CASE WHEN piece = max(piece) OVER (PARTITION BY conv_id) THEN chr(10) || '--' || chr(10) || "
    "'Shorter, please.' ELSE '' END AS text FROM pieces JOIN heads USING (conv_id)",
    "instruct_prompt": "SELECT doc_id, '<s>[INST]<<SYS>>' || chr(10) || 'Answer in ' || lang || '.' || chr(10) || '<</SYS>>' "
    "|| chr(10) || chr(10) || chr(10) || text || '[/INST]' || chr(10) AS prompt FROM documents",
    "strip_prompt": "SELECT conv_id, turn, text AS answer FROM conversations",
    "generate_batch": "SELECT conv_id, turn, text || 't=' || CASE WHEN role = 'user' THEN '0.25' ELSE '1.00' END || ' ' || "
    "array_to_string(list_slice(regexp_extract_all(text, '\\S+'), 1, CASE WHEN role <> 'system' THEN turn + 1 ELSE 100 END), ' ') "
    "AS output FROM conversations",
    "dedup_latest": with_clause(LOG, LATEST)
    + "SELECT request_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, verdict, suggested_output, "
    "'1' AS schema_version FROM latest",
    "collect_retrieval": with_clause(LOG, COLLECTED, STEPS)
    + "SELECT request_id, user_id, step_id, n_assessments, n_distinct, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, passages FROM steps",
    "merge_assessments": with_clause(LOG, LATEST, COLLECTED, STEPS, MERGED)
    + "SELECT request_id, user_id, verdict, step_id, n_assessments, n_distinct, passages FROM merged",
    "requests_with_feedback": with_clause(*FEEDBACK)
    + "SELECT log_id, request, request_id, user_id, verdict, step_id, n_assessments, n_distinct, passages FROM requests LEFT JOIN merged "
    "ON log_id = request_id",
    "eval_set_as_coded": with_clause(*FEEDBACK) + CODED,
    "eval_set_documented": with_clause(*FEEDBACK) + DOCUMENTED,
    "expected_context": with_clause(LOG) + EXPECTED,
    "latest_per_key": "SELECT site, version, page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY "
    "version::BIGINT DESC, page_id DESC) AS rn FROM (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS site, "
    "regexp_extract(url, '/([0-9]+)', 1) AS version, page_id, url FROM pages)) WHERE rn = 1",
    "eval_metrics": with_clause(*EVALUATED, *metric_parts("now_", "near", BEST_PASSAGE))
    + "SELECT type, metric, value FROM now_",
    "eval_compare": with_clause(
        *EVALUATED, *metric_parts("now_", "near", BEST_PASSAGE), *metric_parts("then_", "near_first", LOGGED)
    )
    + "SELECT type, metric, n.value AS current_value, t.value AS previous_value, round(n.value - t.value, 6) AS delta, "
    "coalesce(metric <> 'rows' AND round(n.value - t.value, 6) < 0, FALSE) AS regressed FROM now_ n FULL JOIN then_ t USING (type, metric)",
    "ingest_files": "SELECT octet_length(encode(html)) + 1 AS length, md5(html || chr(10)) AS digest FROM pages",
    "published_view": "SELECT lang, count(*) AS documents, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang",
    "corpus_changes": with_clause(
        (
            "landed",
            "SELECT page_id % 50 AS part, string_agg(CASE WHEN page_id % 50 % 3 = 0 THEN replace(html, 'e', 'o') ELSE html END, "
            "chr(10) ORDER BY page_id) AS html FROM pages GROUP BY 1",
        ),
        ("source", f"SELECT part, {LINES.format('html')} AS text FROM landed"),
        *chunk_parts("source", "part"),
        *hash_parts("chunks", "part, chunk_idx", "content", "embedded"),
    )
    + f"SELECT chunk_idx, n_tokens, md5(content) AS digest, {micro('v')} AS embedding FROM chunks JOIN embedded USING (part, chunk_idx)",
    "corpus_to_index": with_clause(
        ("source", f"SELECT page_id, {LINES.format('html')} AS text FROM pages"),
        *chunk_parts("source", "page_id"),
        *hash_parts("chunks", "page_id, chunk_idx", "content", "embedded"),
    )
    + f"SELECT chunk_idx, n_tokens, md5(content) AS digest, {micro('v')} AS embedding FROM chunks JOIN embedded USING (page_id, chunk_idx)",
}
ORACLE["embed_stream"] = ORACLE["embed_batch"]
ORACLE["retrieve_ann"] = ORACLE["retrieve_text"]
ORACLE["rag_prompts_ann"] = ORACLE["rag_prompts"]
ORACLE["stream_table"] = ORACLE["clean_text"]
