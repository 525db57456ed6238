"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
statement per operator.  Every query reads the driver tables of ``sf_dir``.

Table roles: ``documents`` = txt corpus (subject = language folder),
``pages`` = html corpus, ``embeddings`` = vectors with a label, ``benchmark`` =
user questions, ``conversations`` = LLM requests (one per conversation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.text import normalise_whitespace, stable_id, token_count
from vellum.functions.vectors import as_double_vector, cosine, dot, hash_vector
from vellum.operators.chunker import split_documents
from vellum.operators.context import assemble_context, budgeted_blocks, document_block
from vellum.operators.embed import HASH_MODEL, HashEmbedder, embed_batches, global_row_number, hash_embed, token_guard
from vellum.operators.embed_cached import attach_embeddings, cached_embeddings
from vellum.operators.generate import (CHAT_PROVIDERS, SUPPORTED_MODELS, admit_embedding_providers, admit_requests, allow_list,
                                       echo_responder, generate, generate_recorded, request_configs)
from vellum.operators.retrieve import RANK_PLACES, rank_key, rank_top_k, render, score_sets, top_k_single
from vellum.operators.usage import append_usage, cost_rates, read_usage, usage_by_model, usage_cost
from vellum.plans import sql as S
from vellum.plans.build import CHUNK_ORDER, build_database, chunk_corpus
from vellum.plans.retrieval import embed_questions, retrieval_prompts, retrieve
from vellum.session import read_table, shared_path, table_path
from vellum.sources.corpus import (admitted, corpus_files_from_tables, file_format, load_corpus,
                                   load_html, load_pdf, load_text)
from vellum.sources.shared_files import modified
from vellum.sources.store import read_store, write_store

Query = Callable[[SparkSession, str], DataFrame]

K, THRESHOLD, BUDGET = 5, 0.15, 2048
META = ["meta_source", "meta_title", "meta_path", "meta_page"]


def _meta() -> list[Column]:
    return [F.col("metadata.source").alias("meta_source"), F.col("metadata.title").alias("meta_title"),
            F.col("metadata.path").alias("meta_path"), F.col("metadata.page").alias("meta_page")]


def vec_text(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: F.format_string("%.6f", x)), ",")


# --- shared Spark sub-plans ------------------------------------------------------

def files(spark, sf):
    return corpus_files_from_tables(spark, sf)


def txt_docs(spark, sf):
    return load_text(corpus_files_from_tables(spark, sf, include_pages=False, keep_ids=True))


def corpus_docs(spark, sf):
    return load_corpus(files(spark, sf), include_pdf=False)


def norm_corpus(spark, sf):
    return corpus_docs(spark, sf).withColumn("page_content", normalise_whitespace("page_content"))


def doc_chunks(spark, sf, size=512, overlap=64, min_length=0):
    docs = txt_docs(spark, sf).withColumn("page_content", normalise_whitespace("page_content"))
    return split_documents(docs, "page_content", size, overlap, min_length)


def corpus_chunks(spark, sf):
    return chunk_corpus(norm_corpus(spark, sf), 512, 64)


def store(spark, sf):
    return build_database(files(spark, sf), include_pdf=False)


def questions(spark, sf):
    return embed_questions(read_table(spark, sf, "benchmark"))


def label_db(spark, sf):
    return read_table(spark, sf, "embeddings").select(
        "vec_id", "label", as_double_vector("embedding").alias("embedding"))


_stores: dict[tuple, str] = {}


def store_path(spark, sf):
    """The store of this data folder, built and written once per application and state of its
    tables (gzip Parquet by subject): what only reads a store does not build it."""
    state = tuple(modified(spark, table_path(sf, name)) for name in ("documents", "pages"))
    key = (spark.sparkContext.applicationId, sf, state)
    if key not in _stores:
        path = shared_path(spark, "store", unique=True)
        write_store(store(spark, sf), path)
        _stores[key] = path
    return _stores[key]


def written_store(spark, sf):
    return read_store(spark, store_path(spark, sf))


def one_query_set(spark, sf):
    """All benchmark questions as phrasings of one question."""
    return questions(spark, sf).withColumn("query_set_id", F.lit(0).cast("bigint"))


def one_set_scores(spark, sf, threshold):
    return score_sets(written_store(spark, sf), one_query_set(spark, sf), k=None, threshold=threshold, dim=64)


def set_topk(spark, sf):
    return rank_top_k(score_sets(written_store(spark, sf), questions(spark, sf), k=K, threshold=THRESHOLD, dim=64), K)


def text_results(spark, sf):
    return retrieve(written_store(spark, sf), questions(spark, sf), k=K, threshold=THRESHOLD)


def requests(spark, sf):
    conv = read_table(spark, sf, "conversations")
    tok = token_count("text")
    per = conv.groupBy("conv_id").agg(
        F.sum(F.when(F.col("role").isin("system", "user"), tok).otherwise(0)).cast("bigint").alias("prompt_tokens"),
        F.sum(F.when(F.col("role") == "assistant", tok).otherwise(0)).cast("bigint").alias("completion_tokens"))
    models = F.array(*[F.lit(m) for m in SUPPORTED_MODELS + ["unlisted-model"]])
    providers = F.array(*[F.lit(p) for p in CHAT_PROVIDERS + ["huggingface", "OpenAI"]])
    return per.select(
        "conv_id",
        F.element_at(models, (F.pmod("conv_id", F.lit(len(SUPPORTED_MODELS) + 1)) + 1).cast("int")).alias("model"),
        F.element_at(providers, (F.pmod("conv_id", F.lit(4)) + 1).cast("int")).alias("provider"),
        F.when(F.pmod("conv_id", F.lit(2)) == 0, F.lit(0.0)).otherwise(F.lit(0.1)).alias("temperature"),
        F.when(F.pmod("conv_id", F.lit(3)) == 0, F.lit(512))
         .when(F.pmod("conv_id", F.lit(3)) == 1, F.lit(1024)).otherwise(F.lit(2048)).alias("max_tokens"),
        "prompt_tokens", "completion_tokens")


def usage_facts(spark, sf):
    adm = admit_requests(requests(spark, sf), allow_list(spark)).where("admitted")
    return adm.select(F.col("conv_id").cast("string").alias("request_id"), "model",
                      "prompt_tokens", "completion_tokens")


# --- SQL helpers -------------------------------------------------------------------

def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip())


MODELS_SQL = "[" + ", ".join(S.q(m) for m in S.MODELS + ["unlisted-model"]) + "]"
PROVIDERS_SQL = "[" + ", ".join(S.q(p) for p in S.PROVIDERS + ["huggingface", "OpenAI"]) + "]"
SUPPORTED_SQL = ", ".join(S.q(m) for m in S.MODELS)

REQUESTS_SQL = f"""
requests AS (
  SELECT conv_id,
         {MODELS_SQL}[(conv_id % 10) + 1] AS model,
         {PROVIDERS_SQL}[(conv_id % 4) + 1] AS provider,
         CASE WHEN conv_id % 2 = 0 THEN 0.0 ELSE 0.1 END::DOUBLE AS temperature,
         CASE WHEN conv_id % 3 = 0 THEN 512 WHEN conv_id % 3 = 1 THEN 1024 ELSE 2048 END AS max_tokens,
         CAST(sum(CASE WHEN role IN ('system', 'user') THEN {S.token_count('text')} ELSE 0 END) AS BIGINT) AS prompt_tokens,
         CAST(sum(CASE WHEN role = 'assistant' THEN {S.token_count('text')} ELSE 0 END) AS BIGINT) AS completion_tokens
  FROM conversations GROUP BY conv_id),
admission AS (
  SELECT *, CASE WHEN model NOT IN ({SUPPORTED_SQL}) THEN {S.q(S.MODEL_ERROR)}
                 WHEN provider NOT IN ('AzureOpenAI', 'HuggingFace')
                 THEN 'Unsupported provider: ' || provider || '. Supported providers: AzureOpenAI, HuggingFace'
            END AS error
  FROM requests),
usage AS (
  SELECT CAST(conv_id AS VARCHAR) AS request_id, model, prompt_tokens, completion_tokens
  FROM admission WHERE error IS NULL),
rates(model, prompt_rate, completion_rate) AS (
  VALUES ('gpt-4o', 0.0000045::DECIMAL(12,9), 0.0000135::DECIMAL(12,9)),
         ('gpt-35-turbo', 0.0000018::DECIMAL(12,9), 0.0000018::DECIMAL(12,9)),
         ('gpt-35-turbo-16k', 0.0000027::DECIMAL(12,9), 0.0000036::DECIMAL(12,9)))"""


BLOCK_SQL = ("'Metadata: ' || coalesce(to_json({'source': meta_source, 'title': meta_title, "
             "'path': meta_path, 'page': meta_page}), '') || chr(10) || 'Content: ' || content || chr(10) || chr(10)")

CONTEXT_SQL = f"""
blocks AS (SELECT query_set_id, rank, {BLOCK_SQL} AS block FROM text_results),
kept AS (
  SELECT * FROM (SELECT query_set_id, rank, block,
                        CAST(sum(length(block)) OVER (PARTITION BY query_set_id ORDER BY rank
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_length
                 FROM blocks) WHERE running_length <= {BUDGET}),
contexts AS (SELECT query_set_id, string_agg(block, '' ORDER BY rank) AS context FROM kept GROUP BY query_set_id),
prompts AS (
  SELECT q.query_set_id, q.question, coalesce(c.context, '') AS context,
         {S.prompt('c.context', 'q.question')} AS prompt
  FROM question_src q LEFT JOIN contexts c ON q.query_set_id = c.query_set_id)"""


# --- the registry ---------------------------------------------------------------------

def _registry() -> dict[str, tuple[Query, str | None]]:
    R: dict[str, tuple[Query, str | None]] = {}

    # S1 corpus scan (driver tables as files)
    R["corpus_scan"] = (
        lambda sp, sf: files(sp, sf).select("subject", "path", "format"),
        _with(S.PAGE_FILES) + """
SELECT lang AS subject, printf('corpus/%s/doc-%d.txt', lang, doc_id) AS path, 'txt' AS format FROM documents
UNION ALL
SELECT subject, printf('corpus/%s/page-%d.html', subject, page_id) AS path, 'html' AS format FROM page_files""")

    # S2 format admission on page urls
    R["format_admission"] = (
        lambda sp, sf: read_table(sp, sf, "pages").select(
            "page_id", admitted("url").alias("admitted"), file_format("url").alias("format")),
        r"""SELECT page_id, regexp_matches(lower(url), '\.(pdf|html|txt)$') AS admitted,
       regexp_extract(lower(url), '\.(pdf|html|txt)$', 1) AS format FROM pages""")

    # S3 txt loader
    R["load_text"] = (
        lambda sp, sf: txt_docs(sp, sf).select("doc_id", "subject", "path", "page_content", *_meta()),
        _with(S.TXT_DOCS) + " SELECT doc_id, subject, path, page_content, " + ", ".join(META) + " FROM txt_docs")

    # S4 html loader: text and title
    R["html_text"] = (
        lambda sp, sf: load_html(files(sp, sf)).select("subject", "path", "page_content"),
        _with(S.PAGE_FILES, S.HTML_DOCS) + " SELECT subject, path, page_content FROM html_docs")
    R["html_title"] = (
        lambda sp, sf: load_html(files(sp, sf)).select("path", F.col("metadata.source").alias("meta_source"),
                                                      F.col("metadata.title").alias("meta_title")),
        _with(S.PAGE_FILES, S.HTML_DOCS) + " SELECT path, meta_source, meta_title FROM html_docs")

    # S5 pdf pages (four documents of a language as one form-feed paged file, user extractor)
    def pdf_files(sp, sf):
        pages = read_table(sp, sf, "documents").groupBy("lang", F.floor(F.col("doc_id") / 4).alias("n")).agg(
            F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("p"))
        return pages.select(
            F.col("lang").alias("subject"), F.format_string("corpus/%s/doc-%d.pdf", F.col("lang"), F.col("n")).alias("path"),
            F.lit("pdf").alias("format"),
            F.encode(F.array_join(F.transform("p", lambda x: x["text"]), "\f"), "UTF-8").alias("content"))
    R["pdf_pages"] = (
        lambda sp, sf: load_pdf(pdf_files(sp, sf)).select("path", "page", "page_content",
                                                          F.col("metadata.source").alias("meta_source"),
                                                          F.col("metadata.page").alias("meta_page")),
        """SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY doc_id, page) - 1 AS INTEGER) AS page, page_content,
       path AS meta_source, CAST(row_number() OVER (PARTITION BY path ORDER BY doc_id, page) - 1 AS INTEGER) AS meta_page
FROM (SELECT printf('corpus/%s/doc-%d.pdf', lang, doc_id // 4) AS path, doc_id,
             generate_subscripts(string_split(text, chr(12)), 1) AS page,
             unnest(string_split(text, chr(12))) AS page_content FROM documents)""")

    # S6 union of loaders
    R["load_corpus"] = (
        lambda sp, sf: corpus_docs(sp, sf).select("subject", "path", "format", "page_content", *_meta()),
        _with(S.TXT_DOCS, S.PAGE_FILES, S.HTML_DOCS, S.CORPUS_DOCS)
        + " SELECT subject, path, format, page_content, " + ", ".join(META) + " FROM corpus_docs")

    # P1 whitespace normalisation
    R["normalise_text"] = (
        lambda sp, sf: txt_docs(sp, sf).select("doc_id", normalise_whitespace("page_content").alias("page_content")),
        _with(S.TXT_DOCS) + f" SELECT doc_id, {S.normalise('page_content')} AS page_content FROM txt_docs")

    # P2 chunker at two settings
    chunk_cols = ["doc_id", "chunk_index", "char_start", "char_end", "content"]
    for size, ov in ((512, 64), (1000, 50)):
        R[f"chunk_{size}_{ov}"] = (
            (lambda s_, o_: lambda sp, sf: doc_chunks(sp, sf, s_, o_).select(*chunk_cols))(size, ov),
            _with(S.TXT_DOCS, S.norm_txt_docs(), S.chunk_ctes("norm_docs", "doc_id", "page_content", size, ov, "dc"))
            + " SELECT k AS doc_id, chunk_index, char_start, char_end, content FROM dc_chunks")

    # P3 chunk fan-out keeps metadata (whole corpus)
    R["chunk_with_metadata"] = (
        lambda sp, sf: corpus_chunks(sp, sf).select("subject", "path", "chunk_index", "content", *_meta()),
        _with(S.corpus_chunks_ctes()) + " SELECT subject, path, chunk_index, content, "
        + ", ".join(META) + " FROM corpus_chunks")

    # P4 minimum length filter
    R["min_length_filter"] = (
        lambda sp, sf: doc_chunks(sp, sf, 512, 64, 100).select("doc_id", "chunk_index", "content"),
        _with(S.TXT_DOCS, S.norm_txt_docs(), S.chunk_ctes("norm_docs", "doc_id", "page_content", 512, 64, "dc"))
        + " SELECT k AS doc_id, chunk_index, content FROM dc_chunks WHERE length(content) >= 100")

    # P6 token count per chunk
    R["token_count"] = (
        lambda sp, sf: doc_chunks(sp, sf).select("doc_id", "chunk_index",
                                                 token_count("content").alias("tokens")),
        _with(S.TXT_DOCS, S.norm_txt_docs(), S.chunk_ctes("norm_docs", "doc_id", "page_content", 512, 64, "dc"))
        + f" SELECT k AS doc_id, chunk_index, CAST({S.token_count('content')} AS INTEGER) AS tokens FROM dc_chunks")

    # P7 token guard over sixteen documents of a language taken as one chunk (some are over the limit)
    def joined(sp, sf):
        docs = txt_docs(sp, sf).groupBy("subject", F.floor(F.col("doc_id") / 16).alias("n")).agg(
            F.sort_array(F.collect_list(F.struct("doc_id", "page_content"))).alias("p"))
        return docs.select("subject", F.col("n").cast("bigint").alias("n"), token_count(normalise_whitespace(
            F.array_join(F.transform("p", lambda x: x["page_content"]), "\n"))).alias("tokens"))
    R["token_guard"] = (
        lambda sp, sf: token_guard(joined(sp, sf), "tokens", mode="flag"),
        _with(S.TXT_DOCS) + f""", joined AS (
  SELECT subject, doc_id // 16 AS n, string_agg(page_content, chr(10) ORDER BY doc_id) AS t FROM txt_docs GROUP BY subject, doc_id // 16)
SELECT subject, CAST(n AS BIGINT) AS n, CAST({S.token_count(S.normalise('t'))} AS INTEGER) AS tokens,
       {S.token_count(S.normalise('t'))} <= 8191 AS within_limit FROM joined""")

    # P8 stable chunk ids
    R["chunk_id"] = (
        lambda sp, sf: doc_chunks(sp, sf).select(
            "doc_id", "chunk_index", stable_id("subject", "path", "page", "chunk_index").alias("id")),
        _with(S.doc_chunks_ctes()) + " SELECT doc_id, chunk_index, id FROM doc_chunks")

    # P9 + F1b: store rows (assembled, hash-embedded), and the embedder alone on questions
    R["embedded_chunks"] = (
        lambda sp, sf: store(sp, sf).select("id", "subject", "chunk_index", "content", "tokens", "embedding_model",
                                            *_meta(), vec_text("embedding").alias("embedding")),
        _with(S.store_ctes()) + " SELECT id, subject, chunk_index, content, tokens, 'feature-hash-64' AS embedding_model, "
        + ", ".join(META) + f", {S.vec_text('embedding')} AS embedding FROM store")
    R["hash_embed"] = (
        lambda sp, sf: hash_embed(read_table(sp, sf, "benchmark"), "text").select(
            "item_id", vec_text("embedding").alias("embedding")),
        _with("question_src AS (SELECT item_id, text FROM benchmark)", S.hashed_ctes("hq", "question_src", "text"))
        + f" SELECT item_id, {S.vec_text('embedding')} AS embedding FROM hq")

    # P10: dot product of two vector columns, row by row: each page's title
    # vector against its body vector (the query-side product J1 runs inside
    # score_sets, reduced in the task and never materialised as pairs)
    def similarity_scores(sp, sf):
        pages = load_html(files(sp, sf))
        return pages.select(
            "path",
            F.round(dot(hash_vector(F.col("metadata.title")), hash_vector("page_content")), 6).alias("similarity"))
    R["similarity_scores"] = (
        similarity_scores,
        _with(S.PAGE_FILES, S.HTML_DOCS,
              "titles AS (SELECT path, meta_title AS t FROM html_docs)", S.hashed_ctes("tv", "titles", "t"),
              "bodies AS (SELECT path, page_content AS t FROM html_docs)", S.hashed_ctes("bv", "bodies", "t"))
        + f" SELECT tv.path, round({S.dot('tv.embedding', 'bv.embedding')}, 6) AS similarity"
          " FROM tv JOIN bv ON tv.path = bv.path")

    # P11 true cosine against the (non-unit) centroid of each vector's label
    def cosine_scores(sp, sf):
        db = label_db(sp, sf)
        dims = db.select("label", F.posexplode("embedding").alias("i", "x"))
        cent = (dims.groupBy("label", "i").agg(F.avg("x").alias("m"))
                .groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))),
                                                  lambda t: t["m"]).alias("centroid")))
        return (db.join(cent, "label")
                .select("vec_id", "label", F.round(cosine("embedding", "centroid"), 6).alias("cosine")))
    R["cosine_scores"] = (
        cosine_scores,
        _with("vecs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
              """cent AS (SELECT label, list(m ORDER BY i) AS c FROM (
                   SELECT label, i, avg(e[i]) AS m FROM vecs, range(1, 65) r(i) GROUP BY label, i) GROUP BY label)""")
        + f""" SELECT v.vec_id, v.label, round({S.dot('v.e', 'c.c')} / (sqrt({S.dot('v.e', 'v.e')}) * sqrt({S.dot('c.c', 'c.c')})), 6) AS cosine
FROM vecs v JOIN cent c ON v.label = c.label""")

    # A1 max over one query set, one row per chunk of the store
    best_sql = _with(S.store_ctes(), S.QUESTIONS) + f""",
best AS (SELECT CAST(0 AS BIGINT) AS query_set_id, s.id, max({S.dot('s.embedding', 'q.embedding')}) AS score
         FROM store s, questions q GROUP BY s.id)"""
    R["max_over_queries"] = (
        lambda sp, sf: one_set_scores(sp, sf, float("-inf")).select(
            "id", "query_set_id", F.round("score", 6).alias("similarity")),
        best_sql + " SELECT id, query_set_id, round(score, 6) AS similarity FROM best")

    # P12 threshold
    R["threshold_filter"] = (
        lambda sp, sf: one_set_scores(sp, sf, THRESHOLD).select(
            "id", "query_set_id", F.round("score", 6).alias("similarity")),
        best_sql + f" SELECT id, query_set_id, round(score, 6) AS similarity FROM best WHERE NOT isnan(score) AND score >= {THRESHOLD}")

    # W2 ranks of all passing rows of a set, numbered without gathering them
    def ranked_results(sp, sf):
        rows = one_set_scores(sp, sf, THRESHOLD).withColumn("_less", -rank_key())
        return global_row_number(rows, ["_less", "id"], "rank").select(
            "query_set_id", F.col("rank").cast("int").alias("rank"), "id", F.round("score", 6).alias("similarity"))
    R["ranked_results"] = (
        ranked_results,
        best_sql + f""" SELECT query_set_id,
  CAST(row_number() OVER (PARTITION BY query_set_id ORDER BY round(score, {RANK_PLACES}) DESC, id) AS INTEGER) AS rank,
  id, round(score, 6) AS similarity FROM best WHERE NOT isnan(score) AND score >= {THRESHOLD}""")

    # T3 top-k per question (BLAS engine)
    text_top_sql = _with(S.text_topk_ctes(K, THRESHOLD))
    R["retrieve_topk_batch"] = (
        lambda sp, sf: set_topk(sp, sf).select("query_set_id", "rank", "id", "similarity"),
        text_top_sql + " SELECT query_set_id, rank, id, similarity FROM text_top")

    # P17 display form of the top-k
    R["render_results"] = (
        lambda sp, sf: render(set_topk(sp, sf)).select("query_set_id", "document_number", "id", "similarity_text"),
        text_top_sql + """ SELECT query_set_id, CAST(rank AS INTEGER) AS document_number, id,
  printf('%.4f', score) AS similarity_text FROM text_top""")

    # T2 top-k of one query set: all benchmark questions as phrasings of one question
    def retrieve_topk(sp, sf):
        scores = score_sets(written_store(sp, sf), one_query_set(sp, sf), k=K, threshold=THRESHOLD, dim=64)
        return top_k_single(scores, K).select(
            F.row_number().over(Window.orderBy(rank_key().desc(), "id")).alias("rank"), "id", "similarity")
    R["retrieve_topk"] = (
        retrieve_topk,
        best_sql + f"""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY round(score, {RANK_PLACES}) DESC, id) AS INTEGER) AS rank, id, round(score, 6) AS similarity
               FROM best WHERE NOT isnan(score) AND score >= {THRESHOLD}) WHERE rank <= {K}""")

    # C2: questions embedded, and answered against the whole store
    R["embed_queries"] = (
        lambda sp, sf: questions(sp, sf).select("query_set_id", vec_text("embedding").alias("embedding")),
        _with(S.QUESTIONS) + f" SELECT query_set_id, {S.vec_text('embedding')} AS embedding FROM questions")
    result_cols = ["query_set_id", "rank", "id", "similarity", "content", *META,
                   "similarity_function", "embedding_model"]
    R["retrieve_text_queries"] = (
        lambda sp, sf: text_results(sp, sf).select(*[c for c in result_cols if c not in META] + _meta()),
        _with(S.text_topk_ctes(K, THRESHOLD)) + " SELECT " + ", ".join(result_cols) + " FROM text_results")

    # J3 late materialisation: winners first, then content by id
    R["late_materialise"] = (
        lambda sp, sf: text_results(sp, sf).select("query_set_id", "rank", "id", "content"),
        _with(S.text_topk_ctes(K, THRESHOLD)) + " SELECT query_set_id, rank, id, content FROM text_results")

    # P14 blocks, W1 budget, A6 context, P15 prompt, P16 messages, C3 whole chain
    def blocks(sp, sf):
        return text_results(sp, sf).select("query_set_id", "rank", document_block("content", "metadata").alias("block"))
    ctx_sql = _with(S.text_topk_ctes(K, THRESHOLD), CONTEXT_SQL)
    R["format_documents"] = (blocks, ctx_sql + " SELECT query_set_id, rank, block FROM blocks")
    R["budgeted_context"] = (
        lambda sp, sf: budgeted_blocks(blocks(sp, sf), BUDGET).select(
            "query_set_id", "rank", F.length("block").alias("block_length"), "running_length"),
        ctx_sql + " SELECT query_set_id, rank, CAST(length(block) AS INTEGER) AS block_length, running_length FROM kept")
    R["assemble_context"] = (
        lambda sp, sf: assemble_context(budgeted_blocks(blocks(sp, sf), BUDGET)),
        ctx_sql + " SELECT query_set_id, context FROM contexts")

    def prompts(sp, sf):
        return retrieval_prompts(text_results(sp, sf), questions(sp, sf), BUDGET)
    R["build_prompt"] = (lambda sp, sf: prompts(sp, sf).select("query_set_id", "prompt"),
                         ctx_sql + " SELECT query_set_id, prompt FROM prompts")
    R["build_messages"] = (
        lambda sp, sf: prompts(sp, sf).select("query_set_id", F.to_json("messages").alias("messages")),
        ctx_sql + " SELECT query_set_id, CAST(to_json([{'role': 'user', 'content': prompt}]) AS VARCHAR) AS messages FROM prompts")
    R["retrieval_prompts"] = (
        lambda sp, sf: prompts(sp, sf).select("query_set_id", "question", "context", "prompt"),
        ctx_sql + " SELECT query_set_id, question, context, prompt FROM prompts")

    # C1 the build (store rows), S7 write + read back, S8 one subject from the store
    build_sql_cols = "id, subject, path, chunk_index, tokens, content, " + ", ".join(META)
    R["build_database"] = (
        lambda sp, sf: store(sp, sf).select("id", "subject", "path", "chunk_index", "tokens", "content", *_meta(),
                                            vec_text("embedding").alias("embedding")),
        _with(S.store_ctes()) + f" SELECT {build_sql_cols}, {S.vec_text('embedding')} AS embedding FROM store")

    def roundtrip(sp, sf):
        path = shared_path(sp, "store", unique=True)
        write_store(store(sp, sf), path)
        return read_store(sp, path).select("id", "subject", "chunk_index", "tokens", "content",
                                           vec_text("embedding").alias("embedding"))
    R["vector_db_roundtrip"] = (
        roundtrip,
        _with(S.store_ctes()) + f" SELECT id, subject, chunk_index, tokens, content, {S.vec_text('embedding')} AS embedding FROM store")

    def scan(sp, sf):
        return read_store(sp, store_path(sp, sf), subject="en", columns=["id", "content", "metadata", "subject"]).select(
            "id", "subject", "content", *_meta())
    R["vector_db_scan"] = (
        scan,
        _with(S.store_ctes()) + " SELECT id, subject, content, " + ", ".join(META) + " FROM store WHERE subject = 'en'")

    # Structured Streaming: documents as a file stream, built per micro-batch
    def streaming_build(sp, sf):
        from vellum.streaming.ingest import table_stream_build  # noqa: PLC0415
        path = shared_path(sp, "stream_store", unique=True)
        q = table_stream_build(sp, sf, path)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return read_store(sp, path).select("id", "subject", "chunk_index", "tokens", "content",
                                           vec_text("embedding").alias("embedding"))
    R["streaming_build"] = (
        streaming_build,
        _with(S.doc_chunks_ctes(), S.hashed_ctes("dstore", "doc_chunks", "content"))
        + f" SELECT id, subject, chunk_index, tokens, content, {S.vec_text('embedding')} AS embedding FROM dstore")

    # a user embedder, one call per global batch, through the vector cache
    def embed_chunks(sp, sf):
        path = shared_path(sp, "staged-chunks", unique=True)
        corpus_chunks(sp, sf).select("id", "content", "tokens", *CHUNK_ORDER).write.option("compression", "zstd").parquet(path)
        return cached_embeddings(sp.read.parquet(path), lambda: HashEmbedder(64), HASH_MODEL, CHUNK_ORDER)
    R["embed_chunks"] = (
        lambda sp, sf: embed_chunks(sp, sf).select("id", vec_text("embedding").alias("embedding")),
        _with(S.store_ctes()) + f" SELECT id, {S.vec_text('embedding')} AS embedding FROM store")

    # J2: chunks paired 1:1 with a table of vectors; a chunk or a vector without a partner fails the job
    R["attach_embeddings"] = (
        lambda sp, sf: attach_embeddings(corpus_chunks(sp, sf).select("id", "content"), written_store(sp, sf).select("id", "embedding"))
        .select("id", "content", vec_text("embedding").alias("embedding")),
        _with(S.store_ctes()) + f" SELECT id, content, {S.vec_text('embedding')} AS embedding FROM store")

    # P18 for embeddings: the provider of each request as an embedding provider
    R["embedding_admission"] = (
        lambda sp, sf: admit_embedding_providers(requests(sp, sf)).select("conv_id", "provider", "admitted", "error"),
        _with(REQUESTS_SQL) + """ SELECT conv_id, provider, lower(provider) IN ('openai', 'azure') AS admitted,
       CASE WHEN lower(provider) NOT IN ('openai', 'azure')
            THEN 'Unknown provider ''' || provider || '''. Supported providers are ''openai'' and ''azure''.' END AS error
FROM requests""")

    # W3 embedding batches, A2 token totals, A5 build counts
    R["embed_batches"] = (
        lambda sp, sf: embed_batches(corpus_chunks(sp, sf), ["subject", "path", "chunk_index"], "tokens")
        .select("id", "tokens", "batch", "n_batches"),
        _with(S.corpus_chunks_ctes()) + """,
numbered AS (SELECT id, tokens, row_number() OVER (ORDER BY subject, path, chunk_index) - 1 AS r,
                    count(*) OVER () AS n, greatest(sum(tokens) OVER () // 100000, 1) AS k FROM corpus_chunks),
parts AS (SELECT *, n // k AS q, n % k AS m FROM numbered)
SELECT id, tokens,
       CAST(CASE WHEN r < m * (q + 1) THEN r // (q + 1) ELSE m + (r - m * (q + 1)) // q END AS INTEGER) AS batch,
       CAST(k AS INTEGER) AS n_batches
FROM parts""")
    R["token_totals"] = (
        lambda sp, sf: corpus_chunks(sp, sf).rollup("subject").agg(
            F.count(F.lit(1)).alias("chunks"), F.sum("tokens").cast("bigint").alias("total_tokens")),
        _with(S.corpus_chunks_ctes()) + """ SELECT subject, count(*) AS chunks, CAST(sum(tokens) AS BIGINT) AS total_tokens
FROM corpus_chunks GROUP BY ROLLUP (subject)""")
    R["build_counts"] = (
        lambda sp, sf: corpus_chunks(sp, sf).groupBy("subject", "format").agg(
            F.countDistinct("path").alias("documents"), F.count(F.lit(1)).alias("chunks")),
        _with(S.corpus_chunks_ctes()) + """ SELECT subject, format, count(DISTINCT path) AS documents, count(*) AS chunks
FROM corpus_chunks GROUP BY subject, format""")

    # F3 batch generation with the offline responder (it answers "I don't
    # know." and counts str.split() words of the messages as prompt tokens)
    R["generate_batch"] = (
        lambda sp, sf: generate(
            prompts(sp, sf).select("query_set_id", F.lit("gpt-4o").alias("model"),
                                   F.lit("AzureOpenAI").alias("provider"), F.lit(0.1).alias("temperature"),
                                   F.lit(2048).alias("max_tokens"), "messages"),
            echo_responder, ["query_set_id"]).select("query_set_id", "model", "response", "prompt_tokens",
                                                     "completion_tokens", "error"),
        ctx_sql + f""" SELECT query_set_id, 'gpt-4o' AS model, 'I don''t know.' AS response,
       CAST({S.split_words('prompt')} AS BIGINT) AS prompt_tokens,
       CAST(3 AS BIGINT) AS completion_tokens, CAST(NULL AS VARCHAR) AS error FROM prompts""")

    # the usage of every answered request, from the ledger that the calls wrote as they returned
    def usage_after_generation(sp, sf):
        req = prompts(sp, sf).select(
            "query_set_id", F.when(F.col("query_set_id") % 2 == 0, "gpt-4o").otherwise("gpt-35-turbo").alias("model"),
            F.lit("AzureOpenAI").alias("provider"), F.lit(0.1).alias("temperature"), F.lit(2048).alias("max_tokens"), "messages")
        ledger_path = shared_path(sp, "ledger", unique=True)
        generate_recorded(req, echo_responder, ["query_set_id"], ledger_path, mode="strict")
        return usage_by_model(read_usage(sp, ledger_path))
    R["usage_after_generation"] = (
        usage_after_generation,
        ctx_sql + f""" SELECT CASE WHEN query_set_id % 2 = 0 THEN 'gpt-4o' ELSE 'gpt-35-turbo' END AS model,
       CAST(sum({S.split_words('prompt')}) AS BIGINT) AS prompt_tokens,
       CAST(sum(3) AS BIGINT) AS completion_tokens FROM prompts GROUP BY 1""")

    # P18/J5 admission, A7 configurations, S10 ledger, A3 per model, J4/A4 cost
    R["request_admission"] = (
        lambda sp, sf: admit_requests(requests(sp, sf), allow_list(sp)).select(
            "conv_id", "model", "provider", "admitted", "error"),
        _with(REQUESTS_SQL) + " SELECT conv_id, model, provider, error IS NULL AS admitted, error FROM admission")
    R["request_configs"] = (
        lambda sp, sf: request_configs(requests(sp, sf)),
        _with(REQUESTS_SQL) + " SELECT DISTINCT model, provider, temperature, max_tokens FROM requests")

    def ledger(sp, sf):
        path = shared_path(sp, "ledger", unique=True)
        append_usage(usage_facts(sp, sf), path)
        return read_usage(sp, path).drop("call_id")
    R["usage_ledger"] = (ledger, _with(REQUESTS_SQL) + " SELECT request_id, model, prompt_tokens, completion_tokens FROM usage")
    R["usage_by_model"] = (
        lambda sp, sf: usage_by_model(usage_facts(sp, sf)),
        _with(REQUESTS_SQL) + """ SELECT model, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
       CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM usage GROUP BY model""")
    R["usage_cost"] = (
        lambda sp, sf: usage_cost(usage_facts(sp, sf), cost_rates(sp)),
        _with(REQUESTS_SQL) + """,
per_model AS (SELECT model, CAST(sum(prompt_tokens) AS BIGINT) AS p, CAST(sum(completion_tokens) AS BIGINT) AS c
              FROM usage GROUP BY model),
priced AS (SELECT m.model, m.p, m.c,
                  m.p * coalesce(r.prompt_rate, 0::DECIMAL(12,9)) + m.c * coalesce(r.completion_rate, 0::DECIMAL(12,9)) AS cost
           FROM per_model m LEFT JOIN rates r ON m.model = r.model)
SELECT model, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS completion_tokens,
       CAST(round(sum(cost), 6) AS DOUBLE) AS cost
FROM priced GROUP BY ROLLUP (model)""")
    return R


REGISTRY = _registry()


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
