"""Build the vector store of a corpus (one DataFrame chain, one write).

files -> admit -> load (txt, html, pdf) -> normalise whitespace -> chunk ->
minimum length -> token count -> token guard -> embed -> rows -> Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vellum.functions.text import MAX_CHUNK_TOKENS, normalise_whitespace, stable_id, token_count
from vellum.operators.chunker import check_chunk_params, split_documents
from vellum.operators.embed import HASH_MODEL, hash_embed, token_guard
from vellum.operators.embed_cached import attach_embeddings, cached_embeddings
from vellum.session import shared_path
from vellum.sources.corpus import PageExtractor, admit_files, admitted, form_feed_pages, load_corpus
from vellum.sources.store import STORE_COLUMNS, write_store

TokenCounter = Callable[[Column], Column]
CHUNK_ORDER = ["subject", "path", "page", "chunk_index"]


def normalised_documents(files: DataFrame, mode: str = "strict",
                         extractor: PageExtractor = form_feed_pages,
                         include_pdf: bool = True) -> DataFrame:
    docs = load_corpus(admit_files(files, mode), extractor, include_pdf=include_pdf)
    return docs.withColumn("page_content", normalise_whitespace("page_content"))


def chunk_corpus(docs: DataFrame, chunk_size: int = 512, overlap_size: int = 64,
                 min_text_length: int = 0, random_ids: bool = False,
                 token_counter: TokenCounter = token_count) -> DataFrame:
    """Chunks with ``id``, ``tokens`` and the parent document columns.

    Ids are a hash of (subject, path, page, chunk index), stable under task
    retry; ``random_ids`` gives random UUIDs instead (not retry-stable).
    ``token_counter`` maps the content column to a count.
    """
    check_chunk_params(chunk_size, overlap_size)
    chunks = split_documents(docs, "page_content", chunk_size, overlap_size, min_text_length)
    ids = F.expr("uuid()") if random_ids else stable_id("subject", "path", "page", "chunk_index")
    return chunks.withColumn("id", ids).withColumn("tokens", token_counter(F.col("content")).cast("int"))


def store_rows(chunks: DataFrame, model: str = HASH_MODEL, dim: int = 64, guard: str = "strict",
               embedder_factory: Callable | None = None, max_attempts: int = 1, vector_cache: str | None = None) -> DataFrame:
    """Guarded and embedded rows.  With ``embedder_factory`` the vectors come
    from it and ``model`` is its name; without one they are the offline
    embedder's, whose name is the only one allowed.

    A user embedder is called while this plan is made, one call per global batch, for the
    texts that ``vector_cache`` does not hold for ``model``; the vectors are attached 1:1."""
    guarded = token_guard(chunks, "tokens", mode=guard)
    if embedder_factory is None:
        if model != HASH_MODEL:
            raise ValueError(f"{model!r} needs an embedder_factory; the built-in embedder is {HASH_MODEL!r}")
        embedded = hash_embed(guarded, "content", dim)
    else:
        path = shared_path(guarded.sparkSession, "staged-chunks", unique=True)
        guarded.select(*[c for c in STORE_COLUMNS if c not in ("embedding", "embedding_model")], "subject", "path", "page").write.parquet(path)
        staged = guarded.sparkSession.read.parquet(path)
        vectors = cached_embeddings(staged, embedder_factory, model, CHUNK_ORDER, vector_cache, dim=dim, max_attempts=max_attempts)
        embedded = attach_embeddings(staged, vectors, "id")
    return embedded.select(*[c for c in STORE_COLUMNS if c != "embedding_model"],
                           F.lit(model).alias("embedding_model"), "subject", "path", "page")


def build_database(files: DataFrame, chunk_size: int = 512, overlap_size: int = 64,
                   min_text_length: int = 0, model: str = HASH_MODEL, dim: int = 64,
                   mode: str = "strict", include_pdf: bool = True, extractor: PageExtractor = form_feed_pages,
                   token_counter: TokenCounter = token_count, embedder_factory: Callable | None = None,
                   vector_cache: str | None = None) -> DataFrame:
    """The rows of the vector store (not yet written)."""
    check_chunk_params(chunk_size, overlap_size)
    docs = normalised_documents(files, mode, extractor, include_pdf=include_pdf)
    chunks = chunk_corpus(docs, chunk_size, overlap_size, min_text_length, token_counter=token_counter)
    return store_rows(chunks, model, dim, guard=mode, embedder_factory=embedder_factory, vector_cache=vector_cache)


def build_and_write(files: DataFrame, store_path: str, chunk_size: int = 512, overlap_size: int = 64,
                    min_text_length: int = 0, model: str = HASH_MODEL, dim: int = 64,
                    mode: str = "strict", include_pdf: bool = True, extractor: PageExtractor = form_feed_pages,
                    token_counter: TokenCounter = token_count, embedder_factory: Callable | None = None,
                    vector_cache: str | None = None, subjects: list[str] | None = None) -> dict:
    """Write the store and return the build counts (documents, chunks, total
    tokens, and what a quarantine left out: rejected_files, rejected_chunks)
    observed during the same pass -- no second scan.

    Every subject of ``subjects`` is replaced, also one that gives no rows.
    """
    check_chunk_params(chunk_size, overlap_size)
    files_seen, docs_seen, chunks_seen, rows_seen = (Observation(n) for n in ("files", "documents", "cut", "chunks"))
    count = lambda what: F.coalesce(F.sum(what.cast("int")), F.lit(0))
    # only names are looked at, so the count does not read contents
    files = files.observe(files_seen, count(~admitted("path")).alias("rejected_files"))
    docs = normalised_documents(files, mode, extractor, include_pdf=include_pdf).observe(
        docs_seen, F.count(F.lit(1)).alias("documents"))
    chunks = chunk_corpus(docs, chunk_size, overlap_size, min_text_length, token_counter=token_counter).observe(
        chunks_seen, count(F.col("tokens") > MAX_CHUNK_TOKENS).alias("rejected_chunks"))
    rows = store_rows(chunks, model, dim, guard=mode, embedder_factory=embedder_factory, vector_cache=vector_cache).observe(
        rows_seen, F.count(F.lit(1)).alias("chunks"), F.sum("tokens").alias("total_tokens"))
    write_store(rows, store_path, subjects=subjects or ())
    counts = {**files_seen.get, **docs_seen.get, **chunks_seen.get, **rows_seen.get}
    counts["total_tokens"] = counts["total_tokens"] or 0
    return counts
