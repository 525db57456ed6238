"""The three entry points of the reproduced pipeline, as thin Spark facades.

    builder = DatabaseBuilder(spark, subject="test", chunk_size=512, overlap_size=64)
    builder.build_database(root_folder_path="data/")
    docs, tokens = Retriever(spark, subject="test").retrieve(["When is ...?"], top_k=5, threshold=0.2)
    answer = Generator(responder_factory=...).generate_response("When is ...?", docs)

Each call builds one DataFrame plan; the returned objects are DataFrames
(collect them yourself when they are small).  The default embedder is the
offline feature-hashing one; pass ``embedder_factory`` for a real provider.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import token_count
from vellum.operators.chunker import check_chunk_params
from vellum.operators.embed import HASH_MODEL, embed
from vellum.operators.generate import (DEFAULT_MAX_TOKENS, DEFAULT_TEMPERATURE, admit_requests, allow_list,
                                       check_embedding_provider, generate_once, generate_recorded)
from vellum.operators.retrieve import DEFAULT_THRESHOLD, DEFAULT_TOP_K
from vellum.plans.build import TokenCounter, build_and_write, build_database
from vellum.functions.vectors import hash_vector
from vellum.plans.retrieval import retrieval_prompts, retrieve
from vellum.session import shared_path
from vellum.sources.corpus import PageExtractor, form_feed_pages, scan_corpus
from vellum.sources.store import read_store


def default_store(spark: SparkSession) -> str:
    return shared_path(spark, "embedding_database")


class DatabaseBuilder:
    """``embedder_factory``, ``extractor`` (pages of a PDF) and ``token_counter`` are the
    hooks of a build; ``model`` names the embedder, and a text that it has embedded for this
    store (or ``vector_cache``) is not sent again: another embedder needs another name.
    ``provider``, if given, must be one that is supported."""

    def __init__(self, spark: SparkSession, subject: str, chunk_size: int = 512, overlap_size: int = 64,
                 min_text_length: int = 0, store_path: str | None = None, mode: str = "strict",
                 embedder_factory: Callable | None = None, model: str = HASH_MODEL, dim: int = 64,
                 extractor: PageExtractor = form_feed_pages, token_counter: TokenCounter = token_count,
                 vector_cache: str | None = None, provider: str | None = None):
        check_chunk_params(chunk_size, overlap_size)
        check_embedding_provider(provider)
        self.spark, self.subject = spark, subject
        self.store_path = store_path or default_store(spark)
        self.options = {"chunk_size": chunk_size, "overlap_size": overlap_size, "min_text_length": min_text_length,
                        "mode": mode, "embedder_factory": embedder_factory, "model": model, "dim": dim,
                        "extractor": extractor, "token_counter": token_counter,
                        "vector_cache": vector_cache or f"{self.store_path.rstrip('/')}/vectors"}

    def rows(self, root_folder_path: str) -> DataFrame:
        return build_database(scan_corpus(self.spark, root_folder_path, self.subject), **self.options)

    def build_database(self, root_folder_path: str) -> dict:
        """Replace this subject's partition of the store; returns the observed
        counts (chunks, total_tokens, documents, rejected_files, rejected_chunks)."""
        files = scan_corpus(self.spark, root_folder_path, self.subject)
        return build_and_write(files, self.store_path, subjects=[self.subject], **self.options)


class Retriever:
    def __init__(self, spark: SparkSession, subject: str, store_path: str | None = None,
                 embedder_factory: Callable | None = None, model: str = HASH_MODEL, dim: int = 64,
                 check_model: bool = True):
        self.spark, self.subject, self.model, self.dim = spark, subject, model, dim
        self.embedder_factory = embedder_factory
        self.store = read_store(spark, store_path or default_store(spark), subject=subject)
        if check_model:
            # a store built with another embedding model would give silent
            # wrong answers: refuse it (reads one small dictionary column)
            other = (self.store.select("embedding_model").where(~F.col("embedding_model").eqNullSafe(F.lit(model)))
                     .limit(1).collect())
            if other:
                raise ValueError(f"store for {subject!r} was built with {other[0][0]!r}, not {model!r}")

    def _queries(self, user_queries: list[str]) -> tuple[DataFrame, int]:
        """Embedded phrasings, and the tokens that embedding them took.  A user
        embedder is called once: its vectors are written before they are read."""
        qs = self.spark.createDataFrame([(0, i, t) for i, t in enumerate(user_queries)],
                                        "query_set_id long, query_id long, question string")
        if self.embedder_factory is None:
            tokens = qs.agg(F.sum(token_count("question"))).first()[0]
            return qs.withColumn("embedding", hash_vector("question", self.dim)), int(tokens or 0)
        vec = embed(qs, self.embedder_factory, ["query_set_id", "query_id", "question"], "question", None,
                    dim=self.dim).checkpoint(eager=True)
        tokens = vec.agg(F.sum("embed_tokens")).first()[0]
        return vec.select("query_set_id", "query_id", "question", "embedding"), int(tokens or 0)

    def retrieve(self, user_queries: list[str], top_k: int = DEFAULT_TOP_K,
                 threshold: float = DEFAULT_THRESHOLD) -> tuple[DataFrame, int]:
        """All phrasings form one query set; returns (ranked results, query tokens)."""
        queries, tokens = self._queries(user_queries)
        return retrieve(self.store, queries, k=top_k, threshold=threshold,
                        embedding_model=self.model, dim=self.dim), tokens


class Generator:
    def __init__(self, responder_factory: Callable, model_provider: str = "HuggingFace",
                 model_name: str = "meta-llama/Meta-Llama-3-8B-Instruct",
                 temperature: float = 0.1, max_tokens: int = 2048, ledger_path: str | None = None):
        self.responder_factory = responder_factory
        self.provider, self.model = model_provider, model_name
        self.temperature = temperature if temperature is not None else DEFAULT_TEMPERATURE
        self.max_tokens = max_tokens if max_tokens is not None else DEFAULT_MAX_TOKENS
        self.ledger_path = ledger_path

    def generate_response(self, user_query: str, retrieved: DataFrame) -> DataFrame:
        """Prompt from the retrieved rows (budget = max_tokens characters), then one
        request, whose usage goes to the ledger, if there is one."""
        spark = retrieved.sparkSession
        question = spark.createDataFrame([(0, user_query)], "query_set_id long, question string")
        prompts = retrieval_prompts(retrieved, question, self.max_tokens)
        req = prompts.select("query_set_id", F.lit(self.model).alias("model"),
                             F.lit(self.provider).alias("provider"),
                             F.lit(float(self.temperature)).alias("temperature"),
                             F.lit(int(self.max_tokens)).alias("max_tokens"), "messages")
        admitted = admit_requests(req, allow_list(spark))
        bad = admitted.where(~F.col("admitted")).select("error").first()
        if bad is not None:
            raise ValueError(bad.error)
        if self.ledger_path is None:
            return generate_once(req, self.responder_factory, ["query_set_id"], mode="strict")
        return generate_recorded(req, self.responder_factory, ["query_set_id"], self.ledger_path, mode="strict")
