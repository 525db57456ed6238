"""Answer many query sets against a vector store in one job, and build prompts.

retrieve:  score (BLAS per Arrow batch, or native) -> threshold -> per-set
           top-k -> gather content/metadata of the winners -> result columns
prompts:   blocks -> character budget -> context -> prompt -> messages
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.vectors import hash_vector
from vellum.operators.context import (DEFAULT_BUDGET, assemble_context, budgeted_blocks,
                                      build_prompt, document_block, user_messages)
from vellum.operators.embed import HASH_MODEL
from vellum.operators.retrieve import (DEFAULT_THRESHOLD, DEFAULT_TOP_K, late_materialise,
                                       rank_top_k, result_columns, score_sets, score_sets_native)


def embed_questions(questions: DataFrame, id_col: str = "item_id", text_col: str = "text",
                    dim: int = 64) -> DataFrame:
    """One query set per question (a single phrasing), embedded natively."""
    return questions.select(F.col(id_col).cast("bigint").alias("query_set_id"),
                            F.lit(0).cast("bigint").alias("query_id"),
                            F.col(text_col).alias("question"),
                            hash_vector(text_col, dim).alias("embedding"))


def retrieve(db: DataFrame, queries: DataFrame, k: int = DEFAULT_TOP_K,
             threshold: float = DEFAULT_THRESHOLD, engine: str = "arrow",
             embedding_model: str = HASH_MODEL, dim: int | None = 64) -> DataFrame:
    """Per query set the top-k chunks: ``query_set_id, rank, id, score,
    similarity, content, metadata, similarity_function, embedding_model``."""
    if engine == "arrow":
        scores = score_sets(db, queries, k=k, threshold=threshold, dim=dim)
    elif engine == "native":
        scores = score_sets_native(db, queries, threshold=threshold, dim=dim)
    else:
        raise ValueError(f"unknown engine {engine!r}")
    top = rank_top_k(scores, k)
    n_sets = queries.select("query_set_id").distinct().count()   # small side
    full = late_materialise(top, db, max_rows=k * n_sets)
    return result_columns(full, embedding_model).select(
        "query_set_id", "rank", "id", "score", "similarity", "content", "metadata",
        "similarity_function", "embedding_model")


def retrieval_prompts(results: DataFrame, questions: DataFrame,
                      budget: int = DEFAULT_BUDGET) -> DataFrame:
    """One prompt per question; a question without results gets an empty context."""
    blocks = results.select("query_set_id", "rank", document_block("content", "metadata").alias("block"))
    ctx = assemble_context(budgeted_blocks(blocks, budget))
    q = questions.select("query_set_id", "question")
    return (q.join(ctx, "query_set_id", "left")
            .withColumn("context", F.coalesce("context", F.lit("")))
            .withColumn("prompt", build_prompt("context", "question"))
            .withColumn("messages", user_messages("prompt")))
