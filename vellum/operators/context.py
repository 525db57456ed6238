"""Context building: document blocks, the character budget, the prompt.

* block: ``Metadata: {m}\\nContent: {c}\\n\\n`` with ``m`` the metadata as
  JSON (nulls kept) or empty when there is none.  (The reference prints a
  Python dict; JSON is the portable form of the same content.)
* budget: blocks are taken in rank order while the running total of their
  lengths stays ``<= budget``; the first block that overflows ends the
  context (later, shorter blocks are not tried).  Blocks are never empty, so
  the running sum is strictly increasing and the filter is a prefix.
* context: the kept blocks concatenated in rank order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The answer prompt (indentation is part of the text), the
# default context budget in characters, and the chat role.
# ---------------------------------------------------------------------------
PROMPT_HEAD = ("Use the below information chunks to answer the subsequent question. "
               "If the answer cannot be found, write 'I don't know.'\n"
               "    \n"
               "        DOCUMENTS:\n"
               "        ")
PROMPT_MIDDLE = ("\n"
                 "        \n"
                 "        Whenever possible cite the source of the information using the metadata provided "
                 "(i.e., mention for example the title of the document and on which page).\n"
                 "        \n"
                 "        Question: ")
PROMPT_TAIL = ("\n"
               "        ")
DEFAULT_BUDGET = 2048
USER_ROLE = "user"


def document_block(content="content", metadata="metadata") -> Column:
    c = F.col(content) if isinstance(content, str) else content
    m = F.col(metadata) if isinstance(metadata, str) else metadata
    meta = F.coalesce(F.to_json(m, {"ignoreNullFields": "false"}), F.lit(""))
    return F.concat(F.lit("Metadata: "), meta, F.lit("\nContent: "), c, F.lit("\n\n"))


def budgeted_blocks(ranked: DataFrame, budget: int = DEFAULT_BUDGET,
                    set_col: str = "query_set_id", rank_col: str = "rank",
                    block_col: str = "block") -> DataFrame:
    """Keep the rank-ordered prefix of blocks whose total length fits ``budget``."""
    w = (Window.partitionBy(set_col).orderBy(rank_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranked.withColumn("running_length", F.sum(F.length(block_col)).over(w))
            .where(F.col("running_length") <= F.lit(budget)))


def assemble_context(blocks: DataFrame, set_col: str = "query_set_id",
                     rank_col: str = "rank", block_col: str = "block") -> DataFrame:
    """One row per set: blocks concatenated in rank order (bounded: k rows per set)."""
    return blocks.groupBy(set_col).agg(
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(block_col).alias("b")))),
            lambda x: x["b"]), "").alias("context"))


def build_prompt(context="context", question="question") -> Column:
    c = F.col(context) if isinstance(context, str) else context
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit(PROMPT_HEAD), F.coalesce(c, F.lit("")), F.lit(PROMPT_MIDDLE), q, F.lit(PROMPT_TAIL))


def user_messages(prompt="prompt") -> Column:
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.array(F.struct(F.lit(USER_ROLE).alias("role"), p.alias("content")))
