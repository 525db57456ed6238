"""LLM usage accounting: usage facts, per-model sums, cost with default 0.

The ledger is an append-only fact table ``(call_id, request_id, model,
prompt_tokens, completion_tokens)`` with one row for every successful call;
totals are queries over it and count every call, so concurrent writers need
no lock.  A request that was answered twice has two calls, both paid.
``call_id`` names the call: rows that repeat a call_id are one call, written
twice by a replayed append.

Calls are appended below ``calls/<run>/`` (by Spark, or by a journal while the calls are
made).  ``seal_usage`` copies the distinct new ones into ``sealed/<version>``
and names it in the manifest, so a read takes sealed rows as they are and
looks for repeats only among the rest.
"""

from __future__ import annotations

import json
import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.sources.shared_files import create_once, delete_files, exists, files_of, names_in, write_text
from vellum.sources.versions import latest, switch

# ---------------------------------------------------------------------------
# Price per 1000 tokens (prompt, completion); any other model
# costs 0.
#   gpt-4o            0.0045  0.0135
#   gpt-35-turbo      0.0018  0.0018
#   gpt-35-turbo-16k  0.0027  0.0036
# ---------------------------------------------------------------------------
COST_PER_1K = [
    ("gpt-4o", 0.0045, 0.0135),
    ("gpt-35-turbo", 0.0018, 0.0018),
    ("gpt-35-turbo-16k", 0.0027, 0.0036),
]

USAGE_SCHEMA = T.StructType([
    T.StructField("call_id", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
])


RATE_TYPE = "decimal(12,9)"


def cost_rates(spark: SparkSession) -> DataFrame:
    """Per-token rates, a 3-row dimension, exact decimals (money is summed
    exactly and rounded once)."""
    return spark.createDataFrame(
        [(m, Decimal(str(p)) / 1000, Decimal(str(c)) / 1000) for m, p, c in COST_PER_1K],
        f"model string, prompt_rate {RATE_TYPE}, completion_rate {RATE_TYPE}")


def usage_by_model(usage: DataFrame) -> DataFrame:
    return (usage.groupBy("model")
            .agg(F.sum("prompt_tokens").cast("bigint").alias("prompt_tokens"),
                 F.sum("completion_tokens").cast("bigint").alias("completion_tokens")))


def usage_cost(usage: DataFrame, rates: DataFrame) -> DataFrame:
    """Per-model sums and cost, plus a grand-total row (``model`` NULL).

    Unknown models join to no rate and cost 0.  Aggregation happens before
    the join, so the rate table meets one row per model; the 3-row rate table
    is broadcast.
    """
    per_model = usage_by_model(usage)
    zero = F.lit(Decimal(0)).cast(RATE_TYPE)
    priced = (per_model.join(F.broadcast(rates), "model", "left")
              .withColumn("cost",
                          F.col("prompt_tokens") * F.coalesce("prompt_rate", zero)
                          + F.col("completion_tokens") * F.coalesce("completion_rate", zero)))
    return (priced.rollup("model")
            .agg(F.sum("prompt_tokens").cast("bigint").alias("prompt_tokens"),
                 F.sum("completion_tokens").cast("bigint").alias("completion_tokens"),
                 F.round(F.sum("cost"), 6).cast("double").alias("cost")))


def calls_folder(path: str, run_id: str = "") -> str:
    return f"{path.rstrip('/')}/calls/{run_id}".rstrip("/")


def append_usage(usage: DataFrame, path: str, run_id: str | None = None) -> str:
    """Append successful calls; returns the run id.

    Without a ``call_id`` column each row is a call of its own, named by the
    run and its place in it.  The rows are counted as they are written, so
    give a materialised frame (the output of ``generate`` written once).
    """
    run_id = run_id or uuid.uuid4().hex
    if "call_id" not in usage.columns:
        usage = usage.withColumn("call_id", F.concat_ws("-", F.lit(run_id), F.monotonically_increasing_id().cast("string")))
    folder = calls_folder(path, run_id)
    usage.select(*USAGE_SCHEMA.fieldNames()).write.mode("append").parquet(folder)
    close_run(usage.sparkSession, path, run_id)
    return run_id


def close_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Nothing but usage is needed of this run's files any more: they may go once they are sealed."""
    create_once(spark, f"{calls_folder(path, run_id)}/_closed", "")


def _calls(spark: SparkSession, path: str) -> DataFrame | None:
    """What is not known to be sealed, with repeats."""
    folder = calls_folder(path)
    if not exists(spark, folder):
        return None
    calls = spark.read.schema(USAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(folder)
    return calls if files_of(calls) else None


def _sealed(spark: SparkSession, path: str) -> DataFrame | None:
    names = (latest(spark, path)[1] or {}).get("sealed", [])
    return spark.read.schema(USAGE_SCHEMA).parquet(*[f"{path.rstrip('/')}/sealed/{n}" for n in names]) if names else None


def _only_new(calls: DataFrame, sealed: DataFrame | None) -> DataFrame:
    """Distinct calls that are not sealed.  Only those repeated ids that are found
    in a pass over the sealed ids meet the calls, so the sealed side is not shuffled
    while the calls are few enough for Spark to broadcast their ids."""
    new = calls.dropDuplicates(["call_id"])
    if sealed is None:
        return new
    again = sealed.select("call_id").join(new.select("call_id"), "call_id", "left_semi")
    return new.join(again, "call_id", "left_anti")


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """All calls of the ledger, each once."""
    # the calls first: those that are sealed meanwhile are then on both sides, and count once
    calls = _calls(spark, path)
    sealed = _sealed(spark, path)
    if calls is None:
        return sealed if sealed is not None else spark.createDataFrame([], USAGE_SCHEMA)
    new = _only_new(calls, sealed).select(*USAGE_SCHEMA.fieldNames())
    return new if sealed is None else sealed.unionByName(new)


def seal_usage(spark: SparkSession, path: str, remove: bool = True) -> int:
    """Seal what has been appended; returns the number of calls sealed now.

    ``remove`` then deletes the sealed files of closed runs, in tasks; a reader that
    began before may have to read again.  Sealing twice, or ending half-way, does no
    harm: a call that is found on both sides counts once.
    """
    root = path.rstrip("/")
    calls = _calls(spark, path)
    if calls is None:
        return 0
    files = files_of(calls)
    name = uuid.uuid4().hex
    seen = Observation("sealed")
    # these files only: whatever is appended from now on belongs to the next time
    fixed = spark.read.schema(USAGE_SCHEMA).parquet(*files)
    (_only_new(fixed, _sealed(spark, path)).select(*USAGE_SCHEMA.fieldNames())
     .observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/sealed/{name}"))
    sealed_now = seen.get["n"]
    if sealed_now:
        switch(spark, root, lambda m: {**m, "sealed": [*m.get("sealed", []), name]})
    if remove:
        closed = {r for r in names_in(spark, calls_folder(path)) if exists(spark, f"{calls_folder(path, r)}/_closed")}
        gone = [f for f in files if f.rpartition("/calls/")[2].split("/")[0] in closed]
        if gone:
            def run(batches):
                for rb in batches:
                    delete_files(rb.column(0).to_pylist())
                    yield rb.slice(0, 0)

            spark.createDataFrame([(f,) for f in gone], "file string").mapInArrow(run, "file string").collect()
    return sealed_now


def usage_json(usage: DataFrame) -> dict:
    """``{model: {prompt_tokens, completion_tokens}, ..., overall_cost}``: one entry per model."""
    out: dict = {}
    for r in usage_cost(usage, cost_rates(usage.sparkSession)).collect():
        if r.model is None:
            out["overall_cost"] = r.cost or 0.0
        else:
            out[r.model] = {"prompt_tokens": r.prompt_tokens, "completion_tokens": r.completion_tokens}
    return {"overall_cost": 0.0, **out}


def export_usage_json(spark: SparkSession, path: str, target: str) -> dict:
    """The ledger's totals as a JSON file, written in one step; returns them."""
    totals = usage_json(read_usage(spark, path))
    write_text(spark, target, json.dumps(totals, indent=4))
    return totals


def record_usage(responses: DataFrame, path: str, request_col: str) -> DataFrame:
    """Append the usage of the successful responses of ``generate``.

    ``responses`` must be materialised (see ``generate_once``): reading it again
    must not call the model again."""
    calls = responses.where(F.col("error").isNull()).select(
        F.col(request_col).cast("string").alias("request_id"), "model", "prompt_tokens", "completion_tokens")
    append_usage(calls, path)
    return read_usage(responses.sparkSession, path)
