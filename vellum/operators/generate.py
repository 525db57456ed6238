"""Generation requests: admission, configurations, batch generation.

Requests are rows ``(model, provider, temperature, max_tokens, messages)``.
Admission checks the model first (against the supported list, via a
broadcast allow-list join), then the provider (case-sensitive for chat
models; embedding providers are matched lower-cased).  Generation runs a
user responder in Arrow batches with one client per configuration per task.

``generate_recorded`` is the form for paid calls: each answer goes to the usage
ledger while the task runs, a failed batch can be run again and asks only for
what is still open.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.usage import calls_folder, close_run
from vellum.sources.journal import Journal
from vellum.sources.shared_files import exists, qualified

# ---------------------------------------------------------------------------
# Supported chat models, chat providers, embedding providers.
# ---------------------------------------------------------------------------
SUPPORTED_MODELS = [
    "gpt-4o",
    "gpt-35-turbo",
    "gpt-35-turbo-16k",
    "HuggingFaceH4/zephyr-7b-beta",
    "mistralai/Mistral-7B-Instruct-v0.2",
    "codellama/CodeLlama-34b-Instruct-hf",
    "meta-llama/Meta-Llama-3-8B-Instruct",
    "microsoft/Phi-3-mini-4k-instruct",
    "mistralai/Mixtral-8x7B-Instruct-v0.1",
]
CHAT_PROVIDERS = ["AzureOpenAI", "HuggingFace"]
EMBEDDING_PROVIDERS = ["openai", "azure"]
DEFAULT_TEMPERATURE = 0.0
DEFAULT_MAX_TOKENS = 512
CONFIG_COLUMNS = ["model", "provider", "temperature", "max_tokens"]


def allow_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m,) for m in SUPPORTED_MODELS], "model string")


def admit_requests(requests: DataFrame, allowed: DataFrame) -> DataFrame:
    """Adds ``admitted`` and ``error`` (NULL when admitted)."""
    flagged = requests.join(F.broadcast(allowed.select("model", F.lit(True).alias("_known"))), "model", "left")
    model_error = F.concat(F.lit("Model not found in the list of supported models: "),
                           F.lit("[" + ", ".join(f"'{m}'" for m in SUPPORTED_MODELS) + "]"), F.lit("."))
    provider_error = F.concat(F.lit("Unsupported provider: "), F.col("provider"),
                              F.lit(". Supported providers: " + ", ".join(CHAT_PROVIDERS)))
    err = (F.when(F.col("_known").isNull(), model_error)
           .when(~F.col("provider").isin(*CHAT_PROVIDERS), provider_error))
    return flagged.withColumn("error", err).withColumn("admitted", F.col("error").isNull()).drop("_known")


def admitted_only(requests: DataFrame, allowed: DataFrame) -> DataFrame:
    return (requests.join(F.broadcast(allowed.select("model")), "model", "left_semi")
            .where(F.col("provider").isin(*CHAT_PROVIDERS)))


def refused_models(requests: DataFrame, allowed: DataFrame) -> DataFrame:
    return requests.join(F.broadcast(allowed.select("model")), "model", "left_anti")


def embedding_provider_ok(provider) -> Column:
    p = F.col(provider) if isinstance(provider, str) else provider
    return F.lower(p).isin(*EMBEDDING_PROVIDERS)


def admit_embedding_providers(rows: DataFrame, provider: str = "provider") -> DataFrame:
    """Adds ``admitted`` and ``error`` (NULL when admitted); a null provider is refused."""
    ok = F.coalesce(embedding_provider_ok(provider), F.lit(False))
    name = F.coalesce(F.col(provider), F.lit("None"))
    return rows.withColumn("admitted", ok).withColumn("error", F.when(~ok, F.concat(
        F.lit("Unknown provider '"), name, F.lit("'. Supported providers are 'openai' and 'azure'."))))


def check_embedding_provider(provider: str | None) -> None:
    """Refuses a provider by name before anything is built (None: not looked at)."""
    if provider is not None and provider.lower() not in EMBEDDING_PROVIDERS:
        raise ValueError(f"Unknown provider '{provider}'. Supported providers are 'openai' and 'azure'.")


def request_configs(requests: DataFrame) -> DataFrame:
    return requests.select(*CONFIG_COLUMNS).distinct()


Responder = Callable[[list[dict]], tuple[str, int, int]]


class _Clients:
    """One responder per configuration, and the attempts at a request."""

    def __init__(self, factory, max_attempts: int, wait_seconds: float):
        self.factory, self.max_attempts, self.wait_seconds, self.made = factory, max_attempts, wait_seconds, {}

    def answer(self, rec: dict) -> tuple[str | None, int | None, int | None, str | None]:
        """(text, prompt tokens, completion tokens, error)."""
        cfg = (rec["model"], rec["provider"], float(rec["temperature"]), int(rec["max_tokens"]))
        if cfg not in self.made:
            self.made[cfg] = self.factory(*cfg)
        messages = [{"role": m["role"], "content": m["content"]} for m in rec["messages"]]
        error = None
        for attempt in range(self.max_attempts):
            if attempt and self.wait_seconds:
                time.sleep(self.wait_seconds)
            try:
                return *self.made[cfg](messages), None
            except Exception as exc:  # noqa: BLE001 - provider failure
                error = f"API request failed: {exc}"
        return None, None, None, error


def generate(requests: DataFrame, responder_factory: Callable[[str, str, float, int], Responder],
             key_cols: Sequence[str], max_attempts: int = 1, mode: str = "quarantine",
             wait_seconds: float = 0.0) -> DataFrame:
    """Run ``responder(messages) -> (text, prompt_tokens, completion_tokens)``.

    Rows are clustered by configuration inside each task so a task opens one
    client per configuration.  Output: keys, ``model``, ``response``,
    ``prompt_tokens``, ``completion_tokens``, ``error``.
    """
    keys = list(key_cols)
    src = requests.select(*keys, *CONFIG_COLUMNS, "messages").sortWithinPartitions(*CONFIG_COLUMNS)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients = _Clients(responder_factory, max_attempts, wait_seconds)
        for pdf in it:
            out = []
            for rec in pdf.to_dict("records"):
                text, pt, ct, err = clients.answer(rec)
                if err is not None and mode == "strict":
                    raise RuntimeError(err)
                out.append([rec[k] for k in keys] + [rec["model"], text, pt, ct, err])
            yield pd.DataFrame(out, columns=keys + ["model", *ANSWER_COLUMNS])

    return src.mapInPandas(run, f"{_schema_of(requests, keys)}, model string, response string, prompt_tokens bigint, "
                                "completion_tokens bigint, error string")


def _schema_of(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*cols).schema.fields)


ANSWER_COLUMNS = ["response", "prompt_tokens", "completion_tokens", "error"]
CALL_SCHEMA = pa.schema([("call_id", pa.string()), ("request_id", pa.string()), ("model", pa.string()),
                         ("prompt_tokens", pa.int64()), ("completion_tokens", pa.int64()), ("response", pa.string())])


def request_id(keys: Sequence[str]) -> Column:
    """Names a request by its keys, configuration and messages."""
    return F.sha2(F.to_json(F.struct(*[F.col(k) for k in keys], *CONFIG_COLUMNS, "messages"), {"ignoreNullFields": "false"}), 256)


def recorded_answers(spark: SparkSession, ledger: str, run_id: str) -> DataFrame | None:
    """``request_id, model, response, prompt_tokens, completion_tokens`` of a run, one row per request."""
    folder = calls_folder(ledger, run_id)
    if not exists(spark, folder):
        return None
    fields = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'string'}" for n, t in zip(CALL_SCHEMA.names, CALL_SCHEMA.types, strict=True))
    calls = spark.read.schema(fields).option("recursiveFileLookup", "true").parquet(folder)
    first = F.min(F.struct("call_id", "response", "prompt_tokens", "completion_tokens"))
    return (calls.groupBy("request_id").agg(first.alias("a"))
            .select("request_id", "a.response", "a.prompt_tokens", "a.completion_tokens"))


def generate_recorded(requests: DataFrame, responder_factory, key_cols: Sequence[str], ledger: str,
                      run_id: str | None = None, max_attempts: int = 1, mode: str = "quarantine",
                      wait_seconds: float = 0.0, every: int = 32, seconds: float = 5.0) -> DataFrame:
    """``generate``, with each answered call written to the ledger as it returns.

    A batch that ended early (``strict`` mode after a failure, a lost driver) is
    taken up by giving its ``run_id`` again: requests that have an answer (same keys,
    configuration and messages) are not asked again.  Equal rows of one batch may be asked once
    each; all get the first answer.  An attempt of a task that Spark repeats
    leaves out what the attempts before it recorded.  The result is written before it
    is returned.
    """
    spark, keys = requests.sparkSession, list(key_cols)
    run_id = run_id or uuid.uuid4().hex
    src = (requests.select(*keys, *CONFIG_COLUMNS, "messages").withColumn("_request", request_id(keys))
           .checkpoint(eager=True))
    known = recorded_answers(spark, ledger, run_id)
    todo = src if known is None else src.join(known.select(F.col("request_id").alias("_request")), "_request", "left_anti")
    job = Journal(qualified(spark, f"{calls_folder(ledger, run_id)}/{uuid.uuid4().hex}"), "request_id", CALL_SCHEMA, every, seconds)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition = TaskContext.get().partitionId()
        done = job.recorded(partition)
        clients = _Clients(responder_factory, max_attempts, wait_seconds)
        with job.writer(partition) as log:
            for pdf in it:
                failed = []
                for rec in pdf.to_dict("records"):
                    if rec["_request"] in done:
                        continue
                    text, pt, ct, err = clients.answer(rec)
                    if err is None:
                        log.add({"call_id": uuid.uuid4().hex, "request_id": rec["_request"], "model": rec["model"],
                                 "prompt_tokens": pt, "completion_tokens": ct, "response": text})
                    elif mode == "strict":
                        raise RuntimeError(err)
                    else:
                        failed.append((rec["_request"], err))
                yield pd.DataFrame(failed, columns=["_request", "error"])

    errors = (todo.sortWithinPartitions(*CONFIG_COLUMNS).mapInPandas(run, "_request string, error string")
              .checkpoint(eager=True).groupBy("_request").agg(F.min("error").alias("_error")))
    out = src.drop("messages").join(errors, "_request", "left")
    answers = recorded_answers(spark, ledger, run_id)
    if answers is None:
        for name, kind in zip(ANSWER_COLUMNS[:3], ("string", "bigint", "bigint"), strict=True):
            out = out.withColumn(name, F.lit(None).cast(kind))
        out = out.withColumn("_answered", F.lit(False))
    else:
        out = out.join(answers.withColumn("_answered", F.lit(True)).withColumnRenamed("request_id", "_request"), "_request", "left")
    result = out.select(*keys, "model", *ANSWER_COLUMNS[:3],
                        F.when(F.col("_answered"), F.lit(None)).otherwise(F.col("_error")).alias("error")).checkpoint(eager=True)
    close_run(spark, ledger, run_id)
    return result


def generate_once(requests: DataFrame, responder_factory, key_cols: Sequence[str], **kw) -> DataFrame:
    """``generate``, written to the shared checkpoint folder at once: whatever
    reads the responses afterwards does not call the model again."""
    return generate(requests, responder_factory, key_cols, **kw).checkpoint(eager=True)


def echo_responder(model: str, provider: str, temperature: float, max_tokens: int) -> Responder:
    """Deterministic offline responder: answers "I don't know." and counts
    whitespace-separated words as tokens."""
    def respond(messages: list[dict]) -> tuple[str, int, int]:
        prompt_tokens = sum(len(m["content"].split()) for m in messages)
        return "I don't know.", prompt_tokens, 3
    return respond
