import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from vellum.operators.generate import echo_responder, generate, generate_recorded
from vellum.operators.usage import (append_usage, calls_folder, export_usage_json, read_usage, seal_usage, usage_by_model,
                                    usage_json)
from vellum.sources.shared_files import names_in

REQUEST = ("k int, model string, provider string, temperature double, max_tokens int, "
           "messages array<struct<role:string,content:string>>")


def requests(spark, keys, text="a b"):
    return spark.createDataFrame([(k, "gpt-4o", "AzureOpenAI", 0.0, 10, [{"role": "user", "content": f"{text} {k}"}]) for k in keys], REQUEST)


def logging_responder(log, fails_at=None):
    """Writes down each call; fails for the message that ends in ``fails_at``, as long as its marker file is missing."""
    def make(*config):
        def respond(messages):
            content = messages[-1]["content"]
            with open(log, "a") as f:
                f.write(content + "\n")
            if fails_at is not None and content.endswith(f" {fails_at}") and not os.path.exists(f"{log}.mended"):
                raise RuntimeError("out of funds")
            return f"answer to {content}", len(content.split()), 3
        return respond
    return make


def lines(log):
    with open(log) as f:
        return f.read().splitlines()


def test_a_failed_batch_keeps_its_paid_calls_and_goes_on_from_there(spark, tmp_path):
    ledger, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    batch = requests(spark, range(20)).coalesce(1)
    with pytest.raises(Exception, match="out of funds"):
        generate_recorded(batch, logging_responder(log, 13), ["k"], ledger, run_id="r", mode="strict")
    paid = len(lines(log)) - 1                                   # the last one failed
    assert paid == 13
    assert read_usage(spark, ledger).count() == paid             # a usage row for each call that was answered
    open(f"{log}.mended", "w").close()
    out = generate_recorded(batch, logging_responder(log, 13), ["k"], ledger, run_id="r", mode="strict").orderBy("k").collect()
    assert [(r.k, r.response, r.error) for r in out] == [(k, f"answer to a b {k}", None) for k in range(20)]
    assert len(lines(log)) == 20 + 1                             # only the rest was asked for
    assert usage_by_model(read_usage(spark, ledger)).first()[1:] == (60, 60)
    generate_recorded(batch, logging_responder(log), ["k"], ledger, run_id="r")
    assert len(lines(log)) == 21
    generate_recorded(requests(spark, [1], "c d"), logging_responder(log), ["k"], ledger, run_id="r")
    assert len(lines(log)) == 22                                 # another message is another request
    generate_recorded(batch, logging_responder(log), ["k"], ledger)
    assert len(lines(log)) == 42 and read_usage(spark, ledger).count() == 41    # another batch pays anew


def test_recorded_gives_what_generate_gives(spark, tmp_path):
    ledger, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    batch = requests(spark, [*range(8), 3, None]).repartition(3)
    make = logging_responder(log, 5)
    want = sorted(map(tuple, generate(batch, make, ["k"]).collect()), key=repr)
    got = generate_recorded(batch, make, ["k"], ledger)
    assert sorted(map(tuple, got.collect()), key=repr) == want and got.columns == generate(batch, make, ["k"]).columns
    assert read_usage(spark, ledger).count() == 9                # the failed one is not paid
    none = generate_recorded(requests(spark, [5]), make, ["k"], str(tmp_path / "other")).first()
    assert none.response is None and none.error == "API request failed: out of funds"
    assert generate_recorded(batch.limit(0), make, ["k"], ledger).count() == 0
    assert generate_recorded(batch, echo_responder, ["k"], ledger).where("error is null").count() == 10


def test_a_repeated_task_does_not_pay_twice(tmp_path):
    """Spark runs the failed task again: its first attempt's calls are on record."""
    code = f"""
import os, sys
sys.path[:0] = {[os.path.dirname(__file__), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]!r}
from vellum.session import get_spark
from vellum.operators.generate import generate_recorded
from vellum.operators.usage import read_usage
spark = get_spark("local[2,3]", shuffle_partitions=2)
import test_ledger as t
log, ledger = {str(tmp_path / 'log')!r}, {str(tmp_path / 'ledger')!r}
def make(*config):
    def respond(messages):
        content = messages[-1]["content"]
        with open(log, "a") as f:
            f.write(content + "\\n")
        if content.endswith(" 6") and open(log).read().count("b 6\\n") < 3:
            raise RuntimeError("busy")
        return "ok", 1, 1
    return respond
out = generate_recorded(t.requests(spark, range(10)).coalesce(1), make, ["k"], ledger, mode="strict")
print("ROWS", out.where("response = 'ok'").count(), "CALLS", len(open(log).readlines()), "PAID", read_usage(spark, ledger).count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert "ROWS 10 CALLS 12 PAID 10" in done.stdout, done.stderr[-3000:]


def facts(spark, *names):
    return spark.createDataFrame([(n, "r" + n, "gpt-4o", 10, 1) for n in names],
                                 "call_id string, request_id string, model string, prompt_tokens long, completion_tokens long")


def calls(df):
    return sorted(r.call_id for r in df.collect())


def test_sealing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_usage(spark, path).count() == 0 and seal_usage(spark, path) == 0
    run = append_usage(facts(spark, "a", "b"), path)
    append_usage(facts(spark, "a", "b"), path, run)              # a replay
    assert calls(read_usage(spark, path)) == ["a", "b"]
    assert seal_usage(spark, path, remove=False) == 2            # ended before it could remove
    assert calls(read_usage(spark, path)) == ["a", "b"]
    assert seal_usage(spark, path) == 0
    assert calls(read_usage(spark, path)) == ["a", "b"]
    assert not any(n.endswith(".parquet") for n in names_in(spark, calls_folder(path, run)))
    plan = read_usage(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan    # sealed calls are taken as they are
    append_usage(facts(spark, "b", "c"), path, run)              # a late replay with a new call
    assert calls(read_usage(spark, path)) == ["a", "b", "c"]
    append_usage(facts(spark, "d", "d"), path)
    assert seal_usage(spark, path) == 2 and calls(read_usage(spark, path)) == ["a", "b", "c", "d"]


def test_only_the_tail_is_searched_for_repeats(spark, tmp_path):
    path = str(tmp_path / "ledger")
    append_usage(spark.range(5000).select(F.col("id").cast("string").alias("call_id"), F.lit("q").alias("request_id"), F.lit("gpt-4o").alias("model"),
                                          F.lit(1).cast("bigint").alias("prompt_tokens"), F.lit(1).cast("bigint").alias("completion_tokens")), path)
    seal_usage(spark, path)
    append_usage(facts(spark, "7", "new"), path)
    df = read_usage(spark, path)
    assert df.count() == 5001
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2     # sealed rows meet broadcast ids


def test_files_of_an_open_run_stay(spark, tmp_path):
    ledger, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    batch = requests(spark, range(6)).coalesce(1)
    with pytest.raises(Exception, match="out of funds"):
        generate_recorded(batch, logging_responder(log, 4), ["k"], ledger, run_id="r", mode="strict")
    assert seal_usage(spark, ledger) == 4
    open(f"{log}.mended", "w").close()
    generate_recorded(batch, logging_responder(log, 4), ["k"], ledger, run_id="r", mode="strict")
    assert len(lines(log)) == 7 and read_usage(spark, ledger).count() == 6
    assert seal_usage(spark, ledger) == 2 and read_usage(spark, ledger).count() == 6


def test_json_export(spark, tmp_path):
    path, target = str(tmp_path / "ledger"), str(tmp_path / "tokens_usage.json")
    append_usage(spark.createDataFrame([("gpt-4o", 1000, 1000), ("mine", 500, 500), ("gpt-4o", 0, 0)],
                                       "model string, prompt_tokens long, completion_tokens long").withColumn("request_id", F.lit("r")), path)
    totals = export_usage_json(spark, path, target)
    with open(target) as f:
        assert json.load(f) == totals == {"gpt-4o": {"prompt_tokens": 1000, "completion_tokens": 1000},
                                          "mine": {"prompt_tokens": 500, "completion_tokens": 500}, "overall_cost": 0.018}
    assert usage_json(read_usage(spark, str(tmp_path / "none"))) == {"overall_cost": 0.0}


def test_names_with_special_characters(spark, tmp_path):
    """Spaces, percent signs and the like in folders and run names are taken as they stand."""
    ledger, log = str(tmp_path / "a b%20c" / "ledger"), str(tmp_path / "log")
    batch = requests(spark, range(5))
    for _ in range(2):
        out = generate_recorded(batch, logging_responder(log), ["k"], ledger, run_id="run 1%2F2")
        assert out.where("response is not null").count() == 5
    assert len(lines(log)) == 5 and read_usage(spark, ledger).count() == 5
    assert seal_usage(spark, ledger) == 5 and read_usage(spark, ledger).count() == 5
    assert not [n for n in names_in(spark, calls_folder(ledger, "run 1%2F2")) if n.endswith(".parquet")]
