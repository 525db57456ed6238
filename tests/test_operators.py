import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions.html import html_text, html_title
from vellum.functions.text import normalise_whitespace, py_strip, universal_newlines
from vellum.operators.context import (assemble_context, budgeted_blocks, build_prompt,
                                      document_block)
from vellum.operators.embed import embed_batches, token_guard
from vellum.operators.generate import admit_requests, allow_list, embedding_provider_ok
from vellum.operators.retrieve import (check_top_k, rank_top_k, score_sets, score_sets_native,
                                       top_k_single)
from vellum.operators.usage import cost_rates, usage_cost
from vellum.sources.corpus import admit_files, admitted


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col.alias("r")).first().r


def test_normalise_and_newlines(spark):
    assert one(spark, normalise_whitespace(F.col("v")), "a\n\tb\xa0c\rd") == "a  b c\rd"
    assert one(spark, normalise_whitespace(universal_newlines(F.col("v"))), "a\r\nb\rc") == "a b c"
    assert one(spark, py_strip(F.col("v")), "  x y\x1f\t") == "x y"


def test_admission(spark):
    df = spark.createDataFrame([(p,) for p in ["a.PDF", "b.html", "c.TXT", "d.htm", "e.md"]], "path string")
    got = {r.path: r.ok for r in df.select("path", admitted("path").alias("ok")).collect()}
    assert got == {"a.PDF": True, "b.html": True, "c.TXT": True, "d.htm": False, "e.md": False}
    assert admit_files(df, "quarantine").count() == 3
    with pytest.raises(Exception, match="Unsupported file format"):
        admit_files(df, "strict").collect()


def test_html(spark):
    page = ("<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style></head>"
            "<body><!-- c --><script>var t=\"</p>\";</script><p>a &lt;b&gt; &#233;&#x41; &amp;lt; &zz; 3 < 4</p></body></html>")
    assert one(spark, html_text(F.col("v")), page) == "T & Ua <b> éA &lt; &zz; 3 < 4"
    assert one(spark, html_title(F.col("v")), page) == "T & U"


def test_token_guard(spark):
    df = spark.createDataFrame([(8191,), (8192,)], "tokens int")
    assert [r.within_limit for r in token_guard(df, mode="flag").collect()] == [True, False]
    assert token_guard(df, mode="quarantine").count() == 1
    with pytest.raises(Exception, match="exceeds the limit"):
        token_guard(df, mode="strict").collect()


@pytest.mark.parametrize("total,expected", [(99_999, 1), (199_999, 1), (200_000, 2), (350_000, 3)])
def test_batch_count(spark, total, expected):
    df = spark.createDataFrame([(i, total // 10 + (total % 10 if i == 0 else 0)) for i in range(10)],
                               "id int, tokens int")
    out = embed_batches(df, ["id"], checkpoint=False).collect()
    assert {r.n_batches for r in out} == {expected}


def test_batch_sizes_match_array_split(spark):
    for n, tokens_each in [(10, 40_000), (17, 30_000), (3, 500_000)]:
        df = spark.createDataFrame([(i, tokens_each) for i in range(n)], "id int, tokens int").repartition(4)
        rows = sorted(embed_batches(df, ["id"], checkpoint=False).collect(), key=lambda r: r.id)
        k = max(n * tokens_each // 100_000, 1)
        expected = [len(b) for b in np.array_split(np.arange(n), k)]
        sizes = [sum(1 for r in rows if r.batch == b) for b in range(k)]
        assert sizes == expected


def blocks_df(spark, lengths):
    return spark.createDataFrame([(0, i + 1, "x" * n) for i, n in enumerate(lengths)],
                                 "query_set_id long, rank int, block string")


@pytest.mark.parametrize("lengths,kept", [([1000, 1000, 100, 10], 2), ([1000, 1048, 1], 2), ([3000, 10], 0)])
def test_budget(spark, lengths, kept):
    assert budgeted_blocks(blocks_df(spark, lengths), 2048).count() == kept


def test_block_and_prompt(spark):
    df = spark.createDataFrame([("c", None)], "content string, metadata struct<source:string,page:int>")
    assert df.select(document_block().alias("b")).first().b == "Metadata: \nContent: c\n\n"
    ctx = assemble_context(budgeted_blocks(blocks_df(spark, [3, 2]), 2048)).first().context
    assert ctx == "xxxxx"
    p = spark.createDataFrame([("CTX", "Q?")], "context string, question string").select(build_prompt().alias("p")).first().p
    assert p.startswith("Use the below information chunks") and "DOCUMENTS:\n        CTX\n" in p
    assert p.endswith("Question: Q?\n        ")


def test_threshold_and_nan(spark):
    db = spark.createDataFrame([("a", [0.15, 0.0]), ("b", [0.1499, 0.0]), ("c", [math.nan, 0.0]), ("d", [-1.0, 0.0])],
                               "id string, embedding array<double>")
    qs = spark.createDataFrame([(0, 0, [1.0, 0.0])], "query_set_id long, query_id long, embedding array<double>")
    native = score_sets_native(db, qs, threshold=0.15, dim=2).collect()
    arrow = score_sets(db, qs, k=5, threshold=0.15, dim=2).collect()
    assert [r.id for r in native] == ["a"] and [r.id for r in arrow] == ["a"]


def test_max_over_set(spark):
    db = spark.createDataFrame([("a", [0.1, 0.4]), ("b", [math.nan, 0.9])], "id string, embedding array<double>")
    qs = spark.createDataFrame([(0, 0, [1.0, 0.0]), (0, 1, [0.0, 1.0])],
                               "query_set_id long, query_id long, embedding array<double>")
    got = score_sets_native(db, qs, threshold=0.15, dim=2).collect()
    assert [(r.id, r.score) for r in got] == [("a", 0.4)]


def test_top_k_edges(spark):
    scores = spark.createDataFrame([(0, "a", 0.5), (0, "b", 0.4), (0, "c", 0.3)], "query_set_id long, id string, score double")
    assert top_k_single(scores, 5).count() == 3
    assert top_k_single(scores, 0).count() == 0
    assert rank_top_k(scores, 2).count() == 2
    with pytest.raises(ValueError):
        check_top_k(-1)


def test_ragged_vectors_fail(spark):
    db = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0])], "id string, embedding array<double>")
    qs = spark.createDataFrame([(0, 0, [1.0, 0.0])], "query_set_id long, query_id long, embedding array<double>")
    with pytest.raises(Exception):
        score_sets_native(db, qs, threshold=0.0, dim=2).collect()
    with pytest.raises(Exception):
        score_sets(db, qs, k=5, threshold=0.0, dim=2).collect()


def test_ledger_cost(spark):
    usage = spark.createDataFrame([("1", "gpt-4o", 1000, 1000), ("2", "some-model", 500, 500)],
                                  "request_id string, model string, prompt_tokens long, completion_tokens long")
    rows = {r.model: r for r in usage_cost(usage, cost_rates(spark)).collect()}
    assert rows[None].cost == pytest.approx(0.018)
    assert rows["some-model"].cost == 0.0 and "gpt-4o" in rows


def test_request_admission(spark):
    req = spark.createDataFrame([("gpt-4o", "AzureOpenAI"), ("gpt-4o", "huggingface"), ("nope", "HuggingFace")],
                                "model string, provider string")
    got = [r.admitted for r in admit_requests(req, allow_list(spark)).orderBy("model", "provider").collect()]
    assert got == [True, False, False]
    prov = spark.createDataFrame([("OpenAI",), ("huggingface",)], "p string")
    assert [r.ok for r in prov.select(embedding_provider_ok("p").alias("ok")).collect()] == [True, False]


def test_embed_text_returns_vector(spark):
    from vellum.operators.embed import HashEmbedder, embed_text
    v = embed_text(spark, lambda: HashEmbedder(64), "When is Albert Einstein's birthday?")
    assert len(v) == 64 and abs(sum(x * x for x in v) - 1.0) < 1e-9


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=90_000), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=7))
def test_global_batches_match_array_split(spark, tokens, parts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "id int, tokens int").repartition(parts)
    rows = sorted(embed_batches(df, ["id"], checkpoint=False).collect(), key=lambda r: r.id)
    k = max(sum(tokens) // 100_000, 1)
    expected = np.concatenate([np.full(len(b), j) for j, b in enumerate(np.array_split(np.arange(len(tokens)), k))])
    assert [r.batch for r in rows] == expected.tolist()
