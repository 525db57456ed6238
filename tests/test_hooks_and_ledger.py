"""Build hooks, ledger, ranking on raw scores, rejects, rebuilt subjects, hidden entries."""

import html
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import one
from test_streaming_and_sources import make_corpus, write
from vellum.api import DatabaseBuilder, Generator, Retriever
from vellum.functions.html import html_text, html_title
from vellum.operators import retrieve as R
from vellum.operators.embed import HashEmbedder, check_one_to_one, embed, over_limit, token_guard
from vellum.operators.generate import echo_responder, generate, generate_once
from vellum.operators.usage import append_usage, read_usage, record_usage, usage_by_model
from vellum.plans.build import build_and_write, build_database
from vellum.session import ensure_checkpoint_dir
from vellum.sources.corpus import load_corpus, load_pdf, rejected_files, scan_corpus
from vellum.sources.store import read_store

USAGE = "request_id string, model string, prompt_tokens long, completion_tokens long"


def test_ledger_counts_every_call(spark, tmp_path):
    path = str(tmp_path / "ledger")
    calls = spark.createDataFrame([("r1", "m", 20, 2), ("r1", "m", 10, 1)], USAGE)
    append_usage(calls, path)
    got = usage_by_model(read_usage(spark, path)).first()
    assert (got.prompt_tokens, got.completion_tokens) == (30, 3)
    run = append_usage(calls, path)
    append_usage(calls, path, run)                      # the same append once more
    assert read_usage(spark, path).count() == 4


def test_ranking_uses_the_score_not_its_display(spark):
    scores = spark.createDataFrame([(0, "a", 0.80000001), (0, "b", 0.80000049), (0, "c", 0.80000049)],
                                   "query_set_id long, id string, score double")
    assert [r.id for r in R.rank_top_k(scores, 2).orderBy("rank").collect()] == ["b", "c"]
    assert [r.id for r in R.top_k_single(scores, 1).collect()] == ["b"]


def test_ties_are_cut_in_the_task(spark):
    db = spark.range(50_000).select(F.format_string("%08d", 49_999 - F.col("id")).alias("id"),
                                    F.array(F.lit(0.6), F.lit(0.8)).alias("embedding")).repartition(4)
    qs = spark.createDataFrame([(s, 0, [0.6, 0.8]) for s in range(3)], "query_set_id long, query_id long, embedding array<double>")
    scores = R.score_sets(db, qs, k=5, threshold=0.1, dim=2)
    assert scores.count() <= 5 * 3 * 4
    top = R.rank_top_k(scores, 5).where("query_set_id = 1").orderBy("rank").collect()
    assert [r.id for r in top] == ["%08d" % i for i in range(5)]


def test_query_blocks_are_bounded_by_bytes(spark):
    qs = spark.range(400).select(F.lit(0).cast("bigint").alias("query_set_id"), F.col("id").alias("query_id"),
                                 F.array_repeat(F.col("id").cast("double"), 3072).alias("embedding"))
    parts = R.query_blocks(qs, block_bytes=1 << 20)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 400 and max(sizes) * 3072 * 8 <= 1 << 20


def test_scores_are_tiled(spark, monkeypatch):
    rng = np.random.default_rng(0)
    db = spark.createDataFrame([(i, rng.standard_normal(4).tolist()) for i in range(300)], "id long, embedding array<double>")
    qs = spark.createDataFrame([(i % 7, i, rng.standard_normal(4).tolist()) for i in range(50)],
                               "query_set_id long, query_id long, embedding array<double>")
    whole = sorted(R.rank_top_k(R.score_sets(db, qs, k=4, threshold=0.0, dim=4), 4).collect())
    native = sorted(R.rank_top_k(R.score_sets_native(db, qs, threshold=0.0, dim=4), 4).select(*whole[0].__fields__).collect())
    assert [(r.query_set_id, r.id, r["rank"]) for r in whole] == [(r.query_set_id, r.id, r["rank"]) for r in native]


def test_subfolders_and_hidden_entries(spark):
    root = make_corpus()
    os.makedirs(os.path.join(root, "test", "sub"))
    write(os.path.join(root, "test", "sub"), "d.txt", b"inside")
    write(os.path.join(root, "test"), ".e.txt", b"hidden")
    files = scan_corpus(spark, root, "test")
    with pytest.raises(Exception, match="Unsupported file format"):
        build_database(files).collect()
    why = sorted(r.error.rsplit("/test/", 1)[-1] for r in rejected_files(files).collect())
    assert why == [".e.txt (hidden)", "sub/"]
    store = os.path.join(root, "store")
    counts = build_and_write(files, store, mode="quarantine", chunk_size=64, overlap_size=8)
    assert counts["rejected_files"] == 2 and counts["documents"] == 4 and counts["rejected_chunks"] == 0


def test_each_file_is_read_by_one_scan(spark):
    root = make_corpus()
    docs = load_corpus(scan_corpus(spark, root, "test"))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    # txt and html files go through one branch each, pdf files through a third
    assert plan.count("binaryFile") == 3


def test_quarantined_chunks_are_counted(spark, tmp_path):
    root = make_corpus()
    files = scan_corpus(spark, root, "test")
    # a counter that finds the html page too long
    counter = lambda c: F.when(c.contains("Einstein"), 9000).otherwise(F.length(c))
    counts = build_and_write(files, str(tmp_path / "s"), mode="quarantine", token_counter=counter)
    assert counts["rejected_chunks"] == 1 and counts["chunks"] == 3
    df = spark.createDataFrame([(8191,), (8192,)], "tokens int")
    assert over_limit(df).count() == 1 and token_guard(df, mode="quarantine").count() == 1


def test_rebuild_without_rows_leaves_none(spark, tmp_path):
    root, store = make_corpus(), str(tmp_path / "store")
    DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, store_path=store).build_database(root)
    assert read_store(spark, store, "test").count() > 0
    counts = DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, min_text_length=10_000, store_path=store).build_database(root)
    assert counts["chunks"] == 0 and counts["total_tokens"] == 0
    with pytest.raises(FileNotFoundError, match="test"):        # a subject without data
        read_store(spark, store, "test")


def test_real_pdf_needs_an_extractor(spark):
    files = spark.createDataFrame([("s", "a.pdf", "pdf", bytearray(b"%PDF-1.4 obj<</Type/Catalog>>"))],
                                  "subject string, path string, format string, content binary")
    with pytest.raises(Exception, match="page extractor"):
        load_pdf(files).collect()
    pages = load_pdf(files, lambda data: [str(len(data)), "two"]).orderBy("page").collect()
    assert [(r.page, r.page_content) for r in pages] == [(0, "29"), (1, "two")]


def counting(log):
    """Factory of an embedder that writes down its texts (all defined here, so
    that it travels to the workers by value)."""
    def make():
        class Counting(HashEmbedder):
            def __call__(self, texts):
                with open(log, "a") as f:
                    f.writelines("%d\n" % len(t) for t in texts)
                vectors, _ = HashEmbedder.__call__(self, texts)
                return vectors, 100 * len(texts)

        return Counting(64)

    return make


def test_user_embedder_in_build_and_retrieval(spark, tmp_path):
    root, store, log = make_corpus(), str(tmp_path / "store"), str(tmp_path / "log")
    builder = DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, store_path=store,
                              embedder_factory=counting(log), model="mine")
    chunks = builder.build_database(root)["chunks"]
    assert {r.embedding_model for r in read_store(spark, store, "test").collect()} == {"mine"}
    with open(log) as f:
        assert len(f.readlines()) == chunks
    with pytest.raises(ValueError, match="needs an embedder_factory"):
        DatabaseBuilder(spark, "test", store_path=store, model="mine").rows(root)
    with pytest.raises(ValueError, match="built with"):
        Retriever(spark, "test", store_path=store)
    asked = str(tmp_path / "asked")
    docs, tokens = Retriever(spark, "test", store_path=store, model="mine", embedder_factory=counting(asked)).retrieve(
        ["When was Einstein born?", "Einstein birthday"], top_k=2, threshold=0.0)
    assert docs.count() == 2 and docs.collect() and tokens == 200
    with open(asked) as f:
        assert len(f.readlines()) == 2                  # every phrasing once


def test_generation_is_recorded_once(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    req = spark.createDataFrame([(i, "gpt-4o", "AzureOpenAI", 0.0, 10, [{"role": "user", "content": "a b"}]) for i in range(4)],
                                "k int, model string, provider string, temperature double, max_tokens int, "
                                "messages array<struct<role:string,content:string>>")

    def picky(*config):
        answer = echo_responder(*config)
        calls = []

        def respond(messages):
            calls.append(1)
            if len(calls) % 2:
                raise RuntimeError("busy")
            return answer(messages)
        return respond

    answers = generate_once(req, picky, ["k"], max_attempts=2, wait_seconds=0.01)
    assert answers.where("error is null").count() == 4
    got = usage_by_model(record_usage(answers, ledger, "k")).first()
    assert (got.model, got.prompt_tokens, got.completion_tokens) == ("gpt-4o", 8, 12)
    failed = generate(req.coalesce(1), picky, ["k"], max_attempts=1).orderBy("k").collect()
    assert [r.error is None for r in failed] == [False, True, False, True]
    assert "API request failed: busy" in failed[0].error
    with pytest.raises(Exception, match="busy"):
        generate(req, picky, ["k"], mode="strict").collect()
    one_set = spark.createDataFrame([(0, 1, "text", None)], "query_set_id long, rank int, content string, metadata struct<source:string>")
    Generator(echo_responder, "AzureOpenAI", "gpt-4o", ledger_path=ledger).generate_response("q?", one_set)
    assert read_usage(spark, ledger).count() == 5


def test_budget_of_zero_is_kept(spark):
    assert Generator(echo_responder, max_tokens=0).max_tokens == 0


def test_embed_attempts_and_quarantine(spark):
    class Flaky(HashEmbedder):
        tries = 0

        def __call__(self, texts):
            Flaky.tries += 1
            if Flaky.tries < 3 or "bad" in texts[0]:
                raise RuntimeError("busy")
            return HashEmbedder.__call__(self, texts)

    df = spark.createDataFrame([(1, "good")], "k int, content string").coalesce(1)
    assert embed(df, lambda: Flaky(64), ["k"], tokens_col=None, max_attempts=3, wait_seconds=0.01).first().error is None
    bad = spark.createDataFrame([(1, "bad")], "k int, content string")
    row = embed(bad, lambda: Flaky(64), ["k"], tokens_col=None, max_attempts=2, mode="quarantine").first()
    assert row.error == "busy" and row.embedding is None
    with pytest.raises(Exception, match="busy"):
        embed(bad, lambda: Flaky(64), ["k"], tokens_col=None).collect()
    short = spark.createDataFrame([("a",)], "id string")
    check_one_to_one(short, short)
    with pytest.raises(ValueError, match="pair"):
        check_one_to_one(short, short.limit(0))


HAZARDS = [
    ("<script>var a='<!--';</script><p>KEEP THIS</p><!-- c --><p>end</p>", "KEEP THISend"),
    ('<a title="a > b">x</a>', "x"),
    ("text <!-- open <p>gone</p>", "text "),
    ("<style>p{}</style ><p class='x>y'>q</p> 3 < 4", "q 3 < 4"),
    ("&#xD800;&#99999999999999999999;&#xFFFFFFFFFFFFFFFFFFFF;&#0;", "�" * 4),
    ("<a " + "b " * 20_000 + ">k", "k"),
    ("<" * 50, "<" * 50),
]


@pytest.mark.parametrize("page,text", HAZARDS)
def test_html_hazards(spark, page, text):
    assert one(spark, html_text(F.col("v")), page) == text


def test_references_follow_the_standard_library(spark):
    for text in ("&lbrace; &copy 2020 &copy2020 &#128;&#x80; &notit; &amp;lt; &zz; & &; &# &#x; &#65 &#x41z &#0000000065; &AMP &ngE; &ThickSpace;",
                 "&" * 40, "&nbsp;&eacute&Eacute;", "no reference"):
        assert one(spark, html_text(F.col("v")), text) == html.unescape(text)


def test_title_is_the_real_one(spark):
    page = "<script><title>no</title></script><title lang='x>'>T &amp; U</title><title>2</title>"
    assert one(spark, html_title(F.col("v")), page) == "T & U"


def test_chunker_at_the_default_stack():
    """Tasks get the chunker's expression on a plain thread stack."""
    import subprocess
    import sys
    code = ("from pyspark.sql import SparkSession; from vellum.plans import catalog; import __spark_entry__ as E\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            "print('ROWS', E.queries()['chunk_512_64'](s, '/root/testdata/sf0.001').count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "ROWS 1154" in out.stdout, out.stderr[-2000:]


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key):
                raise KeyError(key)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
