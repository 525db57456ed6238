import os
import tempfile

import pytest

from splitter_oracle import split_text
from vellum.plans.build import build_database
from vellum.sources.corpus import load_corpus, scan_corpus
from vellum.sources.store import read_store
from vellum.streaming.ingest import start_ingest, table_stream_build

HTML = ("<html><head><title>Einstein &amp; Co</title><script>x()</script></head>"
        "<body><p>Albert&nbsp;Einstein was born\r\non 14 March 1879.</p></body></html>")


def write(folder, name, data: bytes):
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(data)


def make_corpus():
    root = tempfile.mkdtemp(prefix="vellum-corpus-")
    os.makedirs(os.path.join(root, "test"))
    write(os.path.join(root, "test"), "a.txt", "Line one\r\nline two\tand more".encode())
    write(os.path.join(root, "test"), "b.HTML", HTML.encode())
    write(os.path.join(root, "test"), "c.pdf", "page zero\fpage one".encode())
    return root


def test_file_sources(spark):
    root = make_corpus()
    files = scan_corpus(spark, root, "test")
    docs = {(os.path.basename(r.path), r.page): r for r in load_corpus(files).collect()}
    assert docs[("a.txt", None)].page_content == "Line one\nline two\tand more"
    assert docs[("a.txt", None)].metadata.source == "Klexikon"
    html = docs[("b.HTML", None)]
    assert html.metadata.title == "Einstein & Co"
    assert html.page_content == "Einstein & CoAlbert\xa0Einstein was born\non 14 March 1879."
    assert docs[("c.pdf", 0)].page_content == "page zero" and docs[("c.pdf", 1)].page_content == "page one"
    with pytest.raises(FileNotFoundError):
        scan_corpus(spark, root, "missing")


def test_strict_build_refuses_other_files(spark):
    root = make_corpus()
    write(os.path.join(root, "test"), "notes.md", b"x")
    with pytest.raises(Exception, match="Unsupported file format"):
        build_database(scan_corpus(spark, root, "test")).collect()
    ok = build_database(scan_corpus(spark, root, "test"), mode="quarantine").count()
    assert ok > 0


def test_build_chunks_follow_splitter(spark):
    root = make_corpus()
    rows = build_database(scan_corpus(spark, root, "test"), chunk_size=12, overlap_size=4).collect()
    txt = sorted((r.chunk_index, r.content) for r in rows if r.metadata.source == "Klexikon")
    assert [c for _, c in txt] == split_text("Line one line two and more", 12, 4)
    assert all(len(r.embedding) == 64 for r in rows)


def test_streaming_ingest_is_incremental(spark):
    root = make_corpus()
    store = tempfile.mkdtemp(prefix="vellum-store-")
    ckpt = tempfile.mkdtemp(prefix="vellum-stream-")
    q = start_ingest(spark, root, "test", store, checkpoint_location=ckpt)
    q.awaitTermination(120)
    first = read_store(spark, store, subject="test").count()
    write(os.path.join(root, "test"), "d.txt", b"Another document arrives later.")
    q = start_ingest(spark, root, "test", store, checkpoint_location=ckpt)
    q.awaitTermination(120)
    after = read_store(spark, store, subject="test")
    batch = build_database(scan_corpus(spark, root, "test")).count()
    assert after.count() == batch > first
    assert after.select("id").distinct().count() == batch


def test_reference_style_facade(spark):
    from vellum.api import DatabaseBuilder, Generator, Retriever
    from vellum.operators.generate import echo_responder
    root = make_corpus()
    store = tempfile.mkdtemp(prefix="vellum-api-")
    DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, store_path=store).build_database(root)
    docs, tokens = Retriever(spark, "test", store_path=store).retrieve(
        ["When was Albert Einstein born?", "Einstein birthday"], top_k=3, threshold=0.1)
    rows = docs.orderBy("rank").collect()
    assert tokens > 0 and 1 <= len(rows) <= 3
    assert "Einstein" in rows[0].content
    out = Generator(echo_responder, "AzureOpenAI", "gpt-4o").generate_response("When was Einstein born?", docs)
    assert out.first().response == "I don't know."
    with pytest.raises(ValueError):
        Generator(echo_responder, "HuggingFace", "not-a-model").generate_response("q", docs).collect()
    with pytest.raises(FileNotFoundError):
        Retriever(spark, "other", store_path=store)


def test_build_metrics_and_model_check(spark):
    from vellum.api import DatabaseBuilder, Retriever
    root = make_corpus()
    store = tempfile.mkdtemp(prefix="vellum-obs-")
    counts = DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, store_path=store).build_database(root)
    assert counts["chunks"] == read_store(spark, store, subject="test").count()
    assert counts["documents"] == 4 and counts["total_tokens"] > 0
    with pytest.raises(ValueError, match="built with"):
        Retriever(spark, "test", store_path=store, model="another-model")


def test_table_stream_reads_a_folder_of_parts(spark, tmp_path):
    rows = [(k, "en", f"Document {k} is short.") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "one"))
    part = next(n for n in os.listdir(tmp_path / "one") if n.endswith(".parquet"))
    os.makedirs(tmp_path / "file")
    os.rename(tmp_path / "one" / part, tmp_path / "file" / "documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "parts" / "documents.parquet"))
    for name in ("file", "parts"):
        store = str(tmp_path / f"store-{name}")
        query = table_stream_build(spark, str(tmp_path / name), store)
        query.awaitTermination()
        assert sorted(r.content for r in read_store(spark, store).collect()) == [t for _, _, t in rows]
