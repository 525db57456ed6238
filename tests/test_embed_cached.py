import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sample_tables import SF0001
from vellum.api import DatabaseBuilder
from vellum.operators.embed import HashEmbedder, embed_batches
from vellum.operators.embed_cached import attach_embeddings, cached_embeddings, cached_vectors, text_digest
from vellum.operators.generate import admit_embedding_providers
from vellum.sources.store import read_store

CHUNKS = "id string, content string, tokens int, path string, chunk_index int"
ORDER = ["path", "chunk_index"]


def counting(log, fails_on=None):
    """An embedder that writes down the number of texts of each call."""
    def make():
        class Counting(HashEmbedder):
            def __call__(self, texts):
                if fails_on in texts and not os.path.exists(f"{log}.mended"):
                    raise RuntimeError("out of funds")
                with open(log, "a") as f:
                    f.write(f"{len(texts)} {sorted(texts)[0]}\n")
                return HashEmbedder.__call__(self, texts)
        return Counting(64)
    return make


def calls(log):
    with open(log) as f:
        return [int(x.split()[0]) for x in f]


def staged(spark, tmp_path, rows, name="staged"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, CHUNKS).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def some_rows(n=300, repeats=True):
    return [(f"id{k:04d}", f"text number {k % 250 if repeats else k}", 10, f"p{k // 40:03d}", k % 40) for k in range(n)]


def vectors(df):
    return {r.id: list(r.embedding) for r in df.collect()}


def expected(rows):
    embedder = HashEmbedder(64)
    return {r[0]: embedder([r[1]])[0][0].tolist() for r in rows}


def test_one_call_per_batch(spark, tmp_path):
    rows = some_rows(repeats=False)
    chunks, log = staged(spark, tmp_path, rows), str(tmp_path / "log")
    batches = embed_batches(chunks, ORDER, per_batch=400).groupBy("batch").agg(F.count("*").alias("n")).collect()
    got = cached_embeddings(chunks, counting(log), "m", ORDER, str(tmp_path / "cache"), per_batch=400)
    assert vectors(got) == expected(rows)
    assert len(batches) == 7 and sorted(calls(log)) == sorted(b.n for b in batches)     # 3000 tokens, 400 a batch


def test_a_text_is_sent_once(spark, tmp_path):
    rows = some_rows()
    chunks, log, cache = staged(spark, tmp_path, rows), str(tmp_path / "log"), str(tmp_path / "cache")
    assert vectors(cached_embeddings(chunks, counting(log), "m", ORDER, cache)) == expected(rows)
    assert calls(log) == [250]                                                          # 300 chunks, 250 texts
    assert vectors(cached_embeddings(chunks, counting(log), "m", ORDER, cache)) == expected(rows)
    assert calls(log) == [250]                                                          # unchanged: no call
    more = [*rows, ("new", "a new text", 3, "q", 0), ("null", None, 0, "q", 1)]
    assert vectors(cached_embeddings(staged(spark, tmp_path, more, "more"), counting(log), "m", ORDER, cache)).keys() >= {"new", "id0000"}
    assert calls(log)[:1] == [250] and sum(calls(log)) in (251, 252)
    cached_embeddings(chunks, counting(log), "another", ORDER, cache)
    assert sum(calls(log)) >= 501                                                       # another model has its own vectors


def test_names_with_special_characters(spark, tmp_path):
    rows = some_rows(5)
    chunks, log, cache = staged(spark, tmp_path, rows), str(tmp_path / "log"), str(tmp_path / "c d%2Fe")
    for _ in range(2):
        assert vectors(cached_embeddings(chunks, counting(log), "text/embed 3%", ORDER, cache)) == expected(rows)
    assert calls(log) == [5]


def test_a_failed_build_keeps_what_it_paid(spark, tmp_path):
    rows = some_rows(repeats=False)
    chunks, log, cache = staged(spark, tmp_path, rows).coalesce(1), str(tmp_path / "log"), str(tmp_path / "cache")
    with pytest.raises(Exception, match="out of funds"):
        cached_embeddings(chunks, counting(log, "text number 150"), "m", ORDER, cache, per_batch=400)
    paid = sum(calls(log)) if os.path.exists(log) else 0
    assert (cached_vectors(spark, cache, "m").count() if paid else 0) == paid
    open(f"{log}.mended", "w").close()
    assert vectors(cached_embeddings(chunks, counting(log, "text number 150"), "m", ORDER, cache, per_batch=400)) == expected(rows)
    assert sum(calls(log)) == 300                                                       # each text was paid once


def test_wrong_vectors_are_refused(spark, tmp_path):
    chunks = staged(spark, tmp_path, some_rows(4))
    for answer, why in ((lambda t: ([[1.0]] * len(t), 1), "expected 64"), (lambda t: ([], 1), "0 vectors for 4 texts")):
        with pytest.raises(Exception, match=why):
            cached_embeddings(chunks, lambda a=answer: a, "m", ORDER, str(tmp_path / "cache")).collect()
    assert cached_embeddings(chunks.limit(0), lambda: None, "m", ORDER, str(tmp_path / "cache")).count() == 0


def test_a_rebuild_calls_nobody(spark, tmp_path):
    root, store, log = tmp_path / "data", str(tmp_path / "store"), str(tmp_path / "log")
    os.makedirs(root / "test")
    for k in range(3):
        (root / "test" / f"{k}.txt").write_text(f"Document {k} has a line. " * 12 + "Shared end.")
    builder = DatabaseBuilder(spark, "test", chunk_size=64, overlap_size=8, store_path=store, embedder_factory=counting(log), model="mine")
    counts = builder.build_database(str(root))
    before = read_store(spark, store, "test").count()
    first = calls(log)
    assert counts["chunks"] == before and len(first) == 1
    assert builder.build_database(str(root)) == counts and calls(log) == first
    (root / "test" / "3.txt").write_text("Something new.")
    assert builder.build_database(str(root))["chunks"] == before + 1 and calls(log) == [*first, 1]
    with pytest.raises(ValueError, match="Unknown provider 'huggingface'. Supported providers are 'openai' and 'azure'."):
        DatabaseBuilder(spark, "test", provider="huggingface")
    DatabaseBuilder(spark, "test", provider="OpenAI")


def pair(spark, left, right):
    return spark.createDataFrame([(k, f"c{k}") for k in left], "id int, content string"), spark.createDataFrame([(k, [1.0]) for k in right], "id int, embedding array<double>")


def test_audited_join(spark):
    a, b = pair(spark, [1, 2, 3], [3, 1, 2])
    assert sorted((r.id, r.content) for r in attach_embeddings(a, b).collect()) == [(1, "c1"), (2, "c2"), (3, "c3")]
    for left, right, why in (([1, 2], [1], "chunk without a vector: 2"), ([1], [1, 5], "vector without a chunk: 5"),
                             ([1, 1], [1], "more than once: 1"), ([1], [1, 1], "more than once: 1"), ([None], [None], "null"), ([1], [], "without a vector")):
        with pytest.raises(Exception, match=why):
            attach_embeddings(*pair(spark, left, right)).collect()
    seen = Observation("pairs")
    got = attach_embeddings(*pair(spark, [1, 2, 3, 3, 4, None], [1, 3, 5, 6, 6, 4]), mode="report", report=seen)
    assert sorted(r.id for r in got.collect()) == [1, 4]
    # vectors 3 (its chunk is there twice) and 5 are alone; every row is counted: 2 * 2 + 2 + 2 + 4 = 12
    assert seen.get == {"paired": 2, "without_vector": 2, "without_chunk": 2, "repeated": 4}
    plan = attach_embeddings(a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2                                  # the audit adds no shuffle
    assert attach_embeddings(*pair(spark, [], [])).count() == 0
    with pytest.raises(ValueError, match="mode"):
        attach_embeddings(a, b, mode="x")


def test_providers_of_embeddings(spark):
    rows = spark.createDataFrame([("OpenAI",), ("azure",), ("huggingface",), (None,)], "provider string")
    got = {r.provider: (r.admitted, r.error) for r in admit_embedding_providers(rows).collect()}
    assert got["OpenAI"] == got["azure"] == (True, None)
    assert got["huggingface"] == (False, "Unknown provider 'huggingface'. Supported providers are 'openai' and 'azure'.")
    assert not got[None][0]


def test_digest_names_the_text(spark):
    row = spark.createDataFrame([("é",)], "t string").select(text_digest("t")).first()
    import hashlib
    assert row[0] == hashlib.sha256("é".encode()).hexdigest() and SF0001


def test_missing_rows_are_noted_without_their_texts(spark, tmp_path, monkeypatch):
    from vellum.operators import embed_cached
    folders = []
    monkeypatch.setattr(embed_cached, "shared_path", lambda sp, *parts, unique: folders.append(str(tmp_path / parts[0])) or folders[-1])
    rows = some_rows()
    got = cached_embeddings(staged(spark, tmp_path, rows), lambda: HashEmbedder(64), "m", ORDER, str(tmp_path / "cache"))
    assert vectors(got) == expected(rows)
    # neither texts nor vectors are written a second time
    assert [os.path.basename(f) for f in folders] == ["missing-texts"]
    assert "content" not in spark.read.parquet(folders[0]).columns
