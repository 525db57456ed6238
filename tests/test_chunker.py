import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sample_tables import SF0001
from splitter_oracle import split_text
from vellum.operators.chunker import check_chunk_params, chunk_array, split_documents
from vellum.plans import catalog


def chunks(spark, texts, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    got = {r.k: [c.content for c in r.c] for r in df.select("k", chunk_array("t", size, overlap).alias("c")).collect()}
    return [got[i] for i in range(len(texts))]


def test_golden_case(spark):
    text = "a " + "x" * 25 + " bb cc dd ee ff"
    assert chunks(spark, [text], 10, 4)[0] == ["a", "x" * 9, "x" * 10, "x" * 10, "x" * 8, "bb cc dd", "dd ee ff"]


def test_parameters_refused():
    for size, overlap in [(0, 1), (5, 0), (4, 5)]:
        with pytest.raises(ValueError):
            check_chunk_params(size, overlap)


def test_edge_texts(spark):
    texts = ["", " ", "   a   ", "abc", "a b", "x" * 30]
    for size, overlap in [(1, 1), (2, 1), (10, 4)]:
        assert chunks(spark, texts, size, overlap) == [split_text(t, size, overlap) for t in texts]


def test_size_one_keeps_spaces(spark):
    assert chunks(spark, ["a b"], 1, 1)[0] == ["a", " ", "b"]


def test_counts_sf0001(spark):
    q = catalog.queries()
    assert q["chunk_512_64"](spark, SF0001).count() == 1154
    assert q["chunk_1000_50"](spark, SF0001).count() == 609


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab c\r é", max_size=80), min_size=1, max_size=40),
       st.sampled_from([(2, 1), (5, 2), (7, 7), (10, 4), (16, 15), (1, 1)]))
def test_matches_plain_splitter(spark, texts, params):
    size, overlap = params
    assert chunks(spark, texts, size, overlap) == [split_text(t, size, overlap) for t in texts]


def test_split_documents_keeps_parent_and_filters(spark):
    df = spark.createDataFrame([(1, "ab abc abcd", "m")], "id int, page_content string, meta string")
    out = split_documents(df, "page_content", 4, 1, min_length=3).collect()
    expected = [c for c in split_text("ab abc abcd", 4, 1) if len(c) >= 3]
    assert [r.content for r in out] == expected and len(expected) < len(split_text("ab abc abcd", 4, 1))
    assert all(r.meta == "m" and r.id == 1 for r in out)
    assert "page_content" not in out[0].asDict()


def test_large_document_is_linear(spark):
    """One long document (the whole sf0.001 corpus joined) chunks like the
    plain splitter; the blocked fold must not degrade with length."""
    from vellum.functions.text import normalise_whitespace
    from vellum.session import read_table
    docs = read_table(spark, SF0001, "documents").orderBy("doc_id").select(normalise_whitespace("text").alias("t"))
    text = " ".join(r.t for r in docs.collect())
    got = chunks(spark, [text], 512, 64)[0]
    assert got == split_text(text, 512, 64)
