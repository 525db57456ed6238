"""Corpus sources: folder scan, format admission, txt / html / pdf loaders, union.

A corpus is one folder per subject holding ``.txt``, ``.html`` and ``.pdf``
files directly.  Files become a DataFrame ``(subject, path, format, content)``
and each loader turns them into documents:

    subject STRING, path STRING, format STRING, page INT,
    page_content STRING,
    metadata STRUCT<source STRING, title STRING, path STRING, page INT>

The driver's tables stand in for files in the registered queries
(``corpus_files_from_tables``): ``documents`` rows are txt files and ``pages``
rows are html files, filed under a subject folder named by their language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.html import html_text, html_title
from vellum.functions.text import TXT_SOURCE, universal_newlines
from vellum.session import read_table, spread
from vellum.sources.shared_files import hadoop_path, hadoop_system

ADMITTED_PATTERN = r"\.(pdf|html|txt)$"
METADATA_TYPE = "struct<source:string,title:string,path:string,page:int>"
DOCUMENT_COLUMNS = ["subject", "path", "format", "page", "page_content", "metadata"]


def file_format(path_col) -> Column:
    p = F.lower(F.col(path_col) if isinstance(path_col, str) else path_col)
    return F.regexp_extract(p, r"\.(pdf|html|txt)$", 1)


def admitted(path_col) -> Column:
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.lower(p).rlike(ADMITTED_PATTERN)


def admit_files(files: DataFrame, mode: str = "strict") -> DataFrame:
    """Keep ``.pdf``/``.html``/``.txt`` (case-insensitive suffix).

    ``strict``: any other file fails the job (as one bad file fails a build);
    ``quarantine``: rejected files go on as ``rejected_files`` (counted by the build).
    """
    if mode == "strict":
        fail = F.raise_error(F.concat(F.lit("Unsupported file format: "), F.col("path"),
                                      F.lit(". Only PDF, HTML and txt files are supported.")))
        return files.where(F.when(admitted("path"), F.lit(True)).otherwise(fail))
    if mode == "quarantine":
        return files.where(admitted("path"))
    raise ValueError(f"unknown mode {mode!r}")


def rejected_files(files: DataFrame) -> DataFrame:
    """What ``quarantine`` leaves out: path and reason."""
    why = F.concat(F.lit("Unsupported file format: "), F.col("path"))
    return files.where(~admitted("path")).select("subject", "path", why.alias("error"))


FORMATS = ("txt", "html", "pdf")


def _entries(spark: SparkSession, folder: str) -> list[tuple[str, str, bool, int]]:
    """(path, name, is a folder, bytes) of everything directly in ``folder``, hidden or not.

    The entries come over as three texts, not one by one: a folder may hold very
    many files.  All paths begin with the folder's own, which no name can contain."""
    jvm, path, system = spark.sparkContext._jvm, hadoop_path(spark, folder), hadoop_system(spark, folder)
    if not system.exists(path):
        raise FileNotFoundError(f"Folder not found: {folder}")
    entries = jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(system.listStatusIterator(path))
    collect, by = jvm.org.apache.commons.collections4.CollectionUtils.collect, jvm.org.apache.commons.collections4.TransformerUtils.invokerTransformer
    flags, sizes = (collect(entries, by(m)).toString()[1:-1].split(", ") for m in ("isDirectory", "getLen"))
    paths = collect(entries, by("getPath")).toString()[1:-1]
    start = system.makeQualified(path).toString().rstrip("/") + "/"
    names = paths.removeprefix(start).split(", " + start) if paths else []
    if not paths:
        return []
    if len(names) != len(flags) or any("/" in n for n in names):
        raise RuntimeError(f"the listing of {folder} cannot be read")
    return [(start + n, n, flag == "true", int(size)) for n, flag, size in zip(names, flags, sizes, strict=True)]


def _left_out(name: str) -> bool:
    """Whether Spark's own listing leaves a file of this name out."""
    hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return hidden and not name.startswith(("_metadata", "_common_metadata"))


def scan_corpus(spark: SparkSession, root: str, subject: str) -> DataFrame:
    """All direct children of ``root/subject``: ``(subject, path, format, content BINARY)``.

    Spark lists the folder once; each format is a branch over that listing, cut down
    to its files by name when it is planned, so that a loader reads the files of its
    format only.  Files of another suffix and entries that Spark's listing leaves out
    (subfolders, hidden files) are rows without content: a strict admission refuses
    them, a quarantine reports them.  Spark's scan skips files of no bytes; they
    are rows with empty content.
    """
    folder = root.rstrip("/") + "/" + subject
    odd = []
    for path, name, is_folder, size in _entries(spark, folder):
        suffix = name.lower().rpartition(".")[2] if "." in name else ""
        if is_folder:
            odd.append((subject, path + "/", "", None))
        elif _left_out(name):
            odd.append((subject, path + " (hidden)" * (suffix in FORMATS), "", None))
        elif suffix not in FORMATS:
            odd.append((subject, path, "", None))
        elif not size:
            odd.append((subject, path, suffix, bytearray()))
    raw = spark.read.format("binaryFile").load(folder)
    name = F.lower(F.col("_metadata.file_name"))
    out = None
    for fmt in FORMATS:
        of_format = raw.where(name.endswith("." + fmt))
        part = spread(of_format.select(F.lit(subject).alias("subject"), "path", F.lit(fmt).alias("format"), "content"))
        out = part if out is None else out.unionByName(part)
    if odd:
        out = out.unionByName(spark.createDataFrame(odd, "subject string, path string, format string, content binary"))
    return out


def decode_utf8(content: Column, strict: bool = False) -> Column:
    """Bytes to text.  ``strict`` fails on invalid UTF-8 (as a strict reader
    does); otherwise invalid sequences become U+FFFD."""
    s = content.cast("string")
    if strict:
        return F.when(F.is_valid_utf8(s), s).otherwise(F.raise_error(F.lit("invalid UTF-8 in corpus file")))
    return F.make_valid_utf8(s)


def _text_content(files: DataFrame) -> Column:
    dtype = dict(files.dtypes)["content"]
    return decode_utf8(F.col("content"), strict=True) if dtype == "binary" else F.col("content")


def _metadata(source: Column, title: Column, path: Column, page: Column) -> Column:
    return F.struct(source.cast("string").alias("source"), title.cast("string").alias("title"),
                    path.cast("string").alias("path"), page.cast("int").alias("page"))


def _extra(files: DataFrame) -> list[str]:
    """Caller columns carried through the loaders (e.g. a source row id)."""
    return [c for c in files.columns if c not in ("subject", "path", "format", "content")]


def load_text(files: DataFrame) -> DataFrame:
    """Whole file as one document, read as Python text mode would (universal newlines)."""
    txt = files.where(F.col("format") == "txt")
    return txt.select(
        *_extra(txt), "subject", "path", "format", F.lit(None).cast("int").alias("page"),
        universal_newlines(_text_content(txt)).alias("page_content"),
        _metadata(F.lit(TXT_SOURCE), F.lit(None), F.col("path"), F.lit(None)).alias("metadata"))


def load_html(files: DataFrame) -> DataFrame:
    """One document per page: all text nodes; metadata ``{source: path, title}``."""
    html = files.where(F.col("format") == "html")
    body = universal_newlines(_text_content(html))
    return html.select(
        "subject", "path", "format", F.lit(None).cast("int").alias("page"),
        html_text(body).alias("page_content"),
        _metadata(F.col("path"), html_title(body), F.lit(None), F.lit(None)).alias("metadata"))


PageExtractor = Callable[[bytes], Iterable[str]]


def form_feed_pages(data: bytes) -> list[str]:
    """Stand-in page extractor: UTF-8 text whose pages are separated by form feeds.
    Real PDF bytes are refused: they need an extractor that reads them."""
    if data[:1024].lstrip().startswith(b"%PDF"):
        raise ValueError("a PDF file needs a page extractor (pass extractor=...)")
    return data.decode("utf-8", errors="replace").split("\f")


def load_pdf(files: DataFrame, extractor: PageExtractor = form_feed_pages) -> DataFrame:
    """One document per page, via a user page extractor run in Arrow batches.

    Spark owns the fan-out from file to pages; the extractor only turns one
    file's bytes into page texts.  Page numbers are 0-based.
    """
    pdf = files.where(F.col("format") == "pdf")
    dtype = dict(pdf.dtypes)["content"]
    content = F.col("content") if dtype == "binary" else F.encode(F.col("content"), "UTF-8")
    src = pdf.select("subject", "path", content.alias("content"))

    def pages(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one frame per file: no more pages in memory than one file has
        for batch in it:
            for subject, path, data in zip(batch["subject"], batch["path"], batch["content"]):
                rows = [(subject, path, i, text) for i, text in enumerate(extractor(bytes(data)))]
                yield pd.DataFrame(rows, columns=["subject", "path", "page", "page_content"])

    out = src.mapInPandas(pages, "subject string, path string, page int, page_content string")
    return out.select(
        "subject", "path", F.lit("pdf").alias("format"), "page", "page_content",
        _metadata(F.col("path"), F.lit(None), F.lit(None), F.col("page")).alias("metadata"))


def load_corpus(files: DataFrame, extractor: PageExtractor = form_feed_pages,
                include_pdf: bool = True) -> DataFrame:
    """All loaders over the files: txt and html in one pass, since they are
    expressions of a row; pdf files in another one that sees only them."""
    plain = files.where(F.col("format").isin("txt", "html"))
    is_txt, body = F.col("format") == "txt", universal_newlines(_text_content(plain))
    null = F.lit(None).cast("string")
    out = plain.select(
        "subject", "path", "format", F.lit(None).cast("int").alias("page"),
        F.when(is_txt, body).otherwise(html_text(body)).alias("page_content"),
        _metadata(F.when(is_txt, F.lit(TXT_SOURCE)).otherwise(F.col("path")), F.when(~is_txt, html_title(body)),
                  F.when(is_txt, F.col("path")).otherwise(null), F.lit(None)).alias("metadata"))
    if include_pdf:
        out = out.unionByName(load_pdf(files, extractor))
    return out.select(*DOCUMENT_COLUMNS)


# --- driver tables as a corpus -------------------------------------------

PAGE_SUBJECT_PATTERN = r"^[a-z]+://[^/]+/([a-z]{2})(/|$)"


def corpus_files_from_tables(spark: SparkSession, sf_dir: str,
                             include_pages: bool = True, keep_ids: bool = False) -> DataFrame:
    """``documents`` as txt files, ``pages`` as html files: (subject, path, format, content).

    With ``keep_ids`` (documents only) the source ``doc_id`` rides along.
    """
    docs = read_table(spark, sf_dir, "documents").select(
        *(["doc_id"] if keep_ids and not include_pages else []),
        F.col("lang").alias("subject"),
        F.format_string("corpus/%s/doc-%d.txt", F.col("lang"), F.col("doc_id")).alias("path"),
        F.lit("txt").alias("format"), F.col("text").alias("content"))
    if not include_pages:
        return spread(docs)
    pages = read_table(spark, sf_dir, "pages").select(
        F.coalesce(F.nullif(F.regexp_extract("url", PAGE_SUBJECT_PATTERN, 1), F.lit("")), F.lit("web")).alias("subject"),
        F.col("page_id"), F.col("html"))
    pages = pages.select(
        "subject", F.format_string("corpus/%s/page-%d.html", F.col("subject"), F.col("page_id")).alias("path"),
        F.lit("html").alias("format"), F.col("html").alias("content"))
    return spread(docs.unionByName(pages))
