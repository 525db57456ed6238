import os

import pytest
from pyspark.sql import functions as F

from vellum.sources.corpus import admit_files, load_corpus, rejected_files, scan_corpus


def folder(tmp_path, *names):
    os.makedirs(tmp_path / "s", exist_ok=True)
    for n in names:
        (tmp_path / "s" / n).write_text(f"text of {n}")
    return str(tmp_path)


def seen(files):
    return sorted((r.path.rsplit("/s/", 1)[1], r.format, None if r.content is None else bytes(r.content).decode()) for r in files.collect())


def test_names_of_every_kind(spark, tmp_path):
    root = folder(tmp_path, "a.txt", "B.HTML", "c, d.txt", "e.pdf", "f.docx", "g", ".h.txt", "_i.html", "_j", "_k=1.txt", "50%25 x.txt", "ü[1].txt", "l;m=n.txt")
    os.makedirs(tmp_path / "s" / "sub, file:" / "deep")
    (tmp_path / "s" / "sub, file:" / "in.txt").write_text("inside")
    files = scan_corpus(spark, root, "s")
    known = {n: f for f, ns in {"txt": ["a.txt", "c, d.txt", "_k=1.txt", "50%25 x.txt", "ü[1].txt", "l;m=n.txt"], "html": ["B.HTML"], "pdf": ["e.pdf"]}.items() for n in ns}
    odd = [("f.docx", "", None), ("g", "", None), (".h.txt (hidden)", "", None), ("_i.html (hidden)", "", None), ("_j", "", None), ("sub, file:/", "", None)]
    assert seen(files) == sorted([(n, f, f"text of {n}") for n, f in known.items()] + odd, key=lambda r: r[0])
    with pytest.raises(Exception, match="Unsupported file format"):
        admit_files(files).collect()
    assert admit_files(files, "quarantine").count() == len(known) and rejected_files(files).count() == len(odd)


def test_empty_and_missing_folders(spark, tmp_path):
    os.makedirs(tmp_path / "s")
    assert scan_corpus(spark, str(tmp_path), "s").count() == 0
    with pytest.raises(FileNotFoundError, match="none"):
        scan_corpus(spark, str(tmp_path), "none")


def test_files_of_no_bytes(spark, tmp_path):
    root = folder(tmp_path, "a.txt")
    for n in ("b.txt", "c.html", "d.odt", ".e.txt"):
        (tmp_path / "s" / n).write_bytes(b"")
    files = scan_corpus(spark, root, "s")
    assert seen(files) == [(".e.txt (hidden)", "", None), ("a.txt", "txt", "text of a.txt"), ("b.txt", "txt", ""), ("c.html", "html", ""), ("d.odt", "", None)]
    docs = {r.path.rsplit("/", 1)[1]: r.page_content for r in load_corpus(admit_files(files, "quarantine"), include_pdf=False).collect()}
    assert docs == {"a.txt": "text of a.txt", "b.txt": "", "c.html": ""}


def test_each_file_is_read_once(spark, tmp_path):
    """A branch plans the files of its format only, over one listing."""
    root = folder(tmp_path, *[f"{k}.txt" for k in range(30)], "x.html", "y.pdf")
    files = scan_corpus(spark, root, "s")
    docs = load_corpus(files, include_pdf=False)
    docs.collect()
    read = [int(line.split(":")[1].strip().replace(",", "")) for line in metric_lines(docs, "number of files read")]
    assert sum(read) <= 31 + 1


def metric_lines(df, name):
    """Values of a metric of the scans that ran for ``df``."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        found = node.metrics().get("numFiles")
        if found.isDefined():
            out.append(f"files: {found.get().value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return out


def test_very_many_files_are_listed_without_a_call_each(spark, tmp_path, monkeypatch):
    os.makedirs(tmp_path / "s")
    for k in range(100_000):
        with open(tmp_path / "s" / f"{k}.{'txt' if k % 2 else 'html'}", "wb") as f:
            f.write(b"x")
    os.makedirs(tmp_path / "s" / "sub")
    calls = []
    client = spark.sparkContext._gateway._gateway_client
    kind, send = type(client), type(client).send_command
    monkeypatch.setattr(kind, "send_command", lambda self, *a, **k: calls.append(1) or send(self, *a, **k))
    files = scan_corpus(spark, str(tmp_path), "s")
    monkeypatch.undo()
    assert len(calls) < 2000
    got = {r["format"]: r["count"] for r in files.groupBy("format").count().collect()}
    assert got == {"txt": 50_000, "html": 50_000, "": 1}
    assert files.where(F.col("format") == "").first().path.endswith("/sub/")
