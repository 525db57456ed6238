"""Vector store: Parquet by version and subject (sink and source).

A build writes its subjects into a folder of its own
(``data/version=<name>/subject=<subject>``, gzip) and then switches the store's
manifest, which names each subject's versions.  All subjects of a build change at
once, readers see the old or the new rows and never a mix, and subjects that
a build does not name stay as they are.  A subject that has no rows, or none
any more, is not in the manifest: reading it raises ``FileNotFoundError``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vellum.sources.shared_files import names_in
from vellum.sources.versions import latest, remove_unused, switch

METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("page", T.IntegerType()),
])

STORE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("metadata", METADATA),
    T.StructField("embedding", T.ArrayType(T.DoubleType()), False),
    T.StructField("embedding_model", T.StringType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("tokens", T.IntegerType()),
])

STORE_COLUMNS = [f.name for f in STORE_SCHEMA.fields]
# Smaller row groups: bounded writer memory per task and finer skipping
# when winners are fetched by id.
STORE_ROW_GROUP_BYTES = 32 * 1024 * 1024


def write_store(rows: DataFrame, path: str, compression: str = "gzip", *, subjects: Iterable[str] = (),
                part: str | None = None) -> list[str]:
    """Replace the subjects present in ``rows``; returns their names.

    Those of ``subjects`` that have no rows are emptied.  With ``part``, rows are
    added to what the subjects have; writing a part of the same name again replaces it
    (a replayed micro-batch is there once).

    Rows are sorted by ``id`` inside each file and a Parquet bloom filter is
    written for ``id``, so fetching the content of a few winners by id
    (``late_materialise``) skips row groups that hold none of them.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    version = part or uuid.uuid4().hex
    folder = f"{root}/data/version={version}"
    (rows.select(*STORE_COLUMNS, "subject")
     .sortWithinPartitions("subject", "id")
     .write.mode("overwrite" if part else "errorifexists")
     .option("partitionOverwriteMode", "static")
     .option("compression", compression)
     .option("parquet.bloom.filter.enabled#id", "true")
     .option("parquet.block.size", str(STORE_ROW_GROUP_BYTES))
     .partitionBy("subject")
     .parquet(folder))
    written = {unquote(n.partition("=")[2]): n for n in names_in(spark, folder) if n.startswith("subject=")}

    def change(manifest: dict) -> dict:
        entries = {s: dict(e) for s, e in manifest.get("subjects", {}).items() if part or s not in set(subjects)}
        for subject, name in written.items():
            before = entries.get(subject, {}).get("versions", []) if part else []
            entries[subject] = {"folder": name, "versions": [v for v in before if v != version] + [version]}
        return {**manifest, "subjects": entries}

    switch(spark, root, change)
    return sorted(written)


def stored_subjects(spark: SparkSession, path: str) -> list[str]:
    return sorted((latest(spark, path)[1] or {}).get("subjects", {}))


def remove_old_versions(spark: SparkSession, path: str, older_than_seconds: float = 24 * 3600) -> list[str]:
    """Delete versions that no kept manifest names; returns their folders."""
    used = lambda m: {f"version={v}" for e in m.get("subjects", {}).values() for v in e["versions"]}
    return remove_unused(spark, path, "data", used, older_than_seconds)


def read_store(spark: SparkSession, path: str, subject: str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Rows of one subject (or all), pruned to ``columns``, of the version that counts now."""
    root = path.rstrip("/")
    entries = (latest(spark, root)[1] or {}).get("subjects", {})
    if subject is not None:
        entries = {s: e for s, e in entries.items() if s == subject}
    folders = [f"{root}/data/version={v}/{e['folder']}" for e in entries.values() for v in e["versions"]]
    if not folders:
        raise FileNotFoundError(f"Embedded data not found for subject: {subject}")
    schema = T.StructType(STORE_SCHEMA.fields + [T.StructField("subject", T.StringType())])
    df = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)
    return df.select(*(columns or schema.fieldNames()))
