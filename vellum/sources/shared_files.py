"""Files on shared storage, from the driver and from tasks.

The driver goes through Hadoop's file system (any store that Spark reads):
listing, small text files, and ``create_once``, which lets one of several
writers win.  Tasks have no JVM and go through Arrow's file systems (mounted
folders, HDFS, S3, GCS); ``write_whole`` never shows a reader half a file.
"""

from __future__ import annotations

import os
import re
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession


# --- driver ---------------------------------------------------------------

def hadoop_path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def hadoop_system(spark: SparkSession, name: str):
    return hadoop_path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, name: str) -> str:
    """``name`` with its scheme, as Arrow in a task understands it."""
    whole = hadoop_system(spark, name).makeQualified(hadoop_path(spark, name)).toString()
    return re.sub(r"^file:/+", "file:///", whole)


def exists(spark: SparkSession, name: str) -> bool:
    return hadoop_system(spark, name).exists(hadoop_path(spark, name))


def is_folder(spark: SparkSession, name: str) -> bool:
    return hadoop_system(spark, name).getFileStatus(hadoop_path(spark, name)).isDirectory()


def modified(spark: SparkSession, name: str) -> int:
    """Time of the last change (of a folder: of its entries), in milliseconds."""
    return hadoop_system(spark, name).getFileStatus(hadoop_path(spark, name)).getModificationTime()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in ``folder`` (none if it is not there); for folders of few entries."""
    system, path = hadoop_system(spark, folder), hadoop_path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(path))


def files_of(df: DataFrame) -> list[str]:
    """The files that ``df`` reads, by name (Spark lists them as escaped URIs)."""
    return [re.sub(r"^file:/+", "file:///", unquote(f)) for f in df.inputFiles()]


def read_text(spark: SparkSession, name: str) -> str:
    stream = hadoop_system(spark, name).open(hadoop_path(spark, name))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Write beside, then put in place of what is there."""
    _rename(spark, _beside(spark, name, text), name, "OVERWRITE")


def create_once(spark: SparkSession, name: str, text: str) -> bool:
    """Whether this call made the file; one that is there stays as it is."""
    local = qualified(spark, name)
    if local.startswith("file:///"):
        return _link_once(local.removeprefix("file://"), text)
    beside = _beside(spark, name, text)
    try:
        _rename(spark, beside, name, "NONE")
        return True
    except Exception as exc:  # noqa: BLE001 - a Java exception
        delete(spark, beside)
        if "FileAlreadyExists" in str(exc) or exists(spark, name):
            return False
        raise


def _link_once(path: str, text: str) -> bool:
    """A rename on a local disk looks first and moves then; a link is one step."""
    folder, last = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    beside = os.path.join(folder, f".{last}.{uuid.uuid4().hex}")
    with open(beside, "w", encoding="utf-8") as f:
        f.write(text)
    try:
        os.link(beside, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(beside)


def _beside(spark: SparkSession, name: str, text: str) -> str:
    folder, _, last = name.rpartition("/")
    beside = f"{folder}/.{last}.{uuid.uuid4().hex}"
    stream = hadoop_system(spark, beside).create(hadoop_path(spark, beside), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return beside


def _rename(spark: SparkSession, source: str, target: str, option: str) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.valueOf(option)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        hadoop_system(spark, target).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(hadoop_path(spark, source), hadoop_path(spark, target), options)


def delete(spark: SparkSession, name: str) -> None:
    hadoop_system(spark, name).delete(hadoop_path(spark, name), True)


# --- tasks ----------------------------------------------------------------

def arrow_system(uri: str):
    """File system and path of a name as ``qualified`` gives it: nothing in it is an escape."""
    from pyarrow import fs
    scheme, _, rest = uri.partition("://")
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    authority, _, path = rest.partition("/")
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/{quote(path)}")


def open_input(uri: str):
    system, path = arrow_system(uri)
    return system.open_input_file(path)


def files_in(folder: str) -> list[str]:
    """Paths of the whole files directly in ``folder`` (none if it is not there)."""
    from pyarrow import fs
    system, path = arrow_system(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and not f.base_name.startswith((".", "_")))


def write_whole(uri: str, data) -> None:
    """A file under a hidden name, renamed when it is complete."""
    system, path = arrow_system(uri)
    folder, _, last = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, path)


def delete_files(uris: list[str]) -> None:
    for uri in uris:
        system, path = arrow_system(uri)
        if system.get_file_info(path).is_file:
            system.delete_file(path)
