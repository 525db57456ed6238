"""A journal of paid calls, written while a task is still running.

Spark keeps a task's output only when the task succeeds, but a call to a
provider is paid when it returns.  So tasks write each result to the shared
folder themselves, in small files in a folder for their partition, as soon as
``every`` results or ``seconds`` have gathered, and whatever is left when the
task ends, also when it fails.  A killed worker loses at most what had not been written.

An attempt first reads what earlier attempts of its partition have written and
does not ask for it again; a later run of the same batch leaves out all that is recorded (an
anti join on the entry's key).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pyarrow as pa

from vellum.sources.shared_files import arrow_system, files_in, write_whole


@dataclass(frozen=True)
class Journal:
    """``folder``: of one job, as ``qualified`` gives it; ``key``: the column that names an entry."""
    folder: str
    key: str
    schema: pa.Schema
    every: int = 32
    seconds: float = 5.0

    def of(self, partition: int) -> str:
        return f"{self.folder}/part-{partition:05d}"

    def recorded(self, partition: int) -> set:
        """Keys that earlier attempts of this partition wrote."""
        import pyarrow.parquet as pq
        system, _ = arrow_system(self.folder)
        found: set = set()
        for path in files_in(self.of(partition)):
            with system.open_input_file(path) as f:
                found.update(pq.read_table(f, columns=[self.key])[self.key].to_pylist())
        return found

    def writer(self, partition: int) -> JournalWriter:
        return JournalWriter(self, self.of(partition))


class JournalWriter:
    """Use as a context; leaving it writes what is left."""

    def __init__(self, journal: Journal, folder: str):
        self.journal, self.folder, self.rows, self.since = journal, folder, [], time.monotonic()

    def add(self, *rows: dict) -> None:
        self.rows.extend(rows)
        if len(self.rows) >= self.journal.every or time.monotonic() - self.since >= self.journal.seconds:
            self.flush()

    def flush(self) -> None:
        import pyarrow.parquet as pq
        if self.rows:
            out = pa.BufferOutputStream()
            pq.write_table(pa.Table.from_pylist(self.rows, schema=self.journal.schema), out)
            write_whole(f"{self.folder}/{uuid.uuid4().hex}.parquet", out.getvalue())
        self.rows, self.since = [], time.monotonic()

    def __enter__(self) -> JournalWriter:
        return self

    def __exit__(self, *_) -> None:
        self.flush()
