"""Versions of a folder of tables: data beside data, and a small manifest.

Writers put their files into a new folder and then switch: the next manifest
(``_versions/00000007.json``) names the folders that count.  A number can be
taken once, so two writers that switch at a time are put one after the other
and neither undoes the other.  A reader takes the latest manifest and reads the
folders that it names, so it sees one version however long it reads.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from vellum.sources.shared_files import create_once, delete, modified, names_in, read_text

KEPT_MANIFESTS = 10


def _manifests(spark: SparkSession, root: str) -> list[str]:
    return [n for n in names_in(spark, f"{root}/_versions") if n.endswith(".json") and not n.startswith(".")]


def latest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """Number and content of the manifest that counts (0, None: there is none)."""
    root = root.rstrip("/")
    for _ in range(3):
        names = _manifests(spark, root)
        if not names:
            return 0, None
        try:
            return int(names[-1].split(".")[0]), json.loads(read_text(spark, f"{root}/_versions/{names[-1]}"))
        except Exception:  # noqa: BLE001 - a Java exception: cleared away by a writer meanwhile
            if names[-1] in _manifests(spark, root):
                raise
    raise RuntimeError(f"the manifests of {root} change too fast to be read")


def switch(spark: SparkSession, root: str, change: Callable[[dict], dict]) -> dict:
    """Make ``change`` of the latest manifest the next one, again if another writer was faster."""
    root = root.rstrip("/")
    while True:
        number, now = latest(spark, root)
        new = change(now or {})
        if create_once(spark, f"{root}/_versions/{number + 1:08d}.json", json.dumps(new, sort_keys=True)):
            for name in _manifests(spark, root)[:-KEPT_MANIFESTS]:
                delete(spark, f"{root}/_versions/{name}")
            return new


def remove_unused(spark: SparkSession, root: str, data: str, used: Callable[[dict], set[str]],
                  older_than_seconds: float) -> list[str]:
    """Delete folders of ``root/data`` that no kept manifest names and that are old
    enough not to belong to a writer that has yet to switch; returns their names."""
    root = root.rstrip("/")
    needed: set[str] = set()
    for name in _manifests(spark, root):
        needed |= used(json.loads(read_text(spark, f"{root}/_versions/{name}")))
    folder = f"{root}/{data}"
    gone = []
    for name in names_in(spark, folder):
        at = modified(spark, f"{folder}/{name}") / 1000
        if name not in needed and time.time() - at >= older_than_seconds:
            delete(spark, f"{folder}/{name}")
            gone.append(name)
    return gone
