"""The load manifest: which folders of which table belong to the warehouse.

A load writes every table into a folder of its own and then publishes one new
manifest that names them all.  Readers list the folders of one manifest, so they
see all tables of a load or none; what a load that was killed has written is
named by no manifest and never read.

Manifests are numbered files under ``_manifest``, written aside and renamed into
place; the highest number is the current one.  One load at a time writes a
warehouse: a load that finds another manifest than the one it began with fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from martflow.session import delete_path, list_names, read_marker, rename_path, write_marker

#: Manifests that stay for readers that began earlier.
KEPT = 10


@dataclass(frozen=True)
class Folder:
    """One load's rows of one table."""

    path: str       # below the root
    batch: str
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    product_type: str | None = None
    tables: dict[str, tuple[Folder, ...]] = field(default_factory=dict)

    def folders(self, table: str) -> tuple[Folder, ...]:
        return self.tables.get(table, ())

    def rows(self, table: str) -> int:
        return sum(f.rows for f in self.folders(table))

    def with_folders(self, table: str, folders: list[Folder]) -> "Manifest":
        return replace(self, tables={**self.tables, table: tuple(folders)})

    def adding(self, table: str, folder: Folder) -> "Manifest":
        return self.with_folders(table, [*self.folders(table), folder])

    def text(self) -> str:
        tables = {t: [[f.path, f.batch, f.rows] for f in fs] for t, fs in self.tables.items()}
        return json.dumps({"version": self.version, "product_type": self.product_type, "tables": tables})


def _parse(text: str) -> Manifest:
    d = json.loads(text)
    return Manifest(d["version"], d["product_type"], {t: tuple(Folder(*f) for f in fs) for t, fs in d["tables"].items()})


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in list_names(spark, f"{root}/_manifest") if n.endswith(".json"))


def _path(root: str, version: int) -> str:
    return f"{root}/_manifest/{version:012d}.json"


def current(spark: SparkSession, root: str) -> Manifest:
    """The manifest of the last load that was committed (empty before the first)."""
    versions = _versions(spark, root)
    return _parse(read_marker(spark, _path(root, versions[-1]))) if versions else Manifest()


def commit(spark: SparkSession, root: str, changed: Manifest) -> Manifest:
    """Publish ``changed`` as the successor of the manifest it was made from."""
    versions = _versions(spark, root)
    if (versions[-1] if versions else 0) != changed.version:
        raise RuntimeError(f"{root}: another load was committed meanwhile; run this one again")
    new = replace(changed, version=changed.version + 1)
    aside = f"{root}/_manifest/_{uuid.uuid4().hex}"
    write_marker(spark, aside, new.text())
    if not rename_path(spark, aside, _path(root, new.version)):
        raise RuntimeError(f"{root}: manifest {new.version} was not published")
    for version in versions[:-KEPT]:
        delete_path(spark, _path(root, version))
    return new
