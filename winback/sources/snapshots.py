"""Tables that are replaced or grow while others read them.

A published table is a folder of numbered manifests and a folder of data. A publication writes its rows into a new data
folder and then, by one rename, a manifest that lists all folders the table now consists of. A reader takes the newest
manifest and reads those folders, so it sees a whole table at any moment. A number that has a manifest is never written
again: a batch that is repeated after a failure changes nothing, and what a failed attempt left behind is not listed
anywhere. Folders and manifests that the newest manifest has superseded go after a grace time, which readers have for finishing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DIGITS = 12


def file_of(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, which may be any that Spark reads, and the path as it takes it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def make_folder(spark: SparkSession, path: str) -> None:
    files, folder = file_of(spark, path)
    files.mkdirs(folder)


@dataclass(frozen=True)
class Manifest:
    number: int
    folders: tuple[str, ...]
    schema: StructType


@dataclass(frozen=True)
class PublishedTable:
    """A table below ``path`` with one writer at a time and any number of readers."""

    spark: SparkSession
    path: str
    grace_seconds: float = 24 * 3600.0

    def _file(self, name: str) -> tuple:
        return file_of(self.spark, f"{self.path.rstrip('/')}/{name}")

    def _names(self, folder: str) -> dict[str, float]:
        """Names in a folder with the time of their last change, in seconds."""
        files, path = self._file(folder)
        if not files.exists(path):
            return {}
        return {found.getPath().getName(): found.getModificationTime() / 1000 for found in files.listStatus(path)}

    def _numbers(self) -> dict[int, float]:
        found = self._names("manifests")
        return {int(name.removesuffix(".json")): when for name, when in found.items() if name.endswith(".json")}

    def _load(self, number: int) -> Manifest:
        files, path = self._file(f"manifests/{number:0{DIGITS}d}.json")
        stream = files.open(path)
        try:
            told = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return Manifest(number, tuple(told["folders"]), StructType.fromJson(told["schema"]))

    @property
    def manifest(self) -> Manifest | None:
        """The newest manifest, or None before the first publication."""
        numbers = self._numbers()
        return self._load(max(numbers)) if numbers else None

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """All rows of the newest publication, or of the one given."""
        manifest = manifest or self.manifest
        if manifest is None:
            raise ValueError(f"nothing has been published at {self.path}")
        return self.spark.read.schema(manifest.schema).parquet(*[self._folder(name) for name in manifest.folders])

    def _folder(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/data/{name}"

    def replace(self, rows: DataFrame, number: int) -> None:
        """Publish ``rows`` as the whole table."""
        self._publish(rows, number, lambda newest: ())

    def append(self, rows: DataFrame, number: int, merge: Callable[[DataFrame], DataFrame], merge_every: int) -> None:
        """Publish ``rows`` in addition to what is there.

        With ``merge_every`` folders the table is merged: ``merge`` of all rows becomes its only folder.
        """
        newest = self.manifest
        if newest is not None and newest.number < number and len(newest.folders) + 1 >= merge_every:
            self._publish(merge(self.read(newest).unionByName(rows)), number, lambda newest: ())
        else:
            self._publish(rows, number, lambda newest: newest.folders if newest else ())

    def _publish(self, rows: DataFrame, number: int, kept: Callable[[Manifest | None], tuple[str, ...]]) -> None:
        newest = self.manifest
        if newest is not None and number <= newest.number:
            return
        folder = f"{number:0{DIGITS}d}-{uuid.uuid4().hex}"
        rows.write.parquet(self._folder(folder))
        told = {"folders": [*kept(newest), folder], "schema": rows.schema.jsonValue()}
        files, draft = self._file(f"drafts/{folder}.json")
        stream = files.create(draft, False)
        try:
            stream.write(json.dumps(told).encode())
        finally:
            stream.close()
        _, final = self._file(f"manifests/{number:0{DIGITS}d}.json")
        files.mkdirs(final.getParent())
        if not files.rename(draft, final):
            raise OSError(f"publication {number} of {self.path} could not be named; another writer may have done so")
        self.clean()

    def clean(self) -> None:
        """Delete what the newest manifest does not list and no reader can still need."""
        newest = self.manifest
        if newest is None:
            return
        numbers = self._numbers()
        # when a manifest was superseded: at the next one
        ordered = sorted(numbers)
        limit = time.time() - self.grace_seconds
        gone = [number for number, after in zip(ordered, ordered[1:], strict=False) if numbers[after] <= limit]
        needed = set(newest.folders)
        for number in set(ordered) - set(gone) - {newest.number}:
            needed |= set(self._load(number).folders)
        for number in gone:
            files, path = self._file(f"manifests/{number:0{DIGITS}d}.json")
            files.delete(path, False)
        for name, when in self._names("data").items():
            if name not in needed and when <= limit:
                files, path = self._file(f"data/{name}")
                files.delete(path, True)
