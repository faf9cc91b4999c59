"""A stored table with versions.

A version's rows lie in a folder of their own under ``data``. Which versions count is
recorded under ``commits``: one folder per number, holding the name of the rows' folder,
put there whole by a rename that fails where the number is taken. So of two writers who
start from the same version one succeeds, the other is refused and starts again from the
new one; readers see a version either whole or not at all, and an earlier version stays
as it was.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class StaleVersion(Exception):
    """Somebody has committed a version after the one the change was made from."""


class Version(NamedTuple):
    number: int
    rows: DataFrame


class Versions:
    """The versions under a folder, on any file system Spark writes to whose rename of a
    folder is atomic."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        gateway = spark.sparkContext._jvm
        self._path = gateway.org.apache.hadoop.fs.Path
        self._never_over = gateway.org.apache.hadoop.fs.Options.Rename.NONE
        self._renames = gateway.org.apache.hadoop.fs.Options.Rename
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self._folder).getFileSystem(conf)
        self._context = gateway.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self._folder).toUri(), conf)

    def numbers(self) -> list[int]:
        """All committed versions, oldest first."""
        commits = self._path(f"{self._folder}/commits")
        if not self._files.exists(commits):
            return []
        names = [entry.getPath().getName() for entry in self._files.listStatus(commits)]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> DataFrame:
        name = self._spark.read.text(f"{self._folder}/commits/{number:08d}").first()[0]
        return self._spark.read.parquet(f"{self._folder}/data/{name}")

    def current(self) -> Version | None:
        """The newest version, or nothing before the first commit."""
        numbers = self.numbers()
        return Version(numbers[-1], self.read(numbers[-1])) if numbers else None

    def commit(self, rows: DataFrame, base: int) -> Version:
        """Write ``rows`` as the version after ``base``, 0 for the first. Refused where
        ``base`` is no longer the newest, before the rows are written if that is known,
        and in any case before they count."""
        self._refuse_unless_newest(base)
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self._folder}/data/{name}")
        note = f"{self._folder}/notes/{name}"
        self._spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.text(note)
        self._files.mkdirs(self._path(f"{self._folder}/commits"))
        self._refuse_unless_newest(base)
        options = self._spark.sparkContext._gateway.new_array(self._renames, 1)
        options[0] = self._never_over
        try:
            self._context.rename(self._path(note), self._path(f"{self._folder}/commits/{base + 1:08d}"), options)
        except Py4JJavaError as error:
            if base + 1 in self.numbers():
                raise StaleVersion(f"version {base + 1} was committed by another writer") from error
            raise
        return Version(base + 1, self.read(base + 1))

    def _refuse_unless_newest(self, base: int) -> None:
        newest = max(self.numbers(), default=0)
        if newest != base:
            raise StaleVersion(f"made from version {base}, the newest is {newest}")
