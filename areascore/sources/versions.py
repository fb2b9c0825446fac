"""Tables that are replaced as a whole: every write goes to a folder of its own, and a small commit file makes it the table.

``<root>/data-<id>`` holds rows; ``<root>/_commits/<number>.json`` names the folders of that version and facts
about it. A commit file is created only where none of its number exists, so of two writers that started from the same
version one is refused and decides anew on what the other left. Readers take the highest number: they never meet half a
table, and a write that fails leaves the table as it was. Old folders stay readable until ``prune``.

Files are reached through the session's own file systems. A commit is a rename onto a name that must not exist: atomic on
HDFS; on local disks and stores without such a rename it is a test and a rename, which a lock guards within one driver
only, so there the loads of one table belong into one application.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
_RENAMES = threading.Lock()
MAX_TRIES = 20


class Overtaken(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...] = ()
    facts: dict = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self._root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _commit_file(self, number: int):
        return self._path(f"{self._root}/{COMMITS}/{number:012d}.json")

    def current(self) -> Version:
        """The table's version; number 0, without folders, before the first."""
        folder = self._path(f"{self._root}/{COMMITS}")
        if not self._files.exists(folder):
            return Version(0)
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]
        return self._version(max(numbers)) if numbers else Version(0)

    def _version(self, number: int) -> Version:
        stream = self._files.open(self._commit_file(number))
        try:
            kept = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
        return Version(number, tuple(kept["folders"]), kept["facts"])

    def read(self, version: Version | None = None) -> DataFrame:
        version = version or self.current()
        if not version.folders:
            raise FileNotFoundError(f"no table at {self._root}")
        return self._spark.read.parquet(*(f"{self._root}/{f}" for f in version.folders))

    def stage(self, df: DataFrame) -> str:
        """Write rows to a new folder that no version has yet."""
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self._root}/{folder}")
        return folder

    def commit(self, after: Version, folders: tuple[str, ...], facts: dict) -> Version:
        """Make the folders the table, if ``after`` still is its version."""
        text = json.dumps({"folders": list(folders), "facts": facts}).encode("utf-8")
        number = after.number + 1
        # Written beside and then renamed, so that no reader meets an unfinished commit; a rename does not
        # replace a file that is there.
        place, draft = self._commit_file(number), self._path(f"{self._root}/{COMMITS}/.{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(text)
        finally:
            stream.close()
        try:
            with _RENAMES:
                taken = self._files.exists(place) or not self._files.rename(draft, place)
        except Exception as error:
            raise Overtaken(f"{self._root}: version {number} could not be taken") from error
        if taken:
            self._files.delete(draft, False)
            raise Overtaken(f"{self._root}: version {number} is there already")
        return Version(number, folders, facts)

    def publish(self, folder: str, decide: Callable[[Version], dict | None], append: bool = False) -> Version:
        """Commit a staged folder with the facts that ``decide`` makes of the version before it.

        Where another writer was faster, ``decide`` is asked again with what that one left. ``None`` leaves
        the table as it is.
        """
        for _ in range(MAX_TRIES):
            before = self.current()
            facts = decide(before)
            if facts is None:
                return before
            try:
                return self.commit(before, (*before.folders, folder) if append else (folder,), facts)
            except Overtaken:
                continue
        raise Overtaken(f"{self._root}: overtaken {MAX_TRIES} times")

    def prune(self) -> None:
        """Delete folders that the present version does not have. No reader or writer may be at work."""
        keep = set(self.current().folders)
        for status in self._files.listStatus(self._path(self._root)):
            name = status.getPath().getName()
            if name.startswith("data-") and name not in keep:
                self._files.delete(status.getPath(), True)
