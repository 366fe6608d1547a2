"""Replacing folders of a table in two phases: new files are complete before any old one goes.

New rows are written to a staged folder inside the table, whose name begins with an underscore, so no reader sees it.
A journal then lists which folders take the place of which. From that moment the change counts as made: whoever
touches the table next carries out what an interrupted process left undone. Until it, old rows stay as they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

STAGED, JOURNAL, OLD = "_staged-", "_publish-", "_old"


class Files:
    """The file system of a folder, through the session's own client."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.hadoop.io.IOUtils
        self._bytes = spark._jvm.java.io.ByteArrayOutputStream
        self.store = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.store.makeQualified(self._path(root)).toString()

    def at(self, name: str = ""):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.store.exists(self.at(name))

    def folders(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(f.getPath().getName() for f in self.store.listStatus(self.at(name)) if f.isDirectory())

    def names(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self.store.listStatus(self.at())) if self.exists() else []

    def move(self, source: str, target: str) -> None:
        parent = self.at(target).getParent()
        if not self.store.exists(parent):
            self.store.mkdirs(parent)
        if not self.store.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot move {source} to {target} in {self.root}")

    def remove(self, name: str) -> None:
        self.store.delete(self.at(name), True)

    def write(self, name: str, text: str) -> None:
        """The file appears with all its text or not at all."""
        draft = f"_draft-{uuid.uuid4().hex}"
        out = self.store.create(self.at(draft))
        out.write(bytearray(text.encode()))
        out.close()
        self.move(draft, name)

    def replace(self, name: str, text: str) -> None:
        """Like ``write`` over a file that may exist; a process that dies in between leaves no file."""
        self.remove(name)
        self.write(name, text)

    def read(self, name: str) -> str:
        source, out = self.store.open(self.at(name)), self._bytes()
        self._io.copyBytes(source, out, 4096, True)
        return bytes(out.toByteArray()).decode()


def staged_folder(spark: SparkSession, root: str) -> tuple[Files, str]:
    """The table's files, with everything settled, and the name of a new staged folder."""
    files = Files(spark, root)
    settle(files)
    return files, f"{STAGED}{uuid.uuid4().hex}"


def publish(files: Files, staged: str, places: list[tuple[str, bool]]) -> None:
    """Each ``(place, new)``: the folder at ``place`` goes; with ``new`` the one of that name below ``staged`` comes."""
    journal = f"{JOURNAL}{uuid.uuid4().hex}.json"
    files.write(journal, json.dumps({"staged": staged, "places": places}))
    _carry_out(files, journal)


def settle(files: Files) -> None:
    """Complete what interrupted processes had decided."""
    for name in files.names():
        if name.startswith(JOURNAL):
            _carry_out(files, name)


def _carry_out(files: Files, journal: str) -> None:
    """Any number of times, from any point: a folder that has come is no longer staged, one that has gone is put away."""
    order = json.loads(files.read(journal))
    staged = order["staged"]
    for place, new in order["places"]:
        away = f"{staged}/{OLD}/{place}"
        if new and not files.exists(f"{staged}/{place}"):
            continue
        if files.exists(place) and not files.exists(away):
            files.move(place, away)
        if new:
            files.move(f"{staged}/{place}", place)
    files.remove(staged)
    files.remove(journal)
