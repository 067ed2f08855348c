"""Putting finished files in the place of old ones.

New content is first written whole to ``{path}__staged``. Only then a note
beside the table (``{path}__publish``) says what the publish replaces, drops
and adds; it is written to a side name and renamed, so it is there whole or
not at all. Then folders are moved. Every move can be repeated: a staged
folder that is gone has been moved already. A run that dies

* before the note leaves the old table as it was, and ``recover`` deletes
  what was staged;
* after the note leaves a table that ``recover`` brings to its new state.

Every reader and writer of this package calls ``recover`` first. Needed are a file system with atomic
rename (HDFS, POSIX), and one writer of a table at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

#: fixed value: the folder name of a NULL partition value
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
SCHEMA_FILE = "_table_schema.json"


def staged_path(path: str) -> str:
    return path.rstrip("/") + "__staged"


class Files:
    """The file operations a publish needs, on the file system of ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def folders(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def write(self, path: str, text: str) -> None:
        """``text`` at ``path``, whole or not at all."""
        side = path + ".tmp"
        out = self._fs.create(self._path(side), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.delete(path)
        self.move(side, path)

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _note_path(path: str) -> str:
    return path.rstrip("/") + "__publish"


def _carry_out(files: Files, path: str, note: dict) -> None:
    staged = staged_path(path)
    if note["whole"]:
        if files.exists(staged):
            files.delete(path)
            files.move(staged, path)
    else:
        for name in note["replace"]:
            if files.exists(f"{staged}/{name}"):
                files.delete(f"{path}/{name}")
                files.move(f"{staged}/{name}", f"{path}/{name}")
        for name in note["drop"]:
            files.delete(f"{path}/{name}")
        if note["schema"]:
            files.write(f"{path}/{SCHEMA_FILE}", note["schema"])
    files.delete(_note_path(path))
    files.delete(staged)


def recover(spark: SparkSession, path: str) -> str:
    """Finish or undo an interrupted publish; 'finished', 'undone' or 'clean'."""
    files = Files(spark, path)
    note = files.read(_note_path(path))
    if note is not None:
        _carry_out(files, path, json.loads(note))
        return "finished"
    if files.exists(staged_path(path)):
        files.delete(staged_path(path))
        return "undone"
    return "clean"


def publish_whole(spark: SparkSession, path: str) -> None:
    """The staged table takes the place of the table at ``path``."""
    files = Files(spark, path)
    note = {"whole": True}
    files.write(_note_path(path), json.dumps(note))
    _carry_out(files, path, note)


def publish_folders(spark: SparkSession, path: str, replace: list[str], drop: list[str], schema: str | None = None) -> None:
    """Staged folders ``replace`` take the place of those of the table, its
    folders ``drop`` go; ``schema``: the table's new schema file."""
    files = Files(spark, path)
    note = {"whole": False, "replace": replace, "drop": drop, "schema": schema}
    files.write(_note_path(path), json.dumps(note))
    _carry_out(files, path, note)
