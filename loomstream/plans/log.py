"""A log of commits in a folder: each is one file that gets its number as its name once, never over another."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed what this write rests on."""


def hadoop(spark: SparkSession, path: str):
    """The path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when each was written (milliseconds)."""
    p, fs = hadoop(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)] if fs.exists(p) else []


def removed(spark: SparkSession, path: str) -> None:
    p, fs = hadoop(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published(spark: SparkSession, text: str, target: str) -> bool:
    """Writes the text under a name of its own and gives it its final name; False if that name is taken.

    A rename that does not overwrite is atomic in HDFS. A local file system would check first and rename then, so there
    a hard link takes its place, which fails where the name exists.
    """
    final, fs = hadoop(spark, target)
    staged, _ = hadoop(spark, f"{final.getParent()}/.staged-{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(final), local(staged))
        else:
            kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark._sc._gateway.new_array(kinds, 1)
            options[0] = kinds.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, final, options)
    except Exception:
        if fs.exists(final):
            return False
        raise
    finally:
        fs.delete(staged, False)
    return True


@dataclass
class Snapshot:
    """What the commits up to a number amount to: live entries by their path, and the last batch of each stream."""

    number: int = 0
    files: dict[str, dict] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    touched: dict[str, int] = field(default_factory=dict)  # partition: the commit that touched it last

    def apply(self, commit: dict) -> None:
        self.number = commit["number"]
        for path in commit["remove"]:
            self.files.pop(path, None)
        for f in commit["add"]:
            self.files[f["path"]] = f
        for part in commit["parts"]:
            self.touched[part] = commit["number"]
        if commit["stream"]:
            self.batches[commit["stream"]] = max(commit["batch"], self.batches.get(commit["stream"], -1))


class CommitLog:
    """Commits ``<number>.json`` and, after every ``EVERY`` of them, the whole snapshot ``<number>.all.json``.

    Readers take the last snapshot and the commits after it, so what they read does not grow with the number of writes.
    """

    EVERY = 10

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def numbers(self) -> tuple[list[int], list[int]]:
        """Of commits and of snapshots."""
        names = [n for n, _ in listed(self.spark, self.path)]
        return sorted(int(n[:12]) for n in names if n[12:] == ".json"), sorted(int(n[:12]) for n in names if n[12:] == ".all.json")

    def commit_file(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def snapshot(self, number: int | None = None) -> Snapshot:
        commits, wholes = self.numbers()
        if number is not None:
            commits, wholes = [n for n in commits if n <= number], [n for n in wholes if n <= number]
        state = Snapshot()
        if wholes:
            state = Snapshot(**json.loads(read_text(self.spark, f"{self.path}/{wholes[-1]:012d}.all.json")))
        for n in commits:
            if n > state.number:
                state.apply(json.loads(read_text(self.spark, self.commit_file(n))))
        return state

    def commit(self, base: Snapshot, add: list[dict], remove: list[str], parts: list[str], stream: str = "", batch: int = -1) -> int:
        """Commits on top of ``base``. Commits of others that came first are passed if they touch other partitions, and a Conflict if not.

        A write that names a stream passes no other commit of this stream.
        """
        own, number = set(parts), base.number
        while True:
            number += 1
            commit = {"number": number, "add": add, "remove": remove, "parts": sorted(own), "stream": stream, "batch": batch, "time": int(1000 * time.time())}
            if published(self.spark, json.dumps(commit), self.commit_file(number)):
                break
            other = json.loads(read_text(self.spark, self.commit_file(number)))
            if own & set(other["parts"]) or (stream and other["stream"] == stream):
                raise Conflict(f"commit {number} of another writer touches the same partitions")
        if number % self.EVERY == 0:
            published(self.spark, json.dumps(vars(self.snapshot(number))), f"{self.path}/{number:012d}.all.json")
        return number

    def forget(self, before_ms: int) -> Snapshot:
        """Deletes commits and snapshots that the last old enough snapshot stands for; returns that one, from which on versions can be read."""
        _, wholes = self.numbers()
        at = dict(listed(self.spark, self.path))
        old = [n for n in wholes if at[f"{n:012d}.all.json"] < before_ms]
        if not old:
            return Snapshot()
        for name in at:
            if not name.startswith(".") and (int(name[:12]) < old[-1] or name == f"{old[-1]:012d}.json"):
                removed(self.spark, f"{self.path}/{name}")
        for name, when in at.items():
            if name.startswith(".staged-") and when < before_ms:
                removed(self.spark, f"{self.path}/{name}")
        return self.snapshot(old[-1])
