"""Tables that grow by micro-batches, each of which counts exactly once.

A batch writes its rows to a folder of its own and then a small commit file that names the
folder, the batch, and the checkpoint that fed it. Readers take committed folders only, so
they see neither a batch that is being written nor one that failed. A batch that is run
again finds its commit and is left out. A checkpoint that did not feed the table so far is
refused, or begins a new generation that replaces all batches.

Where rows are mergeable partial results (counts, least times, sketches), ``read`` merges
them, and ``compact`` writes the merged rows as one folder that stands for all before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyframe.plans.files import Folder

_LOG = "_commits"
_WHOLE = "compacted"


class Commit(NamedTuple):
    generation: int
    batch: int
    compacted: bool
    owner: str
    folder: str
    schema: str

    @property
    def name(self) -> str:
        return f"{self.generation:06d}-{self.batch:012d}" + (f"-{_WHOLE}" if self.compacted else "")


class ForeignCheckpoint(ValueError):
    """The table was fed by another checkpoint."""


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a streaming query keeps in its checkpoint."""
    return json.loads(Folder(spark, checkpoint).read("metadata"))["id"]


class BatchTable:
    """A table of committed batches.

    ``keys`` and ``merges`` say how partial rows become one: rows with equal keys are
    aggregated by the functions in ``merges``. Without them rows are kept as they are.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (),
                 merges: Mapping[str, Callable[[str], Column]] | None = None) -> None:
        self._spark = spark
        self._path = path.rstrip("/")
        self._keys = list(keys)
        self._merges = dict(merges or {})
        self._log = Folder(spark, f"{self._path}/{_LOG}")

    def commits(self) -> list[Commit]:
        """Those of the latest generation that count, in order: the last compaction and the
        batches after it."""
        found = []
        for name in self._log.names():
            if name.startswith("."):
                continue
            text = self._log.read(name)
            if text.endswith("\n"):  # else it is being written
                found.append(Commit(**json.loads(text)))
        if not found:
            return []
        last = max(c.generation for c in found)
        found = [c for c in found if c.generation == last]
        upto = max((c.batch for c in found if c.compacted), default=-1)
        kept = [c for c in found if c.batch > upto or (c.compacted and c.batch == upto)]
        return sorted(kept, key=lambda c: c.batch)

    def add(self, rows: DataFrame, batch: int, owner: str, *, replace: bool = False) -> bool:
        """Write and commit a batch, and whether that was still to be done.

        ``owner`` is the identity of the checkpoint. With ``replace`` that of another one starts anew.
        """
        so_far = self.commits()
        generation = so_far[-1].generation if so_far else 0
        if so_far and so_far[-1].owner != owner:
            if not replace:
                raise ForeignCheckpoint(
                    f"{self._path} was fed by checkpoint {so_far[-1].owner}, not {owner}: "
                    "go on with that checkpoint, or replace its batches")
            so_far, generation = [], generation + 1
        if so_far and so_far[-1].batch >= batch:
            return False
        self._commit(rows, Commit(generation, batch, False, owner, "", ""))
        return True

    def _commit(self, rows: DataFrame, commit: Commit) -> None:
        folder = f"batch_id={commit.batch}/run={uuid.uuid4().hex}"
        rows.write.parquet(f"{self._path}/{folder}")
        commit = commit._replace(folder=folder, schema=rows.schema.json())
        self._log.create(commit.name, json.dumps(commit._asdict()) + "\n")

    def read(self) -> DataFrame:
        """The rows of all committed batches, merged where they are partial."""
        return self._merged(self.commits())

    def _merged(self, commits: list[Commit]) -> DataFrame:
        if not commits:
            raise FileNotFoundError(f"{self._path} has no committed batch")
        schema = T.StructType.fromJson(json.loads(commits[-1].schema))
        rows = self._spark.read.schema(schema).parquet(*(f"{self._path}/{c.folder}" for c in commits))
        if not self._merges:
            return rows
        return rows.groupBy(*self._keys).agg(*(merge(name).alias(name) for name, merge in self._merges.items()))

    def compact(self) -> bool:
        """Merge the committed batches into one folder, and whether there were several.

        A batch that is committed meanwhile stays beside it. Readers that began before go on
        with the old folders, which ``vacuum`` deletes later.
        """
        commits = self.commits()
        if len(commits) < 2:
            return False
        self._commit(self._merged(commits), commits[-1]._replace(compacted=True))
        return True

    def vacuum(self) -> int:
        """Delete the folders that no commit counts, and say how many those are.

        Not while a batch is being written or an old folder is still being read.
        """
        used = {c.folder for c in self.commits()}
        deleted = 0
        for batch in Folder(self._spark, self._path).names():
            if not batch.startswith("batch_id="):
                continue
            runs = Folder(self._spark, f"{self._path}/{batch}")
            for run in runs.names():
                if f"{batch}/{run}" not in used:
                    runs.delete(run)
                    deleted += 1
        return deleted

    def feed(self, stream: DataFrame, partial: Callable[[DataFrame], DataFrame], checkpoint: str, *,
             replace: bool = False) -> StreamingQuery:
        """Add ``partial`` of each micro-batch of what has arrived, and stop."""
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            owner = checkpoint_id(batch.sparkSession, checkpoint)
            self.add(partial(batch), batch_id, owner, replace=replace)

        return (
            stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
