"""Tables whose rows count only once a commit record names them.

Every attempt to write goes to a directory of its own (a part). A commit is one small file that
lists the parts it adds, over several tables if need be, and the parts they replace. Readers take
the parts that some commit added and none replaced, so that they never see half a batch, and a
failed attempt leaves nothing but an unused directory. Commits are appended; one writer per table
adds batches, and ``compact`` may run beside it, one at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.schemas import BIG, TEXT, struct

_LIST = T.ArrayType(TEXT)
RECORD = struct(table=TEXT, added=_LIST, replaced=_LIST, query_id=TEXT, batch_id=BIG)
BATCH = struct(query_id=TEXT, batch_id=BIG)
BUCKET = "bucket"


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _children(spark: SparkSession, name: str) -> list[str]:
    """Names of the directories below ``name``; none where a store keeps no empty directory."""
    path = _path(spark, name)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()]


def _remove(spark: SparkSession, name: str) -> None:
    path = _path(spark, name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Commits:
    """The commit records below one path."""

    path: str

    def load(self, spark: SparkSession) -> list[Row]:
        """All records: a few names per batch."""
        try:
            return spark.read.schema(RECORD).json(self.path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def add(self, spark: SparkSession, records: Iterable[Row]) -> None:
        """Makes the records count, all at once: they are one file, renamed into its place."""
        lines = "".join(json.dumps(r.asDict()) + "\n" for r in records)
        name = uuid.uuid4().hex
        hidden, place = _path(spark, f"{self.path}/_{name}"), _path(spark, f"{self.path}/{name}.json")
        system = hidden.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = system.create(hidden)
        try:
            out.write(bytearray(lines, "utf-8"))
        finally:
            out.close()
        if not system.rename(hidden, place):
            raise OSError(f"no commit at {self.path}")


def _record(table: str, added: list, replaced: list, query_id: str, batch_id: int) -> Row:
    return Row(
        table=table, added=added, replaced=replaced, query_id=query_id, batch_id=batch_id
    )


@dataclass(frozen=True)
class CommittedTable:
    """One table: where its parts lie and which commits name them."""

    root: str
    name: str
    commits: Commits

    def live(self, spark: SparkSession, records: list[Row] | None = None) -> list[str]:
        """The parts that count, in the order of their batches."""
        if records is None:
            records = self.commits.load(spark)
        own = [r for r in records if r["table"] == self.name]
        gone = {part for r in own for part in r["replaced"]}
        own.sort(key=lambda r: (r["query_id"], r["batch_id"]))
        return [part for r in own for part in r["added"] if part not in gone]

    def read(
        self, spark: SparkSession, schema: T.StructType, parts: list[str] | None = None
    ) -> DataFrame:
        """Rows of ``schema`` with the batch that wrote them; ``parts`` are all that count."""
        parts = self.live(spark) if parts is None else parts
        whole = T.StructType([*schema, *BATCH])
        if not parts:
            return spark.createDataFrame([], whole)
        places = [f"{self.root}/{part}" for part in parts]
        found = spark.read.schema(whole).option("basePath", self.root).parquet(*places)
        return found.select(*whole.names)

    def stage(
        self, df: DataFrame, query_id: str, batch_id: int, by: str | None = None, few: bool = False
    ) -> Row:
        """Writes a batch's rows and returns the record that would make them count.

        With ``by`` there is a directory per value of that column; those of ``bucket`` are parts
        of their own, gathered into few files each. ``few`` rows go to one task per bucket; else
        Spark splits buckets by their size.
        """
        labelled = df.withColumns({
            "query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast(BIG),
        })
        return _record(self.name, self._write(labelled, by, few), [], query_id, batch_id)

    def _write(self, df: DataFrame, by: str | None, few: bool = False) -> list[str]:
        part = f"write={uuid.uuid4().hex}"
        place = f"{self.root}/{part}"
        if by == BUCKET:
            df = df.repartition(BUCKET) if few else df.hint("rebalance", BUCKET)
        writer = df.write.partitionBy(by) if by else df.write
        writer.mode("overwrite").parquet(place)
        if by != BUCKET:
            return [part]
        return [f"{part}/{child}" for child in _children(df.sparkSession, place)]

    def compact(
        self,
        spark: SparkSession,
        schema: T.StructType,
        min_parts: int = 8,
        by: str | None = None,
        order: str | None = None,
    ) -> int:
        """Merges parts that batches left small; returns how many were replaced.

        A bucketed table is merged bucket by bucket, where ``min_parts`` or more have gathered,
        sorted by ``order``. Another one is merged in runs of ``min_parts`` batches; the latest
        batches wait until their run is complete. Rows keep the batch that wrote them. Readers
        that are under way still find the replaced parts, until ``remove_replaced``.
        """
        parts = self.live(spark)
        if by == BUCKET:
            buckets: dict[str, list[str]] = {}
            for part in parts:
                buckets.setdefault(part.rsplit("=", 1)[1], []).append(part)
            chosen = [p for held in buckets.values() if len(held) >= min_parts for p in held]
            runs = [chosen] if chosen else []
        else:
            runs = [parts[k : k + min_parts] for k in range(0, len(parts), min_parts)]
            runs = [run for run in runs if len(run) == min_parts > 1]
        for run in runs:
            places = [f"{self.root}/{part}" for part in run]
            whole = T.StructType([*schema, *BATCH])
            rows = spark.read.schema(whole).option("basePath", self.root).parquet(*places)
            if by != BUCKET:
                rows = rows.select(*whole.names).hint("rebalance")
            else:
                rows = rows.select(*whole.names, BUCKET)
            if order:
                rows = rows.sortWithinPartitions(order)
            added = self._write(rows, by)
            # Under the first batch's name, so that the order of parts stays.
            first = next(r for r in self.commits.load(spark) if run[0] in r["added"])
            self.commits.add(
                spark, [_record(self.name, added, run, first["query_id"], first["batch_id"])]
            )
        return sum(map(len, runs))

    def remove_replaced(self, spark: SparkSession) -> int:
        """Deletes the directories of replaced parts; run it when no older reader is left."""
        records = [r for r in self.commits.load(spark) if r["table"] == self.name]
        gone = {part for r in records for part in r["replaced"]}
        for part in gone:
            _remove(spark, f"{self.root}/{part}")
        return len(gone)


def committed_once(
    commits: Commits, spark: SparkSession, query_id: str, batch_id: int,
    write: Callable[[list[Row]], list[Row]],
) -> list[Row]:
    """Commits what ``write`` stages, unless this batch is committed already; all records then.

    ``write`` gets the records so far and returns those of the batch. If it fails, nothing counts.
    """
    records = commits.load(spark)
    if any(r["query_id"] == query_id and r["batch_id"] == batch_id for r in records):
        return records
    added = write(records)
    commits.add(spark, added)
    return [*records, *added]
