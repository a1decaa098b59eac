"""Micro-batch tables: appends that may be repeated, and merging that hides no row.

A batch is written to a folder of its own, so a batch delivered again replaces what it wrote
before. That leaves many small files. ``merge`` gathers them beside the table, and one small commit
file says, for each day, which batches it now stands for and where. Whatever is not named there
is read from its batch folder: an event that comes late for a merged day is visible at once.

Nothing is overwritten or deleted by a merge, so a reader keeps the files it has listed. ``forget``
removes what was replaced long enough ago.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from cartwheel.schemas import RAW_EVENTS, TRAFFIC_STATS, empty_table

PIECES = 8              # merged pieces of a day; with one more the day is written anew
KEEP_HOURS = 24.0       # longer than the longest reader runs


@dataclass(frozen=True)
class BatchTable:
    """Rows of ``fields`` below ``path``. With ``day``, a date column that rows bring along, the
    layout has a folder for each day. ``order`` sorts the merged files. One writer per run, one
    merger per table."""

    path: str
    fields: StructType
    day: str | None = None
    order: str | None = None

    # -- writing ----------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int, run: str) -> None:
        """Write one batch. ``run`` names the checkpoint: a stream begun anew counts from batch 0
        again and must not touch old data. A large day is split over tasks, small ones share one."""
        days = [self.day] if self.day else []
        (batch.select(*self.fields.names, *days).hint("rebalance", *days)
              .withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(*days, "run", "batch_id").parquet(self.path))
        _replace_mark(batch.sparkSession, f"{self._beside}/batches/run={run}", batch_id)

    def merge(self, spark: SparkSession, before: str | None = None) -> list[str]:
        """Gather complete batches that are not merged yet, of days before ``before`` only; returns
        the days touched. No other day is read or written. A day's new batches make one more piece;
        only when it has ``PIECES`` of them its whole is gathered again."""
        state = self._state(spark)
        marks = self._marks(spark)     # asked first: batches up to a mark are complete
        if not marks:
            return []
        ready = self._fresh(spark, state).filter(_upto(marks))
        if self.day and before:
            ready = ready.filter(F.col(self.day) < F.lit(before).cast("date"))
        if self.day:
            touched = sorted(str(r[0]) for r in ready.select(self.day).distinct().collect())
        else:
            touched = [""] if not ready.isEmpty() else []
        if not touched:
            return []
        whole = [d for d in touched if len(state["days"].get(d, {}).get("pieces", [])) >= PIECES]
        rows = self._of_days(ready, touched).drop("run", "batch_id")
        if whole:
            rows = rows.unionByName(self._merged(spark, state, whole))
        number = state["number"] + 1
        generation = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        days = [self.day] if self.day else []
        sort = [c for c in (self.day, self.order) if c]
        gathered = rows.hint("rebalance", *days)
        if sort:
            gathered = gathered.sortWithinPartitions(*sort)
        gathered.write.mode("overwrite").partitionBy(*days).parquet(f"{self._beside}/data/generation={generation}")
        new = {d: dict(v) for d, v in state["days"].items()}
        for d in touched:
            old = new.get(d, {"pieces": [], "upto": {}})
            new[d] = {"pieces": [generation] if d in whole else [*old["pieces"], generation],
                      "upto": {**old["upto"], **{r: max(n, old["upto"].get(r, n)) for r, n in marks.items()}}}
        _commit(spark, f"{self._beside}/commits", number, {"days": new})
        return touched

    def forget(self, spark: SparkSession, keep_hours: float = KEEP_HOURS) -> None:
        """Remove batches and pieces that a commit older than ``keep_hours`` has replaced. Readers
        of the bare folder ``path`` no longer see the rows then; ``read`` does."""
        fs, path_of = _files(spark, self.path)
        commits = _commits(spark, f"{self._beside}/commits")
        limit = time.time() * 1000 - keep_hours * 3_600_000
        old = [c for c in commits if c[1] <= limit]
        if not old:
            return
        settled = _load(spark, old[-1][2])
        pattern = f"{self.path}/{f'{self.day}=*/' if self.day else ''}run=*/batch_id=*"
        for status in fs.globStatus(path_of(pattern)) or []:
            names = dict(part.split("=", 1) for part in status.getPath().toString().rstrip("/").split("/")[-3:] if "=" in part)
            of_day = settled["days"].get(names.get(self.day, "") if self.day else "", {"upto": {}})
            if int(names["batch_id"]) <= of_day["upto"].get(names["run"], -1):
                fs.delete(status.getPath(), True)
        named = {p for c in commits if c[0] >= old[-1][0] for d in _load(spark, c[2])["days"].values() for p in d["pieces"]}
        for status in fs.globStatus(path_of(f"{self._beside}/data/generation=*")) or []:
            piece = status.getPath().getName().split("=", 1)[1]
            if piece not in named and int(piece.split("-")[0]) <= commits[-1][0]:    # a later one is being written
                fs.delete(status.getPath(), True)
        for number, _, path in commits:
            if number < old[-1][0]:
                fs.delete(path_of(path), False)

    # -- reading ----------------------------------------------------------------------------

    def read(self, spark: SparkSession) -> DataFrame:
        """Every row once. Filters on the day prune folders of both parts."""
        state = self._state(spark)
        fresh = self._fresh(spark, state).drop("run", "batch_id")
        return fresh.unionByName(self._merged(spark, state, list(state["days"]))) if state["days"] else fresh

    @property
    def _beside(self) -> str:
        return f"{self.path.rstrip('/')}_merged"

    def _day_field(self) -> list[StructField]:
        return [StructField(self.day, DateType())] if self.day else []

    def _scan(self, spark: SparkSession, path: str, *parts: StructField) -> DataFrame:
        schema = StructType([*self.fields.fields, *self._day_field(), *parts])
        fs, path_of = _files(spark, path)
        if not fs.exists(path_of(path)):
            return empty_table(spark, schema)
        return spark.read.schema(schema).parquet(path).select(*schema.names)

    def _of_days(self, df: DataFrame, days: list[str]) -> DataFrame:
        return df.filter(self._in(days)) if self.day else df

    def _in(self, days: list[str]) -> Column:
        return F.col(self.day).isin([F.lit(d).cast("date") for d in days]) if self.day else F.lit(True)

    def _fresh(self, spark: SparkSession, state: dict) -> DataFrame:
        """Rows of batches that no piece stands for; the others' folders are pruned."""
        rows = self._scan(spark, self.path, StructField("run", StringType()), StructField("batch_id", LongType()))
        alike: dict[str, list[str]] = {}      # days merged up to the same batches
        for day, merged in state["days"].items():
            alike.setdefault(json.dumps(merged["upto"], sort_keys=True), []).append(day)
        merged = [self._in(days) & _upto(json.loads(upto)) for upto, days in alike.items()]
        return rows.filter(~F.coalesce(_any(merged), F.lit(False))) if merged else rows

    def _merged(self, spark: SparkSession, state: dict, days: list[str]) -> DataFrame:
        rows = self._scan(spark, f"{self._beside}/data", StructField("generation", StringType()))
        held: dict[str, list[str]] = {}
        for day in days:
            for piece in state["days"][day]["pieces"]:
                held.setdefault(piece, []).append(day)
        return rows.filter(_any([(F.col("generation") == g) & self._in(of) for g, of in held.items()])).drop("generation")

    def _state(self, spark: SparkSession) -> dict:
        """What the newest commit says: a line per day, and per day one number per run."""
        commits = _commits(spark, f"{self._beside}/commits")
        return {"number": commits[-1][0], **_load(spark, commits[-1][2])} if commits else {"number": 0, "days": {}}

    def _marks(self, spark: SparkSession) -> dict[str, int]:
        """The last complete batch of each run; those before it are complete, as they come in turn."""
        fs, path_of = _files(spark, self._beside)
        marks: dict[str, int] = {}
        for status in fs.globStatus(path_of(f"{self._beside}/batches/run=*/*")) or []:
            run = status.getPath().getParent().getName().split("=", 1)[1]
            marks[run] = max(marks.get(run, -1), int(status.getPath().getName()))
        return marks


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _upto(marks: dict[str, int]) -> Column:
    return _any([(F.col("run") == run) & (F.col("batch_id") <= n) for run, n in marks.items()])


def _files(spark: SparkSession, path: str):
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()), path_of


def _replace_mark(spark: SparkSession, folder: str, batch_id: int) -> None:
    """An empty file named after the last complete batch."""
    fs, path_of = _files(spark, folder)
    known = [s.getPath() for s in fs.listStatus(path_of(folder))] if fs.exists(path_of(folder)) else []
    if any(int(p.getName()) >= batch_id for p in known):
        return
    fs.create(path_of(f"{folder}/{batch_id}"), True).close()
    for path in known:
        fs.delete(path, False)


def _commits(spark: SparkSession, folder: str) -> list[tuple[int, int, str]]:
    """(number, time in milliseconds, path), oldest first."""
    fs, path_of = _files(spark, folder)
    found = [(s.getPath().getName(), s.getModificationTime(), s.getPath().toString())
             for s in fs.globStatus(path_of(f"{folder}/*.json")) or []]
    return sorted((int(name.removesuffix(".json")), at, path) for name, at, path in found)


def _commit(spark: SparkSession, folder: str, number: int, state: dict) -> None:
    """Write the commit aside and move it in, so that it is there whole or not at all."""
    fs, path_of = _files(spark, folder)
    aside = path_of(f"{folder}/writing-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if not fs.rename(aside, path_of(f"{folder}/{number:012d}.json")):
        raise RuntimeError(f"commit {number} exists: two merges of one table at a time")


def _load(spark: SparkSession, path: str) -> dict:
    fs, path_of = _files(spark, path)
    stream = fs.open(path_of(path))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def raw_table(path: str) -> BatchTable:
    return BatchTable(path, RAW_EVENTS, "event_date", "timestamp")


def windows_table(path: str) -> BatchTable:
    return BatchTable(path, TRAFFIC_STATS, order="window_start")


def append_raw(batch: DataFrame, batch_id: int, path: str, run: str) -> None:
    """Valid events of one batch, laid out by day."""
    rows = batch.withColumnRenamed("event_time", "timestamp")
    raw_table(path).append(rows.withColumn("event_date", F.to_date("timestamp")), batch_id, run)


def write_batch(batch: DataFrame, batch_id: int, path: str, run: str) -> None:
    """Append one batch of any rows; delivering it again replaces it."""
    BatchTable(path, batch.schema).append(batch, batch_id, run)


def append_windows(batch: DataFrame, batch_id: int, path: str, run: str) -> None:
    """Windows that the watermark has closed."""
    windows_table(path).append(batch, batch_id, run)


def compact_days(spark: SparkSession, path: str, before: str) -> list[str]:
    """Merge the batches of ``raw_events`` on all days before ``before``, late ones too."""
    return raw_table(path).merge(spark, before)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """``raw_events``, merged or not, no event twice."""
    return raw_table(path).read(spark)


def jdbc_write(df: DataFrame, options: dict[str, str], replace: bool = False) -> None:
    """Write to a database; ``replace`` empties the table but keeps its schema and indexes."""
    writer = df.write.format("jdbc").options(**options)
    if replace:
        writer.option("truncate", "true").mode("overwrite").save()
    else:
        writer.mode("append").save()
