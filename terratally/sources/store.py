"""A star kept as Parquet parts that never change, and the commits that say which of them count.

Every load writes parts of its own: members of a dimension below ``<table>/load=<id>``, rows of a
fact below ``<fact>/year=/month=/day=/load=<id>``, and the index of their keys below
``_index/<fact>/bucket=/load=<id>``. Nothing that a reader may use is overwritten. At the end one
small file under ``_commits`` names the loads that make up each table, day and bucket, so a load
shows as a whole or not at all; what a stopped load has left is never read and may be removed by
``expire``. A commit takes a number of its own, so of two loads on the same state one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terratally.functions.keys import numbered
from terratally.sources.warehouse import DAY_PARTITIONS, day_layout, split_by_day, stored

#: Buckets of a key index. Keys that differ in their last characters alone share one, so keys
#: handed out in sequence touch few buckets a day, and any others spread evenly.
BUCKETS = 256
_LAST_CHARACTERS = 4
#: Parts of one table, day or bucket before they are written together.
MOST_PARTS = 8
_COMMITS = "_commits"
_NO_DAY = "undated"
_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Commit:
    """What counts: loads by table, by fact and day, by fact and bucket; the next fact keys."""

    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    days: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    index: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    next_key: dict[str, int] = field(default_factory=dict)


class Store:
    """One load on top of the last commit under ``root``, or a look at that commit."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.base = last_commit(spark, self.root)
        self.load = f"{self.base.number + 1:08d}-{uuid.uuid4().hex[:12]}"
        self.next = replace(self.base, number=self.base.number + 1, **{
            name: json.loads(json.dumps(getattr(self.base, name)))
            for name in ("tables", "days", "index", "next_key")
        })

    # --- dimensions ---------------------------------------------------------------

    def table(self, name: str, layout: StructType) -> DataFrame | None:
        """The committed members of a dimension."""
        loads = self.base.tables.get(name)
        if loads is None:
            return None
        paths = [f"{self.root}/{name}/load={load}" for load in loads]
        return self.spark.read.schema(layout).parquet(*paths)

    def put_members(self, name: str, layout: StructType, rows: DataFrame, key: str) -> None:
        """Add members with final keys. New ones are appended; a changed one has the table written anew.

        Stored members that ``rows`` does not have stay.
        """
        kept = self.table(name, layout)
        if kept is None:
            self._write_members(name, rows.select(*layout.names))
            return
        others = [c for c in layout.names if c != key]
        before = kept.select(F.col(key), F.struct(*others).alias("_before"))
        same = [F.col(c).eqNullSafe(F.col(f"_before.{c}")) for c in others]
        differing = stored(
            rows.select(*layout.names)
            .join(before, key, "left")
            .withColumn("_new", F.col("_before").isNull())
            .where(F.col("_new") | ~_all(same))
            .select(*layout.names, "_new"),
            f"differing-{name}",
        )
        counts = {r["_new"]: r["count"] for r in differing.groupBy("_new").count().collect()}
        rows = differing.select(*layout.names)
        if False in counts or (counts and len(self.base.tables[name]) >= MOST_PARTS):
            rest = kept.join(rows.select(key), key, "left_anti")
            self._write_members(name, rest.unionByName(rows))
        elif counts:
            self._write_members(name, rows, [*self.base.tables[name]])

    def _write_members(self, name: str, rows: DataFrame, beside: list[str] | None = None) -> None:
        write_part(rows, f"{self.root}/{name}/load={self.load}")
        self.next.tables[name] = [*(beside or []), self.load]

    # --- facts --------------------------------------------------------------------

    def days(
        self, name: str, layout: StructType, day: str,
        first: date | None = None, last: date | None = None, only: set[str] | None = None,
    ) -> DataFrame:
        """Committed rows of a fact; bounds and ``only`` choose the days whose files are opened."""
        whole = day_layout(layout, day).add("load", "string")
        paths = [
            f"{self.root}/{name}/{_day_folder(label)}/load={load}"
            for label, loads in sorted(self.base.days.get(name, {}).items())
            for load in loads
            if _within(label, first, last) and (only is None or label in only)
        ]
        return self._parts(whole, f"{self.root}/{name}", paths).drop("load")

    def where_kept(self, name: str, key: str, wanted: DataFrame) -> DataFrame | None:
        """(key, sk, year, month, day) of those ``wanted`` keys that the fact has, by its index.

        None if no bucket of theirs has an entry. Only the buckets of the wanted keys are opened. Of several entries those of the last load
        hold: one for each of its rows with the key.
        """
        layout = StructType.fromDDL(f"{key} string, sk long, year int, month int, day int, bucket int, load string")
        hit = wanted.where(F.col(key).isNotNull()).select(key_bucket(key).alias("bucket")).distinct()
        buckets = {str(r.bucket) for r in hit.collect()}
        paths = [
            f"{self.root}/_index/{name}/bucket={bucket}/load={load}"
            for bucket, loads in sorted(self.base.index.get(name, {}).items())
            for load in loads
            if bucket in buckets
        ]
        if not paths:
            return None
        entries = self._parts(layout, f"{self.root}/_index/{name}", paths)
        newest = Window.partitionBy(key).orderBy(F.desc("load"))
        found = entries.join(wanted.select(key).distinct(), key, "left_semi")
        return found.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").select(key, "sk", *DAY_PARTITIONS)

    def merge(
        self, name: str, layout: StructType, rows: DataFrame, day: str, key: str, sk: str,
        only_new: bool = False,
    ) -> None:
        """Add rows to a fact; stored rows of the same ``key`` give way, wherever their day was.

        With ``only_new`` the stored rows stay instead. A row that replaces another takes its
        surrogate key over; new rows get the next keys in the order of ``key``. Opened are the
        index buckets of the incoming keys and the days of the rows that are replaced; days that
        only gain rows get one more part. A row without a key is always a new one.
        """
        incoming = stored(split_by_day(rows, day), f"incoming-{name}")
        columns = incoming.columns
        before = self.where_kept(name, key, incoming)
        before = before and stored(before, f"kept-{name}")
        whole = F.xxhash64(*columns)
        moved = set()
        if before is None:
            known = incoming.withColumn("_sk", F.lit(None).cast("long"))
        elif only_new:
            known = incoming.join(before.select(key), key, "left_anti").withColumn("_sk", F.lit(None).cast("long"))
        else:
            alone = F.when(F.col(key).isNull(), whole)
            copy = F.row_number().over(Window.partitionBy(key, alone).orderBy(whole))
            place = F.row_number().over(Window.partitionBy(key).orderBy("sk"))
            earlier = before.select(key, F.col("sk").alias("_sk"), place.alias("_copy"))
            known = incoming.withColumn("_copy", copy).join(earlier, [key, "_copy"], "left").drop("_copy")
            known = stored(known, f"known-{name}")
            moved = _labels(before)
        start = self.base.next_key.get(name, 1)
        new = known.where("_sk IS NULL").drop("_sk")
        placed = numbered(new, "_place", [F.col(key), whole])
        self.next.next_key[name] = start + new.count()
        written = stored(
            placed.withColumn(sk, F.col("_place") + start).select(*columns).unionByName(
                known.where("_sk IS NOT NULL").withColumn(sk, F.col("_sk")).select(*columns)
            ),
            f"written-{name}",
        )
        full = {d for d, loads in self.base.days.get(name, {}).items() if len(loads) >= MOST_PARTS}
        rewritten = moved | (full & _labels(written))
        parts = written
        if rewritten:
            stay = self.days(name, layout, day, only=rewritten)
            if before is not None and not only_new:
                stay = stay.join(before.select(key), key, "left_anti")
            parts = stored(written.unionByName(stay.select(*columns)), f"rewritten-{name}")
        days = self.next.days.setdefault(name, {})
        for label in rewritten:
            days.pop(label, None)
        gained = _labels(parts)
        if gained:
            write_part(_of_load(parts.hint("rebalance", *DAY_PARTITIONS), self.load), f"{self.root}/{name}", *DAY_PARTITIONS)
        for label in gained:
            days[label] = [*days.get(label, []), self.load]
        self._add_to_index(name, written, key, sk)

    def _add_to_index(self, name: str, rows: DataFrame, key: str, sk: str) -> None:
        entries = rows.where(F.col(key).isNotNull()).select(
            F.col(key), F.col(sk).alias("sk"), *DAY_PARTITIONS, key_bucket(key).alias("bucket")
        )
        index = self.next.index.setdefault(name, {})
        path = f"{self.root}/_index/{name}"
        buckets = {str(r.bucket) for r in entries.select("bucket").distinct().collect()}
        full = sorted(b for b in buckets if len(index.get(b, [])) >= MOST_PARTS)
        if full:
            whole = StructType([*entries.schema.fields]).add("load", "string")
            paths = [f"{path}/bucket={b}/load={load}" for b in full for load in index[b]]
            older = self._parts(whole, path, paths).join(entries.select(key), key, "left_anti")
            newest = Window.partitionBy(key).orderBy(F.desc("load"))
            latest = older.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
            entries = entries.unionByName(latest.select(*entries.columns))
            for bucket in full:
                index.pop(bucket)
        if not buckets:
            return
        write_part(_of_load(entries.hint("rebalance", "bucket"), self.load), path, "bucket")
        for bucket in buckets:
            index[bucket] = [*index.get(bucket, []), self.load]

    def _parts(self, layout: StructType, base: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).option("basePath", base).parquet(*paths)

    # --- commits ------------------------------------------------------------------

    def commit(self) -> None:
        """Make the load visible."""
        path = f"{self.root}/{_COMMITS}/{self.next.number:08d}.json"
        files, at = _files(self.spark, path)
        unseen, draft = _files(self.spark, f"{self.root}/{_COMMITS}/.{self.load}")
        stream = unseen.create(draft, True)
        stream.write(bytearray(json.dumps(asdict(self.next)).encode()))
        stream.close()
        if files.exists(at) or not files.rename(draft, at):
            raise RuntimeError(f"another load has been committed as {path}")


def last_commit(spark: SparkSession, root: str) -> Commit:
    """The commit with the highest number, or an empty one."""
    numbers = _commit_numbers(spark, root)
    return _commit(spark, root, numbers[-1]) if numbers else Commit()


def _commit_numbers(spark: SparkSession, root: str) -> list[int]:
    files, folder = _files(spark, f"{root}/{_COMMITS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name[:-5].isdigit() and name.endswith(".json"))


def _commit(spark: SparkSession, root: str, number: int) -> Commit:
    files, path = _files(spark, f"{root}/{_COMMITS}/{number:08d}.json")
    stream = files.open(path)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return Commit(**json.loads(text))


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove parts that none of the last ``keep`` commits uses; returns how many.

    To be called while no load is running; readers of older commits lose their files.
    """
    numbers = _commit_numbers(spark, root)
    live: set[str] = set()
    for number in numbers[-keep:]:
        commit = _commit(spark, root, number)
        live |= {f"{t}/load={load}" for t, loads in commit.tables.items() for load in loads}
        live |= {
            f"{fact}/{_day_folder(label)}/load={load}"
            for fact, days in commit.days.items() for label, loads in days.items() for load in loads
        }
        live |= {
            f"_index/{fact}/bucket={bucket}/load={load}"
            for fact, buckets in commit.index.items() for bucket, loads in buckets.items() for load in loads
        }
    removed = 0
    for pattern in ("*/load=*", "_index/*/*/load=*", "*/year=*/month=*/day=*/load=*"):
        files, glob = _files(spark, f"{root}/{pattern}")
        for status in files.globStatus(glob) or []:
            parts = status.getPath().toString().split("/")
            if "/".join(parts[-pattern.count("/") - 1 :]) not in live:
                removed += bool(files.delete(status.getPath(), True))
    for number in numbers[:-keep]:
        files, path = _files(spark, f"{root}/{_COMMITS}/{number:08d}.json")
        files.delete(path, False)
    return removed


def write_part(rows: DataFrame, path: str, *parts: str) -> None:
    """Every write of a load but the commit: new files only."""
    if parts:
        rows.write.mode("append").partitionBy(*parts, "load").parquet(path)
    else:
        rows.write.parquet(path)


def key_bucket(key: str) -> Column:
    start = F.substring(F.col(key), F.lit(1), F.greatest(F.length(key) - _LAST_CHARACTERS, F.lit(0)))
    return F.pmod(F.xxhash64(start), F.lit(BUCKETS)).cast("int")


def _of_load(rows: DataFrame, load: str) -> DataFrame:
    return rows.withColumn("load", F.lit(load))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def _labels(rows: DataFrame) -> set[str]:
    """The days of ``rows``, at most those of the calendar."""
    return {_day_label(r) for r in rows.select(*DAY_PARTITIONS).distinct().collect()}


def _day_label(row) -> str:
    return _NO_DAY if row.year is None else f"{row.year:04d}-{row.month:02d}-{row.day:02d}"


def _day_folder(label: str) -> str:
    values = [_NO_PARTITION] * 3 if label == _NO_DAY else [int(v) for v in label.split("-")]
    return "/".join(f"{name}={value}" for name, value in zip(DAY_PARTITIONS, values, strict=True))


def _within(label: str, first: date | None, last: date | None) -> bool:
    if first is None and last is None:
        return True
    if label == _NO_DAY:
        return False
    day = date.fromisoformat(label)
    return (first is None or day >= first) and (last is None or day <= last)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at
