"""Persisted type-2 history: snapshot runs over a versioned store.

Every slice (host, listing, property, review) is one history. A run takes the rows of
one load and, for each slice, merges them into the open versions of the key-hash
folders that have incoming keys; folders without are neither read nor written.

    <path>/<slice>/run=R/part=open/bucket=B      the open versions of a folder, as of run R
    <path>/<slice>/run=R/part=closed/bucket=B    the versions that run R closed, written once
    <path>/commits/run=R                         one row: for each slice, the run that holds each folder

Slices of the same key, time of change and tie break have the same versions. They are merged together and
stored once with the columns of all, in the folder of the first of them (which the commit names); a
slice is read by its own columns. A slice stays in the folder that it is held in.

The commit row is written last and publishes all slices together. A run that dies
leaves files that no commit names: the version before stays readable, and the next
run takes the same number and overwrites them. ``expire`` removes open folders that
no kept commit names. What a run writes is the open versions of the touched
folders, not the history, without the columns that follow from key and time (id of the
version, start of validity), which reading adds; a key's rows are merged in a window that holds its open version and its
new dates.

Runs must come in time order, as snapshot runs do: a row not later than its key's
open version changes nothing. NULL keys are a key like any other.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions.dates import HOST_SINCE_FORMAT, SCRAPED_DATE_FORMAT, parse_date
from staylake.operators.history import HISTORY_COLUMNS, scd2_bulk, scd2_line

COMMIT = "run bigint, slices map<string, struct<columns: string, open: map<int, bigint>, folder: string>>, source string"


@dataclass(frozen=True)
class Slice:
    """What a history holds: its columns, key, time of change, and how that time is ordered."""

    columns: tuple[str, ...]
    key: str
    updated_at: str
    order_by: Callable[[Column], Column]
    tie_break: str = "id"


def by_date(date_format: str) -> Callable[[Column], Column]:
    return lambda c: parse_date(c, date_format)


def row_slices() -> dict[str, Slice]:
    """The models' own snapshots: every slice by row id, hosts by the date they joined."""
    from staylake.plans import warehouse as w

    scraped, since = by_date(SCRAPED_DATE_FORMAT), by_date(HOST_SINCE_FORMAT)
    return {"host": Slice(tuple(w.HOST_COLUMNS), "id", "host_since", since),
            "listing": Slice(tuple(w.LISTING_COLUMNS), "id", "scraped_date", scraped),
            "property": Slice(tuple(w.PROPERTY_COLUMNS), "id", "scraped_date", scraped),
            "review": Slice(tuple(w.REVIEW_COLUMNS), "id", "scraped_date", scraped)}


def natural_slices() -> dict[str, Slice]:
    """The same slices by host and by listing, which change from month to month."""
    from staylake.plans import warehouse as w

    scraped = by_date(SCRAPED_DATE_FORMAT)
    own = lambda cols: tuple(["id", "listing_id", *[c for c in cols if c not in ("id", "listing_id")]])
    return {"host": Slice((*w.HOST_COLUMNS, "scraped_date"), "host_id", "scraped_date", scraped),
            "listing": Slice(own(w.LISTING_COLUMNS), "listing_id", "scraped_date", scraped),
            "property": Slice(own(w.PROPERTY_COLUMNS), "listing_id", "scraped_date", scraped),
            "review": Slice((*own(w.REVIEW_COLUMNS),), "listing_id", "scraped_date", scraped)}


class SnapshotStore:
    def __init__(self, spark: SparkSession, path: str, slices: Mapping[str, Slice], buckets: int = 64):
        self.spark, self.path, self.slices, self.buckets = spark, path, dict(slices), buckets

    def commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException:  # no run yet (path not found)
            return None

    def last(self, as_of: int | None = None):
        """The newest commit row (of run ``as_of`` or earlier), or None."""
        commits = self.commits()
        if commits is None:
            return None
        return (commits if as_of is None else commits.filter(F.col("run") <= as_of)).orderBy(F.desc("run")).first()

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def _folders(self, commit) -> dict[str, list[str]]:
        """For each folder the slices it holds, or will hold: slices new to the store share one if their versions are the same."""
        taken = {held.folder or name for name, held in commit.slices.items()} if commit else set()
        folders: dict[str, list[str]] = {}
        of_new: dict[tuple, str] = {}
        for name, s in self.slices.items():
            held = commit.slices.get(name) if commit else None
            if held:
                folder = held.folder or name
            else:
                own = name
                while own in taken:
                    own += "_"
                folder = of_new.setdefault((s.key, s.updated_at, s.order_by, s.tie_break), own)
            folders.setdefault(folder, []).append(name)
        return folders

    def _open(self, name: str, commit, only: Sequence[int] | None = None) -> DataFrame | None:
        """The open versions that ``commit`` names, as stored, of all folders or of ``only`` these."""
        held = commit.slices.get(name) if commit else None
        chosen = {b: r for b, r in (held.open if held else {}).items() if only is None or b in only}
        if not chosen:
            return None
        folders = [f"{self.path}/{held.folder or name}/run={r}/part=open/bucket={b}" for b, r in sorted(chosen.items())]
        return self.spark.read.schema(held.columns).parquet(*folders)

    def _whole(self, name: str, stored: DataFrame) -> DataFrame:
        """A slice's own columns of stored versions, with the history columns that follow from a version's key and time of change."""
        s = self.slices[name]
        if "scd_id" in stored.columns:  # written with them
            return stored.select(*[c for c in s.columns if c not in HISTORY_COLUMNS], *HISTORY_COLUMNS)
        return scd2_bulk(stored.select(*s.columns, "valid_to"), s.key, s.updated_at, unique_key=True, valid_to=F.col("valid_to"))

    def read(self, name: str, as_of: int | None = None) -> DataFrame | None:
        """The complete history of a slice as of its last committed run (or as of run ``as_of``)."""
        commit = self.last(as_of)
        open_ = self._open(name, commit)
        if open_ is None:
            return None
        held = commit.slices[name]
        closed = self.spark.read.schema(f"{held.columns}, run bigint, part string, bucket int").parquet(f"{self.path}/{held.folder or name}")
        closed = closed.filter((F.col("part") == "closed") & (F.col("run") <= commit.run))
        return self._whole(name, closed.drop("run", "part", "bucket")).unionByName(self._whole(name, open_))

    def run_of(self, source: str) -> int | None:
        """The run that took in ``source``, or None."""
        commits = self.commits()
        row = commits.filter(F.col("source") == source).select("run").first() if commits is not None else None
        return row.run if row else None

    def run(self, rows: DataFrame, source: str | None = None) -> int:
        """Merge one load into every slice and publish them together; the run's number."""
        if source is not None and (done := self.run_of(source)) is not None:
            return done
        before = self.last()
        number = before.run + 1 if before else 0
        keys = sorted({s.key for s in self.slices.values()})
        of_key = rows.agg(*[F.collect_set(self._bucket(k)).alias(k) for k in keys]).first()  # at most ``buckets`` numbers each

        folders = self._folders(before)

        def merge(folder: str) -> tuple[str, dict[int, int], str] | None:
            names = folders[folder]
            s, held = self.slices[names[0]], before.slices.get(names[0]) if before else None
            touched = sorted(of_key[s.key])
            if not touched:
                self._remove(f"{self.path}/{folder}/run={number}")  # left by a run that died
                return (held.columns, dict(held.open), folder) if held else None
            incoming = rows.select(*dict.fromkeys(c for name in names for c in self.slices[name].columns))
            line = scd2_line(self._open(names[0], before, touched), incoming, s.key, s.updated_at, s.order_by, s.tie_break)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in line.schema)
            line = line.withColumns({"part": F.when(F.col("valid_to").isNull(), "open").otherwise("closed"), "bucket": self._bucket(s.key)})
            line.write.mode("overwrite").option("compression", "zstd").partitionBy("part", "bucket").parquet(f"{self.path}/{folder}/run={number}")
            return columns, {**(held.open if held else {}), **{b: number for b in touched}}, folder

        with ThreadPoolExecutor(max_workers=max(1, len(folders))) as pool:  # independent jobs, submitted together
            merged = dict(zip(folders, pool.map(merge, folders)))
        entries = {name: merged[folder] for folder, names in folders.items() for name in names if merged[folder]}
        row = self.spark.createDataFrame([(number, entries, source)], COMMIT)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/run={number}")
        return number

    def _remove(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def expire(self, keep: int = 1) -> list[str]:
        """Delete open folders of runs that none of the last ``keep`` commits names; their paths."""
        commits = self.commits()
        if commits is None:
            return []
        kept = commits.orderBy(F.desc("run")).limit(keep).collect()  # ``keep`` rows
        named = {(held.folder or name, r) for row in kept for name, held in row.slices.items() for r in held.open.values()}
        gone = []
        for name in {held.folder or n: None for row in kept for n, held in row.slices.items() if n in self.slices}:
            base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            fs = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(base) if fs.exists(base) else ():
                folder = f"{self.path}/{name}/{status.getPath().getName()}/part=open"
                run = int(status.getPath().getName().partition("=")[2])
                if (name, run) not in named and run <= kept[0].run and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(folder)):
                    self._remove(folder)
                    gone.append(folder)
        return gone


def run_snapshots(store: SnapshotStore, loads: Sequence[DataFrame]) -> SnapshotStore:
    """One snapshot run per load, in their order."""
    for rows in loads:
        store.run(rows)
    return store
