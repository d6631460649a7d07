"""Stored tables behind a commit log: what a reader sees changes by one atomic rename.

A table is a folder. Data files lie in ``_data/commit=<name>/`` (one folder for each day below it, if the table is
kept by day) and are never overwritten. The log, ``_log/``, holds numbered snapshots: a small JSON file with one
entry for each day, naming the folders that hold the day, their rows, and what the writer wants to remember
(``of``). A writer stores its files, writes the next snapshot under a private name and renames it; until then,
and if it dies before, every reader sees the former snapshot whole. Of two writers that start from one snapshot
one publishes; the other finds its number taken and fails with :class:`CommitConflict`.

Readers open the folders that the newest snapshot names; nothing is listed to learn which days exist. The last
``KEPT`` snapshots stay readable, so a query that has begun keeps its files over the next commits. Folders that
only older ones name are removed by the commit that retires them; what crashed writers left, by :func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DATA, LOG, COMMIT = "_data", "_log", "commit"
KEPT = 3
#: The key of rows without a day, and of a table that is not kept by day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
WHOLE = ""


class CommitConflict(RuntimeError):
    """Another writer has published since this one read the log."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: ``days`` maps a day to its entry {"folders": [...], "rows": n, "of": {...}}."""

    root: str
    version: int = 0
    days: Mapping[str, dict] = field(default_factory=dict)

    def day_list(self) -> list[str]:
        return sorted(d for d in self.days if d not in (NO_DAY, WHOLE))

    def folders(self, days: Iterable[str] | None = None) -> list[str]:
        wanted = self.days if days is None else [d for d in days if d in self.days]
        return [f"{self.root}/{DATA}/{folder}" for d in sorted(wanted) for folder in self.days[d]["folders"]]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, log = _file_system(spark, root), _path(spark, f"{root}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]    # KEPT files and a few
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def _entries(spark: SparkSession, root: str, version: int) -> dict:
    stream = _file_system(spark, root).open(_path(spark, f"{root}/{LOG}/{version:010d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The newest published state; an absent table is an empty one."""
    root = root.rstrip("/")
    versions = _versions(spark, root)
    return Snapshot(root, versions[-1], _entries(spark, root, versions[-1])) if versions else Snapshot(root)


def publish(spark: SparkSession, base: Snapshot, days: Mapping[str, dict]) -> Snapshot:
    """Make ``days`` the table's state after ``base``, by one rename."""
    root, version = base.root, base.version + 1
    fs = _file_system(spark, root)
    private, target = f"{root}/{LOG}/.{uuid.uuid4().hex}", f"{root}/{LOG}/{version:010d}.json"
    out = fs.create(_path(spark, private), True)
    out.write(bytearray(json.dumps(dict(sorted(days.items()))).encode("utf-8")))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(_path(spark, root)).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, private), _path(spark, target), plain)
    except Py4JJavaError as e:
        fs.delete(_path(spark, private), False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise CommitConflict(f"{root}: snapshot {version} is there already") from None
        raise
    now = Snapshot(root, version, dict(days))
    _retire(spark, now)
    return now


def _retire(spark: SparkSession, now: Snapshot) -> None:
    """Forget snapshots older than the last ``KEPT``, and the folders that none of these names."""
    fs = _file_system(spark, now.root)
    versions = _versions(spark, now.root)
    kept = {f for v in versions[-KEPT:] for e in _entries(spark, now.root, v).values() for f in e["folders"]}
    for v in versions[:-KEPT]:
        for folder in {f for e in _entries(spark, now.root, v).values() for f in e["folders"]} - kept:
            fs.delete(_path(spark, f"{now.root}/{DATA}/{folder}"), True)
        fs.delete(_path(spark, f"{now.root}/{LOG}/{v:010d}.json"), False)


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove what no kept snapshot names (writers that died); no writer may be at work. Returns the folders removed."""
    root = root.rstrip("/")
    fs, data = _file_system(spark, root), _path(spark, f"{root}/{DATA}")
    kept = {f.split("/")[0] for v in _versions(spark, root) for e in _entries(spark, root, v).values() for f in e["folders"]}
    left = [s.getPath() for s in fs.listStatus(data)] if fs.exists(data) else []
    gone = [p for p in left if p.getName() not in kept]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def store(df: DataFrame, root: str, commit: str, key: str | None = "date_ech") -> dict[str, dict]:
    """Write the files of a commit and return its entries, one for each day with rows; nothing is published yet.

    The rows of each day are counted from the files' footers.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    folder = f"{COMMIT}={commit}"
    path = f"{root}/{DATA}/{folder}"
    writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    if key is None:
        writer.parquet(path)
        return {WHOLE: {"folders": [folder], "rows": None, "of": {}}}
    writer.partitionBy(key).parquet(path)
    counted = spark.read.schema(f"{key} string").parquet(path).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    names = {r[0] if r[0] is not None else NO_DAY: r["n"] for r in counted.collect()}     # one row for each day
    return {d: {"folders": [f"{folder}/{key}={d}"], "rows": n, "of": {}} for d, n in names.items()}


def new_commit() -> str:
    return f"c{uuid.uuid4().hex}"


def replace_days(df: DataFrame, root: str, days: Iterable[str] | None, key: str = "date_ech",
                 of: Mapping[str, dict] | None = None) -> Snapshot:
    """Make ``df`` the content of ``days``, which go if it has no row for them (``None``: of the whole table)."""
    base = snapshot(df.sparkSession, root)
    entries = store(df, root, new_commit(), key)
    gone = base.days if days is None else set(days)
    for d, what in (of or {}).items():
        if d in entries:
            entries[d]["of"] = what
    return publish(df.sparkSession, base, {d: e for d, e in base.days.items() if d not in gone} | entries)


def replace_whole(df: DataFrame, root: str) -> Snapshot:
    """Make ``df`` the content of a table that is not kept by day."""
    base = snapshot(df.sparkSession, root)
    return publish(df.sparkSession, base, store(df, root, new_commit(), None))


def append_days(df: DataFrame, root: str, commit: str, key: str = "date_ech") -> bool:
    """Add rows beside what their days hold, under a commit name of the caller's; does the commit hold any?

    A commit that the log already names is done: nothing is written again.
    """
    spark = df.sparkSession
    base = snapshot(spark, root)
    if any(f.split("/")[0] == f"{COMMIT}={commit}" for e in base.days.values() for f in e["folders"]):
        return True
    entries = store(df, root, commit, key)
    if not entries:
        return False
    days = dict(base.days)
    for d, e in entries.items():
        old = days.get(d, {"folders": [], "rows": 0, "of": {}})
        days[d] = {"folders": old["folders"] + e["folders"], "rows": old["rows"] + e["rows"], "of": old["of"]}
    publish(spark, base, days)
    return True


def read(spark: SparkSession, root: str, schema: StructType, days: Iterable[str] | None = None,
         at: Snapshot | None = None) -> DataFrame:
    """The table's newest state, or the given days of it, with the columns of ``schema`` in order."""
    state = at or snapshot(spark, root)
    folders = state.folders(days)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{state.root}/{DATA}").parquet(*folders).select(*schema.fieldNames())
