"""Writes on Parquet directories: idempotent append, month replacement, rebuild and merges by hash bucket.

Rows of one write lie in a directory of their own, below it by partition: rev=<write>/<partition>.
A small pointer file names the live ones of each partition, with the table's columns;
a write that is done puts the next pointer beside the last, and that is all that readers
see of it. So a reader keeps what it opened, a killed writer leaves nothing that shows, a
replaced month changes at once, and a merge rewrites only the buckets in which a row
is new or other than before. Of two writers that began from one pointer the second does
its check again.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Hash buckets of a merged table, fixed when it is first written.
BUCKETS = 16
#: Times that a write begins anew because another one was faster.
ATTEMPTS = 20
#: Hashed keys, most of a fact's bytes, are hex digits, which this stores in half their length.
CODEC = "zstd"
POINTERS, REV, BUCKET = "pointers", "rev", "bucket"
_commits = threading.Lock()


class TableError(ValueError):
    pass


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- listings and pointers go through Hadoop's file system, so any store will do
    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names_in(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _versions(self, name: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names_in(f"{self.root}/{name}/{POINTERS}") if n.endswith(".json") and n[:-5].isdigit())

    def _pointer(self, name: str, version: int) -> dict:
        p, fs = self._at(f"{self.root}/{name}/{POINTERS}/{version:08}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _newest(self, name: str) -> tuple[int, dict]:
        versions = self._versions(name)
        if not versions:
            return 0, {"columns": None, "by": [], "buckets": 0, "leaves": {}, "sources": []}
        return versions[-1], self._pointer(name, versions[-1])

    def _commit(self, name: str, version: int, pointer: dict) -> bool:
        """Put the pointer at its number; false if another write was there first. The rename of a complete file refuses an existing one."""
        folder = f"{self.root}/{name}/{POINTERS}"
        final, fs = self._at(f"{folder}/{version:08}.json")
        draft, _ = self._at(f"{folder}/{uuid.uuid4().hex}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(pointer), "utf-8"))
        finally:
            stream.close()
        with _commits:  # local file systems rename over what is there
            done = not fs.exists(final) and fs.rename(draft, final)
        if not done:
            fs.delete(draft, False)
        return done

    def _change(self, name: str, make: Callable[[dict], tuple[dict, int] | None]) -> int:
        """make the next pointer from the newest until it is put in place; None: nothing to change. The rows that were written."""
        for _ in range(ATTEMPTS):
            version, pointer = self._newest(name)
            made = make(pointer)
            if made is None:
                return 0
            if self._commit(name, version + 1, made[0]):
                return made[1]
        raise TableError(f"{name} is written too often at a time")

    # --- reads
    def names(self) -> list[str]:
        return sorted(n for n in self._names_in(self.root) if self._versions(n))

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def _frame(self, name: str, pointer: dict, parts: list[str] | None = None) -> DataFrame:
        """Rows of some partitions, or all, as the pointer names them."""
        columns = StructType.fromJson(pointer["columns"])
        leaves = [leaf for part, found in pointer["leaves"].items() if parts is None or part in parts for leaf in found]
        if not leaves:
            return self.spark.createDataFrame([], columns)
        top = f"{self.root}/{name}"
        return self.spark.read.schema(StructType(columns.fields).add(REV, "string")).option("basePath", top).parquet(*(f"{top}/{leaf}" for leaf in leaves)).drop(REV)  # _metadata stays in reach

    def read(self, name: str) -> DataFrame:
        version, pointer = self._newest(name)
        if not version:
            raise TableError(f"no table {name}")
        frame = self._frame(name, pointer)
        return frame.drop(BUCKET) if pointer["by"] == [BUCKET] else frame

    def read_or_empty(self, name: str, like: DataFrame) -> DataFrame:
        return self.read(name) if self.exists(name) else like.limit(0)

    def unscanned(self, name: str, known: set[str]) -> DataFrame | None:
        """Rows in live directories that are not among the known ones, with _leaf, the directory; None: there is none. What is written never changes."""
        pointer = self._newest(name)[1]
        fresh = {p: [leaf for leaf in found if leaf not in known] for p, found in pointer["leaves"].items()}
        if not any(fresh.values()):
            return None
        return self._frame(name, pointer | {"leaves": fresh}).withColumn("_leaf", F.regexp_extract(F.col("_metadata.file_path"), rf"({REV}=.*)/[^/]+$", 1))

    def leaves(self, name: str) -> list[str]:
        return sorted(leaf for found in self._newest(name)[1]["leaves"].values() for leaf in found)

    def files(self, name: str) -> list[str]:
        """Live data files."""
        return sorted(self._frame(name, self._newest(name)[1]).inputFiles())

    # --- writes
    def _put(self, df: DataFrame, name: str, by: list[str], dealt: bool = False) -> tuple[int, dict[str, list[str]]]:
        """Write df into a directory of its own: rows, counted while writing, and leaves by partition. Rows of a partition are brought together first, if they are not dealt already."""
        rev = f"{REV}={uuid.uuid4().hex}"
        seen = Observation(uuid.uuid4().hex)
        writer = (df.hint("rebalance", *by) if by and not dealt else df).observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", CODEC)
        path = f"{self.root}/{name}/{rev}"
        (writer.partitionBy(*by) if by else writer).parquet(path)
        parts = [n for n in self._names_in(path) if "=" in n] if by else [""]
        return seen.get["n"], {p: [f"{rev}/{p}".rstrip("/")] for p in parts}

    def _columns(self, pointer: dict, df: DataFrame, by: list[str]) -> dict:
        """The table's columns and those that df adds, the partition column last."""
        fields = list(StructType.fromJson(pointer["columns"]).fields) if pointer["columns"] else []
        have = {f.name for f in fields}
        fields += [f for f in df.schema.fields if f.name not in have]
        fields.sort(key=lambda f: f.name in by)
        for f in fields:
            f.nullable = True
        return json.loads(StructType(fields).json())

    def append(self, df: DataFrame, name: str, by: tuple[str, ...] = (), dealt: bool = False) -> int:
        if df.isEmpty():
            raise TableError(f"nothing to append to {name}")
        by = self._newest(name)[1]["by"] or list(by)
        rows, leaves = self._put(df, name, by, dealt)
        return self._change(name, lambda pointer: (self._added(pointer, df, by, leaves), rows))

    def _added(self, pointer: dict, df: DataFrame, by: list[str], leaves: dict[str, list[str]]) -> dict:
        every = {p: [*pointer["leaves"].get(p, []), *leaves.get(p, [])] for p in (*pointer["leaves"], *leaves)}
        return pointer | {"columns": self._columns(pointer, df, by), "by": by, "leaves": every}

    def append_unseen(self, df: DataFrame, name: str, by: tuple[str, ...] = (), key: str = "_source_file") -> int:
        """Append the rows whose source file the table does not have; 0 on a second run.

        The list of sources, a small table below the table, is named by the same pointer as
        the rows: both show at once or not at all. A writer that was overtaken looks again.
        """
        mine, listed = df.select(key).distinct(), f"{name}/sources"

        def make(pointer: dict) -> tuple[dict, int] | None:
            rows = df
            if pointer["sources"]:
                known = self.spark.read.schema(mine.schema).parquet(*(f"{self.root}/{listed}/{leaf}" for leaf in pointer["sources"]))
                new = mine.join(known, key, "left_anti")
                if new.isEmpty():
                    return None
                rows = df.join(new, key, "left_semi")
            else:
                new = mine
            if not pointer["columns"] and new.isEmpty():
                return None
            _, sources = self._put(new, listed, [])
            n, leaves = self._put(rows, name, pointer["by"] or list(by))
            return self._added(pointer, df, pointer["by"] or list(by), leaves) | {"sources": [*pointer["sources"], *sources[""]]}, n

        return self._change(name, make)

    def replace_months(self, df: DataFrame, name: str, months: list[str], column: str = "billing_month", dealt: bool = False) -> int:
        """Replace some billing months; other months stay. Refuses rows of other months, and months without rows."""
        found = df.select(column).distinct().limit(len(months) + 1).collect()
        found = {r[column] for r in found}
        if found - set(months):
            raise TableError(f"rows outside {sorted(months)}")
        if set(months) - found:
            raise TableError(f"no rows for {sorted(set(months) - found)}")
        return self.replace_parts(df, name, column, months, dealt)

    def replace_month(self, df: DataFrame, name: str, month: str, dealt: bool = False) -> int:
        return self.replace_months(df, name, [month], dealt=dealt)

    def replace_parts(self, df: DataFrame, name: str, column: str, values: list[str], dealt: bool = False) -> int:
        """Replace the partitions of some values by df's rows, which may be none."""
        version, pointer = self._newest(name)
        if version:
            df = align(df, self._frame(name, pointer))
        rows, leaves = self._put(df, name, [column], dealt)

        def make(pointer: dict) -> tuple[dict, int]:
            kept = {p: found for p, found in pointer["leaves"].items() if p not in {f"{column}={v}" for v in values}}
            return pointer | {"columns": self._columns(pointer, df, [column]), "by": [column], "leaves": kept | leaves}, rows

        return self._change(name, make)

    def rebuild(self, df: DataFrame, name: str) -> int:
        """Replace the whole table by df, which may read the table itself."""
        rows, leaves = self._put(df, name, [])
        fresh = {"columns": self._columns({"columns": None}, df, []), "by": [], "buckets": 0, "leaves": leaves, "sources": []}
        return self._change(name, lambda pointer: (fresh, rows))

    def retain(self, name: str, versions: int = 2) -> list[str]:
        """Delete all but the newest pointers, and the leaves that only those named; returns the paths that went. Readers of an older version lose it."""
        numbers = self._versions(name)
        old, kept = numbers[: -max(1, versions)], numbers[-max(1, versions) :]
        named = lambda of: {x for v in of for p in [self._pointer(name, v)] for x in (*(leaf for found in p["leaves"].values() for leaf in found), *(f"sources/{s}" for s in p["sources"]))}
        gone = sorted(f"{self.root}/{name}/{leaf}" for leaf in named(old) - named(kept))
        for path in (*gone, *(f"{self.root}/{name}/{POINTERS}/{v:08}.json" for v in old)):
            file, fs = self._at(path)
            fs.delete(file, True)
        return gone

    def version(self, name: str) -> int:
        """Number of the newest pointer; 0: no table."""
        return self._newest(name)[0]

    def altered(self, name: str, since: int, keys: list[str], columns: list[str]) -> DataFrame | None:
        """Keys whose row had other values in these columns when pointer number since was the newest. Reads only what was rewritten; None: nothing."""
        version, now = self._newest(name)
        if not since or version == since:
            return None
        before = self._pointer(name, since)
        only = lambda a, b: a | {"leaves": {p: [x for x in found if x not in b["leaves"].get(p, [])] for p, found in a["leaves"].items()}}
        old, new = self._frame(name, only(before, now)), self._frame(name, only(now, before))
        same = F.lit(True)
        for c in (c for c in columns if c not in keys):
            same &= F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        return old.alias("o").join(new.alias("n"), keys).where(~same).select(*keys)

    # --- merges
    def _merge(self, df: DataFrame, name: str, keys: list[str], buckets: int, write: Callable[[DataFrame, DataFrame, dict], tuple[dict, int] | None]) -> int:
        """Merge df by hash bucket: write gets its rows with their buckets and the target's rows of these buckets only. A table written otherwise is dealt to buckets first."""
        number = self._newest(name)[1]["buckets"] or buckets
        source = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(number)).cast("int")).persist()
        try:
            touched = [f"{BUCKET}={r[0]}" for r in source.select(BUCKET).distinct().collect()]  # as many as buckets at most

            def make(pointer: dict) -> tuple[dict, int] | None:
                if not pointer["columns"]:
                    rows, leaves = self._put(source, name, [BUCKET])
                    return pointer | {"columns": self._columns(pointer, source, [BUCKET]), "by": [BUCKET], "buckets": number, "leaves": leaves}, rows
                if pointer["by"] != [BUCKET]:
                    whole = self._frame(name, pointer)
                    dealt = whole.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(number)).cast("int"))
                    _, leaves = self._put(dealt, name, [BUCKET])
                    columns = self._columns({"columns": None}, dealt, [BUCKET])
                    pointer = pointer | {"columns": columns, "by": [BUCKET], "buckets": number, "leaves": leaves}
                    return write(source, self._frame(name, pointer, touched), pointer) or (pointer, 0)
                return write(source, self._frame(name, pointer, touched), pointer)

            return self._change(name, make)
        finally:
            source.unpersist()

    def insert_missing(self, df: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS) -> int:
        """Append the rows whose key the table does not have; stored files stay as they are."""

        def write(source: DataFrame, target: DataFrame, pointer: dict) -> tuple[dict, int] | None:
            new = source.join(target.select(BUCKET, *keys), [BUCKET, *keys], "left_anti")
            rows, leaves = self._put(new.select(*target.columns), name, [BUCKET])
            return (self._added(pointer, target, [BUCKET], leaves), rows) if rows else None

        return self._merge(df, name, keys, buckets, write)

    def upsert(self, df: DataFrame, name: str, keys: list[str], least: tuple[str, ...] = (), buckets: int = BUCKETS) -> int:
        """Source rows win; columns named in least keep the smaller of both values. Only buckets with a new or changed row are rewritten."""

        def write(source: DataFrame, target: DataFrame, pointer: dict) -> tuple[dict, int] | None:
            changed = [r[0] for r in changes(target, source, [BUCKET, *keys], least).select(BUCKET).distinct().collect()]  # buckets
            if not changed:
                return None
            chosen = F.col(BUCKET).isin(changed)
            rows, leaves = self._put(upserted(target.where(chosen), source.where(chosen), [BUCKET, *keys], least), name, [BUCKET])
            return pointer | {"leaves": pointer["leaves"] | leaves}, rows

        return self._merge(df, name, keys, buckets, write)


def align(df: DataFrame, target: DataFrame) -> DataFrame:
    """df in the target's column order; refuses missing and additional columns."""
    missing, extra = sorted(set(target.columns) - set(df.columns)), sorted(set(df.columns) - set(target.columns))
    if missing or extra:
        raise TableError(f"schema drift: missing {missing}, additional {extra}")
    return df.select(*(F.col(n).cast(k) for n, k in target.dtypes))


def changes(target: DataFrame, source: DataFrame, keys: list[str], least: tuple[str, ...] = ()) -> DataFrame:
    """Source rows that target does not have, or that an upsert would change."""
    same = F.lit(True)
    for k in keys:
        same &= F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    other = F.col("t._has").isNull()
    for c in target.columns:
        if c not in keys:
            value = F.least(f"t.{c}", f"s.{c}") if c in least else F.col(f"s.{c}")
            other |= ~value.eqNullSafe(F.col(f"t.{c}"))
    return source.alias("s").join(target.withColumn("_has", F.lit(True)).alias("t"), same, "left").where(other).select("s.*")


def inserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target and the source rows whose key it does not have."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def upserted(target: DataFrame, source: DataFrame, keys: list[str], least: tuple[str, ...] = ()) -> DataFrame:
    """One row a key: the source's where it has one, else the target's."""
    same = F.lit(True)
    for k in keys:
        same &= F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    has = F.col("s._has").isNotNull()

    def value(c: str) -> Column:
        if c in least:
            return F.least(f"t.{c}", f"s.{c}").alias(c)
        return F.when(has, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    marked = source.withColumn("_has", F.lit(True)).alias("s")
    return target.alias("t").join(marked, same, "full_outer").select(*(value(c) for c in target.columns))


def latest_state(events: DataFrame, key: str, at: str) -> DataFrame:
    """Appended states of a run as its newest state: an update without rewriting."""
    from ..plans.serving import latest

    return latest(events, [key], at, "status")
