"""The star-schema warehouse on Spark's catalog.

Parquet tables have no transactions, MERGE, or overwrite-while-reading, so a
logical table is a series of physical versions ``<name>__v<N>``, each
partitioned by the load that wrote its rows, and one property of the database
says which version of every table is current and which of its loads can be
seen:

- ``publish`` writes whole new versions of several tables, checks them, and
  moves all of them by setting that property once;
- ``begin`` reserves a load number and returns a ``Load``.  What it appends
  lies in partitions of that number, which nobody sees; its commit adds the
  number to every table it touched, together with their row counts and id
  marks, by setting the property once.  So rows, counts and marks cannot
  disagree: a load that dies leaves rows that are never seen, its number is
  never used again, and the next load starts from the marks of what is seen;
- a dimension with ``buckets`` is partitioned by a hash of its key as well, so
  an insert reads only the buckets that its keys fall into, and an upsert
  rewrites only those (``Load.upsert``), the others being carried over;
- the property is changed under a lock (a catalog table, whose creation
  succeeds for one only), and only if the tables are as the load found them;
  otherwise the load is refused and can be run again.

A view named like the table follows the property for SQL users; views move
one after the other, after the commit.  Column lengths (VARCHAR, CHAR) are
enforced by the physical tables on every write; NOT NULL and UNIQUE are
checked on new rows before they become visible.

Physical data lives under ``spark.sql.warehouse.dir`` (shared storage on a
cluster).  Old versions and unseen loads are kept until ``vacuum``."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.keys import max_id
from quarry.operators.merge import new_rows, upsert
from quarry.operators.quality import constraint_checks
from quarry.schemas import COLUMN_TYPES, NOT_NULL, UNIQUE, WAREHOUSE_TABLES
from quarry.session import discard, materialize

_VERSION = re.compile(r"__v(\d+)$")
_STATE = "quarry.state"
LOAD = "_load"
BUCKET = "_bucket"
LOCK = "quarry_commit_lock"
LOCK_SECONDS = 300.0  # a lock older than this belongs to a driver that died


class ConstraintError(ValueError):
    """Rows break a NOT NULL, UNIQUE or REFERENCES rule; nothing was published."""


class ConcurrentLoadError(RuntimeError):
    """Another load changed the same tables first; nothing was published."""


@dataclass(frozen=True)
class TableState:
    """What can be seen of a table: a version, ranges of its loads, and for
    buckets that an upsert rewrote the load that did so."""

    version: int
    loads: tuple[tuple[int, int], ...] = ((0, 0),)
    rows: int | None = None
    max_id: int | None = None
    since: tuple[tuple[int, int], ...] = ()

    def with_load(self, number: int) -> tuple[tuple[int, int], ...]:
        *head, (lo, hi) = self.loads
        return (*head, (lo, number)) if number == hi + 1 else (*self.loads, (number, number))

    def seen(self) -> Column:
        load = F.col(LOAD)
        cond = F.lit(False)
        for lo, hi in self.loads:
            cond = cond | ((load == lo) if lo == hi else load.between(lo, hi))
        for bucket, load_from in self.since:
            cond = cond & ((F.col(BUCKET) != bucket) | (load >= load_from))
        # never null; said so, no further predicate is inferred from it
        return F.coalesce(cond, F.lit(False))


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        database: str = "health_wh",
        partition_by: Mapping[str, Sequence[str]] | None = None,
        buckets: Mapping[str, tuple[Sequence[str], int]] | None = None,
    ):
        """``partition_by`` names directory-partition columns per table, e.g.
        ``{"fact_health_events": ["date_id"]}`` for a large fact: date
        filters and joins with a filtered date dimension then prune whole
        directories (dynamic partition pruning).  ``buckets`` names the key
        and the number of buckets of large dimensions, e.g.
        ``{"dim_location": (["iso_code"], 64)}``; numbers up to about 200 keep
        the property small.  Both are off by default, since they write one
        directory per value."""
        self.spark = spark
        self.db = database
        self.partition_by = {k: list(v) for k, v in (partition_by or {}).items()}
        self.buckets = {k: (list(key), n) for k, (key, n) in (buckets or {}).items()}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    # names -----------------------------------------------------------------

    def _physical(self, name: str, version: int) -> str:
        return f"{self.db}.{name}__v{version:06d}"

    def _versions(self, name: str) -> list[int]:
        out = []
        for t in self.spark.catalog.listTables(self.db):
            if t.name.startswith(f"{name}__v"):
                m = _VERSION.search(t.name)
                if m:
                    out.append(int(m.group(1)))
        return sorted(out)

    # the one property --------------------------------------------------------

    def _state(self) -> tuple[int, dict[str, TableState]]:
        """The next load number and the state of every table."""
        told = self.spark.sql(f"DESCRIBE DATABASE EXTENDED {self.db}").collect()
        text = " ".join(r[1] or "" for r in told if r[0] == "Properties")
        m = re.search(rf"{re.escape(_STATE)},([^)]*)\)", text)
        if not m:
            return 1, {}
        state = json.loads(m.group(1))
        pairs = lambda x: tuple((a, b) for a, b in x)
        return state["next"], {k: TableState(v, pairs(loads), n, top, pairs(since)) for k, (v, loads, n, top, since) in state["tables"].items()}

    def _set_state(self, following: int, tables: Mapping[str, TableState]) -> None:
        rows = {k: [s.version, s.loads, s.rows, s.max_id, s.since] for k, s in sorted(tables.items())}
        text = json.dumps({"next": following, "tables": rows}, separators=(",", ":"))
        self.spark.sql(f"ALTER DATABASE {self.db} SET DBPROPERTIES ('{_STATE}' = '{text}')")

    @contextmanager
    def _locked(self, wait_seconds: float = 2 * LOCK_SECONDS) -> Iterator[None]:
        lock, began = f"{self.db}.{LOCK}", time.time()
        while True:
            try:
                self.spark.sql(f"CREATE TABLE {lock} (x INT) USING parquet TBLPROPERTIES ('quarry.taken' = '{time.time()}')")
                break
            except AnalysisException as refused:
                if refused.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                    raise
            if time.time() - self._lock_taken(lock) > LOCK_SECONDS:
                self.spark.sql(f"DROP TABLE IF EXISTS {lock}")
            elif time.time() - began > wait_seconds:
                raise ConcurrentLoadError(f"{lock} was not released")
            else:
                time.sleep(0.1)
        try:
            yield
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {lock}")

    def _lock_taken(self, lock: str) -> float:
        try:
            rows = self.spark.sql(f"SHOW TBLPROPERTIES {lock}").collect()
        except AnalysisException:  # released meanwhile
            return time.time()
        return next((float(r[1]) for r in rows if r[0] == "quarry.taken"), time.time())

    def _commit(self, changes: Mapping[str, TableState], base: Mapping[str, TableState] | None = None) -> None:
        """Set the new states of some tables at once; with ``base`` only if
        none of them changed since."""
        with self._locked():
            following, tables = self._state()
            moved = [k for k in changes if base is not None and tables.get(k) != base.get(k)]
            if moved:
                raise ConcurrentLoadError(f"changed by another load: {', '.join(sorted(moved))}")
            self._set_state(following, tables | dict(changes))
        for name, state in changes.items():
            columns = ", ".join(f"`{c}`" for c in self._columns(name, state.version))
            where = " OR ".join(f"{LOAD} BETWEEN {lo} AND {hi}" for lo, hi in state.loads)
            kept = "".join(f" AND ({BUCKET} <> {b} OR {LOAD} >= {n})" for b, n in state.since)
            table = self._physical(name, state.version)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.db}.{name} AS SELECT {columns} FROM {table} WHERE ({where}){kept}")

    # reads -----------------------------------------------------------------

    def _columns(self, name: str, version: int) -> list[str]:
        return [c for c in self.spark.table(self._physical(name, version)).columns if c not in (LOAD, BUCKET)]

    def exists(self, name: str) -> bool:
        return name in self._state()[1]

    def current_version(self, name: str) -> int | None:
        """The published version of a table."""
        state = self._state()[1].get(name)
        return state.version if state else None

    def _seen(self, name: str, state: TableState, also: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        df = self.spark.table(self._physical(name, state.version))
        df = df.where(state.seen() if also is None else state.seen() | (F.col(LOAD) == also))
        if buckets is not None:
            df = df.where(F.col(BUCKET).isin(*buckets))
        return df.drop(LOAD, BUCKET)

    def _of(self, name: str, tables: Mapping[str, TableState] | None = None) -> TableState:
        state = (self._state()[1] if tables is None else tables).get(name)
        if state is None:
            raise KeyError(f"table {name} does not exist; create() it first")
        return state

    def table(self, name: str) -> DataFrame:
        """The rows of a table that can be seen."""
        return self._seen(name, self._of(name))

    def count(self, name: str) -> int:
        """Post-load row count, from the files."""
        return self.table(name).count()

    def stat(self, name: str, key: str) -> int | None:
        """A number kept with the current state (``rows``, ``max_id``)."""
        return getattr(self._of(name), key)

    def check_counts(self) -> dict[str, tuple[int, int]]:
        """Tables whose files hold another number of rows than their
        loads recorded, as (recorded, found); empty if all is well."""
        told = {k: (s.rows, self._seen(k, s).count()) for k, s in self._state()[1].items() if s.rows is not None}
        return {k: v for k, v in told.items() if v[0] != v[1]}

    # writes ----------------------------------------------------------------

    def _create_physical(self, name: str, version: int, schema: T.StructType) -> str:
        lengths = COLUMN_TYPES.get(name, {})
        columns = [f"`{f.name}` {lengths.get(f.name, f.dataType.simpleString())}" for f in schema]
        parts = [LOAD, *([BUCKET] if name in self.buckets else []), *self.partition_by.get(name, [])]
        columns += [f"{c} BIGINT" if c == LOAD else f"{c} INT" for c in parts if c in (LOAD, BUCKET)]
        table = self._physical(name, version)
        self.spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet PARTITIONED BY ({', '.join(parts)})")
        return table

    def _bucket(self, name: str) -> Column:
        key, n = self.buckets[name]
        return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")

    def _insert(self, name: str, table: str, df: DataFrame, load: int = 0) -> None:
        """Insert into a load's partition, by the table's column order
        (partition columns last).  Rows of a table that is partitioned further
        are clustered by that partition first, with large partitions split, so
        a task does not open a file for each.  A streaming batch comes from a
        session of its own, so this session's view of the files is renewed."""
        by = [*([BUCKET] if name in self.buckets else []), *self.partition_by.get(name, [])]
        if name in self.buckets:
            df = df.withColumn(BUCKET, self._bucket(name))
        if by:
            df = df.hint("rebalance", *by)
        columns = ", ".join(f"`{c}`" for c in self.spark.table(table).columns if c != LOAD)
        batch = f"quarry_batch_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(batch)
        try:
            spec = ", ".join([f"{LOAD} = {load}", *by])
            df.sparkSession.sql(f"INSERT INTO {table} PARTITION ({spec}) SELECT {columns} FROM {batch}")
        finally:
            df.sparkSession.catalog.dropTempView(batch)
        self.spark.catalog.refreshTable(table)

    def _write_version(self, name: str, df: DataFrame) -> int:
        version = max(self._versions(name), default=0) + 1
        table = self._create_physical(name, version, df.schema)
        try:
            self._insert(name, table, df)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            raise
        return version

    def _write_checked(self, name: str, df: DataFrame) -> int:
        version = self._write_version(name, df)
        try:
            self._check(name, self.version_table(name, version))
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._physical(name, version)}")
            raise
        return version

    def _check(self, name: str, df: DataFrame) -> None:
        not_null = [c for c in NOT_NULL.get(name, []) if c in df.columns]
        unique = [[c] for c in UNIQUE.get(name, []) if c in df.columns]
        if not not_null and not unique:
            return
        broken = constraint_checks(df, not_null=not_null, unique=unique, prefix=f"{name}_").where("violations > 0").collect()
        if broken:
            raise ConstraintError("; ".join(f"{r['check_name']}: {r['violations']}" for r in broken))

    def _move(self, versions: Mapping[str, int], base: Mapping[str, TableState] | None = None) -> None:
        self._commit({name: TableState(version) for name, version in versions.items()}, base)

    def write_unpublished(self, name: str, df: DataFrame) -> int:
        """Write ``df`` as the next version of ``name`` without publishing
        it: readers keep seeing the current version until ``publish_version``
        (or never, after ``drop_version``)."""
        return self._write_version(name, df)

    def version_table(self, name: str, version: int) -> DataFrame:
        """The rows a version was written with."""
        return self._seen(name, TableState(version))

    def publish_version(self, name: str, version: int) -> None:
        self._move({name: version})

    def drop_version(self, name: str, version: int) -> None:
        if version == self.current_version(name):
            raise ValueError(f"version {version} of {name} is published")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._physical(name, version)}")

    def publish(self, frames: Mapping[str, DataFrame]) -> dict[str, int]:
        """Replace several tables together (L1 replace-load, L11
        all-or-nothing): all new versions are written and checked before any
        of them becomes visible, all at once."""
        base = self._state()[1]
        # independent tables: submitted from threads, they run as concurrent jobs
        with ThreadPoolExecutor(max_workers=min(8, max(1, len(frames)))) as pool:
            jobs = {name: pool.submit(self._write_checked, name, df) for name, df in frames.items()}
        written = {name: job.result() for name, job in jobs.items() if not job.exception()}
        failed = [job.exception() for job in jobs.values() if job.exception()]
        try:
            if failed:
                raise failed[0]
            self._move(written, base)
        except Exception:
            for name, version in written.items():
                self.spark.sql(f"DROP TABLE IF EXISTS {self._physical(name, version)}")
            raise
        return written

    def replace(self, name: str, df: DataFrame) -> int:
        return self.publish({name: df})[name]

    def begin(self) -> Load:
        """Reserve a load number; nobody else ever gets the same."""
        with self._locked():
            number, tables = self._state()
            self._set_state(number + 1, tables)
        return Load(self, number, tables)

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows to one table.  Columns are matched by name."""
        with self.begin() as load:
            load.append(name, df)

    def create(self, schemas: Mapping[str, T.StructType] = WAREHOUSE_TABLES) -> None:
        """Create every missing table, empty, from its fixed schema."""
        known = self._state()[1]
        empty = {name: self.spark.createDataFrame([], schema) for name, schema in schemas.items() if name not in known}
        if empty:
            self.publish(empty)

    def seed(self, frames: Mapping[str, DataFrame]) -> None:
        """Load seed rows (replacing current contents)."""
        self.publish(frames)

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Drop physical versions older than the newest ``keep``, and in the
        current one the loads that were never committed before its last."""
        state = self._of(name)
        old = [v for v in self._versions(name)[:-keep] if v != state.version]
        for v in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._physical(name, v)}")
        table = self._physical(name, state.version)
        there = {int(re.match(rf"{LOAD}=(\d+)", r[0]).group(1)) for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for n in sorted(n for n in there if n < state.loads[-1][1] and not any(lo <= n <= hi for lo, hi in state.loads)):
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = {n})")
        return old


class Load:
    """Rows for several tables that become visible together, or not at all.

    As a context manager it commits at the end and aborts on an error.  What a
    lost driver leaves behind is the same as an aborted load, but for its
    files, which ``vacuum`` removes."""

    def __init__(self, warehouse: Warehouse, number: int, base: Mapping[str, TableState]):
        self.warehouse, self.number, self.base = warehouse, number, base
        self.changes: dict[str, TableState] = {}

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
        else:
            self.abort()

    def mark(self, name: str, id_col: str) -> int:
        """The highest id that can be seen (kept with the table, found by a
        scan where something else than a load wrote it)."""
        state = self.warehouse._of(name, self.base)
        return max_id(self.warehouse._seen(name, state), id_col) if state.max_id is None else state.max_id

    def table(self, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """What the table held when the load began, and what it has added."""
        state = self.changes.get(name) or self.warehouse._of(name, self.base)
        return self.warehouse._seen(name, state, buckets=buckets)

    def rows(self, name: str) -> DataFrame:
        """What this load has written to a table."""
        return self.warehouse._seen(name, TableState(self.warehouse._of(name, self.base).version, ((self.number, self.number),)))

    def append(self, name: str, df: DataFrame, id_col: str | None = None) -> int:
        """Write rows, unseen until the commit; returns how many the files
        hold.  ``id_col`` names the column whose mark is kept."""
        wh, state = self.warehouse, self.warehouse._of(name, self.base)
        if name in self.changes:
            raise ValueError(f"load {self.number} has already written {name}")
        wh._insert(name, wh._physical(name, state.version), df, self.number)
        own = self.rows(name)
        wh._check(name, own)
        n, top = own.agg(F.count(F.lit(1)), F.max(id_col) if id_col else F.lit(None).cast("bigint")).first()
        before = wh._seen(name, state).count() if state.rows is None else state.rows
        mark = max(self.mark(name, id_col), top or 0) if id_col else state.max_id
        self.changes[name] = replace(state, loads=state.with_load(self.number), rows=before + n, max_id=mark)
        return n

    def _touched(self, name: str, incoming: DataFrame) -> list[int] | None:
        """Buckets that keys of ``incoming`` fall into (at most the number of
        buckets), or None for a table without."""
        if name not in self.warehouse.buckets:
            return None
        return [r[0] for r in incoming.select(self.warehouse._bucket(name).alias("b")).distinct().collect()]

    def insert_new(self, name: str, incoming: DataFrame, keys: Sequence[str], id_col: str) -> int:
        """L2/L3: append the rows whose key is unknown; returns how many.
        Known rows are neither rewritten nor shuffled, and of a table with
        buckets only those are read that a key falls into."""
        touched = self._touched(name, incoming)
        added = new_rows(self.table(name, touched), incoming, keys, id_col, start_after=self.mark(name, id_col))
        return self.append(name, added, id_col)

    def upsert(self, name: str, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str], id_col: str) -> int:
        """``ON CONFLICT (keys) DO UPDATE SET update_cols``, written as new
        contents of the buckets that the batch falls into; returns the number
        of rows written.  The rows of all other buckets stay where they are."""
        wh, state = self.warehouse, self.warehouse._of(name, self.base)
        batch = materialize(incoming, "upsert")
        touched = self._touched(name, batch)
        old = self.table(name, touched)
        mark = self.mark(name, id_col)
        replaced = old.count()
        total = wh._seen(name, state).count() if state.rows is None else state.rows
        n = self.append(name, upsert(old, batch, keys, update_cols, id_col, start_after=mark), id_col)
        discard(batch)
        if touched is None:
            seen = {"loads": ((self.number, self.number),)}
        else:
            seen = {"since": tuple(sorted((dict(state.since) | {b: self.number for b in touched}).items()))}
        self.changes[name] = replace(self.changes[name], rows=total - replaced + n, **seen)
        return n

    def commit(self) -> None:
        if self.changes:
            try:
                self.warehouse._commit(self.changes, self.base)
            except Exception:
                self.abort()
                raise

    def abort(self) -> None:
        """Remove what the load has written."""
        for name, state in self.base.items():
            table = self.warehouse._physical(name, state.version)
            self.warehouse.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = {self.number})")
        self.changes = {}
