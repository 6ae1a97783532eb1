"""Mart tables on a shared file system, written so that a retried batch changes nothing.

Layout below ``<root>/<table>/``::

    state/version=<v>/     the whole current state as of v
    changes/version=<v>/   one row per key changed by batch v
    merged/version=<v>/    all changes after the last state up to v, one row per key
    history/recorded_on=<day>/batch_id=<v>/  every event of batch v
    history_days/recorded_on=<day>/          the same of a whole day that is over
    rejected/batch_id=<v>/ events of batch v without a key
    generations/<g>/       marks the start of replay number g
    settings/<name>        conflict rule, delete mode and encoding, fixed by the first writer
    claims/                versions that a repair or a fold is working on

A batch writes only its own rows, so its cost does not grow with the table. The current state is
the newest ``state``, the newest ``merged`` after it and the ``changes`` after that, folded.
Three jobs beside the streams keep that short: :meth:`MartTable.merge` folds the pending changes among
themselves, :meth:`MartTable.rewrite` folds them into a new state, and :meth:`MartTable.vacuum` removes
what no reader of the last day can still use. Only folders with a ``_SUCCESS`` file count, and a batch
that runs again overwrites its own folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.operators import history, upsert
from cdcmart.operators.contracts import schema_differences
from cdcmart.session import prepare
from cdcmart.sinks import files
from cdcmart.sinks.external import Outside
from cdcmart.specs import PARTITION, SPECS, TOPIC, TableSpec, resolve

# Version numbers order all writes to a table: generation, then batch, then repairs after it.
_PER_GENERATION = 10**12
_PER_BATCH = 1000

_FULL = "state"
_MERGED = "merged"
_DELTA = "changes"

# Partition columns of the history.
_HISTORY_FOLDERS = (T.StructField("recorded_on", T.DateType()), T.StructField("batch_id", T.LongType()))

# Claims older than this belong to a job that died; files superseded for less may still be read.
_CLAIM_SECONDS = 24 * 3600
RETENTION = dt.timedelta(days=1)


def version_of(generation: int, batch_id: int) -> int:
    """Version of a stream batch; leaves room for 999 repairs before the next batch."""
    return generation * _PER_GENERATION + (batch_id + 1) * _PER_BATCH


class MartTable:
    """One current-state table with its history."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, on_conflict: str | None = None):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self._asked = on_conflict

    # -- settings -------------------------------------------------------------------------

    def setting(self, name: str) -> str | None:
        """A stored setting; None if no writer fixed it yet."""
        return files.read_text(self.spark, f"{self.path}/settings/{name}")

    def settle(self, **wanted: str | None) -> None:
        """Store settings with the table, or fail where a stored one differs. None asks for nothing."""
        for name, value in wanted.items():
            if value is None or files.create_new(self.spark, f"{self.path}/settings/{name}", value):
                continue
            stored = self.setting(name)
            if stored != value:
                raise ValueError(f"{self.spec.name} is kept with {name}={stored}, not {value}")

    @property
    def on_conflict(self) -> str:
        """The stored conflict rule; folding by another one would give other rows."""
        stored = self.setting("on_conflict")
        if stored and self._asked and stored != self._asked:
            raise ValueError(f"{self.spec.name} is kept with on_conflict={stored}, not {self._asked}")
        return stored or self._asked or upsert.LAST_BATCH

    # -- versions -------------------------------------------------------------------------

    def versions(self, kind: str) -> list[int]:
        """Committed versions, oldest first."""
        base = f"{self.path}/{kind}"
        names = files.subfolders(self.spark, base)
        return sorted(
            int(n.split("=")[1])
            for n in names
            if n.startswith("version=") and files.exists(self.spark, f"{base}/{n}/_SUCCESS")
        )

    def latest_version(self) -> int:
        """The newest version of any kind; -1 for a new table."""
        kinds = (_FULL, _MERGED, _DELTA)
        return max([-1, *(v for kind in kinds for v in self.versions(kind)[-1:])])

    def repair_version(self) -> int:
        """The next free version before the next stream batch, claimed ones left out."""
        latest = max(self.latest_version(), self.generation() * _PER_GENERATION, *self._claimed(), -1)
        if latest % _PER_BATCH == _PER_BATCH - 1:
            raise RuntimeError("no repair version left before the next batch; run a batch first")
        return latest + 1

    def claim(self) -> int:
        """Reserve a version for a repair. Folds stop below it until it is committed or released."""
        while True:
            version = self.repair_version()
            if not files.create_new(self.spark, f"{self.path}/claims/version={version}", ""):
                continue
            if not self.superseded(version):
                return version
            self.release(version)

    def release(self, version: int) -> None:
        files.remove_folder(self.spark, f"{self.path}/claims/version={version}")

    def superseded(self, version: int) -> bool:
        """Whether a fold was committed that readers start from without looking at ``version``."""
        return any(v >= version for kind in (_FULL, _MERGED) for v in self.versions(kind))

    def _claimed(self) -> list[int]:
        """Versions a living job has reserved."""
        base = f"{self.path}/claims"
        return [
            int(n.split("=")[1])
            for n in files.names(self.spark, base)
            if n.startswith("version=") and self._fresh(f"{base}/{n}")
        ]

    # -- what was synced ------------------------------------------------------------------

    def synced_to(self, other: str) -> int:
        """The version of another table up to which its values are stored here; -1 for none."""
        done = [int(n) for n in files.names(self.spark, f"{self.path}/synced/{other}")]
        return max(done, default=-1)

    def mark_synced(self, other: str, version: int) -> None:
        files.create_new(self.spark, f"{self.path}/synced/{other}/{version}", "")

    def changed_since(self, version: int, up_to: int) -> DataFrame | None:
        """Rows changed after ``version``; None where a state or a merge has folded some of them away."""
        if version < 0 or any(version < v <= up_to for v in (*self.versions(_FULL), *self.versions(_MERGED))):
            return None
        later = [v for v in self.versions(_DELTA) if version < v <= up_to]
        return self._scan(_DELTA, later).drop("_version") if later else self._empty(self.spec.mart_schema)

    def _fresh(self, path: str) -> bool:
        return files.exists(self.spark, path) and files.age(self.spark, path) < _CLAIM_SECONDS

    def generation(self) -> int:
        """How often the log was replayed into this table."""
        return max((int(n) for n in files.subfolders(self.spark, f"{self.path}/generations")), default=0)

    def start_generation(self) -> int:
        """Begin a replay: later batches get versions above all earlier ones."""
        nxt = self.generation() + 1
        files.make_folder(self.spark, f"{self.path}/generations/{nxt}")
        return nxt

    # -- reading --------------------------------------------------------------------------

    def exists(self) -> bool:
        return self.latest_version() >= 0

    def read(
        self,
        up_to: int | None = None,
        keys: DataFrame | None = None,
        bounds: tuple | None = None,
    ) -> DataFrame:
        """The current state, or the state after version ``up_to``.

        ``keys`` limits it to the keys of that frame, before anything is folded. ``bounds`` are the
        smallest and largest of them; the files of a state hold ranges of keys, so the scan skips those
        that lie outside.
        """
        rule = self.on_conflict
        full, merged, deltas = self._parts(up_to if up_to is not None else self.latest_version())
        limits = (keys, bounds)
        state = self._scan(_FULL, full, *limits).drop("_version") if full else None
        folded = self._changes(merged, deltas, *limits)
        if folded is None:
            return state if state is not None else self._empty(self.spec.mart_schema)
        if state is None:
            return folded
        return upsert.merge_latest(state, folded, self.spec, rule)

    def _parts(self, limit: int) -> tuple[list[int], list[int], list[int]]:
        """Versions a read at ``limit`` is made of: at most one state and one merge, and changes."""
        full = [v for v in self.versions(_FULL) if v <= limit][-1:]
        start = full[0] if full else -1
        merged = [v for v in self.versions(_MERGED) if start < v <= limit][-1:]
        start = merged[0] if merged else start
        return full, merged, [v for v in self.versions(_DELTA) if start < v <= limit]

    def _changes(self, merged: list[int], deltas: list[int], *limits) -> DataFrame | None:
        """Changes since the state, one row per key; None without any."""
        scans = [
            self._scan(kind, versions, *limits)
            for kind, versions in ((_MERGED, merged), (_DELTA, deltas))
            if versions
        ]
        if not scans:
            return None
        if len(merged) + len(deltas) == 1:
            folded = scans[0]
        else:
            every = scans[0].unionByName(scans[1]) if len(scans) == 2 else scans[0]
            folded = upsert.fold_batches(every, self.spec, "_version", self.on_conflict)
        return folded.select(*self.spec.columns)

    def _scan(
        self,
        kind: str,
        versions: list[int],
        keys: DataFrame | None = None,
        bounds: tuple | None = None,
    ) -> DataFrame:
        base = f"{self.path}/{kind}"
        schema = T.StructType(list(self.spec.mart_schema) + [T.StructField("version", T.LongType())])
        rows = (
            self.spark.read.schema(schema)
            .option("basePath", base)
            .parquet(*[f"{base}/version={v}" for v in versions])
            .withColumnRenamed("version", "_version")
        )
        if bounds is not None:
            rows = rows.where(F.col(self.spec.key[0]).between(*bounds))
        if keys is None:
            return rows
        wanted = keys.select(*self.spec.key).distinct()
        return rows.join(wanted, list(self.spec.key), "left_semi")

    def read_history(self, distinct: bool = False) -> DataFrame:
        """All history rows, with the batch that wrote them.

        ``distinct`` keeps one row per event where the log was replayed into a kept history.
        """
        schema = self._history_schema()
        path = f"{self.path}/history"
        merged = self._merged_days()
        done = [
            f"{path}/{day}/{batch}"
            for day in self._history_days()
            if day not in merged
            for batch in files.subfolders(self.spark, f"{path}/{day}")
            if files.exists(self.spark, f"{path}/{day}/{batch}/_SUCCESS")
        ]
        parts = [(path, done)] if done else []
        if merged:
            days = f"{self.path}/history_days"
            parts.append((days, [f"{days}/{day}" for day in merged]))
        if not parts:
            return self._empty(schema)
        frames = [
            self.spark.read.schema(schema).option("basePath", base).parquet(*paths) for base, paths in parts
        ]
        rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        return history.distinct_events(rows) if distinct else rows

    def _history_schema(self) -> T.StructType:
        return T.StructType(
            list(self.spec.history_schema)
            + [
                T.StructField(TOPIC, T.StringType()),
                T.StructField(PARTITION, T.IntegerType()),
                *_HISTORY_FOLDERS,
            ]
        )

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    # -- writing --------------------------------------------------------------------------

    def commit_changes(self, latest: DataFrame, version: int) -> None:
        """Write one batch: one row per changed key, defaults applied."""
        self._write(latest, f"{self.path}/{_DELTA}/version={version}")

    def commit_state(self, state: DataFrame, version: int) -> None:
        """Write a whole state. It may be computed from older versions, never from this one.

        Each file holds one range of keys, and a bloom filter of them for keys that lie far apart.
        """
        ranges = state.select(*self.spec.columns).repartitionByRange(*self.spec.key)
        options = {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.spec.key}
        self._write(ranges, f"{self.path}/{_FULL}/version={version}", options)

    def _write(self, rows: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
        ordered = rows.select(*self.spec.columns).sortWithinPartitions(*self.spec.key)
        ordered.write.mode("overwrite").options(**(options or {})).parquet(path)

    def append_history(
        self, changes: DataFrame, version: int, recorded_at: dt.datetime | None = None
    ) -> None:
        """Write every event of a batch to the batch's own history folder.

        The folder is filed by day. A batch that runs again after midnight goes back to the folder
        of its first run, which can only be below the newest day. Where that day is merged by now it holds the
        batch whole, since a day is not merged while a batch of it is unfinished.
        """
        when = recorded_at or dt.datetime.now(dt.timezone.utc)
        folder, own = f"{self.path}/history", f"batch_id={version}"
        day = f"recorded_on={when.date().isoformat()}"
        merged = self._merged_days()
        newest = max([*self._history_days(), *merged], default=day)
        if newest in merged:
            stored = self.spark.read.parquet(f"{self.path}/history_days/{newest}").where(F.col("batch_id") == version)
            if not stored.isEmpty():
                return
        elif files.exists(self.spark, f"{folder}/{newest}/{own}"):
            day = newest
        rows = history.entries(changes, self.spec, when.date(), when)
        rows.write.mode("overwrite").parquet(f"{folder}/{day}/{own}")

    def _history_days(self) -> list[str]:
        names = files.subfolders(self.spark, f"{self.path}/history")
        return [n for n in names if n.startswith("recorded_on=")]

    def _merged_days(self) -> list[str]:
        base = f"{self.path}/history_days"
        return [
            day for day in files.subfolders(self.spark, base) if files.exists(self.spark, f"{base}/{day}/_SUCCESS")
        ]

    def merge_history(self, before: dt.date | None = None) -> list[str]:
        """Rewrite each day before ``before`` (by default yesterday) from a folder per batch into one; returns the days.

        A day with an unfinished batch is left alone: the batch will run again and write there. Rows, ids and batch
        numbers stay; the batches' folders go with a later :meth:`vacuum`.
        """
        limit = before or dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
        known, done = self._merged_days(), []
        for day in sorted(self._history_days()):
            if day in known or day.split("=")[1] >= limit.isoformat() or self._unfinished(day):
                continue
            batches = files.subfolders(self.spark, f"{self.path}/history/{day}")
            rows = self.read_history().where(F.col("recorded_on") == day.split("=")[1]).drop("recorded_on")
            rows.write.mode("overwrite").parquet(f"{self.path}/history_days/{day}")
            if files.subfolders(self.spark, f"{self.path}/history/{day}") != batches:
                # A batch came back to the day meanwhile: it is not in what was written.
                files.remove_folder(self.spark, f"{self.path}/history_days/{day}")
                continue
            done.append(day)
        return done

    def _unfinished(self, day: str) -> bool:
        """Whether a batch of the day has begun to write its events and not ended."""
        path = f"{self.path}/history/{day}"
        return any(not files.exists(self.spark, f"{path}/{b}/_SUCCESS") for b in files.subfolders(self.spark, path))

    def append_rejected(self, changes: DataFrame, version: int) -> None:
        changes.write.mode("overwrite").parquet(f"{self.path}/rejected/batch_id={version}")

    def settled_version(self) -> int:
        """The newest committed version that no claimed one comes before."""
        limit = min([v - 1 for v in self._claimed() if v not in self.versions(_DELTA)], default=None)
        kinds = (_FULL, _MERGED, _DELTA)
        found = [v for kind in kinds for v in self.versions(kind) if limit is None or v <= limit]
        return max(found, default=-1)

    def _alone(self, version: int, work: Callable[[], None]) -> int | None:
        """Run a fold unless another one of the same version is at work; returns the version written."""
        mark = f"{self.path}/claims/fold={version}"
        if not files.create_new(self.spark, mark, ""):
            if self._fresh(mark):
                return None
            files.remove_folder(self.spark, mark)
            if not files.create_new(self.spark, mark, ""):
                return None
        try:
            work()
        finally:
            files.remove_folder(self.spark, mark)
        return version

    def merge(self) -> int | None:
        """Fold pending changes among themselves, so that readers open fewer files. The state is not touched.

        Returns the version written, or None when there is nothing to fold. For between two rewrites.
        """
        latest = self.settled_version()
        _, merged, deltas = self._parts(latest)
        if not deltas or len(merged) + len(deltas) == 1:
            return None
        path = f"{self.path}/{_MERGED}/version={latest}"
        return self._alone(latest, lambda: self._write(self._changes(merged, deltas), path))

    def rewrite(self, transform: Callable[[DataFrame], DataFrame] | None = None) -> int | None:
        """Fold pending changes into a new state, with ``transform`` applied to it.

        Returns the version written, or None when nothing was pending. Older files stay for their
        readers until :meth:`vacuum`.
        """
        latest = self.settled_version()
        _, merged, deltas = self._parts(latest)
        if not deltas and not merged:
            return None

        def work() -> None:
            state = self.read(latest)
            self.commit_state(transform(state) if transform else state, latest)

        return self._alone(latest, work)

    def vacuum(self, older_than: dt.timedelta = RETENTION) -> list[str]:
        """Remove versions that a fold replaced at least ``older_than`` ago; returns their folders.

        A reader planned before that fold has had that long to end.
        """
        removed = []

        def settled(kind: str) -> int:
            """The newest fold that is old enough; readers since then do not look below it."""
            done = [
                v
                for v in self.versions(kind)
                if files.age(self.spark, f"{self.path}/{kind}/version={v}/_SUCCESS") >= older_than.total_seconds()
            ]
            return max(done, default=-1)

        state, merge = settled(_FULL), settled(_MERGED)
        for kind, last in ((_FULL, state - 1), (_MERGED, max(state, merge - 1)), (_DELTA, max(state, merge))):
            for v in self.versions(kind):
                if v <= last:
                    removed.append(f"{kind}/version={v}")
                    files.remove_folder(self.spark, f"{self.path}/{kind}/version={v}")
        batches = self._history_days()
        for day in self._merged_days():
            mark = f"{self.path}/history_days/{day}/_SUCCESS"
            if day in batches and files.age(self.spark, mark) >= older_than.total_seconds():
                removed.append(f"history/{day}")
                files.remove_folder(self.spark, f"{self.path}/history/{day}")
        return removed

    def reset(self, with_history: bool = True) -> int:
        """Empty the table by committing an empty state, and clear its history."""
        version = self.claim()
        try:
            self.commit_state(self._empty(self.spec.mart_schema), version)
        finally:
            self.release(version)
        if with_history:
            files.remove_folder(self.spark, f"{self.path}/history")
            files.remove_folder(self.spark, f"{self.path}/history_days")
        return version


class Mart:
    """The mart's tables below one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: dict[str, TableSpec] | None = None,
        on_conflict: str | None = None,
        outside: Mapping[str, Outside] | None = None,
    ):
        """``outside`` names tables whose current state is kept elsewhere; their histories are kept here all the same."""
        prepare(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = dict(specs or SPECS)
        self.on_conflict = on_conflict
        self.outside = dict(outside or {})

    def table(self, name: str) -> MartTable:
        spec = self.specs.get(name) or resolve(name)
        return MartTable(self.spark, self.root, self.specs.get(spec.name, spec), self.on_conflict)

    def read(self, name: str, stored_status: bool = False) -> DataFrame:
        """Current state of a table; order items come with the status of their order as of now.

        ``stored_status`` takes the status that the items' own table holds, without a join with the orders:
        that of the last ``repair.sync_status``.
        """
        spec = self.table(name).spec
        state = self.current(spec.name)
        if "order_status" in spec.derived and not stored_status:
            state = upsert.sync_from(state, self.current("fact_orders"))
        return state

    def current(
        self, name: str, keys: DataFrame | None = None, bounds: tuple | None = None, up_to: int | None = None
    ) -> DataFrame:
        """The stored current state of a table, wherever it is kept; for ``keys``, ``bounds`` and ``up_to`` see
        :meth:`MartTable.read`. Tables kept outside have no versions, so ``up_to`` is not for them."""
        if name not in self.outside:
            return self.table(name).read(up_to, keys, bounds)
        spec = self.table(name).spec
        rows = self.outside[name].read().select(*spec.columns)
        if bounds is not None:
            rows = rows.where(F.col(spec.key[0]).between(*bounds))
        return rows if keys is None else rows.join(keys.select(*spec.key).distinct(), list(spec.key), "left_semi")

    def commit(self, name: str, latest: DataFrame, version: int) -> None:
        """Upsert one row per changed key, defaults applied, wherever the table is kept."""
        if name in self.outside:
            self.outside[name].write(latest)
        else:
            self.table(name).commit_changes(latest, version)

    def checkpoint(self, name: str) -> str:
        """Checkpoint folder of a table's stream; a replay starts a new one."""
        table = self.table(name)
        return f"{self.root}/checkpoints/{table.spec.source}/generation={table.generation()}"

    def create(self, **settings: str | None) -> None:
        """Commit an empty state for every table that has none, and settle its settings."""
        for name in self.specs:
            table = self.table(name)
            table.settle(on_conflict=self.on_conflict, **settings)
            if name not in self.outside and not table.exists():
                table.commit_state(table._empty(table.spec.mart_schema), 0)

    def problems(self) -> list[str]:
        """Missing tables and columns that differ from the specs, histories included."""
        found = []
        for name, spec in self.specs.items():
            table = self.table(name)
            if name not in self.outside and not table.exists():
                found.append(f"{name}: missing")
                continue
            stored = self._stored(name)
            if stored is None:
                found.append(f"{name}: missing outside")
                continue
            found += [f"{name}: {p}" for p in schema_differences(stored, spec.mart_schema)]
            days = table._history_days()
            if spec.history and days:
                stored = self.spark.read.parquet(f"{table.path}/history/{max(days)}")
                inner = [f for f in table._history_schema() if f not in _HISTORY_FOLDERS]
                problems = schema_differences(stored.drop("batch_id"), T.StructType(inner))
                found += [f"{name} history: {p}" for p in problems]
        return found

    def _stored(self, name: str) -> DataFrame | None:
        """A table's rows with the columns they are stored with; None where one kept outside cannot be read."""
        if name in self.outside:
            try:
                return self.outside[name].read()
            except AnalysisException:
                return None
        table = self.table(name)
        kind = _FULL if table.versions(_FULL) else _DELTA
        return self.spark.read.parquet(f"{table.path}/{kind}/version={table.versions(kind)[-1]}")

    def validate(self) -> None:
        """Fail before any stream starts when a table is missing or has the wrong columns."""
        found = self.problems()
        if found:
            raise RuntimeError("mart validation failed: " + "; ".join(found))
