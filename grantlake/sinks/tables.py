"""The tables jobs write: keyed state, append-only history, and small ledgers.

A table is plain Parquet below its folder. Each load writes its own files and then one row into ``loads``, itself a
Parquet table, so a load is seen as a whole or not at all, and a replayed batch finds its row. One writer at a time
writes a table, as a job does.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.entities import AUDIT, ENTITIES, SCOPE, Entity
from grantlake.operators.snapshot import remove_stale
from grantlake.operators.state import (
    TIME,
    apply_changes,
    as_stored,
    is_removal,
    key_columns,
    matches_key,
    newest_per_key,
    split_changes,
    surviving,
)
from grantlake.session import remove_path


def read_or_empty(spark: SparkSession, schema: T.StructType | str, *paths: str, base: str | None = None) -> DataFrame:
    """The Parquet files below ``paths``; no rows where there is nothing yet."""
    try:
        reader = spark.read.schema(schema)
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Load:
    """A row of ``loads``: what a load wrote, and the batch it came from (-1: none)."""

    number: int
    kind: str
    folder: str
    source: str = ""
    batch: int = -1
    parts: int = 0


_LOADS = "number long, kind string, folder string, source string, batch long, parts int"


class Loads:
    """The loads of a table that count, oldest first.

    Rewriting starts a new generation with fewer rows; readers take the newest.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, f"{root}/loads"

    def all(self) -> list[tuple[int, Load]]:
        """Every row with its generation; a writer reads them once for all it does."""
        rows = read_or_empty(self.spark, f"{_LOADS}, generation int", self.path).collect()
        return sorted(((r["generation"], Load(*r[:-1])) for r in rows), key=lambda x: (x[0], x[1].number, x[1].folder))

    def read(self) -> list[Load]:
        return _newest(self.all())

    def add(self, load: Load, rows: list[tuple[int, Load]] | None = None) -> None:
        """Publish a load; ``rows`` are what the writer has read."""
        rows = self.all() if rows is None else rows
        self._write([load], max((generation for generation, _ in rows), default=0), "append")

    def rewrite(self, loads: Iterable[Load], rows: list[tuple[int, Load]] | None = None) -> list[Load]:
        """Replace all rows by ``loads`` (at least one); the generation before stays for readers that have begun.

        Returns the loads of older generations whose folders nothing refers to any more.
        """
        rows = self.all() if rows is None else rows
        new = max((generation for generation, _ in rows), default=0) + 1
        self._write(list(loads), new, "overwrite")
        used = {x.folder for generation, x in rows if generation == new - 1} | {x.folder for x in loads}
        for old in {generation for generation, _ in rows} - {new - 1}:
            remove_path(self.spark, f"{self.path}/generation={old}")
        return [x for generation, x in rows if generation < new - 1 and x.folder and x.folder not in used]

    def _write(self, loads: list[Load], generation: int, mode: str) -> None:
        # From Arrow the rows are part of the plan; from tuples a task would start Python workers for them.
        rows = self.spark.createDataFrame(pa.Table.from_pylist([vars(x) for x in loads]), _LOADS)
        rows.coalesce(1).write.mode(mode).parquet(f"{self.path}/generation={generation}")


def _newest(rows: list[tuple[int, Load]]) -> list[Load]:
    return [load for generation, load in rows if generation == rows[-1][0]]


def _next(loads: list[Load]) -> int:
    return max((x.number for x in loads), default=0) + 1


def _applied(loads: list[Load], source: str, batch: int | None) -> bool:
    return batch is not None and any(x.source == source and x.batch >= batch for x in loads)


def _batches(loads: list[Load]) -> dict[str, int]:
    """The last batch of each source."""
    return {x.source: max(y.batch for y in loads if y.source == x.source) for x in loads if x.batch >= 0}


def _folder(number: int) -> str:
    return f"load={number}/attempt=a{uuid.uuid4().hex[:8]}"


def _compacted(loads: list[Load]) -> Load | None:
    return next((x for x in loads if x.kind == "base"), None)


def _equals(rows: DataFrame, column: str, value: str | None) -> Column:
    """Key columns match empty to NULL."""
    return F.col(column) == value if value not in (None, "") else F.nullif(F.col(column), F.lit("")).isNull()


def _part(value: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.nullif(value, F.lit(""))), F.lit(parts)).cast("int")


#: Rows that one folder of a state table holds about; more rows give more folders at the next compaction.
PART_ROWS = 4_000_000
MOST_PARTS = 64
#: The columns by which the folders of compacted rows are told apart.
_TENANT, _PREFIX = "_tenant", "_prefix"
_GROUP_BITS = 32

_CHANGE = T.StructType().add("_route", "string").add("_group", T.IntegerType())
_STALE = T.StructType().add("scope_tenancy", "string").add("scope_service", "string").add("cutoff", "timestamp")
#: What the folder of a load says of its rows.
_PLACE = T.StructType().add("load", "long").add("attempt", "string")


class StateTable:
    """Current state of one entity: compacted rows, and the loads since.

    A load appends what it inserts, updates and deletes, reduced to one row per key and group, so it writes in proportion to
    itself and reads nothing of the state. Readers resolve: rows that no load since the compaction touches pass by; of the
    others and the loads' rows, ``apply_changes`` leaves the newest. ``compact`` writes what readers see as new rows.

    Compacted rows lie in folders by the hash of their tenant and by the hash of the first part of their key, both of
    which grow in number with the table, and are sorted by scope and key in their files. So a reader of one tenant or one key opens a fraction of the
    files, and of these the row groups whose smallest and largest values allow it. A folder with a large share of the
    rows (a tenant's are spread by their keys, a key's are not) is written by several tasks.
    """

    def __init__(self, spark: SparkSession, root: str, entity: Entity, part_rows: int = PART_ROWS) -> None:
        self.spark, self.entity, self.part_rows = spark, entity, part_rows
        self.path = f"{root.rstrip('/')}/{entity.name}_STATE"
        self.loads = Loads(spark, self.path)

    def create(self, recreate: bool = False) -> None:
        _create(self.spark, self.path, self.loads, recreate)

    def applied(self, source: str, batch_id: int) -> bool:
        return _applied(self.loads.read(), source, batch_id)

    # -- reading

    def read(self, **where: str) -> DataFrame:
        """The state; with ``where``, the rows with these values of key columns (scope included), read by themselves."""
        if strange := set(where) - set(self.entity.state_key):
            raise ValueError(f"no key column of {self.entity.name}: {', '.join(sorted(strange))}")
        return self._state(self.loads.read(), where)

    def _state(self, loads: list[Load], where: dict[str, str]) -> DataFrame:
        entity, columns, keys = self.entity, self.entity.column_names, list(self.entity.state_key)
        base = self._base(loads, where)
        changes, cutoffs = self._since(loads, "changes"), self._since(loads, "stale")
        if cutoffs is not None:
            base = remove_stale(base, cutoffs, TIME)
        if changes is None:
            return base.select(*columns)
        # Deletes may leave parts of the key empty; the scope they always have.
        for column, value in where.items():
            equal = _equals(changes, column, value)
            changes = changes.filter(equal if column in SCOPE else is_removal(entity) | equal)
        if cutoffs is not None:
            kept = remove_stale(changes.filter(~is_removal(entity)), cutoffs, TIME, "load")
            changes = kept.unionByName(changes.filter(is_removal(entity)))
        changes = changes.withColumns({"_step": F.shiftleft(F.col("load"), _GROUP_BITS) + F.col("_group"), "_seq": F.lit(0)})
        upserts, deletes = split_changes(changes, entity)
        touched = upserts.select(*key_columns(upserts, keys)).distinct()
        others = surviving(as_stored(base.join(touched, matches_key(base, keys), "left_anti"), upserts), deletes, entity)
        met = base.join(touched, matches_key(base, keys), "left_semi")
        return others.select(*columns).unionByName(apply_changes(met, changes, entity, dated=True))

    def _base(self, loads: list[Load], where: dict[str, str]) -> DataFrame:
        compacted = _compacted(loads)
        if compacted is None:
            return self.spark.createDataFrame([], self.entity.schema)
        schema = T.StructType([*self.entity.schema.fields, *(T.StructField(c, T.IntegerType()) for c in (_TENANT, _PREFIX))])
        rows = read_or_empty(self.spark, schema, f"{self.path}/base/{compacted.folder}")
        for column, value in where.items():
            rows = rows.filter(_equals(rows, column, value))
            for folder, source in self._folders():
                if source == column:
                    # Of a constant, so the folders are chosen before any file is opened.
                    rows = rows.filter(F.col(folder) == _part(F.lit(value).cast("string"), compacted.parts))
        return rows

    def _folders(self) -> list[tuple[str, str]]:
        return [(_TENANT, "tenancy_id"), (_PREFIX, self.entity.key[0])]

    def _since(self, loads: list[Load], kind: str) -> DataFrame | None:
        """What loads of a kind have written since the compaction, with ``load``, the number of each."""
        compacted = _compacted(loads)
        number = compacted.number if compacted else 0
        folders = [f"{self.path}/{kind}/{x.folder}" for x in loads if x.kind == kind and x.number > number]
        if not folders:
            return None
        schema = T.StructType([*(_STALE if kind == "stale" else [*self.entity.schema.fields, *_CHANGE]), *_PLACE])
        return read_or_empty(self.spark, schema, *folders, base=f"{self.path}/{kind}")

    # -- writing

    def load(self, changes: DataFrame, source: str = "", batch_id: int | None = None, ranked: bool = False) -> bool:
        """Append the changes and publish them; a batch applied before is skipped.

        ``ranked`` says that ``_step`` is a whole number from 1 on, the rank of its group.
        """
        known = self.loads.all()
        if _applied(_newest(known), source, batch_id):
            return False
        self._append(known, "changes", self._net(changes, ranked), source, batch_id)
        return True

    def _append(self, known: list[tuple[int, Load]], kind: str, rows: DataFrame, source: str, batch_id: int | None) -> None:
        number = _next(_newest(known))
        folder = _folder(number)
        rows.write.parquet(f"{self.path}/{kind}/{folder}")
        self.loads.add(Load(number, kind, folder, source, -1 if batch_id is None else batch_id), known)

    def _net(self, changes: DataFrame, ranked: bool = False) -> DataFrame:
        """One upsert per key and group, and one delete per delete key and group; groups by number."""
        entity = self.entity
        # The groups of a load are the files or the operations of a batch.
        if ranked:
            changes = changes.withColumn("_group", F.col("_step").cast("int"))
        else:
            groups = changes.select("_step").distinct()
            groups = groups.withColumn("_group", F.row_number().over(Window.orderBy("_step")))
            # Sent to all tasks: dealt by group, the rows of a load of one group would meet in one task.
            changes = changes.join(F.broadcast(groups), "_step")
        removal = is_removal(entity)
        dated = F.when(F.col(TIME).isNull(), F.raise_error(F.lit(f"{entity.name}: a row of the state needs an event time"))).otherwise(F.col(TIME))
        upserts = changes.filter(~removal).withColumn(TIME, dated)
        upserts = newest_per_key(upserts, [*entity.state_key, "_group"], dated=True)
        by = {c for route in entity.routes for c in (*route.keys, route.when_set)} - {None}
        deletes = changes.filter(removal).groupBy(*sorted({*by, *SCOPE}), "_group").agg(F.max(TIME).alias(TIME))
        deletes = deletes.withColumn("_route", F.lit("DELETE"))
        net = upserts.select(*entity.column_names, "_route", "_group").unionByName(deletes, allowMissingColumns=True)
        return net.hint("rebalance").sortWithinPartitions(*SCOPE, *entity.key)

    def remove_stale(self, ready: DataFrame) -> bool:
        """Drop the rows that finished snapshots of this entity did not bring."""
        rows = ready.select(*_STALE.fieldNames())
        self._append(self.loads.all(), "stale", rows.coalesce(1), "", None)
        return True

    def compact(self) -> bool:
        """Write the state anew as compacted rows; what it replaces goes at the compaction after the next reader's."""
        loads = self.loads.read()
        before, last = _compacted(loads), max((x.number for x in loads), default=0)
        if last == (before.number if before else 0):
            return False
        state = self._state(loads, {})
        changes = self._since(loads, "changes")
        most = self._base(loads, {}).count() + (changes.count() if changes is not None else 0)
        parts = min(MOST_PARTS, 2 ** math.ceil(math.log2(max(1.0, math.sqrt(most / self.part_rows)))))
        folder = _folder(last)
        by = {f: _part(F.col(c), parts) for f, c in self._folders()}
        rows = state.withColumns(by).hint("rebalance", *by).sortWithinPartitions(*by, *SCOPE, *self.entity.key)
        rows.write.partitionBy(*by).parquet(f"{self.path}/base/{folder}")
        sources = _batches(loads)
        # Readers that have begun still find what this compaction replaces; what the one before it replaced goes.
        for old in self.loads.rewrite([Load(last, "base", folder, parts=parts), *(Load(last, "applied", "", s, b) for s, b in sources.items())]):
            remove_path(self.spark, f"{self.path}/{old.kind}/{old.folder}")
        return True


class LedgerTable:
    """A small table that is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.schema, self.path = spark, schema, path.rstrip("/")
        self.loads = Loads(spark, self.path)

    def read(self, known: list[tuple[int, Load]] | None = None) -> DataFrame:
        """The rows; ``known``, here and below, are the loads as the writer has read them."""
        current = _compacted(_newest(self.loads.all() if known is None else known))
        return read_or_empty(self.spark, self.schema, f"{self.path}/base/{current.folder}") if current else self.spark.createDataFrame([], self.schema)

    def applied(self, source: str, batch_id: int, known: list[tuple[int, Load]] | None = None) -> bool:
        return _applied(_newest(self.loads.all() if known is None else known), source, batch_id)

    def replace(self, df: DataFrame, source: str = "", batch_id: int | None = None) -> None:
        known = self.loads.all()
        self.publish(self.write(df, known), source, batch_id, known)

    def write(self, df: DataFrame, known: list[tuple[int, Load]]) -> str:
        """Write the rows without publishing them; returns their folder."""
        folder = _folder(_next(_newest(known)))
        df.write.parquet(f"{self.path}/base/{folder}")
        return folder

    def publish(self, folder: str, source: str, batch_id: int | None, known: list[tuple[int, Load]]) -> None:
        loads = _newest(known)
        number = _next(loads)
        sources = {**_batches(loads), **({} if batch_id is None else {source: batch_id})}
        new = [Load(number, "base", folder), *(Load(number, "applied", "", s, b) for s, b in sources.items())]
        for old in self.loads.rewrite(new, known):
            remove_path(self.spark, f"{self.path}/base/{old.folder}")


#: Loads of a history table whose replay is recognised.
REMEMBERED_LOADS = 10_000
#: A load of a history table with fewer rows is written together with others by a compaction.
SMALL_ROWS = 10_000_000


class HistoryTable:
    """Append-only rows of one entity; every event of every operation, duplicates kept.

    A load writes few files for each date, however many tasks made its rows, and more only for dates too large for one.
    ``compact`` writes small loads together, so the files of a date grow with its rows and not with the loads.
    """

    def __init__(self, spark: SparkSession, root: str, entity: Entity) -> None:
        self.spark, self.entity = spark, entity
        name = entity.name if entity is AUDIT else f"{entity.name}_TS"
        self.path = f"{root.rstrip('/')}/{name}"
        self.loads = Loads(spark, self.path)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.entity.schema.fields, T.StructField("event_date", T.DateType())])

    def create(self, recreate: bool = False) -> None:
        _create(self.spark, self.path, self.loads, recreate)

    def append(self, rows: DataFrame, load_id: str) -> None:
        """Append under ``load_id``; the same load again adds nothing."""
        known = self.loads.all()
        loads = _newest(known)
        if any(x.source == load_id for x in loads):
            return
        number = _next(loads)
        folder = _folder(number)
        self._write(rows.select(*self.entity.column_names).withColumn("event_date", F.to_date(TIME)), folder)
        self.loads.add(Load(number, "rows", folder, load_id), known)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.hint("rebalance", F.col("event_date")).write.partitionBy("event_date").parquet(f"{self.path}/rows/{folder}")

    def read(self) -> DataFrame:
        return self._read([x for x in self.loads.read() if x.kind == "rows"]).drop("load", "attempt")

    def _read(self, loads: list[Load]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *_PLACE])
        folders = [f"{self.path}/rows/{x.folder}" for x in loads]
        return read_or_empty(self.spark, schema, *folders, base=f"{self.path}/rows") if folders else self.spark.createDataFrame([], schema)

    def compact(self, small_rows: int = SMALL_ROWS) -> bool:
        """Write the loads of fewer than ``small_rows`` rows as one; larger ones stay as they are."""
        loads = self.loads.read()
        written = [x for x in loads if x.kind == "rows"]
        # One number per load; counting reads no column.
        sizes = {r["attempt"]: r["count"] for r in self._read(written).groupBy("attempt").count().collect()}
        small = [x for x in written if sizes.get(x.folder.partition("attempt=")[2], 0) < small_rows]
        if len(small) < 2:
            return False
        folder = _folder(_next(loads))
        self._write(self._read(small).drop("load", "attempt"), folder)
        known = sorted((x for x in loads if x.source), key=lambda x: x.number)[-REMEMBERED_LOADS:]
        kept = [x for x in written if x not in small]
        done = [Load(x.number, "applied", "", x.source) for x in known if x not in kept]
        for old in self.loads.rewrite([*kept, *done, Load(_next(loads), "rows", folder)]):
            remove_path(self.spark, f"{self.path}/rows/{old.folder}")
        return True


class RejectTable:
    """Input that no table took: skipped events and rejected rows of every load, with the reason.

    ``content`` is the event's text, or the row as JSON.
    """

    SCHEMA = "load string, entity string, reason string, content string"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/REJECTS"

    def put(self, rows: DataFrame, load: str, part: str) -> None:
        """Keep (entity, reason, content) rows of a part of a load; the same part again replaces its own rows only."""
        rows.select("entity", "reason", "content").write.mode("overwrite").parquet(f"{self.path}/load={load}/part={part}")

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.SCHEMA}, part string", self.path).select("load", "entity", "reason", "content")


def _create(spark: SparkSession, path: str, loads: Loads, recreate: bool) -> None:
    if recreate:
        remove_path(spark, path)
    if not loads.read():
        loads.add(Load(0, "created", ""))


def create_tables(spark: SparkSession, root: str, history: bool = True, recreate: bool = False) -> None:
    """Create what is missing; ``recreate`` drops first, ``history`` also makes the append-only tables."""
    for entity in ENTITIES.values():
        StateTable(spark, root, entity).create(recreate)
        if history:
            HistoryTable(spark, root, entity).create(recreate)
    HistoryTable(spark, root, AUDIT).create(recreate)


def compact_tables(spark: SparkSession, root: str, history: bool = True) -> list[str]:
    """Compact every table below ``root`` that has loads to put together; returns their names. No job may write meanwhile."""
    done = []
    for entity in ENTITIES.values():
        if StateTable(spark, root, entity).compact():
            done.append(f"{entity.name}_STATE")
    for entity in (*ENTITIES.values(), AUDIT) if history else ():
        table = HistoryTable(spark, root, entity)
        if table.compact():
            done.append(table.path.rpartition("/")[2])
    return done
