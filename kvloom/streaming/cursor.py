"""A stream over a table that lists no files but can be asked for the rows above a cursor.

The offset of the stream is a cursor (ts, entity_id, key), the primary key of ``ts_kv`` with ts
first. A micro-batch has the rows above the cursor of the one before, up to and with the highest
one there is, so rows that share a ts may fall into different batches and none is lost or repeated.
What is planned for a batch are ranges of ts with about equally many rows; each is read in a task.

Like every poll by ts, a stream by cursor does not see rows that arrive below its cursor. Rows
whose ts, entity or key is null are at no place and never delivered.
"""

from __future__ import annotations

import json
import re
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from kvloom.model import source_schema

NAME = "kvloom_cursor"
_FIRST_TS = -(2**63)
_PLACE = ["ts", "entity_id", "key"]
# Points of a row group that a range may end at.
_POINTS = 16


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI, or of a plain local path."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass(frozen=True)
class Cursor:
    """A place in (ts, entity_id, key) order; without an entity behind all rows of its ts."""

    ts: int = _FIRST_TS
    entity_id: str | None = None
    key: int | str | None = None

    @staticmethod
    def of(offset: dict) -> Cursor:
        return Cursor(offset["ts"], offset["entity_id"], offset["key"])

    def offset(self) -> dict:
        return {"ts": self.ts, "entity_id": self.entity_id, "key": self.key}

    def above(self) -> pc.Expression:
        """The rows behind this place."""
        ts, entity, key = (pc.field(c) for c in _PLACE)
        if self.entity_id is None:
            return ts > self.ts
        later = (entity > self.entity_id) | ((entity == self.entity_id) & (key > self.key))
        return (ts >= self.ts) & ((ts > self.ts) | later)

    def upto(self) -> pc.Expression:
        """The rows before this place and the one at it."""
        ts, entity, key = (pc.field(c) for c in _PLACE)
        if self.entity_id is None:
            return ts <= self.ts
        earlier = (entity < self.entity_id) | ((entity == self.entity_id) & (key <= self.key))
        return (ts <= self.ts) & ((ts < self.ts) | earlier)

    def rank(self) -> tuple:
        """Sorts cursors of one key type."""
        whole = self.entity_id is None
        return (self.ts, whole, "" if whole else self.entity_id, self.key if not whole else 0)


class CursorRange(InputPartition):
    """The rows above one cursor, up to another; ``hint`` tells the table where they lie."""

    def __init__(self, above: Cursor, upto: Cursor, hint: object = None):
        self.above, self.upto, self.hint = above, upto, hint


class CursorTable(ABC):
    """What a table has to answer to be streamed by cursor."""

    @abstractmethod
    def newest(self, above: Cursor) -> Cursor:
        """The highest place; the given one if no row is above it."""

    @abstractmethod
    def page_end(self, above: Cursor, rows: int) -> Cursor:
        """The place of the last of so many rows above a cursor, or of the last row."""

    @abstractmethod
    def ranges(self, above: Cursor, upto: Cursor, parts: int) -> list[CursorRange]:
        """Ranges with about equally many rows, cut between two ts."""

    @abstractmethod
    def read(self, part: CursorRange) -> Iterator[pa.RecordBatch]:
        """The rows of a range, in any order."""


@dataclass(frozen=True)
class _Group:
    """A row group: where it is, its rows and its range of ts."""

    path: str
    number: int
    rows: int
    low: int
    high: int


class ParquetCursorTable(CursorTable):
    """``ts_kv`` as Parquet files in a folder of a file system that Arrow knows.

    Statistics of row groups stand for the index of a database: they tell where to look for the
    highest place, for the end of a page and for a range. Of the cursor columns, one row group is
    held at a time, and a page of cursors. Files must come complete, as Spark's writers leave them.
    """

    def __init__(self, path: str, schema: pa.Schema):
        self.schema = schema
        self.system, self.path = _located(path)

    def groups(self) -> list[_Group]:
        if self.system.get_file_info(self.path).type == fs.FileType.NotFound:
            return []
        found = []
        for file in ds.dataset(self.path, format="parquet", filesystem=self.system).get_fragments():
            for group in file.row_groups:
                known = (group.statistics or {}).get("ts") or {}
                low, high = known.get("min", _FIRST_TS), known.get("max", 2**63 - 1)
                if group.num_rows:
                    found.append(_Group(file.path, group.id, group.num_rows, low, high))
        return found

    def _scan(self, path: str, numbers: list[int], columns: list[str], wanted: pc.Expression) -> pa.Table:
        file = ds.ParquetFileFormat().make_fragment(path, self.system, row_groups=numbers)
        placed = pc.field("entity_id").is_valid() & pc.field("key").is_valid()
        table = file.to_table(columns=columns, filter=wanted & placed)
        return table.cast(pa.schema([self.schema.field(c) for c in columns]))

    def _places(self, group: _Group, above: Cursor) -> pa.Table:
        return self._scan(group.path, [group.number], _PLACE, above.above())

    @staticmethod
    def _ordered(places: pa.Table) -> pa.Table:
        return places.sort_by([(c, "ascending") for c in _PLACE])

    @staticmethod
    def _last(places: pa.Table, otherwise: Cursor) -> Cursor:
        if not places.num_rows:
            return otherwise
        row = places.slice(places.num_rows - 1).to_pylist()[0]
        return Cursor(row["ts"], row["entity_id"], row["key"])

    def newest(self, above: Cursor) -> Cursor:
        best = above
        for group in sorted(self.groups(), key=lambda g: g.high, reverse=True):
            if group.high < best.ts:
                break
            places = self._places(group, best)
            if places.num_rows:
                highest = places.filter(pc.field("ts") == pc.max(places["ts"]))
                best = self._last(self._ordered(highest), best)
        return best

    def page_end(self, above: Cursor, rows: int) -> Cursor:
        page = pa.schema([self.schema.field(c) for c in _PLACE]).empty_table()
        for group in sorted(self.groups(), key=lambda g: g.low):
            if page.num_rows == rows and group.low > page["ts"][-1].as_py():
                break
            if group.high >= above.ts:
                page = self._ordered(pa.concat_tables([page, self._places(group, above)])).slice(0, rows)
        return self._last(page, above)

    def ranges(self, above: Cursor, upto: Cursor, parts: int) -> list[CursorRange]:
        touched = [g for g in self.groups() if g.high >= above.ts and g.low <= upto.ts]
        # Rows of a group are taken to lie evenly over its range of ts.
        points = sorted(
            (g.low + (g.high - g.low) * k // _POINTS, g.rows / _POINTS) for g in touched for k in range(_POINTS)
        )
        share = sum(w for _, w in points) / parts
        edges, held = [above], 0.0
        for ts, weight in points:
            held += weight
            if held >= share and edges[-1].ts < ts < upto.ts and ts > above.ts:
                edges.append(Cursor(ts))
                held = 0.0
        out = []
        for low, high in zip(edges, [*edges[1:], upto]):
            where: dict[str, list[int]] = {}
            for g in touched:
                if g.high >= low.ts and g.low <= high.ts:
                    where.setdefault(g.path, []).append(g.number)
            if where:
                out.append(CursorRange(low, high, where))
        return out

    def read(self, part: CursorRange) -> Iterator[pa.RecordBatch]:
        wanted = part.above.above() & part.upto.upto()
        for path, numbers in part.hint.items():
            for number in numbers:
                yield from self._scan(path, [number], self.schema.names, wanted).to_batches()


class CursorStreamReader(DataSourceStreamReader):
    """Offsets and ranges of a stream over a ``CursorTable``.

    Without ``page_rows`` a batch goes up to the highest place. With it, a batch has that many rows
    at most, and the end of the newest page is kept in ``state_dir`` before the stream learns of
    it: a restarted reader is not told where the stream stands. If the stream fails in between, its
    next batch has two pages; nothing is lost or repeated.
    """

    def __init__(self, table: CursorTable, start: Cursor, parts: int, page_rows: int | None, state_dir: str | None):
        if page_rows is not None and (page_rows < 1 or state_dir is None):
            raise ValueError("page_rows must be at least 1 and needs state_dir")
        self.table, self.start, self.parts = table, start, parts
        self.page_rows, self.state_dir = page_rows, state_dir

    def initialOffset(self) -> dict:
        return self.start.offset()

    def latestOffset(self) -> dict:
        if self.page_rows is None:
            return self.table.newest(self.start).offset()
        before = self._kept()
        end = self.table.page_end(before, self.page_rows)
        if end != before:
            self._keep(end)
        return end.offset()

    def partitions(self, start: dict, end: dict) -> list[CursorRange]:
        above, upto = Cursor.of(start), Cursor.of(end)
        return self.table.ranges(above, upto, self.parts) if above.rank() < upto.rank() else []

    def read(self, partition: CursorRange) -> Iterator[pa.RecordBatch]:
        return self.table.read(partition)

    def _file(self) -> tuple[fs.FileSystem, str]:
        system, folder = _located(self.state_dir)
        return system, f"{folder}/page_end.json"

    def _kept(self) -> Cursor:
        system, path = self._file()
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return self.start
        with system.open_input_stream(path) as file:
            return Cursor.of(json.loads(file.read()))

    def _keep(self, end: Cursor) -> None:
        system, path = self._file()
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{path}.new") as file:
            file.write(json.dumps(end.offset()).encode())
        system.move(f"{path}.new", path)


class CursorDataSource(DataSource):
    """The format ``kvloom_cursor``.

    Options: ``path`` of the Parquet folder, ``start_ts`` (rows above it), ``parts`` ranges a batch,
    ``page_rows`` and ``state_dir``. A subclass with another ``name`` and ``table`` streams another
    kind of table.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return source_schema()

    def table(self, schema: T.StructType) -> CursorTable:
        from pyspark.sql.pandas.types import to_arrow_schema

        return ParquetCursorTable(self.options["path"], to_arrow_schema(schema))

    def streamReader(self, schema: T.StructType) -> CursorStreamReader:
        page = self.options.get("page_rows")
        return CursorStreamReader(
            self.table(schema),
            Cursor(int(self.options.get("start_ts", _FIRST_TS))),
            int(self.options.get("parts", 8)),
            None if page is None else int(page),
            self.options.get("state_dir"),
        )


def cursor_stream(
    spark: SparkSession,
    path: str,
    start_ts: int | None = None,
    parts: int | None = None,
    page_rows: int | None = None,
    state_dir: str | None = None,
    key_type: T.DataType | None = None,
) -> DataFrame:
    """``ts_kv`` rows of a Parquet folder as a stream by cursor, for ``start_live``."""
    spark.dataSource.register(CursorDataSource)
    given = {"path": path, "start_ts": start_ts, "parts": parts, "page_rows": page_rows, "state_dir": state_dir}
    reader = spark.readStream.format(NAME).options(**{k: str(v) for k, v in given.items() if v is not None})
    return (reader.schema(source_schema(key_type)) if key_type else reader).load()
