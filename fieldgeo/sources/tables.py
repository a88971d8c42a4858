"""Plot tables in a database, as a Spark source: filters go into the database's own query, and tasks read ranges of keys.

    spark.dataSource.register(tables.TableSource)
    plots = spark.read.format("plot_table").schema("plot_id string, ...").options(database=..., table="plots", key="id", parts=8).load()
    plots.where(F.col("plot_id").startswith("18ASH"))        # reads those rows alone

Any DB-API module whose parameters are question marks will do (option module, sqlite3 by default); executors connect by themselves. Spark
hands filters over where spark.sql.python.filterPushdown.enabled is true.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import StructType

COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Range(InputPartition):
    """Rows whose key is in [low, high), or (low None) those without a key."""

    low: int | None
    high: int | None


def condition(f: Filter, columns: set[str]) -> tuple[str, list] | None:
    """A filter as SQL text with its parameters; None where the database is not to be trusted with it."""
    if len(f.attribute) != 1 or f.attribute[0] not in columns:
        return None
    name = quoted(f.attribute[0])
    if type(f) in COMPARED and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool):
        return f"{name} {COMPARED[type(f)]} ?", [f.value]
    if isinstance(f, In) and f.value and all(isinstance(v, (int, str)) for v in f.value):
        return f"{name} in ({', '.join('?' * len(f.value))})", list(f.value)
    if isinstance(f, StringStartsWith):
        return f"substr({name}, 1, {len(f.value)}) = ?", [f.value]
    if isinstance(f, IsNotNull):
        return f"{name} is not null", []
    if isinstance(f, IsNull):
        return f"{name} is null", []
    return None


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class TableReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns, self.options = schema.names, options
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            found = condition(f, set(self.columns))
            if found is None:
                yield f
                continue
            self.where.append(found[0])
            self.values += found[1]

    def _rows(self, what: str, more: list[str], values: list) -> Iterator[tuple]:
        connection = importlib.import_module(self.options.get("module", "sqlite3")).connect(self.options["database"])
        try:
            where = [*self.where, *more]
            cursor = connection.cursor()
            cursor.execute(f"select {what} from {quoted(self.options['table'])}" + (f" where {' and '.join(where)}" if where else ""), [*self.values, *values])
            while rows := cursor.fetchmany(1000):
                yield from rows
        finally:
            connection.close()

    def partitions(self) -> list[Range]:
        """Equal ranges of the whole-number key between the ends of the rows that the filters leave, and one for rows without a key."""
        key, parts = quoted(self.options["key"]), int(self.options.get("parts", 8))
        low, high, n, keyed = next(self._rows(f"min({key}), max({key}), count(*), count({key})", [], []))
        out = []
        if keyed:
            step = -(-(high - low + 1) // parts)
            out = [Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]
        return out + ([Range(None, None)] if n > keyed or not out else [])

    def read(self, partition: Range) -> Iterator[tuple]:
        key = quoted(self.options["key"])
        more, values = ([f"{key} >= ?", f"{key} < ?"], [partition.low, partition.high]) if partition.low is not None else ([f"{key} is null"], [])
        yield from self._rows(", ".join(map(quoted, self.columns)), more, values)


class TableSource(DataSource):
    """Options: database, table, key (a whole-number column), parts (how many ranges, 8 by default), module."""

    @classmethod
    def name(cls) -> str:
        return "plot_table"

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(schema, self.options)
