"""Tables of a Silver or Gold layer whose keys are numbered on demand.

Numbering 1..n needs a pass over the rows of its own.  A consumer that never
looks at the generated key (a question over Gold, say) should not pay for it, so
a ``Layer`` keeps each table both ways: by name, as any mapping, with its key;
and through ``rows`` without any generated key, its own or one that came with a
source table.  Nothing is built before it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """``key``: name of the generated key, None where the rows had one."""
    key: str | None
    plain: Callable[[], DataFrame]
    numbered: Callable[[], DataFrame]

    @staticmethod
    def keyed(made: Callable[[], DataFrame]) -> Table:
        return Table(None, made, made)


class Layer(Mapping[str, DataFrame]):
    def __init__(self) -> None:
        self._tables: dict[str, Table] = {}
        self._numbered: dict[str, DataFrame] = {}
        self._plain: dict[str, DataFrame] = {}

    def add(self, name: str, table: Table) -> None:
        self._tables[name] = table

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._numbered:
            self._numbered[name] = self._tables[name].numbered()
        return self._numbered[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def rows(self, name: str) -> DataFrame:
        """The table without generated keys."""
        if name not in self._plain:
            self._plain[name] = self._tables[name].plain()
        return self._plain[name]

    def key(self, name: str) -> str | None:
        return self._tables[name].key

    def fields(self, name: str) -> list[T.StructField]:
        """Columns of the table, key first; nothing is numbered to know them."""
        key = [T.StructField(self.key(name), T.LongType())] if self.key(name) else []
        return key + self.rows(name).schema.fields


def plain_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of any mapping without generated keys."""
    return {name: tables.rows(name) if isinstance(tables, Layer) else tables[name] for name in tables}


def fields_of(tables: Mapping[str, DataFrame], name: str) -> list[T.StructField]:
    return tables.fields(name) if isinstance(tables, Layer) else tables[name].schema.fields
