"""Target mappings: what each star-schema table is made of."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, types as T

from starloom.functions.clean import is_boolean_name, is_time_name

LOAD_TIME = "etl_timestamp"
# The most characters of a text that a mapping declares no type for.
UNDECLARED_LENGTH = 255

_TYPES = {"bigint": T.LongType(), "boolean": T.BooleanType(), "string": T.StringType(), "timestamp": T.TimestampType()}


def type_by_name(column: str) -> T.DataType:
    """The type of a column that a mapping does not declare one for: names decide."""
    if is_time_name(column) or column == LOAD_TIME:
        return T.TimestampType()
    if is_boolean_name(column):
        return T.BooleanType()
    return T.LongType() if column.endswith("_id") else T.StringType()


@dataclass(frozen=True)
class TargetMapping:
    """One target: its sources in order and, per target column, ``table.field`` or a function that makes a column.

    A field without a table is taken from the main table. The first key column decides
    which source is the main table. ``types`` declares columns as bigint, boolean,
    timestamp, string or ``varchar(n)``, a text of at most n characters.
    """

    name: str
    sources: tuple[str, ...]
    key: tuple[str, ...]
    columns: Mapping[str, str | Callable[[], Column]]
    group: str = ""
    declared_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    bit_columns: tuple[str, ...] = ()
    null_defaults: Mapping[str, object] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.declared_key or self.key

    @property
    def schema(self) -> T.StructType:
        fields = []
        for name in self.columns:
            length = self.length_of(name)
            fields.append(T.StructField(name, self.type_of(name), True, {"max_length": length} if length else {}))
        return T.StructType([*fields, T.StructField(LOAD_TIME, T.TimestampType(), True)])

    def type_of(self, column: str) -> T.DataType:
        declared = self.types.get(column)
        if declared is None:
            return type_by_name(column)
        return T.StringType() if declared.startswith("varchar") else _TYPES[declared]

    def length_of(self, column: str) -> int:
        """The declared length of a text; 0 means unlimited."""
        declared = self.types.get(column)
        if declared is None:
            return UNDECLARED_LENGTH if isinstance(type_by_name(column), T.StringType) else 0
        return int(declared[len("varchar(") : -1]) if declared.startswith("varchar(") else 0

    def field_of(self, column: str) -> tuple[str | None, str | Callable[[], Column]]:
        """(table, field) of a target column; table is None for the main table."""
        source = self.columns[column]
        if isinstance(source, str) and "." in source:
            table, name = source.split(".", 1)
            return table, name
        return None, source


def target(
    name: str,
    group: str,
    sources: Sequence[str],
    key: Sequence[str],
    columns: Sequence[tuple[str, str, str]],
    *,
    declared_key: Sequence[str] = (),
    required: Sequence[str] = (),
    defaults: Mapping[str, object] | None = None,
    cluster_by: Sequence[str] = (),
    bit_columns: Sequence[str] = (),
    null_defaults: Mapping[str, object] | None = None,
) -> TargetMapping:
    """A mapping from rows of (column, ``table.field``, type)."""
    return TargetMapping(
        name=name,
        group=group,
        sources=tuple(sources),
        key=tuple(key),
        columns={column: source for column, source, _ in columns},
        declared_key=tuple(declared_key),
        required=tuple(required),
        defaults=defaults or {},
        cluster_by=tuple(cluster_by),
        bit_columns=tuple(bit_columns),
        null_defaults=null_defaults or {},
        types={column: kind for column, _, kind in columns},
    )


class MappingSet:
    """The registry of mappings by target name."""

    def __init__(self, mappings: Iterable[TargetMapping]):
        self._by_name = {mapping.name: mapping for mapping in mappings}

    def __getitem__(self, name: str) -> TargetMapping:
        return self._by_name[name]

    def __iter__(self):
        return iter(self._by_name.values())

    def __len__(self) -> int:
        return len(self._by_name)

    def get(self, name: str) -> TargetMapping | None:
        return self._by_name.get(name)

    def names(self) -> list[str]:
        return list(self._by_name)

    def in_group(self, group: str) -> list[str]:
        return [m.name for m in self if m.group == group.lower()]

    def sources_of(self, name: str) -> list[str]:
        mapping = self.get(name)
        return list(mapping.sources) if mapping else []

    def columns_of(self, name: str) -> dict[str, str | Callable[[], Column]]:
        mapping = self.get(name)
        return dict(mapping.columns) if mapping else {}

    def key_of(self, name: str) -> tuple[str, ...] | None:
        mapping = self.get(name)
        return mapping.key if mapping else None

    def required_tables(self) -> set[str]:
        """Every source table some target reads."""
        return {table for mapping in self for table in mapping.sources}

    def source_schema(self, table: str, join_keys: Mapping[frozenset, str] | None = None) -> T.StructType:
        """The columns the mappings and joins read from a source table, in the types of what they feed.

        A BIT column is marked, because text and numbers count differently in it.
        """
        fields: dict[str, T.StructField] = {}
        for mapping in self.fed_by(table):
            for target in mapping.columns:
                owner, name = mapping.field_of(target)
                if owner == table and not callable(name):
                    marks = {"bit": True} if target in mapping.bit_columns else {}
                    fields.setdefault(name, T.StructField(name, mapping.type_of(target), True, marks))
        for pair, key in (join_keys or {}).items():
            if table in pair:
                fields.setdefault(key, T.StructField(key, T.LongType()))
        return T.StructType(list(fields.values()))

    def fed_by(self, table: str) -> list[TargetMapping]:
        """The targets that list a source table."""
        return [mapping for mapping in self if table in mapping.sources]
