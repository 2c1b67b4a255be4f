"""Table schemas compiled on the driver, and the registries users extend.

The schema list is configuration: a few thousand short rows at most.  It is read to the
driver once, partition by partition, and compiled to Column expressions, so no per-row
work depends on it but evaluating those expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from eventloom.functions import casts
from eventloom.functions.casts import Conversion

LAYOUT_PREFIX = "f@timestamp@"

# Named single-value transformers (extension point: add a Conversion).
CONVERSIONS: dict[str, Conversion] = {
    "int": casts.INT,
    "bigint": casts.BIGINT,
    "float": casts.FLOAT,
    "varchar": casts.VARCHAR,
    "bool": casts.BOOL,
    LAYOUT_PREFIX + "unix": casts.UNIX_WALL_CLOCK,
    LAYOUT_PREFIX + "unix-utc": casts.UNIX_UTC,
}

# Transformers answered by a range table on the address: name -> (table, field, SQL type).
ADDRESS_LOOKUPS: dict[str, tuple[str, str, str]] = {
    "ipCity": ("geo", "city", "string"),
    "ipCountry": ("geo", "country", "string"),
    "ipRegion": ("geo", "region", "string"),
    "ipAsn": ("asn", "asn", "string"),
    "ipAsnInteger": ("asn", "asn", "bigint"),
}

# Transformers that map a supporting column to an id through a dimension table (extension
# point: name -> name of the dimension passed to ``collate``).
MAPPINGS: dict[str, str] = {"userIDWithMapping": "logins"}


def register_conversion(name: str, conversion: Conversion) -> None:
    CONVERSIONS[name] = conversion


def register_mapping(name: str, dimension: str) -> None:
    MAPPINGS[name] = dimension


@dataclass(frozen=True)
class TableColumn:
    inbound: str
    outbound: str
    transformer: str
    options: str = ""
    supporting: tuple[str, ...] = ()

    @property
    def is_mapping(self) -> bool:
        return self.transformer in MAPPINGS

    @property
    def dimension(self) -> str | None:
        """Dimension table of a mapping column."""
        return MAPPINGS.get(self.transformer)

    @property
    def sql_type(self) -> str:
        if self.is_mapping:
            return "bigint"
        if self.transformer in ADDRESS_LOOKUPS:
            return ADDRESS_LOOKUPS[self.transformer][2]
        return conversion_of(self.transformer).sql_type


@dataclass(frozen=True)
class TableSchema:
    event: str
    version: int
    columns: tuple[TableColumn, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.outbound for c in self.columns]


def conversion_of(transformer: str) -> Conversion | None:
    """Conversion of a single-value transformer name, None when the name is unknown."""
    if transformer in CONVERSIONS:
        return CONVERSIONS[transformer]
    parts = transformer.split("@")
    if transformer.startswith("f") and len(parts) >= 3 and parts[1] == "timestamp":
        name = LAYOUT_PREFIX + parts[2]
        return CONVERSIONS.get(name) or casts.layout_conversion(parts[2])
    return None


def is_known(transformer: str) -> bool:
    return (
        transformer in MAPPINGS
        or transformer in ADDRESS_LOOKUPS
        or conversion_of(transformer) is not None
    )


def compile_schemas(entries: list[dict]) -> dict[str, TableSchema]:
    """Usable schemas by event name.

    A table with one unknown transformer is left out, which makes its events untracked; a
    later entry of the same event replaces an earlier one.
    """
    compiled: dict[str, TableSchema] = {}
    for entry in entries:
        columns = []
        for c in entry.get("Columns") or []:
            name = c.get("Transformer") or ""
            supporting = (c.get("SupportingColumns") or "").split(",") if name in MAPPINGS else []
            columns.append(
                TableColumn(
                    c.get("InboundName") or "", c.get("OutboundName") or "", name,
                    c.get("ColumnCreationOptions") or "", tuple(supporting),
                )
            )
        if all(is_known(c.transformer) for c in columns):
            event = entry.get("EventName") or ""
            compiled[event] = TableSchema(event, int(entry.get("Version") or 0), tuple(columns))
    return compiled


def load_schemas(config: DataFrame) -> dict[str, TableSchema]:
    """Compile a schema DataFrame (see ``read_table_schemas``)."""
    return compile_schemas([json.loads(r) for r in config.toJSON().toLocalIterator()])
