"""Declared table specs: what a relational DDL states and Spark tables do not hold.

Spark parquet tables keep names, types and comments, but not primary /
unique / foreign keys, CHECK constraints, ENUM domains, defaults on old
rows or AUTO_INCREMENT.  A :class:`TableSpec` keeps them so the quality,
mutation and evolution operators can enforce them as DataFrame jobs.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

# Collation kinds of the modelled DDL and their Spark names; ai_ci (e = É, a = A), as_cs (accent and case sensitive), bin (byte order)
COLLATIONS = {"ai_ci": "UNICODE_CI_AI", "as_cs": "UNICODE", "bin": "UTF8_BINARY"}

NOW = object()  # marker: default / on-update is the operation's `now`


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str                       # Spark SQL type: bigint, decimal(10,2), string, ...
    nullable: bool = True
    default: Any = None              # literal, NOW, or None (NULL / no default)
    has_default: bool = False
    char_len: int | None = None      # CHAR(n): exact length after right-trim
    max_len: int | None = None       # VARCHAR(n)
    max_bytes: int | None = None     # TEXT family byte limit
    enum: tuple[str, ...] | None = None
    set_values: tuple[str, ...] | None = None
    unsigned: bool = False
    json: bool = False
    auto_increment: bool = False
    on_update_now: bool = False
    ts_range: tuple[dt.datetime, dt.datetime] | None = None
    collation: str | None = None     # 'ai_ci' | 'as_cs' | 'bin': how keys on the column compare
    comment: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    name: str
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]
    on_delete: str = "restrict"      # restrict | no_action | cascade | set_null
    on_update: str = "restrict"      # restrict | cascade


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, tuple[str, ...]], ...] = ()
    checks: tuple[tuple[str, str], ...] = ()          # (name, SQL boolean expression)
    foreign_keys: tuple[ForeignKey, ...] = ()
    indexes: tuple[tuple[str, tuple[str, ...]], ...] = ()  # (name, ("col", "col DESC"))
    comment: str | None = None

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def replace(self, **kw) -> "TableSpec":
        return dataclasses.replace(self, **kw)

    @property
    def collations(self) -> dict[str, str]:
        """Column -> declared collation, for the columns that declare one."""
        return {c.name: c.collation for c in self.columns if c.collation}

    def ddl_columns(self) -> str:
        return ", ".join(f"{c.name} {c.dtype}" for c in self.columns)


def col(name, dtype, **kw) -> ColumnSpec:
    if "default" in kw:
        kw.setdefault("has_default", True)
    return ColumnSpec(name, dtype, **kw)


# ---------------------------------------------------------------------------
# The enterprise_employees definition (types, lengths, enum
# members, defaults, keys, check and foreign key as declared).
# ---------------------------------------------------------------------------
CONTRACT_TYPES = ("FULL_TIME", "PART_TIME", "CONTRACTOR")
TEXT_BYTES = 65535
TIMESTAMP_RANGE = (dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(2038, 1, 19, 3, 14, 7))

EMPLOYEES = TableSpec(
    name="enterprise_employees",
    columns=(
        col("emp_id", "bigint", nullable=False, unsigned=True, auto_increment=True),
        col("department_id", "bigint", unsigned=True),
        col("national_id", "string", nullable=False, char_len=14),
        col("full_name", "string", nullable=False, max_len=150),
        col("contract_type", "string", nullable=False, enum=CONTRACT_TYPES, default="FULL_TIME"),
        col("base_salary", "decimal(10,2)", nullable=False, default=Decimal("0.00")),
        col("status", "string"),
        col("birth_date", "date", nullable=False),
        col("created_at", "timestamp", default=NOW, ts_range=TIMESTAMP_RANGE),
        col("updated_at", "timestamp", default=NOW, on_update_now=True, ts_range=TIMESTAMP_RANGE),
        col("metadata", "string", json=True),
    ),
    primary_key=("emp_id",),
    unique=(("uk_national_id", ("national_id",)), ("uk_email", ("full_name",))),
    checks=(("chk_salary", "base_salary >= 0"),),
    foreign_keys=(ForeignKey("fk_employee_department", ("department_id",), "departments", ("id",),
                             on_delete="set_null", on_update="cascade"),),
    indexes=(("idx_department_salary", ("department_id", "base_salary DESC")),),
    comment="Core table storing enterprise employee records",
)

DEPARTMENTS = TableSpec(
    name="departments",
    columns=(col("id", "bigint", nullable=False), col("department_name", "string"),
             col("status", "string")),
    primary_key=("id",),
)
