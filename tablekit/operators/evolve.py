"""Schema evolution (E1-E8) as frame functions plus a spec change.

Metadata-only changes (SET DEFAULT, RENAME TABLE) touch no rows.  Changes of
type, name, position or constraint are a projection of the frame, checked
against the existing rows first (one job), and are written once by publish.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions.exprs import names_in, rename_in
from tablekit.operators import quality as V
from tablekit.spec import TEXT_BYTES, ColumnSpec, ForeignKey, TableSpec, col


def set_default(spec: TableSpec, column: str, value) -> TableSpec:
    """ALTER COLUMN .. SET DEFAULT: future inserts only, old rows keep values."""
    cols = tuple(dataclasses.replace(c, default=value, has_default=True) if c.name == column else c
                 for c in spec.columns)
    return spec.replace(columns=cols)


def set_default_sql(spark: SparkSession, table: str, column: str, value_sql: str) -> None:
    """E1 on a catalog table (native, metadata only)."""
    spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} SET DEFAULT {value_sql}")


def add_column(df: DataFrame, spec: TableSpec, new: ColumnSpec, after: str | None = None,
               first: bool = False) -> tuple[DataFrame, TableSpec]:
    """ADD COLUMN at the end, FIRST or AFTER a column; existing rows get
    the default (NULL when none)."""
    value = (F.lit(new.default) if new.has_default else F.lit(None)).cast(new.dtype).alias(new.name)
    names = list(df.columns)
    pos = 0 if first else (names.index(after) + 1 if after else len(names))
    cols = [F.col(c) for c in names]
    cols.insert(pos, value)
    spec_cols = list(spec.columns)
    spec_names = [c.name for c in spec_cols]
    spos = 0 if first else (spec_names.index(after) + 1 if after in spec_names else len(spec_cols))
    spec_cols.insert(spos, new)
    return df.select(*cols), spec.replace(columns=tuple(spec_cols))


def modify_columns(df: DataFrame, spec: TableSpec, news: Sequence[ColumnSpec]) -> tuple[DataFrame, TableSpec]:
    """E3 for several columns at once (type, length, nullability).  Existing
    rows must fit the new definitions, else raise; one pass checks them all."""
    by_name = {c.name: c for c in news}
    probe = df.select(*[F.col(c.name) for c in news])
    V.require_empty(V.row_violations(probe, TableSpec(spec.name, tuple(news))), f"MODIFY {', '.join(by_name)}")
    out = df.select(*[F.col(c).cast(by_name[c].dtype).alias(c) if c in by_name else F.col(c) for c in df.columns])
    return out, spec.replace(columns=tuple(by_name.get(c.name, c) for c in spec.columns))


def modify_column(df: DataFrame, spec: TableSpec, new: ColumnSpec) -> tuple[DataFrame, TableSpec]:
    """MODIFY COLUMN."""
    return modify_columns(df, spec, [new])


def rename_in_spec(spec: TableSpec, old: str, new: str) -> TableSpec:
    """``spec`` with a column renamed wherever it is named: column list, keys,
    checks (as Spark parses them), foreign keys and indexes."""
    def one(c: str) -> str:
        return new if c == old else c

    def in_index(part: str) -> str:
        words = part.split()
        return " ".join([one(words[0]), *words[1:]])

    return spec.replace(
        columns=tuple(dataclasses.replace(c, name=one(c.name)) for c in spec.columns),
        primary_key=tuple(map(one, spec.primary_key)),
        unique=tuple((n, tuple(map(one, cs))) for n, cs in spec.unique),
        checks=tuple((n, rename_in(e, old, new)) for n, e in spec.checks),
        foreign_keys=tuple(dataclasses.replace(fk, cols=tuple(map(one, fk.cols))) for fk in spec.foreign_keys),
        indexes=tuple((n, tuple(map(in_index, parts))) for n, parts in spec.indexes))


def rename_column(df: DataFrame, spec: TableSpec, old: str, new: str) -> tuple[DataFrame, TableSpec]:
    """The renaming part of E4, metadata only."""
    return df.withColumnRenamed(old, new), rename_in_spec(spec, old, new)


def change_column(df: DataFrame, spec: TableSpec, old: str, new: ColumnSpec) -> tuple[DataFrame, TableSpec]:
    """CHANGE COLUMN old new TYPE: rename and retype, position kept; keys,
    checks, foreign keys and indexes follow the new name."""
    return modify_column(*rename_column(df, spec, old, new.name), new)


def drop_column(df: DataFrame, spec: TableSpec, name: str) -> tuple[DataFrame, TableSpec]:
    """E5: DROP COLUMN; keys, checks and indexes on it go with it."""
    keep = lambda cols: name not in cols
    new_spec = spec.replace(
        columns=tuple(c for c in spec.columns if c.name != name),
        primary_key=spec.primary_key if keep(spec.primary_key) else (),
        unique=tuple(u for u in spec.unique if keep(u[1])),
        checks=tuple(ch for ch in spec.checks if name.lower() not in names_in(ch[1])),
        foreign_keys=tuple(fk for fk in spec.foreign_keys if keep(fk.cols)),
        indexes=tuple(ix for ix in spec.indexes if all(p.split()[0] != name for p in ix[1])),
    )
    return df.drop(name), new_spec


def add_index(spec: TableSpec, name: str, parts: tuple[str, ...]) -> TableSpec:
    """ADD INDEX: a layout wish that ``write_clustered`` follows."""
    if any(p.split()[0] not in spec.names for p in parts) or name in [n for n, _ in spec.indexes]:
        raise ValueError(f"index {name} on {parts}")
    return spec.replace(indexes=spec.indexes + ((name, parts),))


def drop_index(spec: TableSpec, name: str) -> TableSpec:
    """DROP INDEX."""
    if name not in [n for n, _ in spec.indexes]:
        raise KeyError(name)
    return spec.replace(indexes=tuple(ix for ix in spec.indexes if ix[0] != name))


def unique_violations(df: DataFrame, name: str, cols: tuple[str, ...],
                      collations: Mapping[str, str] | None = None) -> DataFrame:
    return V.duplicate_keys(df, cols, f"unique:{name}", collations=collations)


def add_unique(df: DataFrame, spec: TableSpec, name: str, cols: tuple[str, ...]) -> TableSpec:
    """ADD UNIQUE on existing data: duplicates (NULLs excepted,
    compared under the columns' collations) raise."""
    V.require_empty(unique_violations(df, name, cols, spec.collations), f"ADD UNIQUE {name}")
    return spec.replace(unique=spec.unique + ((name, cols),))


def drop_foreign_key(spec: TableSpec, name: str) -> TableSpec:
    """DROP FOREIGN KEY (metadata only)."""
    return spec.replace(foreign_keys=tuple(fk for fk in spec.foreign_keys if fk.name != name))


def fk_violations(df: DataFrame, spec: TableSpec, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    return V.orphans(df, parent, fk, spec.primary_key)


def add_foreign_key(df: DataFrame, spec: TableSpec, fk: ForeignKey, parent: DataFrame) -> TableSpec:
    """ADD FOREIGN KEY: every non-NULL value must have a parent, else raise."""
    V.require_empty(fk_violations(df, spec, fk, parent), f"ADD FOREIGN KEY {fk.name}")
    return spec.replace(foreign_keys=spec.foreign_keys + (fk,))


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """RENAME TABLE on the catalog (metadata only)."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


PHONE = col("phone_number", "string", max_len=15)
BIOGRAPHY = col("biography", "string", max_bytes=TEXT_BYTES)
RESUME = col("resume_text", "string", max_bytes=4294967295)
