"""F1-F3 over a graph of tables: DELETE with its foreign-key actions.

A delta fixpoint.  Each round joins only the rows deleted in the round before
(their referenced columns) with the tables that refer to them:

* ``cascade`` children not deleted yet are the next round's delta;
* ``set_null`` remembers the keys gone, applied to the rows that stay;
* ``restrict`` raises at once; ``no_action`` only for rows that stay.

So the number of rounds is the longest chain of rows that refer to each other,
not the size of a table; self references and cycles end when a round deletes
nothing new.  Deltas are written as tables: an executor's loss does not repeat
earlier rounds, and the planner knows their sizes and picks each join itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import hit
from tablekit.operators.quality import require_empty
from tablekit.session import materialize
from tablekit.spec import ForeignKey, TableSpec

Tables = Mapping[str, tuple[DataFrame, TableSpec]]


def delete_cascade(tables: Tables, name: str, where) -> dict[str, DataFrame]:
    """DELETE FROM ``name`` WHERE ``where`` over all ``tables`` (name -> frame
    and spec with a PRIMARY KEY); returns every table as it is afterwards.

    A NULL in a foreign key refers to nothing.  A key that is cleared may not
    be referred to itself (that would be an update cascade): ValueError.
    """
    refs = [(child, fk) for child, (_, spec) in tables.items() for fk in spec.foreign_keys if fk.parent in tables]
    named = {t: sorted({c for _, fk in refs if fk.parent == t for c in fk.parent_cols}
                       | set(spec.primary_key)) for t, (_, spec) in tables.items()}
    for child, fk in refs:
        if fk.on_delete == "set_null" and set(fk.cols) & set(named[child]):
            raise ValueError(f"{fk.name}: cleared columns are a key of {child}")

    gone: dict[str, DataFrame] = {}                        # all deleted rows, their named columns
    delta = {name: materialize(tables[name][0].filter(hit(where)).select(*named[name]), "deleted")}
    while delta:
        for t, rows in delta.items():
            gone[t] = gone[t].unionByName(rows) if t in gone else rows
        found: dict[str, list[DataFrame]] = {}
        for child, fk in refs:
            if fk.parent not in delta or fk.on_delete not in ("cascade", "restrict"):
                continue
            hits = _referring(tables[child][0], delta[fk.parent], fk)
            if fk.on_delete == "restrict":
                require_empty(hits.select(*fk.cols), f"{fk.name}: deleted rows of {fk.parent} are still referenced")
            else:
                found.setdefault(child, []).append(hits.select(*named[child]))
        delta = {}
        for child, parts in found.items():
            pk = list(tables[child][1].primary_key)
            new = reduce(DataFrame.unionByName, parts).dropDuplicates(pk)
            if child in gone:
                new = new.join(gone[child].select(*pk), pk, "left_anti")
            new = materialize(new.select(*named[child]), "deleted")
            if not new.isEmpty():
                delta[child] = new

    out = {}
    for t, (df, spec) in tables.items():
        left = df.join(gone[t].select(*spec.primary_key), list(spec.primary_key), "left_anti") if t in gone else df
        left = left.select(*df.columns)
        for child, fk in refs:
            if child != t or fk.parent not in gone:
                continue
            if fk.on_delete == "no_action":
                require_empty(_referring(left, gone[fk.parent], fk).select(*fk.cols),
                              f"{fk.name}: deleted rows of {fk.parent} are still referenced")
            elif fk.on_delete == "set_null":
                left = _cleared(left, gone[fk.parent], fk)
        out[t] = left
    return out


def _keys(parents: DataFrame, fk: ForeignKey) -> DataFrame:
    return parents.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_cols, fk.cols)]).distinct()


def _referring(child: DataFrame, parents: DataFrame, fk: ForeignKey) -> DataFrame:
    return child.join(_keys(parents, fk), list(fk.cols), "left_semi").select(*child.columns)


def _cleared(child: DataFrame, parents: DataFrame, fk: ForeignKey) -> DataFrame:
    types = dict(child.dtypes)
    flagged = child.join(_keys(parents, fk).withColumn("__gone", F.lit(True)), list(fk.cols), "left")
    return flagged.select(*[F.when(F.col("__gone").isNull(), F.col(c)).cast(types[c]).alias(c) if c in fk.cols
                            else F.col(c) for c in child.columns])
