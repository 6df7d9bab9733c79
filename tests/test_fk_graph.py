"""Deletes over a graph of tables: cascades, cycles, cleared keys, refusals."""

import pytest
from pyspark.sql import functions as F

from tablekit.operators.fk_graph import delete_cascade
from tablekit.operators.quality import ConstraintViolation
from tablekit.spec import ForeignKey, TableSpec, col


def table(spark, name, rows, **refs):
    """Columns id and one for each foreign key: name=(parent, action)."""
    cols = ["id", *refs]
    fks = tuple(ForeignKey(f"fk_{c}", (c,), parent, ("id",), on_delete=action) for c, (parent, action) in refs.items())
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in cols))
    return df, TableSpec(name, tuple(col(c, "bigint") for c in cols), primary_key=("id",), foreign_keys=fks)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cycle_and_self_reference_end(spark):
    tables = {"a": table(spark, "a", [(1, 2), (2, 3), (3, None), (4, 5)], b=("b", "cascade")),
              "b": table(spark, "b", [(2, 2, 1), (3, 3, 2), (5, None, None), (6, 5, None)],
                         up=("b", "cascade"), a=("a", "cascade"))}
    left = delete_cascade(tables, "a", F.col("id") == 2)     # a2 -> b3, whose up is itself; a.b = 3 is a2 alone
    assert rows(left["a"]) == [(1, 2), (3, None), (4, 5)]
    assert sorted(map(str, left["b"].collect())) == sorted(map(str, tables["b"][0].filter("id <> 3").collect()))
    left = delete_cascade(tables, "a", F.col("id") == 1)     # a1 -> b2 -> a1 again
    assert [r.id for r in left["b"].orderBy("id").collect()] == [3, 5, 6]
    assert [r.id for r in left["a"].orderBy("id").collect()] == [2, 3, 4]


def test_mixed_actions_on_one_path(spark):
    tables = {"p": table(spark, "p", [(1,), (2,)]),
              "c": table(spark, "c", [(10, 1), (11, 2), (12, None)], p=("p", "cascade")),
              "n": table(spark, "n", [(20, 10, 1), (21, 11, 1), (22, None, None)], c=("c", "set_null"), p=("p", "set_null"))}
    left = delete_cascade(tables, "p", "id = 1")
    assert sorted(map(str, left["c"].collect())) == sorted(map(str, tables["c"][0].filter("id <> 10").collect()))
    assert {r.id: (r.c, r.p) for r in left["n"].collect()} == {20: (None, None), 21: (11, None), 22: (None, None)}


@pytest.mark.parametrize("action,raises", [("restrict", True), ("no_action", False)])
def test_a_reference_from_a_row_that_goes_too(spark, action, raises):
    tables = {"p": table(spark, "p", [(1,), (2,)]),
              "c": table(spark, "c", [(10, 1, 1), (11, 2, 2)], p=("p", "cascade"), q=("p", action))}
    if raises:
        with pytest.raises(ConstraintViolation):
            delete_cascade(tables, "p", "id = 1")
    else:
        assert rows(delete_cascade(tables, "p", "id = 1")["c"]) == [(11, 2, 2)]


def test_no_action_raises_for_rows_that_stay(spark):
    tables = {"p": table(spark, "p", [(1,)]), "c": table(spark, "c", [(10, 1)], p=("p", "no_action"))}
    with pytest.raises(ConstraintViolation):
        delete_cascade(tables, "p", "id = 1")
    assert rows(delete_cascade(tables, "p", "id = 7")["c"]) == [(10, 1)]
