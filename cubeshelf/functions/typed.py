"""Query-time typing: data stays text at rest, types are applied by the query.

`try_cast` gives null for dirty cells ('4680, 4690' as a number) instead of
failing the query, which plain CAST does under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .._compat import qcol


def typed_view(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Apply `try_cast` to the named columns, keep the others as they are."""
    return df.select([qcol(c).try_cast(types[c]).alias(c) if c in types else qcol(c) for c in df.columns])


def create_typed_view(spark, table: str, types: dict[str, str], view: str | None = None) -> str:
    """Register `<table>_typed` (or `view`): the table with `try_cast` applied
    to the named columns, every other column passed through. Returns the
    view name. The data at rest stays text."""
    view = view or f"{table}_typed"
    cols = spark.table(table).columns

    def q(n: str) -> str:
        return "`" + n.replace("`", "``") + "`"

    select = ", ".join(f"try_cast({q(c)} AS {types[c]}) AS {q(c)}" if c in types else q(c) for c in cols)
    target = ".".join(q(p) for p in view.split(".")) if "`" not in view else view
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT {select} FROM {table}")
    return view
