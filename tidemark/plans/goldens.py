"""Queries over inline rows whose answers are known: the operators that no SQL engine has a twin for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.registry import ORACLES, QUERIES


def _sql(v, like=()) -> str:
    """A value as a DuckDB literal; a null has the type of the other values of its column."""
    if v is None:
        kind = next((type(x) for x in like if x is not None), str)
        return f"CAST(NULL AS {({bool: 'BOOLEAN', float: 'DOUBLE', int: 'BIGINT'}).get(kind, 'VARCHAR')})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, int):
        return f"CAST({v} AS BIGINT)"
    if isinstance(v, (list, tuple)):
        return "'" + "|".join(v).replace("'", "''") + "'"
    return "'" + v.replace("'", "''") + "'"


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as joined texts and integers as longs, so that results are alike on both engines."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        out.append((F.array_join(c, "|") if kind == "array<string>" else c.cast("long") if kind == "int" else c).alias(name))
    return df.select(*out)


def golden(name: str, inputs: list[str], cases: list[tuple], make: Callable[..., Column | dict[str, Column]], outputs: list[str] = ["result"]) -> None:  # noqa: B006
    """``make`` applied to rows of text inputs; the values after the inputs are what it must give."""
    n = len(inputs)

    def run(spark, sf_dir):
        rows = spark.createDataFrame([(i, *c[:n]) for i, c in enumerate(cases)], "case_no long, " + ", ".join(f"`{x}` {'string' if not any(isinstance(c[k], (int, float)) and not isinstance(c[k], bool) for c in cases) else 'double'}" for k, x in enumerate(inputs)))
        got = make(*[F.col(x) for x in inputs])
        got = got if isinstance(got, dict) else {outputs[0]: got}
        return _flat(rows.select("case_no", *[got[o].alias(o) for o in outputs]))

    if name in QUERIES:
        raise ValueError(name)
    QUERIES[name] = run
    ORACLES[name] = "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join([f"CAST({i} AS BIGINT)", *[_sql(v, [o[n + k] for o in cases]) for k, v in enumerate(c[n:])]]) + ")" for i, c in enumerate(cases)) + f") t(case_no, {', '.join(outputs)})"
