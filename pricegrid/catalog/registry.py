"""Registering queries and writing their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


# Both engines add doubles in their own order and break decimal ties their own
# way, so a value half way between two roundings is first moved off the tie.
DIGITS, NUDGE = 6, 1e-9


def comparable(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles with six decimals and instants without zone, as the twins have them."""
    cols = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            cols.append(f"round(CAST(`{name}` AS DOUBLE) + {NUDGE}D, {digits}) + 0.0D AS `{name}`")
        elif kind == "timestamp":
            cols.append(f"CAST(`{name}` AS TIMESTAMP_NTZ) AS `{name}`")
        else:
            cols.append(f"`{name}`")
    return df.selectExpr(*cols)


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    def keep(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(spark, sf_dir), digits)

        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return build

    return keep


def rounded(expression: str, name: str, digits: int = DIGITS) -> str:
    return f"round({expression} + {NUDGE:.9f}::DOUBLE, {digits}) + 0.0 AS {name}"


def shown(columns: str, digits: int = DIGITS) -> str:
    """Select list; a leading ``~`` marks a double to be rounded."""
    out = []
    for c in columns.replace("\n", " ").split(","):
        c = c.strip()
        out.append(rounded(c[1:], c[1:], digits) if c.startswith("~") else c)
    return ", ".join(out)


def twin(columns: str, source: str, *ctes: str, where: str = "", digits: int = DIGITS) -> str:
    """``WITH ctes SELECT columns FROM source``."""
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    tail = f"\nWHERE {where}" if where else ""
    return f"{head}SELECT {shown(columns, digits)} FROM {source}{tail}"
