"""Month-partitioned feature tables on Parquet: write, read, upsert, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.functions.timezones import month_id
from pricegrid.operators.dedupe import keep_latest
from pricegrid.operators.market import join_weather
from pricegrid.schemas import BATCH, MONTH, SERIES, TS
from pricegrid.session import staged_while
from pricegrid.sources import versions


def table_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}_v{version}"


def with_month(df: DataFrame, ts_col: str = TS) -> DataFrame:
    """The month folder of each row, always by its instant in UTC."""
    return df.withColumn(MONTH, month_id(ts_col))


def as_double(df: DataFrame, skip: Sequence[str] = (SERIES, TS, MONTH)) -> DataFrame:
    """Store form of a feature table: every numeric column as double, NaN as null."""
    numeric = ("int", "bigint", "smallint", "tinyint", "float", "decimal", "double")
    casts = {
        c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        for c, t in df.dtypes
        if c not in skip and t.startswith(numeric)
    }
    return df.withColumns(casts) if casts else df


def write_months(
    df: DataFrame, path: str, sort_cols: Sequence[str] = (SERIES, TS), ts_col: str = TS
) -> None:
    """Replace the months present in ``df``; other months stay untouched.

    The month is that of the instant in UTC, whatever month column the rows bring, so
    that a range in instants finds all its rows; ``read_months`` prunes by the same rule.

    Rows are rebalanced by month, which splits a large month over several
    tasks and merges small ones, and sorted for row-group statistics. A table made by
    ``versions.create`` gets a new version, any other one has its folders replaced.
    """
    months = with_month(df, ts_col).drop(BATCH)
    order = [c for c in sort_cols if c in months.columns]
    if versions.is_published(df.sparkSession, path):
        versions.publish(months, path, versions.pinned(df.sparkSession, path), order)
        return
    (
        months.hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None before its first write."""
    if versions.is_published(spark, path):
        return versions.read_version(spark, path)
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_months(
    spark: SparkSession,
    path: str,
    start=None,
    end=None,
    months: Sequence[str] | None = None,
    ts_col: str = TS,
    version: int | None = None,
) -> DataFrame:
    """Table rows of the closed range, pruned by month folder and by instant.

    A predicate on the instant alone does not prune folders, so the matching
    months are added (in UTC, as written by ``write_months``). A published table is
    read as of its latest version or the one given, whatever is published afterwards.
    """
    if versions.is_published(spark, path):
        df = versions.read_version(spark, path, version)
        if df is None:
            raise ValueError(f"nothing is published at {path}")
    elif version is not None:
        raise ValueError(f"{path} keeps no versions")
    else:
        df = spark.read.parquet(path)
    if months is not None:
        df = df.where(F.col(MONTH).isin(list(months)))
    if start is not None:
        lit = F.lit(start).cast("timestamp")
        df = df.where((F.col(MONTH) >= month_id(lit)) & (F.col(ts_col) >= lit))
    if end is not None:
        lit = F.lit(end).cast("timestamp")
        df = df.where((F.col(MONTH) <= month_id(lit)) & (F.col(ts_col) <= lit))
    return df


def upsert(
    df: DataFrame,
    path: str,
    key_cols: Sequence[str] = (SERIES, TS),
    version_col: str = "ingest_ts",
    ts_col: str = TS,
) -> None:
    """Insert rows, keeping the latest version per key; repeatable.

    A row without version, or from a table stored without that column, is older than
    any version; on equal versions the incoming row replaces the stored one. A key
    that repeats within one delivery and version keeps any one of its rows, whole.

    Only the months of the incoming rows are read and rewritten. The delivery is
    written to the shared folder first, so its plan runs once, and removed at the end.
    The names of its months are the one thing collected, one short string per month.

    A table made by ``versions.create`` gets a new version: readers keep the one they
    opened, a job that dies changes nothing, and if another writer has published one of
    these months meanwhile, the delivery is merged again with what is stored then.
    """
    spark = df.sparkSession
    with staged_while(with_month(df, ts_col).drop(BATCH), "delivery") as incoming:
        if not versions.is_published(spark, path):
            stored = stored_table(spark, path)
            touched = _months_of(incoming) if stored is not None else []
            latest = _latest(incoming, stored, touched, key_cols, version_col)
            write_months(latest, path, key_cols, ts_col)
            return
        touched = _months_of(incoming)
        while True:
            base = versions.pinned(spark, path)
            stored = versions.read_version(spark, path, base, touched)
            latest = _latest(incoming, stored, touched, key_cols, version_col)
            try:
                versions.publish(latest, path, base, key_cols, touched)
                return
            except versions.Superseded:
                continue


def _months_of(rows: DataFrame) -> list[str]:
    return [r[0] for r in rows.select(_folder_month()).distinct().collect()]


def _folder_month():
    """The month as its folder spells it; rows without an instant have a folder too."""
    return F.coalesce(F.col(MONTH), F.lit(versions.NO_MONTH))


def _latest(
    incoming: DataFrame, stored: DataFrame | None, touched: list[str], key_cols: Sequence[str], version_col: str
) -> DataFrame:
    """The delivery merged with the stored rows of its months."""
    rows = incoming.withColumn("__arrival", F.lit(1))
    if version_col not in rows.columns:
        kept = stored is not None and version_col in stored.columns
        kind = stored.schema[version_col].dataType if kept else "timestamp"
        rows = rows.withColumn(version_col, F.lit(None).cast(kind))
    if stored is not None:
        old = stored.where(_folder_month().isin(touched)).withColumn("__arrival", F.lit(0))
        rows = old.unionByName(rows, allowMissingColumns=True)
    return keep_latest(rows, [*key_cols, MONTH], [version_col, "__arrival"]).drop("__arrival")


def read_groups(
    spark: SparkSession,
    market_path: str,
    weather_path: str,
    start=None,
    end=None,
    keys: Sequence[str] = (SERIES, TS),
) -> DataFrame:
    """Market joined with weather over a range; both sides are cut first."""
    market = read_months(spark, market_path, start, end)
    weather = read_months(spark, weather_path, start, end).drop(MONTH)
    return join_weather(market, weather, keys, "inner")


def feature_view(df: DataFrame, name: str, label: str = "price") -> tuple[DataFrame, str]:
    """Register a joined or engineered table under a name, with its label."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name), label


def read_view(spark: SparkSession, name: str, start=None, end=None, ts_col: str = TS) -> DataFrame:
    df = spark.table(name)
    if start is not None:
        df = df.where(F.col(ts_col) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(ts_col) <= F.lit(end).cast("timestamp"))
    return df


def pair_months(market: DataFrame, weather: DataFrame) -> DataFrame:
    """Months present in both tables, with row counts, matched by name."""
    left = market.groupBy(MONTH).agg(F.count(F.lit(1)).alias("market_rows"))
    right = weather.groupBy(MONTH).agg(F.count(F.lit(1)).alias("weather_rows"))
    return left.join(right, MONTH)
