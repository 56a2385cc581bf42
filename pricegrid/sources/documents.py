"""Market documents (XML) and weather documents (JSON) to hourly rows.

Each kind has a reader for landed files and a flattening step that also takes a
column of parsed documents, so text from any table or stream can be used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions.timezones import local_to_utc, occurrences, position_time
from pricegrid.operators.dedupe import keep_latest
from pricegrid.operators.market import generation_by_type
from pricegrid.schemas import (
    DISPLAY_TZ,
    LOCATIONS,
    SERIES,
    SOLAR_TYPES,
    TIME_SERIES_SCHEMA,
    TS,
    WEATHER_DOCUMENT_SCHEMA,
    WIND_TYPES,
)

# --- fixed values: document formats ---
START_FORMAT = "yyyy-MM-dd'T'HH:mmX"
LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm"
RESOLUTION_PATTERN = r"^PT([0-9]+)M$"
# minutes per step, by kind of document, where the resolution is not listed
PRICE_STEPS = {"PT60M": 60, "PT15M": 15}
PRICE_OTHER = 60
QUANTITY_STEPS = {"PT60M": 60}
QUANTITY_OTHER = 15
# --- end of fixed values ---

READINGS = ["temperature_2m", "wind_speed_10m", "wind_speed_80m", "irradiance"]
ORDER = ["__delivered", "__file", "__row", "__period", "__point"]


def read_time_series(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per TimeSeries element of the XML files, with its origin."""
    return (
        spark.read.format("xml")
        .option("rowTag", "TimeSeries")
        .schema(TIME_SERIES_SCHEMA)
        .load(path)
        .select(
            "MktPSRType",
            "Period",
            F.col("_metadata.file_modification_time").alias("__delivered"),
            F.col("_metadata.file_path").alias("__file"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )


def parse_time_series(
    df: DataFrame, text_col: str, file_col: str, row_col: str, keep: Sequence[str] = (SERIES,)
) -> DataFrame:
    """The same from a text column holding one TimeSeries element per row.

    The file column names the delivery; later names are later deliveries.
    """
    schema = TIME_SERIES_SCHEMA.simpleString().replace("price.amount", "`price.amount`")
    parsed = F.from_xml(F.col(text_col), schema)
    return df.select(
        *keep,
        F.lit(None).cast("timestamp").alias("__delivered"),
        F.col(file_col).cast("string").alias("__file"),
        F.col(row_col).cast("long").alias("__row"),
        parsed.alias("__doc"),
    ).select(*keep, "__delivered", "__file", "__row", "__doc.MktPSRType", "__doc.Period")


def rejected_documents(series: DataFrame) -> DataFrame:
    """Elements that gave no period: text that does not parse, or nothing in it.

    From ``read_time_series`` or ``parse_time_series``; ``points`` has no row of them.
    """
    return series.where(F.col("Period").isNull() | (F.size("Period") == 0)).select("__file", "__row")


def required(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error if it has no row at all."""
    if df.isEmpty():
        raise ValueError(f"no data in {what}")
    return df


def _number(name: str) -> Column:
    """A value of a document; both formats can spell NaN, which is missing here."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def points(series: DataFrame) -> DataFrame:
    """One row per Point with period start, resolution and arrival order."""
    origin = [c for c in series.columns if c not in ("MktPSRType", "Period")]
    periods = series.select(
        *origin,
        F.col("MktPSRType.psrType").alias("psr_type"),
        F.posexplode("Period").alias("__period", "p"),
    )
    return periods.select(
        *origin,
        "psr_type",
        "__period",
        F.try_to_timestamp(F.col("p.timeInterval.start"), F.lit(START_FORMAT)).alias("start"),
        F.col("p.resolution").alias("resolution"),
        F.posexplode("p.Point").alias("__point", "q"),
    ).select(
        *origin,
        "psr_type",
        "__period",
        "__point",
        "start",
        "resolution",
        F.col("q.position").alias("position"),
        _number("q.`price.amount`").alias("price"),
        _number("q.quantity").alias("quantity"),
    )


def step_minutes(kind: str, strict: bool = False) -> Column:
    """Minutes per position. ``strict`` reads any PTnnM and rejects the rest."""
    resolution = F.col("resolution")
    if strict:
        found = F.regexp_extract(resolution, RESOLUTION_PATTERN, 1)
        return F.when(found != "", found.cast("int"))
    steps, other = (
        (PRICE_STEPS, PRICE_OTHER) if kind == "price" else (QUANTITY_STEPS, QUANTITY_OTHER)
    )
    out = F.when(resolution.isNull(), 60)
    for name, minutes in steps.items():
        out = out.when(resolution == name, minutes)
    return out.otherwise(other)


def _timed(pts: DataFrame, kind: str, value_col: str, strict: bool) -> DataFrame:
    """Points with an instant. Incomplete ones are dropped; see ``rejected``."""
    return (
        pts.withColumn("__step", step_minutes(kind, strict))
        .where(
            F.col("start").isNotNull()
            & F.col("position").isNotNull()
            & F.col(value_col).isNotNull()
            & F.col("__step").isNotNull()
        )
        .withColumn(TS, position_time("start", "position", "__step"))
    )


def rejected(pts: DataFrame, kind: str, strict: bool = True) -> DataFrame:
    """Points without start, position, value or usable resolution."""
    value_col = "price" if kind == "price" else "quantity"
    return pts.withColumn("__step", step_minutes(kind, strict)).where(
        F.col("start").isNull()
        | F.col("position").isNull()
        | F.col(value_col).isNull()
        | F.col("__step").isNull()
    ).drop("__step")


def _keys(pts: DataFrame) -> list[str]:
    return [SERIES, TS] if SERIES in pts.columns else [TS]


def _newest(timed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each instant the latest delivery, and of that document the first point."""
    order = timed.withColumns({f"__back{k}": -F.col(c) for k, c in enumerate(ORDER[2:])})
    return keep_latest(order, keys, [*ORDER[:2], "__back0", "__back1", "__back2"])


def price_rows(pts: DataFrame, strict: bool = False) -> DataFrame:
    """Prices; the latest delivery of an instant counts, and the first point in it."""
    keys = _keys(pts)
    timed = _timed(pts, "price", "price", strict).select(*keys, "price", *ORDER)
    return _newest(timed, keys).select(*keys, "price")


def load_rows(pts: DataFrame, strict: bool = False) -> DataFrame:
    """Loads; the latest delivery of an instant counts, and the first point in it."""
    keys = _keys(pts)
    timed = _timed(pts, "quantity", "quantity", strict).select(
        *keys, F.col("quantity").alias("load_forecast"), *ORDER
    )
    return _newest(timed, keys).select(*keys, "load_forecast")


def generation_rows(pts: DataFrame, strict: bool = False) -> DataFrame:
    """Wind and solar sums; other types are dropped.

    Points of one instant and type add up inside a file. A file delivered again
    replaces the earlier one for the instants and types it has, and adds nothing.
    """
    keys = _keys(pts)
    wanted = pts.where(F.col("psr_type").isin([*WIND_TYPES, *SOLAR_TYPES]))
    per_file = (
        _timed(wanted, "quantity", "quantity", strict)
        .groupBy(*keys, "psr_type", "__delivered", "__file")
        .agg(F.sum("quantity").alias("quantity"))
    )
    return generation_by_type(keep_latest(per_file, [*keys, "psr_type"], ["__delivered", "__file"]), keys)


def with_series(df: DataFrame, path_pattern: str) -> DataFrame:
    """Series name from the file path, by the first group of a pattern."""
    return df.withColumn(SERIES, F.regexp_extract("__file", path_pattern, 1))


def read_weather_documents(
    spark: SparkSession, path: str | Sequence[str], location_pattern: str = r"([^/]+)\.json$"
) -> DataFrame:
    """One row per JSON file named by location: its readings, or the text that is no document."""
    schema = T.StructType([*WEATHER_DOCUMENT_SCHEMA.fields, T.StructField("__broken", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "__broken")
        .json(path)
        .select(
            F.regexp_extract(
                F.url_decode(F.col("_metadata.file_path")), location_pattern, 1
            ).alias("location"),
            "hourly",
            "__broken",
            F.col("_metadata.file_modification_time").alias("__delivered"),
            F.col("_metadata.file_path").alias("__file"),
        )
    )


def read_weather(
    spark: SparkSession, path: str | Sequence[str], location_pattern: str = r"([^/]+)\.json$"
) -> DataFrame:
    """One row per location and instant; files that do not parse are in ``rejected_weather``."""
    return weather_rows(read_weather_documents(spark, path, location_pattern))


def parse_weather_documents(
    df: DataFrame, text_col: str, keep: Sequence[str] = (SERIES, "location"), file_col: str | None = None
) -> DataFrame:
    """The same from a text column holding one document per row.

    The file column names the delivery; later names are later deliveries.
    """
    schema = T.StructType([*WEATHER_DOCUMENT_SCHEMA.fields, T.StructField("__broken", T.StringType())])
    doc = F.from_json(F.col(text_col), schema, {"columnNameOfCorruptRecord": "__broken"})
    file = F.col(file_col).cast("string") if file_col else F.lit(None).cast("string")
    rows = df.select(*keep, doc.alias("d"), F.col(text_col).alias("t"), file.alias("__file"))
    return rows.select(
        *keep,
        "d.hourly",
        F.coalesce("d.__broken", F.when(F.col("d.hourly").isNull(), F.coalesce("t", F.lit("")))).alias("__broken"),
        F.lit(None).cast("timestamp").alias("__delivered"),
        "__file",
    )


def parse_weather(
    df: DataFrame, text_col: str, keep: Sequence[str] = (SERIES, "location"), file_col: str | None = None
) -> DataFrame:
    return weather_rows(parse_weather_documents(df, text_col, keep, file_col))


def rejected_weather(docs: DataFrame) -> DataFrame:
    """Documents without readings: text that does not parse, or no times in it.

    From ``read_weather_documents`` or ``parse_weather_documents``; ``weather_rows`` has
    no row of them.
    """
    times = F.col("hourly.time")
    return docs.where(times.isNull() | (F.size(times) == 0)).drop("hourly")


def weather_rows(docs: DataFrame, zone: str = DISPLAY_TZ) -> DataFrame:
    """Parallel arrays to rows, one per key and instant; local hours become instants.

    A repeated local hour in autumn is told by the order in its document: the second
    one is the later instant. Where it stands there only once its row is left out, as
    either instant may be meant. Of several deliveries of an instant the latest counts.
    """
    origin = [c for c in ("__delivered", "__file") if c in docs.columns]
    keep = [c for c in docs.columns if c not in ("hourly", "__broken", *origin)]
    times = F.col("hourly.time")

    def parsed(time: Column) -> Column:
        return F.to_timestamp_ntz(time, F.lit(LOCAL_FORMAT))

    zipped = F.arrays_zip(
        times.alias("time"),
        F.col("hourly.temperature_2m").alias("temperature_2m"),
        F.col("hourly.wind_speed_10m").alias("wind_speed_10m"),
        F.col("hourly.wind_speed_80m").alias("wind_speed_80m"),
        F.col("hourly.direct_normal_irradiance").alias("irradiance"),
        occurrences(times, parsed, zone).alias("__nth"),
    )
    first = local_to_utc(parsed(F.col("time")), zone)
    rows = (
        docs.select(*keep, *origin, F.inline(zipped))
        .where("__nth IS NOT NULL")
        .withColumn(TS, first + F.make_dt_interval(hours=F.col("__nth")))
        .withColumns({c: _number(c) for c in READINGS})
        .select(*keep, *origin, TS, *READINGS)
    )
    return keep_latest(rows, [*keep, TS], origin or [TS]).select(*keep, *READINGS, TS)


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A table of constants whose size the optimizer knows.

    A frame made from a Python list counts as unboundedly large, so a join with
    it would shuffle the other side; one made of literals is measured.
    """

    def text(value) -> str:
        return f"{value}D" if isinstance(value, float) else "'" + str(value).replace("'", "\\'") + "'"

    values = ", ".join(f"({', '.join(text(v) for v in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def default_locations(spark: SparkSession) -> DataFrame:
    return literal_table(spark, LOCATIONS, ["location", "lat", "lon", "weight"])
