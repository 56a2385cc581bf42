"""Column lists, document schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = "series_id"
TS = "ts"
LABEL_COL = "price"
MONTH = "part_month"
BATCH = "batch_month"

MARKET_COLS = ["price", "load_forecast", "wind_forecast", "solar_forecast"]
WEATHER_COLS = [
    "temperature_avg",
    "wind_speed_10m_avg",
    "wind_speed_80m_avg",
    "irradiance_avg",
]

# --- fixed values: they must equal the published definitions for right results ---
DISPLAY_TZ = "Europe/Stockholm"
PRICE_BOUNDS = (-500.0, 1000.0)
MAX_GAP_HOURS = 6
DEFAULT_GAP_HOURS = 3
OUTLIER_STD = 4.0
MAE_LIMIT = 8.0
HOLIDAYS = [
    "01-01",
    "01-06",
    "05-01",
    "06-06",
    "12-24",
    "12-25",
    "12-26",
    "12-31",
]
MORNING_PEAK = (7, 9)
EVENING_PEAK = (17, 20)
LAGS = [1, 24, 168]
ROLLING = [24, 168]
DIFFS = [1, 24]
SOLAR_TYPES = ["B16"]
WIND_TYPES = ["B18", "B19"]
LOCATIONS = [
    ("Stockholm", 59.33, 18.07, 0.4),
    ("Uppsala", 59.86, 17.64, 0.2),
    ("Västerås", 59.62, 16.55, 0.2),
    ("Norrköping", 58.59, 16.19, 0.2),
]
VALIDATION_SHARE = 0.15
TEST_SHARE = 0.2
TRAINING_DAYS = 180
BACKTEST_DAYS = 7
FORECAST_DAYS = 2
HISTOGRAM_BINS = 20
CHEAPEST = 4
# --- end of fixed values ---

TIME_FEATURES = [
    "hour",
    "day_of_week",
    "month",
    "day_of_year",
    "week_of_year",
    "is_weekend",
    "is_holiday",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
    "is_peak_morning",
    "is_peak_evening",
]
MARKET_FEATURES = [
    "residual_load",
    "renewable_ratio",
    "renewable_surplus",
    "load_stress",
]
INTERACTION_FEATURES = [
    "temp_load_interaction",
    "wind_efficiency",
    "hour_load_interaction",
]

_period = T.StructType(
    [
        T.StructField(
            "timeInterval",
            T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]),
        ),
        T.StructField("resolution", T.StringType()),
        T.StructField(
            "Point",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("position", T.IntegerType()),
                        T.StructField("price.amount", T.DoubleType()),
                        T.StructField("quantity", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)
TIME_SERIES_SCHEMA = T.StructType(
    [
        T.StructField("MktPSRType", T.StructType([T.StructField("psrType", T.StringType())])),
        T.StructField("Period", T.ArrayType(_period)),
    ]
)
WEATHER_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                    T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
                    T.StructField("wind_speed_80m", T.ArrayType(T.DoubleType())),
                    T.StructField("direct_normal_irradiance", T.ArrayType(T.DoubleType())),
                ]
            ),
        )
    ]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("predicted_price", T.DoubleType()),
        T.StructField("mode", T.StringType()),
        T.StructField("actual_price", T.DoubleType()),
        T.StructField("error", T.DoubleType()),
        T.StructField("abs_error", T.DoubleType()),
    ]
)
