"""Column lists and table schemas."""

from pyspark.sql import types as T

# The measures of the raw hourly table.
WEATHER_INTEGERS = [
    "tempF", "windspeedMiles", "weatherCode", "humidity", "visibility", "visibilityMiles",
    "pressure", "pressureInches", "cloudcover", "HeatIndexC", "HeatIndexF", "DewPointC",
    "DewPointF", "WindChillC", "WindChillF", "WindGustMiles", "WindGustKmph", "FeelsLikeC",
    "FeelsLikeF", "uvIndex",
]
WEATHER_DOUBLES = ["precipMM", "precipInches"]
TEXT_COLUMNS = ["subba-name", "value-units", "zone"]
SERIES_KEY = ["zone", "datetime"]

# Rolling and lag features.
ROLLED = ["tempF", "windspeedMiles", "humidity"]
WINDOW_ROWS = 6
LAGS = [2, 4, 6]

# The 32 columns of the preprocessed table.
FINAL_COLUMNS = [
    "datetime", "precipMM", "weatherCode", "visibility", "HeatIndexF", "WindChillF",
    "windspeedMiles", "FeelsLikeF", "tempF_rolling_mean", "windspeedMiles_rolling_mean",
    "humidity_rolling_mean", "value", "pressure", "pressureInches", "cloudcover", "uvIndex",
    "tempF_rolling_std", "windspeedMiles_rolling_std", "humidity_rolling_std",
    "tempF_lag_2", "windspeedMiles_lag_2", "humidity_lag_2",
    "tempF_lag_4", "windspeedMiles_lag_4", "humidity_lag_4",
    "tempF_lag_6", "windspeedMiles_lag_6", "humidity_lag_6",
    "month_sin", "month_cos", "subba-name", "zone",
]

MODEL_LABEL = "value"
# Served features are the final measures; training adds the name of the area.
MODEL_FEATURES = [
    c for c in FINAL_COLUMNS if c not in ("datetime", MODEL_LABEL, "subba-name", "zone")
]
TRAINING_FEATURES = [*MODEL_FEATURES, "subba-name"]

# Columns that must not be negative: the final measures except the weather code and the
# cyclic month pair.
NON_NEGATIVE = [
    c for c in FINAL_COLUMNS
    if c not in ("datetime", "weatherCode", "month_sin", "month_cos", "subba-name", "zone")
]

# Columns never rescaled by min-max.
NOT_SCALED = {"month_sin", "month_cos", "zone", "datetime", "datetime_1", "subba-name"}

# Columns watched by the drift report.
DRIFT_COLUMNS = [
    "tempF", "precipMM", "humidity", "visibility", "pressure", "HeatIndexF", "DewPointF",
    "WindChillF", "WindGustMiles", "uvIndex", "value",
]

RAW_SCHEMA = T.StructType(
    [T.StructField("datetime", T.TimestampNTZType())]
    + [T.StructField(c, T.LongType()) for c in WEATHER_INTEGERS]
    + [T.StructField(c, T.DoubleType()) for c in WEATHER_DOUBLES]
    + [T.StructField("value", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
)

# Landed demand payload: response.total, response.data[].
DEMAND_ROW = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "period", "subba", "subba-name", "parent", "parent-name", "value", "value-units",
        )
    ]
)
DEMAND_PAYLOAD = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("total", T.StringType()),
                    T.StructField("data", T.ArrayType(DEMAND_ROW)),
                ]
            ),
        )
    ]
)

# Landed weather payload: data.weather[].hourly[]; every measure arrives as text.
_LABELS = T.ArrayType(T.StructType([T.StructField("value", T.StringType())]))
# Fields of an hour that are not kept.
DROPPED_WEATHER = [
    "time", "tempC", "windspeedKmph", "weatherIconUrl", "weatherDesc", "winddirDegree",
    "winddir16Point",
]
WEATHER_HOUR = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["time", *WEATHER_INTEGERS, *WEATHER_DOUBLES]]
    + [
        T.StructField(c, T.StringType())
        for c in ("tempC", "windspeedKmph", "winddirDegree", "winddir16Point")
    ]
    + [T.StructField("weatherIconUrl", _LABELS), T.StructField("weatherDesc", _LABELS)]
)
WEATHER_DAY = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("hourly", T.ArrayType(WEATHER_HOUR)),
    ]
)
WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "data", T.StructType([T.StructField("weather", T.ArrayType(WEATHER_DAY))])
        )
    ]
)

# Geocoder answer: results[].geometry.{lat,lng}.
GEOCODE_PAYLOAD = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField("lat", T.DoubleType()),
                                    T.StructField("lng", T.DoubleType()),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)
