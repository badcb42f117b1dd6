"""Table and document schemas, column lists and lookup values.

Every stored table carries ``series_id`` first: one measuring site is one series.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("series_id",)
DAY = "date"
HORIZON = 7
NUM_LAGS = 7
ROLLING = 7
TIME_ZONE = "Asia/Kolkata"
MODEL_NAME = "XGBoost_V1"

# Pollutants, and the weather columns in document order.
POLLUTANTS = ("pm25", "pm10", "o3", "no2", "so2", "co")
SUB_INDEXES = tuple(f"AQI_{p}" for p in POLLUTANTS)
WEATHER_COLUMNS = (
    "name", "tempmax", "tempmin", "temp", "feelslikemax", "feelslikemin", "feelslike",
    "dew", "humidity", "precip", "precipprob", "precipcover", "preciptype", "snow", "snowdepth",
    "windgust", "windspeed", "winddir", "sealevelpressure", "cloudcover", "visibility",
    "solarradiation", "solarenergy", "uvindex", "severerisk", "sunrise", "sunset", "moonphase",
    "conditions", "description", "icon", "stations",
)
WEATHER_TEXT = (
    "name", "preciptype", "sunrise", "sunset", "conditions", "description", "icon", "stations",
)
WEATHER_LISTS = ("preciptype", "stations")
WEATHER_NUMERIC = tuple(c for c in WEATHER_COLUMNS if c not in WEATHER_TEXT)

# The columns of the cleaned table.
CLEANED = (
    "date", "pm25", "pm10", "co", "no2", "so2", "o3", "AQI",
    "tempmax", "tempmin", "temp", "humidity", "dew",
    "windspeed", "winddir", "windgust", "precip", "cloudcover",
    "visibility", "sealevelpressure",
)
BASE_FEATURES = tuple(c for c in CLEANED if c not in ("date", "AQI", "precip"))
ENGINEERED_FEATURES = (
    "total_pollution", "aqi_cum_sum_7", "month", "is_summer", "is_winter",
    "pm25_co_interaction", "temp_humidity_interaction", "pm25_cumulative_sum_7",
    "pm25_no2_interaction", "pm25_so2_interaction",
)
LAG_FEATURES = tuple(f"lag_{i}_AQI" for i in range(1, NUM_LAGS + 1))
FEATURES = BASE_FEATURES + ENGINEERED_FEATURES + LAG_FEATURES
TARGETS = tuple(f"AQI_day_{i}" for i in range(1, HORIZON + 1))

# Concentration bands per pollutant (low, high), and the index range of each band.
INDEX_RANGES = ((0, 50), (51, 100), (101, 200), (201, 300), (301, 400), (401, 500))
BANDS = {
    "pm25": ((0, 30), (31, 60), (61, 90), (91, 120), (121, 250), (251, 500)),
    "pm10": ((0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (431, 600)),
    "o3": ((0, 50), (51, 100), (101, 168), (169, 208), (209, 748), (748, 1000)),
    "no2": ((0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (401, 800)),
    "so2": ((0, 40), (41, 80), (81, 380), (381, 800), (801, 1600), (1601, 3000)),
    "co": ((0, 1.0), (1.1, 2.0), (2.1, 10), (10.1, 17.0), (17.1, 34.0), (34.1, 50)),
}

# The order in which the table browser shows columns.
BROWSE_ORDER = (
    "date", "forecast_date", "predicted_date", "predicted_aqi", "model_name", "location",
    "pm25", "pm10", "o3", "no2", "so2", "co",
    "aqi_pm25", "aqi_pm10", "aqi_o3", "aqi_no2", "aqi_so2", "aqi_co", "aqi",
    "name", "tempmax", "tempmin", "temp", "feelslikemax", "feelslikemin", "feelslike",
    "dew", "humidity", "precip", "precipprob", "precipcover", "preciptype", "snow", "snowdepth",
    "windgust", "windspeed", "winddir", "sealevelpressure", "cloudcover", "visibility",
    "solarradiation", "solarenergy", "uvindex", "severerisk", "sunrise", "sunset",
    "moonphase", "conditions", "description", "icon", "stations",
    "timestamp", "mae", "rmse", "mape", "r2",
)

# Names shown to the user; a column not listed keeps its own name.
DISPLAY_NAMES = {
    "date": "Date",
    "aqi": "AQI",
    "aqi_pm25": "AQI PM2.5",
    "aqi_pm10": "AQI PM10",
    "aqi_co": "AQI CO",
    "aqi_no2": "AQI NO2",
    "aqi_o3": "AQI O3",
    "aqi_so2": "AQI SO2",
    "pm25": "PM2.5 (µg/m³)",
    "pm10": "PM10 (µg/m³)",
    "co": "Carbon Monoxide (CO)",
    "no2": "Nitrogen Dioxide (NO2)",
    "o3": "Ozone (O3)",
    "so2": "Sulfur Dioxide (SO2)",
    "conditions": "Conditions",
    "description": "Description",
    "cloudcover": "Cloud Cover",
    "dew": "Dew Point",
    "feelslike": "Feels Like",
    "feelslikemax": "Feels Like (Max)",
    "feelslikemin": "Feels Like (Min)",
    "humidity": "Humidity (%)",
    "temp": "Temperature (°C)",
    "tempmax": "Max Temperature (°C)",
    "tempmin": "Min Temperature (°C)",
    "timestamp": "Timestamp",
    "icon": "Weather Icon",
    "moonphase": "Moon Phase",
    "name": "Location Name",
    "precip": "Precipitation (mm)",
    "precipcover": "Precipitation Cover (%)",
    "precipprob": "Precipitation Probability (%)",
    "preciptype": "Precipitation Type",
    "sealevelpressure": "Sea Level Pressure (hPa)",
    "severerisk": "Severe Risk",
    "snow": "Snow (mm)",
    "snowdepth": "Snow Depth (cm)",
    "solarenergy": "Solar Energy (kWh/m²)",
    "solarradiation": "Solar Radiation (W/m²)",
    "stations": "Weather Stations",
    "sunrise": "Sunrise Time",
    "sunset": "Sunset Time",
    "uvindex": "UV Index",
    "visibility": "Visibility (km)",
    "winddir": "Wind Direction (°)",
    "windgust": "Wind Gust (km/h)",
    "windspeed": "Wind Speed (km/h)",
    "predicted_date": "Predicted Date",
    "predicted_aqi": "Predicted AQI",
    "model_name": "Model Name",
    "location": "Location",
    "mae": "Mean Absolute Error",
    "rmse": "Root Mean Square Error",
    "mape": "Mean Absolute Percentage Error",
    "r2": "R² Score",
}


def _fields(names, dtype) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names]


def _weather_fields() -> list[T.StructField]:
    return [
        T.StructField(c, T.StringType() if c in WEATHER_TEXT else T.DoubleType())
        for c in WEATHER_COLUMNS
    ]


_ID = [T.StructField("series_id", T.StringType()), T.StructField("date", T.DateType())]
_POLLUTANT_FIELDS = _fields((*POLLUTANTS, *SUB_INDEXES, "AQI"), T.DoubleType())

WEATHER = T.StructType(_ID + _weather_fields())
POLLUTANT = T.StructType(_ID + _POLLUTANT_FIELDS)
RAW = T.StructType(_ID + _weather_fields() + _POLLUTANT_FIELDS)
CLEANED_TABLE = T.StructType(_ID + _fields([c for c in CLEANED if c != "date"], T.DoubleType()))
FORECAST = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("forecast_date", T.DateType()),
    T.StructField("predicted_date", T.DateType()),
    T.StructField("predicted_aqi", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("location", T.StringType()),
])
EVALUATION = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("eval_date", T.DateType()),
    *_fields(("mae", "r2", "rmse", "mape"), T.DoubleType()),
])

TABLES = {
    "weather_data": WEATHER,
    "pollutant_data": POLLUTANT,
    "raw_data": RAW,
    "cleaned_data": CLEANED_TABLE,
    "aqi_forecast": FORECAST,
    "model_evaluation": EVALUATION,
}
TABLE_KEYS = {
    "weather_data": ("series_id", "date"),
    "pollutant_data": ("series_id", "date"),
    "raw_data": ("series_id", "date"),
    "cleaned_data": ("series_id", "date"),
    "aqi_forecast": ("series_id", "forecast_date", "predicted_date"),
    "model_evaluation": ("series_id", "eval_date"),
}
# The column a date range filters on, and the one the store partitions by month.
DATE_COLUMN = {
    "weather_data": "date",
    "pollutant_data": "date",
    "raw_data": "date",
    "cleaned_data": "date",
    "aqi_forecast": "forecast_date",
    "model_evaluation": "timestamp",
}
PARTITION_COLUMN = {**DATE_COLUMN, "model_evaluation": "eval_date"}

# Landed documents. ``series_id`` may be a document field or a ``series_id=...`` directory;
# ``fetched_at`` is the moment of the fetch.
_DOCUMENT_HEAD = [
    T.StructField("series_id", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
]
WEATHER_DOCUMENT = T.StructType(_DOCUMENT_HEAD + [
    T.StructField("resolvedAddress", T.StringType()),
    T.StructField("days", T.ArrayType(T.StructType(
        [T.StructField("datetime", T.StringType())]
        + [
            T.StructField(
                c,
                T.ArrayType(T.StringType()) if c in WEATHER_LISTS
                else T.StringType() if c in WEATHER_TEXT
                else T.DoubleType(),
            )
            for c in WEATHER_COLUMNS if c != "name"
        ]
    ))),
])
POLLUTANT_DOCUMENT = T.StructType(_DOCUMENT_HEAD + [
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.DoubleType()),
        T.StructField("iaqi", T.StructType([
            T.StructField(p, T.StructType([T.StructField("v", T.DoubleType())]))
            for p in POLLUTANTS
        ])),
    ])),
])
