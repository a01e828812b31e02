"""Fixed values that results depend on. Kept together, in natural order."""

# --- fixed values: the five cities of the platform ------------------------
EXPECTED_CITIES = ["ha-noi", "ho-chi-minh-city", "da-nang", "gia-lai", "cao-bang"]

# --- fixed values: AQI level ladder (upper bound inclusive, label) --------
AQI_LEVELS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_TOP_LEVEL = "Hazardous"

# --- fixed values: AQI scale bounds used by the range check ---------------
AQI_MIN, AQI_MAX = 0, 500

# --- fixed values: city keywords in station names (ETL table, case-sensitive)
CITY_KEYWORDS_ETL = {
    "ho-chi-minh-city": ["Ho Chi Minh", "Hồ Chí Minh"],
    "ha-noi": ["Hanoi", "Hà Nội"],
    "da-nang": ["Da Nang", "Đà Nẵng"],
    "gia-lai": ["Gia Lai"],
    "cao-bang": ["Cao Bằng"],
}

# --- fixed values: city keywords, analysis spelling (matched lower-cased) --
CITY_KEYWORDS_ANALYSIS = {
    "ha-noi": ["hanoi", "hà nội", "ha noi"],
    "ho-chi-minh-city": ["ho chi minh", "hồ chí minh"],
    "da-nang": ["da nang", "đà nẵng"],
    "gia-lai": ["gia lai", "pleiku"],
    "cao-bang": ["cao bằng", "cao bang"],
}

# --- fixed values: URL slug aliases ---------------------------------------
URL_CITY_ALIASES = {
    "hanoi": "ha-noi",
    "ho-chi-minh-city": "ho-chi-minh-city",
    "da-nang": "da-nang",
    "gia-lai": "gia-lai",
    "cao-bang": "cao-bang",
}
URL_CITY_PATTERN = r"/city/vietnam/([^/]+)/"

# --- fixed values: display labels of city slugs ---------------------------
CITY_LABELS = {
    "ha-noi": "Ha Noi",
    "ho-chi-minh-city": "Ho Chi Minh City",
    "gia-lai": "Gia Lai",
    "quang-ninh": "Quang Ninh",
    "thua-thien-hue": "Thua Thien Hue",
    "bac-ninh": "Bac Ninh",
    "lao-cai": "Lao Cai",
    "da-nang": "Da Nang",
    "cao-bang": "Cao Bang",
}

# --- fixed values: map coordinates (lat, lon) of city slugs ---------------
CITY_COORDS = {
    "ha-noi": (21.0285, 105.8542),
    "ho-chi-minh-city": (10.8231, 106.6297),
    "gia-lai": (13.9833, 108.0),
    "quang-ninh": (21.0064, 107.2925),
    "thua-thien-hue": (16.4637, 107.5909),
    "bac-ninh": (21.1861, 106.0763),
    "lao-cai": (22.4856, 103.9754),
    "da-nang": (16.0544, 108.2022),
    "cao-bang": (22.6667, 106.25),
}

# --- fixed values: display labels of the daily forecast's features --------
FEATURE_LABELS = {
    "aqi_lag_1d": "AQI lag 1 day",
    "aqi_lag_2d": "AQI lag 2 days",
    "aqi_lag_3d": "AQI lag 3 days",
    "aqi_lag_5d": "AQI lag 5 days",
    "aqi_lag_7d": "AQI lag 7 days",
    "aqi_roll_mean_3d": "Rolling avg 3d",
    "aqi_roll_std_3d": "Rolling std 3d",
    "aqi_roll_mean_7d": "Rolling avg 7d",
    "aqi_roll_std_7d": "Rolling std 7d",
    "aqi_roll_mean_14d": "Rolling avg 14d",
    "aqi_diff_1d": "AQI change 1d",
    "pm25": "PM2.5",
    "pm10": "PM10",
    "temperature": "Temperature",
    "humidity": "Humidity",
    "pressure": "Pressure",
    "wind": "Wind speed",
    "month_sin": "Month (sin)",
    "month_cos": "Month (cos)",
    "dow_sin": "Day-of-week (sin)",
    "dow_cos": "Day-of-week (cos)",
    "is_weekend": "Is weekend",
    "is_dry_season": "Dry season",
}

# --- fixed values: junk tokens that mean "no value" in raw text -----------
NULL_TOKENS = ["-", "", "#NAME?", "N/A"]

# --- fixed values: invalid pollutant categories ---------------------------
INVALID_POLLUTANTS = ["aqi", ""]

# --- fixed values: accepted provenance sources ----------------------------
VALID_SOURCES = ["kaggle", "api"]

# --- fixed values: dry season months (Nov-Apr) ----------------------------
DRY_SEASON_MONTHS = [11, 12, 1, 2, 3, 4]

# --- fixed values: quality thresholds (defaults) --------------------------
DQ_MIN_ROW_COUNT = 10
DQ_MAX_NULL_PERCENT = 5.0
DQ_FRESHNESS_HOURS = 48
DQ_NULL_COLUMNS = ["aqi", "measured_at", "dominant_pollutant", "queried_city"]

# --- fixed values: hourly measures and feature parameters -----------------
HOURLY_MEASURES = ["aqi", "pm25", "pm10", "temperature", "humidity", "pressure", "wind"]
HOURLY_LAGS = [1, 3, 6, 12, 24]
HOURLY_ROLLING = [(3, "3h"), (24, "24h"), (168, "7d")]
DAILY_LAGS = [1, 2, 3, 5, 7]
DAILY_ROLLING = [(3, "3d"), (7, "7d"), (14, "14d")]
FORECAST_HORIZON_H = 24
MODEL_APPROVAL_MAE = 20.0
ANOMALY_CONTAMINATION = 0.02
CONTAMINATION_SWEEP = [0.005, 0.01, 0.02, 0.03, 0.05, 0.1]

# --- fixed values: dashboard colour per AQI level --------------------------
AQI_LEVEL_COLORS = {
    "Good": "#00E400",
    "Moderate": "#FFFF00",
    "Unhealthy for Sensitive Groups": "#FF7E00",
    "Unhealthy": "#FF0000",
    "Very Unhealthy": "#8F3F97",
    "Hazardous": "#7E0023",
}

# --- fixed values: drift rule (relative change that triggers a refit) -------
DRIFT_CHANGE_PCT = 50.0
