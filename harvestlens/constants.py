"""Fixed values.

Everything here must equal the published data model for results to agree, so the
values are written out plainly in their natural order.
"""

# The 36 map regions and their ids.
STATE_SEED = [
    (0, "Andaman and Nicobar"),
    (1, "Telangana"),
    (2, "Andhra Pradesh"),
    (3, "Arunachal Pradesh"),
    (4, "Assam"),
    (5, "Bihar"),
    (6, "Chandigarh"),
    (7, "Chhattisgarh"),
    (8, "Dādra and Nagar Haveli and Damān and Diu"),
    (9, "Delhi"),
    (10, "Goa"),
    (11, "Gujarat"),
    (12, "Haryana"),
    (13, "Himachal Pradesh"),
    (14, "Jharkhand"),
    (15, "Karnataka"),
    (16, "Kerala"),
    (17, "Madhya Pradesh"),
    (18, "Maharashtra"),
    (19, "Manipur"),
    (20, "Meghalaya"),
    (21, "Mizoram"),
    (22, "Nagaland"),
    (23, "Odisha"),
    (24, "Puducherry"),
    (25, "Punjab"),
    (26, "Rajasthan"),
    (27, "Sikkim"),
    (28, "Tamil Nadu"),
    (29, "Tripura"),
    (30, "Uttar Pradesh"),
    (31, "Uttarakhand"),
    (32, "West Bengal"),
    (33, "Lakshadweep"),
    (34, "Jammu and Kashmir"),
    (35, "Ladakh"),
]

# Spellings of a state after title-casing -> its name in STATE_SEED.
STATE_ALIASES = {
    "Keralam": "Kerala",
    "Chattisgarh": "Chhattisgarh",
    "Nct Of Delhi": "Delhi",
    "Nct of Delhi": "Delhi",
    "Nct Of Delhi.": "Delhi",
    "Uttrakhand": "Uttarakhand",
    "Orissa": "Odisha",
    "Pondicherry": "Puducherry",
    "Dadra and Nagar Haveli": "Dādra and Nagar Haveli and Damān and Diu",
    "Daman and Diu": "Dādra and Nagar Haveli and Damān and Diu",
    "Dadra & Nagar Haveli": "Dādra and Nagar Haveli and Damān and Diu",
    "Dadra And Nagar Haveli And Daman And Diu": "Dādra and Nagar Haveli and Damān and Diu",
    "Jammu & Kashmir": "Jammu and Kashmir",
    "Jammu And Kashmir": "Jammu and Kashmir",
    "Andaman & Nicobar": "Andaman and Nicobar",
    "Andaman And Nicobar": "Andaman and Nicobar",
}

# Header of a daily quote file -> column name.
QUOTE_COLUMNS = {
    "State": "state",
    "District": "district",
    "Market": "market",
    "Commodity": "commodity",
    "Variety": "variety",
    "Grade": "grade",
    "Arrival_Date": "arrival_date",
    "Min_Price": "min_price",
    "Max_Price": "max_price",
    "Modal_Price": "modal_price",
}

TEXT_COLUMNS = ["state", "district", "market", "commodity", "variety", "grade"]
PRICE_COLUMNS = ["min_price", "max_price", "modal_price"]

# Cell texts a pandas CSV reader takes as missing by default.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Model features and their display labels.
FEATURE_LABELS = {
    "lag_1": "1-Day Price Lag",
    "lag_7": "7-Day Price Lag",
    "lag_14": "14-Day Price Lag",
    "roll_mean_7": "7-Day Moving Avg",
    "roll_mean_14": "14-Day Moving Avg",
    "roll_std_7": "Price Volatility",
    "weekday_num": "Weekly Seasonality",
    "month": "Monthly Seasonality",
}
FEATURES = list(FEATURE_LABELS)

# Series guards and evaluation.
MIN_SERIES_ROWS = 180
MIN_FEATURE_ROWS = 40
MIN_TEST_ROWS = 10
MIN_TRAIN_ROWS = 30
TEST_DAYS = 30

# Metrics shown for a series that has none stored.
DEFAULT_METRICS = {"mape": 9.50, "rmse": 150.00, "r2_score": 0.85}
DEFAULT_TRUST = 92.0

# Lower and upper limits of the stored metrics.
METRIC_LIMITS = {
    "mape": (0.0, 999.99),
    "rmse": (0.0, 99999999.99),
    "r2_score": (-999.99, 1.0),
}

# Recommendation by the forecast's per-cent change.
RECOMMENDATION_PCT = 3.0
RECOMMENDATIONS = {
    "HOLD": ("Significant upward trend predicted. Sell later for higher returns.", "gainer"),
    "SELL": ("Downward trend predicted. Sell immediately to prevent loss.", "loser"),
    "STABLE": ("Stable prices predicted. Execute routine transactions.", "stable"),
}

# Why a forecast is refused.
NO_COMMODITY = "No active commodity '{}' found in market ID {}."
NO_MODEL = "No trained model found for this market and commodity. Please run the training pipeline first."
TOO_SHORT = "Insufficient historical data to build model features. Need {} days, found {}."

# Volume model of the price explorer.
VOLUME_PER_PRICE = 1.2
ELASTICITY = 3.5
FACTOR_RANGE = (0.4, 2.2)
HISTORY_ROWS = 90

CONFIDENCE_Z = 1.96
BUFFER_ROWS = 14
HORIZON = 3
MOVER_PCT = 0.1
