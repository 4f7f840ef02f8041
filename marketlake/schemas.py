"""Schemas of the stored tables and of the landed payloads.

Timestamps carry no zone, prices are decimal(20,8) from the first cast to the last write.
"""

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
NTZ = T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    out = T.StructType()
    for name, kind, *required in fields:
        out = out.add(name, kind, not required)
    return out


# Names and order of the stored columns.
# --- normalised tables -----------------------------------------------------------------------
CURRENCY = _schema(
    ("Currency_ID", T.IntegerType(), "not null"),
    ("Currency_Name", T.StringType(), "not null"),
    ("Asset_Type", T.StringType(), "not null"),
    ("Global_Price_USD", PRICE),
    ("Raw_Tags", T.ArrayType(T.StringType())),
)
PAIR = _schema(
    ("Pair_ID", T.IntegerType(), "not null"),
    ("Pair_Name", T.StringType(), "not null"),
    ("Base_Currency_ID", T.IntegerType(), "not null"),
    ("Quote_Currency_ID", T.IntegerType(), "not null"),
    ("Manual_Category", T.StringType()),
)
PRICE_HIST = _schema(
    ("Price_Hist_ID", T.LongType(), "not null"),
    ("Pair_ID", T.IntegerType(), "not null"),
    ("Price", PRICE, "not null"),
    ("Timestamp", NTZ),
    ("Source", T.StringType()),
)

# The history as loads append to it; a stored row has no id of its own.
PRICES = _schema(("Pair_ID", T.IntegerType()), ("Price", PRICE), ("Timestamp", NTZ), ("Source", T.StringType()))
PRICE_KEY = ["Timestamp", "Pair_ID", "Source"]

# --- star tables -----------------------------------------------------------------------------
DIM_TIME = _schema(
    ("TIME_ID", NTZ, "not null"),
    *[(part, T.IntegerType()) for part in ("DAY", "MONTH", "YEAR", "QUARTER", "HOUR", "MINUTE", "SECOND")],
)
DIM_PAIR = _schema(
    ("PAIR_ID", T.IntegerType(), "not null"),
    ("PAIR_NAME", T.StringType()),
    ("CATEGORY_NAME", T.StringType()),
    ("BASE_CURRENCY", T.StringType()),
    ("BASE_ASSET_TYPE", T.StringType()),
    ("QUOTE_CURRENCY", T.StringType()),
    ("QUOTE_ASSET_TYPE", T.StringType()),
)
DIM_CATEGORY = _schema(("CATEGORY_ID", T.IntegerType(), "not null"), ("CATEGORY_NAME", T.StringType()))
DIM_SOURCE = _schema(("SOURCE_ID", T.IntegerType(), "not null"), ("SOURCE_NAME", T.StringType()))
FACT_PRICE = _schema(
    ("TIME_ID", NTZ), ("PAIR_ID", T.LongType()), ("SOURCE_ID", T.IntegerType()), ("PRICE", PRICE)
)
# A fact is its whole row: every distinct price of a time, pair and source is one.
FACT_KEY = FACT_PRICE.names
FACT_PAIRS = _schema(
    ("PAIR_NAME", T.StringType()),
    ("CURRENCY_ID", T.IntegerType()),
    ("TIME_ID", NTZ),
    ("CATEGORY_ID", T.IntegerType()),
    ("SOURCE_ID", T.IntegerType()),
    ("PRICE", PRICE),
)
DIM_CURRENCY = _schema(
    ("Currency_ID", T.IntegerType(), "not null"), ("Currency_Name", T.StringType()), ("Asset_Type", T.StringType())
)

# --- which version of a replaced table is current ----------------------------------------------
VERSIONS = _schema(("view", T.StringType()), ("path", T.StringType()), ("published", NTZ))

# --- landed payloads -------------------------------------------------------------------------
CORRUPT = "_corrupt_record"
TICKER = _schema(("symbol", T.StringType()), ("price", T.StringType()), (CORRUPT, T.StringType()))
ASSET = _schema(
    ("id", T.LongType()), ("symbol", T.StringType()), ("name", T.StringType()), ("rank", T.IntegerType()),
    (CORRUPT, T.StringType()),
)
QUOTE = _schema(
    ("tags", T.ArrayType(T.StringType())),
    ("quote", T.MapType(T.StringType(), _schema(("price", T.DecimalType(30, 12))))),
)
QUOTES = _schema(("data", T.MapType(T.StringType(), QUOTE)), (CORRUPT, T.StringType()))

# The twelve positions of one candle.
CANDLE_FIELDS = (
    "timestamp", "open", "high", "low", "close", "volume",
    "close_time", "qav", "num_trades", "taker_base", "taker_quote", "ignore",
)

# --- files -----------------------------------------------------------------------------------
TICKER_EXTRACT = _schema(("Symbol", T.StringType()), ("Price", PRICE), ("Retrieval_Timestamp", NTZ))
# Exported timestamps may end in a zone offset, so they are read as text first.
EXPORT_DIM_TIME = _schema(
    ("Timestamp", T.StringType()),
    *[(part, T.IntegerType()) for part in ("Year", "Month", "Day", "Quarter")],
)
EXPORT_DIM_CURRENCY = _schema(
    ("Currency_ID", T.IntegerType()), ("Currency_Name", T.StringType()), ("Asset_Type", T.StringType())
)
EXPORT_FACT_PAIRS = _schema(
    ("TIME_ID", T.StringType()),
    ("Currency_ID", T.IntegerType()),
    ("Pair_ID", T.LongType()),
    ("Pair_Name", T.StringType()),
    ("Price", PRICE),
)
