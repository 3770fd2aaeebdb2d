"""Declared schemas (no per-message inference)."""

from pyspark.sql import types as T

# Joined post + bar record as the reference's CSV carries it; column names with blanks are
# mapped to snake_case at the source and restored at the sink.
REFERENCE_POST_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType(), True),
    T.StructField("Tweet", T.StringType(), True),
    T.StructField("Stock Name", T.StringType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Adj Close", T.DoubleType(), True),
    T.StructField("Volume", T.DoubleType(), True),
])

# reference column name -> library column name
REFERENCE_TO_SNAKE = {
    "_id": "doc_id", "Date": "dt", "Tweet": "tweet", "Stock Name": "symbol", "Open": "open",
    "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume",
    "Prediction": "prediction", "Sentiment": "sentiment",
}
SNAKE_TO_REFERENCE = {v: k for k, v in REFERENCE_TO_SNAKE.items()}

# Post message: the stored record (its id is the library's addition); dates travel as text.
POST_MESSAGE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), True),
    T.StructField("dt", T.StringType(), True),
    T.StructField("tweet", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adj_close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

# Prediction message: the whole post message, the number of the prediction version and the prediction.
PREDICTION_MESSAGE_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), True), *POST_MESSAGE_SCHEMA.fields,
    T.StructField("prediction", T.DoubleType(), True),
])

# Live view columns (order as in the reference's live table).
LIVE_COLUMNS = [("dt", "date"), ("tweet", "string"), ("low", "double"), ("high", "double"),
                ("open", "double"), ("close", "double"), ("volume", "double"),
                ("prediction", "double"), ("sentiment", "string")]
