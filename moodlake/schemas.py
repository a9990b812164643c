"""Record shapes."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_COLUMNS = ("id", "timestamp", "tweet_text")

# A post as it travels through the broker: text fields only.
POST = T.StructType([T.StructField(name, T.StringType()) for name in REQUIRED_COLUMNS])

# What a scorer says about one text.
SCORE = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("score", T.FloatType()),
    T.StructField("error", T.StringType()),
])

# A hosted model's answer: per input, a list of candidate labels.
MODEL_RESPONSE = T.ArrayType(T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("score", T.DoubleType()),
])))

# A scored post as stored, partitioned by sentiment_label.
ENRICHED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("original_text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("confidence_score", T.FloatType()),
])

# The same with the reason why a post has no true score; NULL for a true score and in stores without the column.
STORED = T.StructType([*ENRICHED.fields, T.StructField("inference_error", T.StringType())])
