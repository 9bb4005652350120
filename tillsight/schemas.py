"""Declared schemas of the two inputs and of the detection table."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("gender", T.StringType()),
    ]
)

IMPORTANCE = T.StructType(
    [
        T.StructField("Source", T.StringType()),
        T.StructField("Target", T.StringType()),
        T.StructField("Weight", T.DoubleType()),
        T.StructField("typeTrans", T.StringType()),
    ]
)

# Column names and order of the result.
DETECTION_COLUMNS = [
    "YStartTime",
    "detectionTime",
    "patternId",
    "actionType",
    "customerName",
    "merchantId",
]
DETECTION_KEYS = ["patternId", "actionType", "customerName", "merchantId"]

DETECTIONS = T.StructType([T.StructField(c, T.StringType()) for c in DETECTION_COLUMNS])
