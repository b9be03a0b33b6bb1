"""Table schemas shared by sources, operators and plans."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

HELPFUL = T.StructType(
    [
        T.StructField("positive", T.IntegerType()),
        T.StructField("total", T.IntegerType()),
    ]
)

REVIEW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("date_raw", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("summary", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("helpful", HELPFUL),
        T.StructField("rating", T.IntegerType()),
        T.StructField("split", T.StringType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("features", VectorUDT()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("split", T.StringType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)

RATINGS = (1, 2, 3, 4, 5)
