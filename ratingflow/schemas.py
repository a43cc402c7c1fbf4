"""Contract schemas of the tables the jobs read and write."""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.IntegerType()),
])

REC = T.StructType([
    T.StructField("rid", T.IntegerType()),
    T.StructField("r", T.DoubleType()),
])
RECS = T.ArrayType(REC)
