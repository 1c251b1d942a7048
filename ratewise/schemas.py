"""Schemas of the data model (explicit, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# raw review / stream message: the four columns the engine uses
REVIEW = T.StructType([
    T.StructField("UserId", T.StringType(), True),
    T.StructField("ProductId", T.StringType(), True),
    T.StructField("Score", T.FloatType(), True),
    T.StructField("Time", T.LongType(), True),
])

# cleaned ratings, the ALS input
RATING = T.StructType([
    T.StructField("user_idx", T.IntegerType(), True),
    T.StructField("product_idx", T.IntegerType(), True),
    T.StructField("Score", T.FloatType(), True),
])

USER_DICT = T.StructType([
    T.StructField("UserId", T.StringType(), True),
    T.StructField("user_idx", T.IntegerType(), True),
])

PRODUCT_DICT = T.StructType([
    T.StructField("ProductId", T.StringType(), True),
    T.StructField("product_idx", T.IntegerType(), True),
])

REC_ITEM = T.StructType([
    T.StructField("product_idx", T.IntegerType(), True),
    T.StructField("rating", T.FloatType(), True),
])

RECS = T.StructType([
    T.StructField("user_idx", T.IntegerType(), True),
    T.StructField("recommendations", T.ArrayType(REC_ITEM), True),
])

# recommendation store rows as written by the streaming sink
STORE = T.StructType(RECS.fields + [T.StructField("batch_id", T.LongType(), True)])

ALS_CONFIG = T.StructType([
    T.StructField("rank", T.IntegerType(), True),
    T.StructField("regParam", T.DoubleType(), True),
    T.StructField("maxIter", T.IntegerType(), True),
])

METRICS = T.StructType([
    T.StructField("config", ALS_CONFIG, True),
    T.StructField("rmse_validation", T.DoubleType(), True),
    T.StructField("rmse_test", T.DoubleType(), True),
])

REPORT_MODEL = T.StructType([
    T.StructField("algorithme", T.StringType(), True),
    T.StructField("rmse_validation", T.DoubleType(), True),
    T.StructField("rmse_test", T.DoubleType(), True),
    T.StructField("config", ALS_CONFIG, True),
    T.StructField("donnees_train", T.StringType(), True),
    T.StructField("donnees_test", T.StringType(), True),
])

REPORT = T.StructType([
    T.StructField("date_execution", T.StringType(), True),
    T.StructField("pipeline", T.StringType(), True),
    T.StructField("kafka_broker_docker", T.StringType(), True),
    T.StructField("modele", REPORT_MODEL, True),
    T.StructField("fichiers_generes", T.LongType(), True),
    T.StructField("statut", T.StringType(), True),
    T.StructField("echantillon", T.ArrayType(T.StructType([
        T.StructField("user_idx", T.IntegerType(), True),
        T.StructField("n_items", T.IntegerType(), True),
    ])), True),
])

FACTORS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("features", T.ArrayType(T.FloatType()), True),
])
