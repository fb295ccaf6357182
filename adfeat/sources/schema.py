"""Impression-log schema and readers.

The log has no declared schema upstream; these types fix it so parquet and
CSV inputs plan the same way (no schema inference on a 100 TB CSV).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

IMPRESSION_FIELDS = [
    T.StructField("instance_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("item_id", T.LongType(), True),
    T.StructField("shop_id", T.LongType(), True),
    T.StructField("is_trade", T.IntegerType(), True),
    T.StructField("context_timestamp", T.StringType(), True),
    T.StructField("item_category_list", T.StringType(), True),
    T.StructField("item_property_list", T.StringType(), True),
    T.StructField("predict_category_property", T.StringType(), True),
]

ATTRIBUTE_FIELDS = [
    T.StructField("shop_review_num_level", T.IntegerType(), True),
    T.StructField("shop_review_positive_rate", T.DoubleType(), True),
    T.StructField("shop_star_level", T.IntegerType(), True),
    T.StructField("shop_score_service", T.DoubleType(), True),
    T.StructField("shop_score_delivery", T.DoubleType(), True),
    T.StructField("shop_score_description", T.DoubleType(), True),
    T.StructField("item_price_level", T.IntegerType(), True),
    T.StructField("item_sales_level", T.IntegerType(), True),
    T.StructField("item_collected_level", T.IntegerType(), True),
    T.StructField("item_pv_level", T.IntegerType(), True),
    T.StructField("item_brand_id", T.StringType(), True),
    T.StructField("item_city_id", T.IntegerType(), True),
    T.StructField("user_gender_id", T.IntegerType(), True),
    T.StructField("user_age_level", T.IntegerType(), True),
    T.StructField("user_occupation_id", T.StringType(), True),
    T.StructField("user_star_level", T.IntegerType(), True),
]

IMPRESSION_SCHEMA = T.StructType(IMPRESSION_FIELDS + ATTRIBUTE_FIELDS)


def read_impressions(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = IMPRESSION_SCHEMA,
    **options: str,
) -> DataFrame:
    """Read an impression log with the fixed schema.

    Columns are matched by *name* (CSV header or parquet footer); a CSV is parsed
    straight to the declared types – no schema inference pass over the data.  Columns of
    the schema that the file lacks are left out, so a feature needing one
    fails at analysis time rather than reading silent nulls.
    """
    if fmt == "csv":
        opts = {"header": "true", **options}
        declared = {f.name: f.dataType for f in schema.fields}
        names = spark.read.options(**opts).csv(path).columns  # the header line alone
        types = T.StructType([T.StructField(n, declared.get(n, T.StringType()), True) for n in names])
        df = spark.read.options(**opts).schema(types).csv(path, enforceSchema=False)
    else:
        df = spark.read.options(**options).format(fmt).load(path)
    present = set(df.columns)
    return df.select(
        *[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields if f.name in present]
    )
