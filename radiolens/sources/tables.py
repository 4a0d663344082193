"""Scans of the side tables that travel with the records: tab-separated
point tables and JSON-lines posts.  Schemas are pinned (no inference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_SCHEMA = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("value", T.IntegerType()),
])

_USER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("screen_name", T.StringType()),
    T.StructField("followers_count", T.LongType()),
    T.StructField("lang", T.StringType()),
    T.StructField("verified", T.BooleanType()),
    T.StructField("utc_offset", T.LongType()),
])
_HASHTAG = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("indices", T.ArrayType(T.LongType())),
])
_MENTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("screen_name", T.StringType()),
    T.StructField("indices", T.ArrayType(T.LongType())),
])
_URL = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("expanded_url", T.StringType()),
    T.StructField("indices", T.ArrayType(T.LongType())),
])
_ENTITIES = T.StructType([
    T.StructField("hashtags", T.ArrayType(_HASHTAG)),
    T.StructField("user_mentions", T.ArrayType(_MENTION)),
    T.StructField("urls", T.ArrayType(_URL)),
])
_POST_CORE = [
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("retweet_count", T.LongType()),
    T.StructField("favorite_count", T.LongType()),
    T.StructField("coordinates", T.StringType()),
    T.StructField("user", _USER),
    T.StructField("entities", _ENTITIES),
]
POST_SCHEMA = T.StructType(_POST_CORE + [
    T.StructField("retweeted_status", T.StructType(_POST_CORE)),
])

# posts carry "EEE MMM dd HH:mm:ss Z yyyy"; Spark does not parse day-of-week
# names, so the leading "EEE " is cut off before parsing the rest
POST_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def read_points(spark: SparkSession, path: str, *, header: bool,
                with_value: bool = True) -> DataFrame:
    """Tab-separated ``lat, lon[, value]`` (``.csv`` in name only)."""
    schema = POINT_SCHEMA if with_value else T.StructType(POINT_SCHEMA.fields[:2])
    return (spark.read.option("sep", "\t").option("header", str(header).lower())
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


CORRUPT = "_corrupt"


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines posts with the pinned nested schema; ``created_ts`` parsed.  A line that is no post of
    that schema is a row with its text in ``_corrupt``, which is null for all others."""
    schema = T.StructType([*POST_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return df.withColumn("created_ts",
                         F.try_to_timestamp(F.substring("created_at", 5, 64), F.lit(POST_TIME_FORMAT)))


def post_rows(posts: DataFrame) -> DataFrame:
    """One row per well-formed post with every pinned column: scalars as they are, the nested lists as lists of
    texts (``start-end:text``), the retweeted post by id, author and text."""
    def listed(name: str, text: str) -> Column:
        items = F.coalesce(F.col(f"entities.{name}"), F.array())
        return F.array_join(F.transform(items, lambda x: F.concat(
            F.array_join(F.transform(x["indices"], lambda i: i.cast("string")), "-"), F.lit(":"),
            F.coalesce(x[text], F.lit("")))), " ").alias(name)

    return posts.where(F.col(CORRUPT).isNull()).select(
        F.col("id").alias("post_id"), "text", "lang", F.unix_seconds("created_ts").alias("created"),
        "retweet_count", "favorite_count", "coordinates", F.col("user.id").alias("user_id"),
        F.col("user.screen_name").alias("author"), F.col("user.followers_count").alias("followers"),
        F.col("user.lang").alias("user_lang"), F.col("user.verified").alias("verified"),
        F.col("user.utc_offset").alias("utc_offset"), listed("hashtags", "text"), listed("user_mentions", "screen_name"),
        listed("urls", "expanded_url"), F.col("retweeted_status.id").alias("retweeted_id"),
        F.col("retweeted_status.user.screen_name").alias("retweeted_author"),
        F.col("retweeted_status.text").alias("retweeted_text"))


def damaged_lines(posts: DataFrame) -> DataFrame:
    """The number of lines, of those that are no post, and the largest identifier of the posts:
    ``lines, damaged, last_post``."""
    # Spark does not read the corrupt-record column alone
    return posts.select(F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("damaged"),
                        F.max(F.when(F.col(CORRUPT).isNull(), F.col("id"))).alias("last_post"))


def post_mentions(posts: DataFrame) -> DataFrame:
    """One row per (post, user mention); posts without mentions kept with nulls, damaged lines left out."""
    return posts.where(F.col(CORRUPT).isNull()).select(F.col("id").alias("post_id"), "lang",
                        F.col("user.screen_name").alias("author"),
                        F.explode_outer("entities.user_mentions").alias("m")) \
                .select("post_id", "lang", "author", F.col("m.id").alias("mention_id"),
                        F.col("m.screen_name").alias("mention_name"))
