"""Trending-video ETL (Y1-Y6): the second cleaning contract found in the
reference's tests (per-country trending CSV files + per-country category
JSON files -> one typed table with engagement metrics).

Not registered as a query: the driver's tables hold no such data; the
operators are covered by unit tests on hand-made files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values of the public trending-video file layout ------------------
VIDEO_COLUMNS = [
    "video_id", "trending_date", "title", "channel_title", "category_id", "publish_time", "tags",
    "views", "likes", "dislikes", "comment_count", "thumbnail_link", "comments_disabled",
    "ratings_disabled", "video_error_or_removed", "description",
]
TRENDING_DATE_FORMAT = "yy.dd.MM"
NO_TAGS = "[none]"
# ------------------------------------------------------------------------------

VIDEO_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in VIDEO_COLUMNS])


def _country_from_file(prefix_len: int = 2):
    """Country code = first letters of the source file name (file-source metadata column)."""
    return F.upper(F.substring(F.col("_metadata.file_name"), 1, prefix_len))


def read_videos(spark: SparkSession, paths) -> DataFrame:
    """Headered CSV files (all strings) with the country taken from the file name."""
    df = (spark.read.schema(VIDEO_SCHEMA).option("header", "true").option("multiLine", "true")
               .option("escape", '"').csv(paths if isinstance(paths, list) else [paths]))
    return df.select("*", _country_from_file().alias("country"))


def read_categories(spark: SparkSession, paths) -> DataFrame:
    """Category JSON files -> (country, category_id, category_title)."""
    raw = spark.read.option("multiLine", "true").json(paths if isinstance(paths, list) else [paths])
    items = raw.select(_country_from_file().alias("country"), F.explode("items").alias("it"))
    return (items.select("country", F.col("it.id").try_cast("bigint").alias("category_id"),
                         F.col("it.snippet.title").alias("category_title"))
                 .dropDuplicates(["country", "category_id"]))


def tags_array(col: str = "tags"):
    """Y2: 'a"|"b' -> ['a', 'b'] (quotes stripped); the no-tags marker -> []."""
    c = F.col(col)
    parts = F.transform(F.split(c, r"\|"), lambda x: F.regexp_replace(x, '"', ""))
    return (F.when(c.isNull() | (c == F.lit(NO_TAGS)), F.array().cast("array<string>"))
             .otherwise(F.filter(parts, lambda x: F.length(x) > 0)))


def clean_videos(videos: DataFrame, categories: DataFrame) -> DataFrame:
    """Typed columns, category title, tags array, engagement metrics,
    days to trend and days trending per (video, country)."""
    num = {c: F.col(c).try_cast("bigint") for c in ("views", "likes", "dislikes", "comment_count")}
    flags = {c: F.lower(F.col(c)).try_cast("boolean") for c in
             ("comments_disabled", "ratings_disabled", "video_error_or_removed")}
    pt = F.coalesce(F.try_to_timestamp(F.col("publish_time"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")),
                    F.try_to_timestamp(F.col("publish_time")))
    typed = videos.select(
        "video_id", F.to_date(F.try_to_timestamp(F.col("trending_date"), F.lit(TRENDING_DATE_FORMAT))).alias("trending_date"),
        "title", "channel_title", F.col("category_id").try_cast("bigint").alias("category_id"),
        pt.alias("publish_time"), F.coalesce(F.col("tags"), F.lit(NO_TAGS)).alias("tags"),
        *[e.alias(c) for c, e in num.items()], *[e.alias(c) for c, e in flags.items()],
        F.coalesce(F.col("description"), F.lit("")).alias("description"),   # Y6
        F.coalesce(F.col("country"), F.lit("UNKNOWN")).alias("country"),
    )
    views, likes, dislikes, comments = (F.coalesce(F.col(c), F.lit(0)) for c in ("views", "likes", "dislikes", "comment_count"))
    engagement = F.when(views > 0, (likes + dislikes + comments) / views).otherwise(F.lit(0.0))   # Y3
    like_ratio = F.when(likes + dislikes > 0, likes / (likes + dislikes)).otherwise(F.lit(0.0))   # Y4
    feat = typed.select(
        "*", F.to_date("publish_time").alias("publish_date"), F.hour("publish_time").alias("publish_hour"),
        F.date_format("publish_time", "E").alias("publish_day_of_week"), tags_array().alias("tags_array"),
        engagement.cast("double").alias("engagement_rate"), like_ratio.cast("double").alias("like_ratio"),
        F.date_format("trending_date", "yyyy-MM").alias("trending_year_month"))
    feat = feat.select("*", F.datediff("trending_date", "publish_date").alias("days_to_trend"))     # Y5
    days = feat.groupBy("video_id", "country").agg(F.count_distinct("trending_date").alias("total_days_trending"))
    out = feat.join(days, ["video_id", "country"], "left")
    out = out.select("*", F.greatest(F.coalesce("total_days_trending", F.lit(1)), F.lit(1)).alias("_tdt")) \
             .drop("total_days_trending").withColumnRenamed("_tdt", "total_days_trending")
    return out.join(categories, ["country", "category_id"], "left")
