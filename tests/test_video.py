"""Trending-video ETL contract (Y1-Y6) on hand-made CSV + JSON files."""

import json
import os

import pytest
from pyspark.sql.types import ArrayType, DateType, DoubleType, LongType, TimestampType

from txlens.operators import video
from txlens.session import scratch_path

HEADER = ",".join(video.VIDEO_COLUMNS)
ROWS = [
    'v1,17.14.11,Title one,Chan A,10,2017-11-13T17:13:01.000Z,"""a""|""b""",1000,50,5,45,http://x,False,False,False,Desc',
    'v1,17.15.11,Title one,Chan A,10,2017-11-13T17:13:01.000Z,"""a""|""b""",2000,80,20,100,http://x,False,False,False,',
    'v2,17.14.11,Title two,Chan B,24,2017-11-12T05:00:00.000Z,[none],0,0,0,0,http://y,True,True,False,',
]
CATS = {"kind": "x", "items": [{"id": "10", "snippet": {"title": "Music"}},
                               {"id": "24", "snippet": {"title": "Entertainment"}}]}


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


@pytest.fixture(scope="module")
def cleaned(spark):
    d = scratch_path(spark, "t-video")
    os.makedirs(_local(d), exist_ok=True)
    with open(os.path.join(_local(d), "USvideos.csv"), "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS) + "\n")
    with open(os.path.join(_local(d), "US_category_id.json"), "w") as f:
        json.dump(CATS, f)
    vids = video.read_videos(spark, f"{d}/*.csv")
    cats = video.read_categories(spark, f"{d}/*.json")
    return video.clean_videos(vids, cats)


def test_schema_and_nulls(cleaned):
    expected = {"video_id", "trending_date", "title", "channel_title", "category_id", "category_title",
                "publish_time", "publish_date", "publish_hour", "publish_day_of_week", "tags", "tags_array",
                "views", "likes", "dislikes", "comment_count", "comments_disabled", "ratings_disabled",
                "video_error_or_removed", "description", "days_to_trend", "engagement_rate", "like_ratio",
                "total_days_trending", "country", "trending_year_month"}
    assert expected <= set(cleaned.columns)
    types = {f.name: f.dataType for f in cleaned.schema.fields}
    assert isinstance(types["trending_date"], DateType) and isinstance(types["publish_time"], TimestampType)
    assert isinstance(types["views"], LongType) and isinstance(types["engagement_rate"], DoubleType)
    assert isinstance(types["tags_array"], ArrayType)
    assert cleaned.filter("description IS NULL OR country IS NULL").count() == 0


def test_metrics(cleaned):
    rows = {(r["video_id"], str(r["trending_date"])): r for r in cleaned.collect()}
    r = rows[("v1", "2017-11-14")]
    assert r["engagement_rate"] == pytest.approx((50 + 5 + 45) / 1000)
    assert r["like_ratio"] == pytest.approx(50 / 55)
    assert r["total_days_trending"] == 2 and r["days_to_trend"] == 1
    assert r["category_title"] == "Music" and r["country"] == "US" and list(r["tags_array"]) == ["a", "b"]
    v2 = rows[("v2", "2017-11-14")]
    assert v2["engagement_rate"] == 0.0 and list(v2["tags_array"]) == [] and v2["total_days_trending"] == 1
    assert v2["category_title"] == "Entertainment"
