"""File-time window, point tables and JSON posts."""

import json
import os

from conftest import record_line
from radiolens.operators import pairs
from radiolens.sources import records as rsrc
from radiolens.sources import tables


def test_file_window_inclusive_and_pruned(spark, tmp_dir):
    names = ["2031-05-09.06_41", "2031-05-09.06_43.gz.part", "2031-05-09.06_44",
             "2031-05-09.06_40", "not-a-time"]
    # outside the window, and no gzip data: reading it would fail
    with open(os.path.join(tmp_dir, "2031-05-09.06_39.gz"), "w") as f:
        f.write("not to be opened")
    for i, n in enumerate(names):
        with open(os.path.join(tmp_dir, n), "w") as f:
            f.write(record_line(payload=f"[1;7;X:1;{30 + i};5|") + "\n")
    df = rsrc.read_records(spark, tmp_dir, start="2031-05-09.06_41", minutes=2)
    got = sorted(r.file_name for r in df.selectExpr("_metadata.file_name AS file_name").collect())
    assert got == ["2031-05-09.06_41", "2031-05-09.06_43.gz.part"]
    s = {tuple(r) for r in pairs.serving_pairs(df).select("s", "n").collect()}
    assert s == {(30.0, 30.0), (31.0, 31.0)}


def test_points(spark, tmp_dir):
    p = os.path.join(tmp_dir, "input.csv")
    with open(p, "w") as f:
        f.write("lat\tlon\tvalue\n10.5\t-20.25\t3\n11.0\t-21.0\t1\n")
    rows = [tuple(r) for r in tables.read_points(spark, p, header=True).collect()]
    assert rows == [(10.5, -20.25, 3), (11.0, -21.0, 1)]
    q = os.path.join(tmp_dir, "coords.csv")
    with open(q, "w") as f:
        f.write("1.5\t2.5\n")
    assert [tuple(r) for r in tables.read_points(spark, q, header=False, with_value=False).collect()] \
        == [(1.5, 2.5)]


def test_posts(spark, tmp_dir):
    p = os.path.join(tmp_dir, "posts.json")
    posts = [
        {"id": 1, "text": "hello @bob", "lang": "en", "created_at": "Wed Aug 20 16:23:14 +0000 2014",
         "retweet_count": 0, "favorite_count": 2, "coordinates": None,
         "user": {"id": 10, "screen_name": "amy", "followers_count": 3, "lang": "en",
                  "verified": False, "utc_offset": None},
         "entities": {"hashtags": [], "urls": [],
                      "user_mentions": [{"id": 11, "screen_name": "bob", "indices": [6, 10]}]}},
        {"id": 2, "text": "plain", "lang": "it", "created_at": "Thu Aug 21 01:02:03 +0000 2014",
         "user": {"id": 12, "screen_name": "cid"}, "entities": {"user_mentions": []},
         "retweeted_status": {"id": 1, "text": "hello @bob"}},
    ]
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(x) for x in posts) + "\n")
    df = tables.read_posts(spark, p)
    assert df.where("created_ts IS NOT NULL").count() == 2
    m = {tuple(r) for r in tables.post_mentions(df).collect()}
    assert m == {(1, "en", "amy", 11, "bob"), (2, "it", "cid", None, None)}
    assert df.where("retweeted_status.id = 1").count() == 1
