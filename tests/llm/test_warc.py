import random

import pytest
from pyspark.sql import functions as F
from tripmill.llm import warc
from tripmill.llm.queries import QUERIES

RECORDS = "record_id long, uri string, captured long, status int, headers map<string,string>, payload string, response_id int, is_revisit int"


def records(spark, *rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], RECORDS)


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTP://User@Ex.ORG:80/a?B#c", "http://ex.org/a?B"), ("https://ex.org:443", "https://ex.org/"), ("http://ex.org:443/", "http://ex.org:443/"),
        ("http://ex.org?q", "http://ex.org/?q"), ("mailto:x#y", "mailto:x"), (None, None), ("", ""),
    ],
)
def test_canonical(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical(F.col("u"))).first()[0] == want


def test_resolution_and_headers(spark):
    stored = {"ETag": '"a"', "Content-Type": "text/html", "X-Old": "1", "Date": "d0"}
    rows = [
        (1, "http://h/p", 10, 200, stored, "body 1"),
        (2, "http://h/p", 20, 200, {"etag": '"b"'}, "body 2"),
        (3, "HTTP://H/p#x", 15, 304, {"etag": 'W/"a"', "DATE": "d1", "content-type": "x", "Connection": "X-Hop", "x-hop": "1", "X-New": "n"}, None),
        (4, "http://h/p", 25, 304, {"ETag": '"a"'}, None),
        (5, "http://h/p", 10, 304, {"ETag": '"a"'}, None),
        (6, "http://h/p", 30, 304, None, None),
        (7, None, 30, 304, {"etag": '"a"'}, None),
        (8, "http://h/p", None, 304, {"etag": '"a"'}, None),
        (9, "http://h/p", 40, 404, {}, "gone"),
        (10, "http://h/p", 41, 200, {}, None),
        (11, "http://h/p", 42, 304, {"ETag": '"b"', "Last-Modified": "m"}, None),
    ]
    got = {r["record_id"]: r for r in warc.resolve_revisits(records(spark, *rows)).collect()}
    said = {k: (r["resolution"], r["response_id"], r["payload"]) for k, r in got.items()}
    assert said == {
        3: ("resolved", 1, "body 1"), 4: ("changed", 2, None), 5: ("no_response", None, None), 6: ("unverified", 2, "body 2"),
        7: ("no_response", None, None), 8: ("no_response", None, None), 11: ("resolved", 2, "body 2"),
    }
    assert got[3]["headers"] == {"etag": 'W/"a"', "content-type": "text/html", "x-old": "1", "date": "d1", "x-new": "n"}


def test_matches_brute_force_with_a_hot_url(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        url = "http://hot/" if rng.random() < 0.5 else f"http://h/{rng.randint(0, 20)}"
        if rng.random() < 0.2:
            rows.append((i, url, rng.randint(0, 200), 200, {"etag": str(rng.randint(0, 1))}, f"p{i}"))
        else:
            rows.append((i, url, rng.randint(0, 200), 304, {"etag": str(rng.randint(0, 1))}, None))
    got = {r["record_id"]: (r["resolution"], r["response_id"]) for r in warc.resolve_revisits(records(spark, *rows).repartition(6)).collect()}
    for i, url, at, status, headers, _ in rows:
        if status != 304:
            continue
        earlier = [(t, j, h) for j, u, t, s, h, _ in rows if s == 200 and u == url and t < at]
        if not earlier:
            assert got[i] == ("no_response", None)
        else:
            _, j, h = max(earlier, key=lambda e: e[:2])
            assert got[i] == ("resolved" if h == headers else "changed", j)


def test_repeated_records_count_once(spark):
    full = [(1, "http://h/p", 10, 200, {"etag": "a"}, "body 1")] * 3 + [(None, "http://h/p", 12, 200, {"etag": "a"}, "no id")]
    revisits = [(2, "http://h/p", 20, 304, {"etag": "a"}, None), (3, None, 20, 304, None, None), (None, "http://h/p", 20, 304, {"etag": "a"}, None)]
    got = warc.resolve_revisits(records(spark, *full, *revisits, *revisits[:2] * 2).repartition(5)).collect()
    said = sorted((r["record_id"] or 0, r["resolution"], r["response_id"], r["payload"]) for r in got)
    assert said == [(0, "no_response", None, None), (2, "resolved", 1, "body 1"), (3, "no_response", None, None)]


def test_empty(spark):
    assert warc.resolve_revisits(records(spark)).count() == 0


def test_query_has_a_row_per_revisit(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id").collect()
    want = {4 * r[0] + 2 for r in pages} | {4 * r[0] + 3 for r in pages if r[0] % 13 == 0}
    got = QUERIES["op3_warc"](spark, sf_dir).collect()
    assert {r["record_id"] for r in got} == want and len(got) == len(want)
    assert {r["resolution"] for r in got} >= {"resolved", "changed"}
