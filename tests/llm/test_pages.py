"""Archives and url filters on small tables."""

import base64
import hashlib

from askloom.llm import archives, url_filter

PAGES = [
    (3, "http://a.example.com/x y", "<p>same</p>"), (1, "http://b.example.com/", "<p>same</p>"),
    (2, None, None), (4, "https://c.example.net/en/1?q", ""), (5, "http://d", "x\r\n\r\nWARC/1.1\r\n\n1 2 3\n"),
    (6, "http://é.org/fr/", "é" * 3000), (1, "http://b.example.com/", "<p>same</p>"), (None, "http://e", "<p>same</p>"),
]
SCHEMA = "page_id long, url string, html string"


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    got = archives.archive_pages(pages, file_bytes=500).collect()
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = page is not None and page > first[html or ""]
        want.append((page, len(data), digest, "revisit" if again else "response", first[html or ""] if again else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key
    ) == sorted(want, key=key)
    assert {r["date"] for r in got} == {"2024-01-01T00:00:00Z"}
    assert archives.archive_pages(pages.limit(0)).collect() == []


def test_both_arc_versions():
    for version in (1, 2):
        docs = [b"HTTP/1.1 200 OK\r\n\r\nfirst\n", b""]
        data = archives.arc_file_header(version, "19990101000000")
        for d in docs:
            data += archives.arc_record(version, "http://x/", "19990101000000", d, len(data))
        assert [(u, t, d) for _, u, t, d in archives.parse_arc(data)] == [("http://x/", "19990101000000", d) for d in docs]


def test_rules_and_propagation(spark):
    link = lambda h: f'<a href="http://{h}/">x</a><a href="/own">y</a>'
    rows = [
        (1, "http://bad.net/a", link("farm.com")), (2, "http://farm.com/", link("bad.net")), (3, "http://ok.org/fr/1", link("friend.com")),
        (4, "http://friend.com/z", link("ok.org")), (5, "http://X.Example.NET/en/1#f", None), (6, "http://example.net", ""),
        (7, None, None), (8, "no scheme", None), (9, "http://net/", None), (10, "http://a.example.com/de/x?y", None),
        (11, "http://lonely.com/", "<p>"),
    ]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(rows, SCHEMA), margin=0.5).collect()}
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()} == {
        1: ("bad.net", "/a", "net/", "block"), 2: ("farm.com", "/", None, "block"),
        3: ("ok.org", "/fr/1", "org/fr/", "allow"), 4: ("friend.com", "/z", None, "allow"),
        5: ("x.example.net", "/en/1", "example.net/en/", "allow"), 6: ("example.net", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("net", "/", "net/", "block"),
        10: ("a.example.com", "/de/x", "example.com/de/", "block"), 11: ("lonely.com", "/", None, "allow"),
    }
    assert url_filter.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def test_url_filter_is_native(spark):
    plan = url_filter.judge_urls(spark.createDataFrame(PAGES, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_small_parts_of_many_seeds_add_up(spark):
    # Each of 200 seeds hands less than a billionth to each of its 1,000 neighbours.
    seeds = spark.range(200).selectExpr("concat('s', id) AS host", "1000L AS weight")
    edges = spark.range(200_000).selectExpr(
        "concat('s', id % 200) AS src", "CASE WHEN id < 200 THEN 'farm' ELSE concat('h', id) END AS dst", "1L AS n"
    )
    got = url_filter.propagate(edges, seeds, steps=1).where("host = 'farm'").first()["score"]
    assert abs(float(got) - 200 * 1000 * 0.85 / 1000) < 1e-6
