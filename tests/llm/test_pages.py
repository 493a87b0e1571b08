"""Operators on pages against brute force and round trips."""

import base64
import hashlib
import struct

import pytest

from martforge.llm import style_tree, url_filter, warc
from martforge.llm.common import shared_path

URLS = [
    None, "", "no scheme", "http://", "http://Example.COM", "http://example.com/en/x?q#f", "https://www.EXAMPLE.com/en/1",
    "http://a.www.example.com/en/2", "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/1", "http://x.net/de/",
    "http://x.org/é/日", "http://x.com:8080/a", "ftp://h?x=://y", "http://com/", "http://com", "a://b://c/d",
]


def host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def test_rules_and_parts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[5])] * 2 + [(None, URLS[6])]
    pages = spark.createDataFrame([(*r, "taken", "taken") for r in rows], "page_id long, url string, verdict string, host string")
    got = url_filter.judge_urls(pages, url_filter.RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = host_path(r.url)
        assert (r.host, r.path) == (host, path)
        fits = [x for x in url_filter.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert r.rule == (best.text if best else None)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), url_filter.RULES).count() == 0


def test_model_tells_urls_apart(spark):
    """URLs without a rule go with the rule-judged ones that look like them."""
    rows = [(i, f"http://w{i}.com/good/news/{i}") for i in range(150)] + [(500 + i, f"http://w{i}.net/es/casino-win/{i}") for i in range(150)]
    rows += [(1000 + i, f"http://v{i}.org/good/news/{i}") for i in range(20)] + [(2000 + i, f"http://v{i}.org/casino-win/{i}") for i in range(20)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), url_filter.RULES).collect()
    told = {r.page_id: r.verdict for r in got if r.rule is None}
    assert len(told) == 40
    assert sum(v == ("allow" if i < 2000 else "block") for i, v in told.items()) >= 38


def test_probabilities_sum_to_one(spark):
    counts = spark.createDataFrame([(5, 3, 0), (70, 1, 2), (1048575, 0, 9)], "code int, allow long, block long")
    assert url_filter.gram_scores(counts).count() == url_filter.GRAMS


def test_plan_has_no_python(spark, small_dir):
    plan = url_filter.op4_url_filter(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


ODD_PAGES = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "u\r\nv", ""), (5, "http://a/5", "é" * 300_000),
    (2, "http://a/2", "<p>x</p>"), (2, "http://a/2", "other"), (None, "http://n", "<p>x</p>"), (None, "http://n", "alone"), (0, "http://z", "other"),
    (7, "http://a/7", "WARC/1.1\r\n\r\nfake\r\n\r\n"),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1, "taken") for r in ODD_PAGES], "page_id long, url string, html string, first int, digest string")
    index = warc.write_archives(pages, shared_path(spark, "t"), frame_bytes=2000, bundle_bytes=4000)
    rows = warc.read_archives(index).collect()
    assert len(rows) == len(ODD_PAGES)
    first = {}
    for page, _, body in sorted((r for r in ODD_PAGES if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(body or "", page)
    for r in rows:
        body = r.payload.decode() if r.payload is not None else None
        if r.record_type == "response":
            assert r.payload_bytes == len(r.payload) and r.refers_to is None
            assert r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
            assert r.page_id is None or first[body] == r.page_id
        else:
            assert r.refers_to in first.values() and body is None
    pairs = sorted((r.page_id, r.record_type, r.refers_to) for r in rows if r.page_id is not None)
    assert pairs == sorted(
        [(0, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (2, "revisit", 0), (3, "response", None),
         (4, "revisit", 3), (5, "response", None), (7, "response", None)]
    )
    assert sorted((r.record_type, r.refers_to) for r in rows if r.page_id is None) == [("response", None)] * 2
    # Every record can be read alone.
    alone = {r.record_id: r for r in warc.fetch_records(index).collect()}
    assert alone == {r.record_id: r for r in rows} and len(alone) == len(rows)


def test_bundle_has_the_public_seek_table(spark, tmp_path):
    import zstandard

    bundle = warc.Bundle(f"file://{tmp_path}", "b.warc.zst", 100, 3)
    for i in range(5):
        bundle.add(warc.warc_record(warc.record_id(i), i, "http://x", b"p" * 80, None, False), (warc.record_id(i), i, "response"))
    bundle.close()
    raw = (tmp_path / "b.warc.zst").read_bytes()
    n, _, magic = struct.unpack("<IBI", raw[-9:])
    assert magic == 0x8F92EAB1 and n >= 5
    # A reader that knows nothing of the table reads the frames in a row.
    reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
    assert reader.read().count(b"WARC-Type: ") == 6


def test_warc_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.write_archives(pages, shared_path(spark, "t"))
    assert index.count() == 0 and warc.read_archives(index).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- c --><div class="ad">Buy</div><header>Site</header>
<article><header><h1>Head &amp; more</h1></header><p><b>One
  two<br><p>Three &lt;x&gt;&nbsp;four</p><ul><li>a<li>b</ul><form><input>send</form><div id="comments"><p>first!</p></div></article>
<div class="cookie-notice">We use</div><aside>side</aside><footer>&copy;</footer>"""


def test_blocks_of_a_page():
    assert style_tree.main_blocks(PAGE) == ["Head & more", "One two", "Three <x> four", "a", "b"]
    for odd in (None, "", "plain", "<", "<p", "a < b", "<p>x</q></p>", "<script>never", "<!--", "</p>", "<p a='>'>q"):
        style_tree.main_blocks(odd)
    assert style_tree.main_blocks("a < b &amp; c") == ["a < b & c"]
    assert style_tree.main_blocks("<p a='>'>q") == ["q"]


def test_tree_removes_what_a_site_repeats(spark):
    """Unnamed branches with the same text on every page go, articles stay."""
    page = "<body><div class='x1'><p>Same words on all pages</p></div><div class='x2'><p>Article {0} says {1}</p></div></body>"
    rows = [(i, f"http://h.com/{i}", page.format(i, i * i)) for i in range(30)]
    rows += [(100 + i, f"http://few.com/{i}", page.format(i, i * i)) for i in range(3)]
    rows += [(200 + i, f"http://art.com/{i}", "<article><p>one copy</p></article>") for i in range(30)]
    rows += [(300, None, None), (301, "http://h.com/e", ""), (0, "http://h.com/0", page.format(0, 0))]
    pages = spark.createDataFrame([(*r, "taken") for r in rows], "page_id long, url string, html string, text string")
    got = style_tree.extract_main_text(pages).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[5] == "Article 5 says 25"
    assert texts[101] == "Same words on all pages\nArticle 1 says 1"
    assert texts[200] == "one copy" and texts[300] == "" and texts[301] == ""
    assert style_tree.extract_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("table", ["sf0.001"])
def test_extraction_against_a_plain_reading(spark, table):
    import html
    import re

    pages = spark.read.parquet(f"/root/testdata/{table}/pages.parquet")
    for r in style_tree.extract_main_text(pages).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p)


def test_archives_are_read_by_as_many_tasks_as_bundles(spark, tmp_path):
    from martforge.llm import warc

    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(string(id), 50) AS html")
    index = warc.write_archives(pages, f"file://{tmp_path}/a", frame_bytes=500, bundle_bytes=2000)
    bundles = index.select("bundle").distinct().count()
    read = warc.read_archives(index, with_payload=False)
    assert bundles > 1 and read.rdd.getNumPartitions() == bundles
    spark.conf.set("spark.sql.shuffle.partitions", bundles)
    try:
        again = warc.read_archives(index, with_payload=False)
        assert again.rdd.getNumPartitions() == bundles and again.count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
