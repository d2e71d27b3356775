"""Text functions: literal results, and properties on random Unicode."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom import constants as C
from vecloom.functions import text as T

MIXED = st.text(
    alphabet=st.one_of(
        st.sampled_from("a#![]()\r\n \t\u001c\u0085  ​﻿\U0001f600é"),
        st.characters(min_codepoint=1, exclude_categories=["Cs"]),
    ),
    max_size=40,
)


def values(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in rows.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_whitespace_is_what_python_strips(spark):
    assert {ord(c) for c in C.WHITESPACE} == {c for c in range(0x110000) if chr(c).isspace()}
    texts = [f"{chr(p)}a b{chr(p)}" for p in C.WHITESPACE_POINTS] + ["​a​", "﻿a", "", "   "]
    assert values(spark, texts, T.strip) == [t.strip() for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(MIXED, min_size=40, max_size=40))
def test_random_texts_match_python(spark, texts):
    assert values(spark, texts, T.strip) == [t.strip() for t in texts]
    assert values(spark, texts, F.length) == [len(t) for t in texts]
    cleaned = values(spark, texts, T.clean_markdown)
    assert all("\r" not in t and t == t.strip() for t in cleaned)
    assert not any(f"{scheme}://{c}" in t for t in cleaned for scheme in ("http", "https") for c in "ab#!")
    for text, title in zip(cleaned, values(spark, cleaned, T.markdown_title), strict=True):
        assert title is None or (title and title == title.strip() and title in text and "#" in text)


def test_markdown_fixtures(spark):
    pages = {
        "![a](b.png)text": "text",
        "[label](https://x.y/z)": "label",
        "[![i](p.png)](https://x.y)": "[](",
        "[two\nlines](u) rest": "two\nlines rest",
        "see https://a.b/c. end": "see  end",
        "a\r\nb\rc": "a\nb\nc",
        "no links [a] (b)": "no links [a] (b)",
        "![unclosed](": "![unclosed](",
        "https://a.b c": "c",
        "https://a.b\u001cc": "c",
        "[x]()": "x",
        "![]()": "",
    }
    assert values(spark, list(pages), T.clean_markdown) == list(pages.values())
    titles = ["## x only", "#\n\nFoo", "# A\u0085B", "x\n# T  \ny", "#no", "# a\n# b", "text"]
    assert values(spark, titles, T.markdown_title) == [None, "Foo", "A\u0085B", "T", None, "a", None]


def test_length_band_edges(spark):
    texts = ["x" * n for n in (79, 80, 8000, 8001)] + ["\U0001f600" * 80, None, ""]
    assert values(spark, texts, T.in_length_band) == [False, True, True, False, True, False, False]


def test_urls(spark):
    urls = ["http://x", "https://x", "HTTP://x", "ftp://x", "", None, "http:/x", "xhttp://"]
    assert values(spark, urls, T.is_valid_url) == [True, True, False, False, False, False, False, False]
    made = values(spark, ["", None, "u"], lambda c: T.default_url(c, F.lit("f.parquet"), F.lit(7)))
    assert made == ["http://fw2.local/f.parquet-7"] * 2 + ["u"]


def test_snippets_and_sizes(spark):
    texts = ["x" * 200, "y" * 201, "", None]
    assert values(spark, texts, T.snippet) == ["x" * 200, "y" * 200 + "...", "", None]
    sizes = [0, 1023, 1024, 1536, 1024**2, 5 * 1024**4, 3000 * 1024**4, 1280, 1792, 1024**2 - 1, 1280 * 1024**3, 1281]
    rows = spark.createDataFrame(list(enumerate(sizes)), "i int, n bigint")
    shown = [r.v for r in rows.select("i", T.human_bytes(F.col("n")).alias("v")).orderBy("i").collect()]
    assert shown == ["0.0B", "1023.0B", "1.0KB", "1.5KB", "1.0MB", "5.0TB", "3000.0TB", "1.2KB", "1.8KB", "1024.0KB", "1.2TB", "1.3KB"]


def test_metadata_line_and_ids(spark):
    row = spark.range(1).select(
        T.metadata_line(F.lit(1).cast("bigint"), F.lit(None).cast("string"), F.lit("2024-01-02 03:04:05")).alias("line"),
        T.external_id_16().alias("x"),
        T.doc_ref(F.sha1(F.lit("é"))).alias("ref"),
        T.shown_time(F.timestamp_seconds(F.lit(0))).alias("t"),
    ).first()
    assert row.line == '{"id":1,"url":null,"created_at":"2024-01-02 03:04:05"}'
    assert re.fullmatch(r"[0-9a-f]{16}", row.x) and row.ref.startswith("doc_") and len(row.ref) == 16
    assert row.t == "1970-01-01 00:00:00"
