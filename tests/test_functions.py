import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import functions as tf


def apply(spark, values, build, schema="x string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    rows = frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_version_parts(spark):
    cases = {
        "1": (1, None, None, None),
        "1.2": (1, 2, None, None),
        " 1.2.3\t": (1, 2, 3, None),
        "1.2.3-beta.1": (1, 2, 3, "beta.1"),
        "1.0-a-b+c-d": (1, 0, None, "a-b"),
        "1.0+build-x": (1, 0, None, None),
        "1.2.3.4": (None,) * 4,
        "v1.0": (None,) * 4,
        "1.0-": (None,) * 4,
        "1.0+": (None,) * 4,
        "1.0-a_b": (None,) * 4,
        "1..2": (None,) * 4,
        "": (None,) * 4,
        "2147483647.2147483648": (2147483647, None, None, None),
        "1.2.3000000000-rc": (1, 2, None, "rc"),
    }
    rows = apply(spark, [*cases, None], tf.version_parts)
    assert [tuple(r) for r in rows] == [*cases.values(), (None,) * 4]


def test_package_url(spark):
    names = ["Alpha.Core_x-1~", "a b", "x*y", "p:q", "c++"]
    urls = apply(spark, names, lambda x: tf.package_url(x, F.lit("1.0+b")))
    assert urls == [
        "pkg:nuget/Alpha.Core_x-1~@1.0%2Bb",
        "pkg:nuget/a%20b@1.0%2Bb",
        "pkg:nuget/x%2Ay@1.0%2Bb",
        "pkg:nuget/p:q@1.0%2Bb",
        "pkg:nuget/c%2B%2B@1.0%2Bb",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_instant_ignores_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [
            "2024-02-08", "2024-02-08T01:02:03Z", "2024-02-08T01:02:03+02:00",
            "2024-02-08T01:02:03.25", "soon", "", "2024-13-01", None, "2024-02-08T01:02:03.1234567Z",
        ]
        micros = apply(spark, texts, lambda x: F.unix_micros(tf.parse_instant(x)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = int(dt.datetime(2024, 2, 8, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    clock = (3600 + 120 + 3) * 1_000_000
    assert micros == [
        day, day + clock, day + clock - 7200 * 1_000_000, day + clock + 250_000,
        None, None, None, None, day + clock + 123_456,
    ]


TERMS = {
    "MIT": (["MIT"], None),
    "MIT OR Apache-2.0": (["MIT", "Apache-2.0"], "OR"),
    "MIT and Apache-2.0": (["MIT", "Apache-2.0"], "AND"),
    "(MIT OR X) AND Y": (["MIT", "X", "Y"], "MIXED"),
    "GPL-2.0+ OR LGPL-2.1++": (["GPL-2.0", "LGPL-2.1"], "OR"),
    "GPL-2.0 WITH Classpath-exception-2.0": (["GPL-2.0"], None),
    "MIT WITH AND exc OR BSD": (["MIT", "BSD"], "OR"),
    "MIT WITH exc AND BSD WITH other": (["MIT", "BSD"], "AND"),
    "MIT WITH": (["MIT"], None),
    "MIT BSD": (["MIT", "BSD"], None),
    "ANDROID": (["ANDROID"], None),
    "OR-later": (["-later"], "OR"),
    "with-x MIT": (["MIT"], None),
    "MIT/X": ([], None),
    "MIT, X": ([], None),
    "AND (OR)": ([], "MIXED"),
    "()": ([], None),
    "+": ([""], None),
}


def test_license_terms(spark):
    assert apply(spark, list(TERMS), tf.term_words) == [t for t, _ in TERMS.values()]
    assert apply(spark, list(TERMS), tf.terms_combinator) == [c for _, c in TERMS.values()]


def test_whitespace(spark):
    texts = ["  a \t b\n", " a b", "", None, "\x1ca"]
    assert apply(spark, texts, tf.collapse_whitespace) == ["a b", "a b", "", None, "a"]
    blank = apply(spark, [" \t\n", "", None, "　", " x"], tf.is_blank)
    assert blank == [True, True, True, True, False]


def test_normalize_url(spark):
    cases = {
        "https://www.Opensource.org/licenses/MIT/": "opensource.org/licenses/MIT",
        "http://opensource.org/licenses/MIT?x=1#y": "opensource.org/licenses/MIT",
        " ftp://User@Host:21/p///\n": "user@host:21/p",
        "http://www.www.x/": "www.x",
        "http://h/a;b/c;d;e": "h/a;b/c",
        "git://h/a;b": "h/a;b",
        "http://h": "h",
        "http://h/a/;x": "h/a",
        "opensource.org/licenses/MIT": "",
        "file:/x": "",
        "https:///p": "",
        "http://[::1/x": "",
        "http://www./": "",
        "": "",
        "HTTP://a\tb.c/d": "ab.c/d",
    }
    assert apply(spark, list(cases), tf.normalize_url) == list(cases.values())


def test_vendor_eula(spark):
    urls = [
        " https://go.microsoft.com/fwlink/?LinkId=1", "http://GO.microsoft.com/FWLINK",
        "https://aka.ms/deprecateLicenseUrl", "http://aka.ms/pexunj/x",
        "https://go.microsoftXcom/fwlink", "see https://aka.ms/pexunj", "ftp://aka.ms/pexunj",
    ]
    assert apply(spark, urls, tf.is_vendor_eula) == [True] * 4 + [False] * 3


def test_json_text_field(spark):
    raw = [
        '{"licenseUrl":" x "}', '{"licenseUrl":5}', '{"licenseUrl":null}', "{}",
        '{"licenseUrl":"  "}', '{"licenseUrl":{"a":"b"}}', '{"licenseUrl":true}', "bad", None,
        '{"a":{"licenseUrl":"inner"},"licenseUrl":"outer"}',
    ]
    urls = apply(spark, raw, lambda x: tf.json_text_field(x, "licenseUrl"))
    assert urls == [" x ", *[None] * 8, "outer"]


def test_cursor(spark):
    cursors = ["0", "2024-01-01T00:00:00Z", "2024-01-01T02:00:00.5+02:00|a|b", "2024-01-01T00:00:00Z|"]
    back = apply(spark, cursors, tf.decode_cursor)
    utc = dt.datetime(2024, 1, 1)
    half = utc + dt.timedelta(milliseconds=500)
    assert [(r.at, r.row_id) for r in back] == [(None, ""), (utc, ""), (half, "a|b"), (utc, "")]
    again = apply(
        spark,
        cursors[1:],
        lambda x: tf.encode_cursor(tf.decode_cursor(x)["at"], tf.decode_cursor(x)["row_id"]),
    )
    assert again[1] == "2024-01-01T00:00:00.500000Z|a|b"


def test_measures(spark):
    row = spark.range(1).select(
        tf.progress_pct(F.lit(1), F.lit(3)).alias("third"),
        tf.progress_pct(F.lit(0), F.lit(0)).alias("nothing"),
        tf.progress_pct(F.lit(9), F.lit(3)).alias("over"),
        tf.share_pct(F.lit(0), F.lit(0)).alias("empty"),
        tf.per_second(F.lit(10), F.lit(0)).alias("instant"),
        tf.per_second(F.lit(10), F.lit(None).cast("bigint")).alias("running"),
        tf.duration_ms(
            F.lit("2024-01-01 00:00:00").cast("timestamp"),
            F.lit("2024-01-01 00:00:01.0006").cast("timestamp"),
        ).alias("ms"),
    ).first()
    assert tuple(row) == (33.33, 100.0, 100.0, 0.0, 10000.0, None, 1001)
