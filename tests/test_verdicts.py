import pytest
from pyspark.sql import functions as F

from tidemark.operators import licenses as lic
from tidemark.operators import verdicts as vd

LICENSES = [
    ("MIT", True, ["https://opensource.org/licenses/MIT", "http://shared.example/text"]),
    ("Apache-2.0", True, ["https://www.apache.org/licenses/LICENSE-2.0"]),
    ("BSD-3-Clause", True, ["https://shared.example/text/"]),
    ("GPL-2.0", True, []),
    ("NoShare-1.0", False, ["https://noshare.example/1.0/"]),
    ("Shareware", False, None),
]

# expression, url -> class, license, approved, normalized, reason, term
CASES = {
    ("MIT", None): ("open_source", "MIT", True, "MIT", "any_approved", "MIT"),
    ("NoShare-1.0 OR MIT", None): ("open_source", "MIT", True, "NoShare-1.0 OR MIT", "any_approved", "MIT"),
    ("MIT AND Apache-2.0", None): ("open_source", "MIT", True, "MIT AND Apache-2.0", "and_all_approved", None),
    ("MIT AND NoShare-1.0 AND Shareware", None): (
        "proprietary", "NoShare-1.0", False, "MIT AND NoShare-1.0 AND Shareware", "and_blocked", "NoShare-1.0",
    ),
    ("Shareware OR NoShare-1.0", None): (
        "proprietary", "Shareware", False, "Shareware OR NoShare-1.0", "none_approved", "Shareware",
    ),
    ("LicenseRef-Own", None): ("proprietary", "LicenseRef-Own", False, "LicenseRef-Own", "custom_ref", "LicenseRef-Own"),
    ("MIT OR LICENSEREF-Own", None): (
        "proprietary", "LICENSEREF-Own", False, "MIT OR LICENSEREF-Own", "custom_ref", "LICENSEREF-Own",
    ),
    ("LicenseRef-Own AND Foo", None): (
        "unknown", None, None, "LicenseRef-Own AND Foo", "term_unrecognised", "LicenseRef-Own",
    ),
    ("mit", None): ("unknown", None, None, "mit", "term_unrecognised", "mit"),
    ("MIT / X", None): ("unknown", None, None, "MIT / X", "expr_unparsed", None),
    ("AND", None): ("unknown", None, None, "AND", "expr_unparsed", None),
    # Grouping is lost, so one approved term is enough.
    ("(MIT OR Shareware)  AND NoShare-1.0", None): (
        "open_source", "MIT", True, "(MIT OR Shareware) AND NoShare-1.0", "any_approved", "MIT",
    ),
    (" GPL-2.0+ ", "https://noshare.example/1.0"): ("open_source", "GPL-2.0", True, "GPL-2.0+", "any_approved", "GPL-2.0"),
    ("GPL-2.0 WITH Classpath-exception-2.0", None): (
        "open_source", "GPL-2.0", True, "GPL-2.0 WITH Classpath-exception-2.0", "any_approved", "GPL-2.0",
    ),
    (None, "http://www.opensource.org/licenses/MIT/"): ("open_source", "MIT", True, None, "url_known", "MIT"),
    ("  ", "https://noshare.example/1.0?x"): ("proprietary", "NoShare-1.0", False, None, "url_known", "NoShare-1.0"),
    # Two licenses name this URL; the smaller id has it.
    ("", "https://shared.example/text"): ("open_source", "BSD-3-Clause", True, None, "url_known", "BSD-3-Clause"),
    (None, "https://go.microsoft.com/fwlink/?LinkId=9"): ("proprietary", None, False, None, "url_eula", None),
    (None, "https://git.example/a/LICENSE"): ("unknown", None, None, None, "url_unrecognised", None),
    (None, "MIT"): ("unknown", None, None, None, "url_unrecognised", None),
    (None, " \t"): ("unknown", None, None, None, "no_signal", None),
    (None, None): ("unknown", None, None, None, "no_signal", None),
}


@pytest.fixture
def licenses(spark):
    return spark.createDataFrame(
        LICENSES, "license_id string, is_osi_approved boolean, see_also_urls array<string>"
    )


def judged(spark, licenses, copies=1):
    rows = [(i, e, u) for i, (e, u) in enumerate(CASES)]
    packages = spark.createDataFrame(rows, "i int, license string, license_url string")
    packages = packages.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return vd.classify(packages, licenses)


def test_verdicts(spark, licenses):
    rows = judged(spark, licenses).select("i", *["classification", "spdx_id", "is_osi_approved", "spdx_normalized", "reason", "reason_term"])
    got = {r.i: tuple(r)[1:] for r in rows.collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_verdicts_without_any_broadcast(spark, licenses):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = judged(spark, licenses, copies=50)
        assert rows.count() == 50 * len(CASES)
        got = {r.i: r.reason for r in rows.select("i", "reason").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert [got[i] for i in range(len(CASES))] == [c[4] for c in CASES.values()]


def test_empty_list_leaves_only_texts(spark, licenses):
    counts = vd.class_tally(judged(spark, licenses.limit(0))).first()
    assert counts.open_source == 0 and counts.rows_classified == len(CASES)


def test_tallies_and_profile(spark, licenses):
    tally = vd.signal_tally(vd.with_signal(judged(spark, licenses).drop("signal"), "license", "license_url")).first()
    assert tuple(tally) == (14, 6, 2)
    full = licenses.withColumn("is_fsf_libre", F.lit(True)).withColumn("is_deprecated_id", F.lit(False))
    assert tuple(lic.list_profile(full).first()) == (6, 4, 6, 0, 5)
    assert tuple(lic.list_profile(full.limit(0)).first()) == (0, 0, 0, 0, 0)
    linked = lic.licenses_linking_to(licenses, F.lit("https://opensource.org/licenses/MIT"))
    assert [r.license_id for r in linked.collect()] == ["MIT"]
