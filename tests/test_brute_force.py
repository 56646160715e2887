"""Random inputs whose right answer is known from how they were made."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.operators import events as ev
from tidemark.operators import merge

KEYS = ["package_id", "version"]


def made_expression(rng):
    """An expression built clause by clause, with its names and joiners."""
    text, names, joiners = [], [], set()
    for i in range(rng.randint(1, 5)):
        if i:
            joiner = rng.choice(["AND", "OR", "and", "oR", None])
            if joiner:
                joiners.add(joiner.upper())
                text.append(joiner)
        name = rng.choice(["MIT", "Apache-2.0", "ANDROID", "x.y", "ORACLE", "with.in"[4:], "-later", "0BSD"])
        names.append(name)
        word = name + "+" * rng.choice([0, 0, 1, 2])
        text.append("(" * rng.choice([0, 0, 1]) + word + ")" * rng.choice([0, 0, 1]))
        if rng.random() < 0.3:
            skipped = [rng.choice(["AND", "or", "WITH", "with"]) for _ in range(rng.choice([0, 0, 1, 2]))]
            text += ["WITH", *skipped, rng.choice(["exc-2.0", "LLVM", "a+"])]
    gap = rng.choice([" ", "  ", "\t", "\n "])
    combinator = None if not joiners else joiners.pop() if len(joiners) == 1 else "MIXED"
    return gap.join(text), names, combinator


def test_license_terms(spark):
    rng = random.Random(7)
    made = [made_expression(rng) for _ in range(3000)]
    frame = spark.createDataFrame([(i, m[0]) for i, m in enumerate(made)], "i int, x string")
    rows = frame.select("i", tf.term_words(F.col("x")), tf.terms_combinator(F.col("x"))).collect()
    for i, names, combinator in rows:
        assert (names, combinator) == made[i][1:], made[i][0]
    # One foreign character anywhere makes an expression unreadable.
    bad = frame.withColumn("x", F.concat("x", F.lit(" "), F.element_at(F.array(*map(F.lit, "/:,?_&é")), F.col("i") % 7 + 1)))
    assert bad.filter(F.size(tf.term_words(F.col("x"))) > 0).count() == 0


def made_url(rng):
    host = rng.choice(["Example.ORG", "www.example.org", "WWW.a.b", "a"])
    user, port = rng.choice(["", "", "U:p@"]), rng.choice(["", "", ":8080"])
    segments = [rng.choice(["a", "B", "c%20d", "e f", "g;h"]) for _ in range(rng.randint(0, 3))]
    params = rng.choice(["", "", ";v=1", ";v=1;w"])
    slashes = "/" * rng.choice([0, 0, 1, 3])
    tail = rng.choice(["", "?q=/x", "#f/g", "?a#b", "?"])
    path = "".join("/" + s for s in segments)
    scheme = rng.choice(["http", "HTTPS", "ftp"])
    authority = (user + host + port).lower()
    if authority.startswith("www."):
        authority = authority[4:]
    kept = path
    if slashes == "" and segments:
        # The last segment loses what follows its first semicolon.
        kept = path[: len(path) - len(segments[-1])] + segments[-1].split(";")[0]
    text = f"{scheme}://{user}{host}{port}{path}{slashes}{params if segments or slashes else ''}{tail}"
    return rng.choice(["", " ", "\n"]) + text, authority + kept.rstrip("/")


def test_urls(spark):
    rng = random.Random(11)
    made = [made_url(rng) for _ in range(3000)]
    frame = spark.createDataFrame([(i, m[0]) for i, m in enumerate(made)], "i int, x string")
    for i, key in frame.select("i", tf.normalize_url(F.col("x"))).collect():
        assert key == made[i][1], made[i][0]


def test_versions(spark):
    rng = random.Random(13)
    made = []
    for _ in range(2000):
        numbers = [rng.choice([0, 1, 12, 2147483647, 2147483648, 10**12]) for _ in range(rng.randint(1, 4))]
        label = rng.choice([None, None, "beta.1", "rc-2", "0a"])
        build = rng.choice(["", "", "+b-1", "+x.y"])
        text = ".".join(map(str, numbers)) + (f"-{label}" if label else "") + build
        parts = [n if n <= 2147483647 else None for n in numbers] + [None] * 3
        made.append((text, (*parts[:3], label) if len(numbers) < 4 else (None,) * 4))
    frame = spark.createDataFrame([(i, m[0]) for i, m in enumerate(made)], "i int, x string")
    for i, parts in frame.select("i", tf.version_parts(F.col("x"))).collect():
        assert tuple(parts) == made[i][1], made[i][0]


def made_log(rng, size):
    """Events of few keys and few commit times; one key has a third of them."""
    log = []
    for place in range(size):
        key = (0, 0) if rng.random() < 1 / 3 else (rng.randint(0, 4), rng.randint(0, 3))
        log.append((*key, rng.randint(0, 40), place, rng.random() < 0.3, rng.choice([None, 1, 2, 3])))
    return log


def applied_one_by_one(log):
    """The state after applying events in commit order, deletes last at equal commits."""
    state = {}
    for package, version, commit, place, gone, value in sorted(
        log, key=lambda e: (e[2], e[4], e[3])
    ):
        if not gone:
            state[package, version] = (value, commit, None)
        elif (package, version) in state:
            value, at, _ = state[package, version]
            state[package, version] = (value, at, commit)
    return state


def as_frame(spark, log, text):
    frame = spark.createDataFrame(
        log, "package_id int, version int, commit int, place int, gone boolean, value int"
    )
    return frame.withColumn("value", F.col("value").cast("string")) if text else frame


def changes(log):
    return ev.net_changes(
        log,
        KEYS,
        commit=F.col("commit"),
        deletes=F.col("gone"),
        payload=["place", "value"],
        order=F.col("commit") * 1000 + F.col("place"),
    )


def as_dict(state, text):
    rows = state.select(*KEYS, "value", "details_at", "deleted_at").collect()
    return {
        (p, v): (int(value) if text and value is not None else value, at, gone)
        for p, v, value, at, gone in rows
    }


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_change_capture(spark, seed, text):
    rng = random.Random(seed)
    log = made_log(rng, 150)
    right = applied_one_by_one(log)
    frame = as_frame(spark, log, text)
    assert as_dict(ev.current_state(changes(frame)), text) == right

    cuts = [0, *sorted(rng.sample(range(1, 41), 3)), 41]
    batches = [
        changes(frame.filter((F.col("commit") >= a) & (F.col("commit") < b)))
        for a, b in zip(cuts, cuts[1:])
    ]
    for step in (merge.merge_changes, merge.merge_few_changes):
        state = ev.current_state(batches[0]).drop("delete_at")
        for batch in batches[1:]:
            state = step(state, batch, KEYS)
        assert as_dict(state, text) == right
        # Every batch again, newest first: late and repeated deliveries change nothing.
        rows = spark.createDataFrame(state.collect(), state.schema)
        for batch in reversed(batches):
            rows = step(rows, batch, KEYS)
        assert as_dict(rows, text) == right

    joined = batches[0]
    for batch in batches[1:]:
        joined = joined.unionByName(batch)
    combined = ev.combine_changes(joined, KEYS, ["place", "value"])
    assert as_dict(ev.current_state(combined), text) == right


def test_backfill_marks(spark):
    rng = random.Random(3)
    log = made_log(rng, 200)
    frame = as_frame(spark, log, False)
    known = ev.current_state(changes(frame.filter(~F.col("gone")))).drop("delete_at")
    marked = merge.mark_deleted(known, frame.filter("gone").withColumnRenamed("commit", "delete_at"), KEYS)
    newest = {}
    for package, version, commit, _, gone, _ in log:
        if gone:
            newest[package, version] = max(commit, newest.get((package, version), commit))
    got = {(r.package_id, r.version): r.deleted_at for r in marked.collect()}
    assert got == {k: newest.get(k) for k in {e[:2] for e in log if not e[4]}}
