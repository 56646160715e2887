"""What grew faster than its input: parsing in one task, bytes of pairs, time of the line and suffix steps."""

import numpy as np
import pytest

from tidemark.llm import common, lines, suffixes
from tidemark.plans.workload import documents


@pytest.fixture
def one_row_group(spark, tmp_path):
    rows = [(i, f"2024-01-{1 + i % 3:02d} 10:00:00", i % 5, "error" if i % 4 == 0 else "view", 20.0 + i, f'{{"k": {i % 9}}}') for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", events.ts.cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_documents_of_one_row_group_are_made_by_all_tasks(spark, one_row_group):
    for made in (documents._page_documents, documents._leaf_documents):
        assert made(spark, one_row_group).rdd.getNumPartitions() > 1


def test_suffixes_that_have_their_place_are_not_sorted_again(monkeypatch):
    rng, sorted_, argsort = np.random.default_rng(0), [], np.argsort
    symbols = np.append(rng.integers(1, 257, 5000), 0).astype(np.int16)
    symbols[3000:3600] = symbols[1000:1600]
    monkeypatch.setattr(suffixes.np, "argsort", lambda a, **kw: sorted_.append(len(a)) or argsort(a, **kw))
    order = suffixes.suffix_order(symbols, 400)
    monkeypatch.undo()
    assert sum(sorted_) < 3 * len(symbols)
    assert [bytes(symbols[i:].astype(">i2"))[:800] for i in order] == sorted(bytes(symbols[i:].astype(">i2"))[:800] for i in order)
    heads = suffixes.shared_intervals(symbols, 400)[1]
    assert len(symbols) - len(heads) == 201


def test_texts_are_cut_into_lines_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five\nb\n"), (2, " one\ttwo  three four\nb"), (3, "one two three four five\n \nc")], "doc_id long, text string")
    plans, stored = [], common.settled
    for module in (common, lines):
        monkeypatch.setattr(module, "settled", lambda df, purpose: plans.append(df._jdf.queryExecution().toString()) or stored(df, purpose))
    got = {r.doc_id: (r.kept_text, r.n_removed) for r in lines.dedup_lines(docs).select("row.doc_id", "kept_text", "n_removed").collect()}
    assert got == {1: ("one two three four five\nb\n", 0), 2: (" one\ttwo  three four\nb", 0), 3: ("\n".join([" ", "c"]), 1)}
    assert sum("posexplode" in p for p in plans) == 1


def test_long_lines_are_those_of_five_words(spark):
    texts = ["a b c d e", " \ta b\vc d\fe ", "a b c d ", "  a  b", "a", "é b c d è", "a b c d\r", "x" * 50 + " b c d e"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.long for r in lines.line_rows(docs, 5).collect()}
    assert got == {i: len(t.encode().split()) >= 5 for i, t in enumerate(texts)}
