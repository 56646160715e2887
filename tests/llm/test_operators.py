"""The ten operators against plain versions of themselves, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import os
import random
import re

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, chunks, graph_ann, jaccard_join, lines, mixing, pseudo_likelihood, quality, queries, resharding, suffixes
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(400)] + ["the", "of", "and", "Zürich", "naïve"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def awkward_rows():
    rng = random.Random(5)
    base = prose(rng, 300)
    passage = "\n".join(prose(rng, 30) for _ in range(4))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " end of it", "en", "b"), (3, base + " end of it", "en", "b"),
        (4, None, None, None), (5, "", "en", ""), (6, " \t\n ", "de", "b"), (7, "one", "fr", "a"), (8, "One", "es", "c"),
        (None, base, None, None), (None, "alone here", "en", None), (9, "ab " * 4000, "en", "a"), (10, "x" * 5000, "en", "c"),
        (11, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 60), "en", "d"),
        (12, prose(rng, 40) + "\n" + passage, "en", "d"), (13, passage + "\n\n" + prose(rng, 90), "en", "d"),
        (14, prose(rng, 20000), "en", "a"), (15, "é中\U0001f600 " * 300, "zz", "e"), (16, "the of and\n" * 40, "en", "e"),
    ]
    words = base.split()
    for k in range(12):  # near copies, from links to none
        changed = list(words)
        for i in rng.sample(range(len(words)), k * 2):
            changed[i] = f"other{k}-{i}"
        rows.append((20 + k, " ".join(changed), "en", "f"))
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns whose names the operators use inside."""
    frame = spark.createDataFrame(awkward_rows(), SCHEMA)
    return frame.select("*", *(F.lit("x").alias(c) for c in ("key", "size", "row", "a", "rank", "shard", "token", "_key", "label", "ids", "spans"))).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


# -- 1 -----------------------------------------------------------------------


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = WORD.findall(lowered)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    out = []
    for (doc_id, _), s, g in zip(rows, sets, group, strict=True):
        ids = [r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None]
        out.append((doc_id, len(s), (min(ids) if ids else None) if s else doc_id))
    return sorted(out, key=repr)


def test_jaccard_join(docs):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    found = jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
    assert collected(found) == plain_components(rows)


def test_jaccard_join_chains_and_frequent_shingles(spark):
    """Chains of near copies reach their ends, and a passage in all documents links nothing."""
    rng = random.Random(2)
    passage, rows = prose(rng, 40), []
    for g in range(12):
        words = prose(rng, 120).split()
        for k in range(6):
            rows.append((g * 10 + k, " ".join(words) + " " + passage))
            for i in rng.sample(range(len(words)), 5):
                words[i] = f"n{g}-{k}-{i}"
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_join.jaccard_components(frame).select("doc_id", "n_shingles", "component_id")
    assert collected(found) == plain_components(rows)


def test_pairs_of_a_run_are_listed_about_once(spark):
    """Texts that share half of their rare shingles are no candidates, and a pair that meets in many runs is not listed in each."""
    rng, rows = random.Random(5), []
    for g in range(4):
        body, near = prose(rng, 150), prose(rng, 150).split()
        for k in range(12):
            rows.append((g * 100 + k, body + " " + " ".join(f"own{g}-{k}-{i}" for i in range(150))))
            rows.append((g * 100 + 50 + k, " ".join(near)))
            for i in rng.sample(range(len(near)), 2):
                near[i] = f"new{g}-{k}-{i}"
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets, sketches = jaccard_join.set_table(frame)
    labelled = jaccard_join.shared_prefixes(frame, sets, sketches).withColumn("label", F.col("a"))
    dealt = jaccard_join._token_rows(labelled).repartition("token").sortWithinPartitions("token", "label", "a")
    listed = collected(dealt.mapInArrow(jaccard_join._cross_pairs, "a long, b long"))
    digest = {r["doc_id"]: r["digest"] for r in sets.collect()}
    texts = {digest[doc_id]: plain_set(text) for doc_id, text in rows}
    links = {(a, b) for a in texts for b in texts if a < b and 100 * len(texts[a] & texts[b]) >= 75 * len(texts[a] | texts[b])}
    assert len(links) > 50
    assert links <= set(listed) == set(collected(jaccard_join.all_pairs(labelled)))
    assert len(listed) <= 4 * len(set(listed))
    halves = {digest[doc_id] for doc_id, _ in rows if doc_id % 100 < 50}
    assert not any(a in halves for a, _ in listed)


def test_jaccard_join_of_nothing(empty):
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_one_of_each(docs):
    kept = collected(jaccard_join.one_of_each(docs).select("doc_id", "text"))
    rows = [(r[0], r[1]) for r in awkward_rows()]
    components_ = {c for _, n, c in plain_components(rows) if n}
    ids = [doc_id for doc_id, text in kept if plain_set(text) and doc_id is not None]
    assert sorted(ids) == sorted(c for c in components_ if c is not None)
    assert sum(doc_id is None for doc_id, _ in kept) == 1  # "alone here"; the other row without an id has copies
    assert [doc_id for doc_id, text in kept if not plain_set(text)] == [4, 5, 6]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7)]
    found = dict(collected(components(spark.createDataFrame(chain, "a long, b long"))))
    assert found == {i: 0 for i in range(61)} | {100: 100, 103: 100, 105: 100}


def test_signatures_bound_common_tokens():
    rng = np.random.default_rng(3)
    for size in (1, 20, 300):
        sets = [np.unique(rng.integers(0, 4 * size, size).astype(np.uint64) * jaccard_join.FACTORS[0]) for _ in range(40)]
        words = [np.zeros(len(sets), np.uint64) for _ in jaccard_join.SIGNATURE]
        for row, tokens in enumerate(sets):
            for token in tokens.tolist():
                words[token >> 6 & 3][row] |= np.uint64(1 << (token & 63))
        held = np.array([len(x) for x in sets])
        x, y = (c.ravel() for c in np.mgrid[: len(sets), : len(sets)])
        most = jaccard_join._most_common(held, [w.view(np.int64) for w in words], x, y)
        common = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)]
        assert (most >= common).all()
        assert (most[x == y] == held).all()


def test_prefix_filter_loses_no_link(spark):
    """Sets right at the threshold pass all filters."""
    rng, rows = np.random.default_rng(1), []
    for _ in range(300):
        common = rng.integers(1, 60)
        rest = int(common / 0.75) - common + int(rng.integers(0, 2))
        left = rng.integers(0, rest + 1)
        tokens = rng.integers(0, 1 << 63, common + rest, dtype=np.uint64)
        x = np.unique(tokens[: common + left])
        y = np.unique(np.concatenate([tokens[:common], tokens[common + left :]]))
        both = len(np.intersect1d(x, y))
        rows.append((x.view(np.int64).tolist(), y.view(np.int64).tolist(), bool(100 * both >= 75 * (len(x) + len(y) - both))))
    frame = spark.createDataFrame(rows, "x array<long>, y array<long>, want boolean")
    found = frame.select(jaccard_join.linked(F.col("x"), F.col("y")).alias("got"), "want")
    assert found.filter("got <> want").count() == 0
    assert 50 < found.filter("want").count() < 300


# -- 2 -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(open(PATH, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (64, 40), (50, 10)])
def test_bpe(docs, library, chunk, overlap):
    rows = docs.withColumn("text", F.concat("text", F.lit("  it's  we'll\n\n 12 <|endoftext|> \t "))).union(docs)
    got = bpe.encode(rows, PATH, public_tokenizers.PATTERN, chunk, overlap).select("row.text", "ids").collect()
    assert len(got) == 2 * len(awkward_rows())
    for text, ids in got:
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text or "")


def test_bpe_round_trip(docs):
    for r in bpe.encode_and_decode(docs, PATH, public_tokenizers.PATTERN).select("row.text", "n_tokens", "ids", "decoded").collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["n_tokens"] * 4 == len(r["ids"])


def test_decode(docs):
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    for text, decoded in bpe.decode(coded, PATH, public_tokenizers.PATTERN).select("row.text", "decoded").collect():
        assert bytes(decoded) == (text or "").encode()


def test_bpe_of_nothing(empty):
    assert bpe.encode_and_decode(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_merges_of_long_pieces(library):
    ranks = bpe.read_ranks(open(PATH, "rb").read())
    rng = random.Random(3)
    for n in (1, 2, 3, 50, 3000):
        for letters in ("a", "ab", "abcdefgh é"):
            piece = "".join(rng.choice(letters) for _ in range(n)).encode()
            assert bpe.merge(piece, ranks) == bpe._merge_long(piece, ranks) == library._core_bpe.encode_single_piece(piece)


# -- 3 -----------------------------------------------------------------------


def test_scores_match_a_plain_sum(docs):
    values = pseudo_likelihood.train(docs)
    model = pseudo_likelihood.shaped(values)
    for r in pseudo_likelihood.score(docs, values).select("row.text", "n_words", "pseudo_log_likelihood", "mean_log_probability").collect():
        classes = [int(c) for c in pseudo_likelihood.word_classes((r["text"] or "").encode())]
        assert r["n_words"] == len(classes)
        if len(classes) > 500:
            continue
        total, edge = 0.0, pseudo_likelihood.CLASSES
        for i, c in enumerate(classes):
            near = [classes[i + k] if 0 <= i + k < len(classes) else edge for k in pseudo_likelihood.WINDOW]
            h = np.tanh(model[1] + sum(model[0][k, w] for k, w in enumerate(near)))
            g, m = divmod(c, pseudo_likelihood.GROUPS)
            for x, at in ((h @ model[2] + model[3], g), (h @ model[4][g] + model[5][g], m)):
                total += x[at] - np.log(np.exp(x.astype(float)).sum())
        assert r["pseudo_log_likelihood"] == pytest.approx(total, rel=1e-3, abs=1e-3)
        assert (r["mean_log_probability"] is None) == (not classes)


@pytest.mark.parametrize("frequent", [1 << 16, 20])
def test_each_word_has_a_probability_of_its_own(spark, docs, frequent, monkeypatch):
    """The class's probability times the word's share of the class; unseen words share what is left."""
    monkeypatch.setattr(pseudo_likelihood, "FREQUENT", frequent)
    texts = [(r[1] or "").encode() for r in awkward_rows()]
    counts = collections.Counter(w for t in texts for w in t.lower().split())
    classes = {w: int(pseudo_likelihood.word_classes(w)[0]) for w in counts}
    sizes = collections.Counter()
    for w, n in counts.items():
        sizes[classes[w]] += n
    values, words = pseudo_likelihood.train(docs), pseudo_likelihood.word_table(docs)
    assert sorted(r["n"] for r in words.collect()) == sorted(counts.values())

    def check(frame):
        columns = ("row.text", "n_words", "pseudo_log_likelihood")
        whole = collected(pseudo_likelihood.score(frame, values, words).select(*columns))
        coarse = collected(pseudo_likelihood.score(frame, values).select(*columns))
        for (text, n_words, got), (_, _, base) in zip(whole, coarse, strict=True):
            ws = (text or "").encode().lower().split()
            shares = [np.log(counts.get(w, pseudo_likelihood.UNSEEN) / (sizes[int(pseudo_likelihood.word_classes(w)[0])] + pseudo_likelihood.UNSEEN)) for w in ws]
            assert n_words == len(ws)
            assert got == pytest.approx(base + sum(shares), rel=1e-6, abs=1e-6)
        return {r[0]: r[2] for r in whole}

    check(docs)
    # gibberish of the same class scores below the word that it stands for
    gibberish = next(x for x in map("zq{}".format, range(10**6)) if pseudo_likelihood.word_classes(x.encode())[0] == classes[b"w7"])
    found = check(spark.createDataFrame([(1, "w1 w7 w2"), (2, f"w1 {gibberish} w2")], "doc_id long, text string"))
    assert found["w1 w7 w2"] > found[f"w1 {gibberish} w2"] + 1
    got = collected(pseudo_likelihood.pseudo_likelihood(docs).select("row.text", "pseudo_log_likelihood"))
    want = collected(pseudo_likelihood.score(docs, values, words).select("row.text", "pseudo_log_likelihood"))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-6)


def test_every_word_is_a_target_once(docs, monkeypatch):
    """Over all turns and slices, with its window; slices grow with the input."""
    for seed, n in itertools.product((0, 4, 11), range(15)):
        classes = np.arange(n, dtype=np.int32)
        word, near = pseudo_likelihood.windows([classes])
        seen = [x for t in range(pseudo_likelihood.MASK_EVERY) for x in zip(*map(np.ndarray.tolist, pseudo_likelihood.targets(classes, seed, t)), strict=True)]
        assert sorted(seen) == sorted(zip(word.tolist(), near.tolist(), strict=True))
    monkeypatch.setattr(pseudo_likelihood, "SLICE_BYTES", 60000)
    rows, slices = pseudo_likelihood.encoded(docs)
    assert slices > 2 and {r["slice"] for r in rows.collect()} <= set(range(slices))
    start, seen = pseudo_likelihood.flat(pseudo_likelihood.new_model()), 0
    for i, turn in itertools.product(range(slices), range(pseudo_likelihood.MASK_EVERY)):
        found = pseudo_likelihood.copies(rows.filter(F.col("slice") == i), start, turn).filter("part = 0").collect()
        seen += sum(r["examples"] for r in found)
    assert seen == sum(len((r[1] or "").encode().split()) for r in awkward_rows())


def test_gradients():
    """A step goes downhill, as the numeric slope says."""
    rng = np.random.default_rng(0)
    word, near = rng.integers(0, 1024, 64), rng.integers(0, 1025, (64, 4))
    model = pseudo_likelihood.new_model()
    memory = [np.zeros_like(p) for p in model]
    before = pseudo_likelihood.log_probabilities(model, near, word).mean()
    for _ in range(30):
        pseudo_likelihood.train_step(model, memory, near, word)
    assert pseudo_likelihood.log_probabilities(model, near, word).mean() > before + 1


def test_words_are_cut_for_classes_and_for_scores_only(spark):
    """Rows are read for their size, for classes and counts, for scores, and beside the result."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = [(r[0], r[1]) for r in awkward_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
    assert len(pseudo_likelihood.pseudo_likelihood(docs).collect()) == len(rows)
    assert read.value <= 4 * len(rows)


def test_masked_words_of_many_texts():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 1024, n).astype(np.int16) for n in (0, 1, 5, 6, 7, 40, 0, 13)]
    seeds = rng.integers(0, 1 << 30, len(texts))
    for turn in range(pseudo_likelihood.MASK_EVERY):
        word, near = pseudo_likelihood.masked(texts, seeds, turn)
        each = [pseudo_likelihood.targets(t, s, turn) for t, s in zip(texts, seeds.tolist(), strict=True)]
        assert word.tolist() == [x for w, _ in each for x in w.tolist()]
        assert near.tolist() == [x for _, n in each for x in n.tolist()]


def test_run_sums_round_as_numpy_does():
    rng = np.random.default_rng(6)
    rows = rng.standard_normal((300, 16)).astype(np.float32)
    for sizes in ([1], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 17, 130], [1, 1, 1], [8, 8], [9], [2, 300, 1]):
        place, at = rng.integers(0, len(rows), sum(sizes)), np.cumsum(sizes) - sizes
        sums, order = pseudo_likelihood._run_sums(rows, place, at)
        assert np.array_equal(sums, np.add.reduceat(rows[place], at)[order])


def test_held_out_texts_beat_shuffled_ones(spark):
    """After training, unseen sentences of the same kind score above the same words in random order."""
    rng = random.Random(8)
    follow = {w: rng.sample(VOCABULARY, 2) for w in VOCABULARY}

    def text(n):
        out = [rng.choice(VOCABULARY)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return out

    train = spark.createDataFrame([(i, " ".join(text(200))) for i in range(1500)], "doc_id long, text string").repartition(4)
    values = pseudo_likelihood.train(train)
    held = [text(100) for _ in range(30)]
    mixed = [rng.sample(t, len(t)) for t in held]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(held + mixed)], "doc_id long, text string")
    score = {r[0]: r[1] for r in pseudo_likelihood.score(frame, values).select("row.doc_id", "pseudo_log_likelihood").collect()}
    assert sum(score[i] > score[i + 30] for i in range(30)) >= 27


def test_scores_of_nothing(empty):
    assert pseudo_likelihood.pseudo_likelihood(empty).count() == 0


# -- 4 -----------------------------------------------------------------------


def test_quality_measures(docs):
    for r in quality.quality_rules(docs).collect():
        text = r["row"]["text"] or ""
        ws = WORD.findall(text)
        windows = collections.Counter(zip(ws, ws[1:], ws[2:], strict=False))
        covered = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
        worded = [x for x in text.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"]) == (len(ws), sum(map(len, ws)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == len(worded) - len(set(worded))
        assert r["n_repeat_words"] == len(covered)
        failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_quality_verdicts(spark):
    """Texts unlike their language's reference go; short, unlisted and ordinary ones stay."""
    rng = random.Random(4)
    english = quality.COMMON_WORDS["en"]

    def clean(n):
        return " ".join(rng.choice(english) if rng.random() < 0.4 else "".join(rng.choice("abdeorstn") for _ in range(6)) for _ in range(n))

    rows = [(i, clean(120), "en") for i in range(60)]
    rows += [(100, " ".join(f"{rng.random()}%%$$" for _ in range(90)), "en"), (101, clean(90).upper() + " A B", "en")]
    rows += [(102, clean(90), None), (103, " ".join(f"{rng.random()}" for _ in range(90)), "xx"), (104, None, "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r[0]: r[1] for r in quality.quality_rules(frame).select("row.doc_id", "kept").collect()}
    assert all(kept[i] for i in range(60))
    assert [kept[i] for i in range(100, 105)] == [False, False, True, True, False]


def test_quality_of_a_small_language(spark):
    """A language of a few documents is judged as a large one is; texts that fail by repeats are no reference."""
    rng = random.Random(5)
    german = quality.COMMON_WORDS["de"]

    def clean(n):
        return " ".join(rng.choice(german) if rng.random() < 0.4 else "".join(rng.choice("abdeorstn") for _ in range(6)) for _ in range(n))

    rows = [(i, clean(200), "de") for i in range(8)]
    rows += [(10, " ".join(f"{rng.random()}%%$$" for _ in range(50)), "de"), (11, "### $$$ %%% " * 4000, "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = dict(quality.quality_rules(frame).select("row.doc_id", "kept").collect())
    assert kept == {**dict.fromkeys(range(8), True), 10: False, 11: False}
    alone = frame.filter("doc_id = 3")
    assert [r["kept"] for r in quality.quality_rules(alone).collect()] == [True]


def test_js_distance(spark):
    def half(p, m):
        return sum(x * np.log2(x / y) for x, y in zip(p, m, strict=True) if x > 0)

    cases = [([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 5]), ([4, 4], [1, 1]), ([0, 7, 1], [2, 0, 9])]
    frame = spark.createDataFrame(cases, "x array<long>, y array<long>")
    for x, y, d in frame.select("x", "y", quality.js_distance(F.col("x"), F.col("y"))).collect():
        p, q = np.array(x) / sum(x), np.array(y) / sum(y)
        assert d == pytest.approx(np.sqrt(max(0, (half(p, (p + q) / 2) + half(q, (p + q) / 2)) / 2)), abs=1e-9)


def test_quality_of_nothing(empty):
    assert quality.quality_rules(empty).count() == 0


# -- 5 -----------------------------------------------------------------------


def plain_lines(rows, m, min_words):
    """What lies in the longest run, from any place, that an earlier place has too, if it has m lines or is one of enough words.

    Over documents in order of doc_id (null last) and text hash.
    """
    keyed = {(d is None, d or 0, hashlib.md5((t or "").encode()).hexdigest()): t or "" for d, t in rows}
    seqs = {k: [x for x in t.split("\n") if WORD.search(x)] for k, t in keyed.items()}
    places = [(k, i) for k in sorted(seqs) for i in range(len(seqs[k]))]
    gone = collections.defaultdict(set)
    for at, (k, i) in enumerate(places):
        for other, j in places[:at]:
            n = 0
            while i + n < len(seqs[k]) and j + n < len(seqs[other]) and seqs[k][i + n] == seqs[other][j + n]:
                n += 1
            if n >= m or (n and len(WORD.findall(seqs[k][i])) >= min_words):
                gone[k].update(range(i, i + (n if n >= m else 1)))
    out = []
    for d, t in rows:
        k = (d is None, d or 0, hashlib.md5((t or "").encode()).hexdigest())
        split = (t or "").split("\n")
        lined = [i for i, x in enumerate(split) if WORD.search(x)]
        drop = {lined[s] for s in gone[k]}
        text = t if not drop else "" if len(drop) == len(lined) else "\n".join(x for i, x in enumerate(split) if i not in drop)
        runs = sum(s - 1 not in gone[k] for s in gone[k])
        out.append((d, text, len(lined), len(drop), runs))
    return sorted(out, key=repr)


@pytest.mark.parametrize("m,min_words", [(1, 5), (2, 5), (2, 2), (3, 99), (5, 5)])
def test_line_dedup(spark, docs, m, min_words):
    rng = random.Random(m)
    rows = [(i, "\n".join(rng.choice(["a b", "c", "d e", "f", "", "g h", "v w x y z"]) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(50 + i, rows[30][1]) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(frame, m, min_words).select("row.doc_id", "kept_text", "n_lines", "n_removed", "n_runs")
    assert collected(got) == plain_lines(rows, m, min_words)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = lines.dedup_lines(docs, m, min_words).select("row.doc_id", "kept_text", "n_lines", "n_removed", "n_runs")
    assert collected(got) == plain_lines(rows, m, min_words)


def test_doubling_ends_with_the_longest_repeat(spark):
    """21 lines in common are found in rounds of 1, 2, 4, 8 and 16; one line inside a document repeats on its own."""
    passage = [f"line {i}" for i in range(21)]
    rows = [(1, "\n".join(["x", *passage, "y"])), (2, "\n".join([*passage, "z", "x"])), (3, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rounds = lines.suffix_rounds(frame)
    assert [n for n, _ in rounds] == [1, 2, 4, 8, 16]
    assert [s.count() for _, s in rounds] == [44, 40, 36, 28, 12]
    assert [s.filter("later").count() for _, s in rounds] == [22, 20, 18, 14, 6]
    got = collected(lines.dedup_lines(frame).select("row.doc_id", "kept_text", "n_removed", "n_runs", "longest_shared"))
    assert got == [(1, rows[0][1], 0, 0, 0), (2, "z\nx", 21, 1, 16), (3, "alone", 0, 0, 0)]


def test_pipeline_drops_single_repeated_lines(spark):
    """A line of five words that repeats among other neighbours goes, a short one stays; so does a one-line document's copy."""
    five = "a line of five words"
    rows = [(1, f"own a\n{five}\nYes.\nown b"), (2, f"own c\n{five}\nown d\nYes."), (3, five), (4, "one line"), (5, "one line"), (6, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = collected(corpus_pipeline.line_dedup(spark, frame, ""))
    assert kept == [(1, rows[0][1]), (2, "own c\nown d\nYes."), (4, "one line"), (5, "one line"), (6, None), (7, "")]


def test_lines_of_nothing(empty):
    assert lines.dedup_lines(empty).count() == 0


# -- 6 -----------------------------------------------------------------------


def plain_repeats(texts, least):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + least] for r in raws for i in range(len(r) - least + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - least + 1):
            if seen[r[i : i + least]] > 1:
                covered[i : i + least] = True
        runs = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        out.append((len(r), int(covered.sum()), runs, np.frombuffer(r, np.uint8)[~covered[: len(r)]].tobytes()))
    return sorted(out)


@pytest.mark.parametrize("least,gram", [(400, 128), (40, 16), (17, 8)])
def test_suffix_dedup(docs, least, gram):
    got = suffixes.remove_repeats(docs, least, gram).select("n_bytes", "n_removed", "n_spans", "kept").collect()
    texts = [r[1] for r in awkward_rows()]
    assert sorted((*r[:3], bytes(r[3])) for r in got) == plain_repeats(texts, least)


def test_suffix_dedup_of_random_overlaps(spark):
    rng = random.Random(11)
    blocks = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(5, 60))) for _ in range(30)]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = suffixes.remove_repeats(frame, 40, 16).select("n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted((*r[:3], bytes(r[3])) for r in got) == plain_repeats(texts, 40)


@pytest.mark.parametrize("bound", [0, 3000, 20000])
def test_suffix_dedup_splits_hot_groups(spark, docs, bound, monkeypatch):
    """Boilerplate in many surroundings finds its repeats, and no hash gathers more than the bound in a task."""
    monkeypatch.setattr(suffixes, "GROUP_BYTES", bound, raising=False)
    real = suffixes._blocks

    def bounded(batches, least):
        sizes = {}
        for batch in batches:
            for anchor, digest, _, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes.setdefault(anchor, {})[digest] = len(raw)
            if max((sum(x.values()) for x in sizes.values()), default=0) > bound:
                raise ValueError("a group beyond the bound")
            yield from real(iter([batch]), least)

    monkeypatch.setattr(suffixes, "_blocks", bounded)
    rng = random.Random(3)
    boilerplate, middle = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (60, 20))
    texts = []
    for k in range(120):
        near = middle if k % 3 else "".join(rng.choice("abcdefgh ") for _ in range(5))
        sides = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(50, 80))) for _ in range(2)]
        texts.append(near.join([sides[0], boilerplate, sides[1]]))
    texts += texts[:5] + [r[1] for r in awkward_rows()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffixes.remove_repeats(frame, 40, 16).select("n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted((*r[:3], bytes(r[3])) for r in got) == plain_repeats(texts, 40)


def test_shared_intervals():
    rng = np.random.default_rng(6)
    for n, letters, depth in ((200, 2, 5), (500, 3, 9), (300, 1, 20), (64, 4, 2)):
        symbols = np.append(rng.integers(1, letters + 1, n), 0).astype(np.int16)
        order, heads = suffixes.shared_intervals(symbols, depth)
        padded = [tuple(symbols[i : i + depth]) + (0,) * max(0, i + depth - n - 1) for i in order.tolist()]
        whole = [len(p) == depth and 0 not in p for p in padded]
        starts = [i for i in range(n + 1) if i == 0 or padded[i] != padded[i - 1]]
        assert {h for h in heads.tolist() if whole[h]} == {s for s in starts if whole[s]}


def test_suffixes_of_nothing(empty):
    assert suffixes.remove_repeats(empty).count() == 0


# -- 7 -----------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {s: 0.0 for s in names}, set(names)
    left = 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + share * weight[s] > 2 * sizes[s]}
        for s in open_:
            target[s] = 2 * sizes[s] if s in full else target[s] + share * weight[s]
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        open_ -= full
    return target


def test_mix(docs):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == len(awkward_rows())
    sizes = collections.Counter()
    for _, text, _, source, _ in awkward_rows():
        sizes[source] += len(WORD.findall(text or ""))
    target, taken = plain_targets(sizes), collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS
    assert collected(mixing.mixed(docs)) == sorted(map(tuple, rows), key=repr)


def test_mix_of_many_shards(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 2)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 4)
    taken = collections.Counter()
    target = {}
    for r in mixing.mixed(docs).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(20, 0.02 * t)


def test_mix_documents(docs):
    want = collections.Counter()
    for r in mixing.mixed(docs).collect():
        want[r["source"]] += r["taken"]
    got = collections.Counter()
    for r in mixing.mix_documents(docs).select("source", "text").collect():
        got[r["source"]] += len(WORD.findall(r["text"]))
    assert +got == +want


def test_sainte_lague(spark):
    rng = random.Random(9)
    for n, seats in ((1, 5), (7, 3), (20, 400), (30, 29), (4, 0)):
        votes = [rng.choice([0, 1, 5, 50, 5000]) * rng.random() for _ in range(n)]
        frame = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "k int, votes double, seats long")
        got = dict(mixing.sainte_lague(frame, [], ["k"]).select("k", "quota").collect())
        best = sorted(((-v / (2 * s + 1), i) for i, v in enumerate(votes) for s in range(seats) if v), key=lambda x: x)[:seats]
        want = collections.Counter(i for _, i in best)
        assert got == {i: want[i] for i in range(n)}


def test_mix_of_nothing(empty):
    assert mixing.mixed(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0


# -- 8 -----------------------------------------------------------------------


def test_reshard(docs):
    placed = resharding.reshard(docs.withColumn("old_file", F.when(F.col("doc_id") < 9, "p").when(F.col("doc_id") < 22, "q")), F.col("old_file"), 4)
    rows = placed.collect()
    assert len(rows) == len(awkward_rows())
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sum(r["size"] for r in rows) == sum(len((r[1] or "").encode()) + 1 for r in awkward_rows())


def test_reshard_sizes_and_moves(spark):
    import zlib

    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(5, 60)), f"f{0 if i % 3 else i % 7}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, file string").repartition(4)
    placed = resharding.reshard(frame, F.col("file")).toPandas()
    sizes = placed.groupby("shard")["size"].sum()
    largest = placed["size"].max()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * largest
    old = placed.groupby("old")["size"].sum()
    capacity = placed["size"].sum() / 16
    stays = placed[placed.old == placed["shard"]]["size"].sum()
    assert stays >= sum(min(s, capacity) for i, s in old.items() if i < 16) - 16 * largest
    texts = dict((r[0], r[1]) for r in rows)
    assert all(zlib.crc32(texts[r.doc_id].encode()) == r.text_crc32 for r in placed.itertuples())


def test_transfers_are_cheapest():
    """Against all ways to fill small shards."""
    rng = random.Random(1)
    for _ in range(40):
        m, n = rng.randrange(1, 4), rng.randrange(1, 4)
        old = [rng.randrange(0, 5) for _ in range(m)]
        total = sum(old)
        capacity = [total * (j + 1) // n - total * j // n for j in range(n)]
        moves = resharding.transfers(old, capacity)
        assert [sum(b for i, _, b in moves if i == k) for k in range(m)] == old
        assert [sum(b for _, j, b in moves if j == k) for k in range(n)] == capacity
        units = [i for i, s in enumerate(old) for _ in range(s)]
        places = [j for j, c in enumerate(capacity) for _ in range(c)]
        best = min((sum(i != j for i, j in zip(units, p, strict=True)) for p in set(itertools.permutations(places))), default=0) if total <= 8 else None
        if best is not None:
            assert sum(b for i, j, b in moves if i != j) == best


def test_rewrite_leaves_shards_that_do_not_change(spark, tmp_path):
    rows = [(i, "x" * 9, i % 2) for i in range(64)] + [(100 + i, "y" * 9, 2) for i in range(16)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, old long")
    placed = resharding.reshard(frame, F.col("old").cast("string"), 2)
    same = resharding.reshard(frame.filter("old < 2"), F.col("old").cast("string"), 2)
    path = str(tmp_path / "new")
    assert resharding.rewrite(frame, placed, path) == []
    assert spark.read.parquet(path).count() == 80
    assert resharding.rewrite(frame.filter("old < 2"), same, str(tmp_path / "same")) == [0, 1]


def test_reshard_of_nothing(empty):
    assert resharding.reshard(empty, F.lit("f")).count() == 0


# -- 9 -----------------------------------------------------------------------




def test_gear_hash():
    rng = np.random.default_rng(4)
    for n in (1, 5, 31, 32, 33, 200):
        data, h, want = rng.integers(0, 256, n, dtype=np.uint8), 0, []
        for b in data.tolist():
            h = (2 * h + int(chunks.GEAR[b])) & 0xFFFFFFFF
            want.append(h)
        assert chunks.gear_hashes(data).tolist() == want


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(6)
    text = prose(rng, 3000).encode()
    edges = chunks.chunk_starts(np.frombuffer(text, np.uint8)).tolist()
    assert edges[0] == 0 and edges == sorted(set(edges))
    other = (prose(rng, 7) + " ").encode() + text
    moved = {e - len(other) + len(text) for e in chunks.chunk_starts(np.frombuffer(other, np.uint8)).tolist()}
    assert sum(e in moved for e in edges) >= len(edges) - 3
    assert not len(chunks.chunk_starts(np.empty(0, np.uint8)))
    for raw in ("é中\U0001f600".encode() * 500, b"a" * 5000, b"short"):
        data = np.frombuffer(raw, np.uint8)
        starts = chunks.chunk_starts(data).tolist()
        assert all((raw[s] & 0xC0) != 0x80 for s in starts)
        assert all(b - a <= chunks.MAX_CHUNK + 3 for a, b in zip(starts, [*starts[1:], len(raw)], strict=True))


@pytest.mark.parametrize("block", [chunks.BLOCK_CHUNKS, 3])
def test_chunk_dedup(spark, docs, block, monkeypatch):
    monkeypatch.setattr(chunks, "BLOCK_CHUNKS", block)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    keys = {t: k for t, k in docs.select("text", F.xxhash64("text")).distinct().collect()}
    seen, kept = set(), {}
    for null, doc, key, text in sorted({(d is None, d or 0, keys[t], t) for d, t in rows}, key=lambda x: x[:3]):
        raw = (text or "").encode()
        edges = [*chunks.chunk_starts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
        parts = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if raw[a:b] not in seen:
                parts.append(raw[a:b])
            seen.add(raw[a:b])
        kept[null, doc, key] = b"".join(parts) if raw else raw
    want = sorted(((d, None if t is None else kept[d is None, d or 0, keys[t]].decode()) for d, t in rows), key=repr)
    assert collected(chunks.dedup_chunks(docs).select("row.doc_id", "kept_text")) == want


def test_shared_passages_are_found(spark):
    rng = random.Random(13)
    passage = prose(rng, 90)
    rows = [(i, prose(rng, 100 + i) + " " + passage + " " + prose(rng, 80)) for i in range(8)] + [(50, prose(rng, 300))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1] for r in chunks.dedup_chunks(frame).select("row.doc_id", "n_removed").collect()}
    assert got[0] == got[50] == 0
    assert all(got[i] > len(passage) / 2 for i in range(1, 8))


def test_chunks_of_nothing(empty):
    assert chunks.dedup_chunks(empty).count() == 0


# -- 10 ----------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((3000, 24)) + 2 * rng.standard_normal((30, 24))[rng.integers(0, 30, 3000)]
    rows = [(i, v.astype(float).tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5001, []), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [None] * 24), (5200, [1.0, 2.0])]
    same = vectors[0].tolist()
    rows += [(6000 + i, same) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = graph_ann.nearest(frame, frame.filter("vec_id % 50 = 0")).toPandas()
    ids = np.array([*range(3000), *range(6000, 6300)])
    unit = np.concatenate([vectors, np.tile(vectors[0], (300, 1))])
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    hits, total = 0, 0
    for q in ids[ids % 50 == 0]:
        own = int(np.flatnonzero(ids == q)[0])
        score = unit @ unit[own]
        others = ids != q
        best = ids[others][np.lexsort((ids[others], -np.round(score[others], 12)))][:5]
        got = found[found.query_id == q].sort_values("rank")
        assert got["rank"].tolist() == [1, 2, 3, 4, 5]
        assert q not in set(got.vec_id)
        for r in got.itertuples():
            assert r.score == pytest.approx(score[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12)
        hits += len(set(best) & set(got.vec_id))
        total += 5
        if q == 0 or q >= 6000:
            assert got.vec_id.tolist() == best.tolist()
    assert hits / total >= 0.9
    assert not set(found.query_id) & {5000, 5050, 5100, 5150, 5200}


def test_few_neighbours(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = collected(graph_ann.nearest(frame, frame.filter("vec_id % 50 = 0")).select("query_id", "rank", "vec_id"))
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert graph_ann.nearest(frame.limit(0), frame.limit(0)).count() == 0


# -- registered queries --------------------------------------------------------


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    """The awkward rows as a stored table."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def test_query_byte_bpe(spark, folder, library):
    want = []
    for doc_id, text, *_ in awkward_rows():
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(np.array(ids, "<i4").tobytes()), sha((text or "").encode())))
    assert collected(queries.op2_byte_bpe(spark, folder)) == sorted(want, key=repr)


def test_query_suffix_dedup(spark, folder):
    rows = queries.op6_suffix_dedup(spark, folder).collect()
    want = plain_repeats([r[1] for r in awkward_rows()], suffixes.MIN_BYTES)
    assert sorted(tuple(r)[1:] for r in rows) == sorted((*w[:3], sha(w[3])) for w in want)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in awkward_rows())


def test_query_chunk_dedup(spark, folder, docs):
    want = chunks.dedup_chunks(docs).select("row.doc_id", "kept_text").collect()
    got = queries.op9_chunk_dedup(spark, folder).select("doc_id", "kept_sha256")
    assert collected(got) == sorted(((r[0], None if r[1] is None else sha(r[1].encode())) for r in want), key=repr)


def test_query_reshard(spark, folder):
    rows = queries.op8_reshard(spark, folder).collect()
    size = {(r[0], len((r[1] or "").encode()) + 1) for r in awkward_rows()}
    assert len(rows) == len(awkward_rows()) and {(r["doc_id"], r["size"]) for r in rows} == size
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_query_neighbours(spark, tmp_path):
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = collected(queries.op10_graph_neighbours(spark, str(tmp_path)).select("query_id", "rank", "vec_id"))
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]


def test_query_pseudo_likelihood(spark, folder):
    for r in queries.op3_pseudo_likelihood(spark, folder).collect():
        assert (r["mean_log_probability"] is None) == (r["n_words"] == 0)
        assert r["n_words"] == 0 or r["mean_log_probability"] == pytest.approx(r["pseudo_log_likelihood"] / r["n_words"])
        assert r["pseudo_log_likelihood"] <= 0


def plain_distance(x, y):
    x, y = np.array(x) / sum(x), np.array(y) / sum(y)
    m = (x + y) / 2
    return np.sqrt(sum((p[p > 0] * np.log2(p[p > 0] / m[p > 0])).sum() for p in (x, y)) / 2)


def plain_kept(rows):
    """Whether each (text, lang) passes the base rule and is near its language's reference."""
    measured = []
    for text, lang in rows:
        ws = WORD.findall(text or "")
        windows = collections.Counter(zip(ws, ws[1:], ws[2:], strict=False))
        covered = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
        chars = [len(re.findall(f"[{c}]", text or "")) for c in quality.CHARACTER_CLASSES]
        common = [sum(w in (x, x.capitalize()) for w in ws) for x in quality.COMMON_WORDS.get(lang, [])]
        measured.append((len(ws), len(covered), [*chars, len(text or "") - sum(chars)], [*common, len(ws) - sum(common)]))
    sums = {}
    for (_, lang), (n, covered, chars, common) in zip(rows, measured, strict=True):
        if lang in quality.COMMON_WORDS and n >= quality.MIN_WORDS and 2 * covered <= n:
            shares, found = sums.setdefault(lang, ([], []))
            shares.append([1000 * x // len(text) for x in chars])
            found.append(common)
    out = []
    for (_, lang), (n, covered, chars, common) in zip(rows, measured, strict=True):
        good = n >= quality.MIN_WORDS and 2 * covered <= n
        if good and lang in sums:
            ref_chars, ref_common = np.median(sums[lang][0], axis=0) + 1, np.sum(sums[lang][1], axis=0)
            near = plain_distance(chars, ref_chars) <= quality.MAX_CHARACTER_DISTANCE
            good = near and plain_distance(common, ref_common) <= quality.MAX_WORD_DISTANCE
        out.append(bool(good))
    return out


def test_pipeline_stages(spark, tmp_path, library):
    """Each stage against a plain version on all that the one before it kept, and run() against the last."""
    rng = random.Random(21)
    english = quality.COMMON_WORDS["en"]

    def clean(n):
        return " ".join(rng.choice(english) if rng.random() < 0.4 else "".join(rng.choice("abdeorstn") for _ in range(6)) for _ in range(n))

    rows = [(i, clean(70) + "\nthe same line\n" + clean(60), "en", "ab"[i % 2]) for i in range(40)]
    rows += [(50, rows[3][1] + " end", "en", "a"), (51, rows[4][1], "en", "b"), (52, clean(20), "en", "a"), (53, None, None, None)]
    rows += [(54, " ".join(f"{rng.random()}%%$$" for _ in range(90)), "en", "a"), (55, "again and again " * 40, "en", "b")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert len(stages) == 5

    good = corpus_pipeline.settled(stages[0](spark, docs, ""), "test")
    want = [r for r, k in zip(rows, plain_kept([r[1:3] for r in rows]), strict=True) if k]
    assert collected(good.select("doc_id", "text")) == sorted((r[:2] for r in want), key=repr)
    assert {52, 53, 54, 55}.isdisjoint(r[0] for r in want)

    cut = corpus_pipeline.settled(stages[1](spark, good, ""), "test")
    want = [r[:2] for r in plain_lines([r[:2] for r in want], 2, 5) if r[3] == 0 or r[3] < r[2]]
    assert collected(cut.select("doc_id", "text")) == sorted(want, key=repr)

    single = corpus_pipeline.settled(stages[2](spark, cut, ""), "test")
    ids = {c for _, _, c in plain_components(want)}
    assert collected(single.select("doc_id", "text")) == sorted((r for r in want if r[0] in ids), key=repr)

    mix = corpus_pipeline.settled(stages[3](spark, single, ""), "test")
    sizes, taken = collections.Counter(), collections.Counter()
    for r in single.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in mix.collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    assert all(abs(taken[s] - t) <= mixing.BLOCK_WORDS for s, t in plain_targets(sizes).items())

    coded = collected(stages[4](spark, mix, "").select("doc_id", "ids", "n_tokens", "decoded_sha256"))
    want = []
    for r in mix.collect():
        ids = library.encode_ordinary(r["text"])
        want.append((r["doc_id"], bytearray(np.array(ids, "<i4").tobytes()), len(ids), sha(r["text"].encode())))
    assert [(a, bytes(b), c, d) for a, b, c, d in sorted(coded, key=lambda x: (x[0], x[3]))] == [
        (a, bytes(b), c, d) for a, b, c, d in sorted(want, key=lambda x: (x[0], x[3]))
    ]
    whole = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids", "n_tokens", "decoded_sha256")
    assert collected(whole) == coded
