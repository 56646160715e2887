"""Packing, the Merkle manifest and the filter audit against plain versions of themselves."""

import collections
import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import filter_audit, merkle, packing, queries
from test_operators import SCHEMA, WORD, awkward_rows, collected

EXTRA = ("key", "idx", "row", "tree", "shard", "block", "digest", "leaf", "piece", "length", "ids", "part", "n", "mask", "step", "ws", "_doc_id", "place", "_source")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns whose names the operators use inside."""
    frame = spark.createDataFrame(awkward_rows(), SCHEMA)
    return frame.select("*", *(F.lit("x").alias(c) for c in EXTRA)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


# -- packing -----------------------------------------------------------------


def test_words_encode_as_the_whole_text(tokenizer):
    known = packing.WordIds(open(PATH, "rb").read())
    rng = random.Random(3)
    parts = ["It's", "ÉTÉ", "é", "́x", "İstanbul", "ΣΑΣ", "中文字", "12a3", "a b", "x y", "\x1cz", "<|endoftext|>q", "don't've", "...!?", "\x85", "🙂‍↔️", "ﬁ", "'s"]
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice([" ", "\n", "\t\t", " \x0b", "\x0c", "", "\r\n"]) for _ in range(12))
        assert np.frombuffer(known.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_each_token_is_reached_by_its_own_merge():
    """What merging on bytes rests on: merging the letters of a token, by the listed pairs only, gives the token; ids ascend."""
    model = json.load(open(PATH))["model"]
    pairs = {tuple(m.split(" ") if isinstance(m, str) else m): k for k, m in enumerate(model["merges"])}
    made = [model["vocab"][a + b] for a, b in pairs]
    assert made == sorted(set(made))
    end = model["end_of_word_suffix"]
    for a, b in pairs:
        token = a + b
        parts = list(token.removesuffix(end))
        if token.endswith(end):
            parts[-1] += end
        while len(parts) > 1:
            rank, k = min((pairs.get((x, y), len(pairs)), k) for k, (x, y) in enumerate(itertools.pairwise(parts)))
            assert rank < len(pairs)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [token]


def test_plain_words_merge_as_the_tokenizer_does(tokenizer):
    known, rng = packing.WordIds(open(PATH, "rb").read()), random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'.,-!$é0123456789ñóüßÀÞ×½ª\u00ad¿|"
    words = ["".join(rng.choice(letters[: rng.choice([26, 60, len(letters)])]) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    assert sum(known.merges.encode(w.encode()) is not None for w in words) > 3900
    for w in words:
        assert np.frombuffer(known[w.encode()], "<u4").tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w


def plain_pieces(rows, tokenizer, capacity):
    out = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            out.append((doc_id, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes())))
    return sorted(out, key=repr)


def check_layout(rows, capacity):
    """Every sequence is filled from 0 on without a gap and holds no more than it may."""
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity,per_shard", [(4096, 2048), (300, 8), (64, 2048)])
def test_packing(docs, tokenizer, capacity, per_shard, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", per_shard)
    monkeypatch.setattr(packing, "OPEN_ROOM", capacity // 32)
    packed = packing.pack(docs, PATH, capacity).select("row", "piece", "start", "length", "ids", "sequence_id", "offset")
    rows = packed.collect()
    found = sorted(((r.row.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows), key=repr)
    assert found == plain_pieces(awkward_rows(), tokenizer, capacity)
    check_layout(rows, capacity)
    assert {r.row.shard for r in rows} == {"x"}
    joined = packing.sequences(packed).collect()
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, bytes(r.ids)))
    assert {r.sequence_id: bytes(r.ids) for r in joined} == {k: b"".join(x for _, x in sorted(v)) for k, v in by_sequence.items()}


def first_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        at = next((i for i, r in enumerate(rooms) if r >= x), None)
        if at is None:
            rooms.append(capacity - x)
        else:
            rooms[at] -= x
    return len(rooms)


def test_packing_over_shards_nears_the_bound(spark, monkeypatch):
    """Slack is lost once, not in every shard."""
    monkeypatch.setattr(packing, "SHARD_PIECES", 100)
    rng = random.Random(8)
    lengths = [min(4095, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length long")
    placed = packing.placements(frame)
    assert placed.select("piece_id").distinct().count() == placed.count() == 3000
    rows = placed.join(frame, "piece_id").collect()
    assert check_layout(rows, 4096) <= -(-sum(lengths) // 4096) + 2


def test_evolution_beats_falling_lengths():
    """Triplets that fill bins exactly, which best fit by falling length misses."""
    rng, capacity = random.Random(4), 1000
    lengths = []
    for _ in range(20):
        a, b = rng.randint(380, 490), rng.randint(250, 300)
        lengths += [a, b, capacity - a - b]
    least = packing.bound(np.array(lengths), capacity)
    population = packing.first_population(lengths, capacity, 0, rng)
    falling = len(packing.best_fit(packing.Bins([], []), sorted(range(60), key=lambda i: -lengths[i]), lengths, capacity))
    start = max(packing.fitness(p, capacity) for p in population)
    for _ in range(40):
        population = packing.evolve(population, lengths, capacity, least, rng)
    assert packing.fitness(population[0], capacity) > start
    assert least <= len(population[0]) < falling
    for solution in population:
        assert sorted(i for b in solution for i in b) == list(range(60))
        assert all(sum(lengths[i] for i in b) <= capacity for b in solution)


def test_islands_migrate_until_they_end(spark, monkeypatch):
    """Later epochs start from what the islands before them found."""
    monkeypatch.setattr(packing, "EPOCHS", 6)
    rng, capacity = random.Random(4), 1000
    lengths = []
    for _ in range(20):
        a, b = rng.randint(380, 490), rng.randint(250, 300)
        lengths += [a, b, capacity - a - b]
    frame = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length long")
    found = packing.pack_level(frame, 1, capacity, 0).select("piece_id", "length", F.col("bin").alias("sequence_id"), "offset").collect()
    assert sorted(r.piece_id for r in found) == list(range(60))
    assert 20 <= check_layout(found, capacity) < first_fit_decreasing(lengths, capacity)


def test_crossover_keeps_items_and_injects_bins():
    rng = random.Random(6)
    lengths = [rng.randint(1, 60) for _ in range(200)]
    one, two = (packing.best_fit(packing.Bins([], []), rng.sample(range(200), 200), lengths, 100) for _ in range(2))
    child = packing.crossover(one, two, lengths, 100, rng)
    assert sorted(i for b in child for i in b) == list(range(200))
    assert [100 - sum(lengths[i] for i in b) for b in child] == child.rooms and min(child.rooms) >= 0
    whole = {frozenset(b) for b in child}
    assert sum(any(frozenset(b) <= c for c in whole) for b in two) >= len(two) // 8


def test_tightest_fit():
    rng = random.Random(1)
    rooms, plain = packing.Rooms(50), []
    for k in range(30):
        plain.append((rng.randint(1, 50), k))
        rooms.add(k, plain[-1][0])
    for _ in range(60):
        x = rng.randint(1, 50)
        best = min((r for r, _ in plain if r >= x), default=None)
        found = rooms.tightest(x)
        assert (found and found[1]) == best
        if found:
            plain.remove((best, found[0]))


def test_packing_of_nothing(empty):
    assert packing.pack(empty, PATH).count() == 0


# -- the manifest ------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_manifest(rows):
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, plain_leaf(r, r[1]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for t, s in enumerate(order):
        for i, (*_, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            digest, siblings = plain_leaf(r, text), ""
            for at, levels in ((i, trees[s]), (t, top)):
                for level in levels[:-1]:
                    run = level[at // 16 * 16 : at // 16 * 16 + 16]
                    k = at % 16
                    siblings += "".join(run[:k] + run[k + 1 :])
                    digest = sha("".join(run[:k]) + digest + "".join(run[k + 1 :]))
                    at //= 16
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], sha(siblings), digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def checked(frame, levels=merkle.LEVELS):
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(frame, merkle.lowered(F.col("text")), touched, levels)
    return collected(found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest(docs, levels):
    """Also with superblocks so small that trees take several tables."""
    assert checked(docs, levels) == plain_manifest(awkward_rows())


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_of_a_large_source_and_many_small_ones(spark, levels):
    rows = [(i * 7919 % 100003, f"Text {i % 300}", "en", "hot", i) for i in range(4700)]
    rows += [(200000 + i, "A" if i % 3 else None, None, f"s{i}" if i else None, None) for i in range(40)]
    rows += [(300000 + i, f"B{i}", "de", f"s{i % 2}", 1) for i in range(270)]
    found = checked(spark.createDataFrame(rows, SCHEMA).repartition(5), levels)
    assert found == plain_manifest(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found)


def test_manifest_of_one_row(spark):
    rows = [(1, "Text", "en", "a", 4)]
    found = checked(spark.createDataFrame(rows, SCHEMA))
    assert found == plain_manifest(rows)
    assert found[0][4] == sha("")


def test_manifest_without_tampering(docs):
    assert merkle.manifest(docs).filter("verified").count() == len(awkward_rows())


def test_large_integers_stay_whole(spark):
    rows = [(2**62 + 1, "a", "en", "s", 1), (None, "b", "en", "s", 1)]
    assert checked(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_manifest_of_nothing(empty):
    assert checked(empty) == []


# -- the audit ---------------------------------------------------------------


def plain_failed(rows):
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    out = []
    for doc_id, text, _, source, _ in rows:
        t = text or ""
        ws = WORD.findall(t)
        first = smallest.get(t)
        failed = {
            "A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": first is not None and (doc_id is None or first < doc_id),
        }
        out.append((doc_id, source or "", {k for k, v in failed.items() if v}))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    counts, removed = collections.defaultdict(lambda: [0] * 6), collections.Counter()
    for doc_id, part, failed in plain_failed(rows):
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                c = counts[part, order, step]
                if f in failed and not gone:
                    c[1] += 1
                    c[4] += doc_id in good
                    c[5] += doc_id in toxic
                    removed[part, f] += 1
                    gone = True
                elif f in failed:
                    c[2] += 1
                c[0] += not gone
                c[3] += failed == {f}
    return sorted(((*k, *c, removed[k[0], k[1][k[2] - 1]]) for k, c in counts.items()), key=repr)


LABELS = "doc_id long, quality int, toxic int"


def audited(docs, labels):
    return collected(filter_audit.filter_audit(docs, labels).drop("filter"))


def test_audit(spark, docs):
    labels = [(i, i % 2, i % 3 % 2) for i in range(1, 28)] + [(2, 1, 1), (None, 1, 1), (3, None, 0)]
    frame = spark.createDataFrame(labels, LABELS)
    assert audited(docs, frame) == plain_audit(awkward_rows(), labels)


def test_audit_of_copies_in_many_parts(spark):
    """Each part counts its own copies; the smallest doc_id of the table passes."""
    rng = random.Random(3)
    texts = ["Same TEXT # " * 30, "", None, " ".join(f"w{i}" for i in range(80)), "| " * 60, "x"]
    rows = [(rng.randrange(400) if i % 9 else None, rng.choice(texts), "en", rng.choice(["a", "b", "", None]), 1) for i in range(600)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 400, 2)]
    found = audited(spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS))
    assert found == plain_audit(rows, labels)


def test_potentials_give_shapley_values(spark):
    """Against the mean of what a filter adds, over all orders, of any game."""
    rng = random.Random(7)
    worth = [0] + [rng.randrange(1000) for _ in range(31)]
    made = spark.range(1).select(filter_audit.potentials(F.array(*(F.lit(w).cast("long") for w in worth))).alias("p")).first().p
    for i in range(5):
        added = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            added += worth[before | 1 << i] - worth[before]
        assert made[31] - 5 * made[31 ^ 1 << i] == added


def test_audit_of_nothing(spark, empty):
    assert audited(empty, spark.createDataFrame([], LABELS)) == []


# -- the registered queries --------------------------------------------------


def test_packing_query(spark, tmp_path, tokenizer):
    spark.createDataFrame(awkward_rows(), SCHEMA).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op11_genetic_packing(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == plain_pieces(awkward_rows(), tokenizer, 4096)
    assert check_layout(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_all_operators_are_registered():
    """The entry does without what cannot be imported, so a mistake in an import would only show here."""
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in entry.queries() if q.startswith("op") or q == "pipeline"}
