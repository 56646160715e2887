"""LM scoring by masked pseudo-likelihood.

A small network predicts a masked word from the two words before it and the two
after it.  It is trained in numpy on every word of all documents: each word is a
target in one of MASK_EVERY turns over the table.  A turn takes the table in slices
of bounded size; every task trains a copy on its rows of a slice, the copies are
averaged weighted by their examples, and the next slice goes on from there, so
rounds grow with the input.  A document's score is the sum, over all its words, of
the logarithm of the probability that the network gives the word when masked.

Texts are cut into words twice: once for their classes and the counts of their
words, and once to score them, when the words that are not frequent leave for the
join.

The network sees words as a fixed number of classes; a class has a group and a
member, so a probability takes two short softmaxes instead of one long one.  A
word's probability is that of its class times its share of the class, by a table
that counts every word of all documents and grows with them.  The words above a
`FREQUENT`-th of all are dealt to every task, the others meet the table in a join.
Words are told apart by 64-bit hashes.  A word that the table lacks has the share
that `UNSEEN` occurrences would have, so the shares of a class and of its unseen
words sum to one.

Defined results: null or blank text has no words and scores 0.  Words are cut at
ASCII blanks, A-Z in lower case.  Rows of equal text score alike.  Without any
words in the table the network stays as it began.  Extra columns stay in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import binaries, ranges
from tidemark.llm.common import settled
from tidemark.session import shared_dir

GROUPS = 32
CLASSES = GROUPS * GROUPS
#: The neighbours that predict a word, as distances to it.
WINDOW = (-2, -1, 1, 2)
WIDTH = 16
#: One in so many words of a document is masked in a turn, as usual for masked models; in as many turns each word is once.
MASK_EVERY = 6
#: Bytes of text between two averagings.
SLICE_BYTES = 256 << 20
RATE = 0.1
BATCH = 2048
#: Parts that averaged weights are dealt in.
PARTS = 16
#: Occurrences that all unseen words of a class count as.
UNSEEN = 0.5
#: Words of more than one in so many occurrences are looked up without a join; there are fewer of them than this.
FREQUENT = 1 << 18
#: Words that a task holds before it hands on their counts, in rows of so many distinct words.
COUNTED = 1 << 21
COUNTS_ROW = 1 << 12
#: The slice that the counts are stored as.
COUNTS = -1
#: Runs of up to so many rows are added side by side.
SHORT = 8
#: Words that are scored at once; their layers fit a core's cache.
SCORED = 1 << 12

Model = list[np.ndarray]
#: Hashes of the frequent words in order, the logarithms of their counts, and those of the classes' counts.
Known = tuple[np.ndarray, np.ndarray, np.ndarray]


def word_hashes(raw: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, raw.lower().split())), ">u8").astype(np.uint64)


def _classes(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(CLASSES)).astype(np.int32)


def word_classes(raw: bytes) -> np.ndarray:
    return _classes(word_hashes(raw))


def new_model() -> Model:
    """Word vectors for each place of the window (the last row stands for the text's edge), group and member layers."""
    rng = np.random.default_rng(3)
    shapes = [(len(WINDOW), CLASSES + 1, WIDTH), (WIDTH,), (WIDTH, GROUPS), (GROUPS,), (GROUPS, WIDTH, GROUPS), (GROUPS, GROUPS)]
    return [(rng.standard_normal(s) * (0.1 if len(s) > 1 else 0)).astype(np.float32) for s in shapes[:4]] + [
        (rng.standard_normal(shapes[4]) * 0.1).astype(np.float32),
        np.zeros(shapes[5], np.float32),
    ]


def flat(model: Model) -> np.ndarray:
    return np.concatenate([p.ravel() for p in model])


def shaped(values: np.ndarray) -> Model:
    out, at = [], 0
    for p in new_model():
        out.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return out


def _hidden(model: Model, near: np.ndarray) -> np.ndarray:
    total = model[1] + model[0][0].take(near[:, 0], 0)
    for k in range(1, near.shape[1]):
        total += model[0][k].take(near[:, k], 0)
    return np.tanh(total, out=total)


def _column_sums(x: np.ndarray) -> np.ndarray:
    """The sums down the columns, added in the order in which numpy adds GROUPS neighbours."""
    x = x.reshape(-1, 8, x.shape[1]).sum(0)
    while len(x) > 1:
        x = x[0::2] + x[1::2]
    return x[0]


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Down each column, at one place of it; `x` is used up."""
    x -= x.max(0)
    found = x[at, np.arange(len(at))]
    return found - np.log(_column_sums(np.exp(x, out=x)))


def _softmax(x: np.ndarray) -> np.ndarray:
    """Down each column, in place; rows and columns change places in the result."""
    x -= x.max(0)
    np.exp(x, out=x)
    x /= _column_sums(x)
    return np.ascontiguousarray(x.T)


def _by_group(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order that brings rows of a group together, and each group's place in it."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    edges = np.searchsorted(group[order], np.arange(GROUPS + 1)).tolist()
    return order, [(g, slice(edges[g], edges[g + 1])) for g in range(GROUPS) if edges[g] < edges[g + 1]]


def _groups(model: Model, h: np.ndarray) -> np.ndarray:
    """The group layer's values, a column for each row."""
    return model[2].T @ h.T + model[3][:, None]


def _members(model: Model, h: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """The member layers' values of rows that lie by group, a column for each row."""
    out, h = np.empty((GROUPS, len(h)), np.float32), h.T
    for g, at in parts:
        np.matmul(model[4][g].T, h[:, at], out=out[:, at])
    out += np.repeat(model[5][[g for g, _ in parts]].T, [at.stop - at.start for _, at in parts], 1)
    return out


def log_probabilities(model: Model, near: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of each word, given its window (rows of class numbers)."""
    h = _hidden(model, near)
    group, member = word // GROUPS, word % GROUPS
    out = _log_softmax_at(_groups(model, h), group)
    order, parts = _by_group(group)
    out[order] += _log_softmax_at(_members(model, h.take(order, 0), parts), member[order])
    return out


def _run_sums(rows: np.ndarray, place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.add.reduceat(rows[place], at) with the same rounding, longest run first, and the order of the runs."""
    size = np.diff(at, append=len(place))
    order = np.argsort(-size.astype(np.int16), kind="stable")  # of 16 bits: by counting
    size, at = size[order], at[order]
    longer = np.searchsorted(-size, -np.arange(SHORT + 1)).tolist()  # runs of more than 0, 1, ... rows
    out = rows.take(place[at], 0)
    long, end = longer[SHORT], longer[1]
    if long < end:
        rest = rows.take(place[at[long:end] + 1], 0)
        for j in range(2, SHORT):
            rest[: longer[j] - long] += rows.take(place[at[long : longer[j]] + j], 0)
        out[long:end] += rest
    if long:
        some = ranges(at[:long], size[:long])
        out[:long] = np.add.reduceat(rows.take(place[some], 0), np.cumsum(size[:long]) - size[:long])
    return out, order


def _vector_gradients(near: np.ndarray, d_h: np.ndarray) -> np.ndarray:
    """The sums of `d_h` by place of the window and word."""
    out = np.zeros((len(WINDOW) * (CLASSES + 1), WIDTH), np.float32)
    key = (near.T.astype(np.int16) + np.arange(0, len(out), CLASSES + 1, dtype=np.int16)[:, None]).ravel()
    order = np.argsort(key, kind="stable")  # of 16 bits: by counting
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sums, by = _run_sums(d_h, order % len(near), at)
    out[key[at[by]]] = sums
    return out.reshape(len(WINDOW), CLASSES + 1, WIDTH)


def train_step(model: Model, memory: Model, near: np.ndarray, word: np.ndarray) -> None:
    """One step of Adagrad on a batch, in place."""
    h = _hidden(model, near)
    group, member = word // GROUPS, word % GROUPS
    rows = np.arange(len(word))
    d_group = _softmax(_groups(model, h))
    d_group[rows, group] -= 1
    d_h = d_group @ model[2].T
    grads = [None, None, h.T @ d_group, d_group.sum(0), np.zeros_like(model[4]), np.zeros_like(model[5])]
    order, parts = _by_group(group)
    by_group = h.take(order, 0)
    d = _softmax(_members(model, by_group, parts))
    d[rows, member[order]] -= 1
    d_member = np.empty_like(by_group)
    for g, at in parts:
        np.matmul(d[at], model[4][g].T, out=d_member[at])
        np.matmul(by_group[at].T, d[at], out=grads[4][g])
        np.add.reduce(d[at], 0, out=grads[5][g])
    d_h[order] += d_member
    d_h *= 1 - h * h
    grads[0], grads[1] = _vector_gradients(near, d_h), d_h.sum(0)
    scale = np.float32(1 / len(word))
    for p, m, g in zip(model, memory, grads, strict=True):  # where g is 0, nothing changes
        g *= scale
        m += g * g
        g *= RATE
        root = m + 1e-8
        g /= np.sqrt(root, out=root)
        p -= g


def _line(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts in a line, with edges between; where each text starts, and its size."""
    reach = max(map(abs, WINDOW))
    edge = np.full(reach, CLASSES, np.int16)
    line = np.concatenate([edge, *(x for t in texts for x in (t, edge))], dtype=np.int16)
    size = np.array([len(t) for t in texts], np.int64)
    return line, np.cumsum(size) - size + reach * np.arange(1, len(texts) + 1), size


def _with_windows(line: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return line[at], line[at + np.array(WINDOW)[:, None]].T


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, one after another, and the window of each."""
    line, start, size = _line(texts)
    return _with_windows(line, ranges(start, size))


def masked(texts: list[np.ndarray], seeds: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts that are masked in a turn, and the window of each; over MASK_EVERY turns every word once."""
    line, start, size = _line(texts)
    skip = (seeds + turn) % MASK_EVERY
    n = np.maximum(-((skip - size) // MASK_EVERY), 0)
    return _with_windows(line, ranges(0, n) * MASK_EVERY + np.repeat(start + skip, n))


def targets(classes: np.ndarray, seed: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """The masked words of one text."""
    return masked([classes], np.array([seed]), turn)


def _trainer(start: np.ndarray, turn: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen, part = shaped(start), 0, 0
        memory = [np.zeros_like(p) for p in model]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def steps(whole: bool) -> None:
            nonlocal held, count
            word, near = np.concatenate([h[0] for h in held]), np.concatenate([h[1].T for h in held], 1).T
            stop = len(word) if whole else len(word) // BATCH * BATCH
            for i in range(0, stop, BATCH):
                train_step(model, memory, near[i : i + BATCH], word[i : i + BATCH])
            held, count = [(word[stop:], near[stop:])], len(word) - stop

        for batch in batches:
            part = batch.column(0)[0].as_py() if len(batch) else part
            # every text gives its share of masked words, from a place of its own on
            word, near = masked([data.view(np.int16) for data in binaries(batch.column(2))], batch.column(1).to_numpy(), turn)
            held.append((word, near))
            count += len(word)
            seen += len(word)
            if count >= 8 * BATCH:
                steps(False)
        if seen:
            steps(True)
            values = flat(model)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(PARTS), pa.int32()), pa.array([part] * PARTS, pa.int32()), pa.array([seen] * PARTS, pa.int64()),
                    pa.array([v.tobytes() for v in np.array_split(values, PARTS)]),
                ],
                ["part", "task", "examples", "weights"],
            )

    return train


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for part, _, examples, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            weights = np.frombuffer(raw, np.float32).astype(np.float64) * examples
            if part in sums:
                sums[part][0] += weights
                sums[part][1] += examples
            else:
                sums[part] = [weights, examples]
    for part, (total, examples) in sums.items():
        mean = (total / examples).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([mean])], ["part", "weights"])


def _counts(words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    word, n = np.unique(np.concatenate(words), return_counts=True)
    for i in range(0, len(word), COUNTS_ROW):
        some = slice(i, i + COUNTS_ROW)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([COUNTS], pa.int32()), pa.array([None], pa.int32()), pa.array([None], pa.binary()),
                pa.array([word[some].view(np.int64)], pa.list_(pa.int64())), pa.array([n[some]], pa.list_(pa.int64())),
            ],
            ["slice", "seed", "classes", "word", "n"],
        )


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for batch in batches:
        classes = []
        for data in binaries(batch.column(2)):
            hashes = word_hashes(data.tobytes())
            classes.append(_classes(hashes).astype(np.int16).tobytes())
            held.append(hashes)
            count += len(hashes)
            if count >= COUNTED:
                yield from _counts(held)
                held, count = [], 0
        none = pa.nulls(len(batch), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(classes, pa.binary()), none, none], ["slice", "seed", "classes", "word", "n"])
    if count:
        yield from _counts(held)


def _stored(docs: DataFrame) -> tuple[DataFrame, int]:
    """The class numbers of each text's words by slice, and as slice COUNTS the tasks' counts of words; and how many slices there are.

    Rows are dealt to slices by their place, so that copies of a text spread too.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // SLICE_BYTES))
    placed = docs.select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)).cast("int").alias("seed"), F.col("text").cast("binary").alias("text")
    )
    dealt = placed.select(F.floor(F.col("seed") / 64 % slices).cast("int").alias("slice"), "seed", "text")
    path = shared_dir(docs.sparkSession, "word-classes")
    columns = "seed int, classes binary, word array<long>, n array<long>"
    dealt.mapInArrow(_encoded, f"slice int, {columns}").write.partitionBy("slice").parquet(path)
    return docs.sparkSession.read.schema(f"{columns}, slice int").parquet(path), slices


def _texts(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("slice") != COUNTS).select("seed", "classes", "slice")


def encoded(docs: DataFrame) -> tuple[DataFrame, int]:
    """slice, seed and the class numbers of each text's words, stored by slice; and how many slices there are."""
    stored, slices = _stored(docs)
    return _texts(stored), slices


def copies(rows: DataFrame, values: np.ndarray, turn: int) -> DataFrame:
    """The weights of each task's copy after a turn over `rows`, in PARTS, and the examples it has seen."""
    return rows.select(F.spark_partition_id().alias("task"), "seed", "classes").mapInArrow(
        _trainer(values, turn), "part int, task int, examples long, weights binary"
    )


def train(docs: DataFrame) -> np.ndarray:
    """The network's weights, trained on every word of every document; a few hundred kilobytes, whatever the input."""
    return _trained(*encoded(docs))


def _trained(rows: DataFrame, slices: int) -> np.ndarray:
    values = flat(new_model())
    for turn in range(MASK_EVERY):
        for i in range(slices):
            trained = copies(rows.filter(F.col("slice") == i), values, turn)
            means = trained.repartition(PARTS, "part").sortWithinPartitions("part", "task").mapInArrow(_averaged, "part int, weights binary")
            found = {r["part"]: np.frombuffer(r["weights"], np.float32) for r in means.collect()}  # PARTS rows
            if found:
                values = np.concatenate([found[k] for k in range(PARTS)])
    return values


def word_table(docs: DataFrame) -> DataFrame:
    """word (hash) and n, its occurrences in all documents; stored."""
    return _word_table(_stored(docs)[0])


def _word_table(stored: DataFrame) -> DataFrame:
    found = stored.filter(F.col("slice") == COUNTS).select(F.inline(F.arrays_zip("word", "n")))
    return settled(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def known_words(words: DataFrame) -> Known:
    """What every task looks up itself: fewer than FREQUENT words, and the classes."""
    sizes = np.zeros(CLASSES)
    for r in words.groupBy(F.col("word").bitwiseAND(F.lit(CLASSES - 1)).alias("class")).agg(F.sum("n").alias("n")).collect():
        sizes[r["class"]] = r["n"]
    frequent = words.filter(F.col("n") * FREQUENT > F.lit(int(sizes.sum()))).toArrow()
    hashes, counts = (frequent[c].to_numpy() for c in ("word", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], np.log(counts[order]), np.log(sizes + UNSEEN)


def _found(known: Known, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are frequent ones, and the places of these among them."""
    at = np.searchsorted(known[0], hashes)
    hit = at < len(known[0])
    hit[hit] = known[0][at[hit]] == hashes[hit]
    return hit, at[hit]


def _scorer(held, known):
    none = np.empty(0, np.int64)

    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shaped(held.value)
        for series in texts:
            hashes = [word_hashes(t or b"") for t in series]
            size, total = np.array([len(h) for h in hashes], np.int64), np.zeros(len(hashes))
            rare = [none] * len(hashes)
            at = 0
            while at < len(hashes):  # some thousand words at a time
                end = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), 1 << 15)) + at)
                word, near = windows([_classes(h) for h in hashes[at:end]])
                owner = np.repeat(np.arange(end - at), size[at:end])
                value = np.empty(len(word))
                for i in range(0, len(word), SCORED):
                    value[i : i + SCORED] = log_probabilities(model, near[i : i + SCORED], word[i : i + SCORED])
                if known is not None:
                    hit, place = _found(known.value, np.concatenate(hashes[at:end]))
                    value -= known.value[2][word]
                    value[hit] += known.value[1][place]
                    edges = np.cumsum(size[at:end])
                    for d, (a, b) in enumerate(zip((edges - size[at:end]).tolist(), edges.tolist(), strict=True), at):
                        rare[d] = hashes[d][~hit[a:b]].view(np.int64)
                total[at:end] = np.bincount(owner, value, end - at)
                at = end
            yield pd.DataFrame({"n_words": size, "total": total, "rare": rare})

    return F.pandas_udf(scores, "n_words long, total double, rare array<long>")


def _rare_counts(scored: DataFrame, words: DataFrame) -> DataFrame:
    """_k1, _k2 (of a text) and the mean logarithm of the counts of its words that are not frequent.

    A mean, so that rows of equal text need not be told apart; summed as whole
    billionths, their high and low 32 bits apart, so that the order of the rows
    changes nothing and no sum runs over.
    """
    rare = scored.select("k1", "k2", F.explode("rare").alias("word"))
    table = words.select(F.col("word").alias("_word"), F.col("n").alias("count"))
    billionths = F.rint(F.log(F.coalesce(F.col("count").cast("double"), F.lit(UNSEEN))) * 1e9).cast("long")
    high, low = F.sum(F.shiftright("log", 32)).cast("double"), F.sum(F.col("log").bitwiseAND(F.lit((1 << 32) - 1))).cast("double")
    return (
        rare.join(table, F.col("word") == F.col("_word"), "left")
        .select("k1", "k2", billionths.alias("log"))
        .groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
        .agg(((high * float(1 << 32) + low) / 1e9 / F.count("*")).alias("log_count"))
    )


def score(docs: DataFrame, values: np.ndarray, words: DataFrame | None = None) -> DataFrame:
    """`row`, n_words, pseudo_log_likelihood (natural logarithm) and its mean for each word (null without words).

    Of the words themselves by the table `words`; without one, of their classes only.
    """
    context = docs.sparkSession.sparkContext
    held = context.broadcast(values)
    known = context.broadcast(known_words(words)) if words is not None else None
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(3), text).alias("k2")  # 128 bits of a text
    scores = _scorer(held, known)(F.col("text").cast("binary")).alias("s")
    if words is None:
        found, total = docs.select(F.struct("*").alias("row"), scores).select("row", "s.*"), F.col("total")
    else:
        scored = settled(docs.select(*keys, scores).select("k1", "k2", "s.*"), "text-scores")
        # rows of equal text have equal values
        texts = scored.groupBy("k1", "k2").agg(F.max("n_words").alias("n_words"), F.max("total").alias("total"), F.max(F.size("rare")).alias("n_rare"))
        rare = _rare_counts(scored, words)
        texts = texts.join(rare, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").drop("_k1", "_k2")
        found = docs.select(F.struct("*").alias("row"), *keys).join(texts, ["k1", "k2"])
        total = F.col("total") + F.coalesce(F.col("log_count") * F.col("n_rare"), F.lit(0.0))
    return found.select(
        "row",
        "n_words",
        total.alias("pseudo_log_likelihood"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_probability"),
    )


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Trains on all documents, counts their words and scores them."""
    stored, slices = _stored(docs)
    return score(docs, _trained(_texts(stored), slices), _word_table(stored))
