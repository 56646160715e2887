"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set holds the hashes of its distinct 5-word shingles.  Two sets
that link share a token among the first n - ceil(t n) + 1 of each, whatever the
global order.  Order one puts tokens of frequent sketch cells last and brings
documents together by prefix token.  Among the tokens so shared, order two
(ascending hash) must find a common one in prefixes made as short as the link
still allows, and bit signatures of them and of the whole sets must leave room
for as many common ones as a link takes.  Of the runs in which a pair meets, those
that follow closely on another one do not list it again.  Listed pairs are verified
on whole sets, order three (descending hash) first.

Equal sets are one node.  First rounds test documents against a few documents of
their tokens' runs only, chosen anew each round, which joins a group of near
copies without listing its pairs; the last round lists the pairs of a run that
are still in different components.  No link between components is lost, as
every such pair is tested.

Defined results: null or blank text has an empty set and links with nothing;
fewer than five words are one shingle.  Rows equal in doc_id and text are alike.
component_id is the smallest doc_id reachable, null where no doc_id is known.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import binaries
from tidemark.llm.common import forget, settled
from tidemark.llm.components import components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Cells of the frequency sketch behind order one; it has this size whatever the input.
SKETCH_BITS = 21
SKETCH_PARTS = 32
#: Rounds of guesses, and hubs that a set is tested against in each.
TURNS = 3
HUBS = 8
#: A round in which fewer than one guess of so many is a link is the last one; what is left is listed in full anyway.
GUESSES = 32
#: Words of 64 bits in the signature of a set's shared prefix tokens.
SIGNATURE = [f"s{i}" for i in range(4)]
#: Bits in the signature of a whole set.
WHOLE_BITS = 512
#: The tokens before a shared one, by which a pair that has met in one of their runs is known.
BEFORE = [f"p{i}" for i in range(1, 5)]
#: Up to so many rows of 16 bytes are sent to all tasks to find documents; more are joined by a shuffle.
SENT_ROWS = 1 << 18
FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def row_hashes() -> list[Column]:
    """128 bits of doc_id and text."""
    parts = [F.col("doc_id").isNull(), F.col("text").isNull(), F.col("doc_id"), F.col("text")]
    return [F.xxhash64(F.lit(1), *parts).alias("r1"), F.xxhash64(F.lit(2), *parts).alias("r2")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(raw: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; A-Z in lower case."""
    found = raw.lower().split()  # of bytes: ASCII letters, and ASCII blanks
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(n, WORDS)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += h[i : n - size + 1 + i] * FACTORS[i]
    return np.unique(_mix(total))


def need(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_size(n):
    return n + (-PERCENT * n // 100) + 1


def _sets(batch: pa.RecordBatch, seen: set[int] | None, column: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, digest, set) of each document with a set; each set once if `seen` is given."""
    for i, data in enumerate(binaries(batch.column(column))):
        tokens = shingles(data.tobytes())
        if not len(tokens):
            continue
        digest = xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
        if seen is not None:
            if digest in seen:
                continue
            seen.add(digest)
        yield i, digest, tokens


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _add(counts: np.ndarray, tokens: np.ndarray) -> None:
    """Counts the cells of a set's tokens, which ascend; a full cell stays full."""
    cells = _cells(tokens)
    at = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    many = np.diff(np.append(at, len(cells)))
    here = counts[cells[at]]
    counts[cells[at]] = here + np.minimum(many, 65535 - here.astype(np.int64)).astype(np.uint16)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[part] = sums.get(part, 0) + np.frombuffer(raw, np.uint16).astype(np.int64)
    if sums:
        levels = [np.frexp(s.astype(float))[1].astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels)], ["part", "levels"])


def frequency_levels(parts: DataFrame) -> np.ndarray:
    """For each cell of token hashes, the binary logarithm of how often tokens of the cell occur, over all documents."""
    summed = (
        parts.repartition(SKETCH_PARTS, "part")
        .mapInArrow(_summed, "part int, levels binary")
        .collect()  # SKETCH_PARTS rows, 2 ** SKETCH_BITS bytes in all
    )
    by_part = {r["part"]: np.frombuffer(r["levels"], np.uint8) for r in summed}
    empty = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint8)
    return np.concatenate([by_part.get(i, empty) for i in range(SKETCH_PARTS)])


def whole_signature(tokens: np.ndarray) -> bytes:
    """WHOLE_BITS bits of a set; one that another set's lack stands for a token which that set lacks."""
    bits = np.zeros(WHOLE_BITS, bool)
    bits[(tokens >> np.uint64(20)).astype(np.int64) % WHOLE_BITS] = True
    return np.packbits(bits).tobytes()


_SETS = pa.schema(
    [("doc_id", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("whole", pa.binary())]
)
_PARTS = pa.schema([("part", pa.int32()), ("counts", pa.binary())])


def _rows(columns: dict[str, list | pa.Array], size: int) -> pa.RecordBatch:
    """A batch of the sets' and the sketch's columns; those not given are null."""
    fields = [*_SETS, *_PARTS]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(size, f.type) if f.name not in columns else pa.array(columns[f.name], f.type) for f in fields], [f.name for f in fields]
    )


def set_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets and, from the same pass, the tasks' sketches of token frequencies.

    Sets: doc_id, r1, r2 (row hashes), digest, n and whole (a signature) of every
    document; digest and whole are null and n 0 where the set is empty.  Sketches:
    part and counts.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << SKETCH_BITS, np.uint16), set()
        for batch in batches:
            digest, n, whole = [None] * len(batch), [0] * len(batch), [None] * len(batch)
            for i, d, tokens in _sets(batch, None, 3):
                digest[i], n[i], whole[i] = d, len(tokens), whole_signature(tokens)
                if d not in seen:
                    seen.add(d)
                    _add(counts, tokens)
            known = {"doc_id": batch.column(0), "r1": batch.column(1), "r2": batch.column(2)}
            yield _rows({**known, "digest": digest, "n": n, "whole": whole}, len(batch))
        if seen:
            for part, held in enumerate(np.split(counts, SKETCH_PARTS)):
                yield _rows({"part": [part], "counts": [held.tobytes()]}, 1)

    rows = docs.select(F.col("doc_id").cast("long"), *row_hashes(), F.col("text").cast("binary"))
    schema = "doc_id long, r1 long, r2 long, digest long, n long, whole binary, part int, counts binary"
    stored = settled(rows.mapInArrow(digests, schema), "shingle-sets")
    return stored.filter("part is null").select(_SETS.names), stored.filter("part is not null").select(_PARTS.names)


def shared_prefixes(docs: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """The sets whose prefixes under order one hold tokens of other sets' prefixes: a (a set), n (its size), these tokens in order, their signature and that of the whole set."""
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(sketches))  # 2 ** SKETCH_BITS bytes

    def first_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            token, owner, size = [], [], []
            for _, digest, tokens in _sets(batch, seen, 0):
                n = len(tokens)
                p = prefix_size(n)
                order = levels.value[_cells(tokens)].astype(np.uint64) << np.uint64(56) | (tokens * FACTORS[0]) >> np.uint64(8)
                token.append(tokens[np.argpartition(order, p - 1)[:p]] if p < n else tokens)
                owner.append(digest)
                size.append((p, n))
            if token:
                p, n = np.array(size).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(token).view(np.int64)), pa.array(np.repeat(np.array(owner, np.int64), p)), pa.array(np.repeat(n, p).astype(np.int32))],
                    ["token", "a", "n"],
                )

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(first_tokens, "token long, a long, n int")
    dealt = rows.repartition("token").sortWithinPartitions("token", "a")
    several = settled(dealt.mapInArrow(_several, "token long, a long, n int"), "shingle-runs")
    bit = F.expr("shiftleft(1L, cast(token & 63 as int))")
    in_word = F.shiftright("token", 6).bitwiseAND(len(SIGNATURE) - 1)
    signature = [F.bit_or(F.when(in_word == i, bit).otherwise(F.lit(0).cast("long"))).alias(s) for i, s in enumerate(SIGNATURE)]
    held = several.groupBy("a").agg(F.min("n").alias("n"), F.sort_array(F.collect_list("token")).alias("tokens"), *signature)
    whole = sets.filter("digest is not null").groupBy("digest").agg(F.min("whole").alias("whole"))
    prefixes = settled(held.join(whole, F.col("a") == F.col("digest")).drop("digest"), "shingle-prefixes")
    forget(several)
    return prefixes


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, cut so that no run of it is split."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        start = int(np.searchsorted(columns[0], columns[0][-1]))  # of the run that may go on
        if held and (start or held[-1][0][-1] != columns[0][0]):
            yield [np.concatenate(x) for x in zip(*held, [c[:start] for c in columns], strict=True)]
            held = []
        elif start:
            yield [c[:start] for c in columns]
        held.append([c[start:] for c in columns])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for token, a, n in _runs(batches):
        new = np.r_[True, token[1:] != token[:-1]] if len(token) else np.empty(0, bool)
        fresh = new | np.r_[True, a[1:] != a[:-1]][: len(a)]  # a set may have come from several tasks
        token, a, n = token[fresh], a[fresh], n[fresh]
        if not len(token):
            continue
        new = np.r_[True, token[1:] != token[:-1]]
        keep = ~(new & np.r_[new[1:], True])
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, a, n)], ["token", "a", "n"])


def _most_common(held: np.ndarray, signature: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An upper bound of the held tokens that rows x and y have in common."""
    only_x, only_y = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for word in signature:
        only_x += np.bitwise_count((word[x] & ~word[y]).view(np.uint64))
        only_y += np.bitwise_count((word[y] & ~word[x]).view(np.uint64))
    return np.minimum(held[x] - only_x, held[y] - only_y)


def _met(before: list[np.ndarray], token: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows x and y have a common one among the tokens before their own; where there are none, `before` has the own one."""
    found = np.zeros(len(x), bool)
    for p in before:
        real = p[x] != token[x]
        for q in before:
            found |= real & (p[x] == q[y])
    return found


def _cross_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a run in different components that order two and the signatures allow to link.

    A link takes `least` common ones among the tokens that two prefixes share
    with others.  So in the order of the hashes one of them is among the first
    held - least + 1 of either: a prefix of the prefix.  A bit of one signature that
    the other lacks stands for a token that is not common, so signatures bound the
    common ones from above.  Sets that share an earlier token have met in its run,
    where they pass the same tests: so the run of their first common token lists
    them, and one with a common token shortly before does not.
    """
    for token, label, a, n, place, held, whole, *words in _runs(batches):
        if not len(token):
            continue
        signature, before = words[: len(SIGNATURE)], words[len(SIGNATURE) :]
        whole = list(np.frombuffer(b"".join(whole), np.int64).reshape(len(token), -1).T)
        n, place, held = n.astype(np.int64), place.astype(np.int64), held.astype(np.int64)
        end = np.searchsorted(token, token, "right")
        # rows of a run lie by component: what follows the own component is to be paired
        last = np.r_[(token[1:] != token[:-1]) | (label[1:] != label[:-1]), True]
        stop = np.flatnonzero(last)
        step = stop[np.searchsorted(stop, np.arange(len(token)))] + 1
        at = np.flatnonzero(step < end)
        while len(at):
            x, y = at, step[at]
            larger = np.maximum(n[x], n[y])
            common = need(n[x], n[y])
            least = np.maximum(1, common - (larger - prefix_size(larger)))
            ok = 100 * np.minimum(n[x], n[y]) >= PERCENT * larger
            some = np.flatnonzero(ok & (place[x] + least <= held[x]) & (place[y] + least <= held[y]))
            some = some[_most_common(held, signature, x[some], y[some]) >= least[some]]
            some = some[_most_common(n, whole, x[some], y[some]) >= common[some]]
            some = some[~_met(before, token, x[some], y[some])]
            x, y = x[some], y[some]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[x], a[y])), pa.array(np.maximum(a[x], a[y]))], ["a", "b"])
            step[at] += 1
            at = at[step[at] < end[at]]


def _prefix(n: Column) -> Column:
    return n - F.ceil(PERCENT * n / 100) + 1


def _missing(n: Column, m: Column) -> Column:
    """So many tokens two prefixes must share at least for a link to be possible.

    The other common tokens come after the prefix that ends first, so they are
    no more than what follows the larger set's prefix.
    """
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT)) - (F.greatest(n, m) - _prefix(F.greatest(n, m)))


def linked(x: Column, y: Column) -> Column:
    """Whether two sets, as arrays in the order of the hashes, link: the filters of orders two and three, then the whole sets."""
    n, m = F.size(x), F.size(y)
    least = F.ceil(PERCENT * (n + m) / (100 + PERCENT)).cast("int")
    p, q = _prefix(n).cast("int"), _prefix(m).cast("int")
    rest = F.greatest(n - p, m - q)
    up = F.size(F.array_intersect(F.slice(x, F.lit(1), p), F.slice(y, F.lit(1), q)))
    down = F.size(F.array_intersect(F.slice(x, n - p + 1, p), F.slice(y, m - q + 1, q)))
    return (up + rest >= least) & (down + rest >= least) & (F.size(F.array_intersect(x, y)) >= least)


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> tuple[int, DataFrame]:
    """How many pairs (a, b) there are, and those that link.

    Only documents in a pair are read again, one for each set.  Pairs are
    compared as rows, so a task holds one pair of sets at a time.
    """
    pairs = settled(pairs.select("a", "b"), "shingle-pairs")
    wanted = pairs.select("a").union(pairs.select("b")).distinct()
    ones = (
        sets.filter("digest is not null")
        .join(wanted, F.col("digest") == F.col("a"), "left_semi")
        .groupBy("digest")
        .agg(F.min(F.struct("r1", "r2")).alias("one"))
        .select("one.r1", "one.r2")
    )
    ones = settled(ones, "shingle-wanted")
    few = F.broadcast(ones) if ones.count() <= SENT_ROWS else ones
    read = docs.select(*row_hashes(), F.col("text").cast("binary").alias("text")).join(few, ["r1", "r2"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, digest, tokens in _sets(batch, seen, 0):
                held = pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([digest], pa.int64()), held], ["digest", "tokens"])

    stored = settled(read.select("text").mapInArrow(whole, "digest long, tokens array<long>").dropDuplicates(["digest"]), "shingle-whole")
    left = stored.select(F.col("digest").alias("_a"), F.col("tokens").alias("x"))
    right = stored.select(F.col("digest").alias("_b"), F.col("tokens").alias("y"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    links = settled(both.filter(linked(F.col("x"), F.col("y"))).select("a", "b"), "shingle-links")
    n_pairs = pairs.count()
    forget(stored, ones, pairs)
    return n_pairs, links


def _labelled(shared: DataFrame, links: DataFrame) -> DataFrame:
    """Adds the component of each set; a set without links is its own."""
    labels = components(links).withColumnRenamed("node", "_node")
    return shared.join(labels, F.col("a") == F.col("_node"), "left").select(
        F.coalesce("label", "a").alias("label"), "a", "n", "tokens", "whole", *SIGNATURE
    )


def hub_pairs(labelled: DataFrame, turn: int) -> DataFrame:
    """Guesses: each set with the HUBS hubs of other components that it shares most runs with, as far as sizes allow a link.

    A run's hubs are the set of whose prefix others hold most (the one that
    others were copied from, say), give or take a little in later turns, and
    another one.  A hub has only a part of the runs that it
    shares with a set, so an eighth of what a link takes will do.  What is not
    guessed is listed in full later.
    """
    labelled = labelled.select(F.explode("tokens").alias("token"), "label", "a", "n", F.size("tokens").alias("held"))
    random = F.pmod(F.xxhash64(F.lit(turn), "a"), F.lit(1 << 20)) / float(1 << 20)
    one = F.struct(F.col("a").alias("b"), F.col("n").alias("b_n"), F.col("label").alias("b_label"))
    runs = (
        labelled.groupBy(F.col("token").alias("_token"))
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max_by(one, F.col("held") / _prefix(F.col("n")) + random * (0.1 * turn)).alias("x"), F.max_by(one, random).alias("y"))
        .filter("lo <> hi")
    )
    counted = (
        labelled.join(runs, F.col("token") == F.col("_token"))
        .select("a", "n", "label", F.explode(F.array("x", "y")).alias("hub"))
        .select("a", "n", "label", "hub.*")
        .filter("label <> b_label")
        .filter(100 * F.least("n", "b_n") >= PERCENT * F.greatest("n", "b_n"))
        .groupBy("a", "n", "b", "b_n")
        .agg(F.count(F.lit(1)).alias("common"))
        .filter(8 * F.col("common") >= _missing(F.col("n"), F.col("b_n")))
    )
    best = Window.partitionBy("a").orderBy(F.col("common").desc(), "b")
    return (
        counted.withColumn("turn", F.row_number().over(best))
        .filter(F.col("turn") <= HUBS)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _token_rows(labelled: DataFrame) -> DataFrame:
    """A row for each token of a set: its place among them, how many there are, and the ones before it (the token itself where there are none)."""
    tokens, size = F.col("tokens"), F.size("tokens")
    before = [
        F.concat(F.slice(tokens, F.lit(1), F.lit(k)), F.slice(tokens, F.lit(1), F.greatest(size - k, F.lit(0)))).alias(name)
        for k, name in enumerate(BEFORE, 1)
    ]
    shifted = labelled.select("label", "a", "n", size.alias("held"), "whole", *SIGNATURE, tokens.alias("token"), *before)
    rows = shifted.select("label", "a", "n", "held", "whole", *SIGNATURE, F.posexplode(F.arrays_zip("token", *BEFORE)).alias("place", "z"))
    return rows.select("z.token", "label", "a", "n", "place", "held", "whole", *SIGNATURE, *(f"z.{p}" for p in BEFORE))


def all_pairs(labelled: DataFrame) -> DataFrame:
    """All pairs of sets in different components that share prefix tokens under orders one and two."""
    dealt = _token_rows(labelled).repartition("token").sortWithinPartitions("token", "label", "a")
    return dealt.mapInArrow(_cross_pairs, "a long, b long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, r1, r2 (row hashes), n_shingles, group_id and component_id of every document."""
    sets, sketches = set_table(docs)
    shared = shared_prefixes(docs, sets, sketches)
    labelled = shared.withColumn("label", F.col("a"))
    links = docs.sparkSession.createDataFrame([], "a long, b long")
    for turn in range(TURNS):
        tried, found = verified(docs, sets, hub_pairs(labelled, turn))
        links = links.union(found)
        if not found.isEmpty():
            labelled = _labelled(shared, links)
        if found.count() * GUESSES < tried or not tried:
            break  # the rest is as well found by listing it
    links = links.union(verified(docs, sets, all_pairs(labelled))[1])
    joined = components(links).withColumnRenamed("node", "_node")
    of_set = sets.join(joined, F.col("digest") == F.col("_node"), "left").withColumn("group_id", F.coalesce("label", "digest"))
    ids = of_set.filter("group_id is not null").groupBy(F.col("group_id").alias("_group")).agg(F.min("doc_id").alias("smallest"))
    return of_set.join(ids, F.col("group_id") == F.col("_group"), "left").select(
        "doc_id", "r1", "r2", F.col("n").alias("n_shingles"), "group_id",
        F.when(F.col("group_id").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of their component, and those that link with nothing.

    Rows without doc_id count as the last of their component.  Of rows equal in
    doc_id and text one stays.
    """
    found = jaccard_components(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), "r1", "r2")
    # an empty set is alone with its rows' own keys
    group = [F.coalesce("group_id", "r1").alias("g1"), F.when(F.col("group_id").isNull(), F.col("r2")).alias("g2")]
    stay = found.groupBy(*group).agg(F.min(rank).alias("one")).select(F.col("one.r1").alias("_r1"), F.col("one.r2").alias("_r2"))
    keyed = docs.select(F.struct("*").alias("row"), *row_hashes())
    first = keyed.withColumn("turn", F.row_number().over(Window.partitionBy("r1", "r2").orderBy("r1"))).filter("turn = 1")
    held = first.join(stay, (F.col("r1") == F.col("_r1")) & (F.col("r2") == F.col("_r2")), "left_semi")
    return held.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
