"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents are encoded and cut into pieces of at most CAPACITY tokens.  Full
pieces are sequences of their own; the others are dealt over shards of bounded
size at random, and each shard is packed by a few islands, each one a row that
any task can evolve.  A solution is a list of bins.  Crossover injects the
well-filled bins of one parent into a copy of the other, drops the bins that hold
a document twice, and best-fits the displaced documents, the long ones first;
fitness is the mean square of how full the bins are.  After each epoch an
island's elite migrates to the next one.  A shard is done when a solution meets
the bound that its tokens set, or after the last epoch.

A shard's slack is left in few bins.  The pieces in those go on to the next
level, again dealt over shards, until one shard holds all of them, so slack is
lost once for the corpus and not once for each shard.

Encoding splits texts at ASCII blanks, across which the tokenizer's normaliser
and pre-tokenizer carry nothing, and remembers the ids of each such word.  A word not
yet met is merged on its bytes if it is plain, else by the tokenizer itself.

Defined results: null text is empty, and an empty document holds the end id only.
Repeated rows are pieces of their own.  Texts of any length are encoded whole and
cut, never shortened.  All columns but the text stay in `row`; an empty table has no pieces.
"""

from __future__ import annotations

import functools
import itertools
import json
import random
import zlib
from array import array
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tiktoken._tiktoken import CoreBPE
from tokenizers import Tokenizer

from tidemark.llm.arrays import binaries
from tidemark.llm.common import settled

CAPACITY = 4096
END_ID = 1
#: Pieces in a shard, on average.
SHARD_PIECES = 2048
ISLANDS = 4
POPULATION = 4
EPOCHS = 3
#: Children of an island in one epoch.
CHILDREN = 12
#: Bins with more room than this pass their pieces on to the next level.
OPEN_ROOM = CAPACITY // 32
#: Words whose ids a Python worker remembers, twice, and the bytes up to which it does.
REMEMBERED = 1 << 18
SHORT = 64
#: Signs that often end a word.
STOPS = b".,;:!?"
#: Documents whose pieces go out together.
OUT_ROWS = 128


# -- encoding ----------------------------------------------------------------


class Merges:
    """The tokenizer's merges on bytes, for words of Latin letters and signs.

    The last byte of a piece and the end of the piece are one symbol in the
    vocabulary; here the end is a byte of its own, one that UTF-8 never uses.
    Ids ascend with the merges, so joining the pair of lowest id first is what
    the tokenizer does, as long as each token is reached by its own merge.
    """

    END = b"\xff"

    def __init__(self, definition: dict):
        model, alphabet = definition["model"], {c: b for b, c in byte_letters().items()}
        suffix = model["end_of_word_suffix"]
        ranks = {}
        for token, rank in model["vocab"].items():
            ends = len(token) > len(suffix) and token.endswith(suffix)
            letters = token[: -len(suffix)] if ends else token
            ranks[bytes(alphabet[c] for c in letters) + (self.END if ends else b"")] = rank
        self.piece = CoreBPE(ranks, {}, r"\S+").encode_single_piece
        self.split = regex.compile(definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        #: Neither composed, nor blank, nor the start of a special token, and one letter each in lower case.
        starts = "".join({regex.escape(t["content"][0]) for t in definition["added_tokens"]})
        self.plain = regex.compile(rf"(?:(?![{starts}])[\x21-\x7e\xa1-\xff])+" if starts else r"[\x21-\x7e\xa1-\xff]+").fullmatch

    @staticmethod
    def fit(definition: dict) -> bool:
        """Whether the definition is of the kind that this class can stand for."""
        model, split = definition["model"], definition["pre_tokenizer"] or {}
        norm, parts = definition["normalizer"] or {}, split.get("pretokenizers", [])
        return (
            model["type"] == "BPE" and bool(model["end_of_word_suffix"])
            and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
            and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
        )

    def encode(self, word: bytes) -> list[int] | None:
        """The ids of a word, or None for one that is not plain."""
        if word.isalpha():  # of bytes: ASCII letters
            return self.piece(word.lower() + self.END)
        text = word.decode("utf-8", "replace")
        if not self.plain(text):
            return None
        if text.isalpha():
            return self.piece(text.lower().encode("utf-8") + self.END)
        return [i for p in self.split(text.lower()) for i in self.piece(p.encode("utf-8") + self.END)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: its own where it can be seen, else the next free one."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordIds(dict):
    """Little-endian ids of each word, made when first asked for; the older half is forgotten when the table is full."""

    def __init__(self, definition: bytes):
        super().__init__()
        self.tokenizer = Tokenizer.from_buffer(definition)
        parsed = json.loads(definition)
        self.merges = Merges(parsed) if Merges.fit(parsed) else None
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encoded(word)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encoded(self, word: bytes) -> bytes:
        if self.merges and word[-1] in STOPS and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]  # letters and a sign are split anyway
        ids = self.merges.encode(word) if self.merges else None
        if ids is None:
            ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))  # of bytes: ASCII blanks


@functools.cache
def word_ids(definition: bytes) -> WordIds:
    """One for each Python worker and tokenizer."""
    return WordIds(definition)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """`row` (without the text), piece (from 0), start, length, `ids` (little-endian 32-bit integers), ids_crc32 and piece_id.

    piece_id follows the place of the rows, so store the result before using it twice.
    Every task reads its rows once; the tokenizer's file is read on the driver.
    """
    with open(path, "rb") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())  # under two megabytes
    end = array("I", [END_ID]).tobytes()
    # the text itself would be stored once for each of its pieces
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    rows = docs.select(row.alias("row"), F.col("text").cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(definition.value)
        for batch in batches:
            texts = binaries(batch.column(1))
            for at in range(0, len(batch), OUT_ROWS):
                of, piece, ids = [], [], []
                for i, text in enumerate(itertools.islice(texts, OUT_ROWS), at):
                    whole = known.encode(text.tobytes()) + end
                    for k, start in enumerate(range(0, len(whole), 4 * capacity)):
                        of.append(i)
                        piece.append(k)
                        ids.append(whole[start : start + 4 * capacity])
                columns = {
                    "row": batch.column(0).take(pa.array(of, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array([k * capacity for k in piece], pa.int64()),
                    "length": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                    "ids_crc32": pa.array(list(map(zlib.crc32, ids)), pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = T.StructType([rows.schema["row"]])
    for name, kind in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("ids_crc32", T.LongType())):
        schema = schema.add(name, kind)
    return rows.mapInArrow(cut, schema).withColumn("piece_id", F.monotonically_increasing_id())


# -- one shard ---------------------------------------------------------------


def bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


class Rooms:
    """Bins by the room that they have, so that the tightest one a length fits is found at once."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.bins: dict[int, list[int]] = {}

    def add(self, bin_: int, room: int) -> None:
        self.bins.setdefault(room, []).append(bin_)
        self.mask |= 1 << room

    def tightest(self, length: int) -> tuple[int, int] | None:
        """A bin with the least room of at least `length`, taken out, and its room."""
        fitting = self.mask >> length
        if not fitting:
            return None
        room = length + (fitting & -fitting).bit_length() - 1
        alike = self.bins[room]
        bin_ = alike.pop()
        if not alike:
            self.mask &= ~(1 << room)
        return bin_, room


class Bins(list):
    """A solution: the items of each bin, and the room that each bin has."""

    def __init__(self, bins: list[list[int]], rooms: list[int]):
        super().__init__(bins)
        self.rooms = rooms

    @classmethod
    def of(cls, bins: list[list[int]], lengths: list[int], capacity: int) -> Bins:
        return cls(bins, [capacity - sum(lengths[i] for i in b) for b in bins])


def best_fit(bins: Bins, items: list[int], lengths: list[int], capacity: int) -> Bins:
    """The bins with the items added in the given order, each where the least room is left."""
    made = Bins(bins, list(bins.rooms))
    rooms = Rooms(capacity)
    for k, room in enumerate(made.rooms):
        rooms.add(k, room)
    for i in items:
        found = rooms.tightest(lengths[i])
        if found is None:
            made.append([])
            made.rooms.append(capacity)
            found = len(made) - 1, capacity
        k, room = found
        made[k] = [*made[k], i]
        made.rooms[k] = room - lengths[i]
        rooms.add(k, made.rooms[k])
    return made


def fitness(bins: Bins, capacity: int) -> tuple[int, int]:
    """Fewer bins are better; of equal numbers, the one with fuller bins beside emptier ones: the squares of the fillings."""
    return -len(bins), sum((capacity - room) ** 2 for room in bins.rooms)


def crossover(one: Bins, two: Bins, lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """A child: well-filled bins of `two` injected whole into `one`."""
    by_room = sorted(range(len(two)), key=two.rooms.__getitem__)
    fullest = by_room[: max(1, len(by_room) // 2)]
    injected = rng.sample(fullest, max(1, len(fullest) // 2))
    inside = {i for k in injected for i in two[k]}
    kept, displaced = [], []
    for k, held in enumerate(one):
        if inside.isdisjoint(held):
            kept.append(k)
        else:
            displaced.extend(i for i in held if i not in inside)
    displaced.sort(key=lambda i: (-lengths[i], i))
    joined = Bins([*(one[k] for k in kept), *(two[k] for k in injected)], [*(one.rooms[k] for k in kept), *(two.rooms[k] for k in injected)])
    return best_fit(joined, displaced, lengths, capacity)


def mutated(bins: Bins, lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """The emptiest bins and a few others taken apart and fitted anew."""
    order = sorted(range(len(bins)), key=lambda k: -bins.rooms[k])
    gone = {*order[:3], *rng.sample(order, min(len(order), 3))}
    loose = [i for k in sorted(gone) for i in bins[k]]
    rng.shuffle(loose)
    stay = [k for k in range(len(bins)) if k not in gone]
    return best_fit(Bins([bins[k] for k in stay], [bins.rooms[k] for k in stay]), loose, lengths, capacity)


def first_population(lengths: list[int], capacity: int, island: int, rng: random.Random) -> list[Bins]:
    """Items best-fitted in random orders; on the first island one solution takes them by falling length."""
    out = []
    for k in range(POPULATION):
        order = list(range(len(lengths)))
        if island == 0 and k == 0:
            order.sort(key=lambda i: (-lengths[i], i))
        else:
            rng.shuffle(order)
        out.append(best_fit(Bins([], []), order, lengths, capacity))
    return out


def evolve(population: list[Bins], lengths: list[int], capacity: int, least: int, rng: random.Random) -> list[Bins]:
    """The best POPULATION of these solutions and up to CHILDREN children, best first; ends early at the bound."""

    def valued(bins):
        return fitness(bins, capacity), bins

    held = sorted(map(valued, population), key=itemgetter(0), reverse=True)[:POPULATION]
    for _ in range(CHILDREN):
        if len(held[0][1]) <= least or len(held) < 2:
            break
        (_, one), (_, two) = rng.sample(held, 2)
        worth, child = valued(mutated(crossover(one, two, lengths, capacity, rng), lengths, capacity, rng))
        if all(worth != other for other, _ in held):
            held = sorted([*held, (worth, child)], key=itemgetter(0), reverse=True)[:POPULATION]
    return [bins for _, bins in held]


def packed_bins(bins: list[list[int]], n: int) -> bytes:
    """The bin of each item."""
    of = np.zeros(n, np.int32)
    for k, held in enumerate(bins):
        of[held] = k
    return of.tobytes()


def unpacked_bins(raw: bytes) -> list[list[int]]:
    of = np.frombuffer(raw, np.int32)
    bins: list[list[int]] = [[] for _ in range(int(of.max()) + 1 if len(of) else 0)]
    for i, k in enumerate(of.tolist()):
        bins[k].append(i)
    return bins


# -- islands -----------------------------------------------------------------

_STATE = "shard long, island int, lengths array<int>, least int, best int, solutions array<binary>"
_STATE_FIELDS = pa.schema(
    [("shard", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())), ("least", pa.int32()), ("best", pa.int32()), ("solutions", pa.list_(pa.binary()))]
)


def _evolved(capacity: int, epoch: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One epoch of each row: shard, island, lengths, its own solutions (none at first) and the elite that came in."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = row["lengths"]
                rng = random.Random(f"{row['shard']}/{row['island']}/{epoch}")
                least = bound(np.array(lengths, np.int64), capacity)
                if row["solutions"] is None:
                    population = first_population(lengths, capacity, row["island"], rng)
                else:
                    population = [Bins.of(unpacked_bins(s), lengths, capacity) for s in [*row["solutions"], row["elite"]]]
                population = evolve(population, lengths, capacity, least, rng)
                made = {
                    "shard": row["shard"], "island": row["island"], "lengths": lengths, "least": least,
                    "best": len(population[0]), "solutions": [packed_bins(p, len(lengths)) for p in population],
                }
                yield pa.RecordBatch.from_pylist([made], _STATE_FIELDS)

    return run


def _migrated(state: DataFrame) -> DataFrame:
    """The islands of the shards that have not met their bound, each with the elite of the one before it."""
    open_ = state.groupBy(F.col("shard").alias("_open")).agg(F.min(F.col("best") - F.col("least")).alias("over")).filter("over > 0")
    going = state.join(open_, F.col("shard") == F.col("_open"), "left_semi")
    elites = going.select(
        F.col("shard").alias("_shard"), F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("_island"), F.get("solutions", F.lit(0)).alias("elite")
    )
    same = (F.col("shard") == F.col("_shard")) & (F.col("island") == F.col("_island"))
    return going.join(elites, same).select("shard", "island", "lengths", "solutions", "elite")


def _spread(rows: DataFrame, n_rows: int) -> DataFrame:
    """Some rows a task: the work is in the rows, not in their bytes."""
    return rows.repartition(max(1, min(n_rows // 16, 1 << 14)), "shard", "island")


def pack_level(items: DataFrame, n_shards: int, capacity: int, level: int) -> DataFrame:
    """piece_id, length, shard, bin, offset and room (what is left in the bin) of the items (piece_id, length)."""
    dealt = items.withColumn("shard", F.pmod(F.xxhash64(F.lit(level), "piece_id"), F.lit(n_shards)))
    members = F.array_sort(F.collect_list(F.struct("piece_id", "length")))  # some SHARD_PIECES
    shards = settled(dealt.groupBy("shard").agg(members.alias("members")), "packing-shards")
    lengths = shards.select("shard", F.col("members.length").cast("array<int>").alias("lengths"))
    rows = lengths.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths", F.lit(None).cast("array<binary>").alias("solutions"), F.lit(None).cast("binary").alias("elite"))
    state = settled(_spread(rows, n_shards * ISLANDS).mapInArrow(_evolved(capacity, 0), _STATE), "packing-islands")
    found = [state]
    for epoch in range(1, EPOCHS):
        going = settled(_migrated(found[-1]), "packing-migrants")
        left = going.count()
        if not left:
            break
        found.append(settled(_spread(going, left).mapInArrow(_evolved(capacity, epoch), _STATE), "packing-islands"))
    solved = functools.reduce(DataFrame.union, [s.select("shard", "best", "island", F.get("solutions", F.lit(0)).alias("bins")) for s in found])
    best = solved.groupBy(F.col("shard").alias("_shard")).agg(F.min_by("bins", F.struct("best", "island")).alias("bins"))

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, members, bins in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, sizes = (np.array([m[k] for m in members], np.int64) for k in ("piece_id", "length"))
                of = np.frombuffer(bins, np.int32).astype(np.int64)
                order = np.argsort(of, kind="stable")
                ends = np.cumsum(sizes[order])
                first = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]])
                before = np.repeat(ends[first] - sizes[order][first], np.diff(np.append(first, len(order))))
                room = capacity - np.bincount(of, sizes).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (ids[order], sizes[order], np.full(len(ids), shard), of[order], ends - sizes[order] - before, room[of[order]])],
                    ["piece_id", "length", "shard", "bin", "offset", "room"],
                )

    return shards.join(best, F.col("shard") == F.col("_shard")).select("shard", "members", "bins").mapInArrow(
        laid, "piece_id long, length long, shard long, bin long, offset long, room long"
    )


def placements(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """piece_id, sequence_id and offset of the items (piece_id, length)."""
    full = items.filter(F.col("length") >= capacity)
    out = [full.select("piece_id", (-1 - F.col("piece_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = settled(items.filter(F.col("length") < capacity).select("piece_id", "length"), "packing-items")
    n_shards, level = -(-left.count() // SHARD_PIECES), 0
    while n_shards:
        laid = settled(pack_level(left, n_shards, capacity, level), "packing-laid")
        opened = F.col("room") > OPEN_ROOM
        left = laid.filter(opened).select("piece_id", "length")
        after = -(-left.count() // SHARD_PIECES) if n_shards > 1 else 0
        if 2 * after > n_shards:
            after = 0  # little can be gained from bins of which most are open
        stay = laid.filter(~opened) if after else laid
        sequence = (F.lit(level << 24) + F.col("shard")) * (1 << 24) + F.col("bin")
        out.append(stay.select("piece_id", sequence.alias("sequence_id"), "offset"))
        n_shards, level = after, level + 1
    return functools.reduce(DataFrame.union, out)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """`row`, piece, start, length, ids, ids_crc32, sequence_id and offset of every piece of every document."""
    cut = settled(pieces(docs, path, capacity), "packing-pieces")
    where = placements(cut.select("piece_id", "length"), capacity).withColumnRenamed("piece_id", "_piece_id")
    return cut.join(where, F.col("piece_id") == F.col("_piece_id")).drop("_piece_id", "piece_id")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence: its pieces joined.  A sequence holds no more than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    whole = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return joined.select("sequence_id", "n_tokens", whole.alias("ids"))
