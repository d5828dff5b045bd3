"""Packing of token sequences into fixed capacities by a grouping genetic algorithm on islands.

A document becomes its token ids and an end id; what is longer than the
capacity is cut, and only that. Pieces of the full capacity are sequences of
their own. The others are packed in rounds:

1. They are dealt at random over blocks of about BLOCK pieces.
2. ISLANDS populations of packings evolve for a block, each in a Spark row of
   its own. A packing is a set of bins. Crossover injects whole well-filled
   bins of one parent into the other, removes the bins there that hold a piece
   twice now, and puts their other pieces back by best fit; mutation empties the
   least-filled bin and some others the same way. After each epoch the elite of an
   island replaces the worst packing of the next one in the ring.
3. The fullest packing of a block stays. Bins that leave more than SLACK unused
   are opened again, and their pieces go to the next round, where they meet
   those of other blocks, until that saves no bin.

So a task holds a few blocks of bounded size at any number of documents.

Null and empty texts are a single end id; null, repeated and equal keys are
kept, a piece for each row. Other input columns are not read, so their names
cannot clash. An empty table gives an empty packing.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import materialize
from .records import _byte_letters, _tokenizer

BLOCK = 2048         # pieces that are packed together
ISLANDS = 4
POPULATION = 6       # packings on an island
EPOCHS = 2
GENERATIONS = 24     # children of an island in an epoch
ROUNDS = 6
SLACK = 1 / 128      # unused share of a bin beyond which it is opened again
CACHE = 300_000      # encodings of words after which all are forgotten

# Fixed value: the split of the word-level vocabulary; it drops white space and lower-cases.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# --- token ids ---

def word_encoder(path: str, pattern: str):
    """A function from texts to their ids as little-endian 32-bit integers.

    For a byte-level BPE that drops white space, lower-cases and splits by
    ``pattern``: a word between white space always has the same ids, so it is
    encoded once and remembered. Texts on which that could differ (special
    tokens, separators that count as space only for Python, letters whose lower
    case depends on their place, other than composed form) are encoded whole.
    """
    import unicodedata

    import regex
    tok = _tokenizer(path)
    split = regex.compile(pattern).findall
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    odd = re.compile("[\x1c-\x1f\x85Σİ]").search
    tokenize, letters = tok.model.tokenize, dict(enumerate(_byte_letters()))

    class Known(dict):
        def __missing__(self, key):
            word = key
            pieces = (word,) if word.isalpha() else split(word)
            if len(pieces) == 1 and pieces[0] == word:
                if not (word.isascii() and word.isprintable()):
                    word = word.encode().decode("latin-1").translate(letters)
                ids = array("I", [t.id for t in tokenize(word)]).tobytes()
            else:
                ids = b"".join([self[p] for p in pieces])
            if len(key) <= 64:
                self[key] = ids
            return ids

    known = Known()

    def encode(text: str) -> bytes:
        if any(s in text for s in special) or odd(text) or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
            return array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()
        if len(known) > CACHE:
            known.clear()
        return b"".join(map(known.__getitem__, text.lower().split()))

    return encode


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, pattern: str = WORD_PATTERN, text: str = "text",
        key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents: their key, piece, start, length, ids_crc32 and, if wanted, the ids as 32-bit integers."""
    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema[0]]).add("piece", "integer").add("start", "long").add("length", "integer").add("ids_crc32", "long")
    if keep_ids:
        schema = schema.add("ids", "binary")
    end = array("I", [end_id]).tobytes()

    def run(batches):
        encode = word_encoder(tokenizer, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, len(texts), 512):
                owner, piece, size, crc, ids = [], [], [], [], []
                for i, t in enumerate(texts.slice(at, 512).to_pylist(), at):
                    data = memoryview((encode(t) if t else b"") + end)
                    for k in range(0, len(data), 4 * capacity):
                        part = data[k: k + 4 * capacity]
                        owner.append(i)
                        piece.append(k // (4 * capacity))
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            ids.append(bytes(part))
                starts = [p * capacity for p in piece]
                columns = [keys.take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(starts, pa.int64()),
                           pa.array(size, pa.int32()), pa.array(crc, pa.int64())] + [pa.array(ids, pa.binary())] * keep_ids
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


# --- the genetic algorithm, on the lengths of one block ---

def best_fit(sizes: np.ndarray, items, room: list[int], bins: np.ndarray, used: int, capacity: int) -> int:
    """Put ``items`` (in this order) where the least room is left; ``room`` holds room << 32 | bin, sorted. Number of bins."""
    for i in items:
        size = int(sizes[i])
        at = bisect_left(room, size << 32)
        if at < len(room):
            slot = room.pop(at)
            left, b = (slot >> 32) - size, slot & 0xFFFFFFFF
        else:
            left, b = capacity - size, used
            used += 1
        bins[i] = b
        if left:
            insort(room, left << 32 | b)
    return used


def _pack_into(sizes: np.ndarray, bins: np.ndarray, loose: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` with its kept bins numbered anew and the ``loose`` pieces put back, largest first."""
    kept = np.ones(len(bins), bool)
    kept[loose] = False
    bins = bins.copy()
    names, at = np.unique(bins[kept], return_inverse=True)
    bins[kept] = at
    room = capacity - np.bincount(at, weights=sizes[kept], minlength=len(names)).astype("int64")
    free = sorted(int(r) << 32 | b for b, r in enumerate(room) if r > 0)
    best_fit(sizes, loose[np.argsort(-sizes[loose], kind="stable")], free, bins, len(names), capacity)
    return bins


def _loads(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=sizes)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Mean square of how full the bins are: more for fewer bins, and for full bins beside empty ones."""
    return float(np.mean((_loads(sizes, bins) / capacity) ** 2))


def crossover(sizes, first, second, capacity, rng) -> np.ndarray:
    """``first`` with some of the fullest bins of ``second`` as they are, what that displaces put back by best fit."""
    load = _loads(sizes, second)
    full = np.argsort(-load, kind="stable")[: max(1, len(load) // 2)]
    wanted = rng.choice(full, size=min(len(full), int(rng.integers(1, 2 + len(full) // 4))), replace=False)
    injected = np.isin(second, wanted)
    broken = np.isin(first, np.unique(first[injected]))  # bins of the first parent that hold an injected piece
    child = np.where(injected, second + len(sizes), first)
    return _pack_into(sizes, child, np.flatnonzero(broken & ~injected), capacity)


def mutate(sizes, bins, capacity, rng) -> np.ndarray:
    """Empty the least-filled bin and a few others, and put their pieces back by best fit."""
    load = _loads(sizes, bins)
    gone = np.append(rng.choice(len(load), size=min(len(load), int(rng.integers(1, 6))), replace=False), np.argmin(load))
    return _pack_into(sizes, bins, np.flatnonzero(np.isin(bins, gone)), capacity)


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, rng, generations: int) -> list[np.ndarray]:
    """The island's packings after so many children, fullest first; an empty ``population`` is founded first.

    The founders take the pieces in orders that go from the largest to the
    smallest up to a random factor each, the first one exactly so. A packing
    with as few bins as the total length allows ends the search.
    """
    least = -(-int(sizes.sum()) // capacity)
    for k in range(len(population), POPULATION):
        if population and int(population[0].max()) + 1 <= least:
            break
        order = np.argsort(-sizes * rng.uniform(1 - 0.1 * k, 1, len(sizes)), kind="stable")
        bins = np.zeros(len(sizes), "int64")
        best_fit(sizes, order, [], bins, 0, capacity)
        population.append(bins)
    rank = lambda bins: (int(bins.max()), -fitness(sizes, bins, capacity))
    ranked = sorted(((rank(b), k, b) for k, b in enumerate(population)), key=lambda r: r[:2])
    for k in range(generations):
        if ranked[0][0][0] + 1 <= least:
            break
        one, two = (ranked[int(min(rng.integers(len(ranked), size=2)))][2] for _ in range(2))
        child = crossover(sizes, one, two, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(sizes, child, capacity, rng)
        got = rank(child)
        if got < ranked[-1][0] and all(got != r[0] for r in ranked):
            ranked[-1] = (got, POPULATION + k, child)
            ranked.sort(key=lambda r: r[:2])
    return [r[2] for r in ranked]


# --- islands on Spark ---

_STATE = "block BIGINT, island INT, sizes ARRAY<INT>, population ARRAY<BINARY>"


def _epoch(capacity: int, generations: int, seed: int):
    """One epoch of each row (an island); ``guest``, if there, is the elite that migrates in."""
    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                sizes = np.array(row["sizes"], "int64")
                population = [np.frombuffer(p, "<i2").astype("int64") for p in row.get("population") or []]
                if row.get("guest") is not None:
                    population[-1] = np.frombuffer(row["guest"], "<i2").astype("int64")
                rng = np.random.default_rng([seed, row["block"], row["island"]])
                population = evolve(sizes, population, capacity, rng, generations)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int64()), "island": pa.array([row["island"]], pa.int32()),
                    "sizes": pa.array([row["sizes"]], pa.list_(pa.int32())),
                    "population": pa.array([[p.astype("<i2").tobytes() for p in population]], pa.list_(pa.binary()))})
    return run


def _islands(blocks: DataFrame, capacity: int, seed: int) -> DataFrame:
    """(block, bins): the best packing that the islands of each block found, as 16-bit bin numbers."""
    rows = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "sizes")
    state = materialize(rows.repartition("block", "island").mapInArrow(_epoch(capacity, GENERATIONS, seed), _STATE), "islands")
    for k in range(1, EPOCHS):
        guests = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("population")[0].alias("guest"))
        moved = state.join(guests, ["block", "island"])
        state = materialize(moved.mapInArrow(_epoch(capacity, GENERATIONS, seed + k), _STATE), "islands")

    @F.pandas_udf("struct<bins INT, fit DOUBLE>")
    def value(sizes, packing):
        import pandas as pd
        out = [(int(b.max()) + 1, fitness(s, b, capacity)) for s, b in (
            (np.asarray(s, "int64"), np.frombuffer(p, "<i2").astype("int64")) for s, p in zip(sizes, packing, strict=True))]
        return pd.DataFrame(out, columns=["bins", "fit"])

    best = state.select("block", "island", F.col("population")[0].alias("packing"), value("sizes", F.col("population")[0]).alias("v"))
    return best.groupBy("block").agg(F.min_by("packing", F.struct("v.bins", -F.col("v.fit"), "island")).alias("packing"))


def _placed(blocks: DataFrame, best: DataFrame, capacity: int) -> DataFrame:
    """Each piece with its bin, its offset there and what the bin leaves unused."""
    @F.pandas_udf("array<struct<bin INT, offset BIGINT, unused INT>>")
    def places(sizes, packing):
        import pandas as pd
        out = []
        for s, p in zip(sizes, packing, strict=True):
            s, b = np.asarray(s, "int64"), np.frombuffer(p, "<i2").astype("int64")
            order = np.argsort(b, kind="stable")
            ends = np.cumsum(s[order])
            first = np.flatnonzero(np.diff(b[order], prepend=-1))
            base = np.repeat((ends - s[order])[first], np.diff(np.append(first, len(s))))
            offset = np.empty(len(s), "int64")
            offset[order] = ends - s[order] - base
            unused = (capacity - _loads(s, b).astype("int64"))[b]
            out.append([{"bin": x, "offset": y, "unused": z} for x, y, z in zip(b.tolist(), offset.tolist(), unused.tolist(), strict=True)])
        return pd.Series(out)

    at = blocks.join(best, "block").select("block", "pieces", places("sizes", "packing").alias("places"))
    return at.select("block", F.inline(F.arrays_zip("pieces", "places"))).select("block", "pieces.*", "places.*")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with their ``length``) with sequence_id and offset: at most ``capacity`` per sequence, offsets without gaps."""
    pieces = materialize(pieces, "pieces")
    columns = pieces.columns
    done = [pieces.where(F.col("length") >= capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    open_ = pieces.where(F.col("length") < capacity)
    for k in range(ROUNDS):
        n = open_.count()
        if not n:
            break
        parts = -(-n // BLOCK)
        block = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(k)), F.lit(parts))
        # the order within a block is by length and the other columns, so that a lost task gives the same block again
        dealt = open_.select(block.alias("block"), F.struct(F.col("length").alias("_size"), *[c for c in columns]).alias("p"))
        blocks = materialize(dealt.groupBy("block").agg(F.sort_array(F.collect_list("p"), False).alias("pieces")).select(
            "block", F.transform("pieces", lambda p: p["_size"]).alias("sizes"),
            F.transform("pieces", lambda p: F.struct(*[p[c].alias(c) for c in columns])).alias("pieces")), "blocks")
        placed = materialize(_placed(blocks, _islands(blocks, capacity, 1000 * k), capacity), "placed").select(
            *columns, "offset", "unused", (F.lit(k) * (1 << 58) + F.col("block") * (1 << 16) + F.col("bin")).alias("sequence_id"))
        loose = F.col("unused") > int(capacity * SLACK)
        spare = placed.where(loose & (F.col("offset") == 0)).agg(F.coalesce(F.sum("unused"), F.lit(0))).first()[0]
        # nothing left to gain: all in one block, or less unused than a bin
        stop = parts == 1 or spare < capacity or k == ROUNDS - 1
        done.append((placed if stop else placed.where(~loose)).select(*columns, "sequence_id", "offset"))
        if stop:
            break
        open_ = placed.where(loose).select(*columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of each sequence, for pieces cut with their ids."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, **how) -> DataFrame:
    """Key, piece, start, length, ids_crc32 (and ids), sequence_id and offset of every piece of every document."""
    return pack(cut(docs, tokenizer, capacity, end_id, **how), capacity)
