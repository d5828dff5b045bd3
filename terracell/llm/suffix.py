"""Removal of repeated byte strings by deep-shallow suffix sorting.

Every window of WINDOW bytes belongs to its anchor, the k-gram of least hash in
it, so equal windows share the anchor and their place relative to it. Windows
with one anchor form a segment; equal segments are counted as one. The
different segments of an anchor are sorted by what follows the anchor and by
what precedes it, read backwards: multikey quicksort to a shallow depth, then a
blind trie for each group that is still tied. Two windows are equal exactly
when their segments lie within common prefixes that are long enough in both
orders.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import materialize, share, shared
from .wordhash import CHUNK, Powers, chunks, mix

WINDOW = 400
GRAM = 64                      # bytes of an anchor
SHALLOW = 32                   # bytes past the anchor that multikey quicksort sorts by
PIECE = 4 << 20                # longer texts are cut into pieces whose windows do not overlap
SORT_ROWS = 8192               # segments sorted together, if anchors are not larger
HOT = 200_000                  # anchors of more different segments are settled by hashes of their windows


def segments(data: np.ndarray, borders: np.ndarray, powers: Powers):
    """(text, lo, n, off, anchor): per run of windows with one anchor, the text's number in the chunk, the first
    window's start, the number of windows, the anchor's offset from that start and its hash."""
    grams = WINDOW - GRAM + 1
    starts = np.arange(len(data), dtype="int64")
    text = np.searchsorted(borders, starts, side="right") - 1
    valid = np.flatnonzero(starts + WINDOW <= borders[text + 1])
    if not len(valid):
        none = np.zeros(0, "int64")
        return none, none, none, none, none.view("uint64")
    up, down = powers.upto(len(data))
    total = np.zeros(len(data) + 1, dtype="uint64")
    np.cumsum((data.astype("uint64") + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = mix((total[GRAM:] - total[:-GRAM]) * down[: len(data) - GRAM + 1])
    mask = np.uint64((1 << max(1, int(len(h)).bit_length())) - 1)
    packed = (h & ~mask) | np.arange(len(h), dtype="uint64")
    padded = np.full(-(-len(packed) // grams) * grams, np.iinfo("uint64").max, dtype="uint64")
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, grams)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[valid], ahead[valid + grams - 1]) & mask).astype("int64")
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[valid[1:]] != text[valid[:-1]])
    first = np.flatnonzero(new)
    lo = valid[first]
    return text[lo], lo, np.diff(np.append(first, len(valid))), at[first] - lo, h[at[first]]


def _texts(column: pa.Array, powers: Powers):
    """(first row, bytes, rows of its segments, lo, n, off, anchor, shift) for chunks of texts and pieces of long ones.

    ``shift`` is what to add to a position for its place in the text.
    """
    for row, data, borders in chunks(column, CHUNK // 2):
        if len(borders) == 2 and len(data) > PIECE:
            for at in range(0, len(data) - WINDOW + 1, PIECE):
                piece = data[at: at + PIECE + WINDOW - 1]
                yield row, piece, *segments(piece, np.array([0, len(piece)]), powers), np.array([-at])
        else:
            yield row, data, *segments(data, borders, powers), borders


def text_id(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _hash(body: bytes):
    h = xxhash.xxh3_128_intdigest(body)
    return (h & (1 << 64) - 1) - (1 << 63), (h >> 64 & 0xFFFFFFFF) - (1 << 31)


def _segment_rows(docs: DataFrame, text: str) -> DataFrame:
    """(seg, chk, anchor, tid, lo, n): every segment of every text; (seg, chk) is a hash of its bytes."""
    def run(batches):
        powers = Powers()
        for b in batches:
            ids = [text_id(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            for row, data, text_no, lo, n, _, anchor, shift in _texts(b.column(0), powers):
                body = data.tobytes()
                names = [_hash(body[a: a + k + WINDOW - 1]) for a, k in zip(lo.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in names], pa.int64()), pa.array([c for _, c in names], pa.int32()),
                    pa.array(anchor.view("int64")), pa.array([ids[row + i] for i in text_no.tolist()], pa.int64()),
                    pa.array(lo - shift[text_no], pa.int64()), pa.array(n, pa.int64())], names=["seg", "chk", "anchor", "tid", "lo", "n"])

    return docs.select(text).where(F.octet_length(text) >= WINDOW).mapInArrow(
        run, "seg BIGINT, chk INT, anchor BIGINT, tid BIGINT, lo BIGINT, n BIGINT")


def _bodies(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(anchor, seg, chk, off, n, body) of the segments in ``wanted`` and a few others, once per task."""
    bits = share(docs.sparkSession, bloom.build(wanted, "seg"))

    def run(batches):
        powers, held, done = Powers(), shared(bits), set()
        for b in batches:
            for _, data, _, lo, n, off, anchor, _ in _texts(b.column(0), powers):
                body, rows = data.tobytes(), []
                for a, k, o, g in zip(lo.tolist(), n.tolist(), off.tolist(), anchor.view("int64").tolist(), strict=True):
                    part = body[a: a + k + WINDOW - 1]
                    s, c = _hash(part)
                    if s not in done and all(held[p >> 5] >> (p & 31) & 1 for p in _spots(s)):
                        if len(done) < 1_000_000:
                            done.add(s)
                        rows.append((g, s, c, o, k, part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * 6, _BODY, strict=True)],
                    names=["anchor", "seg", "chk", "off", "n", "body"])

    return docs.select(text).where(F.octet_length(text) >= WINDOW).mapInArrow(
        run, "anchor BIGINT, seg BIGINT, chk INT, off INT, n INT, body BINARY")


_BODY = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _spots(value: int):
    """The filter positions Spark computes for a long."""
    low = xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), 42)
    return [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), low) % bloom.BITS for i in range(bloom.PROBES)]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


def blind_order(rows: list[bytes]) -> list[int]:
    """Order of strings of one length by a blind trie.

    Inner nodes hold the depth at which their strings differ and a child per
    byte there; an insertion walks down blindly, compares once with the leaf it
    ends at, and adds its branch at the depth where the two part.
    """
    if len(rows) == 2:
        return [0, 1] if rows[0] <= rows[1] else [1, 0]
    root: tuple | list = [0]  # a leaf is a list of equal strings, a node a (depth, children) pair
    for i in range(1, len(rows)):
        s, node = rows[i], root
        while isinstance(node, tuple):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        leaf = rows[node[0]]
        depth = _common(s, leaf)
        if depth == len(s):
            node.append(i)
            continue
        above, step, node = None, None, root
        while isinstance(node, tuple) and node[0] < depth:
            above, step = node, s[node[0]]
            node = node[1][step]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][s[depth]] = [i]
            continue
        new = (depth, {leaf[depth]: node, s[depth]: [i]})
        if above is None:
            root = new
        else:
            above[1][step] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(group: np.ndarray, rows: np.ndarray, skip: int):
    """(order, lcp): the rows of a byte matrix sorted within their groups, and the bytes each shares with the row before.

    All rows of a group agree in the first ``skip`` bytes. Multikey quicksort
    orders by the next SHALLOW bytes, eight at a time; rows still tied go
    through a blind trie. A row that begins a group shares -1 bytes.
    """
    words = rows.view(">u8")
    near = range(skip // 8, min(words.shape[1], (skip + SHALLOW) // 8))
    order = np.lexsort([*(words[:, c] for c in reversed(near)), group])
    tied = np.zeros(len(order), dtype=bool)
    tied[1:] = group[order[1:]] == group[order[:-1]]
    for c in near:
        tied[1:] &= words[order[1:], c] == words[order[:-1], c]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tied.astype("int8"), [0]])))
    for a, b in zip(edges[::2] - 1, edges[1::2], strict=True):
        own = order[a:b]
        order[a:b] = own[blind_order([rows[i].tobytes() for i in own])]
    lcp = np.full(len(order), -1, dtype="int64")
    same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    for at in np.array_split(same, max(1, len(same) // 4096)):
        differ = rows[order[at]] != rows[order[at - 1]]
        lcp[at] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, lcp


def repeated_windows(group: np.ndarray, off: np.ndarray, n: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    """Boolean matrix (segment, window): which windows of different segments of an anchor occur in another one too."""
    left_width = -(-(WINDOW - GRAM) // 8) * 8
    right = np.frombuffer(b"".join(b[o: o + WINDOW].ljust(WINDOW, b"\0") for b, o in zip(bodies, off.tolist(), strict=True)), "uint8").reshape(-1, WINDOW)
    left = np.frombuffer(b"".join(b[:o][::-1].ljust(left_width, b"\0") for b, o in zip(bodies, off.tolist(), strict=True)), "uint8").reshape(-1, left_width)
    r_order, r_lcp = deep_shallow(group, right, GRAM)
    l_order, l_lcp = deep_shallow(group, left, 0)
    out = np.zeros((len(n), int(n.max())), dtype=bool)
    r_class, l_class = np.empty(len(n), "int64"), np.empty(len(n), "int64")
    for d in range(int(off.max()) + 1):
        active = np.flatnonzero((off >= d) & (off - d < n))  # those with a window that starts d bytes before the anchor
        if len(active) < 2:
            continue
        r_class[r_order] = np.cumsum(r_lcp < WINDOW - d)
        l_class[l_order] = np.cumsum(l_lcp < d)
        code = r_class[active] * (len(n) + 1) + l_class[active]
        order = np.argsort(code, kind="stable")
        same = code[order[1:]] == code[order[:-1]]
        twin = np.zeros(len(active), dtype=bool)
        twin[order[1:]] |= same
        twin[order[:-1]] |= same
        hit = active[twin]
        out[hit, off[hit] - d] = True
    return out


def _spans(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype("int8"), [0]])))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_PA_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_SPANS = "ARRAY<STRUCT<a: BIGINT, b: BIGINT>>"


def _sorted_groups(rows: DataFrame) -> DataFrame:
    """(seg, chk, spans) of the segments with windows that another segment of their anchor has.

    ``rows`` are partitioned by anchor and sorted by (anchor, seg, chk); a task
    holds SORT_ROWS segments at a time, or one larger anchor.
    """
    def flush(held):
        t = pa.Table.from_batches(held).combine_chunks()
        anchor, seg, chk = (t[c].to_numpy() for c in ("anchor", "seg", "chk"))
        fresh = np.ones(len(seg), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1]) | (chk[1:] != chk[:-1])
        size = np.unique(anchor[fresh], return_inverse=True, return_counts=True)
        keep = np.flatnonzero(fresh)[size[2][size[1]] > 1]
        if not len(keep):
            return
        group = np.unique(anchor[keep], return_inverse=True)[1]
        n = t["n"].to_numpy()[keep].astype("int64")
        bodies = t["body"].take(pa.array(keep)).to_pylist()
        flags = repeated_windows(group, t["off"].to_numpy()[keep].astype("int64"), n, bodies)
        hit = np.flatnonzero(flags.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seg[keep][hit]), pa.array(chk[keep][hit]), pa.array([_spans(flags[i]) for i in hit], _PA_SPANS)], names=["seg", "chk", "spans"])

    def run(batches):
        held, count = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            count += b.num_rows
            if count >= SORT_ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                anchor = t["anchor"].to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
                if cut:
                    yield from flush(t.slice(0, cut).to_batches())
                    held = t.slice(cut).to_batches()
                    count -= cut
        if held:
            yield from flush(held)

    return rows.mapInArrow(run, f"seg BIGINT, chk INT, spans {_SPANS}")


def _hashed_groups(rows: DataFrame) -> DataFrame:
    """``_sorted_groups`` for anchors with more segments than a task should hold: equal windows have equal hashes."""
    def run(batches):
        for b in batches:
            out = []
            for s, c, n, body in zip(*(b.column(k).to_pylist() for k in ("seg", "chk", "n", "body")), strict=True):
                for i in range(n):
                    h = _hash(body[i: i + WINDOW])
                    out.append((h[0], h[1], s, c, i))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                names=["h", "g", "seg", "chk", "i"])

    windows = materialize(rows.dropDuplicates(["anchor", "seg", "chk"]).mapInArrow(run, "h BIGINT, g INT, seg BIGINT, chk INT, i BIGINT"), "windows")
    twice = windows.groupBy("h", "g").agg(F.count("*").alias("c")).where("c > 1").select("h", "g")
    return windows.join(twice, ["h", "g"]).groupBy("seg", "chk").agg(
        F.collect_list(F.struct(F.col("i").alias("a"), (F.col("i") + 1).alias("b"))).alias("spans"))


def repeated_starts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(tid, spans): for each text with a repeated window, the ranges [a, b) of byte positions where one starts.

    ``tid`` is ``text_id`` of the text. Texts shorter than WINDOW have none.
    """
    spark = docs.sparkSession
    # copies of a text have the same rows: each is kept once with their number, so no text outgrows a task
    rows = materialize(_segment_rows(docs, text).groupBy("seg", "chk", "anchor", "tid", "lo", "n").agg(F.count("*").alias("copies")), "segments")
    kinds = materialize(rows.groupBy("seg", "chk", "anchor").agg(F.sum("copies").alias("c"), F.first("n").alias("n")), "kinds")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    # segments that occur twice are repeated throughout; the others are compared within their anchor
    wanted = materialize(kinds.join(anchors, "anchor").select("anchor", "seg", "chk", "kinds"), "wanted")
    bodies = materialize(_bodies(docs, text, wanted.select("seg")), "bodies").join(
        wanted.select("anchor", "kinds").distinct(), "anchor")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sortable = bodies.where(F.col("kinds") <= HOT).repartition(parts, "anchor").sortWithinPartitions("anchor", "seg", "chk")
    found = _sorted_groups(sortable.select("anchor", "seg", "chk", "off", "n", "body"))
    if not wanted.where(F.col("kinds") > HOT).isEmpty():
        found = found.unionByName(_hashed_groups(bodies.where(F.col("kinds") > HOT)))
    found = found.join(kinds.where("c > 1"), ["seg", "chk"], "left_anti")
    whole = kinds.where("c > 1").select("seg", "chk", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))).alias("spans"))
    hits = materialize(found.union(whole), "hits")
    placed = rows.join(hits, ["seg", "chk"]).select("tid", F.explode("spans").alias("s"), "lo")
    return placed.groupBy("tid").agg(F.array_distinct(F.collect_list(F.struct(
        (F.col("lo") + F.col("s.a")).alias("a"), (F.col("lo") + F.col("s.b")).alias("b")))).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row: the text less each byte in a repeated window.

    A window of WINDOW bytes is repeated when it starts anywhere else too, in
    the same text or another. All are judged on the input. Null texts count as
    empty; empty and shorter texts are kept whole; rows that repeat a text of at
    least WINDOW bytes lose it. ``kept`` is binary, as a cut may fall inside a
    character. Texts are known by a 64-bit hash.
    """
    starts = materialize(repeated_starts(docs, text), "starts")
    bits = share(docs.sparkSession, bloom.build(starts, "tid"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))
    schema = rows.select("key").schema[0].dataType

    def split(touched):
        def run(batches):
            held = shared(bits)
            for b in batches:
                ids = [text_id(t) for t in b.column(1).to_pylist()]
                mask = pa.array([all(held[p >> 5] >> (p & 31) & 1 for p in _spots(i)) == touched for i in ids], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.int64())], names=["key", "body", "tid"]).filter(mask)
        return rows.mapInArrow(run, f"key {schema.simpleString()}, body BINARY, tid BIGINT")

    def cut(batches):
        for b in batches:
            total, removed, runs, kept = [], [], [], []
            for body, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                merged = []
                for s in sorted((s["a"], s["b"] + WINDOW - 1) for s in spans or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                rest, at = [], 0
                for a, e in merged:
                    rest.append(body[at:a])
                    at = e
                total.append(len(body))
                removed.append(sum(e - a for a, e in merged))
                runs.append(len(merged))
                kept.append(b"".join([*rest, body[at:]]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["key", "n_bytes", "n_removed", "n_spans", "kept"])

    whole = split(False).select("key", F.length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                F.lit(0).cast("long").alias("n_spans"), F.col("body").alias("kept"))
    less = split(True).join(starts, "tid", "left").select("key", "body", "spans").mapInArrow(
        cut, f"key {schema.simpleString()}, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")
    return whole.unionByName(less).withColumnRenamed("key", key)


def digest(kept: bytes) -> str:
    """The digest of kept bytes, as Spark's sha2 gives it."""
    return hashlib.sha256(kept).hexdigest()
