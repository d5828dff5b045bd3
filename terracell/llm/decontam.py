"""Benchmark decontamination with a generalised suffix automaton over the test items."""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, materialize, share, shared, utf8, without

WINDOW = 13            # words of a window
COVER = 20             # a document is contaminated when COVER * n_hit >= n_words
BLOCK_BYTES = 1 << 20  # item text per automaton; more items make more automata
PIECE_WORDS = 20_000   # longer items are cut into pieces that overlap by a window

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII characters."""
    return _WORD.findall(text.lower()) if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window.

    ``step`` keeps the longest suffix of the words read so far that occurs in
    some item. ``items`` maps a state to the set of items that hold the window
    ending there, by its number in ``sets``. ``own`` maps a state to whole items shorter than a
    window that end there, as (length, set) with one set for all equal items;
    ``short`` leads from a state to the nearest of its suffixes that has such items.
    """

    def __init__(self, pieces, window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [(item, whole, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for item, whole, ws in pieces]
        for _, _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self._mark(coded)

    def _state(self, size, link, edges):
        self.size.append(size)
        self.link.append(link)
        self.next.append(edges)
        return len(self.size) - 1

    def _split(self, p, q, c):
        """Clone of ``q`` that is one word longer than ``p``."""
        clone = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last, c):
        q = self.next[last].get(c)
        if q is not None:  # the sequence so far occurs in an earlier item
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, c)
        new = self._state(self.size[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, c)
        return new

    def _level(self, v, size):
        """The state of the last ``size`` words of ``v``."""
        while self.size[self.link[v]] >= size:
            v = self.link[v]
        return v

    def _mark(self, coded):
        held: dict[int, set] = {}
        whole_items: dict[tuple[int, int], set] = {}
        for item, whole, ids in coded:
            v = 0
            for i, c in enumerate(ids):
                v = self.next[v][c]
                if i + 1 >= self.window:
                    held.setdefault(self._level(v, self.window), set()).add(item)
            if whole and 0 < len(ids) < self.window:
                whole_items.setdefault((self._level(v, len(ids)), len(ids)), set()).add(item)
        self.sets: list[set] = []
        number = {}
        for v, found in held.items():
            number[v] = len(self.sets)
            self.sets.append(found)
        self.own: dict[int, list[tuple[int, int]]] = {}
        for (v, length), found in whole_items.items():
            self.own.setdefault(v, []).append((length, len(self.sets)))
            self.sets.append(found)
        self.items: list = [None] * len(self.size)
        self.short: list = [None] * len(self.size)
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            if self.size[v] >= self.window:
                self.items[v] = number.get(self._level(v, self.window))
            self.short[v] = v if v in self.own else self.short[self.link[v]]

    def scan(self, text_words):
        """(spans, items) of a document: maximal hit spans [start, end) in words, items found."""
        follow, link, size, items, short, window = self.next, self.link, self.size, self.items, self.short, self.window
        spans, hits, v, n, code = [], set(), 0, 0, self.vocab.get
        for i, c in enumerate(map(code, text_words)):
            if c is None:
                v = n = 0
                continue
            to = follow[v].get(c)
            while to is None:
                v = link[v]
                n = size[v]
                to = follow[v].get(c)
            v, n = to, n + 1
            cover = 0
            if n >= window and items[v] is not None:
                cover = window
                hits.add(items[v])
            u = short[v]
            while u is not None:  # fewer steps than a window has words
                for length, found in self.own[u]:
                    if length <= n:
                        cover = max(cover, length)
                        hits.add(found)
                u = short[link[u]]
            if cover:
                a = i + 1 - cover
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, i + 1))
        return spans, set().union(*(self.sets[h] for h in hits))


def _pieces(items: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    """(item, whole, words) rows of bounded length; windows lie whole in some piece."""
    def cut(batches):
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                ws = words(t)
                for at in range(0, max(1, len(ws) - window + 1), PIECE_WORDS) if ws else ():
                    out.append((i, len(ws) < window, b" ".join(ws[at:at + PIECE_WORDS + window - 1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else ([], [], []), (pa.string(), pa.bool_(), pa.binary()), strict=True)],
                names=["item", "whole", "words"],
            )

    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    return rows.mapInArrow(cut, "item STRING, whole BOOLEAN, words BINARY")


def _merge(a, b):
    out = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan_documents(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word positions [start, end), merged) and ``hit_items`` (sorted strings).

    A word is hit when it lies in an occurrence of ``window`` consecutive words
    of an item, or of a whole item that is shorter. The items are held in
    automata of at most about BLOCK_BYTES of text, one broadcast each; items of
    any total size are handled by as many passes. Null or wordless texts have no
    words; items with a null id or no words take no part; repeated items count
    once. Rows are never moved between tasks.
    """
    added = ["n_words", "hit_spans", "hit_items"]
    out = (
        without(docs, added).withColumn("n_words", F.lit(0).cast("long"))
        .withColumn("hit_spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
        .withColumn("hit_items", F.array().cast("array<string>"))
    )
    pieces = materialize(_pieces(items, item_id, item_text, window), "items").withColumn(
        "block_hash", F.xxhash64("item", "words"))
    size = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    pa_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for block in range(blocks):
        rows = pieces.where(F.pmod("block_hash", F.lit(blocks)) == block).distinct().collect()
        held = share(docs.sparkSession, Automaton([(r["item"], r["whole"], bytes(r["words"]).split()) for r in rows], window))

        def start(held=held):
            automaton = shared(held)

            def work(texts, spans, items):
                n, sp, it = [], [], []
                for t, old_s, old_i in zip(utf8(texts), spans.to_pylist(), items.to_pylist(), strict=True):
                    ws = words(t)
                    s, found = automaton.scan(ws)
                    if old_s:
                        s = _merge([(x["start"], x["end"]) for x in old_s], s)
                    n.append(len(ws))
                    sp.append([{"start": a, "end": b} for a, b in s])
                    it.append(sorted(found | set(old_i)))
                return n, sp, it
            return work

        # the old values ride along under other names and are replaced
        old = out.withColumnsRenamed({"hit_spans": "_old_spans", "hit_items": "_old_items"})
        out = add_columns(
            old, [("n_words", T.LongType(), pa.int64()), ("hit_spans", span, pa_span),
                  ("hit_items", T.ArrayType(T.StringType()), pa.list_(pa.string()))],
            start, [text, "_old_spans", "_old_items"],
        ).drop("_old_spans", "_old_items")
        if blocks > 1:
            out = materialize(out, "scanned")
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **kwargs) -> DataFrame:
    """``scan_documents`` with ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    Contaminated: at least one hit word and ``COVER * n_hit >= n_words``.
    """
    added = ["n_hit", "n_items", "items_sha256", "contaminated"]
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return without(scan_documents(docs, items, text, **kwargs), added).withColumns({
        "n_hit": hit,
        "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join("hit_items", ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * COVER >= F.col("n_words")))


def remove_spans(scanned: DataFrame, text: str = "text", min_words: int = WINDOW) -> DataFrame:
    """``clean_text``: the text less its hit spans of at least ``min_words`` words.

    A span goes with the bytes from its first to its last word; the rest is
    kept byte for byte. A null text stays null.
    """
    def start():
        def work(texts, spans):
            out = []
            for t, s in zip(utf8(texts), spans.to_pylist(), strict=True):
                cut = [(x["start"], x["end"]) for x in s or () if x["end"] - x["start"] >= min_words]
                if t is not None and cut:
                    at = [m.span() for m in _WORD.finditer(t.lower())]
                    kept, done = [], 0
                    for a, b in cut:
                        kept.append(t[done:at[a][0]])
                        done = at[b - 1][1]
                    t = b"".join([*kept, t[done:]])
                out.append(None if t is None else t.decode("utf-8", "replace"))
            return (out,)
        return work

    return add_columns(scanned, [("clean_text", T.StringType(), pa.string())], start, [text, "hit_spans"])


def digest(items) -> str:
    """The digest of a set of item ids, as the column ``items_sha256`` has it."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
