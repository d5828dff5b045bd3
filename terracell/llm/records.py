"""Token ids in files of length-delimited binary records, with a separate offset index.

A file is a run of records. A record is

    8 bytes   length of the body, little endian
    4 bytes   masked CRC-32 of those 8 bytes
    body      1 byte (1: the document has an id, 2: wide ids), 8 bytes id, then the token ids
    4 bytes   masked CRC-32 of the body
    1 byte    line feed, the end mark

all little endian. A mask rotates the checksum right by 15 bits and adds a
constant, so that a checksum of data that holds checksums stays meaningful.
Token ids take two bytes where the vocabulary has at most 65,536, else four
(wide), and the record says which.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import sys
import types
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import materialize

END_ID = 0
RANGE_BYTES = 8 << 20    # text per range of ids
CHUNK_BYTES = 8 << 20    # a file is closed once its records reach this; one longer record has a file of its own
CACHE = 400_000          # encodings of pieces of text after which only those used again are kept
GROUP = 1 << 19          # characters of the texts whose pieces are looked up together; one longer text has a group of its own
JOINED = 200             # new pieces per call of the model

INDEX = ".index"         # what the folder of the offset index has after the name of the files' folder

# letters up to U+017F, whose class no version of Unicode changes, and what is neither those, ASCII (less separators) nor common punctuation
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_UNUSUAL = f"[^\x00-\x1b\x20-\x7f{_LETTERS}\u2013\u2014\u2018\u2019\u201c\u201d\u2026]"

_MASK = 0xA282EAD8       # fixed value: the constant of masked checksums
_EXTRA = 17              # bytes of a record besides its body


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    head = struct.pack("<Q", len(body))
    return b"".join([head, struct.pack("<I", masked(head)), body, struct.pack("<I", masked(body)), b"\n"])


def frames(data: bytes, name: str = "file"):
    """(offset, body) of each record; a wrong length, checksum or end mark is an error."""
    at = 0
    while at < len(data):
        head = data[at:at + 8]
        if len(head) < 8 or data[at + 8: at + 12] != struct.pack("<I", masked(head)):
            raise ValueError(f"{name}: damaged length at byte {at}")
        size = struct.unpack("<Q", head)[0]
        body = data[at + 12: at + 12 + size]
        if len(body) < size or data[at + 12 + size: at + 17 + size] != struct.pack("<I", masked(body)) + b"\n":
            raise ValueError(f"{name}: damaged record at byte {at}")
        yield at, body
        at += size + _EXTRA


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next past 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b not in rest else chr(256 + rest.index(b)) for b in range(256)]


def _pieces_encoder(tok, kind: str):
    """A function from pieces of text to the ids of each as bytes; the model alone where pieces are byte-level BPE.

    A byte that no UTF-8 text has and no merge names keeps its neighbours apart:
    pieces joined by it get the ids that each has alone, in one call.
    """
    import json

    from tokenizers import Tokenizer
    made = json.loads(tok.to_str())
    model, split, letters = made["model"], made["pre_tokenizer"], _byte_letters()
    if not (model["type"] == "BPE" and split and split["type"] == "ByteLevel" and not (split["add_prefix_space"] or made["normalizer"])):
        return lambda pieces: [np.array(tok.encode(p, add_special_tokens=False).ids, dtype=kind).tobytes() for p in pieces]
    between = letters[0xFF]
    other = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if any(model.get(k) for k in other) or between not in model["vocab"] or any(between in part for m in model["merges"] for part in m):
        tokenize, table = tok.model.tokenize, dict(enumerate(letters))
        return lambda pieces: [np.array([t.id for t in tokenize(p.encode().decode("latin-1").translate(table))], dtype=kind).tobytes() for p in pieces]
    bare, mark, table = Tokenizer(tok.model), model["vocab"][between], dict(enumerate(letters))

    def ids(pieces):
        out = []
        for at in range(0, len(pieces), JOINED):
            # the escaped byte 0xFF is the mark
            text = "\udcff".join(pieces[at: at + JOINED]).encode("utf-8", "surrogateescape").decode("latin-1").translate(table)
            found = np.array(bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=kind)
            cuts, data = np.flatnonzero(found == mark) * found.itemsize, found.tobytes()
            out.extend([data[a:b] for a, b in zip([0, *(cuts + found.itemsize).tolist()], [*cuts.tolist(), len(data)], strict=True)])
        return out

    return ids


def _remembered(name: str, make):
    """What ``make`` gives, kept for later tasks of the same Python process."""
    process = sys.modules.setdefault("terracell_process_cache", types.ModuleType("terracell_process_cache"))
    if name not in process.__dict__:
        process.__dict__[name] = make()
    return process.__dict__[name]


def encoder(path: str, pattern: str | None):
    """``_encoder``, made once per Python process."""
    return _remembered(f"{path} {pattern}", lambda: _encoder(path, pattern))


def _plain_split(pattern: str):
    """``pattern`` for the standard library's engine, or None; the same pieces of texts without characters that ``_UNUSUAL`` names."""
    here = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}0-9]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in here else re.compile(here).findall


def _encoder(path: str, pattern: str | None):
    """A function from texts to their ids as bytes, and the id type.

    ``pattern`` is the tokenizer's own split of a text into pieces that are
    encoded one by one. New pieces of a group of texts are encoded
    together and remembered; once there are too many, those that a later group
    used again stay. Texts that hold a special token, or control characters on
    whose class regular expression engines differ, are encoded whole.
    """
    import regex
    tok = _tokenizer(path)
    kind, code = ("<u4", "I") if wide_ids(tok) else ("<u2", "H")
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    odd, unusual = re.compile("[\x1c-\x1f\x85]").search, re.compile(_UNUSUAL).search
    split = regex.compile(pattern).findall if pattern else None
    plain = (_plain_split(pattern) if pattern else None) or split
    ids_of = _pieces_encoder(tok, kind)
    known: dict[str, bytes] = {}
    again: set[str] = set()

    def pieces_of(t):
        rare = unusual(t)
        if split is None or (rare and odd(t)) or any(s in t for s in special):
            return None
        return split(t) if rare else plain(t)

    def group(texts):
        pieces = [pieces_of(t) for t in texts]
        wanted = set().union(*filter(None, pieces))
        new = list(itertools.filterfalse(known.__contains__, wanted))
        wanted.difference_update(new)
        again.update(wanted)
        known.update(zip(new, ids_of(new), strict=True))
        for t, found in zip(texts, pieces, strict=True):
            if found is None:
                yield array(code, tok.encode(t, add_special_tokens=False).ids).tobytes()
            else:
                yield b"".join(map(known.__getitem__, found))
        for p in new:
            if len(p) > 64:
                del known[p]
        if len(known) > CACHE:
            if len(again) > CACHE // 2:
                again.clear()
            kept = {p: known[p] for p in again}
            known.clear()
            known.update(kept)

    def encode(texts):
        held, size = [], 0
        for t in texts:
            if held and size + len(t) > GROUP:
                yield from group(held)
                held, size = [], 0
            held.append(t)
            size += len(t)
        yield from group(held)

    return encode, kind


def wide_ids(tok) -> bool:
    """Whether ids need four bytes."""
    return tok.get_vocab_size(with_added_tokens=True) > 1 << 16


def write(docs: DataFrame, path: str, tokenizer: str, pattern: str | None = None, text: str = "text", key: str = "doc_id") -> None:
    """Write the ids of each whole text, END_ID appended, to record files below ``path``, in ascending order of key.

    Null keys come first, equal keys in the order of a hash of their texts; a
    null text counts as empty. Ranges of keys become tasks, and tasks files of
    about CHUNK_BYTES, named so that their order is that of the keys.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    tie = F.xxhash64("t")
    ranged = rows.repartitionByRange(max(1, -(-total // RANGE_BYTES)), "key", tie).sortWithinPartitions("key", tie)

    def run(batches):
        encode, kind = encoder(tokenizer, pattern)
        end, wide = np.array([END_ID], dtype=kind).tobytes(), kind == "<u4"
        chunk = seq = size = 0
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1)
            for at in range(0, b.num_rows, 256):
                out = []
                for k, ids in zip(keys[at:at + 256], encode(texts[at:at + 256].to_pylist()), strict=True):
                    rec = frame(struct.pack("<Bq", (k is not None) + 2 * wide, k or 0) + ids + end)
                    if size and size + len(rec) > CHUNK_BYTES:
                        chunk, size = chunk + 1, 0
                    size += len(rec)
                    out.append((chunk, seq, rec))
                    seq += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()), strict=True)],
                    names=["chunk", "seq", "record"])

    # the end mark of a record is the line feed the text writer puts after each row
    framed = ranged.mapInArrow(run, "chunk INT, seq BIGINT, record BINARY").sortWithinPartitions("chunk", "seq")
    framed.select("chunk", F.expr("substring(record, 1, length(record) - 1)").cast("string").alias("value")).write.partitionBy("chunk").text(path)


def _decoded(body: bytes):
    """(key, ids) of a record's body."""
    marks, key = struct.unpack_from("<Bq", body)
    return key if marks & 1 else None, np.frombuffer(body, dtype="<u4" if marks & 2 else "<u2", offset=9).astype("<u4")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, file, range, chunk, number, offset, length, before, n_tokens, ids) of every record below ``path``, checked.

    ``before`` counts the ids of the records before it in its file.
    """
    return _scan(spark, path, "ids", "BINARY", pa.binary(), bytes)


def _scan(spark: SparkSession, path: str, last: str, kind: str, arrow: pa.DataType, made) -> DataFrame:
    """The rows of ``read`` with what ``made`` gives for the bytes of the ids as column ``last``."""
    kinds = [*_KINDS, (last, arrow)]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds, strict=True)], names=[n for n, _ in kinds])

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, before = [], 0
                part, chunk = int(name.rsplit("/part-", 1)[1].split("-")[0]), int(name.rsplit("/chunk=", 1)[1].split("/")[0])
                for i, (at, body) in enumerate(frames(data.as_py(), name)):
                    k, ids = _decoded(body)
                    rows.append((k, name, part, chunk, i, at, len(body) + _EXTRA, before, len(ids), made(ids.tobytes())))
                    before += len(ids)
                    if len(rows) == 256:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        run, f"key BIGINT, file STRING, range INT, chunk INT, number BIGINT, offset BIGINT, length BIGINT, before BIGINT, n_tokens BIGINT, {last} {kind}")


_KINDS = [("key", pa.int64()), ("file", pa.string()), ("range", pa.int32()), ("chunk", pa.int32()), ("number", pa.int64()), ("offset", pa.int64()),
          ("length", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64())]


def index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: (key, file, offset, length, start, n_tokens, ids_crc32), one row per record, read from the files.

    ``file`` is relative to ``path``. ``start`` counts the ids of all records before it, ``ids_crc32`` is the
    CRC-32 of the ids as four-byte integers. With it a reader fetches records
    in any order by file, offset and length.
    """
    rows = materialize(_scan(spark, path, "ids_crc32", "BIGINT", pa.int64(), zlib.crc32), "records")
    files = rows.groupBy("range", "chunk").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy(F.lit(0)).orderBy("range", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("range", "chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    return rows.join(first, ["range", "chunk"]).select(
        "key", _relative(F.col("file")).alias("file"), "offset", "length", (F.col("before") + F.col("_first")).alias("start"), "n_tokens", "ids_crc32")


def _relative(file):
    return F.regexp_extract(file, "(chunk=[0-9]+/[^/]+)$", 1)


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Store the offset index beside the files, at ``path`` + INDEX; the stored table."""
    index(spark, path).write.parquet(path + INDEX)
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path + INDEX)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(place, key, n_tokens, ids) of the records that ``wanted`` (place, file, offset) names, in any order and as often as it does.

    Each file is opened once and gives the wanted stretches of it; only those
    are checked and decoded. ``wanted`` comes from the index.
    """
    stretch = F.struct("place", "offset", "length")
    asked = wanted.join(read_index(spark, path).select("file", "offset", "length"), ["file", "offset"]).groupBy("file").agg(
        F.collect_list(stretch).alias("asked"))  # at most the records of a file, times how often each is named
    files = spark.read.format("binaryFile").load(path).select(_relative(F.col("path")).alias("file"), "content").join(asked, "file")
    cut = F.transform("asked", lambda a: F.struct(a["place"].alias("place"), F.substring(
        F.col("content"), (a["offset"] + 1).cast("int"), a["length"].cast("int")).alias("record")))

    def run(batches):
        for b in batches:
            rows = []
            for place, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for _, body in frames(data.as_py(), "record"):
                    key, ids = _decoded(body)
                    rows.append((place, key, len(ids), ids.tobytes()))
            names, kinds = ["place", "key", "n_tokens", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return files.select(F.inline(cut)).mapInArrow(run, "place BIGINT, key BIGINT, n_tokens BIGINT, ids BINARY")


def shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in an order that depends on ``seed`` only: by ranges of the shuffled place, sorted within."""
    place = F.xxhash64("file", "offset", F.lit(seed))
    return fetch(spark, path, read_index(spark, path).select(place.alias("place"), "file", "offset")).repartitionByRange("place").sortWithinPartitions("place")
