"""Token ids of documents in binary files, in Simple-8b words.

A file is a run of frames, each followed by a line feed (Spark's text sink writes the bytes as they are, on any
file system). A frame holds whole documents: a head, then the documents' ids, marks of null ids and lengths, the
word at which each block of BLOCK ids starts, the words, and the escaped ids. All numbers are little-endian. The upper
4 bits of a word select how many ids of how many bits its lower 60 bits hold; blocks start with a word of their own,
so that all of them can be decoded at once or any of them alone. The last word of a block may hold fewer ids than its
selector says. Ids of more than 60 bits are escaped: their word holds a place in the list of escaped ids.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapledger.llm.packing import tokens
from lapledger.llm.tables import Shelf, chunks, shuffles_removed

MAGIC = b"IDWORDS1"
#: Magic, then documents, ids, blocks, words, escaped ids and bytes of the frame.
HEAD = "<8s6q"
HEAD_SIZE = struct.calcsize(HEAD)
BLOCK = 1_024
#: Ids after which a frame ends with the document at hand, and frames of a file: a file has about 60 MB at most.
FRAME_IDS, FILE_FRAMES = 500_000, 48
#: Words that a worker remembers the tokens of: more of them take less time and more memory.
WORDS, PLAIN_WORDS = 600_000, 300_000
PAYLOAD = 60
#: (ids, bits) of selectors 1 to 14: the widest ids of which so many fit a word. Selector 0 is a run of zeros.
PACKS = sorted({PAYLOAD // bits: bits for bits in range(1, PAYLOAD + 1)}.items(), reverse=True)
ZEROS, ESCAPE = 2 * PAYLOAD, len(PACKS) + 1
COUNTS = np.array([ZEROS, *(count for count, _ in PACKS), 1], np.int64)
LIMITS = np.array([1 << bits for _, bits in PACKS], np.uint64)


#: The first pack that is wide enough, for ids of 16 bits.
KINDS = np.searchsorted(LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _window_max(rows: np.ndarray, count: int) -> np.ndarray:
    """The largest of each value and the ``count`` - 1 values behind it in its row."""
    width = 1
    while width < count:
        step = min(width, count - width)
        wider = rows.copy()
        np.maximum(rows[:, :-step], rows[:, step:], out=wider[:, :-step])
        rows, width = wider, width + step
    return rows


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each place the selector of a word that starts there: the one that holds most ids."""
    n = len(ids)

    def in_blocks(values: np.ndarray) -> np.ndarray:
        # behind the last id is room for anything
        return np.append(values, np.zeros(-n % BLOCK, np.uint8)).reshape(-1, BLOCK)

    kind = in_blocks(KINDS[ids] if ids.max() < len(KINDS) else np.searchsorted(LIMITS, ids, side="right").astype(np.uint8))
    # where ids fit a pack they fit all wider ones, of which a word holds fewer
    best = np.full(kind.shape, ESCAPE, np.uint8)
    for k, (count, _) in enumerate(PACKS):
        best -= _window_max(kind, count) <= k
    if not ids.all():
        best[_window_max(in_blocks((ids != 0).astype(np.uint8)), ZEROS) == 0] = 0
    return best.ravel()[:n]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word that each block starts at (and their number), and escaped ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    firsts = np.arange(0, n, BLOCK, dtype=np.int64)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    ends = np.minimum((np.arange(n, dtype=np.int32) // BLOCK + 1) * BLOCK, n).astype(np.int32)
    best = _selectors(ids)
    following = np.minimum(np.arange(n, dtype=np.int64) + COUNTS[best], ends)
    # all blocks take a step at a time, from word to word
    at, starts = firsts, []
    while len(at):
        starts.append(at)
        block_end, at = ends[at], following[at]
        at = at[at < block_end]
    starts = np.sort(np.concatenate(starts))
    chosen = best[starts]
    words = chosen.astype(np.uint64) << np.uint64(PAYLOAD)
    for k, (count, bits) in enumerate(PACKS, 1):
        rows = np.flatnonzero(chosen == k)
        if len(rows):
            places = starts[rows, None] + np.arange(count)
            inside = places < ends[starts[rows], None]
            values = np.where(inside, ids[np.minimum(places, n - 1)], np.uint64(0))
            words[rows] |= np.bitwise_or.reduce(values << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return words, np.append(np.searchsorted(starts, firsts), len(starts)), ids[starts[escaped]]


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids, of all blocks at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(PAYLOAD)).astype(np.int64)
    before = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = before - before[offsets[:-1]][block] + block * BLOCK
    last = np.zeros(len(words), bool)
    last[offsets[1:] - 1] = True
    ends = np.minimum((block + 1) * BLOCK, n)
    for k, (count, bits) in enumerate(PACKS, 1):
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        mask = np.uint64((1 << bits) - 1)
        for whole in (True, False):
            rows = np.flatnonzero((selector == k) & (last != whole))
            if len(rows):
                places = starts[rows, None] + np.arange(count)
                values = (words[rows, None] >> shifts) & mask
                inside = slice(None) if whole else places < ends[rows, None]
                out[places[inside].ravel()] = values[inside].ravel()
    escaped = np.flatnonzero(selector == ESCAPE)
    out[starts[escaped]] = escapes[(words[escaped] & np.uint64((1 << PAYLOAD) - 1)).astype(np.int64)]
    return out


def frame(docs: list[int | None], ids: list[bytes]) -> bytes:
    """The bytes of a frame of these documents (their ids as little-endian 32-bit numbers)."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    words, offsets, escapes = encode(flat)
    parts = [
        np.array([0 if d is None else d for d in docs], "<i8").tobytes(),
        np.array([d is None for d in docs], np.uint8).tobytes(),
        np.array([len(x) // 4 for x in ids], "<i8").tobytes(),
        offsets.astype("<i8").tobytes(),
        words.astype("<u8").tobytes(),
        escapes.astype("<u8").tobytes(),
    ]
    size = HEAD_SIZE + sum(map(len, parts))
    return b"".join([struct.pack(HEAD, MAGIC, len(docs), len(flat), len(offsets) - 1, len(words), len(escapes), size), *parts])


def heads(content: memoryview) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Where each frame of a file's bytes starts, and the numbers of its head."""
    at = 0
    while at < len(content):
        magic, *numbers = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError("not a frame of token ids")
        yield at, tuple(numbers)
        at += numbers[-1] + 1


def unframed(content: memoryview, at: int, head: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, marks of null ids, lengths and all token ids of the frame that starts there."""
    docs, ids, blocks, words, escapes, _ = head
    at += HEAD_SIZE
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", blocks + 1), ("<u8", words), ("<u8", escapes)):
        parts.append(np.frombuffer(content, kind, count, at))
        at += parts[-1].nbytes
    doc, null, lengths, offsets, packed, escaped = parts
    return doc, null.astype(bool), lengths, decode(packed, offsets, escaped, ids)


def write(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1) -> None:
    """Files with the token ids of all rows, each followed by ``end``, in ascending order of their ids, null first.

    Files are in the order of the numbers in their names. Rows that share an id are documents of their own, in the
    order they are read; a null or empty text is ``end`` alone. ``tokenizer`` names a file that every executor has.
    A task holds a frame at a time: FRAME_IDS ids and one document at most.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows with one id are dealt out too, in the order they are read
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("id", "row").sortWithinPartitions("id", "row")

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, stop = tokens(tokenizer, WORDS, PLAIN_WORDS), np.array([end], "<u4").tobytes()
        held, ids, size = [], [], 0
        for batch in batches:
            for chunk in chunks(batch, "text"):
                for doc, text in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist()):
                    ids.append(known.of(text or "") + stop)
                    held.append(doc)
                    size += len(ids[-1]) // 4
                    if size >= FRAME_IDS:
                        yield pa.RecordBatch.from_arrays([pa.array([frame(held, ids)], pa.binary())], ["frame"])
                        held, ids, size = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([frame(held, ids)], pa.binary())], ["frame"])

    frames = rows.select("id", "text").mapInArrow(framed, "frame binary")
    with shuffles_removed(docs.sparkSession):
        frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_FRAMES).text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """``shard``, ``piece`` (the numbers in a file's name, its place in the order) and ``content`` of each file."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = lambda pattern: F.regexp_extract("path", pattern, 1).cast("long")
    return found.select(number(r"/part-(\d+)-[^/]*$").alias("shard"), number(r"-c(\d+)[^/-]*$").alias("piece"), "content")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids`` of each document of the files, its ids as little-endian 32-bit numbers.

    ``start`` counts the ids of all documents before it. No files make no rows.
    """
    every = files(spark, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [sum(h[1] for _, h in heads(memoryview(c.as_buffer()))) for c in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals, pa.int64())], ["shard", "piece", "ids"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, piece, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                content, before = memoryview(content.as_buffer()), 0
                for at, head in heads(content):
                    doc, null, lengths, ids = unframed(content, at, head)
                    bounds = np.concatenate([[0], np.cumsum(lengths)])
                    raw = pa.py_buffer(ids.astype("<u4").tobytes())
                    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(4 * bounds), raw])
                    columns = [pa.array(doc, mask=null), pa.array(np.full(len(doc), shard)), pa.array(np.full(len(doc), piece))]
                    columns += [pa.array(before + bounds[:-1]), pa.array(lengths), blobs.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "shard", "piece", "inside", "n_tokens", "ids"])
                    before += head[1]

    # a row for each file
    totals = every.mapInArrow(count, "shard long, piece long, ids long")
    earlier = Window.orderBy("shard", "piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", "piece", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    # written, so that Spark knows how small it is and does not shuffle the documents
    bases = Shelf(spark, "token-files").put(bases, "bases")
    found = every.mapInArrow(documents, "id long, shard long, piece long, inside long, n_tokens long, ids binary")
    return found.join(bases, ["shard", "piece"]).select("id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids")
