"""Token ids in word-aligned blocks: Simple-8b with escapes, and files of such blocks.

A 64-bit word holds a 4-bit selector in its lowest bits and, above it, COUNTS[selector]
ids of BITS[selector] bits each. Selector 0 is the escape: the next word is one id as it
is, for ids of more than 60 bits. A block is encoded alone; decoding handles all words
of one selector at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storepulse.session import work_folder
from storepulse.llm.token_ids import encoder

#: Fixed values of the format, by selector.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.zeros(0, np.uint8)
    if ids.max() < 2**53:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    return np.array([int(i).bit_length() for i in ids], dtype=np.uint8)


def _starts(step: np.ndarray) -> np.ndarray:
    """Places reached from the first one by steps of `step` ids, at most 60 each; four steps are walked at a time."""
    n, place = len(step), np.arange(len(step) + 1)
    one = np.append(step, np.uint8(0))  # no step leads beyond the end
    two = one + one[place + one]
    four = two + two[place + two]
    walk, at, every = four.tobytes(), 0, []
    while at < n:
        every.append(at)
        at += walk[at]
    first = np.array(every, np.int64)
    third = first + two[first]
    starts = np.column_stack((first, first + one[first], third, third + one[third])).ravel()
    return starts[starts < n]


def encode_words(ids: np.ndarray) -> np.ndarray:
    """64-bit words of unsigned ids. Each word takes as many of the next ids as fit."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    width = _bit_lengths(ids)
    widest = {1: width}  # by count: the widest of so many ids from each place on

    def window(count):
        if count not in widest:
            half = 1 << ((count - 1).bit_length() - 1)
            part = window(half)
            widest[count] = np.maximum(part[: max(0, n - count + 1)], part[count - half: count - half + max(0, n - count + 1)])
        return widest[count]

    pick = np.full(n, 255, np.uint8)  # the smallest selector that fits; 255: none
    for s in range(1, len(COUNTS)):
        if n >= COUNTS[s]:
            over = np.negative((window(COUNTS[s]) > BITS[s]).view(np.uint8))  # 255 where it does not fit
            np.minimum(pick[: len(over)], over | np.uint8(s), out=pick[: len(over)])
    pick[pick == 255] = 0  # escape
    starts = _starts(np.asarray(COUNTS, np.uint8)[pick])
    chosen = pick[starts]
    place = np.cumsum(1 + (chosen == 0)) - 1 - (chosen == 0)  # of each selector word
    words = np.zeros(int(len(starts) + (chosen == 0).sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            word = np.full(len(own), s, np.uint64)
            for j in range(COUNTS[s]):
                word |= ids[starts[own] + j] << np.uint64(4 + j * BITS[s])
            words[place[own]] = word
    escaped = np.flatnonzero(chosen == 0)
    words[place[escaped] + 1] = ids[starts[escaped]]
    return words


def decode_words(words: np.ndarray) -> np.ndarray:
    """The ids of a block."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words & np.uint64(15)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    if (selector == 0).any():  # a raw word may look like a selector: walk over them
        at = 0
        for zero in np.flatnonzero(selector == 0):
            if zero >= at:
                raw[zero + 1], at = True, zero + 2
    heads = np.flatnonzero(~raw)
    chosen = selector[heads]
    count = np.asarray(COUNTS, np.int64)[chosen]
    ends = np.cumsum(count)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in range(1, len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << BITS[s]) - 1)
        for j in range(COUNTS[s] if len(own) else 0):
            ids[ends[own] - count[own] + j] = (words[heads[own]] >> np.uint64(4 + j * BITS[s])) & mask
    escaped = np.flatnonzero(chosen == 0)
    ids[ends[escaped] - 1] = words[heads[escaped] + 1]
    return ids


BLOCK = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()),
                   ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary())])


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = 65_536) -> str:
    """Encode every text, append `end_id` and write the ids in ascending order of the document.

    Returns the folder: a Parquet table with one row per block, sorted by (file, block).
    Files cover ranges of ids in order. A block holds whole documents up to about
    `block_ids` ids (a longer document has a block of its own): the ids that come before it
    in its file, the names and lengths of its documents, and the Simple-8b words. Null texts are empty; null ids come first;
    rows that repeat an id stay, ordered by their text. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        file, block, before, open_docs = TaskContext.get().partitionId(), 0, 0, []

        def flush():
            ids = np.frombuffer(b"".join(b for _, b in open_docs), dtype="<u4")
            return pa.RecordBatch.from_pylist([{
                "file": file, "block": block, "before": before, "n_ids": len(ids),
                "doc_ids": [d for d, _ in open_docs], "lengths": [len(b) // 4 for _, b in open_docs],
                "words": encode_words(ids).astype("<u8").tobytes()}], schema=BLOCK)

        end, held = end_id.to_bytes(4, "little"), 0
        tokens = encoder(tokenizer, memory=240_000_000)  # beside the sorted texts, so less than by default
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), tokens.stream(batch.column(1))):
                if open_docs and held + len(ids) // 4 + 1 > block_ids:
                    yield flush()
                    block, before, held, open_docs = block + 1, before + held, 0, []
                open_docs.append((name, ids + end))
                held += len(ids) // 4 + 1
        if open_docs:
            yield flush()

    schema = ("file long, block long, before long, n_ids long, doc_ids array<long>, "
              "lengths array<long>, words binary")
    path = work_folder(docs.sparkSession, "token-files")
    dealt.select("doc_id", "text").mapInArrow(pack, schema).write.parquet(path)
    return path


def read_token_files(spark, path: str) -> DataFrame:
    """`doc_id`, `start` (ids of all documents before), `ids` (little-endian unsigned 32 bits)."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    # One row per file, however many documents: a running sum over them is short.
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = totals.select("file", before.alias("file_start"))
    whole = blocks.join(files, "file").withColumn("start", F.col("file_start") + F.col("before"))

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_words(np.frombuffer(row["words"], dtype="<u8")).astype("<u4")
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(row["start"] + begins, pa.int64()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary())})

    return whole.select("start", "doc_ids", "lengths", "words").mapInArrow(
        unpack, "doc_id long, start long, ids binary")


def digest(found: DataFrame) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32`."""
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.crc32("ids").alias("ids_crc32"))
