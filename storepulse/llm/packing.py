"""Packing documents into windows: minimum bin slack by a bitset subset-sum over lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.token_ids import encoder


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each used at most `counts` times, whose sum is closest to `room` from below.

    A bitset holds the sums that can be reached; each length is added with its count in
    binary steps, and the bitset before every step allows the way back.
    """
    mask, reached, steps = (1 << (room + 1)) - 1, 1, []
    goal = 1 << room
    for length in sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left > 0:
            take = min(size, left)
            steps.append((reached, length, take))
            reached |= (reached << (length * take)) & mask
            left, size = left - take, size * 2
        if reached & goal:
            break
    at, picked = reached.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            picked += [length] * take
            at -= length * take
    return picked


def windows(lengths: dict[int, int], capacity: int) -> Iterator[tuple[list[int], int]]:
    """(lengths of one window, how many such windows) until every piece is placed.

    Each window starts with the longest piece left; the rest is the fullest multiset of
    what remains, repeated while there are pieces for it.
    """
    counts = {n: c for n, c in lengths.items() if c > 0}
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = [longest, *fullest(counts, capacity - longest)]
        counts[longest] += 1
        need = {n: chosen.count(n) for n in set(chosen)}
        times = min(counts[n] // k for n, k in need.items())
        for n, k in need.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        yield chosen, times


def _powers(n: int) -> list[int]:
    """`n` as powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_pieces(docs: list[tuple], capacity: int) -> Iterator[tuple]:
    """(document, start, length, ids, sequence, offset) of the documents (key, ids as bytes).

    Documents give full windows first; the remainders share windows. Where a window would
    stay short, its pieces are joined with those of other short windows and cut anew into
    full ones; what is left at the end is cut into sequences of a power of two, so that
    no sequence needs padding.
    """
    sequence, rest = 0, {}
    for at, (_, ids) in enumerate(docs):
        n = len(ids) // 4
        for start in range(0, n - capacity + 1, capacity):
            yield at, start, capacity, sequence, 0
            sequence += 1
        if n % capacity:
            rest.setdefault(n % capacity, []).append((at, n - n % capacity))
    short = []
    for chosen, times in windows({n: len(p) for n, p in rest.items()}, capacity):
        for _ in range(times):
            pieces = [(*rest[n].pop(), n) for n in chosen]
            if sum(chosen) < capacity:
                short += pieces
                continue
            offset = 0
            for at, start, n in pieces:
                yield at, start, n, sequence, offset
                offset += n
            sequence += 1
    total = sum(n for _, _, n in short)
    sizes = [capacity] * (total // capacity) + _powers(total % capacity)
    pieces = iter(short)
    at, start, n = next(pieces, (0, 0, 0))
    for size in sizes:
        offset = 0
        while offset < size:
            if not n:
                at, start, n = next(pieces)
            take = min(n, size - offset)
            yield at, start, take, sequence, offset
            start, n, offset = start + take, n - take, offset + take
        sequence += 1


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text", group_docs: int = 8192,
                   group_bytes: int = 64 << 20) -> DataFrame:
    """One row per piece: `doc_id`, `start`, `length`, `ids` (little-endian unsigned 32 bits),
    `doc_tokens`, `sequence_id`, `offset`.

    Every document is encoded and ended with `end_id`. Each partition is packed by itself,
    `group_docs` documents at a time, or fewer once their ids take `group_bytes`, so nothing
    is shuffled and memory is bounded by that and one batch of texts; an
    id lies in exactly one piece, a sequence holds at most `capacity` ids and has no gaps.
    Null and empty texts give one piece, the end id. Rows that repeat an id are packed
    each; null ids stay null; other columns are not read; no documents, no pieces.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, tokens, end = TaskContext.get().partitionId() << 40, encoder(tokenizer), end_id.to_bytes(4, "little")
        held: list[tuple] = []
        weight = 0

        def flush():
            nonlocal base
            found = list(pack_pieces(held, capacity))
            for i in range(0, len(found), 4096):
                part = found[i:i + 4096]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([held[p[0]][0] for p in part], pa.int64()),
                    "start": pa.array([p[1] for p in part], pa.int64()),
                    "length": pa.array([p[2] for p in part], pa.int64()),
                    "ids": pa.array([held[p[0]][1][4 * p[1]:4 * (p[1] + p[2])] for p in part], pa.binary()),
                    "doc_tokens": pa.array([len(held[p[0]][1]) // 4 for p in part], pa.int64()),
                    "sequence_id": pa.array([base + p[3] for p in part], pa.int64()),
                    "offset": pa.array([p[4] for p in part], pa.int64())})
            base += max((p[3] for p in found), default=-1) + 1
            held.clear()

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), tokens.stream(batch.column(1))):
                held.append((name, ids + end))
                weight += len(ids)
                if len(held) >= group_docs or weight >= group_bytes:
                    yield from flush()
                    weight = 0
        if held:
            yield from flush()

    return rows.mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                 "sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
