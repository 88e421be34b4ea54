"""Byte-level BPE by DuckDB queries: encoding and decoding from a rank file.

In every partition the distinct new words go to DuckDB as rows (word, position, token). One
recursive query joins neighbours with the merge table and contracts the leftmost pair of
minimum rank of every word until none has a pair; a long word has several places where a pair
is next. The recursion is keyed by (word, position): only the newest state of a word is kept,
so a match of any length takes memory in proportion to its bytes. Decoding joins ids with the
vocabulary and puts their bytes together in order.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.token_ids import _ODD, _TWO
from storepulse.llm.worker import keep

#: Memory that a byte of a long word needs in the recursion: token, neighbours, pairs.
_LONG_BYTES = 600
#: Between a character that is no white space and a space before another, a piece ends.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: A space or line break that does not stand between two such characters.
_UNEVEN = re.compile(r"[ \n](?!\S)|(?<!\S)[ \n]")
#: The signs of ASCII, and a character of each other kind that patterns tell apart.
_KINDS = [*punctuation, *"aZ7\u00e9\u0301\u4e2d\u0663\u00b2\u2026\u20ac\U0001f600"]

WHOLE = """
INSERT INTO encoded SELECT w.word, 0 AS pos, v.id FROM words w JOIN vocabulary v ON v.bytes = w.bytes
"""

# A round of the recursion reads the tokens of the round before (`state`) and gives the words
# that had a pair again, with -1 where a token went into the one before it.
#
# Words of up to `reach` bytes: the leftmost pair of least rank. `best` holds its rank, place and
# the place of its second token in one number.
SHORT = """
INSERT INTO encoded
WITH RECURSIVE state(word, pos, id) USING KEY (word, pos) AS (
    SELECT word, pos, id FROM letters ANTI JOIN encoded USING (word) WHERE NOT long
    UNION ALL
    (WITH near AS (
        SELECT word, pos, id, lead(id) OVER o AS next_id, lead(pos) OVER o AS next_pos, lead(word) OVER o AS next_word
        FROM state WHERE id >= 0 WINDOW o AS (ORDER BY word, pos)),
    best AS (
        SELECT n.word, min((m.merged::BIGINT * {reach} + n.pos) * {reach} + n.next_pos) AS best
        FROM near n JOIN merges m ON m.a = n.id AND m.b = n.next_id WHERE n.word = n.next_word GROUP BY n.word)
    SELECT s.word, s.pos, CASE s.pos WHEN best // {reach} % {reach} THEN (best // ({reach} * {reach}))::INTEGER
                                     WHEN best % {reach} THEN -1 ELSE s.id END
    FROM state s JOIN best USING (word) WHERE s.id >= 0))
SELECT word, pos, id FROM state WHERE id >= 0
"""

# Longer words, in which several pairs are next at the same time.
# `pairs`: neighbours that merge. A pair of least rank in its block of `reach` bytes and the
# blocks beside it (`lowest`, `least`) is next whatever happens beyond: what could take one of its
# tokens is a token of at most half a block. All such pairs are contracted in one round, every
# other one where they overlap, provided that the start of their row is among them (`free`). Only
# where a result would go on at once (it has a lower rank with a neighbour, `goes_on`), the leftmost
# goes alone.
LONG = """
INSERT INTO encoded
WITH RECURSIVE state(word, pos, id) USING KEY (word, pos) AS (
    SELECT word, pos, id FROM letters ANTI JOIN encoded USING (word) WHERE long
    UNION ALL
    (WITH near AS MATERIALIZED (
        SELECT word, pos, id, (row_number() OVER o)::INTEGER AS place, lag(word) OVER o AS word_before, lag(id) OVER o AS id_before,
               lead(word) OVER o AS next_word, lead(id) OVER o AS next_id,
               lead(word, 2) OVER o AS word_after, lead(id, 2) OVER o AS id_after
        FROM state WHERE id >= 0 WINDOW o AS (ORDER BY word, pos)),
    pairs AS MATERIALIZED (
        SELECT n.word, n.pos, n.id, n.place, m.merged, m.doubles, n.pos // {reach} AS block,
               CASE WHEN word_before = word THEN id_before END AS id_before,
               CASE WHEN word_after = word THEN id_after END AS id_after
        FROM near n JOIN merges m ON m.a = n.id AND m.b = n.next_id WHERE n.word = n.next_word),
    blocks AS MATERIALIZED (SELECT word, block, min(merged) AS least FROM pairs GROUP BY word, block),
    more AS (SELECT * FROM blocks SEMI JOIN (SELECT word FROM pairs WHERE block > 0) USING (word)),
    around AS (
        SELECT word, block, least FROM blocks
        UNION ALL SELECT word, block - 1, least FROM more UNION ALL SELECT word, block + 1, least FROM more),
    lowest AS (SELECT word, block, min(least) AS merged FROM around GROUP BY word, block),
    least AS MATERIALIZED (
        SELECT n.*, coalesce(b.merged = n.merged, false) AS follows,
               coalesce(n.doubles OR l.merged < n.merged OR r.merged < n.merged, false) AS goes_on
        FROM (SELECT p.* FROM pairs p JOIN lowest USING (word, block, merged)) n
        LEFT JOIN merges b ON b.a = n.id_before AND b.b = n.id
        LEFT JOIN lower l ON l.a = n.id_before AND l.b = n.merged LEFT JOIN lower r ON r.a = n.merged AND r.b = n.id_after),
    rows AS (SELECT *, place - row_number() OVER (ORDER BY place) AS row FROM least WHERE follows),
    heads AS (SELECT row, min(place) - 1 AS head FROM rows GROUP BY row),
    free AS (
        SELECT word, block, pos, place, merged FROM least WHERE NOT follows
        UNION ALL
        SELECT r.word, r.block, r.pos, r.place, r.merged FROM rows r
        JOIN heads h ON h.row = r.row AND (r.place - h.head) % 2 = 0 SEMI JOIN least l ON l.place = h.head),
    wild AS (SELECT DISTINCT word, block + d AS block FROM least, (VALUES (-1), (0), (1)) AS v(d) WHERE goes_on),
    first AS (
        SELECT w.word, w.block, min(l.pos) AS pos FROM wild w
        JOIN least l ON l.word = w.word AND l.block BETWEEN w.block - 1 AND w.block + 1 GROUP BY w.word, w.block),
    chosen AS MATERIALIZED (
        SELECT f.place, f.merged FROM free f LEFT JOIN first w ON w.word = f.word AND w.block = f.block
        WHERE w.pos IS NULL OR w.pos = f.pos),
    changes AS (SELECT place, merged AS id FROM chosen UNION ALL SELECT place + 1, -1 FROM chosen)
    SELECT n.word, n.pos, coalesce(c.id, n.id) FROM near n SEMI JOIN blocks USING (word) LEFT JOIN changes c ON c.place = n.place))
SELECT word, pos, id FROM state WHERE id >= 0
"""

GATHER = "SELECT word, id FROM encoded ORDER BY word, pos"

DECODE = """
SELECT t.word, string_agg(v.bytes, '' ORDER BY t.pos) AS hex
FROM encoded t JOIN vocabulary v ON v.id = t.id GROUP BY t.word
"""


def _even(text: str) -> bool:
    """Whether spaces and line breaks all stand between two characters that are no white space."""
    for found in _ODD:
        if found in text:
            return _UNEVEN.search(text) is None
    for found in _TWO:
        if found in text:
            return False
    return not text or (text[0] not in " \n" and text[-1] not in " \n")


class WordCodec:
    """Words to ids and back. What was found is kept up to about `remembered` bytes: when half of
    them are full, what was not used since the last time is let go. DuckDB takes `memory` MB, and
    600 bytes more for each byte of words longer than `_reach`, of which a chunk has a megabyte
    unless one word alone has more."""

    def __init__(self, path: str, pattern: str, memory: int = 200, chunk: int = 50_000,
                 remembered: int = 360_000_000):
        import duckdb
        import regex
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._letters = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        if self._letters.min() < 0:
            raise ValueError("every byte needs a rank")
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self._db = duckdb.connect()
        self._memory = memory
        self._db.execute(f"SET memory_limit='{memory}MB'")
        self._db.execute("SET threads=1")
        self._fill("vocabulary", bytes=pa.array([t.hex() for t in ranks]), id=pa.array(ranks.values(), pa.int32()))
        a, b, merged = zip(*pairs) if pairs else ((), (), ())
        doubles = {x for x, y, r in pairs if x == y and r < x}
        self._fill("merges", a=pa.array(a, pa.int32()), b=pa.array(b, pa.int32()), merged=pa.array(merged, pa.int32()),
                   doubles=pa.array([r in doubles for r in merged], pa.bool_()))
        low = [p for p in pairs if p[2] < max(p[:2])]
        self._fill("lower", **{k: pa.array([p[i] for p in low], pa.int32()) for i, k in enumerate(("a", "b", "merged"))})
        self._reach = 2 * max(map(len, ranks), default=1)
        self._split, self._chunk, self._remembered = regex.compile(pattern).findall, chunk, remembered
        # Whether a line break between two characters is a piece, as in most patterns; if not, texts are cut at spaces only.
        sides = {c: (self._split("x" + c), self._split(c + "x")) for c in _KINDS}
        self._breaks = all(self._split(f"x{a}\n{b}x") == [*sides[a][0], "\n", *sides[b][1]] for a in sides for b in sides)
        # Words, and stretches of several words; those met lately, and those met before that.
        self._known: dict[str, tuple[bytes, bytes]] = {}
        self._before: dict[str, tuple[bytes, bytes]] = {}
        self._held = 0

    def _fill(self, table: str, **columns: pa.Array) -> None:
        rows = pa.table(columns)
        self._db.register("_rows", rows)
        self._db.execute(f"CREATE OR REPLACE TABLE {table} AS SELECT * FROM _rows")
        self._db.unregister("_rows")

    def _learn(self, words: list[str]) -> None:
        """Into `_known`, in chunks of at most `chunk` words and, but for one long word, 20 bytes for each."""
        part, size = [], 0
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if part and (len(part) >= self._chunk or size + len(raw) > 20 * self._chunk):
                self._learn_chunk(part)
                part, size = [], 0
            part.append((word, raw))
            size += len(raw)
        if part:
            self._learn_chunk(part)

    def _learn_chunk(self, part: list[tuple[str, bytes]]) -> None:
        sizes = np.array([len(raw) for _, raw in part])
        word = np.repeat(np.arange(len(part)), sizes)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        letters = self._letters[np.frombuffer(b"".join(raw for _, raw in part), np.uint8)]
        self._fill("words", word=pa.array(range(len(part)), pa.int32()), bytes=pa.array([raw.hex() for _, raw in part]))
        self._fill("letters", word=pa.array(word, pa.int32()), pos=pa.array(pos, pa.int32()), id=pa.array(letters),
                   long=pa.array(np.repeat(sizes > self._reach, sizes)))
        self._db.execute("CREATE OR REPLACE TABLE encoded (word INTEGER, pos INTEGER, id INTEGER)")
        self._db.execute(WHOLE)
        self._db.execute(SHORT.format(reach=self._reach))
        long = int(sizes[sizes > self._reach].sum())
        if long:
            self._db.execute(f"SET memory_limit='{self._memory + long * _LONG_BYTES // 10**6}MB'")
            self._db.execute(LONG.format(reach=self._reach))
            self._db.execute(f"SET memory_limit='{self._memory}MB'")
        found = self._db.execute(GATHER).fetchnumpy()
        ids = np.ascontiguousarray(found["id"], "<u4").tobytes()
        ends = 4 * np.searchsorted(found["word"], np.arange(len(part) + 1))
        texts = dict(self._db.execute(DECODE).fetchall())
        for i, (text, _) in enumerate(part):
            self._keep(text, (ids[ends[i]:ends[i + 1]], bytes.fromhex(texts[i])))

    def _keep(self, text: str, entry: tuple[bytes, bytes]) -> None:
        self._known[text] = entry
        self._held += 320 + len(text) + len(entry[0]) + len(entry[1])  # with what Python adds

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32 bits, bytes decoded from those ids) of each text."""
        return list(zip(*(c.to_pylist() for c in self.columns(pa.array(texts, pa.large_string())))))

    def columns(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The same as two columns; null counts as empty."""
        if self._held > self._remembered // 2:
            self._before, self._known, self._held = self._known, {}, 0
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        rows = texts.to_numpy(zero_copy_only=False).tolist()
        even = [_even(t) for t in rows]
        if all(even):
            return self._even(texts)
        cut = [[] if e else _CUT.split(t) for t, e in zip(rows, even)]
        known = self._look_up({c for cs in cut for c in cs})
        out = [[b"".join([known[c][i] for c in cs]) for cs in cut] for i in (0, 1)]
        for i, column in enumerate(self._even(texts.filter(pa.array(even)))):
            for at, entry in zip([at for at, e in enumerate(even) if e], column.to_pylist()):
                out[i][at] = entry
        return pa.array(out[0], pa.large_binary()), pa.array(out[1], pa.large_binary())

    def _even(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Texts whose spaces and line breaks all stand between two characters that are no white
        space: split and told apart in Arrow, looked up once a word, and put together there."""
        if self._breaks:
            texts = pc.replace_substring(texts, "\n", " \n ")
        chunks = pc.split_pattern(texts, " ")
        begins = chunks.offsets.to_numpy()
        coded = chunks.flatten().dictionary_encode()
        words, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        bare = np.zeros(len(index) + 1, bool)  # words without a space before them
        bare[begins[:-1]] = True
        if self._breaks and "\n" in words:
            breaks = np.flatnonzero(index == words.index("\n"))
            bare[breaks] = bare[breaks + 1] = True
        index += len(words) * bare[:-1]
        used = np.flatnonzero(np.bincount(index, minlength=2 * len(words)))
        met = [words[i - len(words)] if i >= len(words) else " " + words[i] for i in used.tolist()]
        known = self._look_up(met)
        place = np.empty(2 * len(words), np.int64)
        place[used] = np.arange(len(used))
        order = pa.array(place[index])

        def gathered(entries: list[bytes]) -> pa.Array:
            all_words = pa.array(entries, pa.large_binary()).take(order)
            ends = np.frombuffer(all_words.buffers()[1], np.int64)[begins]
            return pa.Array.from_buffers(pa.large_binary(), len(texts),
                                         [None, pa.py_buffer(ends), all_words.buffers()[2] or pa.py_buffer(b"")])

        return gathered([known[w][0] for w in met]), gathered([known[w][1] for w in met])

    def _look_up(self, stretches: Iterable[str]) -> dict[str, tuple[bytes, bytes]]:
        """All that is known, with what each of the different `stretches` became."""
        known, before = self._known, self._before
        known[""] = (b"", b"")

        def missing(some):
            """Those of `some` that are not known; what was known before is again."""
            strange = []
            for c in some:
                if c in before:
                    self._keep(c, before[c])
                else:
                    strange.append(c)
            return strange

        pieces = {c: self._split(c) for c in missing([c for c in stretches if c not in known])}
        self._learn(missing({w for ws in pieces.values() for w in ws if w not in known}))
        for c, ws in pieces.items():
            if ws != [c]:
                self._keep(c, (b"".join([known[w][0] for w in ws]), b"".join([known[w][1] for w in ws])))
        return known


def codec(path: str, pattern: str) -> WordCodec:
    """One codec per Python worker, kept for its later tasks."""
    return keep((WordCodec, path, pattern), lambda: WordCodec(path, pattern))


def _parts(batch: pa.RecordBatch, rows: int = 2048, size: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of up to `rows` rows whose texts have `size` bytes together, or one row that has more."""
    at, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
        if i > at and (i - at == rows or held + n > size):
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """`doc_id`, `ids` (little-endian unsigned 32 bits), `decoded` (the bytes of those ids).

    Each match of `pattern` is encoded alone; there are no special tokens. Null texts count
    as empty and have no ids. Nothing is shuffled: a partition holds the words it has met,
    up to a bound. Repeated rows and null ids stay; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(ranks, pattern)
        for batch in batches:
            for part in _parts(batch):
                ids, decoded = words.columns(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), ids.cast(pa.binary()), decoded.cast(pa.binary())],
                                                 names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digest(found: DataFrame) -> DataFrame:
    """`doc_id`, `n_tokens` and the checksums of ids and decoded bytes."""
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
