import base64
import random
import tempfile
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
from hypothesis import given, settings, strategies as st

from storepulse.llm import bpe, packing, simple8b

SCHEMA = "doc_id long, text string, ids string, words int, start long"
TEXTS = [(4, "Hello world, it's a test.\nNew line"), (1, None), (2, ""), (3, "  two  spaces \t tab\n\nx "),
         (9, "<|endoftext|> é🎉🎉 ünï 12.5%"), (9, "again the same id"), (9, "again the same id"), (None, "no id"),
         (8, "  wide\x1fspace a\x85b"), (7, "word " * 4000), (6, "don't!! stop... 'quoted' a,b.c"), (5, "\n"), (11, " ")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 60_000), st.integers(0, 3)), max_size=300))
@settings(max_examples=200, deadline=None)
def test_simple8b_round_trip(ids):
    given_ids = np.array(ids, dtype=np.uint64)
    words = simple8b.encode_words(given_ids)
    assert simple8b.decode_words(words).tolist() == ids
    if ids and max(ids) < 2**12:
        assert len(words) <= -(-len(ids) // 5) + 1


def test_token_files_read_back(spark, tokenizer):
    path = simple8b.write_token_files(frame(spark, TEXTS), vocabularies.path("byte_bpe_50k.json"), end_id=0, block_ids=50)
    found = simple8b.digest(simple8b.read_token_files(spark, path)).collect()
    assert len(found) == len(TEXTS)
    at, seen = 0, []
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
        seen.append(row.doc_id)
    assert seen == sorted(seen, key=lambda d: (d is not None, d or 0))
    expected = sorted((str(d), zlib.crc32(np.array([*tokenizer(t), 0], "<u4").tobytes())) for d, t in TEXTS)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in found) == expected


def test_packing_places_every_id_once(spark, tokenizer):
    rows = TEXTS + [(100 + i, "some words here " * (i * 7 % 90)) for i in range(120)]
    pieces = packing.pack_documents(frame(spark, rows), vocabularies.path("byte_bpe_50k.json"), capacity=256).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        docs[p.doc_id].append((p.start, p.doc_tokens, bytes(p.ids)))
        sequences[p.sequence_id].append((p.offset, p.length))
    for d, t in rows:
        if d not in (9, None):
            joined = b"".join(b for _, _, b in sorted(docs[d]))
            assert joined == np.array([*tokenizer(t), 1], "<u4").tobytes()
            assert {n for _, n, _ in docs[d]} == {len(joined) // 4}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256 and at & (at - 1) == 0  # full, or a power of two: no padding


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=6), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_best_subset(counts, room):
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    chosen = packing.fullest(counts, room)
    assert sum(chosen) == max(s for s in sums if s <= room)
    assert all(chosen.count(n) <= counts[n] for n in chosen)


def test_windows_use_every_piece():
    rng = random.Random(1)
    lengths = {rng.randrange(1, 100): rng.randrange(1, 30) for _ in range(40)}
    used = defaultdict(int)
    for chosen, times in packing.windows(dict(lengths), 100):
        assert sum(chosen) <= 100
        for n in chosen:
            used[n] += times
    assert used == lengths


def test_bpe_equals_the_library(spark):
    import tiktoken
    path = vocabularies.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode_documents(frame(spark, TEXTS), path, vocabularies.PATTERN).collect()
    expected = [(str(d), np.array(own.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in TEXTS]
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in found) == sorted(expected)


def library():
    import tiktoken
    with open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("alphabet, size", [("acgt", 20_000), ("ab", 20_000), ("-=_*#", 20_000), ("-", 1_000_003)])
def test_bpe_of_one_long_match(alphabet, size):
    text = "".join(random.Random(1).choices(alphabet, k=size))
    ids, decoded = bpe.WordCodec(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN).encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library().encode_ordinary(text) and decoded == text.encode()


def test_bpe_of_a_vocabulary_whose_ranks_fall():
    """Tokens whose rank is below that of a part, so that a contraction may go on at once."""
    import tiktoken
    draw = random.Random(7)
    for _ in range(20):
        parts = {bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(25)}
        tokens = [bytes([i]) for i in range(256)] + draw.sample(sorted(parts), len(parts))
        ranks = {t: i for i, t in enumerate(tokens)}
        own = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
        with tempfile.NamedTemporaryFile("wb", suffix=".tiktoken") as file:
            file.write(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
            file.flush()
            words = bpe.WordCodec(file.name, vocabularies.PATTERN)
        texts = ["".join(draw.choices("abc", k=k)) for k in (3, 9, 30, 99)]
        assert [np.frombuffer(f[0], "<u4").tolist() for f in words.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_bpe_forgets_without_harm():
    words = bpe.WordCodec(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN, chunk=3, remembered=2)
    first = words.encode([t for _, t in TEXTS])
    assert words.encode([t for _, t in TEXTS]) == first
    assert [words.encode([t])[0] for _, t in TEXTS] == first


#: Line breaks and spaces in every place, beside other white space and signs of every kind.
BROKEN = ["", None, "one two\nthree, two\nfour.\n'll five", "one\n\ntwo", "\none", "one\n", " one two", "one two ", "a  b\nc",
          "a \nb", "a\n b", "a\tb\nc d", "a \tb c", "a\u00a0b c\nd", "don't\n's 12\n34 \u00e9\u0301\n\u4e2d\u6587 \U0001f600\n\u20ac5",
          "a\r\nb", "x\x1c y", "\n", " ", "one", "two one\none two"]


def test_bpe_cuts_at_line_breaks():
    words = bpe.WordCodec(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
    for texts in (BROKEN, [t for t in BROKEN if t and "  " not in t], BROKEN[:3]):
        for text, (ids, decoded) in zip(texts, words.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library().encode_ordinary(text or "") and decoded == (text or "").encode()
    words = bpe.WordCodec(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
    words.encode(["seven eight\nnine eight"])
    assert " eight" in words._known and "nine" in words._known and " eight\nnine" not in words._known


def test_bpe_with_signs_that_take_line_breaks():
    """A pattern in which a line break is no piece of its own."""
    import tiktoken
    with open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n/]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    words = bpe.WordCodec(vocabularies.path("byte_bpe_50k.tiktoken"), pattern)
    texts = [t for t in BROKEN if t] + ["a.\n/b c;\nd", "e).\nf g"]
    assert [np.frombuffer(f[0], "<u4").tolist() for f in words.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_bpe_parts_are_bounded_in_rows_and_bytes():
    import pyarrow as pa
    texts = ["a" * n if n else None for n in (0, 5, 9, 30, 1, 1, 1, 1, 0)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    parts = [p.column(1).to_pylist() for p in bpe._parts(batch, rows=3, size=10)]
    assert [t for p in parts for t in p] == texts and list(map(len, parts)) == [2, 1, 1, 3, 2]
    assert list(bpe._parts(batch.slice(0, 0))) == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    path = vocabularies.path("byte_bpe_50k.json")
    assert simple8b.read_token_files(spark, simple8b.write_token_files(none, path)).count() == 0
    assert packing.pack_documents(none, path).count() == 0
    assert bpe.encode_documents(none, vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN).count() == 0


def test_word_memory_is_bounded_in_bytes():
    import random

    from tokenizers import Tokenizer

    from storepulse.llm.token_ids import WordEncoder
    path = vocabularies.path("byte_bpe_50k.json")
    plain, small = Tokenizer.from_file(path), WordEncoder(path, memory=40_000)
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abcdé.,'\n", k=rng.randrange(1, 200))) for _ in range(9)) for _ in range(12)]
        texts += ["a  b", " a", "a ", "a\n\nb", "a\tb", None, "", "\n", "x" * 5000]
        want = [b"".join(i.to_bytes(4, "little") for i in plain.encode(t or "", add_special_tokens=False).ids) for t in texts]
        assert small.encode(texts) == want
    small.encode(["end"])
    assert small._held <= 40_000 + 500 and small._held == sum(small._size(w, i) for w, i in small._known.items() if w)


def test_packing_is_bounded_in_bytes_too(spark):
    rows = [(i, "word " * (300 * (i % 7)) + "end") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = vocabularies.path("byte_bpe_50k.json")
    sizes = []
    for bound in (1 << 20, 5_000):
        found = packing.pack_documents(docs, path, capacity=256, group_bytes=bound).collect()
        ids = defaultdict(bytes)
        for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
            assert r.start * 4 == len(ids[r.doc_id])
            ids[r.doc_id] += bytes(r.ids)
        total = defaultdict(int)
        for r in found:
            total[r.sequence_id] += r.length
        assert all(n <= 256 for n in total.values()) and all(len(ids[r.doc_id]) == 4 * r.doc_tokens for r in found)
        sizes.append(dict(ids))
    assert sizes[0] == sizes[1] and len(sizes[0]) == 40


def test_words_in_use_are_encoded_once():
    from storepulse.llm.token_ids import WordEncoder
    tokens, learned = WordEncoder(vocabularies.path("byte_bpe_50k.json"), memory=60_000), []
    plain = tokens._plain
    tokens._plain = lambda pieces: learned.extend(pieces) or plain(pieces)
    for i in range(60):
        tokens.encode([f"the common words and seven{i} rare{i} new{i} ones{i} odd{i} of{i} them{i}"])
        assert sum(tokens._size(w, b) for w, b in tokens._older.items()) <= 30_000 + 3_000
    assert tokens._older and learned.count(" common") == learned.count(" words") == 1


def test_new_words_are_encoded_as_lines():
    """Far fewer inputs than words reach the tokenizer, and the ids stay those of whole texts."""
    import random

    from tokenizers import Tokenizer

    from storepulse.llm.token_ids import WordEncoder

    class Watched:
        def __init__(self, inner):
            self.inner, self.inputs = inner, 0

        def encode_batch_fast(self, pieces, **kw):
            self.inputs += len(pieces)
            return self.inner.encode_batch_fast(pieces, **kw)

    path = vocabularies.path("byte_bpe_50k.json")
    plain, rng = Tokenizer.from_file(path), random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdeéĠ¡​'’1٣漢.,(", k=rng.randrange(1, 12))) for _ in range(700)) for _ in range(4)]
    want = [b"".join(i.to_bytes(4, "little") for i in plain.encode(t, add_special_tokens=False).ids) for t in texts]
    tokens = WordEncoder(path)
    tokens._tokenizer = Watched(tokens._tokenizer)
    assert tokens.encode(texts) == want
    assert tokens._tokenizer.inputs < 700
    doubtful = WordEncoder(path)
    doubtful._begins[:] = True  # as if the beginnings of words could not be told
    assert doubtful.encode(texts) == want


def test_line_breaks_and_closing_marks_cost_no_inputs(tokenizer, monkeypatch):
    """Words after line breaks or before marks go into the lines as others do, a word once per group of texts."""
    import pyarrow as pa

    from storepulse.llm import token_ids

    tokens, inputs = token_ids.WordEncoder(vocabularies.path("byte_bpe_50k.json")), []
    library = tokens._tokenizer

    class Watched:
        def encode_batch_fast(self, pieces, **kw):
            inputs.extend(pieces)
            return library.encode_batch_fast(pieces, **kw)

    tokens._tokenizer = Watched()
    texts = ["\n".join(f"word{i}{j}, it's{j}! é{i}." for j in range(64)) for i in range(4)] + [None, "", "a  b"] * 2
    want = [np.array(tokenizer(t), "<u4").tobytes() for t in texts]
    assert list(tokens.stream(pa.array(texts))) == want
    assert len(inputs) <= 3 * 64 * 4 // token_ids._LINE + 3 and "".join(inputs).count(" it's7!") == 1
    for bound, few in ((1, 5), (3000, 7), (1 << 20, 100)):  # bytes looked up, words gathered at a time
        monkeypatch.setattr(token_ids, "_GROUP", bound)
        monkeypatch.setattr(token_ids, "_GATHER", few)
        again = token_ids.WordEncoder(vocabularies.path("byte_bpe_50k.json"), memory=20_000)
        assert list(again.stream(pa.array(texts, pa.large_string()).slice(1))) == want[1:] and again.encode(texts) == want


def test_remembered_words_take_little(tokenizer):
    """1200 words stay known within 150,000 bytes, and each is found again without being learned."""
    from storepulse.llm.token_ids import WordEncoder
    tokens, learned = WordEncoder(vocabularies.path("byte_bpe_50k.json"), memory=300_000), []
    plain = tokens._plain
    tokens._plain = lambda pieces: learned.extend(pieces) or plain(pieces)
    texts = [" ".join(f"word{i}é," for i in range(at, at + 40)) for at in range(0, 1200, 40)] + ["", None, " a  b"]
    want = [np.array(tokenizer(t), "<u4").tobytes() for t in texts]
    for _ in range(3):
        assert [i for t in texts for i in tokens.encode([t])] == want
    assert tokens.encode(texts) == want and len(learned) == len(set(learned)) == len(tokens._known) == 1200


@given(st.lists(st.integers(1, 60), max_size=400))
@settings(max_examples=100, deadline=None)
def test_selector_places_are_walked_whole(steps):
    step = np.minimum(steps, np.arange(len(steps), 0, -1)).astype(np.uint8)
    at, reached = 0, []
    while at < len(step):
        reached.append(at)
        at += int(step[at])
    assert simple8b._starts(step).tolist() == reached
