import math
import random
from collections import Counter

import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F

from storepulse.llm import lattice_lm

MODEL = "piece_bpe_32k.model"


def segmentations(text, weights):
    """Every way to write the text as pieces."""
    if not text:
        yield ()
    for k in range(1, len(text) + 1):
        if weights.get(text[:k]):
            for rest in segmentations(text[k:], weights):
                yield (text[:k], *rest)


def brute(word, weights):
    """Probability of a word, and the expected uses of its pieces."""
    text = lattice_lm._spell(word, lattice_lm._letters(weights))
    each = [(s, math.prod(weights[p] for p in s)) for s in segmentations(text, weights)]
    total, uses = math.fsum(p for _, p in each), Counter()
    for pieces, p in each:
        for piece in pieces:
            uses[piece] += p / total
    return total, uses


@pytest.fixture(scope="module")
def weights():
    return lattice_lm.start_weights(lattice_lm.vocabulary(vocabularies.path(MODEL)))


def some_words(seed, n, least=0, most=11):
    rng = random.Random(seed)
    letters = "abcdeinrst.,'-0129éßж中▁\U000F0041\x00"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(least, most))).encode() for _ in range(n)]


@pytest.mark.parametrize("block", [1, 40, 100_000])
def test_blocks_of_words_equal_every_segmentation(weights, block):
    words = some_words(1, 60, most=6) + [b"", b"the", b"\xff\xfe", b"the", "naïve".encode()]
    lattices = lattice_lm.Lattices(weights, lattice_lm.Trie(weights), block=block)
    times = [1 + i % 4 for i in range(len(words))]
    uses, told = Counter(), lattices.log10(words)
    for word, n, log in zip(words, times, told):
        total, own = brute(word, weights)
        assert math.isclose(log, math.log10(total), rel_tol=1e-9)
        for piece, x in own.items():
            uses[piece] += n * x
    found = dict(zip(lattices.trie.pieces, lattices.expected(words, times)))
    assert {p for p, x in found.items() if x > 0} == {p for p, x in uses.items() if x > 0}
    assert all(math.isclose(found[p], x, rel_tol=1e-8, abs_tol=1e-300) for p, x in uses.items())


def test_long_words_are_summed_alike(weights):
    trie = lattice_lm.Trie(weights)
    words = some_words(2, 20, 150, 500) + some_words(3, 20) + [b"ab" * 4000]
    one, many = (lattice_lm.Lattices(weights, trie, longest=n) for n in (2, 20_000))
    for a, b in zip(one.log10(words), many.log10(words)):
        assert math.isclose(a, b, rel_tol=1e-9)
    times = [3] * len(words)
    for a, b in zip(one.expected(words, times), many.expected(words, times)):
        assert math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-200)


def test_trie_equals_a_dictionary(weights):
    trie = lattice_lm.Trie(weights)
    text = lattice_lm._spell("internationalität".encode(), trie.letters)
    _, _, start, end, piece, _ = lattice_lm.Lattices(weights, trie)._arcs([text])
    found = {(a, b, trie.pieces[p]) for a, b, p in zip(start.tolist(), end.tolist(), piece.tolist())}
    assert found == {(a, b, text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if weights.get(text[a:b])}


def test_bytes_start_with_little_weight(weights):
    assert sum(w for p, w in weights.items() if p and ord(p[0]) >= lattice_lm.BYTE) < 0.01


def test_fit_and_scores_equal_brute_force(spark, weights):
    texts = ["The tin set", "a tin  is set é", "", None, "tent The 中", "sit the", "A"]
    train = [True, True, True, False, False, None, True]
    docs = spark.createDataFrame([(i, t, h, "x") for i, (t, h) in enumerate(zip(texts, train))],
                                 "doc_id long, text string, learn boolean, word string")
    tokens = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(w for ws, h in zip(tokens, train) if h for w in ws)
    ends, now = sum(map(bool, train)), weights
    for _ in range(2):
        raw = Counter({p: 0.1 for p in now})
        raw[lattice_lm.END] += ends
        for word, n in counts.items():
            for piece, x in brute(word, now)[1].items():
                raw[piece] += n * x
        total = math.fsum(raw.values())
        now = {p: x / total for p, x in raw.items()}
    found = lattice_lm.score_documents(docs, vocabularies.path(MODEL), F.col("learn")).collect()
    assert len(found) == len(texts)
    for row in found:
        words = tokens[row.doc_id]
        score = sum(math.log10(brute(w, now)[0]) for w in words) + math.log10(now[lattice_lm.END])
        assert math.isclose(row.score, score, rel_tol=1e-7)
        n, v = sum(counts.values()) + ends, len(counts) + 1
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in words), ends])
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and row.train_tokens == n
        assert row.n_tokens == len(words) + 1 and row.n_known == sum(counts[w] > 0 for w in words) + 1
