import math
import random
import re
import zlib

import public_tokenizers as vocabularies
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from storepulse.llm import language_id, lattice_lm, pii
from storepulse.llm.tables import fold, read

SCHEMA = "doc_id long, text string, lang string, score string, pii_spans string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "y") for i, t, g in rows], SCHEMA)


def test_language_held_out(spark):
    docs = read(spark, SF_DIR, "documents").filter("lang IS NOT NULL")
    model = language_id.train(docs.filter(fold("doc_id", 3) != 1))
    found = language_id.identify(docs, model).filter(fold("doc_id", 3) == 1)
    right = found.filter("lang = lang_pred").count()
    assert right >= 0.9 * found.count() > 0


def test_language_edges(spark):
    model = language_id.ByteConvNet(["a", "b"])
    rows = [(1, None, None), (2, "", None), (3, "12 --- 34", None), (4, "word", None), (None, "Ω" * 5000, "x"), (4, "word", None)]
    found = {(r.doc_id, r.text): r for r in language_id.identify(frame(spark, rows), model).collect()}
    assert [found[d, t]["lang_pred"] for d, t, _ in rows[:3]] == ["und"] * 3
    assert found[4, "word"]["lang_pred"] in ("a", "b") and 0 <= found[None, "Ω" * 5000]["score"] <= 1
    assert {r["lang_pred"] for r in language_id.identify(frame(spark, rows), None).collect()} == {"und"}
    assert language_id.train(frame(spark, rows[:3])) is None
    assert language_id.identify(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_windows_cover_all_bytes():
    texts = [b"", b"a", b"b" * 192, b"c" * 500]
    windows, owner = language_id.cut_windows(texts)
    assert owner.tolist() == [1, 2, 3, 3, 3]
    assert [(windows[owner == i] != 0).sum() for i in range(4)] == [len(t) for t in texts]


def test_trained_gradient_lowers_the_loss():
    rng = random.Random(0)
    texts = [bytes(rng.choice(b"abcd" if i % 2 else b"cdef") for _ in range(60)) for i in range(200)]
    windows, owner = language_id.cut_windows(texts)
    labels = (owner % 2).astype(int)
    model = language_id.ByteConvNet(["x", "y"]).fit(windows, labels, least_steps=200, batch=20, rate=0.01)
    assert (model.predict(windows, model.tables()).argmax(axis=1) == labels).mean() > 0.95


def test_predictions_equal_a_plain_convolution():
    """Filters laid over every place of a window one by one, without tables of byte pairs."""
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 256, (40, language_id.WINDOW)).astype(np.uint8)
    model = language_id.ByteConvNet(["x", "y", "z"], seed=5).fit(windows, np.arange(40) % 3, epochs=3, least_steps=0, batch=8)
    expected = []
    for window in windows:
        seen = model.embed[window].astype(float)
        hidden = []
        for w, kernel, bias in zip(language_id.WIDTHS, model.filters, model.bias):
            for f in range(language_id.FILTERS):
                replies = [(seen[i:i + w] * kernel[:, :, f]).sum() for i in range(len(window) - w + 1)]
                hidden.append(max(0.0, max(replies) + bias[f]))
        scores = np.exp(np.array(hidden) @ model.out + model.out_bias)
        expected.append(scores / scores.sum())
    assert np.allclose(model.predict(windows, model.tables()), expected, atol=1e-4)


def test_every_row_is_used_in_every_epoch(monkeypatch):
    used = []
    gradient = language_id.ByteConvNet._gradient
    monkeypatch.setattr(language_id.ByteConvNet, "_gradient",
                        lambda self, rows, labels: used.extend(labels.tolist()) or gradient(self, rows, labels))
    windows = np.random.default_rng(0).integers(0, 256, (70, language_id.WINDOW)).astype(np.uint8)
    language_id.ByteConvNet([str(i) for i in range(70)]).fit(windows, np.arange(70), epochs=2, least_steps=0, batch=32)
    assert sorted(used) == sorted([*range(70)] * 2)


def base_spans(text):
    """The patterns of the base as they are written, one after the other."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits[::-1])))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans_equal_the_patterns():
    rng, anchors = random.Random(3), pii.automaton()
    pieces = ["a@b.c", "@", ".", "+", "1", "22", "255.0.0.1", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", " ", "-",
              "+49 (30) 123-4567", "x", "ü", "@d.e.f", "..", "0000001.2.3.4", "iban ", "http://h.i/j?k", "+1", "\n", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert [s for s in pii.find(text, anchors) if s[0] in pii.KINDS[:4]] == base_spans(text), text


def test_added_kinds_and_redaction():
    anchors = pii.automaton()
    text = "See https://a.example/x?y=1, IBAN: DE89 3704 0044 0532 0130 00 and account no. 12345678; iban XX00 1111 2222 3333"
    spans = pii.find(text, anchors)
    assert [(k, text[s:e]) for k, s, e in spans if k in ("url", "account")] == [
        ("url", "https://a.example/x?y=1"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "12345678")]
    text = 'call +1 (826) 555-4081 10.11.12.13 pay 4111 1111 1111 1111 2024 or 4111111111111111 77 token = "ab12cd34ef56" x'
    assert [(k, text[s:e]) for k, s, e in pii.find(text, anchors) if k not in pii.KINDS[:4]] == [
        ("tel", "+1 (826) 555-4081"), ("pan", "4111 1111 1111 1111"), ("pan", "4111111111111111"), ("secret", "ab12cd34ef56")]
    assert pii.redacted("mail a@b.co now", [("email", 5, 11)]) == "mail <EMAIL> now"
    assert pii.redacted("0123456789", [("card", 0, 5), ("phone", 3, 8)]) == "<CARD>89"


def test_pii_frames(spark):
    rows = [(1, None, None), (2, "", None), (None, "mail a@b.co", "x"), (3, "n" * 200_000 + " 10.0.0.1", None)]
    found = {r.doc_id: r for r in pii.digest(pii.find_spans(frame(spark, rows))).collect()}
    assert found[1]["n_email"] == 0 and found[1]["spans"] == "" and found[None]["spans"] == "email:5:11"
    assert found[3]["spans"] == "ip:200001:200009"
    clean = pii.find_spans(frame(spark, rows), redact=True)
    assert clean.schema == frame(spark, rows).schema
    assert {r.doc_id: r.text for r in clean.collect()} == {
        1: None, 2: "", None: "mail <EMAIL>", 3: "n" * 200_000 + " <IP>"}
    assert pii.find_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def all_segmentations(text, weights):
    if not text:
        return 1.0
    return sum(weights[text[:i]] * all_segmentations(text[i:], weights)
               for i in range(1, len(text) + 1) if text[:i] in weights)


def test_lattice_sums_all_segmentations():
    weights = lattice_lm.start_weights(lattice_lm.vocabulary(vocabularies.path("piece_bpe_32k.model")))
    assert math.isclose(sum(weights.values()), 1)
    lattice = lattice_lm.Lattice(weights)
    for word in ("the", "tion", "zu", "é", "世x", "\U0010fffd", "▁a"):
        text = lattice.spell(word.encode())
        assert math.isclose(lattice.log10(word.encode()), math.log10(all_segmentations(text, weights)), rel_tol=1e-9)
    long = lattice.log10(b"ab" * 5000)
    assert math.isfinite(long) and long < 5 * lattice.log10(b"ab" * 1000) / 1.2


def test_expected_counts_are_those_of_all_segmentations():
    weights = {"▁": 0.2, "▁a": 0.1, "a": 0.2, "b": 0.2, "ab": 0.3}
    from collections import Counter
    total = Counter()
    lattice_lm.Lattice(weights).expected(b"ab", 10, total)
    ways = {("▁", "a", "b"): 0.008, ("▁", "ab"): 0.06, ("▁a", "b"): 0.02}
    for piece in weights:
        expected = 10 * sum(w for way, w in ways.items() if piece in way) / sum(ways.values())
        assert math.isclose(total[piece], expected, abs_tol=1e-9)


def exact_counts(text, weights, times):
    """Sum over segmentations and expected uses of each piece, in fractions."""
    from fractions import Fraction
    longest = max(map(len, weights))
    exact = {p: Fraction(w) for p, w in weights.items()}
    n = len(text)
    edges = [(i, k) for i in range(n) for k in range(i + 1, min(n, i + longest) + 1) if text[i:k] in exact]
    ahead, behind = [Fraction(1)] + [Fraction(0)] * n, [Fraction(0)] * n + [Fraction(1)]
    for i, k in edges:
        ahead[k] += ahead[i] * exact[text[i:k]]
    for i, k in reversed(edges):
        behind[i] += behind[k] * exact[text[i:k]]
    uses = {}
    for i, k in edges:
        uses[text[i:k]] = uses.get(text[i:k], 0) + times * ahead[i] * exact[text[i:k]] * behind[k] / ahead[n]
    return ahead[n], {p: float(u) for p, u in uses.items()}


TINY = {"▁": 2.0**-30, "▁a": 2.0**-9, "a": 2.0**-40, "b": 2.0**-36, "ab": 2.0**-45, "aba": 2.0**-70, "bbbb": 2.0**-20}


@pytest.mark.parametrize("word", ["ab" * 30, "ab" * 30 + "a", "abb" * 60, "abbbbab" * 70, "b" * 500])
def test_expected_counts_of_long_words(word):
    from collections import Counter
    total, lattice = Counter(), lattice_lm.Lattice(TINY)
    lattice.expected(word.encode(), 3, total)
    _, uses = exact_counts("▁" + word, TINY, 3)
    assert set(total) == set(uses)
    for piece, n in uses.items():
        assert math.isclose(total[piece], n, rel_tol=1e-9, abs_tol=1e-30)


@pytest.mark.parametrize("word", ["ab" * 30, "abb" * 60, "b" * 60, "b" * 501, "ab" * 250])
def test_sums_of_rare_symbols(word):
    sums, _ = exact_counts("▁" + word, TINY, 1)
    log = math.log10(sums.numerator) - math.log10(sums.denominator)
    assert math.isclose(lattice_lm.Lattice(TINY).log10(word.encode()), log, rel_tol=1e-9)


@pytest.mark.parametrize("size", [60, 500, 5000])
def test_sums_of_pieces_of_the_least_weight(size):
    from collections import Counter
    scores = lattice_lm.vocabulary(vocabularies.path("piece_bpe_32k.model"))
    weights = dict.fromkeys(scores, 1e-12)
    lattice, total = lattice_lm.Lattice(weights), Counter()
    word = "\U00010380" * (size // 4)  # no piece: four bytes each
    assert math.isclose(lattice.log10(word.encode()), -12.0 * (size + 1), rel_tol=1e-9)
    lattice.expected(word.encode(), 1, total)
    assert math.isclose(sum(total.values()), size + 1, rel_tol=1e-9)


def test_expected_counts_do_not_change_with_length():
    from collections import Counter
    lattice = lattice_lm.Lattice(lattice_lm.start_weights(lattice_lm.vocabulary(vocabularies.path("piece_bpe_32k.model"))))
    for size in (61, 5000):  # symbols with the mark
        word, total = ("information" * 500)[:size - 1], Counter()
        lattice.expected(word.encode(), 2, total)
        assert math.isclose(sum(len(p) * n for p, n in total.items()), 2 * size, rel_tol=1e-9)
        assert total["inform"] + total["information"] + total["ation"] > total["m"]


def test_scores_equal_brute_force(spark):
    rows = [(i, f"The word{i % 7} and THE other {i} word{i % 3} a b", None) for i in range(60)] + [
        (60, None, None), (61, "", None), (62, " \n", None), (None, "the", None), (None, "the", None), (7, "new and rare", None)]
    given = frame(spark, rows)
    tokens = [((t or "").encode().lower().split(), zlib.crc32(str(d if d is not None else "").encode()) % 10 != 0)
              for d, t, _ in rows]
    counts, n = {}, 0
    for words, train in tokens:
        for w in [*words, None] if train else []:
            counts[w] = counts.get(w, 0) + 1
            n += 1
    v = len(counts)
    expected = sorted((str(d), len(words) + 1, sum(w in counts for w in [*words, None]), n, round(sum(
        math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in [*words, None]), 6))
        for (d, _, _), (words, _) in zip(rows, tokens))
    vocabulary = vocabularies.path("piece_bpe_32k.model")
    scores = []
    for frequent in (150_000, 5):  # all words looked up, or most of them joined
        found = lattice_lm.score_documents(given, vocabulary, fold("doc_id", 10) != 0, frequent=frequent).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
        scores.append(sorted((str(r.doc_id), round(r.score, 6)) for r in found))
    assert scores[0] == scores[1] and all(s < 0 for _, s in scores[0])


def test_scores_without_training_rows(spark):
    found = lattice_lm.score_documents(frame(spark, [(1, "a b", None)]), vocabularies.path("piece_bpe_32k.model"), F.lit(False))
    row = found.first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.base_score) and row.score < 0
    none = spark.createDataFrame([], SCHEMA)
    assert lattice_lm.score_documents(none, vocabularies.path("piece_bpe_32k.model"), F.lit(True)).count() == 0
