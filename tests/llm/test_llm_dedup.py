import random
from collections import defaultdict

import numpy as np
import pytest

from storepulse.llm import exact_dedup, jaccard_join, shingles
from storepulse.llm.components import components

SCHEMA = "doc_id long, text string, lang string, group_size int, set_key string, _row string"
WHITE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "s", "r") for i, t in rows], SCHEMA).repartition(4)


EXACT = [(5, "a b"), (3, "ab"), (9, "a  b"), (1, None), (2, ""), (4, " \n"), (7, "x" * 300 + "1"), (8, "x" * 300 + "2"),
         (10, "é "), (11, "é  "), (12, "alone"), (None, "ab "), (None, "no id"), (13, "twin"), (13, "twin"),
         (14, "y" * 100_000), (6, " " + "y" * 100_000)]


def test_exact_groups_equal_brute_force(spark):
    squeeze = lambda t: "".join(c for c in t or "" if c not in WHITE)
    groups = defaultdict(list)
    for i, t in EXACT:
        groups[squeeze(t)].append((-len(t or ""), i is None, i or 0))
    expected = []
    for members in groups.values():
        first, taken = min(members), False
        for m in sorted(members):
            kept = m == first and not taken
            taken |= kept
            expected.append((None if m[1] else m[2], None if first[1] else first[2], len(members), kept))
    for all_hashed in (True, False):
        found = exact_dedup.exact_duplicates(frame(spark, EXACT), digest_all=all_hashed).collect()
        key = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r)[:4] for r in found), key=key) == sorted(expected, key=key)
    hashed = exact_dedup.exact_duplicates(frame(spark, EXACT)).filter("text_sha256 IS NOT NULL")
    assert hashed.count() <= len(EXACT) - 2  # rows alone in length and prefix are never hashed


def test_exact_drop_keeps_rows_whole(spark):
    rows = frame(spark, EXACT)
    left = exact_dedup.drop_exact_duplicates(rows)
    assert left.schema == rows.schema
    assert sorted(((r.doc_id, len(r.text or "")) for r in left.collect()), key=str) == sorted(
        [(9, 4), (4, 2), (7, 301), (8, 301), (11, 3), (12, 5), (None, 5), (13, 4), (6, 100_001)], key=str)


def test_a_hot_group_stays_small(spark):
    rows = [(i, "same text") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 3100)]
    found = exact_dedup.exact_duplicates(frame(spark, rows))
    assert found.count() == 3100 and found.filter("kept").count() == 101
    assert exact_dedup.drop_exact_duplicates(frame(spark, rows)).count() == 101


def brute_sets(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, width, percent):
    sets = [brute_sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def near_copies(seed, families=6, copies=25):
    """Families whose members differ in few words, so that many pairs lie near the bound."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(30)]
    texts = []
    for f in range(families):
        base = [word() for _ in range(rng.choice((2, 9, 12, 30, 120, 400)))]
        if f % 2:
            base = base + passage
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, len(base) // 40, len(base) // 20))):
                own[rng.randrange(len(own))] = word()
            texts.append(rng.choice((" ", "\n", "  ")).join(own).title())
    return texts


@pytest.mark.parametrize("width,percent,seed,block", [(3, 90, 1, 512), (5, 80, 2, 512), (3, 90, 3, 6), (2, 60, 4, 5)])
def test_jaccard_equals_brute_force(spark, width, percent, seed, block):
    texts = near_copies(seed) + [None, "", " \t", "One", "one", "a b", "A B", "a b c", "a b c"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (500, texts[7])]
    found = jaccard_join.jaccard_components(frame(spark, rows), width, percent, block_sets=block)
    assert sorted(map(tuple, found.collect())) == brute_components(rows, width, percent)


def test_near_drop_keeps_one_of_each_component(spark):
    texts = near_copies(5)
    rows = [*enumerate(texts), (0, texts[0]), (900, None), (901, ""), (None, "no id here at all")]
    given = frame(spark, rows)
    left = jaccard_join.drop_near_duplicates(given, 5, 80)
    assert left.schema == given.schema
    parts = brute_components([r for r in rows if r[0] is not None], 5, 80)
    expected = sorted({c for _, n, c in parts if n} | {900, 901}) + [None]
    assert sorted((r.doc_id for r in left.collect()), key=lambda d: (d is None, d or 0)) == expected


def test_jaccard_of_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.jaccard_components(none).count() == 0
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert jaccard_join.drop_near_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0


def test_shingles_of_long_words():
    texts = [b"x" * 2_500_000 + b" y z", b"X" * 2_500_000 + b" Y Z", b"x" * 2_499_999 + b" y z"]
    a, b, c = shingles.shingle_sets(texts, 3)
    assert a.tolist() == b.tolist() != c.tolist()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201), (5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize("probe, slab", [(0, 8), (10**9, 8), (16, 1 << 18)])
@pytest.mark.parametrize("both", [True, False])
def test_block_search_by_lists_and_by_probes(monkeypatch, probe, slab, both):
    """Sets that are near and partly linked, against all pairs."""
    monkeypatch.setattr(jaccard_join, "_PROBE", probe)
    monkeypatch.setattr(jaccard_join, "_SLAB", slab)
    draw = np.random.default_rng(5)
    sets = [np.sort(draw.choice(260, int(n), replace=False)).astype(np.uint64) for n in draw.integers(1, 260, 40)]
    sets += [np.sort(draw.choice(s, max(1, int(len(s) * k)), replace=False)) for s in sets for k in (0.8, 0.9)]
    groups = draw.integers(0, 2, len(sets))

    def joined(pairs):
        root = list(range(len(sets)))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    def near(i, j):
        same = len(np.intersect1d(sets[i], sets[j]))
        return 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same)

    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if (both or groups[i] != groups[j]) and near(i, j)]
    found = jaccard_join.divide_skip(sets, groups, 80, both)
    assert set(map(tuple, map(sorted, found))) <= set(map(tuple, map(sorted, pairs))) and joined(found) == joined(pairs)


def test_a_worker_keeps_the_words_of_one_step():
    import public_tokenizers as vocabularies

    from storepulse.llm import token_ids, worker
    path = vocabularies.path("byte_bpe_50k.json")
    first = token_ids.encoder(path)
    assert token_ids.encoder(path) is first
    other = token_ids.encoder(path, memory=1000)
    assert list(worker._KEPT.values()) == [other]
    assert not list(jaccard_join._search(80)(iter([]))) and not worker._KEPT
