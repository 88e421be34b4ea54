"""Document likelihood over all segmentations: a unigram model on an existing subword vocabulary.

A text is its words (A-Z lower-cased, cut at white space), each written as a mark and its
characters. A word is any sequence of pieces that spells it: pieces of the vocabulary, or
single bytes of characters that no piece has. All pieces and the end of the text share one
distribution, so the probability of a text, summed over every segmentation, is the product
of its words' sums and that of the end. Piece probabilities start from the order of the
vocabulary's scores and are fitted to the corpus by expectation-maximisation over distinct words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse.llm.scratch import stage

MARK = "▁"
END = ""
BYTE = 0xF0000


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model without controls, and their scores. The piece of a
    byte is one character of a private area, from BYTE on."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            found[chr(BYTE + int(piece[3:5], 16))] = model.get_score(i)
        elif not (model.is_control(i) or model.is_unknown(i) or MARK in piece[1:]):
            found.setdefault(piece, model.get_score(i))
    return found


def start_weights(scores: dict[str, float]) -> dict[str, float]:
    """Probabilities from the order of the scores: the r-th best piece weighs 1 / (r + 1).
    Single bytes, whose scores say nothing, come last. The end of the text counts as a
    piece of middling weight."""
    ranked = sorted(scores, key=lambda p: (ord(p[0]) >= BYTE, -scores[p], p))
    weights = {p: 1 / (r + 2) for r, p in enumerate(ranked)}
    weights[END] = 1 / 1000
    total = sum(weights.values())
    return {p: w / total for p, w in weights.items()}


def _letters(pieces: Iterable[str]) -> set[str]:
    return {p for p in pieces if len(p) == 1 and p != MARK and ord(p) < BYTE}


def _spell(word: bytes, letters: set[str]) -> str:
    """Mark and characters; characters that are no piece by themselves become bytes."""
    text = word.decode("utf-8", "replace")
    if not letters.issuperset(text):
        text = "".join(c if c in letters else "".join(chr(BYTE + b) for b in c.encode()) for c in text)
    return MARK + text


class Lattice:
    """Sums over the segmentations of one word, in plain numbers that are rescaled on the way.

    For words of any length; `Lattices` takes many short ones at once."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.letters = _letters(weights)
        self.longest = max((len(p) for p in weights), default=1)
        # Weight of every piece, 0 for what only begins a piece: where a look-up fails, no longer piece fits.
        self.begins = dict.fromkeys((p[:i] for p in weights for i in range(1, len(p))), 0.0) | {
            p: w for p, w in weights.items() if p}

    def spell(self, word: bytes) -> str:
        return _spell(word, self.letters)

    def log10(self, word: bytes) -> float:
        """log10 of the sum over all segmentations of a word.

        Sums over long words would underflow, so they are rescaled on the way."""
        text, get = self.spell(word), self.begins.get
        n = len(text)
        sums, logs = [1.0] + [0.0] * n, 0.0
        for i in range(n):
            here = sums[i]
            if here < 1e-100:
                if not here:
                    continue
                logs -= math.log(self._lift(sums, i))
                here = sums[i]
            for k in range(i + 1, n + 1):
                w = get(text[i:k])
                if w is None:
                    break
                if w:
                    sums[k] += here * w
        return (math.log(sums[n]) + logs) / math.log(10)

    def _lift(self, sums: list[float], i: int) -> float:
        """Scale up the sums from `i` on, of which that at `i` has become small; the factor.

        Sums are never scaled down, and each is used while it is 1e-100 or more: none is lost."""
        begun = sums[i:i + self.longest]
        up = min(1 / begun[0], 1e280 / max(begun))
        sums[i:i + self.longest] = [x * up for x in begun]
        return up

    def expected(self, word: bytes, times: int, into: Counter) -> None:
        """Add the expected number of uses of each piece in `times` copies of the word.

        Forward sums are rescaled on the way, whatever the length of the word. `share` is the
        number of uses that pass a place, over the place's forward sum, and scaled like it."""
        text, get, longest = self.spell(word), self.begins.get, self.longest
        n = len(text)
        ahead, lifts = [1.0] + [0.0] * n, []
        for i in range(n):
            here = ahead[i]
            if here < 1e-100:
                if not here:
                    continue
                lifts.append((i, self._lift(ahead, i)))
                here = ahead[i]
            for k in range(i + 1, n + 1):
                w = get(text[i:k])
                if w is None:
                    break
                if w:
                    ahead[k] += here * w
        share = [0.0] * n + [times / ahead[n]]
        for i in range(n - 1, -1, -1):
            here = ahead[i]
            if here:
                passing = 0.0
                for k in range(i + 1, n + 1):
                    piece = text[i:k]
                    w = get(piece)
                    if w is None:
                        break
                    if w:
                        w *= share[k]
                        passing += w
                        into[piece] += w * here
                share[i] = passing
            if lifts and lifts[-1][0] == i:
                up = lifts.pop()[1]
                share[i:i + longest] = [x * up for x in share[i:i + longest]]


class Trie:
    """The pieces as a table from (node, character) to node; 0 is the root, and no node's child."""

    def __init__(self, pieces: Iterable[str]):
        self.pieces = sorted(p for p in pieces if p)
        self.letters = _letters(self.pieces)
        self.longest = max(map(len, self.pieces), default=0)
        nodes, edges, ends = {"": 0}, [], []
        for piece in self.pieces:
            for i, c in enumerate(piece):
                if piece[:i + 1] not in nodes:
                    edges.append(nodes[piece[:i]] << 21 | ord(c))
                    nodes[piece[:i + 1]] = len(nodes)
            ends.append(nodes[piece])
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[ends] = np.arange(len(ends))
        bits = max(4, (4 * len(edges)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self._edges, self._nodes = np.full(1 << bits, _FREE), np.zeros(1 << bits, np.uint32)
        keys = np.array(edges, np.uint64)
        for at, (key, slot) in enumerate(zip(keys, self._slots(keys).tolist())):
            while self._edges[slot] != _FREE:
                slot = (slot + 1) & int(self._mask)
            self._edges[slot], self._nodes[slot] = key, at + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD) >> self._shift

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of `nodes` by the characters `codes`, 0 where there is none."""
        keys = nodes.astype(np.uint64) << np.uint64(21) | codes
        slots = self._slots(keys)
        met = self._edges[slots]
        same = met == keys
        found = np.where(same, self._nodes[slots], np.uint32(0))
        left = np.flatnonzero(~same & (met != _FREE))
        while left.size:
            slots[left] = (slots[left] + np.uint64(1)) & self._mask
            met = self._edges[slots[left]]
            same = met == keys[left]
            found[left[same]] = self._nodes[slots[left[same]]]
            left = left[~same & (met != _FREE)]
        return found


_FREE = np.uint64(2**64 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Stands between words; no word is spelled with it.
_BETWEEN = chr(BYTE + 256)


class Lattices:
    """Sums over segmentations in log space, for many words at a time.

    The words of a block lie one behind the other, each with a place before every character
    and one after the last. A piece that fits is an arc between two places of a word. Arcs
    that begin at the i-th place of their words end at different places, so one step
    of the recursion is one array operation over all words. A block has `block` characters or
    fewer. Words of more than `longest` characters would make many short steps; they are
    summed one by one, with the same result.
    """

    def __init__(self, weights: dict[str, float], trie: Trie, block: int = 100_000, longest: int = 200):
        self.trie, self.block, self.longest = trie, block, longest
        self.log_weights = np.log([weights[p] for p in trie.pieces])
        self._weights, self._single = weights, None

    def _one(self) -> Lattice:
        if self._single is None:
            self._single = Lattice(self._weights)
        return self._single

    def _blocks(self, words: list[bytes]):
        """Places of words in the list, and how they are spelled; a long word stands alone."""
        held, spelled, size = [], [], 0
        for at, word in enumerate(words):
            text = _spell(word, self.trie.letters)
            if len(text) > self.longest:
                yield [at], None
                continue
            if size + len(text) > self.block and held:
                yield held, spelled
                held, spelled, size = [], [], 0
            held.append(at)
            spelled.append(text)
            size += len(text)
        if held:
            yield held, spelled

    def _arcs(self, spelled: list[str]):
        """First and last place of each word; of each arc its two places and piece; number of each place in its word."""
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1
        first = np.cumsum(sizes) - sizes
        codes = np.frombuffer((_BETWEEN.join(spelled) + _BETWEEN).encode("utf-32-le"), "<u4").astype(np.uint64)
        number = (np.arange(len(codes)) - np.repeat(first, sizes)).astype(np.uint16)
        start, node, found = np.arange(len(codes)), np.zeros(len(codes), np.uint32), []
        for depth in range(1, self.trie.longest + 1):
            if depth > 1:  # The separator ends every walk, so this stays within the block.
                codes_here = codes[start + (depth - 1)]
            else:
                codes_here = codes
            node = self.trie.step(node, codes_here)
            on = np.flatnonzero(node)
            start, node = start[on], node[on]
            piece = self.trie.piece[node]
            whole = np.flatnonzero(piece >= 0)
            found.append((start[whole], start[whole] + depth, piece[whole]))
        return first, first + sizes - 1, *(np.concatenate(a) for a in zip(*found)), number

    def _sums(self, at: np.ndarray, other: np.ndarray, weight: np.ndarray, step: np.ndarray, sums: np.ndarray):
        """Add the sums at one end of the arcs to those at the other, arcs in order of `step`."""
        bounds = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), len(step)]):
            to = other[a:b]
            sums[to] = np.logaddexp(sums[to], sums[at[a:b]] + weight[a:b])

    def _ahead(self, spelled: list[str]):
        first, last, start, end, piece, number = self._arcs(spelled)
        order = np.argsort(number[start], kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        ahead = np.full(len(number), -np.inf)
        ahead[first] = 0.0
        weight = self.log_weights[piece]
        self._sums(start, end, weight, number[start], ahead)
        return first, last, start, end, piece, weight, number, ahead

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 of the sum over all segmentations of each word."""
        out = np.zeros(len(words))
        for held, spelled in self._blocks(words):
            if spelled is None:
                out[held] = self._one().log10(words[held[0]])
            else:
                _, last, *_, ahead = self._ahead(spelled)
                out[held] = ahead[last] / math.log(10)
        return out

    def expected(self, words: list[bytes], times: list[int]) -> np.ndarray:
        """Expected number of uses of each of the trie's pieces in so many copies of the words."""
        uses, single, times = np.zeros(len(self.trie.pieces)), Counter(), np.asarray(times, float)
        for held, spelled in self._blocks(words):
            if spelled is None:
                self._one().expected(words[held[0]], times[held[0]], single)
                continue
            first, last, start, end, piece, weight, number, ahead = self._ahead(spelled)
            behind = np.full(len(number), -np.inf)
            behind[last] = 0.0
            # Arcs that end at the same place of a word begin at different ones.
            order = np.argsort(~number[end], kind="stable")
            self._sums(end[order], start[order], weight[order], ~number[end][order], behind)
            # log of the word's copies over its sum, at each of its places
            scale = np.repeat(np.log(times[held]) - ahead[last], last - first + 1)
            uses += np.bincount(piece, np.exp(ahead[start] + weight + behind[end] + scale[start]), len(uses))
        for at, name in enumerate(self.trie.pieces) if single else ():
            uses[at] += single[name]
        return uses


def _words(batches: Iterator[pa.RecordBatch], column: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            raw = part.column(column).cast(pa.large_binary()).to_pylist()
            yield part, [(t or b"").lower().split() for t in raw]


def word_counts(docs: DataFrame, text_col: str = "text", train_col: str = "train") -> DataFrame:
    """`word` (binary), `c` (in training rows): every distinct word of all rows.

    Tasks add up words before the shuffle, and hand them on when they hold many."""
    def run(batches):
        counts: Counter = Counter()

        def out():
            rows = pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.binary()),
                                               "c": pa.array(counts.values(), pa.int64())})
            counts.clear()
            return rows

        for part, texts in _words(batches, 0):
            for words, train in zip(texts, part.column(1).to_pylist()):
                if train:
                    counts.update(words)
                else:
                    for w in words:
                        counts.setdefault(w, 0)
            if len(counts) > 400_000:
                yield out()
        yield out()

    return (docs.select(F.col(text_col), F.col(train_col)).mapInArrow(run, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def fit(counts: DataFrame, end_count: int, vocabulary_path: str, rounds: int = 2) -> dict[str, float]:
    """Piece probabilities after `rounds` of expectation-maximisation over the word counts.

    Only the expected counts of the pieces, as many as the vocabulary has, reach the
    driver. Every piece keeps a little weight, so any text has a probability."""
    weights = start_weights(vocabulary(vocabulary_path))
    trie = Trie(weights)
    for _ in range(rounds):
        now = weights

        def expect(batches):
            lattices, total = Lattices(now, trie), np.zeros(len(trie.pieces))
            for batch in batches:
                total += lattices.expected(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": pa.array([trie.pieces[i] for i in used], pa.string()),
                                              "n": pa.array(total[used], pa.float64())})

        seen = (counts.filter("c > 0").select("word", "c").mapInArrow(expect, "piece string, n double")
                .groupBy("piece").agg(F.sum("n").alias("n")).orderBy("piece").collect())
        raw = {p: 0.1 for p in weights}
        raw[END] += end_count
        for row in seen:
            raw[row["piece"]] += row["n"]
        total = sum(raw.values())
        weights = {p: n / total for p, n in raw.items()}
    return weights


def score_documents(docs: DataFrame, vocabulary_path: str, train: Column, id_col: str = "doc_id",
                    text_col: str = "text", frequent: int = 150_000) -> DataFrame:
    """`doc_id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of every row.

    `train` says which rows are learned from. Tokens are words and one end per text; null
    texts are empty. `base_score` adds log10((c + 0.1) / (N + 0.1 (V + 1))) over the
    tokens; `score` is the log10 probability under the lattice model. Without training
    rows all counts are 0 and the vocabulary's own weights score. Rows that repeat are
    scored each; null ids stay; other columns are not read.

    The `frequent` most common words are looked up in the tasks; their number is fixed,
    so they may be sent to all. The others are joined by a shuffle, in rows that are
    already added up per document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    counts = stage(word_counts(rows), "lm-words")
    ends = rows.filter("train").count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = total["n"] + ends, total["v"] + (ends > 0)
    weights = fit(counts, ends, vocabulary_path, rounds=2 if ends else 0)
    end_base, end_score = math.log10(ends + 0.1), math.log10(weights[END])
    norm = math.log10(n + 0.1 * (v + 1))
    trie = Trie(weights)

    def marginals(batches):
        lattices = Lattices(weights, trie)
        for batch in batches:
            m = pa.array(lattices.log10(batch.column(0).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), m], names=["word", "c", "m"])

    table = stage(counts.select("word", "c").mapInArrow(marginals, "word binary, c long, m double"), "lm-table")
    common = {bytes(r["word"]): (math.log10(r["c"] + 0.1), r["m"], int(r["c"] > 0))
              for r in _most_common(table, frequent).toLocalIterator()}
    known = docs.sparkSession.sparkContext.broadcast(common)

    def look_up(batches):
        get = known.value.get
        for part, texts in _words(batches, 1):
            ids = part.column(0).to_pylist()
            out = {k: [] for k in ("doc_id", "tie", "word", "times", "n_tokens", "n_known", "base", "m")}
            ties = part.column(2).to_pylist()
            for i, words in enumerate(texts):
                base = m = 0.0
                n_known, rest = 0, []
                for w in words:
                    f = get(w)
                    if f:
                        base += f[0]
                        m += f[1]
                        n_known += f[2]
                    else:
                        rest.append(w)
                rare = Counter(rest)
                size = 1 + len(rare)
                out["doc_id"] += [ids[i]] * size
                out["tie"] += [ties[i]] * size
                out["word"] += [None, *rare]
                out["times"] += [1, *rare.values()]
                out["n_tokens"] += [len(words) + 1] + [0] * len(rare)
                out["n_known"] += [n_known + (ends > 0)] + [0] * len(rare)
                out["base"] += [base + end_base] + [0.0] * len(rare)
                out["m"] += [m + end_score] + [0.0] * len(rare)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(out["doc_id"], pa.int64()), "tie": pa.array(out["tie"], pa.int64()),
                "word": pa.array(out["word"], pa.binary()), "times": pa.array(out["times"], pa.int32()),
                "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                "base": pa.array(out["base"], pa.float64()), "m": pa.array(out["m"], pa.float64())})

    # A row is named by its id and text, so that rows sharing an id are scored each.
    told = rows.select("doc_id", "text", F.xxhash64("text", "train").alias("tie"), "train").select(
        "doc_id", "text", "tie").mapInArrow(
        look_up, "doc_id long, tie long, word binary, times int, n_tokens long, n_known long, base double, m double")
    return _add_up(told, table, n, norm)


def _most_common(table: DataFrame, most: int) -> DataFrame:
    """The words whose count is at least some power of two to the eighth part, chosen so that
    there are `most` of them or fewer."""
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = table.filter("c > 0").groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect()
    least, held = 2**31 - 1, 0
    for row in sizes:
        held += row["count"]
        if held > most:
            break
        least = row["s"]
    return table.filter("c > 0").filter(step >= least)


def _add_up(told: DataFrame, table: DataFrame, n: int, norm: float) -> DataFrame:
    told = stage(told, "lm-parts")
    heads = told.filter("word IS NULL").drop("word", "times")
    rare = told.filter("word IS NOT NULL").select("doc_id", "tie", "word", "times").join(table, "word").select(
        "doc_id", "tie", F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("times")).otherwise(0).cast("long").alias("n_known"),
        (F.col("times") * F.log10(F.col("c") + 0.1)).alias("base"), (F.col("times") * F.col("m")).alias("m"))
    parts = heads.withColumn("rows", F.lit(1)).unionByName(rare.withColumn("rows", F.lit(0)))
    sums = parts.groupBy("doc_id", "tie").agg(
        F.sum("rows").cast("int").alias("rows"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "m")))
    each = sums.select("doc_id", *((F.col(c) / F.col("rows")).alias(c) for c in ("n_tokens", "n_known", "base", "m")),
                       F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_i"))
    tokens = F.round("n_tokens").cast("long")
    return each.select("doc_id", tokens.alias("n_tokens"), F.round("n_known").cast("long").alias("n_known"),
                       F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("base") - tokens * F.lit(norm)).alias("base_score"), F.col("m").alias("score"))
