"""Jaccard join on word shingles: T-occurrence search over inverted lists, with DivideSkip.

Two sets x, y (x the smaller) with |x & y| >= t |x | y| differ in at most
H = floor((1 - t) / t * |x|) elements. Hash space is cut into k = H + 1 + s segments, so
at least s + 1 segments hold the same elements in both. The contents of the segments are
the elements of a first, coarse T-occurrence search, done by shuffles: a set passes only
with its k - s rarest segments (its longest lists are skipped), and sets that meet in one
of them form a cluster of candidates. Inside a cluster the second search runs on the
shingles themselves: short lists are merged by counting, long ones probed by bisection for the
sets that can still be similar, or merged as well while there are many of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.components import components
from storepulse.llm.scratch import bit_filter, might_be_in, stage
from storepulse.llm.shingles import mix, shingle_sets
from storepulse.llm.worker import release

#: Places of lists that are counted at once.
_SLAB = 1 << 18
#: Looking up one set in a list takes as long as counting so many.
_PROBE = 16


def set_key(tokens: np.ndarray) -> int:
    """One signed 64-bit name per set."""
    total = mix(tokens).sum(dtype=np.uint64) if len(tokens) else np.uint64(0)
    return int(mix(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


class Bands:
    """Size bands such that similar sets lie in one band or in neighbours (percent / 100 = t)."""

    def __init__(self, percent: int):
        self.percent, self.low = percent, [1]

    def of(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def allowance(self, band: int) -> tuple[int, int]:
        """(H of the largest set of the band, number of segments k)."""
        self.of(self.low[-1]) if len(self.low) <= band + 1 else None
        differ = (self.low[band + 1] - 1) * (100 - self.percent) // self.percent
        return differ, differ + 1 + 1 + differ // 4


def segment_keys(tokens: np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, int]]:
    """For the set's own band and the one below: keys of its segments, and `spare`.

    Of its c shared keys a set has to offer the rarest c + spare: H + 1 keys are enough to
    meet any partner, and those that no other set has come first. A segment without
    elements gives no key, unless more than s of them are empty; then the empty ones give
    keys as well, and the set offers all.
    """
    own = bands.of(len(tokens))
    mixed = mix(tokens)
    for band in (own, own - 1):
        if band < 0:
            continue
        differ, k = bands.allowance(band)
        if differ < 1:
            continue  # only equal sets are similar
        segment = ((tokens >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        inside = segment[first]
        keys = np.add.reduceat(mixed, first) + inside
        empty = k - len(first)
        if empty > k - differ - 1:
            missing = np.setdiff1d(np.arange(k, dtype=np.uint64), inside)
            keys, spare = np.concatenate([keys, missing]), 0
        else:
            spare = differ + 1 - (k - empty)
        salt = np.uint64((band + 1) * 0xC2B2AE3D27D4EB4F % 2**64)
        yield mix(keys ^ salt), spare


def _merge(docs: np.ndarray, since: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """How often each of the sets 0..n-1 lies in the lists docs[since:to]; a slab of them at a time."""
    counts = np.zeros(n, np.int64)
    held = np.cumsum(to - since)
    at = 0
    while at < len(since):
        before = int(held[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(held, before + _SLAB, side="right")))
        sizes = to[at:end] - since[at:end]
        rows = np.arange(int(sizes.sum())) + np.repeat(since[at:end] - (held[at:end] - sizes - before), sizes)
        counts += np.bincount(docs[rows], minlength=n)
        at = end
    return counts


def divide_skip(sets: list[np.ndarray], groups: np.ndarray, percent: int, both: bool) -> list[tuple[int, int]]:
    """Links that join the sets of a block as all similar pairs do (a spanning forest).

    `groups` is 0 or 1 per set; unless `both`, only pairs across the groups are looked for.
    Sets are taken by size; each queries the lists of those before it.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    groups = np.asarray(groups)[order]
    flat = np.concatenate([sets[i] for i in order]) if order else np.zeros(0, np.uint64)
    tokens, token = np.unique(flat, return_inverse=True)
    del flat
    by_token = np.argsort(token, kind="stable")  # the sets of a list ascend
    docs = np.repeat(np.arange(len(order), dtype=np.int32), sizes)[by_token]
    postings = token[by_token] * len(order) + docs  # every list as one range, sorted
    place = np.empty(len(by_token), np.int64)  # of a set in the list of each of its tokens
    place[by_token] = np.arange(len(by_token))
    del by_token
    begin = np.searchsorted(postings, np.arange(len(tokens) + 1) * len(order))
    length = np.diff(begin)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    component = np.arange(len(order))

    links = []
    for x in range(len(order)):
        n = int(sizes[x])
        needed = -(-percent * n // 100)  # any partner up to this size shares so many
        own, mine = token[begins[x]:begins[x + 1]], place[begins[x]:begins[x + 1]]
        rare = np.argsort(length[own], kind="stable")
        own, mine = own[rare], mine[rare]
        low = int(np.searchsorted(sizes[:x], needed))
        if low == x:
            continue
        since = np.searchsorted(postings, own * len(order) + low)  # of each list, what lies in low..x-1
        n_short = n - needed + 1
        counts = _merge(docs, since[:n_short], mine[:n_short], x)
        live = np.flatnonzero(counts if both else np.where(groups[:x] == groups[x], 0, counts))
        least = -(-percent * (n + sizes[:x]) // (100 + percent))
        at = n_short
        while len(live := live[counts[live] + (n - at) >= least[live]]):
            for y in live[counts[live] >= least[live]]:
                if component[x] != component[y]:
                    component[component == component[x]] = component[y]
                    links.append((order[x], order[y]))
            live = live[component[live] != component[x]]
            if at >= n or not len(live):
                break
            to = min(n, at + 64)
            if int((mine[at:to] - since[at:to]).sum()) > _PROBE * len(live) * (to - at):
                for y in np.array_split(live, len(live) * 64 // _SLAB + 1):
                    probe = own[at:to, None] * len(order) + y
                    found = np.searchsorted(postings, probe)
                    found[found == len(postings)] = 0
                    counts[y] += (postings[found] == probe).sum(axis=0)
            else:
                counts += _merge(docs, since[at:to], mine[at:to], x)
            at = to
    return links


def _read_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _texts(batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[tuple[list, list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            raw = part.column(1).cast(pa.large_binary()).to_pylist()
            yield part.column(0).to_pylist(), [t or b"" for t in raw]


def set_table(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `set_key` of every row."""
    def run(batches):
        release()
        for ids, texts in _texts(batches):
            sets = list(shingle_sets(texts, width))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_key": pa.array([set_key(s) for s in sets], pa.int64())})

    return _read_sets(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, set_key long")


def _keys(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(key, set_key) of every segment, `spare` with it."""
    def run(batches):
        release()
        bands = Bands(percent)
        for _, texts in _texts(batches):
            keys, names, spares = [], [], []
            for tokens in shingle_sets(texts, width):
                if len(tokens):
                    for own, spare in segment_keys(tokens, bands):
                        keys.append(own)
                        names.append((set_key(tokens), len(own)))
                        spares.append(spare)
            sizes = [n for _, n in names]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(np.concatenate(keys).view(np.int64) if keys else [], pa.int64()),
                "set_key": pa.array(np.repeat(np.array([k for k, _ in names], np.int64), sizes), pa.int64()),
                "spare": pa.array(np.repeat(np.array(spares, np.int32), sizes), pa.int32())})

    return _read_sets(docs, id_col, text_col).mapInArrow(run, "key long, set_key long, spare int")


def _sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        release()
        for _, texts in _texts(batches):
            sets = [s for s in shingle_sets(texts, width) if len(s)]
            yield pa.RecordBatch.from_pydict({
                "set_key": pa.array([set_key(s) for s in sets], pa.int64()),
                "tokens": pa.array([s.tobytes() for s in sets], pa.binary())})

    return _read_sets(docs, id_col, text_col).mapInArrow(run, "set_key long, tokens binary")


def candidate_clusters(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """`node` (a set), `root` (its cluster): sets that could be similar share a cluster."""
    keys = _keys(docs, width, percent, id_col, text_col)
    # Keys are salted by nothing but their own value: a set spreads its k keys over all tasks,
    # so even a group with a third of all sets puts a small share of the rows on one key.
    several = keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1").drop("n")
    shared = stage(several.groupBy("key", "set_key", "spare").agg(F.lit(1).alias("one")).drop("one"), "jaccard-keys")
    rare = shared.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = (shared.join(rare, "key").groupBy("set_key", "spare")
              .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("own")))
    allowed = F.col("spare") + F.size("own")
    usable = ranked.filter(allowed > 0).select(
        "set_key", F.explode(F.slice("own", F.lit(1), allowed)).alias("e")).select("set_key", "e.key")
    usable = stage(usable, "jaccard-usable")
    pivot = usable.groupBy("key").agg(F.min("set_key").alias("pivot"), F.max("set_key").alias("other")) \
        .filter("pivot < other").drop("other")
    edges = usable.join(pivot, "key").filter("set_key <> pivot").groupBy("set_key", "pivot").agg(F.lit(1).alias("one"))
    return components(edges, "set_key", "pivot")


def _blocks(members: DataFrame, block_sets: int) -> DataFrame:
    """`set_key`, `root`, `i`, `j`, `side`: the pairs of blocks of its cluster a set takes part in.

    A cluster of up to `block_sets` sets is one block. A larger one is dealt by hash over
    blocks, and each pair of blocks is searched by itself: tasks stay bounded, and no pair
    of sets is ever written, only links found."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("b"))
    own = members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("b")).cast("int"))
    pairs = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("b") - 1)))
    return pairs.select(F.col("node").alias("set_key"), "root", F.least("own", "o").alias("i"),
                        F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).cast("int").alias("side"))


def _search(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        release()

        def links():
            if len(rows) < 2:
                return None
            names = [r[0] for r in rows]
            sets = [np.frombuffer(r[2], np.uint64) for r in rows]
            sides = np.array([r[1] for r in rows])
            found = divide_skip(sets, sides, percent, both=block[1] == block[2])
            return pa.RecordBatch.from_pydict({"a": pa.array([names[i] for i, _ in found], pa.int64()),
                                               "b": pa.array([names[j] for _, j in found], pa.int64())})

        for batch in batches:
            root, i, j, name, side, tokens = (c.to_pylist() for c in batch.columns)
            for k in zip(root, i, j, name, side, tokens):
                if k[:3] != block:
                    if (out := links()) is not None:
                        yield out
                    block, rows = k[:3], []
                rows.append(k[3:])
        if (out := links()) is not None:
            yield out

    return run


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id",
                       text_col: str = "text", block_sets: int = 512) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`: documents joined by links, directly or through others.

    Texts are lower-cased (A-Z) and cut at white space; a set is that of `width` words in a
    row, of fewer words the whole sequence. Two rows link when 100 * |x & y| >= percent *
    |x | y|. Null, empty and blank texts have no set and no link: each is its own
    component. The component is named by its smallest doc_id (a null id names it only if
    there is no other). Rows that repeat stay. Other columns are not read.
    """
    table, names = _labelled(docs, width, percent, id_col, text_col, block_sets)
    named = table.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least")).join(names, "set_key")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.select("set_key", "root").join(lowest, "root").select("set_key", "component_id")
    some = table.filter("n_shingles > 0").join(ids, "set_key").select("doc_id", "n_shingles", "component_id")
    none = table.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def _labelled(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str,
              block_sets: int) -> tuple[DataFrame, DataFrame]:
    """The table of sets, and (`set_key`, `root`) of every set: one root per component."""
    table = stage(set_table(docs, width, id_col, text_col), "jaccard-sets")
    members = stage(candidate_clusters(docs, width, percent, id_col, text_col), "jaccard-clusters")
    bits = stage(bit_filter(members, "node"), "jaccard-bits")
    sets = (might_be_in(_sets(docs, width, id_col, text_col), "set_key", bits).filter("_maybe").drop("_maybe")
            .groupBy("set_key").agg(F.first("tokens").alias("tokens")))
    placed = stage(_blocks(members, block_sets), "jaccard-blocks")
    work = (placed.join(sets, "set_key").select("root", "i", "j", "set_key", "side", "tokens")
            .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "set_key"))
    links = stage(work.mapInArrow(_search(percent), "a long, b long"), "jaccard-links")
    roots = components(links).withColumnRenamed("node", "set_key")
    names = (table.filter("n_shingles > 0").select("set_key").distinct().join(roots, "set_key", "left")
             .withColumn("root", F.coalesce("root", "set_key")))
    return table, stage(names, "jaccard-names")


def _tagged(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """`_row` (all columns), `doc_id` and `set_key` (null without a set)."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    packed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), whole)

    def run(batches):
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw = [t or b"" for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                keys = [set_key(s) if len(s) else None for s in shingle_sets(raw, width)]
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(0), pa.array(keys, pa.int64())],
                                                 names=["_row", "doc_id", "set_key"])

    return packed.mapInArrow(run, f"_row {packed.schema['_row'].dataType.simpleString()}, doc_id long, set_key long")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text", block_sets: int = 512) -> DataFrame:
    """The rows of `docs` that stay: of each component that with the smallest id (then set),
    null ids last. Rows without a set all stay; of rows that repeat the id and set of the one
    to stay, one does. Columns are as they were. Texts of documents alone in their
    component are not shuffled.
    """
    table, names = _labelled(docs, width, percent, id_col, text_col, block_sets)
    counted = table.filter("n_shingles > 0").groupBy("set_key", "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "set_key", "n"))
    kept = (counted.join(names, "set_key").groupBy("root").agg(first.alias("b"), F.sum("n").alias("size"))
            .filter("size > 1").select("root", F.col("b.doc_id").alias("keep_id"),
                                       F.col("b.set_key").alias("keep_set"), F.col("b.n").alias("times")))
    several = stage(names.join(kept, "root").drop("root"), "jaccard-several")
    bits = stage(bit_filter(several, "set_key"), "jaccard-bits")
    told = might_be_in(_tagged(docs, width, id_col, text_col), "set_key", bits)
    alone = told.filter(F.col("set_key").isNull() | ~F.col("_maybe")).select("_row")
    met = told.filter(F.col("set_key").isNotNull() & F.col("_maybe")).join(several, "set_key", "left")
    stays = met.filter(F.col("keep_set").isNull() | (
        (F.col("set_key") == F.col("keep_set")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    once = stays.filter(F.coalesce("times", F.lit(1)) == 1).select("_row")
    repeats = stays.filter("times > 1").dropDuplicates(["set_key"]).select("_row")
    return alone.unionByName(once).unionByName(repeats).select("_row.*")
