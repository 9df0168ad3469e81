"""Exact Jaccard join of word n-gram sets: prefix postings, then a prefix-tree join of candidates."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rtml.llm.common import broadcast_checked, components, giving_back, prepare, stored
from rtml.llm.words import HashOfWord, gram_hashes, spaced_words

#: Bits of a gram key that hold its hash; the six above hold how common the gram is.
_HASH_BITS = np.uint64(58)
#: A gram is common if it has at least this share of all repeats seen inside tasks, so at most
#: 1 / COMMON_SHARE grams are.
COMMON_SHARE = 2.0 ** -20
_SALTS = 16
#: Documents in one side of a prefix-tree join task; the prefix bound takes eight times as many.
BLOCK = 128


def gram_set(hasher: HashOfWord, text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; fewer words make one shingle."""
    words = hasher.of(spaced_words(text))
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(k, len(words))))


class Order:
    """One global order of grams: those known to be common come last, by level, then by hash."""

    def __init__(self, grams: np.ndarray, levels: np.ndarray):
        self.grams, self.levels = grams, levels

    def keys(self, grams: np.ndarray) -> np.ndarray:
        keys = grams >> (np.uint64(64) - _HASH_BITS)
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            keys |= np.where(self.grams[at] == grams, self.levels[at], np.uint64(0)) << _HASH_BITS
        return np.sort(keys)


def needed(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of ``a`` and ``b`` members that reaches ``percent``."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Two linked sets share one of the first so many members: an overlap of ``percent`` of ``n``
    cannot lie in the rest alone."""
    return n - -(-percent * n // 100) + 1


class Tree:
    """Prefix tree of ordered sets; an edge holds a run of members, so single branches stay arrays.

    ``sets`` hold all members or only the first ones of each set; ``sizes`` are the whole sizes.
    """

    class Node:
        __slots__ = ("run", "below", "sets", "least", "most", "depth")

    def __init__(self, sets: dict[int, np.ndarray], sizes: dict[int, int]):
        self.sets, self.sizes = sets, sizes
        order = sorted(sets, key=lambda i: sets[i].astype(">u8").tobytes())
        self.root = self._grow(order, 0) if order else None

    def _grow(self, ids: list[int], at: int) -> Node:
        first, last = self.sets[ids[0]], self.sets[ids[-1]]
        n = min(len(first), len(last))
        apart = first[at:n] != last[at:n]
        end = at + (int(apart.argmax()) if apart.any() else n - at)
        node = self.Node()
        node.run, node.depth = first[at:end], end
        node.sets = [i for i in ids if len(self.sets[i]) == end]
        groups: dict[int, list[int]] = defaultdict(list)
        for i in ids:
            if len(self.sets[i]) > end:
                groups[int(self.sets[i][end])].append(i)
        node.below = [self._grow(group, end) for group in groups.values()]
        node.least = min(self.sizes[i] for i in ids)
        node.most = max(self.sizes[i] for i in ids)
        return node

    def matches(self, y: np.ndarray, size: int, percent: int, wanted):
        """Ids of sets that may reach ``percent`` with ``y`` (of whole size ``size``) as far as the
        known members tell: exactly the links if all members are known on both sides.

        ``wanted(id)`` false skips a set. The overlap of a shared run is counted once for all sets
        below it, and a branch is left when even all that remains of it and of ``y`` could not reach
        the least overlap needed.
        """
        stack = [(self.root, 0, 0)] if self.root and len(y) else []
        while stack:
            node, overlap, at = stack.pop()
            run, depth = node.run, node.depth
            if len(run):
                known = int(np.searchsorted(run, y[-1], "right"))
                depth -= len(run) - known
                run = run[:known]
                if known:
                    stop = int(np.searchsorted(y, run[-1], "right"))
                    window = y[at:stop]
                    place = np.searchsorted(window, run)
                    inside = place < len(window)
                    overlap += int((window[place[inside]] == run[inside]).sum())
                    at = stop
                if depth < node.depth:
                    at = len(y)
            if overlap + min(node.most - depth, size - at) < needed(node.least, size, percent):
                continue
            if depth < node.depth:  # the known members of y end here
                below, sets = [node], []
                while below:
                    child = below.pop()
                    sets += child.sets
                    below += child.below
            else:
                sets = node.sets
                stack.extend((child, overlap, at) for child in node.below)
            for i in sets:
                n, up_to = self.sizes[i], at
                if depth == len(self.sets[i]) and depth:  # members of y up to the last known one
                    up_to = int(np.searchsorted(y, self.sets[i][-1], "right")) if depth < n else \
                        len(y)
                if overlap + min(n - depth, size - up_to) >= needed(n, size, percent) and wanted(i):
                    yield i


class Union(dict):
    """Union-find over any keys."""

    def find(self, x):
        while self.setdefault(x, x) != x:
            self[x] = x = self[self[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        return True


def _sets_table(rows: DataFrame, k: int) -> DataFrame:
    """One row per document: size and signature of its set; and repeats of grams seen by tasks."""
    def scan(batches):
        hasher, held, size = HashOfWord(), [], 0

        def repeats():
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            grams, n = grams[n > 1], n[n > 1]
            none = pa.nulls(len(grams), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array(grams.view(np.int64)), pa.array(n, pa.int64())],
                names=["id", "n", "a", "b"])

        for batch in batches:
            sets = [gram_set(hasher, t, k) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            one = [int(np.bitwise_xor.reduce(s)) if len(s) else 0 for s in sets]
            two = [int((s * s + (s >> np.uint64(7))).sum()) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(np.array(one, np.uint64).view(np.int64)),
                 pa.array(np.array(two, np.uint64).view(np.int64))], names=["id", "n", "a", "b"])
            held += sets
            size += sum(map(len, sets))
            if size > 500_000:
                yield repeats()
                held, size = [], 0
        if held:
            yield repeats()

    return stored(rows.mapInArrow(giving_back(scan), "id long, n long, a long, b long"), "sets")


def _common_grams(repeats: DataFrame) -> Order:
    grams = repeats.groupBy("a").agg(F.sum("b").alias("b")).where("b >= 8")
    total = repeats.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("t")).first().t
    found = grams.where(F.col("b") >= total * COMMON_SHARE).toPandas()
    names = found["a"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    levels = np.minimum(np.log2(np.maximum(found["b"].to_numpy(float), 1)), 31).astype(np.uint64)
    return Order(names[order], levels[order])


def _copies(table: DataFrame) -> DataFrame:
    """(``id``, ``rep``) of documents whose whole set equals that of a smaller id."""
    reps = table.groupBy("n", "a", "b").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")) \
        .where("m > 1") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).drop("m")
    salted = table.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)))
    return stored(salted.join(reps, ["n", "a", "b", "salt"]).where("id <> rep")
                  .select("id", "rep"), "copies")


def _text_key() -> list:
    """Two hashes of a text; null and empty texts have the same."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _versions(rows: DataFrame, table: DataFrame) -> DataFrame | None:
    """(``id``, ``h1``, ``h2``, ``key``): a key of its own, above all ids, for each text of the ids
    that occur with several sets. None if there are no such ids."""
    ids = table.where("id IS NOT NULL AND n IS NOT NULL")
    several = stored(ids.groupBy("id").agg(F.min(F.struct("n", "a", "b")).alias("lo"),
                                           F.max(F.struct("n", "a", "b")).alias("hi"))
                     .where("lo <> hi").select("id"), "several")
    if several.isEmpty():
        return None
    texts = stored(rows.join(broadcast_checked(several), "id", "left_semi")
                   .select("id", *_text_key()).distinct(), "texts")
    top = ids.agg(F.max("id")).first()[0]
    if top > (1 << 63) - 2 - texts.count():
        raise ValueError("no room above the largest id for the texts of repeated ids")
    numbered = texts.rdd.zipWithIndex().map(lambda x: (*x[0], top + 1 + x[1]))
    return stored(rows.sparkSession.createDataFrame(numbered, "id long, h1 long, h2 long, key long"),
                  "versions")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Arrays of a list column of longs or ints, as unsigned."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    flat = flat.view(np.uint64 if flat.dtype == np.int64 else np.uint32)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _ordered_sets(rows: DataFrame, order: Order, k: int, percent: int, whole: bool) -> DataFrame:
    """(``id``, ``n``, ``grams``): each set in the global order, all of it or its prefix.

    Prefixes come with ``short``, the upper half of their keys: as good for bounds, and half as long.
    """
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        hasher, order = HashOfWord(), shared.value
        for batch in batches:
            sets = [order.keys(gram_set(hasher, t, k))
                    for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = [len(s) for s in sets]
            if not whole:
                sets = [s[:prefix_length(len(s), percent)] if len(s) else s for s in sets]
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(flat.view(np.int64)))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), lists]
            if not whole:
                short = (flat >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                        pa.array(short)))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "grams", "short"]
                                             [:len(columns)])

    return rows.mapInArrow(giving_back(run), "id long, n long, grams array<long>" +
                           ("" if whole else ", short array<int>"))


def _possible(x: np.ndarray, nx: int, y: np.ndarray, ny: int, percent: int) -> bool:
    """Whether two sets can be linked, given their first members (all of them: whether they are).

    Below the smaller of the two last known members both sets are known; what is not shared there
    cannot be shared at all.
    """
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    if len(x) < nx or len(y) < ny:
        last = min(x[-1], y[-1])
        shared += min(nx - int(np.searchsorted(x, last, "left")),
                      ny - int(np.searchsorted(y, last, "left")))
    return shared >= needed(nx, ny, percent)


def _bounded(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that can be links as far as the prefixes tell."""
    def check(batches):
        for batch in batches:
            a, b, n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            x, y = _lists(batch.column(4)), _lists(batch.column(5))
            keep = np.array([_possible(p, int(i), q, int(j), percent)
                             for p, i, q, j in zip(x, n, y, m)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()),
                                              pa.array(b[keep], pa.int64())], names=["a", "b"])

    x = heads.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("short").alias("x"))
    y = heads.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("short").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "x", "y") \
        .mapInArrow(giving_back(check), "a long, b long")


def _near(rows, percent, out):
    """Members of a task for which its gram can be the first one that they share with a member of
    another component they link with, given the gram's place (column 6) in each ordered set.

    Of two sets only what follows their first shared gram can be shared, that gram included.
    """
    comp, n, at, side = (np.array([r[i] for r in rows], np.int64) for i in (4, 5, 6, 7))
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    least = -(-percent * (n[left][:, None] + n[right][None, :]) // (100 + percent))
    good = np.minimum((n - at)[left][:, None], (n - at)[right][None, :]) >= least
    good &= comp[left][:, None] != comp[right][None, :]
    found = {*left[good.any(1)].tolist(), *right[good.any(0)].tolist()}
    out += [(rows[i][0], rows[i][3], rows[i][4], rows[i][5]) for i in found]


def _mark(rows, percent, out):
    """Members of a task that may be linked to one of another component, each once.

    The bounds of ``_possible`` and ``_near`` for all pairs of two blocks at once, the former from a
    product of 0/1 matrices. Keys may be halves that members of one set share; each such clash can
    hide one shared member, and the gram's place is that of the first key with its half.
    """
    left = [r for r in rows if r[7] != 2]
    right = [r for r in rows if r[7] != 1]
    if not left or not right:
        return
    half = np.uint32(rows[0][0] >> 32)
    after = [np.array([r[5] - int(np.searchsorted(r[6], half, "left")) for r in side])
             for side in (left, right)]
    sets = [r[6] for r in left] + [r[6] for r in right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((len(left), len(right)), np.float32)
    rank = np.cumsum(times > 1) - 1
    use = times[at] > 1
    owner, column = owner[use], rank[at[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int((times > 1).sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        hot = np.zeros((len(sets), 4096), np.float32)
        hot[owner[a:b], column[a:b] - start] = 1
        shared += hot[:len(left)] @ hot[len(left):].T
    clashes = [np.array([int((r[6][1:] == r[6][:-1]).sum()) for r in side], np.float32)
               for side in (left, right)]
    shared += np.minimum(clashes[0][:, None], clashes[1][None, :])
    last_left = np.array([r[6][-1] for r in left])
    last_right = np.array([r[6][-1] for r in right])
    n, m = np.array([r[5] for r in left]), np.array([r[5] for r in right])
    a = np.stack([np.searchsorted(r[6], last_right, "left") for r in left])
    b = np.stack([np.searchsorted(r[6], last_left, "left") for r in right]).T
    a, b = np.minimum(a, np.array([len(r[6]) for r in left])[:, None] - 1), \
        np.minimum(b, np.array([len(r[6]) for r in right])[None, :] - 1)
    least = -(-percent * (n[:, None] + m[None, :]) // (100 + percent))
    good = shared + np.minimum(n[:, None] - a, m[None, :] - b) >= least
    good &= np.minimum(after[0][:, None], after[1][None, :]) >= least
    good &= np.array([r[4] for r in left])[:, None] != np.array([r[4] for r in right])[None, :]
    found = {left[i][3] for i in np.flatnonzero(good.any(1))} | \
        {right[i][3] for i in np.flatnonzero(good.any(0))}
    out += [(rows[0][0], i) for i in found]


def _lead(rows, percent, out):
    """Links of a task between a leader and a block of its members, which are one tree."""
    members = {r[3]: r for r in rows if r[7] == 1}
    tree = Tree({i: r[6] for i, r in members.items()}, {i: r[5] for i, r in members.items()})
    for r in rows:
        if r[7] == 2:
            out += [(x, r[3]) for x in tree.matches(r[6], r[5], percent, lambda x: True)]


def _link(rows, percent, out):
    """Spanning links of a task between components."""
    left = {r[3]: r for r in rows if r[7] != 2}
    right = {r[3]: r for r in rows if r[7] != 1}
    tree = Tree({i: r[6] for i, r in left.items()}, {i: r[5] for i, r in left.items()})
    united = Union()

    def apart(x, y):
        return united.find(left[x][4]) != united.find(right[y][4])

    for y, r in right.items():
        for x in tree.matches(r[6], r[5], percent, lambda x, y=y: apart(x, y)):
            if apart(x, y):
                united.join(left[x][4], r[4])
                out.append((x, y))


def _run_tasks(tasks: DataFrame, work, percent: int, kind: str) -> DataFrame:
    """Apply ``work`` to each task; rows come sorted by task and one task's rows are held at a time."""
    names = [c.split()[0] for c in kind.split(", ")]

    def rows_of(out):
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches):
        held, task = [], None
        for batch in batches:
            out: list[tuple] = []
            plain = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 5)]
            seventh = batch.column(6)
            seventh = _lists(seventh) if pa.types.is_list(seventh.type) else seventh.to_pylist()
            for row in zip(*plain, seventh, batch.column(7).to_pylist()):
                if task != row[:3]:
                    if held:
                        work(held, percent, out)
                    held, task = [], row[:3]
                held.append(row)
            yield rows_of(out)
        out = []
        if held:
            work(held, percent, out)
        yield rows_of(out)

    return tasks.mapInArrow(giving_back(run), kind)


def _together(tasks: DataFrame, column: str) -> DataFrame:
    """Rows of tasks (``gram``, ``i``, ``j``) with one more column, a task's rows one after the other."""
    return tasks.select("gram", "i", "j", "id", "comp", "n", column, F.col("side").cast("long")) \
        .repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j")


def _placed(tasks: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of tasks with their sets."""
    return _together(tasks.select("gram", "i", "j", "id", "comp", "side").join(sets, "id"), "grams")


def _lead_tasks(pairs: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """A task for each block of up to about ``block`` members ``a`` of a leader ``b``.

    ``side`` is 1 for the members and 2 for the leader, whose set is there once per block.
    """
    leads = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / block).alias("nb"))
    members = pairs.join(leads, "b").select(
        F.col("b").alias("gram"), F.pmod(F.xxhash64("a"), "nb").alias("i"), F.col("a").alias("id"),
        F.lit(1).alias("side"))
    probes = leads.select(F.col("b").alias("gram"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("nb") - 1)).alias("i"), F.col("b").alias("id"),
        F.lit(2).alias("side"))
    return _placed(members.union(probes).select("gram", "i", F.lit(0).cast("long").alias("j"), "id",
                                                F.col("id").alias("comp"), "side"), sets)


def _tree_tasks(groups: DataFrame, block: int, percent: int) -> DataFrame:
    """``groups`` with ``i``, ``j`` and ``side``: blocks of about ``block`` members of neighbouring set
    sizes, and a task for each pair of blocks of a group that can hold a link between components.

    A pair is left out where even the largest set of the one is too small for the smallest of the
    other, or where both blocks hold one and the same component. ``side`` is 1 and 2 for the two blocks,
    3 where a block meets itself. A group of up to ``block`` members is one block.
    """
    columns, zero = [c for c in groups.columns if c != "m"], F.lit(0).cast("long")
    small = groups.where(F.col("m") <= block) \
        .select(*columns, zero.alias("i"), zero.alias("j"), F.lit(3).alias("side"))
    large = groups.where(F.col("m") > block)
    smaller = Window.partitionBy("gram").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = large.groupBy("gram", "n").agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("before", F.coalesce(F.sum("c").over(smaller), F.lit(0)))
    members = large.join(sizes, ["gram", "n"]).select(
        "m", *columns, F.floor((F.col("before") + F.pmod(F.xxhash64("id"), "c")) / block).alias("blk"))
    spans = members.groupBy("gram", "blk").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("lo"),
        F.max("comp").alias("hi"), F.ceil(F.first("m") / block).alias("nb"))
    first = spans.select("gram", F.col("blk").alias("i"), "most", F.col("lo").alias("lo1"),
                         F.col("hi").alias("hi1"),
                         F.explode(F.sequence("blk", F.greatest("blk", F.col("nb") - 1))).alias("j"))
    second = spans.select("gram", F.col("blk").alias("j"), "least", "lo", "hi")
    pairs = first.join(second, ["gram", "j"]).where(
        (100 * F.col("most") >= percent * F.col("least")) &
        (F.least("lo", "lo1") != F.greatest("hi", "hi1"))).select("gram", "i", "j")
    ends = pairs.select("gram", "i", "j", F.col("i").alias("blk"),
                        F.when(F.col("i") == F.col("j"), 3).otherwise(1).alias("side")) \
        .union(pairs.where("i < j").select("gram", "i", "j", "j", F.lit(2)))
    return small.union(members.join(ends, ["gram", "blk"]).select(*columns, "i", "j", "side"))


def _mixed(groups: DataFrame) -> DataFrame:
    """Groups (``gram``, ``id``, ``comp``, ``n``) that hold several components, with their size ``m``; of
    groups of equal members the one of the first gram is enough."""
    sized = groups.groupBy("gram").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s")).where("lo <> hi")
    once = sized.groupBy("m", "s").agg(F.min("gram").alias("gram"))
    return groups.join(once.select("gram", "m"), "gram")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` and ``component_id``, the smallest id that links reach.

    Texts are lower-cased (A-Z) and split at ASCII white space. Two documents link when the shared
    ``k``-word shingles are at least ``percent`` of all theirs; no such pair is missed:

    1. equal sets are joined to their smallest id, by signature (salted join);
    2. each remaining set is put in one global order, grams that repeat inside tasks last, and its
       prefix is posted; linked sets share a posted gram;
    3. in each group of one gram the members that the places of the gram and the prefix bound let link
       to the most shared one are put in prefix trees, in blocks, and that member's whole set walks
       them, which joins groups of copies without comparing them all;
    4. groups whose other members still are in several components are cut into blocks by set size, and every pair of
       blocks whose sizes allow a link is looked at: first by set sizes and places of the gram alone,
       for linked sets meet in the group of their first shared gram too, so members that cannot share
       enough from that place on are left out there; then the overlaps of the prefixes mark the
       members that can have a link to another component at all, and a prefix tree over the whole
       sets of those finds the links.

    Ids are longs; rows with a null id get a null component; rows that repeat an id are one document
    if their sets are equal, and are documents of their own, linked through the shared id, if not. Null, empty and blank
    texts have 0 shingles and no link. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table = _sets_table(rows, k)
    versions = _versions(rows, table)
    if versions is not None:
        rows = rows.select("id", "text", *_text_key()) \
            .join(broadcast_checked(versions), ["id", "h1", "h2"], "left") \
            .select(F.coalesce("key", "id").alias("id"), "text")
        table = _sets_table(rows, k)
    order = _common_grams(table.where("id IS NULL AND n IS NULL"))
    sized = table.where("n IS NOT NULL")
    full = sized.where("n > 0 AND id IS NOT NULL")
    copies = _copies(full)
    left = rows.where("id IS NOT NULL") \
        .join(broadcast_checked(copies.select("id").distinct()), "id", "left_anti")
    heads = stored(_ordered_sets(left, order, k, percent, whole=False), "heads")
    posted = heads.select(F.posexplode("grams").alias("at", "gram"), "id", "n")
    shared = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("lo"),
                                        F.max("id").alias("hi")).where("lo <> hi").select("gram")
    groups = stored(posted.join(shared, "gram").select("gram", "id", "n", "at"), "groups")
    weight = groups.groupBy("id").agg((F.count(F.lit(1)) / F.first("n")).alias("w"))
    ranked = groups.join(weight, "id")
    leaders = ranked.groupBy("gram").agg(
        F.max(F.struct("w", (-F.col("id")).alias("x"), "n", "at")).alias("lead"))
    led = stored(ranked.join(leaders, "gram").select(
        "gram", "id", "n", "at", (-F.col("lead.x")).alias("lead"), F.col("lead.n").alias("ln"),
        F.col("lead.at").alias("lat")).where(F.col("id") != F.col("lead")), "led")
    # all that two sets can share: what lies before their places of the gram, and from there on
    most = F.least("at", "lat") + F.least(F.col("n") - F.col("at"), F.col("ln") - F.col("lat"))
    pairs = led.where((100 + percent) * most >= percent * (F.col("n") + F.col("ln"))) \
        .select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct()
    short = heads.select("id", "n", "short")
    possible = stored(_bounded(pairs, short, percent), "possible")

    def whole_sets(ids: DataFrame) -> DataFrame:
        ids = broadcast_checked(stored(ids.distinct(), "members"))
        return stored(_ordered_sets(left.join(ids, "id", "left_semi"), order, k, percent, whole=True),
                      "grams")

    members = possible.select(F.col("a").alias("id")).union(possible.select("b"))
    linked = stored(_run_tasks(_lead_tasks(possible, whole_sets(members), BLOCK), _lead, percent,
                               "a long, b long"), "links")
    found = components(linked)
    labelled = led.join(found.withColumnRenamed("node", "id"), "id", "left") \
        .select("gram", "id", F.coalesce("component", "id").alias("comp"), "n",
                F.col("at").cast("long"))
    places = _together(_tree_tasks(_mixed(labelled), 8 * BLOCK, percent), "at")
    near = _run_tasks(places, _near, percent, "gram long, id long, comp long, n long").distinct()
    mixed = stored(_mixed(stored(near, "near")), "mixed")
    blocks = _placed(_tree_tasks(mixed, 8 * BLOCK, percent), short.withColumnRenamed("short", "grams"))
    marked = stored(_run_tasks(blocks, _mark, percent, "gram long, id long").distinct(), "marked")
    rest = stored(_mixed(marked.join(mixed.select("gram", "id", "comp", "n"), ["gram", "id"])), "rest")
    walks = _placed(_tree_tasks(rest, BLOCK, percent), whole_sets(rest.select("id")))
    more = stored(_run_tasks(walks, _link, percent, "a long, b long"), "treelinks")
    edges = linked.union(more).union(copies.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    if versions is not None:
        edges = edges.union(versions.select("key", "id"))
    result = sized.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    name = F.col("id")
    if versions is not None:
        own = versions.select(F.col("key").alias("id"), F.col("id").alias("own"))
        result, name = result.join(broadcast_checked(own), "id", "left"), F.coalesce("own", "id")
    return result.select(name.alias(id_col), F.col("n").alias("n_shingles"),
                         F.coalesce("component", "id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of the smallest id of each component only, and all rows
    without an id. Of rows that repeat this id the one with the smallest hash of its text stays."""
    found = stored(jaccard_components(docs, k, percent, id_col, text_col), "components")
    # the row is one struct, so no column of it can have the name of a column here
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_key"),
                       F.xxhash64(text_col).alias("_text"))
    gone = stored(found.where(F.col("component_id") != F.col(id_col))
                  .select(F.col(id_col).alias("_key")).distinct(), "gone")
    kept = rows.join(broadcast_checked(gone), "_key", "left_anti")
    again = stored(found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_key")).count()
                   .where("count > 1").select("_key"), "again")
    if again.isEmpty():
        return kept.select("_row.*")
    again = broadcast_checked(again)
    order = F.struct("_text", F.to_json(F.struct("_row")))
    one = kept.join(again, "_key", "left_semi").groupBy("_key") \
        .agg(F.min_by("_row", order).alias("_row"))
    return kept.join(again, "_key", "left_anti").select("_row").union(one.select("_row")) \
        .select("_row.*")
