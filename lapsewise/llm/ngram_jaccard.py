"""Exact n-gram Jaccard join with signature trees.

A document is the set of its word shingles.  Documents with equal sets form
one node, so copies cost nothing further.  Two sets of Jaccard similarity t or
more share a shingle among the first n - ceil(t n) + 1 of either set, in any
common order of shingles (prefix filter), and their sizes are close.  Their first common shingle stands
among the first n - ceil(2 t / (1 + t) n) + 1 of the smaller set (its leading shingles), so a
shingle that leads no set, or two sets of unfit sizes only, joins nothing.  The order used puts
shingles that are frequent in a bounded sample last; it decides how fast the join is, never
what it finds.  Nodes that share a prefix shingle and a band of sizes form a block; blocks of
equal membership are one block, and large blocks are dealt out as pairs of chunks.

Each block (or pair of chunks) gets a signature tree: every tree node holds
the OR- and the AND-combined token bitmaps and the size range of its members.
The traversal of pairs of tree nodes drops a pair when the largest possible
overlap of any two members is too small for the threshold, or when the
members are of one component already.  Pairs that are left are verified on
the exact sets.  To send few sets, this goes in rounds: a round names, by signatures,
pairs that could join components (one for two components of a block, with
the same leading member in blocks of much the same members), verifies them, and
comes back to the blocks where more pairs are left.  The last round names the members
that could join another component and compares their exact sets inside the block,
where a link settles all pairs of its components.  So a block gives no more rows than it
has members, however many pairs it has.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import attach, keyed, map_text, materialize, released, small
from lapsewise.llm.components import connected_components
from lapsewise.llm.words import U64, RangeHash, WordBatch, mix
from lapsewise.session import ship_package

#: Documents whose shingles decide the order of the prefix filter.
ORDER_SAMPLE = 4000
#: Members of a block that one task compares; larger blocks are dealt in chunks.
BLOCK_MEMBERS = 2000
LEAF = 32
#: Shared shingles and blocks are broadcast up to this only; they soon outgrow it.
TOKEN_BROADCAST = 1 << 20
#: Rows of 64 bits of the bitmap that shingles are tried on where they outgrow that.
BITMAP_ROWS = 1 << 18
#: Pairs that two components are tried on in a block, round by round; the last
#: round compares all members that are left.
CAPS = (1, None)


def shingle_sets(words: WordBatch, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row (empty without words)."""
    counts = words.counts()
    row = words.rows_of_words()
    length = np.minimum(np.maximum(counts, 1), k)[row]
    start = np.arange(len(row))
    usable = start + length <= words.first[row + 1]
    start, length = start[usable], length[usable]
    h = RangeHash(words.hashes, 0)(start, start + length, length.astype(U64))
    per_row = np.bincount(row[usable], minlength=len(words))
    edge = np.r_[0, np.cumsum(per_row)]
    return [np.unique(h[a:b]) for a, b in zip(edge[:-1], edge[1:])]


def overlap_needed(na: int, nb: int, num: int, den: int) -> int:
    """Least intersection with den * inter >= num * union."""
    return -(-num * (na + nb) // (num + den))


def _prefix(own: np.ndarray, num: int, den: int, tokens: np.ndarray, level: np.ndarray) -> np.ndarray:
    n = len(own)
    size = n - (-(-num * n // den)) + 1
    rank = np.zeros(n, dtype=np.uint8)
    if len(tokens):
        at = np.searchsorted(tokens, own)
        at[at == len(tokens)] = 0
        rank = np.where(tokens[at] == own, level[at], 0)
    order = np.lexsort((mix(own, 21), rank))
    return own[order[:size]]


def _fingerprint(own: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return np.add.reduce(mix(own, 31)), np.add.reduce(mix(own, 32))


def _sample_order(rows: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that two or more sampled documents hold, with log2 of how many.

    The sample is at most about ORDER_SAMPLE documents, chosen by a digest.
    """
    total = rows.count()
    if not total:
        return np.empty(0, U64), np.empty(0, np.uint8)
    every = max(1, total // ORDER_SAMPLE)
    chosen = rows.where(F.pmod(F.xxhash64("h"), F.lit(every)) == 0)

    def kernel(batch):
        sets = shingle_sets(WordBatch(batch.column("text"), lower=True), k)
        return pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate(sets).view(np.int64))})

    seen = map_text(chosen, kernel, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    got = seen.toArrow()
    token = got.column(0).to_numpy().astype(np.int64).view(U64)
    level = np.log2(got.column(1).to_numpy()).astype(np.uint8) + 1
    order = np.argsort(token)
    return token[order], level[order]


def _signed(x) -> pa.Array:
    return pa.array(np.array(x, dtype=U64).view(np.int64))


def document_sets(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, h, n, fp1, fp2, bits, tokens): set size, digest of the set, bitmap, prefix."""
    sc = rows.sparkSession.sparkContext
    held = sc.broadcast(_sample_order(rows, k))

    def kernel(batch):
        sets = shingle_sets(WordBatch(batch.column("text"), lower=True), k)
        prints = [_fingerprint(s) for s in sets]
        tokens = [_prefix(s, num, den, *held.value) if len(s) else s for s in sets]
        offsets = np.cumsum([0] + [len(t) for t in tokens]).astype(np.int32)
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "h": batch.column("h"),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "fp1": _signed([p[0] for p in prints]), "fp2": _signed([p[1] for p in prints]),
            "bits": pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
            "tokens": pa.ListArray.from_arrays(pa.array(offsets), _signed(np.concatenate(tokens)) if tokens else _signed([])),
        })

    return map_text(rows, kernel, "doc_id long, h long, n long, fp1 long, fp2 long, bits binary, tokens array<long>")


def bitmap(own: np.ndarray) -> np.ndarray:
    """Token bitmap of a set: the least power of two bits that is its size or more."""
    bits = max(64, 1 << max(0, len(own) - 1).bit_length())
    out = np.zeros(bits, dtype=np.uint8)
    out[(mix(own, 41) & U64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(U64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


class SignatureTree:
    """Binary tree over members sorted by size (by ``group`` first); the last node is the root."""

    def __init__(self, sizes: list[int], bitmaps: list[np.ndarray], group: list[int] | None = None):
        words = min(map(len, bitmaps))
        bitmaps = [_folded(b, words) for b in bitmaps]
        self.order = sorted(range(len(sizes)), key=lambda i: (group[i] if group else 0, sizes[i], bitmaps[i].tobytes()))
        self.size = np.array([sizes[i] for i in self.order], dtype=np.int64)
        self.bitmaps = np.array([bitmaps[i] for i in self.order])
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(sizes))

    def _build(self, a: int, b: int) -> int:
        children = ()
        if b - a > LEAF:
            mid = (a + b) // 2
            children = (self._build(a, mid), self._build(mid, b))
        self.nodes.append((
            a, b, children, np.bitwise_or.reduce(self.bitmaps[a:b]), np.bitwise_and.reduce(self.bitmaps[a:b]),
            int(self.size[a:b].min()), int(self.size[a:b].max())))
        return len(self.nodes) - 1


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def possible_pairs(tree: SignatureTree, num: int, den: int, settled):
    """Pairs of members whose largest possible overlap reaches num/den: (i, j) in
    tree order.  ``settled(a, b, c, d)`` tells that no pair between members a..b and
    c..d is wanted any more; it is asked again as the pairs are used."""
    todo = [(tree.root, tree.root)]
    while todo:
        x, y = todo.pop()
        a, b, below_x, or_x, and_x, low_x, high_x = tree.nodes[x]
        c, d, below_y, or_y, and_y, low_y, high_y = tree.nodes[y]
        if x != y:
            if num * low_y > den * high_x or num * low_x > den * high_y:
                continue
            most = min(high_x - int(_popcount(and_x & ~or_y)), high_y - int(_popcount(and_y & ~or_x)))
            if most < overlap_needed(low_x, low_y, num, den):
                continue
            if settled(a, b, c, d):
                continue
        if below_x or below_y:
            if x == y:
                # last in, first out: the parts themselves before their cross pairs
                todo += [(below_x[0], below_x[1]), (below_x[0], below_x[0]), (below_x[1], below_x[1])]
            elif below_x and (not below_y or b - a >= d - c):
                todo += [(below_x[0], y), (below_x[1], y)]
            else:
                todo += [(x, below_y[0]), (x, below_y[1])]
            continue
        size_x, size_y = tree.size[a:b], tree.size[c:d]
        missing_x = _popcount(tree.bitmaps[a:b, None] & ~tree.bitmaps[None, c:d])
        missing_y = _popcount(~tree.bitmaps[a:b, None] & tree.bitmaps[None, c:d])
        most = np.minimum(size_x[:, None] - missing_x, size_y[None, :] - missing_y)
        need = -(-num * (size_x[:, None] + size_y[None, :]) // (num + den))
        for i, j in zip(*np.nonzero(most >= need)):
            if x != y or i < j:
                yield a + int(i), c + int(j)


def partners(tree: SignatureTree, i: int, num: int, den: int, unwanted=None) -> np.ndarray:
    """Members (in tree order) that may be similar to member i by their signatures; those below
    a tree node for which ``unwanted(node)`` holds may be left out."""
    size, bits = int(tree.size[i]), tree.bitmaps[i]
    out = []
    todo = [tree.root]
    while todo:
        node = todo.pop()
        a, b, below, or_y, and_y, low, high = tree.nodes[node]
        if unwanted is not None and unwanted(node):
            continue
        if num * low > den * size or num * size > den * high:
            continue
        most = min(size - int(_popcount(bits & ~or_y)), high - int(_popcount(and_y & ~bits)))
        if most < overlap_needed(size, low, num, den):
            continue
        if below:
            todo += below
            continue
        own, sizes = tree.bitmaps[a:b], tree.size[a:b]
        most = np.minimum(size - _popcount(bits & ~own), sizes - _popcount(own & ~bits))
        out.append(a + np.flatnonzero(most >= -(-num * (size + sizes) // (num + den))))
    found = np.concatenate(out) if out else np.empty(0, dtype=np.int64)
    return found[found != i]


def open_pairs(ids: list, sizes: list[int], bitmaps: list[np.ndarray], roots: list, num: int, den: int, cap: int, owned):
    """Pairs of members of different components that may be similar by their
    signatures, and whether others are left for a later round.

    Members lead in the order of their ids, so that blocks with much the same
    members name the same pairs.  Two components are tried on up to ``cap`` pairs;
    then they count as joined here, until the pairs have been verified.
    """
    tree = SignatureTree(sizes, bitmaps)
    order = tree.order
    number: dict = {}
    component = np.array([number.setdefault(roots[i], len(number)) for i in order])
    apart = len(number) - 1
    if not apart:
        return [], False
    find, join = _union(range(len(number)))
    taken: list[tuple[int, int]] = []
    tried: dict[tuple[int, int], int] = {}
    left = False
    for i in sorted(range(len(order)), key=lambda i: ids[order[i]]):
        if not apart and len(order) > LEAF:
            return taken, True
        own = partners(tree, i, num, den)
        own = own[component[own] != component[i]]
        for j in sorted((j for j in own.tolist() if ids[order[j]] > ids[order[i]]), key=lambda j: ids[order[j]]):
            if not owned(order[i], order[j]):
                continue
            p, q = find(int(component[i])), find(int(component[j]))
            if p == q:
                left = True
                continue
            taken.append((order[i], order[j]))
            key = (min(p, q), max(p, q))
            tried[key] = tried.get(key, 0) + 1
            if tried[key] >= cap:
                join(p, q)
                apart -= 1
    return taken, left


def open_members(sizes: list[int], bitmaps: list[np.ndarray], roots: list, num: int, den: int, owned) -> list[int]:
    """The members that an owned pair with a member of another component may link, by
    their signatures."""
    if len(set(roots)) == 1:
        return []
    number: dict = {}
    group = [number.setdefault(r, len(number)) for r in roots]
    times = np.bincount(group)
    # members of a component next to each other, so that tree nodes hold one component
    tree = SignatureTree(sizes, bitmaps, [g if times[g] > 1 else -1 for g in group])
    order = tree.order
    component = np.array(group)[order]
    only = [component[a] if (component[a:b] == component[a]).all() else -1 for a, b, *_ in tree.nodes]
    found = [False] * len(order)
    for i in range(len(order)):
        if found[i]:
            continue  # by its partner
        own = partners(tree, i, num, den, lambda node: only[node] == component[i])
        for j in own[component[own] != component[i]].tolist():
            if owned(order[i], order[j]):
                found[i] = found[j] = True
                break
    return [order[i] for i in range(len(order)) if found[i]]


def _union(components) -> tuple:
    """(find, join) over members 0, 1, ... that start in the given components."""
    first: dict = {}
    parent = [first.setdefault(c, i) for i, c in enumerate(components)]

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(i, j):
        parent[find(i)] = find(j)

    return find, join


def tree_links(sets: list[np.ndarray], num: int, den: int, roots: list | None = None,
               owned=None) -> list[tuple[int, int]]:
    """Links that connect every two members of similarity num/den or more,
    directly or through other such links (at most one less than members).

    Members of one root are connected already; with ``owned`` only such pairs are compared.
    """
    if len(sets) < 2:
        return []
    tree = SignatureTree([len(s) for s in sets], [bitmap(s) for s in sets])
    sets = [sets[i] for i in tree.order]
    find, join = _union(range(len(sets)) if roots is None else [roots[i] for i in tree.order])

    def one_component(a, b, c, d):
        first = find(a)
        return all(find(i) == first for i in range(a, b)) and all(find(i) == first for i in range(c, d))

    links = []
    for i, j in possible_pairs(tree, num, den, one_component):
        if find(i) == find(j) or owned is not None and not owned(tree.order[i], tree.order[j]):
            continue
        p, q = sets[i], sets[j]
        if len(p) > len(q):
            p, q = q, p
        at = np.searchsorted(q, p)
        at[at == len(q)] = 0
        inter = int((q[at] == p).sum())
        if den * inter >= num * (len(p) + len(q) - inter):
            join(i, j)
            links.append((tree.order[i], tree.order[j]))
    return links


def _may_link(num: int, den: int) -> str:
    """Whether sets that share a shingle can be similar through it: of ``c`` sets with sizes
    ``lo`` to ``hi`` the least that it leads has the size ``ix``."""
    return f"c > 1 AND ix IS NOT NULL AND (c > 2 OR ({num} * hi <= {den} * lo AND ix = lo))"


def _sharing() -> list:
    return [F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(F.when(F.col("leads"), F.col("n"))).alias("ix")]


def _blocks(members: DataFrame, limit: int | None, alike: str | None = None) -> DataFrame:
    """(key, fp1, fp2, members): blocks of two or more members; with ``alike`` those of them
    that fulfil it, one of each set of blocks with equal members."""
    kept = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("fp1", "fp2")).alias("x1"),
        F.bit_xor(F.xxhash64("fp2", "fp1")).alias("x2"), *(_sharing() if alike else [])).where(alike or "members > 1")
    members = members.select("key", "fp1", "fp2")
    if alike:
        kept = kept.groupBy("members", "x1", "x2").agg(F.min("key").alias("key"))
    kept = materialize(kept.select("key", "members"), "kept_blocks")
    return materialize(members.join(F.broadcast(kept) if small(kept, limit) else kept, "key"), "blocks")


def _cells(members: DataFrame, data: DataFrame) -> DataFrame:
    """Rows (key, c1, c2, fp1, fp2, n, r1, r2, items, keys) of ``members`` with their data, the
    rows of a cell after each other.  A cell is a block, or a pair of chunks of a large
    block: a member goes to every pair that has its own chunk."""
    parts = F.ceil(F.col("members") / F.lit(BLOCK_MEMBERS)).cast("int")
    own = F.pmod(F.xxhash64("fp2"), F.col("parts")).cast("int")
    cells = (members.withColumn("parts", parts).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("fp1", "fp2", "key", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2")))
    if "keys" not in data.columns:
        data = data.withColumn("keys", F.lit(None).cast("array<bigint>"))
    dealt = cells.join(data, ["fp1", "fp2"]).select("key", "c1", "c2", "fp1", "fp2", "n", "r1", "r2", "items", "keys")
    # the data go to the tasks by cell; AQE sizes their number
    return dealt.repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "fp1", "fp2")


def _each_cell(dealt: DataFrame, compare, schema: str) -> DataFrame:
    """compare(key, ids, sizes, roots, items, keys) -> record batches for every cell of ``dealt``."""
    ship_package(dealt.sparkSession)

    def run(batches):
        cell, ids, sizes, roots, items, held = None, [], [], [], [], []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(8)]
            data, keys = batch.column(8), batch.column(9).to_pylist()
            for i, (key, c1, c2, f1, f2, n, r1, r2) in enumerate(zip(*cols)):
                if (key, c1, c2) != cell:
                    if len(ids) > 1:
                        yield from compare(cell[0], ids, sizes, roots, items, held)
                    cell, ids, sizes, roots, items, held = (key, c1, c2), [], [], [], [], []
                if not ids or ids[-1] != (f1, f2):  # a repeated row brings its set twice
                    ids.append((f1, f2))
                    sizes.append(n)
                    roots.append((r1, r2))
                    items.append(np.frombuffer(data[i].as_py(), dtype=U64))
                    held.append(keys[i])
        if len(ids) > 1:
            yield from compare(cell[0], ids, sizes, roots, items, held)

    return dealt.mapInArrow(released(run), schema)


def _verified(rows: DataFrame, nodes: DataFrame, blocks: DataFrame, k: int, num: int, den: int, limit: int | None,
              known: DataFrame | None = None) -> DataFrame:
    """(a1, a2, b1, b2): links inside ``blocks``, on the exact sets of their members.

    ``known`` has each member's component (r1, r2) and open blocks (keys): only pairs of two
    components are compared, in the block that owns them.
    """
    reps = materialize(
        nodes.select("fp1", "fp2", "rep").join(blocks.select("fp1", "fp2"), ["fp1", "fp2"], "left_semi")
        .select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.h").alias("h")), "candidates")

    def kernel(batch):
        sets = shingle_sets(WordBatch(batch.column("text"), lower=True), k)
        prints = [_fingerprint(s) for s in sets]
        none = pa.array(np.zeros(len(sets), dtype=np.int64))
        return pa.RecordBatch.from_pydict({
            "fp1": _signed([p[0] for p in prints]), "fp2": _signed([p[1] for p in prints]),
            "n": pa.array([len(s) for s in sets], pa.int64()), "r1": none, "r2": none,
            "items": pa.array([s.tobytes() for s in sets], pa.binary())})

    sets = map_text(attach(rows, reps, ["doc_id", "h"], "inner", limit), kernel,
                    "fp1 long, fp2 long, n long, r1 long, r2 long, items binary")
    last = known is not None
    if last:
        sets = sets.drop("r1", "r2").join(F.broadcast(known) if small(known, limit) else known, ["fp1", "fp2"])

    def verify(key, ids, sizes, roots, sets, keys):
        links = tree_links(sets, num, den, *((roots, _owner(key, keys)) if last else ()))
        if not links:
            return
        a, b = zip(*links)
        yield pa.RecordBatch.from_pydict({
            name: pa.array([ids[i][f] for i in side], pa.int64())
            for name, side, f in (("a1", a, 0), ("a2", a, 1), ("b1", b, 0), ("b2", b, 1))})

    return materialize(_each_cell(_cells(blocks, sets), verify, "a1 long, a2 long, b1 long, b2 long"), "verified_links")


def _roots(links: DataFrame) -> DataFrame:
    """(fp1, fp2, r1, r2): the component of every linked node."""
    found = connected_components(links.select(F.struct(F.col("a1").alias("fp1"), F.col("a2").alias("fp2")).alias("a"),
                                              F.struct(F.col("b1").alias("fp1"), F.col("b2").alias("fp2")).alias("b")))
    return found.select("node.fp1", "node.fp2", F.col("root.fp1").alias("r1"), F.col("root.fp2").alias("r2"))


def _owner(key: int, keys: list):
    """Whether the pair of members i and j belongs to the block ``key``: the least of the open
    blocks that hold both (``keys``; none known: every block that holds both)."""
    lower = [{k for k in own if k < key} if own is not None else set() for own in keys]

    def owned(i, j):
        return lower[i].isdisjoint(lower[j])

    return owned


def _likely(spread: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of ``spread`` whose token may be one of ``shared``, by a bitmap of bounded size:
    the others need not be shuffled to be left out.  A full bitmap keeps all rows."""
    h = F.xxhash64("token")
    slot = F.pmod(h, F.lit(BITMAP_ROWS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))
    marks = shared.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("marks"))
    # a semi join, as Spark would do the one with ``shared`` before an inner one
    return spread.join(F.broadcast(marks), (slot == F.col("slot")) & (F.col("marks").bitwiseAND(bit) != 0), "left_semi")


def similar_components(rows: DataFrame, nodes: DataFrame, k: int, num: int, den: int, limit: int | None = None) -> DataFrame:
    """(fp1, fp2, r1, r2): nodes with links and the root of their component."""
    # similar sets are of the same band of sizes or of neighbouring ones
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(max(math.log(den / num), 1e-3) * 1.000001)).cast("int")
    keys = F.explode(F.array(F.xxhash64("token", band), F.xxhash64("token", band + 1))).alias("key")
    few = TOKEN_BROADCAST if limit is None else limit
    own = F.call_function("div", 2 * num * F.col("n") + F.lit(num + den - 1), F.lit(num + den))  # overlap of two such sets
    spread = nodes.select("fp1", "fp2", "n", F.posexplode("tokens").alias("at", "token")).select(
        "fp1", "fp2", "n", "token", (F.col("at") <= F.col("n") - own).alias("leads"))
    shared = materialize(spread.groupBy("token").agg(*_sharing()).where(_may_link(num, den)).select("token"), "shared_shingles")
    spread, shared = (spread, F.broadcast(shared)) if small(shared, few) else (_likely(spread, shared), shared)
    banded = materialize(spread.join(shared, "token", "left_semi").select("fp1", "fp2", "n", "leads", keys), "banded")
    blocks = _blocks(banded, few, _may_link(num, den))
    links, roots = None, None
    for cap in CAPS:

        def meet(key, ids, sizes, roots, bitmaps, keys, cap=cap):
            owned = _owner(key, keys)
            if cap is None:
                own = [(i, None) for i in open_members(sizes, bitmaps, roots, num, den, owned)]
            else:
                own, left = open_pairs(ids, sizes, bitmaps, roots, num, den, cap, owned)
                own = [p if ids[p[0]] < ids[p[1]] else p[::-1] for p in own] + [(None, None)] * left
            for at in range(0, len(own), 20_000):
                some = own[at: at + 20_000]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([key] * len(some), pa.int64()),
                    **{f"{name}{f + 1}": pa.array([None if p[side] is None else ids[p[side]][f] for p in some], pa.int64())
                       for side, name in ((0, "a"), (1, "b")) for f in (0, 1)}})

        signatures = nodes.select("fp1", "fp2", "n", F.col("bits").alias("items"))
        if roots is None:
            known = nodes.select("fp1", "fp2", F.col("fp1").alias("r1"), F.col("fp2").alias("r2"),
                                 F.lit(None).cast("array<bigint>").alias("keys"))
            signatures = signatures.select("*", F.col("fp1").alias("r1"), F.col("fp2").alias("r2"))
        else:
            # a member's open blocks (bounded by its prefix): a pair is compared in one of them only
            held = blocks.groupBy("fp1", "fp2").agg(F.collect_set("key").alias("keys"))
            known = materialize(
                held.join(F.broadcast(roots) if small(roots, limit) else roots, ["fp1", "fp2"], "left").select(
                    "fp1", "fp2", F.coalesce("r1", "fp1").alias("r1"), F.coalesce("r2", "fp2").alias("r2"), "keys"), "open_state")
            signatures = signatures.join(F.broadcast(known) if small(known, limit) else known, ["fp1", "fp2"])
        met = materialize(_each_cell(_cells(blocks, signatures), meet, "key long, a1 long, a2 long, b1 long, b2 long"), "open_pairs")
        if cap is None:
            members = met.select("key", F.col("a1").alias("fp1"), F.col("a2").alias("fp2")).distinct()
            if met.counted_rows or links is None:
                members = materialize(members, "open")
                known = materialize(known.join(members.select("fp1", "fp2"), ["fp1", "fp2"], "left_semi"), "open_known")
                found = _verified(rows, nodes, _blocks(members, limit), k, num, den, limit, known)
                roots = materialize(_roots(found if links is None else links.unionByName(found)), "roots")
            return roots
        pairs = met.where("a1 IS NOT NULL").select("a1", "a2", "b1", "b2").distinct()
        pairs = pairs.select(F.xxhash64("a1", "a2").alias("key"), "a1", "a2", "b1", "b2")
        members = pairs.select("key", F.col("a1").alias("fp1"), F.col("a2").alias("fp2")).unionByName(
            pairs.select("key", F.col("b1").alias("fp1"), F.col("b2").alias("fp2"))).distinct()
        found = _verified(rows, nodes, _blocks(materialize(members, "open"), limit), k, num, den, limit)
        links = found if links is None else links.unionByName(found)
        roots = materialize(_roots(links), "roots")
        rest = materialize(met.where("a1 IS NULL").select("key").distinct(), "open_keys")
        if not rest.counted_rows:
            break
        blocks = materialize(blocks.join(F.broadcast(rest) if small(rest, limit) else rest, "key", "left_semi"), "open_blocks")
    return roots


def similarity_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                          text_col: str = "text", limit: int | None = None) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of num/den or more.

    Words are maximal runs of other bytes than ``\\x20\\x09-\\x0D``, A-Z in
    lower case; a document with fewer than ``k`` words is one shingle.  Returns
    per row: doc_id, h (digest of the text), n_shingles, component_id (the least
    doc_id reachable by links), is_rep (whether the row carries that id and is
    the one of its component to keep).  Null or empty text: no shingles, linked with
    nothing.  Repeated rows are copies of each other.  Null ids are allowed and are
    never a component's id unless all its ids are null.  Empty table: no rows.
    """
    rows = keyed(docs, id_col, text_col)
    docs_sets = materialize(document_sets(rows, k, num, den), "document_sets")
    filled = docs_sets.where("n > 0")
    nodes = materialize(filled.groupBy("fp1", "fp2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("rep"),
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("tokens").alias("tokens")), "nodes")
    found = similar_components(rows, nodes, k, num, den, limit)
    roots = found.select("fp1", "fp2", F.struct(F.col("r1").alias("fp1"), F.col("r2").alias("fp2")).alias("root"))
    roots = F.broadcast(roots) if small(found, limit) else roots
    # only sets with copies or links differ from "a component of its own"
    linked = (nodes.select("fp1", "fp2", "rep", "copies").join(roots, ["fp1", "fp2"], "left")
              .where("root IS NOT NULL OR copies > 1")
              .select("fp1", "fp2", "rep", F.coalesce("root", F.struct("fp1", "fp2")).alias("root")))
    linked = materialize(linked, "linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    classes = materialize(linked.join(least, "root").select("fp1", "fp2", "least"), "classes")
    base = docs_sets.select("doc_id", "h", F.col("n").alias("n_shingles"),
                            F.when(F.col("n") > 0, F.col("fp1")).alias("fp1"), F.when(F.col("n") > 0, F.col("fp2")).alias("fp2"))
    classes = F.broadcast(classes) if small(classes, limit) else classes
    out = base.join(classes, ["fp1", "fp2"], "left")
    is_rep = F.col("least").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("h") == F.col("least.h")))
    return out.select("doc_id", "h", "n_shingles",
                      F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                      is_rep.alias("is_rep"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
             text_col: str = "text", limit: int | None = None) -> DataFrame:
    """The rows of ``docs`` (all their columns) that stand for their component:
    the least doc_id of each; of rows that repeat id and text, one stays."""
    found = materialize(similarity_components(docs, k, num, den, id_col, text_col, limit), "similar")
    stay = found.where("is_rep").groupBy("doc_id", "h", "n_shingles").agg(F.count(F.lit(1)).alias("n"))
    stay = materialize(stay, "stay")
    key = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"))
    rows = attach(key, stay, ["doc_id", "h"], "inner", limit)
    once = rows.where("n = 1 OR n_shingles = 0").select("row.*")
    if stay.where("n > 1 AND n_shingles > 0").isEmpty():
        return once
    return once.unionByName(rows.where("n > 1 AND n_shingles > 0").dropDuplicates(["doc_id", "h"]).select("row.*"))
