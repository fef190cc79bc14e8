"""N-gram Jaccard join by chosen paths.

1. Each text becomes the set of its word shingles (hashes), keyed by a 128-bit digest of the set, and a
   MinHash sketch of ``COORDS`` coordinates. Texts with the same set are one row from here on.
2. Chosen-path recursion on the sketches: a node of the tree samples each coordinate with probability
   1 / (threshold * COORDS), as a hash of the node decides, and sends the set to one child per sampled
   coordinate and its value. Nodes of at most ``SMALL`` sets are compared by brute force. In a larger node
   everything that agrees with its pivot (its lowest id) in ``PIVOT`` of the coordinates is linked to the pivot,
   sets that agree in ``CLOSE`` leave the node, and the rest is split again, unless all of the node is linked.
   By the triangle inequality, which holds for the sketches themselves, no set that leaves is a candidate pair
   (``NEAR``) with one that is not linked to the same pivot. Independent trees are grown until the target recall below.
3. Sets that are linked, directly or by others, form a candidate cluster. All pairs of a cluster are
   compared exactly, in blocks of ``BLOCK`` sets, with one matrix product per block pair; a block pair returns
   the number of links of each set and a spanning forest, never the pairs.

Recall: two sets at the threshold share one sampled coordinate of a node on average. So they are together
one level down with probability p = 1 - 1/e, and with 1 - exp(-p) one further down, about 0.37 at the third
level. At least ``RUNS`` trees are grown, and more until 1 - (1 - p)^trees reaches ``RECALL`` for the deepest
level that any tree had to be split to; more similar pairs are found more surely. What is returned is exact:
no pair below the threshold counts.

Memory: a task holds nodes of at most ``SMALL`` sketches, twice that at each level down up to ``LARGEST``, or
two blocks of sets. Larger nodes are never gathered: sizes and pivots of up to ``FEW`` of them go to every
task; only of more than that are the rows joined by node (skew that adaptive execution splits).

Null texts and texts without a word have no set: they link to nothing and are classes of their own. A text
of fewer words than a shingle, but not none, is one shingle. Rows with a null id link to
nothing and come back with a null class. A repeated id with equal texts is a copy of itself; with different
texts, only one of them is compared, so ids should be unique. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.components import components, forest
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import stored

SHINGLE = 5
THRESHOLD = 0.8
COORDS = 64
RUNS = 10
RECALL = 0.99
SMALL = 256
#: the bound doubles from level to level, as fewer rows are left, up to
LARGEST = 4096
BLOCK = 256
#: estimated similarity from which two sets become candidates; 4 standard deviations below the threshold
NEAR = 0.6
#: and from which a set leaves a node with its pivot
CLOSE = 0.9
#: whatever is NEAR a set that is CLOSE to the pivot is this near the pivot, as shares of differing coordinates add up at most
PIVOT = CLOSE + NEAR - 1
#: rows of a few numbers, and of sketches, that may be sent to every task: 80 and 30 MB
FEW = 1_000_000
SKETCHES = 100_000

U64 = np.uint64
_rng = np.random.default_rng(20240115)
_MUL = _rng.integers(1, 1 << 63, COORDS, dtype=U64) * U64(2) + U64(1)
_ADD = _rng.integers(1, 1 << 63, COORDS, dtype=U64)

KEYS = T.StructType([T.StructField("id", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("sketch", T.BinaryType())])
CHILD = T.StructType([T.StructField("node", T.LongType()), T.StructField("id", T.LongType())])
LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
SETS = T.StructType([T.StructField("id", T.LongType()), T.StructField("set", T.BinaryType())])
FOUND = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("links", T.LongType())])


def _shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their bounds."""
    h, row = textops.grams(textops.words(texts), SHINGLE)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, textops.per_row(h, row, len(texts))


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(KEYS)
    for piece in textops.pieces(batches, "text"):
        h, at = _shingle_sets(piece.column("text"))
        full = np.flatnonzero(np.diff(at))
        begin = at[:-1][full]
        sketch = np.zeros((piece.num_rows, COORDS), np.uint32)
        k1, k2 = np.zeros(piece.num_rows, U64), np.zeros(piece.num_rows, U64)
        if len(full):
            for c in range(COORDS):
                sketch[full, c] = np.minimum.reduceat(h * _MUL[c] + _ADD[c] >> U64(32), begin).astype(np.uint32)
            k1[full] = np.add.reduceat(textops.mix(h), begin)
            k2[full] = np.add.reduceat(textops.mix(h ^ U64(0x5851F42D4C957F2D)), begin)
        raw = textops.binaries(sketch.ravel(), np.arange(piece.num_rows + 1) * COORDS)
        yield record(arrow, piece.column("id"), k1.view(np.int64), k2.view(np.int64), np.diff(at).astype(np.int32), raw)


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = textops.buffers(column)
    return data.view(np.uint32).reshape(-1, COORDS)


def _children(nodes: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes of each row and the row they are of."""
    bar = U64(int((1 << 64) / (THRESHOLD * COORDS)))
    out, rows = [], []
    for c in range(COORDS):
        pick = np.flatnonzero(textops.mix(nodes ^ _ADD[c]) < bar)
        out.append(textops.mix(nodes[pick] * U64(0xC2B2AE3D27D4EB4F) + U64(c + 1) + (sketch[pick, c].astype(U64) << U64(8))))
        rows.append(pick)
    return np.concatenate(out), np.concatenate(rows)


def runs_for(depth: int, recall: float = RECALL) -> int:
    """Trees that find a pair at the threshold with probability ``recall``, if nodes are split ``depth`` times."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))


def _split_roots(trees: range):
    def run(batches):
        arrow = to_arrow_schema(CHILD)
        for b in batches:
            sketch, ids = _matrix(b.column("sketch")), b.column("id").to_numpy()
            for r in trees:
                child, rows = _children(np.full(len(ids), textops.mix(np.array([r + 1], U64))[0]), sketch)
                yield record(arrow, child.view(np.int64), ids[rows])

    return run


def _split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(CHILD)
    for b in batches:
        child, rows = _children(b.column("node").to_numpy().view(U64), _matrix(b.column("sketch")))
        yield record(arrow, child.view(np.int64), b.column("id").to_numpy()[rows])


def _runs_of(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows in which no group of equal keys is cut."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            v = b.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= v[0] != held[-1].column(k)[-1].as_py()
        cuts = np.flatnonzero(change)
        if not held:
            cuts = cuts[cuts > 0]
        if len(cuts):
            last = int(cuts[-1])
            yield pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks().to_batches()[0] if held or last else b
            held = [b.slice(last)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _brute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the small nodes: each set that is near another, to the lowest of those it is connected to."""
    arrow = to_arrow_schema(LINK)
    for b in _runs_of(batches, ["node"]):
        node, ids, sketch = b.column("node").to_numpy(), b.column("id").to_numpy(), _matrix(b.column("sketch"))
        left, right, step = [], [], 1
        i = np.flatnonzero(node[1:] == node[:-1])
        while len(i):
            for part in np.array_split(i, max(1, len(i) >> 14)):
                near = (sketch[part] == sketch[part + step]).sum(1) >= NEAR * COORDS
                left.append(part[near])
                right.append(part[near] + step)
            step += 1
            i = i[i + step < len(node)]
            i = i[node[i] == node[i + step]]
        if left:
            low = forest(len(ids), np.concatenate(left), np.concatenate(right))
            some = np.flatnonzero(low < np.arange(len(ids)))
            yield record(arrow, ids[low[some]], ids[some])


def _against_pivot(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, id, sketch, share): how near each set of a large node is to the node's pivot."""
    for b in batches:
        share = (_matrix(b.column("sketch")) == _matrix(b.column("pivot_sketch"))).sum(1) / COORDS
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("id"), b.column("sketch"), b.column("pivot"), pa.array(share)], ["node", "id", "sketch", "pivot", "share"])


def _few(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Sends ``df`` to every task if its counted rows are few."""
    return F.broadcast(df) if rows <= most else df


def _sized(rows: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """``rows`` with the size and pivot of their node. Rows of large nodes are not gathered by node, if the large nodes are few."""
    large = sizes.where(F.col("n") > limit)
    if large.count() > FEW:
        return rows.join(sizes, "node")
    rest = rows.join(F.broadcast(large.select("node")), "node", "left_anti").join(sizes.where(F.col("n") <= limit), "node")
    return rest.unionByName(rows.join(F.broadcast(large), "node"))


def _grow(sets: DataFrame, trees: range, small: int) -> tuple[DataFrame, int]:
    """Links that some trees give, and how often their nodes had to be split."""
    grouped, links, limit, depth = [], [], small, 1
    rows = stored(map_arrow(sets.select("id", "sketch"), _split_roots(trees), CHILD), "paths")
    while True:
        sizes = stored(rows.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("pivot")).where("n > 1"), "sizes")
        sized = _sized(rows, sizes, limit)
        full = stored(sized.join(sets.select("id", "sketch"), "id").select("node", "n", "pivot", "id", "sketch"), "nodes")
        grouped.append(full.where(F.col("n") <= limit).select("node", "id", "sketch"))
        large = full.where(F.col("n") > limit)
        pivots = large.where("id = pivot").select(F.col("node").alias("p"), F.col("sketch").alias("pivot_sketch"))
        count = pivots.count()
        if not count:
            break
        near = large.where("id <> pivot").join(_few(pivots, count, SKETCHES), F.col("node") == F.col("p")).select("node", "id", "sketch", "pivot", "pivot_sketch")
        near = stored(map_arrow(near, _against_pivot, "node bigint, id bigint, sketch binary, pivot bigint, share double"), "near")
        links.append(near.where(F.col("share") >= PIVOT).select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        # a node whose sets are all linked to its pivot is one cluster: nothing is left to find in it
        mixed = near.where(F.col("share") < PIVOT).select(F.col("node").alias("m")).distinct()
        left = near.where(F.col("share") < CLOSE).join(mixed, F.col("node") == F.col("m"), "left_semi")
        rows = stored(map_arrow(left.select("node", "id", "sketch"), _split, CHILD), "paths")
        limit, depth = min(2 * limit, LARGEST), depth + 1
    every = reduce(DataFrame.union, grouped).repartition("node").sortWithinPartitions("node", "id")
    return stored(reduce(DataFrame.union, links, map_arrow(every, _brute, LINK)), "links"), depth


def candidate_links(sets: DataFrame, runs: int = RUNS, small: int = SMALL, recall: float = RECALL) -> DataFrame:
    """(a, b) between sets that are likely similar; every similar pair is connected by links, up to the recall."""
    links, done, wanted, deepest = [], 0, runs, 0
    while done < wanted:
        found, depth = _grow(sets, range(done, wanted), small)
        links.append(found)
        deepest = max(deepest, depth)
        done, wanted = wanted, max(wanted, runs_for(deepest, recall))
    return reduce(DataFrame.union, links)


def _set_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(SETS)
    for piece in textops.pieces(batches, "text"):
        h, at = _shingle_sets(piece.column("text"))
        yield record(arrow, piece.column("id"), textops.binaries(h, at))


def _verify(threshold: float):
    """Exact links of each pair of blocks: link counts, and the edges of a spanning forest."""
    per_mille = round(threshold * 1000)

    def overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Shared shingles of each pair, as products of 0/1 matrices over shingles that both sides have."""
        both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)

        def places(sets):
            row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            flat = np.concatenate(sets)
            at = np.minimum(np.searchsorted(both, flat), max(0, len(both) - 1))
            ok = both[at] == flat if len(both) else np.zeros(len(flat), bool)
            return row[ok], at[ok]

        (lr, lc), (rr, rc) = places(left), places(right)
        out = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, len(both), 2048):
            x, y = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
            own, other = (lc >= lo) & (lc < lo + 2048), (rc >= lo) & (rc < lo + 2048)
            x[lr[own], lc[own] - lo] = 1
            y[rr[other], rc[other] - lo] = 1
            out += x @ y.T
        return out

    def repeated(sets: list[np.ndarray]) -> list[np.ndarray]:
        """The sets without shingles that only one of them has."""
        flat = np.concatenate(sets)
        value, count = np.unique(flat, return_counts=True)
        keep = count[np.searchsorted(value, flat)] > 1
        cuts = np.cumsum([len(x) for x in sets])[:-1]
        return [x[k] for x, k in zip(sets, np.split(keep, cuts))]

    def run(batches):
        arrow = to_arrow_schema(FOUND)
        for b in _runs_of(batches, ["cluster", "i", "j"]):
            key = np.stack([b.column(k).to_numpy() for k in ("cluster", "i", "j")])
            bounds = np.append(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0))), b.num_rows)
            ids, copies, block = b.column("id").to_numpy(), b.column("copies").to_numpy(), b.column("block").to_numpy()
            data, at = textops.buffers(b.column("set"))
            data, at = data.view(U64), at // 8
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sets = [data[at[k] : at[k + 1]] for k in range(lo, hi)]
                n = np.diff(at[lo : hi + 1])
                own = block[lo:hi] == key[1, lo]
                if key[1, lo] == key[2, lo]:
                    if hi - lo < 2:
                        continue
                    if hi - lo == 2:
                        inner = np.zeros((2, 2), np.float32)
                        inner[0, 1] = inner[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
                    else:
                        some = repeated(sets)
                        inner = overlap(some, some)
                    a = c = np.arange(hi - lo)
                    np.fill_diagonal(inner, 0)
                else:
                    a, c = np.flatnonzero(own), np.flatnonzero(~own)
                    if not len(a) or not len(c):
                        continue
                    inner = overlap([sets[k] for k in a], [sets[k] for k in c])
                linked = (inner > 0) & (inner * (1000.0 + per_mille) >= per_mille * (n[a][:, None] + n[c][None, :]))
                count = np.zeros(hi - lo, np.int64)
                count[a] += linked @ copies[lo:hi][c]
                if key[1, lo] != key[2, lo]:
                    count[c] += linked.T @ copies[lo:hi][a]
                x, y = np.nonzero(linked)
                low = forest(hi - lo, a[x], c[y])
                some = np.flatnonzero(count)
                yield record(arrow, ids[lo:hi][low[some]], ids[lo:hi][some], count[some])

    return run


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, runs: int = RUNS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(id, class_id, n_links) for each row of ``docs``.

    ``n_links`` counts the other documents whose shingle sets have a Jaccard similarity of ``threshold`` or
    more with it, copies included. ``class_id`` is the lowest id connected to it by links. ``threshold``
    counts in thousandths and must not be under 0.8, which the sampling rates and bounds above are for.
    ``runs`` is the least number of trees.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"threshold must be at least {THRESHOLD}")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    keys = stored(map_arrow(rows, _sketch, KEYS), "keys")
    with_set = keys.where("size > 0 and id is not null")
    sets = stored(with_set.groupBy("k1", "k2", "size").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min("sketch").alias("sketch")), "sets")

    pairs = candidate_links(sets, runs, small)
    clusters = stored(components(pairs, "a", "b").withColumnRenamed("root", "cluster"), "clusters")
    wanted = clusters.join(sets.select("id", "copies"), "id")
    sized = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    wanted = wanted.join(sized, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    wanted = stored(wanted, "wanted")

    needed = rows.join(_few(wanted.select("id"), wanted.count(), FEW), "id", "left_semi")
    texts = map_arrow(needed, _set_rows, SETS)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = wanted.select("cluster", "id", "copies", "block", other.alias("o")).select("cluster", "id", "copies", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    dealt = dealt.join(texts, "id").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id")
    found = stored(map_arrow(dealt, _verify(threshold), FOUND), "found")

    classes = components(found, "a", "b").withColumnRenamed("root", "class_id")
    counts = found.groupBy(F.col("b").alias("id")).agg(F.sum("links").alias("links"))
    linked = sets.select("k1", "k2", "size", "id", "copies").join(counts, "id", "left").join(classes, "id", "left")
    # only sets with copies or links need to find their documents again
    known = stored(linked.where("copies > 1 or links is not null").select("k1", "k2", "size", F.coalesce("class_id", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    out = keys.drop("sketch").join(_few(known, known.count(), FEW), ["k1", "k2", "size"], "left")
    return out.select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
