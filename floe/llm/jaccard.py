"""Similarity join of documents by word n-grams, over R-trees of count vectors.

A document's set holds its distinct n-word shingles (with fewer words the whole sequence
is one). Two documents link when 100 * intersection >= percent * union.

1. Equal sets collapse into one class first (two 64-bit sums of hashed shingles and the
   size), so copies are never compared and a class that a third of all rows share is one row.
2. Shingles are hashed into groups. The numbers of a set's shingles per group are a point;
   the shared shingles of two sets are at most the sum of the smaller coordinates. Large sets
   have more groups, so that a group holds few shingles at every size (beyond 4,096 groups, at
   32,768 shingles, it holds more and the bound is less sharp). A vector folds to fewer groups
   by adding, so sets of different size are compared in the groups of the smaller.
3. To index only points that can meet, a set's shingles are also split into cells, a few more
   than D + 1, D being the most shingles in which linked sets of that size can differ. If one
   of two linked sets fills D + 1 cells, they agree on all shingles of one of these
   (pigeonhole), so they share that cell's sum. A set that fills fewer takes its empty cells
   too: of two such sets any cell of at least D + 1 can be the one they agree on. Sizes are
   cut into bands; a set is celled for its own band, and for the next smaller one if its
   partners may lie there.
4. Within a cell that two classes share, points are packed into an R-tree, which is
   searched with the bound; small cells are one leaf. In larger ones each member is first
   paired with one smallest id only; after these links are verified, members that did not
   join the first of their cell search the tree, twice for the one with most room, then for
   all that are not yet in their component. Members already joined need no further link.
5. Pairs are verified on whole sets by exact intersection (48-bit hashes); components are
   taken over the links.

Defined cases: null texts and texts without words have an empty set, link with nothing and
are their own component; repeated rows have equal sets and share a component; rows with a
null id are returned with null component and take no part. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import bounded_batches, components, flat, free, lists, sliced, stored, trim
from floe.llm.rolling import is_space, mix, prefix_sums, span_hashes, word_hashes, word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
GROUPS, MOST_GROUPS, PER_GROUP = 256, 4096, 8
FULL = 255  # a count of this or more is kept as this and bounds nothing
LEAF = 8
BLOCK = 5_000
TURN_SHARE, TURN_BYTES = 1.0, 256 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and the number of each text."""
    data = _LOWER[data]
    starts, ends = word_spans(data)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = np.unique(cut[~is_space(data[cut]) & ~is_space(data[cut - 1])]) if len(cut) else cut
    starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    texts = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    words = word_hashes(data, starts, ends)
    owner = np.searchsorted(offsets, starts, "right") - 1
    per = np.bincount(owner, minlength=texts)
    begin = np.cumsum(per) - per
    count = np.where(per >= n, per - n + 1, (per > 0).astype(np.int64))
    shingle_of = np.repeat(np.arange(texts), count)
    first = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    last = np.minimum(first + n, (begin + per)[shingle_of])
    hashes = span_hashes(prefix_sums(words), first, last)
    order = np.lexsort((hashes, shingle_of))
    hashes, shingle_of = hashes[order], shingle_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (shingle_of[1:] != shingle_of[:-1])
    return hashes[new], np.bincount(shingle_of[new], minlength=texts)


class Bands:
    """Size bands: small sizes have their own, further ones grow by the widest ratio that linked sets can have."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, 100 * edges[-1] // percent + 1))
        self.edges = np.array(edges, np.int64)
        band = np.arange(len(edges) - 1)
        need, smallest = self.needed(band).astype(float), self.low(band).astype(float)
        cells = need
        for _ in range(50):  # so many that a set fills the needed ones but for two deviations
            empty = np.exp(-smallest / cells)
            cells = np.minimum(np.maximum(need, np.where(need > 1, (need + 2 * np.sqrt(cells * empty * (1 - empty))) / (1 - empty), 1)), smallest)
        self.splits = np.maximum(np.ceil(cells), need).astype(np.int64)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, np.maximum(size, 1), "right") - 1

    def low(self, band: np.ndarray) -> np.ndarray:
        return self.edges[band]

    def high(self, band: np.ndarray) -> np.ndarray:
        return self.edges[band + 1] - 1

    def cells(self, band: np.ndarray) -> np.ndarray:
        """Into how many cells sets are split for a band."""
        return self.splits[band]

    def needed(self, band: np.ndarray) -> np.ndarray:
        """One more than the shingles in which a set of the band and a linked one that is no smaller can differ.

        With sizes a <= b <= 100a/p and at least p(a + b)/(100 + p) shared, the difference a + b - 2 * shared
        is at most (a + b)(100 - p)/(100 + p), which grows with both sizes.
        """
        a = self.high(band)
        return (a + 100 * a // self.percent) * (100 - self.percent) // (100 + self.percent) + 1


def groups_of(size: np.ndarray) -> np.ndarray:
    """Into how many groups sets of these sizes are counted: a power of two that leaves few shingles in one."""
    wanted = np.maximum(size, 1) / (GROUPS * PER_GROUP)
    return np.minimum(GROUPS << np.ceil(np.log2(np.maximum(wanted, 1))).astype(np.int64), MOST_GROUPS)


def _points(sets: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Count vectors: how many shingles of each set fall in each group, a byte each."""
    groups = groups_of(size)
    begin = np.cumsum(groups) - groups
    text = np.repeat(np.arange(len(size)), size)
    group = (mix(sets + np.uint64(0x77)) >> np.uint64(30)) % groups[text].astype(np.uint64)
    counts = np.bincount(begin[text] + group.astype(np.int64), minlength=int(groups.sum()))
    raw = np.minimum(counts, FULL).astype(np.uint8).tobytes()
    return [raw[b : b + g] for b, g in zip(begin.tolist(), groups.tolist())]


def _folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points (a row each) in fewer groups. A full count stays above every sum of others that matters."""
    opened = np.where(points == FULL, np.uint32(1 << 20), points).astype(np.uint32)
    return opened if opened.shape[1] == groups else opened.reshape(len(points), -1, groups).sum(1, dtype=np.uint32)


def _alike(points: list[bytes]) -> np.ndarray:
    """Points of several sizes as the rows of one table, in the groups of the smallest."""
    lengths = np.array([len(p) for p in points])
    fewest = int(lengths.min())
    out = np.zeros((len(points), fewest), np.uint32)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for start in range(0, len(rows), 500):
            some = rows[start : start + 500]
            out[some] = _folded(np.frombuffer(b"".join(points[i] for i in some), np.uint8).reshape(-1, length), fewest)
    return out


def set_cells(sets: np.ndarray, size: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The cells of every set (flat) and the set of each: for its own band and the smaller ones its partners may be in."""
    text = np.repeat(np.arange(len(size)), size)
    band, active = bands.of(size), size > 0
    scattered, part = mix(sets + np.uint64(0x9E37)) >> np.uint64(20), mix(sets ^ np.uint64(0x3C3C))
    where, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    while active.any():
        split = bands.cells(np.maximum(band, 0))
        chosen = active[text]
        t = text[chosen]
        slot = (scattered[chosen] % split[t].astype(np.uint64)).astype(np.int64)
        base = np.cumsum(np.where(active, split, 0)) - np.where(active, split, 0)
        total = np.zeros(int(np.where(active, split, 0).sum()), np.uint64)
        np.add.at(total, base[t] + slot, part[chosen])
        owner = np.repeat(np.flatnonzero(active), split[active])
        filled = np.zeros(len(total), bool)
        filled[base[t] + slot] = True
        enough = np.bincount(owner[filled], minlength=len(size)) >= bands.needed(np.maximum(band, 0))
        taken = filled | ~enough[owner]
        number = np.arange(len(total)) - base[owner]
        total, owner, number = total[taken], owner[taken], number[taken]
        keys.append(mix(total + mix(number.astype(np.uint64) * np.uint64(0x1003F) + band[owner].astype(np.uint64) * np.uint64(0x10000001B3))))
        where.append(owner)
        band = band - 1
        active = active & (band >= 0) & (100 * bands.high(np.maximum(band, 0)) >= bands.percent * size)
    return np.concatenate(keys), np.concatenate(where)


def _set_rows(bands: Bands, n: int):
    """Per document: size, two sums that name the set, its point, and the cells it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets, size = shingle_sets(*flat(batch.column("text")), n)
            full = np.flatnonzero(size)
            begin = np.cumsum(size) - size
            one, two = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            if len(full):
                one[full] = np.add.reduceat(mix(sets ^ np.uint64(0x51)), begin[full])
                two[full] = np.add.reduceat(mix(sets ^ np.uint64(0xA7)), begin[full])
            keys, where = set_cells(sets, size, bands)
            order = np.argsort(where, kind="stable")
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array(size, pa.int64()), "one": pa.array(one.view(np.int64)), "two": pa.array(two.view(np.int64)),
                "point": pa.array(_points(sets, size), pa.binary()),
                "cells": lists(keys[order].view(np.int64), np.bincount(where, minlength=len(size)), pa.int64()),
            })

    return run


def _packed_sets(n: int):
    """Per document its set as sorted 48-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets, size = shingle_sets(*flat(batch.column("text")), n)
            raw = np.ascontiguousarray((sets >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
            ends = np.cumsum(size) * 6
            yield pa.record_batch({"id": batch.column("doc_id"), "hashes": pa.array([raw[e - 6 * s : e] for e, s in zip(ends, size)], pa.binary()), "bytes": pa.array(size * 6, pa.int64())})

    return run


def _opened(raw: bytes | np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


class RTree:
    """Points packed level by level after sorting by size and their widest coordinates. A node keeps the largest
    coordinates and the smallest and largest size below it.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF):
        wide = np.argsort(-(points.max(0).astype(np.int64) - points.min(0)), kind="stable")[:2]
        self.order = np.lexsort((points[:, wide[1]], points[:, wide[0]], sizes))
        self.leaf = leaf
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            top, low, high = self.levels[-1]
            cut = np.arange(0, len(top), leaf)
            self.levels.append((np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows that can still be linked: the sum of smaller coordinates bounds what is shared."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = (x[at] for x in self.levels[depth])
            shared = np.minimum(np.minimum(top, point).sum(1, dtype=np.int64), np.minimum(high, size))
            fits = (shared * (100 + percent) >= percent * (size + low)) & (low * percent <= 100 * size) & (100 * high >= percent * size)
            at = at[fits]
            if depth:
                at = (at[:, None] * self.leaf + np.arange(self.leaf)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def _runs(keys: np.ndarray) -> np.ndarray:
    """Borders of runs of equal values."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (cell, id) sorted by cell those whose cell has more than one, as a stream: one row is held back."""
    last, before = None, None  # the row held back and the cell of the row in front of it
    for batch in batches:
        cell, ids = batch.column("cell").to_numpy(), batch.column("id").to_numpy()
        if not len(cell):
            continue
        if last is not None:
            cell, ids = np.concatenate(([last[0]], cell)), np.concatenate(([last[1]], ids))
        same = cell[1:] == cell[:-1]
        twin = np.zeros(len(cell), bool)
        twin[1:] |= same
        twin[:-1] |= same
        twin[0] |= before is not None and before == cell[0]
        if len(cell) > 1:
            yield pa.record_batch({"cell": pa.array(cell[:-1][twin[:-1]]), "id": pa.array(ids[:-1][twin[:-1]])})
            before = cell[-2]
        last = (cell[-1], ids[-1])
    if last is not None and before is not None and before == last[0]:
        yield pa.record_batch({"cell": pa.array([last[0]], pa.int64()), "id": pa.array([last[1]], pa.int64())})


def _tree_pairs(percent: int, best: bool):
    """Pairs of an asking member with members of other components, where their points leave room for a link.

    With ``best`` each asks for one only, the one with most room.
    """

    def run(key, frame):
        import pandas as pd

        frame = frame.sort_values("id")
        points = _alike(frame["point"].tolist())
        sizes, ids, label = (frame[c].to_numpy() for c in ("size", "id", "label"))
        members = np.flatnonzero(frame["home"].to_numpy())
        tree = RTree(points[members], sizes[members])
        asker, other, room = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(frame["asks"].to_numpy()):
            j = members[tree.search(points[i], sizes[i], percent)]
            j = j[label[j] != label[i]]
            shared = np.minimum(points[j], points[i]).sum(1, dtype=np.int64)
            if best and len(j):
                top = (shared / (sizes[j] + sizes[i])).argmax()
                j, shared = j[top : top + 1], shared[top : top + 1]
            asker.append(np.full(len(j), ids[i]))
            other.append(ids[j])
            room.append(shared)
        if len(sizes) > 1000:
            trim()
        return pd.DataFrame({"id": np.concatenate(asker), "other": np.concatenate(other), "room": np.concatenate(room)})

    return run


def _roomy(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose points leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                (x, x_at), (y, y_at) = flat(batch.column("point_a")), flat(batch.column("point_b"))
                size = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
                shared, shape = np.zeros(batch.num_rows, np.int64), np.stack((np.diff(x_at), np.diff(y_at)))
                for one, two in np.unique(shape, axis=1).T.tolist():
                    rows = np.flatnonzero((shape[0] == one) & (shape[1] == two))
                    for some in np.array_split(rows, max(1, len(rows) * max(one, two) >> 19)):
                        left, right = (_folded(z[at[some, None] + np.arange(wide)], min(one, two)) for z, at, wide in ((x, x_at, one), (y, y_at, two)))
                        shared[some] = np.minimum(left, right).sum(1, dtype=np.int64)
                fits = shared * (100 + percent) >= percent * size
                yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    side = lambda name: points.select(F.col("id").alias(name), F.col("size").alias(f"size_{name}"), F.col("point").alias(f"point_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "point_a", "point_b").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose sets are linked, stored. Only sets that stand in a pair are made and moved.

    A pair carries its sets to where they are compared. What all pairs would carry together can be many times the
    sets themselves, so they go in turns, a grid over the hashes of both ids; a turn moves about as much as all sets hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the sets are read in place, two at a time
            (x, x_at), (y, y_at) = flat(batch.column("set_a")), flat(batch.column("set_b"))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                both = np.concatenate((_opened(x[x_at[i] : x_at[i + 1]]), _opened(y[y_at[i] : y_at[i + 1]])))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(both) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    spark = pairs.sparkSession
    # a stored table has a known size, so a short list of ids is broadcast and the texts stay where they are
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    sets = texts.join(wanted, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"])
    sets = stored(sets.mapInArrow(_packed_sets(n), "id bigint, hashes binary, bytes bigint"), "hashes")
    sizes = sets.select("id", "bytes")
    each = lambda c: pairs.join(sizes.withColumnRenamed("id", c), c).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    whole = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    side = max(1, math.ceil(math.sqrt((each("a") + each("b")) / max(whole * TURN_SHARE, TURN_BYTES))))
    at = lambda c: F.pmod(F.xxhash64(F.lit(3), c), F.lit(side))
    found = []
    for i in range(side):
        for j in range(side):
            of = lambda name, k: sets.filter(at("id") == k).select(F.col("id").alias(name), F.col("hashes").alias(f"set_{name}"))
            opened = pairs.filter((at("a") == i) & (at("b") == j)).join(of("b", j), "b").join(of("a", i), "a")
            found.append(stored(opened.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint"), "links"))
            free(spark)
    links = stored(reduce(DataFrame.unionByName, found), "links") if side > 1 else found[0]
    free(spark, wanted, sets)
    return links


def similar(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    bounded_batches(docs.sparkSession)
    bands = Bands(percent)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    celled = stored(ids.mapInArrow(_set_rows(bands, n), "doc_id bigint, n_shingles bigint, one bigint, two bigint, point binary, cells array<bigint>"), "sets")
    known = stored(celled.drop("cells"), "names")
    spark = docs.sparkSession
    name = ["n_shingles", "one", "two"]
    classes = known.filter("n_shingles > 0 and doc_id is not null").groupBy(*name).agg(F.min("doc_id").alias("rep"))
    # copies that stand for no class are fewer than the rest: they are looked up, so that cells are moved once
    copies = stored(known.select("doc_id").distinct().join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_anti"), "copies")
    reps = celled.filter("n_shingles > 0 and doc_id is not null").join(copies, "doc_id", "left_anti")
    rows = reps.select(F.explode("cells").alias("cell"), F.col("doc_id").alias("id"))
    shared = stored(rows.repartition("cell").sortWithinPartitions("cell", "id").mapInArrow(_shared_cells, "cell bigint, id bigint"), "cells").distinct()
    free(spark, celled)  # the cells of all documents are by far the largest table, and only shared ones are needed from here on
    points = known.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), "point").filter("size > 0").dropDuplicates(["id"])
    counted = shared.groupBy("cell").agg(F.count("*").alias("members"), F.min("id").alias("first"))

    # small cells are leaves; in larger ones everyone is compared with the first member
    small = shared.join(counted.filter(F.col("members").between(2, LEAF)).select("cell"), "cell", "left_semi")
    leaves = small.groupBy("cell").agg(F.sort_array(F.collect_list("id")).alias("m"))
    each = f"flatten(transform(m, (x, i) -> transform(slice(m, i + 2, {LEAF}), y -> named_struct('a', x, 'b', y))))"
    leaves = leaves.select(F.explode(F.expr(each)).alias("p")).select("p.a", "p.b")
    large = stored(shared.join(counted.filter(F.col("members") > LEAF), "cell"), "large")
    stars = large.filter("id <> first").groupBy("id").agg(F.min("first").alias("a")).select("a", F.col("id").alias("b"))
    # a pair meets in many cells: it is made distinct before its points are looked at
    tried = stored(leaves.unionByName(stars).distinct(), "tried")
    pairs = stored(_roomy(tried, points, percent), "pairs")
    free(spark)
    links = _verified(pairs, ids, n, percent)
    nodes = stored(components(links), "nodes")
    pairs = tried
    free(spark)  # what the star and leaf rounds shuffled

    # members of large cells that are not joined to the first one ask the tree: twice each for the likeliest partner in
    # its largest cell, so that groups of near copies grow together at a row per member, then for all that are left
    for best in (True, True, False):
        label = nodes.select(F.col("node").alias("id"), F.col("component").alias("label"))
        labelled = large.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
        lead = labelled.filter("id = first").select("cell", F.col("label").alias("lead"))
        marked = stored(labelled.join(lead, "cell").withColumn("asks", F.col("label") != F.col("lead")), "asking")
        asking = marked.filter("asks")
        if best:
            asking = asking.groupBy("id").agg(F.max(F.struct("members", "cell")).alias("m")).select("id", F.col("m.cell").alias("cell"))
        asking = asking.select(F.col("id").alias("asker"), F.col("cell").alias("asked")).distinct()
        if asking.isEmpty():
            break
        open_cells = asking.select(F.col("asked").alias("cell")).distinct()
        todo = marked.join(open_cells, "cell").join(asking, (F.col("id") == F.col("asker")) & (F.col("cell") == F.col("asked")), "left").withColumn("asks", F.col("asker").isNotNull())
        # a cell is dealt out in blocks of members; each meets each block of askers, so a group holds two blocks at most
        todo = todo.join(points, "id").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        todo = todo.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        as_member = "transform(sequence(0, blocks - 1), i -> named_struct('asker', i, 'block', own))"
        as_asker = "transform(sequence(0, blocks - 1), i -> named_struct('asker', own, 'block', i))"
        meets = F.expr(f"array_distinct(concat({as_member}, case when asks then {as_asker} else array() end))")
        visits = todo.select("cell", "id", "label", "size", "point", "asks", "own", F.explode(meets).alias("m")).select(
            "cell", "id", "label", "size", "point", "m.*", (F.col("asks") & (F.col("m.asker") == F.col("own"))).alias("asks"), (F.col("m.block") == F.col("own")).alias("home")
        )
        found = visits.groupBy("cell", "asker", "block").applyInPandas(_tree_pairs(percent, best), "id bigint, other bigint, room bigint")
        if best:
            found = found.groupBy("id").agg(F.max(F.struct("room", "other")).alias("m")).select("id", F.col("m.other").alias("other"))
        more = found.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        more = stored(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
        pairs = pairs.unionByName(more)
        free(spark, marked, nodes)  # with the files of this round's shuffles
        links = links.unionByName(_verified(more, ids, n, percent))
        nodes = stored(components(links), "nodes")
        free(spark)
    component = nodes.select(F.col("node").alias("rep"), "component")
    named = classes.join(component, "rep", "left").select(*name, F.coalesce("component", "rep").alias("component_id"))
    placed = known.select("doc_id", *name).join(named, name, "left")
    return placed.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns unchanged, that are the smallest id of their component; of rows equal in id and text one stays.

    Documents without an id or without words are in no group and stay.
    """
    kept = similar(docs, n, percent).filter("component_id is null or component_id = doc_id").select(F.col("doc_id").alias("kept")).distinct()
    same = "_".join(["same", *docs.columns])  # no column has this name
    marked = docs.withColumn(same, F.xxhash64("text"))
    stay = marked.join(kept, marked["doc_id"].eqNullSafe(kept["kept"]), "left_semi")
    return stay.dropDuplicates(["doc_id", same]).drop(same)
