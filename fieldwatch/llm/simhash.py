"""SimHash near-duplicates by exact comparison of tiles.

Fingerprints are computed where the texts are. Equal fingerprints are one class. Classes are cut into tiles by the number
of set bits; a pair of tiles is compared only if those counts differ by no more than the radius, and inside a pair only the
runs whose counts by 16-bit quarter allow a distance within it. A pair of tiles is one task with at most ``2 * tile`` rows, and
gives a spanning forest of the links it finds, not the links: at most one row a class.

The comparison is exact and so grows with the square of the number of distinct fingerprints, divided by what the counts rule out.

Defined results: null and empty texts have fingerprint 0. A null doc_id takes part; its component is the smallest doc_id that is
not null, else null. Rows that repeat a doc_id are rows of their own. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed
from fieldwatch.llm.graph import components

SEED = 42
STEP = 1 << 16
#: Pairs compared at once.
CELLS = 1 << 21


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = len(words) - shingle + 1
    at, to = starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, STEP):
        part = zip(at[k : k + STEP], to[k : k + STEP], strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in part), ">u8", min(STEP, n - k))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint's 64 bits as a long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, fp long")


class Forest:
    """Labels of 0..n-1; each join of places keeps the smaller label."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(self.label, deeper := self.label[self.label]):
                self.label = deeper


def _runs(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts equal bit counts of the first two quarters together, the runs' bounds, and their counts (first, second, rest)."""
    quarter = np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int64)
    counts = np.stack([quarter[:, 0], quarter[:, 1], quarter[:, 2] + quarter[:, 3]], axis=1)
    order = np.lexsort(counts.T[::-1])
    counts = counts[order]
    new = np.flatnonzero(np.concatenate(([True], (counts[1:] != counts[:-1]).any(axis=1))))
    return order, np.append(new, len(fps)), counts[new]


def compare_tiles(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) of a spanning forest over the links between a and b, or within a. uint64 arrays without repeats."""
    both = a if b is None else np.concatenate([a, b])
    forest = Forest(len(both))
    order_a, cut_a, runs_a = _runs(a)
    order_b, cut_b, runs_b = (order_a, cut_a, runs_a) if b is None else _runs(b)
    base = 0 if b is None else len(a)
    sorted_a, sorted_b = a[order_a], (a if b is None else b)[order_b]
    for i, run in enumerate(runs_a):
        near = np.flatnonzero(np.abs(runs_b - run).sum(axis=1) <= radius)
        if b is None:
            near = near[near >= i]
        if not len(near):
            continue
        places = np.concatenate([np.arange(cut_b[j], cut_b[j + 1]) for j in near])
        theirs = sorted_b[places]
        rows = max(1, CELLS // len(theirs))
        for k in range(cut_a[i], cut_a[i + 1], rows):
            mine = sorted_a[k : min(k + rows, cut_a[i + 1])]
            x, y = np.nonzero(np.bitwise_count(mine[:, None] ^ theirs[None, :]) <= radius)
            if len(x):
                forest.link(order_a[x + k], base + order_b[places[y]])
    moved = np.flatnonzero(forest.label != np.arange(len(both)))
    return both[moved], both[forest.label[moved]]


def links(classes: DataFrame, radius: int = 4, tile: int = 1 << 16) -> DataFrame:
    """(a, b) edges between distinct fingerprints (column fp) that connect all that lie within radius of each other."""
    bits = F.bit_count("fp")
    # 65 counts at most reach the driver
    levels = dict(classes.groupBy(bits.alias("k")).agg(F.count("*").alias("n")).collect())
    split = [max(1, -(-levels.get(k, 0) // tile)) for k in range(65)]
    first = np.concatenate(([0], np.cumsum(split))).tolist()
    low = [first[max(0, k - radius)] for k in range(65)]
    high = [first[min(64, k + radius) + 1] - 1 for k in range(65)]
    empty = [k for k in range(65) if not levels.get(k)]
    pick = lambda values: F.get(F.array(*[F.lit(int(x)) for x in values]), F.col("k"))
    tiles = (
        classes.select("fp", bits.cast("int").alias("k"))
        .select("fp", (pick(first[:65]) + F.pmod(F.xxhash64("fp"), pick(split).cast("long")).cast("int")).alias("t"), pick(low).alias("low"), pick(high).alias("high"))
        .select("fp", "t", F.explode(F.sequence("low", "high")).alias("u"))
    )
    absent = [first[k] for k in empty]
    if absent:
        tiles = tiles.filter(~F.col("u").isin(absent))
    pairs = tiles.select("fp", "t", F.least("t", "u").alias("left"), F.greatest("t", "u").alias("right"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows["left"].iloc[0], rows["right"].iloc[0]
        fps, of = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["t"].to_numpy()
        mine, other = fps[of == left], fps[of == right] if left != right else None
        if not len(mine) or other is not None and not len(other):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        a, b = compare_tiles(mine, other, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.groupBy("left", "right").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, tile: int = 1 << 16, salts: int = 8) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links of at most radius bits reach.

    Shuffled: one row a distinct fingerprint and map task, the tiles, and twice a pair of longs a document.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    classes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = components(links(classes.select("fp"), radius, tile))
    joined = checkpointed(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"))
    least = checkpointed(joined.filter("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least")))
    linked = joined.filter("root IS NOT NULL").join(least, "root").select("fp", F.coalesce("least", "first").alias("component_id"), "first", "n")
    named = linked.unionByName(joined.filter("root IS NULL").select("fp", F.col("first").alias("component_id"), "first", "n"))  # these join nothing
    shared = named.filter("n > 1 OR NOT (component_id <=> first)").select("fp", "component_id", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("salt"))
    salted = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    hexed: Column = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return salted.join(shared, ["fp", "salt"], "left").select("doc_id", hexed.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, radius: int = 4) -> DataFrame:
    """docs without the documents whose component holds a smaller doc_id. Rows without a doc_id stay; rows of one doc_id stay or go together."""
    gone = near_duplicates(docs, radius).filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
