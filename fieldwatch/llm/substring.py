"""Removal of repeated passages, with a count-min sketch in front of exact grouping.

A window is ``width`` consecutive words of one document. Pass one: every task notes in a sketch, for each of its documents, the
cells of the document's window anchors (an anchor is the least hash of the ``inner``-word runs inside a window, so equal
windows have equal anchors and neighbours mostly share one); the tasks' sketches are sent as sorted cell lists and merged by
cell range. A cell counts documents and never too few. Pass two: windows whose cell counts two documents or more, and only
those, are grouped exactly by a 96-bit hash; a window that a smaller doc_id holds is repeated. No repeated window is lost at any
sketch size: a small sketch only lets more windows into pass two.

Windows whose cell counts fewer than ``hot`` documents are shuffled once, sorted, and told apart in one sweep; a key has fewer than
``hot`` documents there (65,535, the sketch's largest count; a sorted task holds many times as many rows). Windows of fuller cells take their least doc_id by a grouped minimum, combined before the shuffle, and a join whose
hot keys adaptive execution splits. Both ways give the same answer.

The merged sketch is two bits a cell (``2 ** sketch_bits`` cells: 64 MB by default, whatever the input), which bounds what the driver
collects and broadcasts. Texts are shuffled once, to meet their removals.

Defined results: a null text has no words. Rows with a null doc_id neither lose nor cause removals. Rows that repeat a doc_id are told
apart by their text; equal rows fare alike and don't repeat each other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed

#: Cells of a sketch group and of a chunk within it; a chunk's cells are kept as 16-bit numbers.
GROUPS, CHUNK_BITS = 64, 16
#: Odd multipliers of the words' hashes, by place in the window, for two independent sums, and for inner runs.
PLACES = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 63, (3, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD = re.compile(rb"[^ \t-\r]+")


class WordHashes(dict):
    """word -> 64-bit hash, remembering a bounded number of words."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = found
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _sums(words: np.ndarray, width: int, row: int) -> np.ndarray:
    """A hash of each run of width words."""
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * PLACES[row, k]
    return _mixed(total)


def window_hashes(words: np.ndarray, width: int, inner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every window, and its anchor."""
    first = _sums(words, width, 0)
    runs = _sums(words, inner, 2)
    anchors = runs[: len(first)].copy()
    for k in range(1, width - inner + 1):
        np.minimum(anchors, runs[k : k + len(first)], out=anchors)
    return first, _sums(_mixed(words), width, 1), anchors


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _cells(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(anchors) >> np.uint64(64 - bits)).astype(np.int64)


def _packed(cells: np.ndarray, base: int, chunks: int) -> bytes:
    """Sorted cells of one group: how many each chunk has, then their low 16 bits."""
    local = cells - base
    counts = np.bincount(local >> CHUNK_BITS, minlength=chunks).astype(np.uint32)
    return counts.tobytes() + (local & 0xFFFF).astype(np.uint16).tobytes()


def _unpacked(data: bytes, chunks: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint32, chunks)
    return (np.repeat(np.arange(chunks, dtype=np.int64), counts) << CHUNK_BITS) + np.frombuffer(data, np.uint16, offset=4 * chunks)


def merged_sketch(docs: DataFrame, width: int, inner: int, bits: int, hot: int) -> np.ndarray:
    """Two bits a cell, in two rows of bytes: at least two, and at least ``hot``, documents have an anchor there."""
    size = (1 << bits) // GROUPS
    chunks = size >> CHUNK_BITS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pending, held = WordHashes(), [], 0
        cells, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def folded() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(pending), return_counts=True) if pending else (cells[:0], counts[:0])
            both, at = np.unique(np.concatenate([cells, new]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)

        for batch in batches:
            for x in batch.column(0):
                words = _encoded(x.as_py()).split()
                if len(words) >= width:
                    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
                    mine = np.unique(_cells(window_hashes(hashes, width, inner)[2], bits))
                    pending.append(mine)
                    held += len(mine)
            if held > 1 << 21:
                cells, counts = folded()
                pending, held = [], 0
        cells, counts = folded()
        often = counts > 1
        bounds = np.arange(GROUPS + 1) * size
        for g in range(GROUPS):
            mine = slice(*np.searchsorted(cells, bounds[g : g + 2]).tolist())
            if mine.start < mine.stop:
                many = often[mine]
                row = (_packed(cells[mine], g * size, chunks), _packed(cells[mine][many], g * size, chunks), np.minimum(counts[mine][many] - 1, 0xFFFF).astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), *(pa.array([r], pa.binary()) for r in row)], names=["g", "cells", "again", "more"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, cells, again, more in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                at = counts.setdefault(g, np.zeros(size, np.uint16))
                for data, n in ((cells, 1), (again, np.frombuffer(more, np.uint16))):
                    places = _unpacked(data, chunks)
                    at[places] = np.minimum(at[places].astype(np.uint32) + n, 0xFFFF)
        for g, at in counts.items():
            planes = [np.packbits(at >= least).tobytes() for least in (2, hot)]
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), *(pa.array([x], pa.binary()) for x in planes)], names=["g", "some", "many"])

    sketches = docs.filter("doc_id IS NOT NULL").select("text").mapInArrow(sketch, "g int, cells binary, again binary, more binary")
    merged = sketches.repartition(GROUPS, "g").mapInArrow(merge, "g int, some binary, many binary")
    out = np.zeros((2, GROUPS, size // 8), np.uint8)
    for g, some, many in merged.toLocalIterator():  # GROUPS rows of a fixed size
        out[0, g], out[1, g] = np.frombuffer(some, np.uint8), np.frombuffer(many, np.uint8)
    return out.reshape(2, -1)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and doc_id: those whose doc_id is above the key's first."""
    key, first = None, 0
    for batch in batches:
        h, k, doc, at, mark = (batch.column(c).to_numpy() for c in range(5))
        if not len(h):
            continue
        new = np.concatenate(([key != (h[0], k[0])], (h[1:] != h[:-1]) | (k[1:] != k[:-1])))
        starts = np.flatnonzero(new)
        firsts = np.concatenate(([first], doc[starts]))[np.cumsum(new)]
        repeated = doc > firsts
        key, first = (h[-1], k[-1]), firsts[-1]
        if repeated.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[repeated]) for x in (doc, mark, at)], names=["doc_id", "mark", "at"])


def repeated_starts(docs: DataFrame, width: int = 13, inner: int = 8, sketch_bits: int = 28, hot: int = 0xFFFF) -> DataFrame:
    """(doc_id, mark, starts): the sorted places of the windows that a document with a smaller doc_id also has. mark: a hash of the text."""
    sketch = docs.sparkSession.sparkContext.broadcast(merged_sketch(docs, width, inner, sketch_bits, hot))
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.hash("text").alias("mark"), "text")

    def suspects(fuller: bool):
        """The windows of cells with two documents or more, either below or from the hot count on."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache, (some, many) = WordHashes(), sketch.value
            names = ["h", "k", "doc_id", "at", "mark"]

            def flushed(parts: list) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[j] for p in parts])) for j in range(5)], names=names)

            for batch in batches:
                parts, held = [], 0
                for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    words = _encoded(text.as_py()).split()
                    if len(words) < width:
                        continue
                    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
                    h, k, anchors = window_hashes(hashes, width, inner)
                    cells = _cells(anchors, sketch_bits)
                    byte, bit = cells >> 3, (128 >> (cells & 7)).astype(np.uint8)
                    at = np.flatnonzero(many[byte] & bit if fuller else some[byte] & ~many[byte] & bit)
                    if len(at):
                        parts.append((h[at].view(np.int64), (k[at] >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(at), doc_id, np.int64), at.astype(np.int32), np.full(len(at), mark, np.int32)))
                        held += len(at)
                    if held > 1 << 18:
                        yield flushed(parts)
                        parts, held = [], 0
                if parts:
                    yield flushed(parts)

        return rows.mapInArrow(each, "h long, k int, doc_id long, at int, mark int")

    later = suspects(fuller=False).repartition("h").sortWithinPartitions("h", "k", "doc_id").mapInArrow(_later, "doc_id long, mark int, at int")
    if sketch.value[1].any():
        windows = suspects(fuller=True)
        first = windows.groupBy("h", "k").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
        first = checkpointed(first.select("h", "k", "first"))  # its own exchange, so that a hot window's rows can be split
        later = later.unionByName(windows.join(first, ["h", "k"]).filter("doc_id > first").select("doc_id", "mark", "at"))
    return later.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("at")).alias("starts"))


def _covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """True for each of n words that a window from starts covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def _with_starts(docs: DataFrame, width: int, **options: int) -> DataFrame:
    starts = repeated_starts(docs, width, **options).withColumnsRenamed({"doc_id": "__id", "mark": "__mark", "starts": "__starts"})
    return docs.join(starts, (docs["doc_id"].cast("long") == F.col("__id")) & (F.hash(docs["text"]) == F.col("__mark")), "left").drop("__id", "__mark")


def removal_report(docs: DataFrame, width: int = 13, **options: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256, of the kept words joined by one space."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts in zip(batch.column(1), batch.column(2), strict=True):
                words = _encoded(text.as_py()).split()
                n, gone = len(words), 0
                if starts.is_valid:
                    drop = _covered(starts.values.to_numpy(), n, width)
                    gone = int(drop.sum())
                    words = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
                rows.append((n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = _with_starts(docs.select("doc_id", "text"), width, **options).select(F.col("doc_id").cast("long"), "text", "__starts")
    return joined.mapInArrow(report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = 13, **options: int) -> DataFrame:
    """docs with repeated words, and the white space after them, cut from text; n_chars, where there is one, follows. A text that loses nothing stays as it is."""

    def cut(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, starts in texts:
            out = []
            for t, s in zip(text, starts, strict=True):
                if t is None or s is None:
                    out.append(t)
                    continue
                data = _encoded(t)
                spans = [m.span() for m in WORD.finditer(data)]
                drop = _covered(np.asarray(s), len(spans), width).tolist()
                ends = [*(a for a, _ in spans[1:]), len(data)]
                kept = b"".join(data[a:b] for (a, _), b, d in zip(spans, ends, drop, strict=True) if not d)
                out.append((data[: spans[0][0]] + kept).decode("utf-8", "surrogatepass").rstrip(" \t\n\r\x0b\x0c"))
            yield pd.Series(out, dtype=object)

    shortened = F.pandas_udf(cut, "string")
    joined = _with_starts(docs, width, **options).withColumn("text", F.when(F.col("__starts").isNull(), F.col("text")).otherwise(shortened("text", "__starts")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("__starts").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return joined.select(docs.columns)
