"""Byte-level BPE of whole texts by overlapping chunks.

A long text is cut into chunks of ``chunk`` characters that overlap; tasks split the chunks into pre-tokens independently, each from
its own first character. Chunks are then stitched: the pattern looks at nothing before a pre-token, so once a boundary of the next chunk
meets one of the text so far, all that follow agree, and the next chunk takes over there. Boundaries next to a chunk's cut
end are not trusted. Where no boundary meets within the overlap, the text is split on from the last trusted one, which is always right.
Pieces are encoded one by one; decoding joins the ids' bytes. Texts of at most a chunk need no stitching and no shuffle.

Defined results: a null or empty text has no ids. Null and repeated doc_ids are carried along.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces(dict):
    """piece -> its ids as little-endian 32-bit integers, remembering a bounded number of short pieces."""

    LIMIT, LONG = 200_000, 64

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        found = np.asarray(self.encoding.encode_ordinary(piece), "<u4").tobytes()
        if len(self) < self.LIMIT and len(piece) <= self.LONG:
            self[piece] = found
        return found

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_made: dict[tuple[str, str], Pieces] = {}


def pieces_for(ranks_path: str, pattern: str) -> Pieces:
    """One a Python worker."""
    key = (ranks_path, pattern)
    if key not in _made:
        _made[key] = Pieces(ranks_path, pattern)
    return _made[key]


def boundaries(pieces: list[str]) -> np.ndarray:
    return np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))


def stitch(text: str, starts: list[int], bounds: list[np.ndarray], ends: list[int], split) -> np.ndarray:
    """The whole text's boundaries from those of its chunks (positions in the text, ends of pre-tokens), in order."""
    out, reached = [], 0
    for k, (start, end) in enumerate(zip(starts, ends, strict=True)):
        last = k == len(starts) - 1
        mine = bounds[k]
        # white space before the cut may be split otherwise when more text follows, so the two boundaries next to it don't count
        trusted = mine if last else mine[: max(0, np.searchsorted(mine, end) - 2)]
        if k and reached != start:
            met = np.intersect1d(out[-1][-4096:] if out else np.empty(0, np.int64), mine, assume_unique=True)
            if len(met):
                at = int(met[0])
                out[-1] = out[-1][: np.searchsorted(out[-1], at, side="right")]
                trusted, reached = trusted[trusted > at], at
            else:
                again = reached + boundaries(split(text[reached:end]))
                trusted = again if last else again[: max(0, len(again) - 2)]
        if len(trusted):
            out.append(trusted)
            reached = int(trusted[-1])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _digests(pieces: Pieces, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(pieces.decode(ids)).hexdigest()


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = 1 << 16, overlap: int = 1 << 12) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit integers) and decoded_sha256."""
    size = F.length(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_for(ranks_path, pattern)
        for batch in batches:
            found = [_digests(pieces, pieces.encode(pieces.split(x.as_py() or ""))) for x in batch.column(1)]
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def pretokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_for(ranks_path, pattern)
        for batch in batches:
            ends = [boundaries(pieces.split(x.as_py())).astype(np.int32).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], names=["uid", "doc_id", "k", "part", "ends"])

    def stitched(group: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces_for(ranks_path, pattern)
        group = group.sort_values("k")
        parts = group["part"].tolist()
        starts = [k * chunk for k in range(len(parts))]
        text = "".join([*(p[:chunk] for p in parts[:-1]), parts[-1]])
        bounds = [start + np.frombuffer(e, np.int32).astype(np.int64) for start, e in zip(starts, group["ends"], strict=True)]
        cuts = stitch(text, starts, bounds, [s + len(p) for s, p in zip(starts, parts, strict=True)], pieces.split).tolist()
        ids = pieces.encode([text[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)])
        return pd.DataFrame([(group["doc_id"].iloc[0], *_digests(pieces, ids))], columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})

    step = F.lit(chunk)
    n_chunks = F.greatest(F.lit(1), F.ceil((size - overlap) / step)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda k: F.substring(F.col("text"), k * step + 1, F.when(k == n_chunks - 1, size).otherwise(chunk + overlap)))
    long_rows = rows.filter(size > chunk + overlap).withColumn("uid", F.monotonically_increasing_id()).select("uid", "doc_id", F.posexplode(parts).alias("k", "part"))
    spread = long_rows.repartition("uid", "k").mapInArrow(pretokenised, "uid long, doc_id long, k int, part string, ends binary")
    of_long = spread.groupBy("uid").applyInPandas(stitched, SCHEMA)
    return rows.filter(size <= chunk + overlap).mapInArrow(short, SCHEMA).unionByName(of_long)
