"""The best few of many rows for each query, found tile by tile: a block of queries against a block of rows, both of bounded size, in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows and queries of a tile, and how many scores of it are held at a time.
DATA_BLOCK, QUERY_BLOCK, HELD = 32_768, 4096, 1 << 22


def blocks(count: int, size: int) -> int:
    return max(1, -(-count // size))


def every(count: int) -> Column:
    """A row for each block's number."""
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def block_of(count: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(count)).cast("int")


def first_k(query: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k highest scores, equal ones by tie; a score that is not a number stands before all others, as Spark sorts."""
    order = np.lexsort((tie, -np.where(np.isnan(score), np.inf, score), query))
    ordered = query[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]


def similar(tile: pd.DataFrame, k: int, threshold: float) -> pd.DataFrame:
    """query_id, vec_id, cosine of unit vectors v: each asking row's k best of the others with another id, none below the threshold.

    A matrix product says which pairs can be among them; their cosines are then added up in the order of the components, so that equal vectors get equal ones.
    """
    asks = tile["asks"].to_numpy(bool)
    ids = tile["id"].to_numpy()
    if not asks.any() or asks.all():
        return pd.DataFrame({"query_id": ids[:0], "vec_id": ids[:0], "cosine": np.empty(0)})
    codes, vectors = pd.factorize(ids)[0], np.stack(tile["v"].to_list()).astype(np.float64) + 0.0
    places = np.flatnonzero(~asks)
    places = places[np.argsort(ids[places], kind="stable")]
    alike = pd.factorize(np.array([v.tobytes() for v in vectors[places]], dtype=object))[0]
    spare = int(np.bincount(codes[places]).max())  # the query's own rows may be among the copies
    places = places[pd.Series(alike).groupby(alike).cumcount().to_numpy() < k + spare]
    asking, data, least = np.flatnonzero(asks), vectors[places], threshold - 1e-9
    found = []
    step = max(1, HELD // len(places))
    for begin in range(0, len(asking), step):
        mine = asking[begin : begin + step]
        scores = vectors[mine] @ data.T
        scores[np.isnan(scores)] = np.inf
        scores[codes[mine][:, None] == codes[places][None, :]] = -np.inf
        live = np.flatnonzero((scores >= least).any(axis=1))
        scores = scores[live]
        worst = np.partition(scores, -k, axis=1)[:, -k] - 1e-9 if len(places) > k else np.full(len(live), least)
        q, d = np.nonzero(scores >= np.maximum(worst, least)[:, None])
        q = mine[live[q]]
        cosine = np.zeros(len(q))
        for c in range(vectors.shape[1]):
            cosine += vectors[q, c] * data[d, c]
        good = np.flatnonzero(~(cosine < threshold))
        good = good[first_k(q[good], cosine[good], d[good], k)]
        found.append((ids[q[good]], ids[places[d[good]]], cosine[good]))
    return pd.DataFrame({name: np.concatenate(part) for name, part in zip(("query_id", "vec_id", "cosine"), zip(*found, strict=True), strict=True)})


def matching(tile: pd.DataFrame, k: int, threshold: float) -> pd.DataFrame:
    """question, text, first, cosine of sparse vectors (dims, values): each asking row's k best of the texts that share a dimension with it, by the cosine at six places, then by first."""
    asks = tile["asks"].to_numpy(bool)
    names, data = ["question", "text", "first", "cosine"], tile[~asks]
    empty = pd.DataFrame({c: np.empty(0, object if c != "cosine" else float) for c in names})
    if not asks.any() or data.empty:
        return empty
    flat = lambda rows: (np.repeat(np.arange(len(rows)), rows["dims"].map(len)), np.concatenate(rows["dims"].to_list()), np.concatenate(rows["vals"].to_list()))
    norms = lambda row, value, n: np.sqrt(np.bincount(row, value * value, n))
    q_row, q_dim, q_value = flat(tile[asks])
    d_row, d_dim, d_value = flat(data)
    n_asks, dims = int(asks.sum()), np.unique(q_dim)
    weights = np.zeros((len(dims), n_asks))
    weights[np.searchsorted(dims, q_dim), q_row] = q_value
    weights /= norms(q_row, q_value, n_asks)
    d_value = d_value / norms(d_row, d_value, len(data))[d_row]
    place = np.minimum(np.searchsorted(dims, d_dim), len(dims) - 1)
    met = dims[place] == d_dim
    d_row, place, d_value = d_row[met], place[met], d_value[met]
    tie = np.empty(len(data), np.int64)
    tie[np.argsort(data["first"].to_numpy(), kind="stable")] = np.arange(len(data))
    found = []
    step = max(1, HELD // max(len(dims), n_asks))
    for begin in range(0, len(data), step):
        own = slice(*np.searchsorted(d_row, (begin, begin + step)))
        part = np.zeros((min(step, len(data) - begin), len(dims)))
        part[d_row[own] - begin, place[own]] = d_value[own]
        dots = (part @ weights).T
        cosines = np.where(dots > 0, np.floor(dots * 1e6 + 0.5) / 1e6, -np.inf)
        worst = np.partition(cosines, -k, axis=1)[:, -k] if cosines.shape[1] > k else np.full(n_asks, -np.inf)
        q, d = np.nonzero((cosines >= np.maximum(worst, threshold)[:, None]) & (dots > 0))
        best = first_k(q, cosines[q, d], tie[begin + d], k)
        found.append((q[best], begin + d[best], cosines[q[best], d[best]]))
    q, d, cosine = map(np.concatenate, zip(*found, strict=True))
    best = first_k(q, cosine, tie[d], k)
    asking, text = tile[asks]["key"].to_numpy(), data["key"].to_numpy()
    return pd.DataFrame({"question": asking[q[best]], "text": text[d[best]], "first": data["first"].to_numpy()[d[best]], "cosine": cosine[best]})
