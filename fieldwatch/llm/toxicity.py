"""Toxicity scores by the nearest labelled examples, exact TF-IDF cosine over a block-max inverted index.

Labels are learnt from rows whose crc32(doc_id) mod 5 isn't 0, at most ``max_examples`` of them (those with the smallest hashes), which bounds
the index. Terms are words and word beginnings; of those the examples hold, the ``max_terms`` that toxic ones hold most significantly more often
span the vectors. Their document frequencies are counted over all documents.

The index keeps, for each term, its postings by block of examples and each block's largest weight. A text's blocks are visited by falling upper bound until
that falls below the k-th best similarity, so the neighbours are the exact k nearest. Their votes, weighted by similarity and shrunk to the
examples' base rate, are calibrated by a logistic fit on the examples, each scored without itself. Texts without any term get the rate of such examples.

Defined results: null and empty texts have no terms. held_out is false for a null doc_id. Unlabelled and null-labelled rows teach nothing; several labels
of one doc_id count as their largest. Without toxic examples all scores are 0. Equal similarities are taken in the order of the examples' doc_ids.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
STARTS = (4, 5, 6)
BLOCK = 64


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STARTS if len(word) >= n)]


class TermIds(dict):
    """word -> ids of its terms among the chosen, remembering a bounded number of words."""

    LIMIT = 300_000

    def __init__(self, chosen: dict[str, int]) -> None:
        self.chosen = chosen

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.chosen[t] for t in terms_of(word) if t in self.chosen)
        if len(self) < self.LIMIT:
            self[word] = found
        return found

    def counts(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        for word, n in Counter(WORD.findall((text or "").lower())).items():
            for term in self[word]:
                out[term] = out.get(term, 0) + n
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """(doc_id, text, toxic) of the labelled rows to learn from."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = usable.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # at most max_examples rows of 12 bytes


def choose_terms(taught: DataFrame, max_terms: int, least: int = 4) -> list[str]:
    """The terms that toxic examples hold most significantly more often, by the two-proportion z statistic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = {t for w in set(WORD.findall((text.as_py() or "").lower())) for t in terms_of(w)}
                n.update(found)
                if label:
                    toxic.update(found)
        terms = list(n)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array([toxic[t] for t in terms], pa.int64())], names=["term", "n", "toxic"])

    totals = taught.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n_all, n_toxic = int(totals[0]), int(totals[1])
    if not n_toxic or n_toxic == n_all:
        return []
    sums = taught.select("text", "toxic").mapInArrow(count, "term string, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic") / n_toxic, (F.col("n") - F.col("toxic")) / (n_all - n_toxic)
    p = F.col("n") / n_all
    z = (a - b) / F.sqrt(p * (1 - p) * (1 / n_toxic + 1 / (n_all - n_toxic)))
    kept = sums.filter((F.col("toxic") >= least) & (F.col("n") < n_all)).withColumn("z", z).filter((F.col("z") > 5) & (a > 4 * b))
    return sorted(r["term"] for r in kept.orderBy(F.desc("z"), "term").limit(max_terms).collect())


def document_frequencies(docs: DataFrame, chosen: list[str]) -> np.ndarray:
    """How many of all documents hold each chosen term, and, last, how many there are."""
    at = {t: k for k, t in enumerate(chosen)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, df = TermIds(at), np.zeros(len(at) + 1, np.int64)
        for batch in batches:
            df[-1] += batch.num_rows
            for x in batch.column(0):
                held = list(ids.counts(x.as_py()))
                df[held] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], names=["term", "df"])

    out = np.zeros(len(chosen) + 1, np.int64)
    for term, df in docs.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df")).collect():  # max_terms + 1 rows
        out[term] = df
    return out


class Index:
    """Block-max inverted index over the examples' unit vectors."""

    def __init__(self, chosen: list[str], idf: np.ndarray, ids: list[int], counts: list[dict[int, int]], toxic: list[int], k: int) -> None:
        self.chosen, self.idf, self.k = chosen, idf, k
        vectors = [self.vector(c) for c in counts]
        order = sorted(range(len(ids)), key=lambda i: (max(vectors[i], key=lambda t: (vectors[i][t], t), default=-1), ids[i]))  # like beside like
        self.ids, self.toxic = np.array([ids[i] for i in order], np.int64), np.array([toxic[i] for i in order], np.float64)
        self.vectors = [vectors[i] for i in order]
        self.rate = float(self.toxic.mean()) if ids else 0.0
        empty = np.array([not v for v in self.vectors], bool)
        self.rate_without = float((self.toxic[empty].sum() + self.rate) / (empty.sum() + 1)) if ids else 0.0
        self.postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in chosen]
        self.most: list[tuple[np.ndarray, np.ndarray]] = []
        self.blocks = -(-len(ids) // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in chosen]
        for place, v in enumerate(self.vectors):
            for t, w in v.items():
                lists[t].append((place, w))
        for t, found in enumerate(lists):
            places, weights = np.array([p for p, _ in found], np.int64), np.array([w for _, w in found], np.float64)
            for b in np.unique(places // BLOCK).tolist():
                mine = places // BLOCK == b
                self.postings[t][b] = (places[mine] - b * BLOCK, weights[mine])
            self.most.append((np.array(list(self.postings[t]), np.int64), np.array([w.max() for _, w in self.postings[t].values()], np.float64)))
        self.slope, self.shift = 1.0, 0.0
        self.remembered: dict[tuple, tuple[float, tuple[int, ...]]] = {}

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {t: (1 + math.log(n)) * float(self.idf[t]) for t, n in sorted(counts.items())}
        size = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / size for t, w in raw.items()} if size else {}

    def nearest(self, v: dict[int, float], but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, places) of the k nearest examples that share a term, the one at place ``but`` left out."""
        bound = np.zeros(self.blocks)
        for t, w in v.items():
            bound[self.most[t][0]] += w * self.most[t][1]
        best, places = np.empty(0), np.empty(0, np.int64)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) == self.k and bound[b] + 1e-12 < best[-1]:
                break
            sims = np.zeros(BLOCK)
            for t, w in v.items():
                if b in self.postings[t]:
                    at, weights = self.postings[t][b]
                    sims[at] += w * weights
            hit = np.flatnonzero(sims > 0)
            hit = hit[hit + b * BLOCK != but]
            best, places = np.concatenate([best, sims[hit]]), np.concatenate([places, hit + b * BLOCK])
            first = np.lexsort((self.ids[places], -best))[: self.k]
            best, places = best[first], places[first]
        return best, places

    def vote(self, v: dict[int, float], but: int = -1) -> tuple[float, np.ndarray]:
        sims, places = self.nearest(v, but)
        return (float(sims @ self.toxic[places]) + self.rate) / (float(sims.sum()) + 1), places

    def calibrate(self) -> None:
        """Logistic fit of the labels on the votes' log-odds, each example scored without itself."""
        some = [p for p, v in enumerate(self.vectors) if v]
        if not some or self.rate in (0.0, 1.0):
            return
        x = np.array([self.odds(self.vote(self.vectors[p], p)[0]) for p in some])
        y, w = self.toxic[some], np.array([1.0, 0.0])
        m = np.stack([x, np.ones(len(x))], axis=1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-m @ w))
            w = w + np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + 0.1 * np.eye(2), m.T @ (y - p) - 0.1 * (w - np.array([1.0, 0.0])))
        self.slope, self.shift = max(0.1, float(w[0])), float(w[1])

    @staticmethod
    def odds(p: float) -> float:
        p = min(max(p, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    def score(self, counts: dict[int, int]) -> tuple[float, str, str]:
        """The calibrated score, the doc_ids of the nearest examples and the terms the text holds."""
        if not counts:
            return self.rate_without, "", ""
        key = tuple(sorted(counts.items()))
        if key not in self.remembered:
            vote, places = self.vote(self.vector(counts))
            if len(self.remembered) > 50_000:
                self.remembered.clear()
            found = 1 / (1 + math.exp(-(self.slope * self.odds(vote) + self.shift)))
            self.remembered[key] = (found, ",".join(map(str, self.ids[places].tolist())), ",".join(self.chosen[t] for t, _ in key))
        return self.remembered[key]


def learn(docs: DataFrame, labels: DataFrame, max_examples: int = 8192, max_terms: int = 512, k: int = 15) -> Index:
    """The index: at most max_examples vectors of at most max_terms weights, whatever the input."""
    taught = examples(docs, labels, max_examples)
    chosen = choose_terms(taught, max_terms)
    df = document_frequencies(docs, chosen)
    at = {t: i for i, t in enumerate(chosen)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = TermIds(at)
        for batch in batches:
            found = [ids.counts(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["doc_id", "toxic", "terms", "counts"])

    rows = taught.select("doc_id", "text", "toxic").mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>").dropDuplicates(["doc_id"]).collect()  # bounded by max_examples
    rows.sort(key=lambda r: r["doc_id"])
    index = Index(chosen, np.log((df[-1] + 1) / (df[:-1] + 1)) + 1e-9, [r["doc_id"] for r in rows], [dict(zip(r["terms"], r["counts"], strict=True)) for r in rows], [r["toxic"] for r in rows], k)
    index.calibrate()
    return index


def scores(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """doc_id, held_out, score, predicted, and as evidence the nearest examples and the terms found."""
    index = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, **options))
    names = ["doc_id", "held_out", "score", "predicted", "neighbours", "terms"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        ids = TermIds({t: i for i, t in enumerate(found.chosen)})
        for batch in batches:
            rows = [found.score(ids.counts(x.as_py())) for x in batch.column(2)]
            score = np.array([r[0] for r in rows], np.float64)
            columns = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(each, "doc_id long, held_out boolean, score double, predicted int, neighbours string, terms string")
