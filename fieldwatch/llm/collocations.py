"""Collocations of each language by dynamic itemset counting.

The texts are dealt into shards by their hash, which are scanned in turn, round and round; docs must be a table that reads the same each time. Words are counted from the first scan on. After every scan,
phrases that have reached the threshold are noted, and a longer phrase is counted from the scan after the one in which the later of its two
subphrases (all but its last word, all but its first) was noted; lengths are thus counted side by side. A phrase is counted through one full
round, so its count is exact, whenever it began; the scans end when no phrase is open. A phrase that is as frequent as the threshold
has subphrases that are, so none is missed.

A scan looks up when a phrase was noted in a table of ``2 ** cell_bits`` cells a length, which is all that is broadcast and doesn't grow with the
corpus. Cells that phrases share are noted with the first of them: a phrase may then be counted sooner, or in vain, but still for one
round, so counts don't change. Phrases are told apart by their words' 64-bit hashes, seeded by language; all
distinct words are checked for equal hashes, and another seed is taken should two have one.

Tasks count ``FLUSH`` tokens at a time and shuffle sums only. What earlier scans have counted is kept as a table in the shared folder;
each scan is one job that reads a shard and that table, so a lost executor repeats part of one scan. A
superseded table is removed.

Defined results: a null text is empty and a null language is ``und``. Rows that repeat count again; doc_id isn't read. An empty table has no collocations.
Ties of score and count are ordered by phrase in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldwatch.llm.common import new_path

#: Lower case for A-Z is bytes.lower; what ends a piece becomes a line feed, and a tab a space.
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
BREAK, NEVER = 1, 255
FLUSH = 1 << 20
#: Rows of an Arrow batch that a task sends on.
ROWS = 1 << 16
#: Parts of each language that choose their best rows before the last choice.
PARTS = 32


class Hashes(dict):
    """word -> 64-bit hash, remembering a bounded number of words."""

    LIMIT = 400_000

    def __init__(self, seed: int) -> None:
        super().__init__({b"\n": BREAK})
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) < self.LIMIT:
            self[word] = found
        return found


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in order, with a line feed where a piece ends."""
    return [w for w in text.lower().translate(PIECES).replace(b"\n", b" \n ").split(b" ") if w]


def _of_language(hashes: np.ndarray, lang: str, seed: int) -> np.ndarray:
    """The hashes of words (above 1) mixed with their language, still above 1; breaks as they are."""
    mixed = (hashes ^ np.uint64(xxhash.xxh64_intdigest(b"\n" + lang.encode("utf-8", "surrogatepass"), seed))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return np.where(hashes == BREAK, np.uint64(BREAK), np.maximum(mixed, np.uint64(2)))


def _cells(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """The cell of a phrase, given its words' hashes; cell_column is the same on columns."""
    return reduce(np.bitwise_xor, [p >> np.uint64(64 - bits - 7 * k) for k, p in enumerate(parts)]) & np.uint64((1 << bits) - 1)


def cell_column(length: int, bits: int) -> Column:
    return F.expr(f"({' ^ '.join(f'shiftrightunsigned(h{k + 1}, {64 - bits - 7 * k})' for k in range(length))}) & {(1 << bits) - 1}")


def _counted(docs: list[tuple[str, np.ndarray, list[bytes]]], step: int, shards: int, longest: int, noted: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of the open phrases of some documents: lang and word of single words, hashes, the scan from which they count, and n."""
    if not docs:
        return
    h = np.concatenate([x for _, x, _ in docs])
    lengths = np.array([len(x) for _, x, _ in docs])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    word = h != BREAK

    def rows(at: np.ndarray, length: int, start: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(at), ROWS):
            here, few = at[k : k + ROWS], min(ROWS, len(at) - k)
            langs, words = pa.nulls(few, pa.string()), pa.nulls(few, pa.binary())
            if length == 1:
                of = np.searchsorted(ends, here, side="right")
                langs = pa.array([docs[d][0] for d in of.tolist()], pa.string())
                words = pa.array([docs[d][2][i] for d, i in zip(of.tolist(), (here - begins[of]).tolist(), strict=True)], pa.binary())
            keys = [pa.array(h[here + n].view(np.int64) if n < length else np.zeros(few, np.int64)) for n in range(longest)]
            numbers = [pa.array(np.full(few, length, np.int32)), pa.array(start[k : k + ROWS].astype(np.int32)), pa.array(counts[k : k + ROWS].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([langs, words, *keys, *numbers], names=["lang", "word", *(f"h{n + 1}" for n in range(longest)), "length", "start", "n"])

    if step < shards:
        codes, found = pd.factorize(h)
        highest = np.maximum.accumulate(codes)
        first = np.flatnonzero(np.r_[True, highest[1:] > highest[:-1]])  # codes count up in order of appearance
        kept = found != BREAK
        yield from rows(first[kept], 1, np.zeros(int(kept.sum())), np.bincount(codes)[kept])
    inside = word
    for length in range(2, longest + 1):
        n = len(h) - length + 1
        if n < 1:
            break
        inside = inside[:n] & word[length - 1 :]  # no piece ends within
        noted_at = noted[length - 2][_cells([h[k : n + 1 + k] for k in range(length - 1)], bits)]  # of each shorter phrase, one more than n
        later = np.maximum(noted_at[:-1], noted_at[1:])
        here = np.flatnonzero(inside & (later < step) & (later >= max(0, step - shards)))
        if len(here):
            begun = later[here].astype(np.int32) + 1
            key = pd.factorize(h[here])[0]
            for k in range(1, length):  # keys stay below 2 ** 63: each is made dense before the next word joins
                key = ((key if k == 1 else pd.factorize(key)[0]) << 32) | pd.factorize(h[here + k])[0]
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            yield from rows(here[first], length, begun[first], counts)


_made: dict[int, Hashes] = {}


def _hashes(seed: int) -> Hashes:
    """One a Python worker, so that tasks share what it remembers."""
    if seed not in _made:
        _made[seed] = Hashes(seed)
    return _made[seed]


def _scan(texts: DataFrame, step: int, shards: int, longest: int, noted: list[np.ndarray], bits: int, seed: int, flush: int) -> tuple[DataFrame, Broadcast]:
    """Sums of one scan, a row for each open phrase and task at least, and the broadcast that it needs."""
    shared = texts.sparkSession.sparkContext.broadcast([zstandard.compress(table.data, 1) for table in noted])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.frombuffer(zstandard.decompress(x), np.uint8) for x in shared.value]
        hashes, held, size = _hashes(seed), [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = tokens(text.as_py() or b"")
                if words:
                    words.append(b"\n")
                    held.append((lang, _of_language(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), lang, seed), words if step < shards else []))
                    size += len(words)
                if size >= flush:
                    yield from _counted(held, step, shards, longest, tables, bits)
                    held, size = [], 0
        yield from _counted(held, step, shards, longest, tables, bits)

    keys = "".join(f"h{k + 1} long, " for k in range(longest))
    return texts.mapInArrow(count, f"lang string, word binary, {keys}length int, start int, n long"), shared


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _noted_now(rows: DataFrame, longest: int, least: int, bits: int) -> list[np.ndarray]:
    """For each length but the last, the cells of open phrases, and of those that this scan ended, that have reached the threshold; they come as native bitmaps of 4 KB a range of cells."""
    reached = rows.filter((F.col("length") < longest) & (F.col("n") >= least))
    cell = F.coalesce(*[F.when(F.col("length") == k, cell_column(k, bits)) for k in range(1, longest)]) + 1  # bitmaps count from one
    maps = reached.select("length", cell.alias("c")).groupBy("length", F.bitmap_bucket_number("c").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits")).collect()
    found = [[np.empty(0, np.int64)] for _ in range(1, longest)]
    for r in maps:
        found[r.length - 1].append((r.b - 1) * 32768 + np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")))
    return [np.concatenate(x) for x in found]


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, shards: int = 2, cell_bits: int = 24, flush: int = FLUSH, seed: int = 0) -> DataFrame:
    """Every phrase of up to ``longest`` words with a count of ``least`` or more, exactly: lang and word (of single words), h1 to h{longest}, length, n; and each language's word
    total as a row of length 0."""
    spark = docs.sparkSession
    home, keys = new_path(spark, "collocations"), [f"h{k + 1}" for k in range(longest)]
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    shard = F.pmod(F.xxhash64("text"), F.lit(shards))
    noted = [np.full(1 << cell_bits, NEVER, np.uint8) for _ in range(longest - 1)]
    finals, open_rows, last_start, step = [], None, 0, 0
    while step < last_start + shards:
        if step == NEVER:
            raise ValueError("too many scans: take fewer shards or shorter phrases")
        found, shared = _scan(texts.filter(shard == step % shards), step, shards, longest, noted, cell_bits, seed, flush)
        if open_rows is not None:
            found = found.unionByName(open_rows.select(*found.columns))
        sums = found.groupBy("lang", "word", *keys, "length", "start").agg(F.sum("n").alias("n"))
        path, ends = f"{home}/scan-{step}", F.col("start") + (shards - 1)
        over = (ends == step) & (F.col("n") < least) & (F.col("length") > 1)
        sums.filter(~over).withColumn("open", ends > step).write.partitionBy("open").parquet(path)
        rows = spark.read.schema(f"lang string, word binary, {''.join(f'{k} long, ' for k in keys)}length int, start int, n long, open boolean").parquet(path)
        shared.destroy()  # the scan is written
        if step == shards - 1 and not rows.filter("length = 1 AND NOT open").groupBy("h1").count().filter("count > 1").isEmpty():
            _remove(spark, home)
            if seed == 7:
                raise RuntimeError("eight seeds gave two words one hash")
            return phrase_counts(docs, longest, least, shards, cell_bits, flush, seed + 1)
        for table, cells in zip(noted, _noted_now(rows, longest, least, cell_bits), strict=True):
            fresh = cells[table[cells] == NEVER]
            table[fresh] = step
            if len(fresh):
                last_start = step + 1
        if step:
            _remove(spark, f"{home}/scan-{step - 1}/open=true")
        finals.append(rows.filter("NOT open"))
        open_rows, step = rows.filter("open"), step + 1
    every = reduce(DataFrame.unionByName, finals).select(F.coalesce("lang", F.lit("")).alias("lang"), "word", *keys, "n", "length")
    totals = every.filter("length = 1").groupBy("lang").agg(F.sum("n").alias("n")).withColumns({k: F.lit(0).cast("long") for k in keys} | {"word": F.lit(None).cast("binary"), "length": F.lit(0)})
    # one table instead of a union of all scans, because what follows reads it many times
    every.filter(F.col("n") >= least).unionByName(totals).write.partitionBy("length").parquet(f"{home}/counts")
    for done in range(step):
        _remove(spark, f"{home}/scan-{done}")
    return spark.read.schema(f"lang string, word binary, {''.join(f'{k} long, ' for k in keys)}n long, length int").parquet(f"{home}/counts")


def _score(left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)), exactly."""
    big = [f"cast({c} AS decimal(20,0))" for c in ("a", left, right)]
    return f"(1000000BD * {big[0]} * {big[0]}) div ({big[1]} * {big[2]})"


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, absorbed_percent: int = 50, **how: int) -> DataFrame:
    """Each language's best ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase that stands in a longer one with ``absorbed_percent`` of its count or more gives way to it. Arithmetic is in 38-digit decimals: exact for counts below 10 ** 16.
    """
    counts = phrase_counts(docs, longest, least, **how)
    keys = [f"h{k + 1}" for k in range(longest)]

    def of(rows: DataFrame, length: int) -> DataFrame:
        return rows.filter(F.col("length") == length)

    singles = of(counts, 1).select(F.col("h1").alias("w"), "lang", F.col("word").cast("string").alias("word"), F.col("n").alias("f"))
    kept = []
    for length in range(2, longest + 1):
        rows = of(counts, length).select(*keys[:length], F.col("n").alias("a"))
        absorbed = [
            of(counts, longer).select(*[F.col(keys[at + k]).alias(keys[k]) for k in range(length)], F.col("n").alias("m"))
            for longer in range(length + 1, longest + 1) for at in range(longer - length + 1)
        ]
        if absorbed:
            most = reduce(DataFrame.unionByName, absorbed).groupBy(*keys[:length]).agg(F.max("m").alias("m"))
            rows = rows.join(most, keys[:length], "left").filter(F.col("m").isNull() | (100 * F.col("m").cast("decimal(20,0)") < absorbed_percent * F.col("a").cast("decimal(20,0)"))).drop("m")
        for k in range(length):
            columns = [F.col("w").alias(keys[k]), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}_{k + 1}"), *([F.col("lang")] if k == 0 else [])]
            rows = rows.join(singles.select(*columns), keys[k])
        for size in range(2, length):
            for at in (0, length - size):
                rows = rows.join(of(counts, size).select(*[F.col(keys[k]).alias(keys[at + k]) for k in range(size)], F.col("n").alias(f"f{at}_{at + size}")), keys[at : at + size])
        cuts = []
        for k in range(1, length):
            l, r = f"f0_{k}", f"f{k}_{length}"  # noqa: E741
            cuts.append(F.struct(F.expr(_score(l, r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")))
        cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        kept.append(rows.select("lang", F.concat_ws(" ", *[f"word{k}" for k in range(length)]).alias("phrase"), "a", cut.alias("cut")))
    phrases = reduce(DataFrame.unionByName, kept).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
    chosen = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", rank("lang", "part")).filter(F.col("rank") <= top)
    chosen = chosen.withColumn("rank", rank("lang")).filter(F.col("rank") <= top)
    totals = of(counts, 0).select("lang", F.col("n"))
    return chosen.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for collocations(documents).
COLLOCATIONS_SQL = """
WITH pieces AS (
    SELECT row_number() OVER () AS piece, coalesce(lang, 'und') AS lang,
        unnest(string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13) || chr(9), 'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9) || ' '), chr(10))) AS text
    FROM documents),
listed AS (SELECT row_number() OVER () AS piece, lang, string_split(text, ' ') AS ws FROM pieces),
words AS (SELECT piece, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM listed),
kept AS (SELECT * FROM words WHERE w <> ''),
runs AS (SELECT lang, w AS w1, lead(w, 1) OVER here AS w2, lead(w, 2) OVER here AS w3 FROM kept WINDOW here AS (PARTITION BY piece ORDER BY pos)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
absorbed AS (SELECT lang, w1, w2, max(f) AS m FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY lang, w1, w2),
cuts AS (
    SELECT o.lang, o.w1 || ' ' || o.w2 AS phrase, o.f AS a, 1 AS k, l.f AS l, r.f AS r
    FROM f2 o JOIN f1 l ON l.lang = o.lang AND l.w1 = o.w1 JOIN f1 r ON r.lang = o.lang AND r.w1 = o.w2
        LEFT JOIN absorbed x ON x.lang = o.lang AND x.w1 = o.w1 AND x.w2 = o.w2
    WHERE x.m IS NULL OR 100 * x.m < 50 * o.f
    UNION ALL
    SELECT o.lang, o.w1 || ' ' || o.w2 || ' ' || o.w3, o.f, 1, l.f, r.f
    FROM f3 o JOIN f1 l ON l.lang = o.lang AND l.w1 = o.w1 JOIN f2 r ON r.lang = o.lang AND r.w1 = o.w2 AND r.w2 = o.w3
    UNION ALL
    SELECT o.lang, o.w1 || ' ' || o.w2 || ' ' || o.w3, o.f, 2, l.f, r.f
    FROM f3 o JOIN f2 l ON l.lang = o.lang AND l.w1 = o.w1 AND l.w2 = o.w2 JOIN f1 r ON r.lang = o.lang AND r.w1 = o.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
