"""Operators on documents against plain versions, over the given small table and a table of corner cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fieldwatch.llm import bpe, common, packing, quality, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"word{k}" for k in range(60))
LONG = " ".join(f"long{k % 5000}" for k in range(30_000))
CORNERS = [
    (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, "two words"), (6, "x y z x y z x y z"), (7, PASSAGE), (8, PASSAGE), (9, f"before {PASSAGE} after\nline\nline"),
    (10, LONG), (11, f"{LONG} tail"), (12, "ÀÉ 漢字 😀     <|endoftext|> don't"), (13, "a" * 70_000), (14, "a  \n\n b" * 3000), (None, PASSAGE), (15, "### $$$ %%% " * 30), (16, "SHOUT!! ALL!! DAY!! LONG!! " * 20),
    (17, "of " * 200), (17, "of " * 200), (18, "alpha beta gamma " * 5 + "delta " * 50),
]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    given = [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    return CORNERS + given


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.ship(spark)
    frame = spark.createDataFrame([(i, t, "x", "y", len(t or "")) for i, t in rows], "doc_id bigint, text string, kind string, value string, n_chars bigint")
    return frame.withColumns({"h": F.lit(1), "root": F.lit("r"), "mark": F.lit(2), "first": F.lit(3), "failures": F.lit(4), "fp": F.lit(5)})


def result(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_quality_measures(docs, rows):
    want = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {p for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), failed] += 1
    got = quality.quality_report(docs)
    assert result(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
    assert got.filter("base_failed AND kept").count() == 0
    assert {r.doc_id for r in got.filter("kept").collect()} >= {7, 8, 9}
    assert not {r.doc_id for r in got.filter("kept").collect()} & {15, 16, 17}


def test_rules_count_few_and_many_repeats_alike(docs, monkeypatch):
    usual = result(quality.quality_report(docs))
    monkeypatch.setattr(quality, "FEW", 0)
    assert result(quality.quality_report(docs)) == usual


def test_ablations(docs):
    ledger = quality.ledger(docs)
    bits = [r.failures for r in ledger.select("failures").collect()]
    names, mask = list(quality.RULES), quality.mask("v2")
    for r in quality.ablations(ledger, "v2").collect():
        bit = 1 << names.index(r.rule)
        assert (r.n_failed, r.n_failed_alone, r.n_kept, r.n_kept_without) == (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits), bits.count(0), sum(b & mask & ~bit == 0 for b in bits))


def plain_components(rows, radius=4):
    prints = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0)
    label = list(range(len(rows)))
    values = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for k in range(len(rows)):
            near = np.flatnonzero(np.bitwise_count(values ^ values[k]) <= radius)
            least = min(label[j] for j in near)
            for j in near:
                if label[j] != least:
                    label[j], changed = least, True
    ids = defaultdict(list)
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            ids[c].append(i)
    return Counter((i, f"{p:016x}", min(ids[c], default=None)) for (i, _), p, c in zip(rows, prints, label, strict=True))


@pytest.mark.parametrize("tile", [1 << 16, 16])
def test_simhash(docs, rows, tile):
    assert result(simhash.near_duplicates(docs, tile=tile)) == plain_components(rows)


def test_one_of_each_group_stays(docs, rows):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in plain_components(rows) if i is None or i == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_chains_are_one_component(spark):
    from fieldwatch.llm.graph import components

    edges = [(k, k + 1) for k in range(200)] + [(500, 700), (600, 700), (9, 9), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 600: 500, 700: 500}


def plain_removals(rows):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12 if i is not None else 0):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {p for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"sketch_bits": 22, "hot": 3}])
def test_repeated_passages(docs, rows, options):
    want = plain_removals(rows)
    assert result(substring.removal_report(docs, **options)) == want
    shorter = substring.remove_repeats(docs, **options)
    assert shorter.columns == docs.columns
    digest = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    assert Counter((r.doc_id, digest(r.text)) for r in shorter.collect()) == Counter({(i, d): n for (i, _, _, d), n in want.items()})
    assert all(r.n_chars == len(r.text or "") for r in shorter.collect())


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = [tuple(r) for r in packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), max_open=3).collect()]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset in got:
        pieces[doc_id].append((start, length, crc, total))
        sequences[sequence].append((offset, length))
    for doc_id, text in rows:
        if doc_id == 17:
            continue  # two rows of one id
        ids, at = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for start, length, crc, total in sorted(pieces[doc_id]):
            assert (start, crc, total) == (at, zlib.crc32(ids[at : at + length].tobytes()), len(ids))
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_packer_chooses_the_least_sum_of_squares():
    packer = packing.Packer(10, 0, 100)
    for length in (3, 3, 6, 4):
        before = packer.count.copy()
        level = packer._level(length)
        costs = {}
        for h in range(0, 10 - length + 1):
            if h == 0 or before[h]:
                after = before.copy()
                after[h] -= h > 0
                after[h + length] += h + length < 10
                costs[h] = int((after**2).sum())
        assert costs[level] == min(costs.values())
        packer.add(1, b"\0\0\0\0" * length)


@pytest.mark.parametrize("options", [{}, {"chunk": 700, "overlap": 60}, {"chunk": 200, "overlap": 8}])
def test_byte_bpe(docs, rows, options):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = bpe.pieces_for(ranks, public_tokenizers.PATTERN).encoding
    assert isinstance(encoding, tiktoken.Encoding)
    want = Counter()
    for i, t in rows:
        ids = encoding.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert result(bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN, **options)) == want


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for frame in (quality.quality_report(none), quality.keep_good(none), simhash.near_duplicates(none), simhash.keep_first(none), substring.removal_report(none), substring.remove_repeats(none), packing.pack(none, public_tokenizers.path("word_bpe_49k.json")), bpe.encode_digests(none, ranks, public_tokenizers.PATTERN)):
        assert frame.count() == 0


def test_pipeline_against_plain_stages(spark, sf_dir):
    """The stages one by one: what each keeps is what the plain versions keep of its input."""
    read = lambda frame: [(r.doc_id, r.text) for r in frame.orderBy("doc_id").collect()]
    docs, names = spark.read.parquet(f"{sf_dir}/documents.parquet"), dict(corpus_pipeline.STAGES)
    columns = docs.columns
    good = names["quality rules"](spark, docs, sf_dir)
    distinct = names["near copies"](spark, good, sf_dir)
    single = {i for i, _, c in plain_components(read(good)) if i == c}
    assert {i for i, _ in read(distinct)} == single
    cut = names["repeated passages"](spark, distinct, sf_dir)
    digest = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    assert {(i, digest(t)) for i, t in read(cut)} == {(i, d) for i, _, _, d in plain_removals(read(distinct))}
    private = names["personal data"](spark, cut, sf_dir)
    assert good.columns == distinct.columns == cut.columns == private.columns == columns
    assert {i for i, _ in read(private)} == single
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == single
