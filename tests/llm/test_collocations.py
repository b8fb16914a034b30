"""Collocations against a plain count of all phrases."""

import re
from collections import Counter, defaultdict

import pytest

from fieldwatch.llm import collocations, common

LONG = " ".join(f"long{k % 700} tail" for k in range(10_000))
CORNERS = [
    (1, None, "en"), (2, "", None), (3, " \t\n\r\x0b\x0c ", "en"), (4, "one", "fr"), (5, "New York\tnew  york NEW YORK. new york; new york" * 4, "en"), (6, "x y z x y z x y z, x y z" * 6, "en"),
    (7, LONG, "en"), (7, LONG, "en"), (8, "é É ß ÀB 漢字 😀 漢字 😀! " * 20, "zh"), (9, "a a a a a a a a a a a a a", None), (9, "a a a a a a a a a a a a a", "und"), (None, "red\x1cfox red\x1cfox " * 12, "en"),
    (10, "\n".join(["i am", "i am", "sam i am"] * 10), "en"), (11, "q w e. " * 10 + "q w r. " * 10 + "z w e: " * 5, "en"),
]


def plain(rows, longest=3, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for length in range(1, longest + 1):
                f[lang].update(tuple(words[k : k + length]) for k in range(len(words) - length + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        gone = {p[i:j] for p, m in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * m >= 50 * counts[p[i:j]]}
        found = []
        for p, a in often.items():
            if p not in gone:
                score, _, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, rank, phrase.decode(), -a, l, r, n[lang], -score) for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def result(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows):
    common.ship(spark)
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, 3) for i, t, lang in rows], "doc_id bigint, text string, lang string, word string, n bigint, h1 bigint, shard int")


@pytest.mark.parametrize("how", [{}, {"shards": 4, "cell_bits": 4, "flush": 2000}, {"shards": 2, "cell_bits": 12, "flush": 5000}], ids=str)
def test_corners(spark, how):
    """Also where nearly every cell is shared, and where tasks sum up often."""
    assert result(collocations.collocations(frame(spark, CORNERS).repartition(3), **({"cell_bits": 16} | how))) == plain([(lang, t) for _, t, lang in CORNERS])


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r.lang, r.text) for r in docs.collect()])
    assert result(collocations.collocations(docs, cell_bits=20)) == want and len(want) > 100


def test_longer_phrases_and_few_rows_a_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id % 3 = 0")
    want = plain([(r.lang, r.text) for r in docs.collect()], longest=4, least=5, top=30)
    assert result(collocations.collocations(docs, longest=4, least=5, top=30, cell_bits=20)) == want


def test_empty_table(spark):
    assert result(collocations.collocations(frame(spark, []), cell_bits=10)) == []
