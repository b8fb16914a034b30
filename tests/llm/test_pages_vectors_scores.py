"""WARC bundles, page texts, exact search, toxicity and surrogates."""

import base64
import hashlib
import io
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

from fieldwatch.llm import common, covertree, html_text, pii, toxicity, warc

PAGES = [(1, "http://a", None), (2, None, ""), (3, "u\r\nX: y", "dup"), (9, "é b", "dup"), (None, "z", "dup"), (None, "z", "alone"), (4, "k", "<p>漢字 😀"), (4, "k", "<p>漢字 😀"), (5, "big", "x" * 300_000)]


@pytest.fixture(scope="module")
def pages(spark):
    common.ship(spark)
    frame = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return frame.withColumns({"sha1": F.lit("s"), "first": F.lit(1), "salt": F.lit(2), "text": F.lit("t")})


def test_warc(spark, pages):
    folder = common.new_path(spark, "warc")
    index = warc.write(pages, folder, frame_bytes=500)
    first = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    want = Counter()
    for page_id, _, html in PAGES:
        data, least = (html or "").encode(), first.get(html or "")
        refers = least if least is not None and least != page_id else None
        want[page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers] += 1
    assert Counter(tuple(r)[:5] for r in warc.read(index).collect()) == want
    assert [tuple(r)[:2] for r in warc.read(index.filter("page_id = 9")).collect()] == [(9, 3)]
    plain = b""
    for file in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(f"{warc.filesystem(folder)[1]}/bundles")):
        with open(file.path, "rb") as data:
            plain += zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data.read()), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == len(PAGES)
    for row in index.collect():
        frame = warc.read_frame(row.bundle, row.frame)
        assert frame[row.offset : row.offset + row.length].startswith(b"WARC/1.1\r\n") and row.record_id.encode() in frame[row.offset : row.offset + 200]
    assert warc.round_trip(spark, pages.limit(0)).count() == 0
    assert warc.round_trip(spark, pages, min_revisit_bytes=1000).filter("record_type = 'revisit'").count() == 0


def test_best_run_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.integers(-4, 4, rng.integers(1, 12)).tolist()
        start, end = html_text.best_run(scores)
        assert sum(scores[start:end]) == max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])


PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home page menu</a></ul></nav>
<div class="cookie-notice">We set cookies</div><!-- c --><article><header class="x"></header><h1>The  title</h1><p>First &amp; best&nbsp;part <b>of</b> <a href=y>the text</a> here<br>and there.</p>
<div class="ad-box"><p>Buy these many nice shiny new things now</p></div><ul><li>one item</li><li>two items</li></ul><form><input><button>Send</button> mail me</form><p>Last words of it</p></article>
<aside>Side words only</aside><section id="comments"><article><p>Great post, thank you all for it</p></article></section><footer>All rights reserved</footer></body></html>"""


def test_main_text(spark):
    common.ship(spark)
    w = html_text.fitted()
    assert html_text.main_text(PAGE, w) == "The title\nFirst & best part of the text here and there.\none item\ntwo items\nLast words of it"
    assert html_text.main_text(PAGE[: PAGE.index("Last words") + 4], w).endswith("two items\nLast")
    assert [html_text.main_text(x, w) for x in (None, "", "<nav>menu</nav>", "<p", "<script>x")] == ["", "", "", "", ""]
    assert html_text.main_text("<p>just words</p>", w) == "just words"


def test_extract_equals_the_article(spark, sf_dir):
    from html import unescape

    source = common.table(spark, sf_dir, "pages")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(source.withColumn("text", F.lit(1))).collect()}
    for r in source.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        blocks = unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1|li)\b[^>]*>", "\0", body)))).split("\0")
        want = "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)
        assert got[r.page_id] == (want, len(want))
    assert html_text.extract(source.limit(0)).count() == 0


def plain_top(rows, every=3, k=4):
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in {i: v for i, v in sorted(whole, key=lambda r: (r[0], r[1]), reverse=True) if i % every == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), d) for d, b in whole if d != q and len(b) == len(a))[:k]
        want += [(q, r + 1, d, -s) for r, (s, d) in enumerate(scored)]
    return Counter(want)


@pytest.mark.parametrize("options", [{}, {"data_block": 40, "query_block": 7}])
def test_exact_search(spark, options):
    common.ship(spark)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(k, (centres[k % 6] + rng.normal(size=8) * 0.1).astype(np.float32).tolist()) for k in range(400)]
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, rows[0][1]), (3, rows[9][1]), (600, None), (None, rows[0][1]), (603, [1.0, None] + [0.0] * 6), (606, [float("nan")] * 8), (609, [float("inf")] * 8), (612, [1.0, 2.0]), (613, [2.0, 1.0]), (615, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"v": F.lit(1), "d": F.lit(2), "q": F.lit(3)})
    assert Counter(tuple(r) for r in covertree.top_k(frame, every=3, k=4, **options).collect()) == plain_top(rows)
    assert covertree.top_k(frame.limit(0)).count() == 0


def test_cover_tree_covers_and_prunes():
    rng = np.random.default_rng(5)
    points = np.floor((rng.normal(size=(30, 16)) * 900)[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16)) * 20)

    def check(node):
        assert np.sqrt(((points[node.places] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-6
        if node.children:
            assert sorted(np.concatenate([c.places for c in node.children])) == sorted(node.places)
        for child in node.children:
            check(child)

    tree = covertree.cover_tree(points)
    check(tree)
    search = covertree.Search(points[:100], np.arange(100), points, np.arange(3000), 10)
    search.visit(covertree.cover_tree(points[:100]), tree)
    assert search.pruned > search.compared


def test_toxicity(spark, sf_dir):
    docs, labels = common.table(spark, sf_dir.replace("0.001", "0.01"), "documents"), common.table(spark, sf_dir.replace("0.001", "0.01"), "labels")
    rows = {r.doc_id: r for r in toxicity.scores(docs.withColumn("toxic", F.lit(7)), labels).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    known = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    toxic, clean = [s for s, t in known if t], [s for s, t in known if not t]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean]) > 0.8
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "x")], "doc_id bigint, text string")
    got = toxicity.scores(docs.select("doc_id", "text").union(odd), labels.union(spark.createDataFrame([(None, 1, 1), (5, 1, None)], labels.schema)))
    assert got.count() == docs.count() + 3 and got.filter("doc_id IS NULL AND NOT held_out").count() == 1
    assert {r.score for r in toxicity.scores(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.scores(docs.limit(0), labels).count() == 0


def test_block_max_neighbours_are_exact():
    rng = np.random.default_rng(6)
    counts = [{int(t): int(rng.integers(1, 4)) for t in rng.choice(12, rng.integers(0, 5), replace=False)} for _ in range(400)]
    index = toxicity.Index([f"t{k}" for k in range(12)], rng.uniform(0.1, 5, 12), list(range(400)), counts, rng.integers(0, 2, 400).tolist(), 7)
    for c in counts[:60]:
        v = index.vector(c)
        sims, places = index.nearest(v)
        all_sims = np.array([sum(w * u.get(t, 0.0) for t, w in v.items()) for u in index.vectors])
        order = np.lexsort((index.ids, -all_sims.round(12)))[:7]
        assert np.allclose(sims, all_sims[order][all_sims[order] > 0])
        assert sims.size == places.size


KEY = b"test key"


def test_surrogates_keep_form_distinctness_and_coreference(spark):
    common.ship(spark)
    texts = {
        1: "Call +1 (017) 555-7713 or +1 017 555 7713, mail Ann.Lee@Mail.example.com", 2: "ANN.LEE@mail.example.com, card 4111111111111111, ip 10.0.0.7", 3: None, 4: "",
        5: "nothing here, 12 of 345", 6: 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" Mrs. Anna Schmidt; Frau ANNA Schmidt; Госпожа Анна Иванова', 7: "x 4111111111111111 y 4111 1111 1111 1111",
    }
    rows = [(i, t, "k", "v") for i, t in texts.items()] + [(None, texts[2], "k", "v")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, kind string, value string").withColumn("__x", F.lit(1))
    got = {r.doc_id: r.text for r in pii.with_surrogates(frame, KEY).collect()}
    assert got[3] is None and got[4] == "" and got[5] == texts[5] and got[None] == got[2]
    assert re.fullmatch(r"Call \+1 \(\d{3}\) \d{3}-\d{4} or \+1 \d{3} \d{3} \d{4}, mail [A-Z][a-z]{2}\.[A-Z][a-z]{2}@[A-Z][a-z]{3}\.[a-z]{7}\.com", got[1])
    phones = [re.sub(r"\D", "", x) for x in re.findall(r"\+1[ ()\d-]+\d", got[1])]
    assert phones[0] == phones[1] != "10175557713"
    mail = lambda t: re.search(r"\S+@[^\s,]+", t)[0].lower()
    assert mail(got[1]) == mail(got[2]) != "ann.lee@mail.example.com"
    card = re.search(r"card (\d{16})", got[2])[1]
    assert pii.luhn(card) and card != "4111111111111111" and [re.sub(" ", "", x) for x in re.findall(r"\d[\d ]+\d", got[7])] == [card, card]
    names = re.search(r"Mrs\. (\w+) (\w+); Frau (\w+) (\w+); Госпожа ([А-Яа-яё]+) ([А-Яа-яё]+)", got[6]).groups()
    assert names[0].lower() == names[2].lower() in pii.GIVEN["f", "latin"] and names[2].isupper() and names[1] == names[3] and names[4].lower() in pii.GIVEN["f", "cyrillic"]
    assert pii.with_surrogates(frame.limit(0), KEY).count() == 0


def test_permutations_are_one_to_one():
    for kind, values in (("ssn", [f"{k:09d}" for k in range(3000)]), ("email", [f"{a}{b}{k}@x.org" for a in "abe" for b in "xyz" for k in range(50)]), ("person", [f"f:{n} {s}" for n in (*pii.GIVEN["f", "latin"], "zoe") for s in ("kim", "lee", "cox")]), ("ip", [f"10.0.{a}.{b}" for a in range(20) for b in range(50)])):
        new = [pii.permute(kind, v, KEY) for v in values]
        assert len(set(new)) == len(values) and all(len(a.split(".")) == len(b.split(".")) for a, b in zip(new, values, strict=True))


def test_no_surrogate_is_shared_or_real(spark):
    common.ship(spark)
    values = [f"1{k:010d}" for k in range(40)]
    values += [pii.permute("phone", v, KEY) for v in values[:20]]  # real entities that are others' surrogates
    real = spark.createDataFrame([("phone", v) for v in values], "kind string, value string").distinct()
    again = {r.value: r.attempt for r in pii.attempts(real, KEY).collect()}
    known = pii.Surrogates(KEY)
    new = {v: known["phone", v, again.get(v, 1)] for v in set(values)}
    assert len(again) >= 20 and len(set(new.values())) == len(new) and not set(new.values()) & set(new)


def test_whole_given_table(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in pii.surrogate_report(docs, KEY).collect()}
    by_value = defaultdict(set)
    for r in docs.collect():
        found = pii.entities(r.text)
        assert rows[r.doc_id].n_entities == len(found) and (rows[r.doc_id].text == r.text) == (not found)
        for (kind, a, b), place in zip(found, rows[r.doc_id].places.split(","), strict=True) if found else ():
            by_value[kind, pii.canonical(kind, r.text[a:b])].add(pii.canonical(kind, rows[r.doc_id].text[int(place) : int(place) + b - a]) if kind not in ("ip", "person") else place)
            assert r.text[a:b] not in rows[r.doc_id].text
    assert all(len(v) == 1 for (kind, _), v in by_value.items() if kind not in ("ip", "person"))
