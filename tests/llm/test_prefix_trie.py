"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from fieldwatch.llm import common, prefix_trie


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0), role, digest, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(turns):
        h, family = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(turns.get(family, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children[path]]
        sums[path] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *sums[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()
    )


def result(frame):
    return sorted(tuple(r) for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def sql(path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    return sorted(con.sql(f"SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM ({prefix_trie.TRIE_SQL})").fetchall())


def rows(seed):
    chance = random.Random(seed)
    out = [(c, k, chance.choice(["user", "assistant"]), chance.choice(["a", "bb", "héé😀"])) for c in (*range(60), *range(200, 240), -7, -150, 305) for k in range(chance.randrange(1, 13))]
    out += [(c, k, "user", f"same {k}") for c in range(400, 440) for k in range(9)]  # copies, and their family's first
    return out + [(7, None, None, None), (7, None, "user", None), (9, 3, "user", "a"), (9, 3, "user", "a"), (500, 1, "", ""), (None, 1, "user", "lost"), (501, 5, "u", "x" * 100_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_corners(spark, tmp_path, seed):
    made = rows(seed)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in made], "conv_id bigint, turn bigint, role string, text string, pos int, digest string, n bigint")
    frame.coalesce(1).write.parquet(str(tmp_path / "c"))
    want = plain(made)
    assert result(prefix_trie.trie(frame.repartition(5))) == want
    assert sql(f"{tmp_path}/c/*.parquet") == want


def test_long_conversations_are_numbered_and_summed_in_spans(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPAN", 7)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    made = [(c, k - 20, "user", str(k * (c > 3 and k > 30))) for c in range(8) for k in range(50 + c % 2)]
    assert result(prefix_trie.trie(spark.createDataFrame(made, "conv_id bigint, turn bigint, role string, text string"))) == plain(made)


def test_given_and_empty_tables(spark, sf_dir):
    common.ship(spark)
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert result(prefix_trie.trie(frame)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()])
    assert prefix_trie.trie(frame.limit(0)).count() == 0
