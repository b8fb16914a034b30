"""The prefix trie of conversations, by digests of fixed-length blocks of turns.

Every conversation is cut into blocks of ``BLOCK`` turns (the last may be shorter), and each block has a digest of all turns up to its end. Conversations are first
grouped by these block digests, one row a conversation and block. Where all that go on from a block's start share the next block, the turns
inside that block have the same members, and their nodes follow from the block without another grouping. Only inside blocks where siblings
diverge are turn boundaries refined: there the distinct blocks, not the conversations, are grouped by the digests of their turns.

A prefix digest is the exclusive-or of two 64-bit hashes of each (position, role, text) up to a turn, so it is a running aggregate and never gathers a conversation.
Turns are numbered, and digests summed up, in spans of ``SPAN`` of a conversation; totals of earlier spans are added, so one conversation that
holds much of the table is worked on by many tasks. Texts aren't shuffled, only digests and lengths.

A conversation owns the nodes of which it is the smallest member; they are the last turns of its path. What a subtree saves is the text of its members' turns that
they don't own, so subtree sums are sums over members, and nothing walks the tree. The conversations that end at a node are joined in pieces of at most ``IDS`` ids;
one task reads a node's pieces in order and hashes them as it reads.

Defined results: rows without conv_id belong to no conversation. Null turns come first; turns of equal number are ordered by role and then text's digest, and
repeated rows are turns of their own. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed

BLOCK, SPAN, IDS, SALTS = 4, 4096, 65_536, 16
#: How conversations are rebuilt: those of a family of so many ids begin with up to so many turns of its first.
FAMILY, HEADS = 100, 6
NODE = ["p1", "p2"]


def _offsets(rows: DataFrame, keys: list[str], span: str, sums: dict[str, Column], after: bool = False) -> DataFrame:
    """keys, span and, for each named aggregate of a span's rows, that of the earlier spans of the same keys (of the later ones if after)."""
    totals = rows.groupBy(*keys, span).agg(*[c.alias(n) for n, c in sums.items()])
    order = Window.partitionBy(*keys).orderBy(F.desc(span) if after else F.asc(span)).rowsBetween(Window.unboundedPreceding, -1)
    fold = lambda n: F.coalesce((F.bit_xor(n) if n.startswith("x") else F.sum(n)).over(order), F.lit(0).cast("long"))
    return totals.select(*keys, span, *[fold(n).alias(f"{n}_other") for n in sums])


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest of role and text, and len, the text's code points."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("len"))
    rows = rows.withColumn("span", F.coalesce(F.expr(f"floor(turn / {SPAN})"), F.lit(-(1 << 62)).cast("long")))
    place = F.row_number().over(Window.partitionBy("conv_id", "span").orderBy(F.asc_nulls_first("turn"), "role", "digest"))
    before = _offsets(rows, ["conv_id"], "span", {"n": F.count("*")})
    return rows.withColumn("place", place).join(before, ["conv_id", "span"]).select("conv_id", (F.col("place") + F.col("n_other")).alias("pos"), "digest", "len")


def head(conv_id: Column) -> Column:
    """How many of its family's first turns a conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conv_ids, and the rebuilt conversations' turns: conv_id, pos, digest, len."""
    turns = numbered(conversations)
    ids = turns.select("conv_id").distinct().withColumns({"family": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": head(F.col("conv_id"))})
    firsts = turns.filter(F.col("pos") < HEADS).select(F.col("conv_id").alias("family"), "pos", "digest", "len")
    begun = ids.join(firsts, "family").filter("pos <= h").select("conv_id", "pos", "digest", "len")
    # own turns move up or down by what the family's first conversation lacks of h turns
    has = firsts.groupBy("family").agg(F.max("pos").alias("has"))
    shifts = ids.join(has, "family", "left").select("conv_id", "h", (F.col("h") - F.least("h", F.coalesce("has", F.lit(0)))).alias("short"))
    own = turns.join(shifts, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("short")).alias("pos"), "digest", "len")
    return ids.select("conv_id"), begun.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """turns with span, the digest p1, p2 of all turns up to each, and upto, the text length up to it."""
    hashes = {"x1": F.xxhash64("pos", "digest"), "x2": F.xxhash64("digest", "pos", F.lit(1))}
    rows = turns.withColumn("span", F.expr(f"(pos - 1) div {SPAN}")).withColumns(hashes).drop("digest")
    before = _offsets(rows, ["conv_id"], "span", {"x1": F.bit_xor("x1"), "x2": F.bit_xor("x2"), "len": F.sum("len")})
    here = Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"r1": F.bit_xor("x1").over(here), "r2": F.bit_xor("x2").over(here), "upto": F.sum("len").over(here)}).join(before, ["conv_id", "span"])
    return rows.select("conv_id", "pos", "len", F.expr("r1 ^ x1_other").alias("p1"), F.expr("r2 ^ x2_other").alias("p2"), (F.col("upto") + F.col("len_other")).alias("upto"), F.expr("r1 ^ x1_other ^ x1").alias("q1"), F.expr("r2 ^ x2_other ^ x2").alias("q2"))


def conversation_blocks(turns: DataFrame) -> DataFrame:
    """A row a conversation and block: its inner turns (at most BLOCK) in order, the digest at its start (q1, q2) and its end (p1, p2)."""
    rows = prefixes(turns).withColumn("k", F.expr(f"(pos - 1) div {BLOCK}"))
    inner = F.array_sort(F.collect_list(F.struct("pos", "p1", "p2", "q1", "q2", "len", "upto")))
    blocks = rows.groupBy("conv_id", "k").agg(inner.alias("inner"))
    last = F.element_at("inner", -1)
    return blocks.select("conv_id", "k", "inner", last["p1"].alias("p1"), last["p2"].alias("p2"), F.col("inner")[0]["q1"].alias("q1"), F.col("inner")[0]["q2"].alias("q2"))


def _saved(limit: str, upto: Column) -> Column:
    """Text that a member doesn't own (it owns none of the first ``limit`` code points) below a depth where its text is ``upto`` long."""
    return F.greatest(F.col(limit) - upto, F.lit(0).cast("long"))


def _hashed(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p1, p2, sha256) of each node from its pieces, which come in order."""
    node, state = None, None
    for batch in pieces:
        done: list[tuple] = []
        for p1, p2, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if node != (p1, p2):
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (p1, p2), hashlib.sha256(piece.as_py().encode())
            else:
                state.update(b"," + piece.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["p1", "p2", "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()])], names=["p1", "p2", "ends_sha256"])


def _salted(rows: DataFrame) -> DataFrame:
    """rows once for each salt."""
    return rows.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))


def _with_divergence(blocks: DataFrame, starts: DataFrame) -> DataFrame:
    """Blocks with diverge: whether their start has siblings. A start with many blocks meets them in SALTS parts."""
    own = F.pmod(F.xxhash64(*NODE), F.lit(SALTS))
    return blocks.withColumn("salt", own).join(starts, ["q1", "q2", "salt"], "left").withColumn("diverge", F.coalesce("diverge", F.lit(False))).drop("salt")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ids, turns = rebuilt(conversations)
    ids, blocks, zero = checkpointed(ids), checkpointed(conversation_blocks(turns)), F.lit(0).cast("long")
    # conversations by blocks, and the starts where blocks diverge
    distinct = blocks.groupBy("k", "q1", "q2", *NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("inner").alias("inner"))
    starts = _salted(distinct.groupBy("q1", "q2").agg(F.count("*").alias("m")).filter("m > 1").select("q1", "q2", F.lit(True).alias("diverge")))
    # a node a turn: as it is where nothing diverges, grouped by the turns' digests where siblings do
    each = _with_divergence(distinct, starts).select("n", "conv_id", "diverge", F.explode("inner").alias("t")).select("n", "conv_id", "diverge", "t.*")
    turn = ["p1", "p2", "q1", "q2", "pos", "len", "upto"]
    refined = each.filter("diverge").groupBy(*turn).agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    root = ids.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0").select(*[(F.lit(None) if c in ("q1", "q2") else zero).cast("long").alias(c) for c in turn], "n", "conv_id")
    nodes = checkpointed(each.filter("NOT diverge").select(*turn, "n", "conv_id").unionByName(refined).unionByName(root))
    # where conversations end
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("k", F.element_at("inner", -1).alias("t"))).alias("l")).select("conv_id", "l.t.p1", "l.t.p2", "l.t.upto")
    ends = ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("p1", "p2", "upto")])
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*NODE, F.floor(F.col("conv_id") / IDS).alias("part")).agg(F.count("*").alias("n_ends"), piece.alias("piece"))
    counts = pieces.groupBy(*NODE).agg(F.sum("n_ends").alias("n_ends"))
    hashes = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "piece").mapInArrow(_hashed, "p1 long, p2 long, ends_sha256 string")
    # what each conversation owns, and whether its last node is a leaf that it owns
    owned = nodes.groupBy("conv_id").agg(F.sum("len").alias("owned"), F.min("pos").alias("top"))
    leaves = nodes.join(counts, NODE).filter("n = n_ends").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    members = checkpointed(ends.join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select("conv_id", (F.col("upto") - F.coalesce("owned", zero)).alias("shared"), F.coalesce("leaf", zero).alias("leaf")))
    # sums over members, again by blocks first
    inside = [F.sum(_saved("shared", F.get("inner", F.lit(j))["upto"])).alias(f"below{j}") for j in range(BLOCK)]
    sums = blocks.join(members, "conv_id").groupBy("k", "q1", "q2", *NODE).agg(F.first("inner").alias("inner"), F.sum("leaf").alias("n_leaves"), *inside)
    sums = _with_divergence(sums, starts).withColumn("below", F.array(*[f"below{j}" for j in range(BLOCK)]))
    sums = sums.select("diverge", "n_leaves", "below", F.posexplode("inner").alias("j", "t")).select("diverge", "t.p1", "t.p2", "n_leaves", F.get("below", "j").alias("below"))
    refined_sums = sums.filter("diverge").groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))
    of_root = members.agg(F.sum("leaf").alias("n_leaves"), F.sum(_saved("shared", zero)).alias("below")).filter("below IS NOT NULL").select(zero.alias("p1"), zero.alias("p2"), "n_leaves", "below")
    totals = sums.filter("NOT diverge").select(*NODE, "n_leaves", "below").unionByName(refined_sums).unionByName(of_root)
    children = nodes.filter("pos > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    # a node's parent has another owner only where its own owner's nodes begin
    begins = nodes.join(owned.select("conv_id", F.col("top").alias("pos")), ["conv_id", "pos"]).filter("pos > 0").select(*NODE, "q1", "q2").withColumn("salt", F.pmod(F.xxhash64(*NODE), F.lit(SALTS)))
    above = _salted(nodes.filter("n > 1").select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("other")))
    others = begins.join(above, ["q1", "q2", "salt"]).select(*NODE, "other")
    out = nodes.join(totals, NODE).join(children, NODE, "left").join(hashes, NODE, "left").join(others, NODE, "left")
    return out.select(
        "conv_id", F.col("pos").alias("depth"), F.when(F.col("pos") > 0, F.coalesce("other", "conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", (F.col("below") + (F.col("n") - 1) * F.col("len")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: The bits that CRC-32 takes in turn, for SQL: each byte of a decimal number, then eight shifts.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295)"""
#: DuckDB SQL for trie(conversations).
TRIE_SQL = f"""
WITH turns AS (
    SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS len, turn, coalesce(role, '') AS role
    FROM conversations WHERE conv_id IS NOT NULL),
original AS MATERIALIZED (SELECT conv_id, digest, len, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos FROM turns),
ids AS MATERIALIZED (SELECT c, c - c % 100 AS family, {_CRC_SQL} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM original)),
pieces AS (
    SELECT c, 0 AS part, pos, digest, len FROM ids JOIN original o ON o.conv_id = family AND pos <= h
    UNION ALL SELECT c, 1, pos, digest, len FROM ids JOIN original o ON o.conv_id = c AND pos > h),
rebuilt AS MATERIALIZED (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, digest, len FROM pieces),
paths AS MATERIALIZED (
    SELECT c, d, len, string_agg(digest, '/') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM ids),
own_end AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS MATERIALIZED (
    SELECT path, d, any_value(len) AS len, min(c) AS conv_id, count(*) AS n,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ended
    FROM (SELECT p.*, e.d IS NOT NULL AS ends FROM paths p LEFT JOIN own_end e ON e.c = p.c AND e.d = p.d) GROUP BY path, d),
links AS MATERIALIZED (SELECT DISTINCT b.path AS child, a.path AS parent, a.conv_id FROM nodes b JOIN nodes a ON a.d = b.d - 1 AND starts_with(b.path, a.path) WHERE b.d > 0),
kids AS (SELECT parent, count(*) AS n FROM links GROUP BY parent),
sums AS (
    SELECT a.path, sum((b.n - 1) * b.len)::BIGINT AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
    FROM nodes a JOIN nodes b ON b.d >= a.d AND starts_with(b.path, a.path) LEFT JOIN kids k ON k.parent = b.path GROUP BY a.path)
SELECT v.conv_id, d AS depth, l.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0) AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(ended) AS ends_sha256
FROM nodes v JOIN sums USING (path) LEFT JOIN links l ON l.child = v.path LEFT JOIN kids k ON k.parent = v.path
"""
