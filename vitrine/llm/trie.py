"""Conversation prefix trie by the Euler-tour technique.

A node is a distinct sequence of first turns. It is named by the exclusive or
of 128-bit hashes of (place, turn) along the sequence, which windows add up
turn by turn, so no conversation is ever held whole. Nodes are numbered by
smallest member and depth. Every node has an enter and an exit arc; an arc's
next arc is found from first children, next siblings and parents. The tour is
ranked as a linked list: chunks of neighbouring nodes contract their parts of
it to fragments, and pointer jumping over the fragments, in as many rounds as
the logarithm of their number, tells how far each is from the end. Sums over a
node's subtree are differences of prefix sums at its two arcs.

Defined cases: rows without conv_id belong to no conversation; a null role or
text is empty; turns are ordered by turn, nulls first, ties by the MD5 of role
and text (``turn_key``), and repeated rows are turns of their own; two turns are
equal if their role and text are (by MD5), two sequences if their hashes are; an
empty table has no node, not even the root; other columns are not read.

Hot groups: a conversation, a node's members, its children and those that end
there are cut into runs (``runs``). A digest of many members is one SHA-256 and
so is made in sequence, by streaming their ids in pieces through one task, which
holds one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.llm.common import WORD, n_buckets, stored, word_count
from vitrine.llm.runs import carried, earlier, in_runs, within

EVERY = 20
SHARED = 4
CHUNK_NODES = 1 << 18
NODE = ("depth", "x1", "x2")


def turn_key(role: Column, text: Column) -> Column:
    """MD5 of a turn, as hex; the length of the role tells it from the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))


def _marks(depth: Column, key: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at its place."""
    return F.xxhash64(depth.cast("long"), key), F.xxhash64(F.lit(1), key, depth.cast("long"))


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, key, words, _run) of every turn, stored."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_key(F.col("role"), F.col("text")).alias("key"),
        word_count(F.col("text")).alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    dealt = in_runs(rows, ["conv_id"], order, rows.count())
    placed = dealt.withColumn("place", F.row_number().over(within(["conv_id"], order)).cast("long"))
    placed = carried(placed, ["conv_id"], [F.count("*").alias("n")], lambda w: [F.sum("n").over(earlier(w)).alias("before")])
    return stored(placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "key", "words", "_run"), "places")


def rebuilt(turns: DataFrame, every: int = EVERY, shared: int = SHARED) -> DataFrame:
    """(conv_id, depth, x1, x2, p1, p2, words), stored: a row for each first d turns of each
    rebuilt conversation (d = 0 too), with the hashes of these turns and of all but the last.

    Conversation c takes the first h turns of conversation c - c % every, h = crc32(c) %
    shared, and then its own after the first h. ``shared`` = 1 leaves all as they are."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
    base = turns.filter(F.col("place") < shared).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "key", "words")
    takers = convs.filter("h > 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), "h")
    taken = takers.join(base, "base").filter("depth <= h").select("conv_id", "depth", "key", "words")
    # At most shared - 1 rows per conversation.
    so_far = Window.partitionBy("conv_id").orderBy("depth")
    m1, m2 = _marks(F.col("depth"), F.col("key"))
    taken = taken.withColumns({"m1": m1, "m2": m2}).select("conv_id", "depth", "m1", "m2", F.bit_xor("m1").over(so_far).alias("x1"), F.bit_xor("m2").over(so_far).alias("x2"), "words")
    taken = stored(taken, "taken")
    starts = taken.groupBy("conv_id").agg(F.count("*").alias("m"), F.bit_xor("m1").alias("s1"), F.bit_xor("m2").alias("s2"))
    own = turns.withColumn("h", h).filter("place > h").join(starts, "conv_id", "left")
    none = F.lit(0).cast("long")
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.coalesce("m", none))
    # Stored, so that the join may split a long conversation before the windows below.
    own = stored(own.withColumns({"m1": m1, "m2": m2}).select("conv_id", "_run", "depth", "m1", "m2", F.coalesce("s1", none).alias("s1"), F.coalesce("s2", none).alias("s2"), "words"), "own")
    here = within(["conv_id"], [F.col("depth")])
    summed = own.withColumns({"x1": F.bit_xor("m1").over(here), "x2": F.bit_xor("m2").over(here)})
    aggregates = [F.bit_xor("m1").alias("t1"), F.bit_xor("m2").alias("t2")]
    summed = carried(summed, ["conv_id"], aggregates, lambda w: [F.bit_xor("t1").over(earlier(w)).alias("b1"), F.bit_xor("t2").over(earlier(w)).alias("b2")])
    full = lambda k: F.col(f"x{k}").bitwiseXOR(F.col(f"s{k}")).bitwiseXOR(F.coalesce(f"b{k}", none)).alias(f"x{k}")
    rows = taken.select("conv_id", "depth", "x1", "x2", "m1", "m2", "words").unionByName(summed.select("conv_id", "depth", full(1), full(2), "m1", "m2", "words"))
    rows = rows.select("conv_id", *NODE, F.col("x1").bitwiseXOR(F.col("m1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("m2")).alias("p2"), "words")
    root = convs.select("conv_id", *(none.alias(c) for c in NODE), *(F.lit(None).cast("long").alias(c) for c in ("p1", "p2")), none.alias("words"))
    return stored(rows.unionByName(root), "prefixes")


def tree(prefixes: DataFrame) -> tuple[DataFrame, int]:
    """The nodes, stored, and their number: v (from 0, by smallest member and depth), u (the
    parent's v), first and next (v of the first child and of the next sibling), conv_id,
    parent_conv_id, n_convs, n_children, words and the node's name."""
    nodes = prefixes.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    nodes = stored(nodes, "nodes")
    total = nodes.count()
    order = [F.col("conv_id"), F.col("depth")]
    dealt = in_runs(nodes, [], order, total)
    # A row per run.
    sizes = dealt.groupBy("_run").agg(F.count("*").alias("n"))
    sizes = F.broadcast(sizes.select("_run", (F.sum("n").over(Window.orderBy("_run")) - F.col("n")).alias("start")))
    v = F.row_number().over(Window.partitionBy("_run").orderBy(*order)) - 1
    dealt = stored(dealt.withColumn("v", v).join(sizes, "_run").withColumn("v", F.col("v") + F.col("start")).drop("_run", "start"), "numbered")
    up = dealt.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("v").alias("u"), F.col("conv_id").alias("parent_conv_id"))
    hung = stored(dealt.join(up, ["depth", "p1", "p2"], "left"), "hung")
    kids = hung.filter("u IS NOT NULL").select("u", "v")
    first = kids.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("first"), F.count("*").alias("n_children"))
    own = [F.col("v")]
    kids = in_runs(kids, ["u"], own, total)
    kids = kids.withColumn("next", F.lead("v").over(within(["u"], own)))
    kids = carried(kids, ["u"], [F.min("v").alias("low")], lambda w: [F.lead("low").over(w).alias("beyond")])
    following = kids.select("v", F.coalesce("next", "beyond").alias("next"))
    return stored(hung.join(first, "v", "left").join(following, "v", "left"), "tree"), total


def _contract(first: np.ndarray, after: np.ndarray, up: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk's arcs (2v enters, 2v + 1 exits; -1: none): next arc, first arc of the
    fragment, steps from there, and whether the next arc lies outside the chunk."""
    n = len(v)
    own = np.concatenate([2 * v, 2 * v + 1])
    nxt = np.concatenate([np.where(first >= 0, 2 * first, 2 * v + 1), np.where(after >= 0, 2 * after, np.where(up >= 0, 2 * up + 1, -1))])
    by = np.argsort(own)
    at = np.minimum(np.searchsorted(own[by], nxt), 2 * n - 1)
    inside = own[by][at] == nxt
    # Pointer doubling backwards: each arc's predecessor in the chunk, or itself at a head.
    back = np.arange(2 * n)
    back[by[at[inside]]] = np.flatnonzero(inside)
    steps = (back != np.arange(2 * n)).astype(np.int64)
    while True:
        further = back[back]
        if (further == back).all():
            break
        steps, back = steps + steps[back], further
    return nxt, own[back], steps, ~inside


def tour_positions(nodes: DataFrame, total: int) -> DataFrame:
    """(v, enter, position) of every arc of the Euler tour, positions from 0, by list ranking."""
    size = max(1, -(-total // max(n_buckets(nodes.sparkSession), -(-total // CHUNK_NODES))))

    def contract(rows: pd.DataFrame) -> pd.DataFrame:
        v = rows["v"].to_numpy(np.int64)
        first, after, up = (rows[c].fillna(-1).to_numpy(np.int64) for c in ("first", "next", "u"))
        nxt, head, steps, tail = _contract(first, after, up, v)
        enter = np.arange(2 * len(v)) < len(v)
        return pd.DataFrame({"v": np.concatenate([v, v]), "enter": enter, "head": head, "steps": steps, "tail": tail, "next": nxt})

    rows = nodes.select("v", *(F.coalesce(c, F.lit(-1).cast("long")).alias(c) for c in ("first", "next", "u")), F.expr(f"v div {size}").alias("chunk"))
    arcs = stored(rows.groupBy("chunk").applyInPandas(contract, "v long, enter boolean, head long, steps long, tail boolean, next long"), "arcs")
    # A fragment: its head, the head of the next one (none: -1), and how many arcs it has.
    # ``left`` becomes the number of arcs up to the tour's end.
    parts = stored(arcs.filter("tail").select("head", "next", (F.col("steps") + 1).alias("left")), "fragments")
    while not parts.filter("next >= 0").isEmpty():
        ahead = parts.select(F.col("head").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        jumped = parts.filter("next >= 0").join(ahead, "next").select("head", F.col("_next").alias("next"), (F.col("left") + F.col("_left")).alias("left"))
        parts = stored(parts.filter("next < 0").unionByName(jumped), "fragments")
    return arcs.join(parts.select("head", "left"), "head").select("v", "enter", (F.lit(2 * total) - F.col("left") + F.col("steps")).alias("position"))


def subtree_sums(nodes: DataFrame, total: int, values: dict[str, Column]) -> DataFrame:
    """(v, a column per value): the sum of each value over the node's subtree, from prefix
    sums over the tour. A chunk of positions is summed up at a time."""
    size = max(1, -(-2 * total // max(n_buckets(nodes.sparkSession), -(-total // CHUNK_NODES))))
    own = nodes.select("v", *(x.cast("long").alias(c) for c, x in values.items()))
    none = F.lit(0).cast("long")
    # An exit arc adds nothing.
    arcs = tour_positions(nodes, total).join(own, "v").select(
        "v", "enter", "position", F.expr(f"position div {size}").alias("chunk"), *(F.when(F.col("enter"), F.col(c)).otherwise(none).alias(c) for c in values)
    )
    arcs = stored(arcs, "positions")
    # A row per chunk.
    sums = arcs.groupBy("chunk").agg(*(F.sum(c).alias(f"_{c}") for c in values))
    chunks = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("chunk", *(F.coalesce(F.sum(f"_{c}").over(chunks), none).alias(f"_{c}") for c in values))
    so_far = Window.partitionBy("chunk").orderBy("position")
    sums_here = arcs.join(sums, "chunk").select("v", "enter", *(F.col(c).alias(f"own_{c}") for c in values), *((F.sum(c).over(so_far) + F.col(f"_{c}")).alias(c) for c in values))
    # Up to the exit, less what was there before the enter.
    signed = [F.sum(F.when(F.col("enter"), F.col(f"own_{c}") - F.col(c)).otherwise(F.col(c))).alias(c) for c in values]
    return sums_here.groupBy("v").agg(*signed)


def end_digests(prefixes: DataFrame) -> DataFrame:
    """(node's name, ends_sha256) of the nodes where conversations end: SHA-256 of their
    ids, ascending, joined by commas."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("end")).select("conv_id", "end.*")
    last = stored(last, "ends")
    dealt = in_runs(last, list(NODE), [F.col("conv_id")], last.count())
    # A piece has a run's ids at most.
    pieces = dealt.groupBy(*NODE, "_run").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for b in batches:
            out = []
            for *key, ids in zip(*(b[c] for c in NODE), b["ids"]):
                if key != name:
                    if state is not None:
                        out.append((*name, state.hexdigest()))
                    name, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(*name, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    ordered = pieces.repartition(n_buckets(prefixes.sparkSession), *NODE).sortWithinPartitions(*NODE, "_run")
    return ordered.select(*NODE, "ids").mapInPandas(run, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, every: int = EVERY, shared: int = SHARED) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations (``rebuilt``): conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes = rebuilt(own_turns(conversations), every, shared)
    nodes, total = tree(prefixes)
    # The root has no turn, so no words.
    sums = subtree_sums(nodes, total, {"n_leaves": F.col("first").isNull().cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    out = nodes.join(sums, "v").join(end_digests(prefixes), list(NODE), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256")
    )


def op12_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP12_SQL = rf"""
WITH RECURSIVE bits(i, v, k) AS (SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc(c, s, k, v) AS (SELECT DISTINCT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c, s, crc.k + 1, xor(crc.v >> 8, bits.v) FROM crc JOIN bits ON bits.k = 8 AND bits.i = xor(crc.v & 255, ascii(substr(s, crc.k + 1, 1))) WHERE crc.k < length(s)),
convs AS (SELECT c AS conv_id, c - c % {EVERY} AS base, xor(v, 4294967295) % {SHARED} AS h FROM crc WHERE k = length(s)),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, md5(length(role)::VARCHAR || ':' || role || text) AS key, len(regexp_extract_all(text, '{WORD}')) AS words FROM turns),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS p FROM keyed),
taken AS (SELECT convs.conv_id, p AS depth, key, words FROM convs JOIN own ON own.conv_id = base AND p <= h),
m AS (SELECT conv_id, count(*) AS m FROM taken GROUP BY 1),
rows AS (SELECT * FROM taken UNION ALL
  SELECT own.conv_id, coalesce(m, 0) + p - h, key, words FROM own JOIN convs USING (conv_id) LEFT JOIN m USING (conv_id) WHERE p > h),
pre AS (SELECT conv_id, depth, words, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rows
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words FROM pre GROUP BY 1, 2),
kids AS (SELECT left(path, 32 * (depth - 1)::BIGINT) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
sub AS (SELECT a.path, count_if(n_children IS NULL) AS n_leaves, sum((n - 1) * u.words) AS saved
  FROM nodes u LEFT JOIN kids USING (path) JOIN pre a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY 1),
tails AS (SELECT conv_id, max_by(path, depth) AS path FROM pre GROUP BY 1),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM tails GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes x JOIN sub USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes up ON x.depth > 0 AND up.path = left(x.path, 32 * (x.depth - 1)::BIGINT)
"""
