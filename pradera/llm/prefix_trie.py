"""Trie of the prefixes that conversations share.

A node is a distinct sequence of first turns (role and text); its members are the conversations that begin with it.

* *Sequences.*  A turn is the first 128 bits of a SHA-256; turns are numbered by an ordered scan, so that no conversation
  has to fit into a task.  A conversation is cut into layers of SEGMENT turns.  Conversations with the same turns before
  a layer (a 128-bit fingerprint, ``e1``, ``e2``) form a piece of the trie; the last node of a layer is the root of a piece
  of the next.  Equal segments of a piece are one row, with their members counted up, before anything is sorted.
* *Forest.*  Rows are range-partitioned and sorted by (layer, piece, segment).  In each block of a partition the edges
  between sorted neighbours, as long as their common prefix, are taken by union-find in descending depth: every merge of
  components makes a node that branches, and the turns between two such nodes are the nodes in between.
* *Boundaries.*  A node that holds the first or last row of its block may go on in another one: a block's forest is
  contracted to these and its pieces' roots, which are merged by their fingerprint.  All other nodes are complete.

Sums over a subtree are sums over members: of a member's code points, and, for the member of smallest id in each node,
of the nodes it stands for.  So the forest is built twice: once for the members and smallest ids, once with these sums.

Rows without conv_id belong to no conversation.  Null roles and texts are empty.  Turns are ordered by number (null
first), those with the same number by role, then text; repeated rows are turns of their own.  Empty texts are turns of
no code point.  An empty table gives no row.  Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pradera.operators.scan import ordered_scan
from pradera.session import ship_package

from .common import stored

SEGMENT = 128         # turns of a layer
WIDTH = 16            # bytes of a turn's digest
SHARED = 6            # a conversation takes up to SHARED - 1 first turns from the one that its hundred begins with
IDS = 1 << 13         # ids of a chunk that is hashed

PIECE = ["layer", "e1", "e2"]
_NODES = ("node binary, pkey binary, prep long, depth long, before long, conv long, own long, total long, n long, nc long, "
          "end_id long, wt long, wo long, wl long")
_KINDS = {"long": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in _NODES.split(","))])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 0), ``digest``, ``chars`` of every turn."""
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    t = t.withColumns({"digest": F.unhex(F.substring("digest", 1, 2 * WIDTH)), "chars": F.length("text").cast("long")})
    t = ordered_scan(t, ["conv_id"], ["turn", "role", "text"], row_number="pos")
    return t.select("conv_id", (F.col("pos") - 1).cast("long").alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: ``conv_id``, ``depth`` (from 1), ``digest``, ``chars``, and all conv_ids.

    Conversation c gets the first h turns of c - c % 100 (h: CRC-32 of c's decimal, mod SHARED) and then its own turns
    behind its first h.
    """
    turns = stored(turns, "trie-turns")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED,
                               "base": F.col("conv_id") - F.col("conv_id") % 100})
    n_base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("nb"))
    # turns taken from the base; a base that doesn't exist has none
    convs = stored(convs.join(n_base, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("taken")), "trie-conversations")
    opening = turns.where(F.col("pos") < SHARED - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lead = convs.join(opening, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "digest",
                                                               "chars")
    own = turns.join(convs, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "digest", "chars")
    return lead.union(own), convs.select("conv_id")


def _segments(turns: DataFrame, convs: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """A row per conversation and layer, and ``conv_id``, ``total`` (code points) of every conversation.

    Rows: ``conv_id``, ``layer``, ``e1``, ``e2`` (the piece), ``key`` (digests), ``chars`` (of each turn), ``base`` (code
    points before the layer), ``n1``, ``n2`` (the piece that a whole segment leads to).  A conversation that ends with a
    layer's last turn has an empty segment in the next one.
    """
    layer = ((F.col("depth") - 1 - (F.col("depth") - 1) % segment) / segment).cast("long")
    turn = F.struct("depth", "digest", "chars")
    s = turns.groupBy("conv_id", layer.alias("layer")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    # hexadecimal, as binary values can't be joined
    s = s.select("conv_id", "layer", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), "")).alias("key"),
                 F.transform("t", lambda x: x["chars"]).alias("chars"))
    s = stored(s, "trie-segments")
    size = F.col("chars")
    whole = F.size(size) == segment
    sums = s.select("conv_id", "layer", F.aggregate(size, F.lit(0).cast("long"), lambda a, x: a + x).alias("sum"),
                    F.xxhash64("layer", "key").alias("x1"), F.xxhash64("key", F.lit("next"), "layer").alias("x2"),
                    whole.alias("whole"))
    ends = sums.groupBy("conv_id").agg(F.sum("sum").alias("total"), F.max_by("whole", "layer").alias("even"),
                                       F.max("layer").alias("last"))
    totals = stored(convs.join(ends, "conv_id", "left").select(
        "conv_id", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("even", F.lit(True)).alias("even"),
        F.coalesce("last", F.lit(-1)).alias("last")), "trie-totals")
    empty = totals.where("even").select("conv_id", (F.col("last") + 1).alias("layer"))
    none = [F.unhex(F.lit("")).alias("key"), F.array().cast("array<bigint>").alias("chars")]
    s = s.union(empty.select("conv_id", "layer", *none))
    # what lies before a layer: only for conversations that have more than one
    before = Window.partitionBy("conv_id").orderBy("layer").rowsBetween(Window.unboundedPreceding, -1)
    more = sums.where("whole OR layer > 0").select("conv_id", "layer", "sum", "x1", "x2").union(
        empty.where("layer > 0").select("conv_id", "layer", *[F.lit(0).cast("long")] * 3))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    more = more.select("conv_id", "layer", zero(F.bit_xor("x1").over(before)).alias("e1"),
                       zero(F.bit_xor("x2").over(before)).alias("e2"), zero(F.sum("sum").over(before)).alias("base"),
                       "x1", "x2")
    more = more.select("conv_id", "layer", "e1", "e2", "base", F.col("e1").bitwiseXOR(F.col("x1")).alias("n1"),
                       F.col("e2").bitwiseXOR(F.col("x2")).alias("n2"))
    several = (F.size("chars") == segment) | (F.col("layer") > 0)
    one = s.where(~several).select("conv_id", "layer", "key", "chars",
                                   *[F.lit(0).cast("long").alias(c) for c in ("e1", "e2", "base", "n1", "n2")])
    rows = s.where(several).join(more, ["conv_id", "layer"]).select(*one.columns).union(one)
    return stored(rows, "trie-segments"), totals.select("conv_id", "total")


def _elements(segments: DataFrame) -> DataFrame:
    """Equal segments of a piece as one row: members and the sums over them."""
    first = F.min(F.struct("conv_id", "own", "total"))
    rest = [F.first(c).alias(c) for c in ("chars", "base", "n1", "n2")]  # the same in all
    e = segments.groupBy(*PIECE, "key").agg(F.count(F.lit(1)).alias("n"), first.alias("f"), F.sum("total").alias("wt"),
                                            F.sum("own").alias("wo"), F.sum("leaf").alias("wl"), *rest)
    return stored(e.select(*PIECE, "key", "n", F.col("f.conv_id").alias("conv"), "f.own", "f.total", "wt", "wo", "wl", "chars",
                           "base", "n1", "n2"), "trie-elements")


class _Node:
    """A node that ends or branches: rows ``low`` .. ``high`` of the block begin with it."""

    __slots__ = ("depth", "low", "high", "first", "sums", "kids", "end")

    def __init__(self, depth, low, high, first, sums, kids, end=None):
        self.depth, self.low, self.high, self.first = depth, low, high, first
        self.sums, self.kids, self.end = sums, kids, end

    def take(self, other: _Node) -> None:
        """``other``, the next component, is merged into this one's."""
        self.high = other.high
        self.first = min(self.first, other.first)
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        if other.depth > self.depth:
            self.kids.append(other)
        else:
            self.kids += other.kids


def _common(a: bytes, b: bytes) -> int:
    """Turns that two segments begin with."""
    n = min(len(a), len(b)) // WIDTH
    if a[:n * WIDTH] == b[:n * WIDTH]:
        return n
    return next(k for k in range(n) if a[k * WIDTH:(k + 1) * WIDTH] != b[k * WIDTH:(k + 1) * WIDTH])


def forest(pieces: list[tuple], keys: list[bytes], tops: list[_Node]) -> list[_Node]:
    """Roots (depth 0) of the pieces of sorted rows; ``tops``: each row's own node, ``pieces``: its piece."""
    up = list(range(len(keys)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    edges = [(-_common(keys[i - 1], keys[i]), i) for i in range(1, len(keys)) if pieces[i] == pieces[i - 1]]
    for depth, i in sorted(edges):
        depth, a, b = -depth, find(i - 1), find(i)
        node = tops[a]
        if node.depth > depth:
            node = _Node(depth, node.low, node.high, node.first, node.sums, [node])
        node.take(tops[b])
        up[b], tops[a] = a, node
    out = []
    for i in range(len(keys)):
        if up[i] == i:
            t = tops[i]
            out.append(t if t.depth == 0 else _Node(0, t.low, t.high, t.first, t.sums, [t]))
    return out


def _block_nodes(block: pa.Table, segment: int) -> list[tuple]:
    """All nodes of a block; those that may go on elsewhere have a ``node``, or if their parent may, a ``pkey``."""
    col = {c: block.column(c).to_pylist() for c in block.column_names}
    keys, chars, last = col["key"], col["chars"], block.num_rows - 1
    pieces = list(zip(*(col[c] for c in PIECE), strict=True))
    tops = []
    for i, key in enumerate(keys):
        first = (col["conv"][i], col["own"][i], col["total"][i])
        size = len(key) // WIDTH
        tops.append(_Node(size, i, i, first, [col[c][i] for c in ("n", "wt", "wo", "wl")], [],
                          first[0] if size < segment else None))

    def touches(x: _Node) -> bool:
        return x.low == 0 or x.high == last

    def mark(i: int, depth: int) -> bytes:
        if depth == segment:
            return struct.pack(">qqq", pieces[i][0] + 1, col["n1"][i], col["n2"][i])
        own = hashlib.blake2b(keys[i][:depth * WIDTH], digest_size=16).digest() if depth else b""
        return struct.pack(">qqq", *pieces[i]) + own

    out = []
    for root in forest(pieces, keys, tops):
        stack = [(root, None)]
        while stack:
            x, parent = stack.pop()
            i, edge = x.low, touches(x)
            layer = pieces[i][0]
            low = parent.depth + 1 if parent else 0
            before = col["base"][i] + sum(chars[i][:max(low - 1, 0)])
            for d in range(low, x.depth + 1):
                shared = edge or d in (0, segment)
                pkey = prep = None
                if d:  # the node above may be the parent or lie between
                    over = parent if d == low else x
                    if touches(over) or d == 1:
                        pkey = mark(i, d - 1)
                    else:
                        prep = over.first[0]
                if d > max(low, 1):
                    before += chars[i][d - 2]
                at = before if d else (0 if layer == 0 else None)
                node = mark(i, d) if shared else None
                if d == segment:  # its members are counted where the next layer begins
                    out.append((node, pkey, prep, layer * segment + d, at, *[None] * 9))
                    continue
                if d < x.depth:
                    kids = [edge or d + 1 == segment]
                else:
                    kids = [touches(k) or d + 1 == segment for k in x.kids]
                n, *sums = x.sums
                end = x.end if d == x.depth else None
                out.append((node, pkey, prep, layer * segment + d, at, *x.first, n,
                            sum(not k for k in kids) if shared else len(kids), end, *sums))
            stack += [(k, x) for k in x.kids]
    return out


def _nodes(elements: DataFrame, segment: int) -> DataFrame:
    """Every node: ``conv`` (smallest member, with its ``own`` and ``total``), ``depth``, ``before`` (code points of the turns
    before its last one), ``n``, ``nc`` (children), ``parent``, ``end_id`` and the sums over its members."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = _block_nodes(pa.Table.from_batches([b]), segment)
                for at in range(0, len(rows), 1 << 14):
                    part = zip(*rows[at:at + (1 << 14)], strict=True)
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(part, _SCHEMA, strict=True)], schema=_SCHEMA)

    ship_package(elements.sparkSession)
    order = [*PIECE, "key"]
    tasks = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = elements.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, _NODES)
    found = stored(found, "trie-nodes")
    parts = found.where("node is not null")
    merged = parts.groupBy("node").agg(
        F.max("pkey").alias("pkey"), F.max("prep").alias("prep"), F.max("depth").alias("depth"),
        F.max("before").alias("before"), F.min(F.when(F.col("conv").isNotNull(), F.struct("conv", "own", "total"))).alias("f"),
        *[F.sum(c).alias(c) for c in ("n", "nc", "wt", "wo", "wl")], F.max("end_id").alias("end_id"))
    merged = stored(merged, "trie-merged")
    kids = merged.where("pkey is not null").groupBy(F.col("pkey").alias("node")).agg(F.count(F.lit(1)).alias("_kids"))
    merged = merged.join(kids, "node", "left").withColumns({
        "nc": F.col("nc") + F.coalesce("_kids", F.lit(0)), "conv": F.col("f.conv"), "own": F.col("f.own"),
        "total": F.col("f.total")}).select(*found.columns)
    merged = stored(merged, "trie-merged")
    nodes = found.where("node is null").union(merged)
    parents = merged.select(F.col("node").alias("pkey"), F.col("conv").alias("parent"))
    known = nodes.where("pkey is null").withColumn("parent", F.col("prep"))
    sought = nodes.where("pkey is not null").join(parents, "pkey", "left").select(*known.columns)
    return known.union(sought).drop("node", "pkey", "prep")


def _end_digests(segments: DataFrame, segment: int) -> DataFrame:
    """``end_id`` (smallest conversation that ends at a node) and ``ends_sha256`` of all of them, ascending.

    Ids are joined to chunks where they lie, in order; a node's chunks are hashed one after the other, as SHA-256 asks.
    """
    def chunks(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = b.column("ekey").to_pylist(), b.column("conv_id").to_pylist()
            rows, at = [], 0
            for k in range(1, len(ids) + 1):
                if k == len(ids) or keys[k] != keys[at] or k - at == IDS:
                    rows.append((keys[at], ids[at], ",".join(map(str, ids[at:k]))))
                    at = k
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["ekey", "first", "ids"])

    def digests(batches) -> Iterator[pa.RecordBatch]:
        now, end, sha = None, None, None
        for b in batches:
            out = []
            for key, first, ids in zip(*(b.column(c).to_pylist() for c in ("ekey", "first", "ids")), strict=True):
                if key == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((end, sha.hexdigest()))
                    now, end, sha = key, first, hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names=["end_id", "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([end]), pa.array([sha.hexdigest()])], names=["end_id", "ends_sha256"])

    ends = segments.where(F.size("chars") < segment).select(
        F.unhex(F.sha2(F.concat(*[F.col(c).cast("string").cast("binary") for c in PIECE], F.lit(":").cast("binary"), "key"), 256))
        .alias("ekey"), "conv_id")
    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = (ends.repartitionByRange(tasks, "ekey", "conv_id").sortWithinPartitions("ekey", "conv_id")
              .mapInArrow(chunks, "ekey binary, first long, ids string"))
    return (joined.repartition("ekey").sortWithinPartitions("ekey", "first")
            .mapInArrow(digests, "end_id long, ends_sha256 string"))


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Every node of the trie of ``turns`` (``conv_id``, ``depth`` from 1, ``digest``, ``chars``); ``convs``: all conv_ids.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's; root: null), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree: members but one, times code points of the last text),
    ``ends_sha256`` (of the ids of the members that end at the node).  Conversations without turns are at the root.
    """
    segments, totals = _segments(turns, convs, segment)
    nothing = {c: F.lit(0).cast("long") for c in ("own", "total", "leaf")}
    first = _nodes(_elements(segments.withColumns(nothing)), segment)
    # a conversation is the smallest member from some depth on, down to its end
    chain = first.groupBy("conv").agg(F.min_by("before", "depth").alias("_before"), F.max(F.col("nc") == 0).alias("_leaf"))
    about = stored(totals.join(chain, F.col("conv_id") == F.col("conv"), "left").select(
        "conv_id", "total", F.coalesce(F.col("total") - F.col("_before"), F.lit(0)).alias("own"),
        F.coalesce(F.col("_leaf").cast("long"), F.lit(0)).alias("leaf")), "trie-weights")
    nodes = _nodes(_elements(segments.join(about, "conv_id")), segment)
    spent = F.col("wt") - F.col("n") * F.col("before")  # every member's code points from the node on
    held = F.col("wo") - F.col("own") + F.col("total") - F.col("before")  # every node's once
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return nodes.join(_end_digests(segments, segment), "end_id", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("nc").alias("n_children"), F.col("wl").alias("n_leaves"), (spent - held).alias("saved_tokens"),
        ends.alias("ends_sha256"))


def sql(conversations: str = "conversations") -> str:
    """DuckDB SQL for the rows of the query: nodes by their whole prefixes, subtrees by joining them."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(s)),
        lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
          lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
    return f"""
WITH seqs AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM {conversations} WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT *, {crc} % {SHARED} AS h FROM (SELECT *, CAST(conv_id AS VARCHAR) AS s FROM seqs)),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM heads a LEFT JOIN seqs b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, len(turns) AS size, sha256(CAST(turns[1:d] AS VARCHAR)) AS node,
         CASE WHEN d > 0 THEN sha256(CAST(turns[1:d - 1] AS VARCHAR)) END AS above,
         CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, node, above, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends
  FROM prefixes GROUP BY d, node, above),
kids AS (SELECT above AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (nodes.n - 1) * chars AS saved
        FROM nodes LEFT JOIN kids ON kids.node = nodes.node AND kids.d = nodes.d),
below AS (  -- each node with all nodes above it and itself, through its smallest member
  SELECT p.node, p.d, sum(o.saved) AS saved, count(*) FILTER (o.n_children = 0) AS leaves
  FROM own o JOIN prefixes p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY ALL)
SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, o.ends AS ends_sha256
FROM own o JOIN below b ON b.node = o.node AND b.d = o.d LEFT JOIN own p ON p.node = o.above AND p.d = o.d - 1
"""
