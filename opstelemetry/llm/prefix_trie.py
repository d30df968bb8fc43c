"""Conversation prefix trie by a depth-band rollup.

Turns are range-sorted by conversation and turn; the partitions' own counts and sums give each turn its place, so
one conversation may spread over any number of tasks. A prefix is named by 128 bits: the exclusive or of the
SHA-256 of (place, role, text) of its turns, which the same two levels accumulate. A node is a name and a depth; its
smallest member and its depth identify it from then on.

Totals over subtrees go by bands of ``HEIGHT`` depths. A node never meets more ancestors than its band has: it
explodes to those. What hangs below a band reaches it through the nodes at its lower edge, whose totals are
completed first, by the same method on the tree of edge nodes only. Each such tree is ``HEIGHT`` times
shallower, so the rounds grow with the logarithm of the depth and a node emits at most ``HEIGHT`` rows a round.

Ids of conversations that end at a node are hashed as one text. They are sorted by range and joined to pieces of
``PIECE`` ids, and a task feeds a node's pieces to SHA-256 in order, one at a time.

Null role or text is empty. A null turn comes first; equal turns are ordered by role, the first 64 characters of the
text and its SHA-256. Repeated rows are turns of their own. Rows without conv_id belong to no conversation. An empty
table has no conversations and so no nodes. Other columns are not read. Texts of any length are read
once, for their hash and size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.functions.scale import settle
from opstelemetry.llm.ordering import placed

HEIGHT = 16
PIECE = 1024
_NODE = ["depth", "a", "b"]


def _accumulated(rows: DataFrame, **values: tuple) -> DataFrame:
    """Add, for each name, an aggregate over the rows of the conversation up to this one.

    ``rows`` come from ``placed`` by conversation. Each value is (aggregate, column, combine, start). A partition
    has at most one conversation that began in an earlier one, so the offsets are a row a partition.
    """
    inside = W.partitionBy("__part", "conv_id").orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    parts = rows.groupBy("conv_id", "__part").agg(*[f(c).alias(n) for n, (f, c, _, _) in values.items()])
    before = W.partitionBy("conv_id").orderBy("__part")
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("conv_id").alias("__c"), F.col("__part").alias("__p"), F.row_number().over(before).alias("__nth"),
        *[f(n).over(earlier).alias(f"__{n}") for n, (f, _, _, _) in values.items()],
    ).where("__nth > 1")
    local = rows.select("*", *[f(c).over(inside).alias(f"__in_{n}") for n, (f, c, _, _) in values.items()])
    joined = local.join(settle(offsets), (F.col("__part") == F.col("__p")) & (F.col("conv_id") == F.col("__c")), "left")
    out = [combine(F.col(f"__in_{n}"), F.coalesce(f"__{n}", F.lit(s))).alias(n) for n, (_, _, combine, s) in values.items()]
    return joined.select(*rows.columns, *out)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with their number from 1 in their conversation."""
    found = _accumulated(placed(rows, [F.col("conv_id"), *order]), **{name: (F.sum, F.lit(1), _plus, 0)})
    return found.withColumn(name, F.col(name).cast("bigint"))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, role, digest, bytes) of every turn."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("__head"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"),
        F.xxhash64(F.monotonically_increasing_id()).alias("__salt"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("__head"), F.col("digest"), F.col("__salt")]
    return _numbered(rows, order, "place").select("conv_id", "place", "role", "digest", "bytes")


def grafted(own: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Rebuilt conversations: the first h turns of conversation c - c % group, then c's own after its first h.

    ``place`` keeps the order but has gaps where the first conversation is short or absent.
    """
    ids = own.select("conv_id").distinct()
    c = F.col("conv_id")
    kept = F.crc32(c.cast("string")) % most
    head = own.where((F.col("place") < most) & (c % group == 0)).withColumnRenamed("conv_id", "__base")
    heads = ids.withColumn("__base", c - c % group).join(head, "__base").where(F.col("place") <= kept).drop("__base")
    return heads.unionByName(own.where(F.col("place") > kept))


def prefixes(rebuilt: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, bytes): all prefixes of every conversation, from the empty one."""
    rows = _numbered(rebuilt, [F.col("place")], "depth")
    turn = F.sha2(F.concat_ws(":", "depth", F.octet_length("role"), "role", "digest"), 256)
    own = [F.conv(F.substring(turn, 1 + 16 * i, 16), 16, -10).cast("bigint") for i in range(2)]
    rows = settle(rows.select("conv_id", "depth", "bytes", "__part", "__at", own[0].alias("__own_a"), own[1].alias("__own_b")))

    def xor(x: Column, y: Column) -> Column:
        return x.bitwiseXOR(y)

    named = _accumulated(rows, a=(F.bit_xor, F.col("__own_a"), xor, 0), b=(F.bit_xor, F.col("__own_b"), xor, 0))
    up = [xor(F.col(n), F.col(f"__own_{n}")).alias(f"up_{n}") for n in "ab"]
    empty = ids.selectExpr("conv_id", "0L as depth", "0L as a", "0L as b", "0L as up_a", "0L as up_b", "0L as bytes")
    return named.select("conv_id", "depth", "a", "b", *up, "bytes").unionByName(empty)


def banded(paths: DataFrame, nodes: DataFrame, step: int, height: int) -> DataFrame:
    """(depth, a, b, edge, above): of the nodes at multiples of ``step``, the ancestors in the band and those at its upper edge.

    A band holds the ``height`` steps below its upper edge, and ``above`` the node's ancestors there, itself included.
    """
    rows = paths.where(F.col("depth") % step == 0).select("conv_id", "depth", F.struct(*_NODE).alias("__node"))
    band = F.floor((F.col("depth") - step) / (step * height)).cast("bigint")
    below = F.floor(F.col("depth") / (step * height)).cast("bigint")
    edge = F.col("depth") % (step * height) == 0
    # an edge node closes its band and heads the next one; the first closes none
    rows = rows.withColumn("band", F.explode(F.when(F.col("depth") == 0, F.array(below)).when(edge, F.array(band, below)).otherwise(F.array(band))))
    line = W.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__line", F.collect_list("__node").over(line)).where(F.size("__line") > 1)
    rows = rows.select("conv_id", "depth", F.col("__line")[0].alias("edge"), F.slice("__line", 2, height).alias("above"))
    first = nodes.where(F.col("depth") % step == 0).select(F.col("conv_id"), *_NODE)
    return first.join(rows, ["conv_id", "depth"]).select(*_NODE, "edge", "above")


def rolled_up(paths: DataFrame, nodes: DataFrame, values: Sequence[str], height: int = HEIGHT) -> DataFrame:
    """(depth, a, b, values): sums over each node's subtree, the node included."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(v).alias(v) for v in values]
    own = nodes.select(*_NODE, *values)
    levels, step = [], 1
    while True:
        bands = settle(banded(paths, nodes, step, height))
        levels.append((step, own, bands))
        edge = F.col("depth") % (step * height) == 0
        # what stands between two edges counts for the upper one
        hung = bands.where(~edge).join(own, _NODE).select("edge.*", *values)
        own = settle(own.where(edge).unionByName(hung).groupBy(*_NODE).agg(*sums))
        if step * height > deepest:
            break
        step *= height
    done = own  # the root, whose subtree is all
    for step, own, bands in reversed(levels):
        edge = F.col("depth") % (step * height) == 0
        known = own.where(~edge).unionByName(done.where("depth > 0"))
        spread = bands.join(known, _NODE).select(F.explode("above").alias("n"), *values).select("n.*", *values)
        done = settle(spread.groupBy(*_NODE).agg(*sums).unionByName(done.where("depth = 0")))
    return done


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest per node; its pieces come one after the other."""
    node, state = None, hashlib.sha256()
    kind = pa.schema([*[(n, pa.int64()) for n in _NODE], ("ends_sha256", pa.string())])

    def table(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kind.types, strict=True)], schema=kind)

    for batch in batches:
        done = []
        keys = zip(*[batch.column(n).to_pylist() for n in _NODE], strict=True)
        for key, ids in zip(keys, batch.column("ids"), strict=True):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.as_py().encode())
        if done:
            yield table(done)
    if node is not None:
        yield table([(*node, state.hexdigest())])


def ends(paths: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes at which conversations end."""
    last = paths.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    rows = placed(paths.select("conv_id", *_NODE).join(last, ["conv_id", "depth"]), [*_NODE, "conv_id"])
    rows = rows.withColumn("__piece", F.floor(F.col("__at") / piece))
    by = [*_NODE, "__part", "__piece"]
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = rows.groupBy(*by).agg(ids.alias("ids")).repartition(*_NODE).sortWithinPartitions(*by)
    return pieces.select(*by, "ids").mapInArrow(_sha256, "depth bigint, a bigint, b bigint, ends_sha256 string")


def trie(conversations: DataFrame, group: int = 5, most: int = 9, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    own = settle(turns(conversations))
    paths = settle(prefixes(grafted(own, group, most), own.select("conv_id").distinct()))
    nodes = paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"),
    )
    nodes = settle(nodes)
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = settle(
        nodes.join(children, _NODE, "left").select(
            *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("n_children").isNull().cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        )
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    held = settle(nodes.drop("n_leaves", "saved_tokens").join(parents, ["depth", "up_a", "up_b"], "left"))
    totals = rolled_up(paths, nodes, ["n_leaves", "saved_tokens"], height)
    out = held.join(totals, _NODE).join(ends(paths), _NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def oracle_sql(group: int = 5, most: int = 9) -> str:
    """Prefixes as lists; the unsigned crc32 of the id's digits bit by bit."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
               range(1, len(c::VARCHAR) + 1), lambda i: list_prepend(ascii(substr(c::VARCHAR, i, 1))::BIGINT, list_transform(range(8), lambda j: -1::BIGINT))))),
               lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END), 4294967295)"""
    return f"""
    WITH t AS (
      SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), substr(coalesce(text, ''), 1, 64), sha256(coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    h AS (SELECT c, {crc} % {most} AS h FROM (SELECT DISTINCT c FROM t)),
    g AS (
      SELECT h.c, t.p, t.x FROM h JOIN t ON t.c = h.c - h.c % {group} AND t.p <= h.h
      UNION ALL SELECT h.c, t.p, t.x FROM h JOIN t ON t.c = h.c AND t.p > h.h),
    d AS (SELECT c, x, row_number() OVER (PARTITION BY c ORDER BY p) AS d FROM g),
    m AS (
      SELECT c, d, list(x) OVER (PARTITION BY c ORDER BY d) AS s, octet_length(encode(x.t)) AS b FROM d
      UNION ALL SELECT c, 0, [], 0 FROM h),
    n AS (SELECT d, s, min(c) AS conv_id, count(*) AS n, max(b) AS b FROM m GROUP BY d, s),
    q AS (SELECT n.*, p.conv_id AS up FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.s = n.s[1:n.d - 1]),
    k AS (SELECT d - 1 AS d, up AS conv_id, count(*) AS k FROM q WHERE d > 0 GROUP BY ALL),
    f AS (SELECT q.*, coalesce(k, 0) AS k FROM q LEFT JOIN k USING (d, conv_id)),
    a AS (
      SELECT o.d, o.conv_id, sum((f.k = 0)::BIGINT) AS leaves, sum((f.n - 1) * f.b) AS saved
      FROM f JOIN m ON m.c = f.conv_id AND m.d <= f.d JOIN n o ON o.d = m.d AND o.s = m.s GROUP BY ALL),
    l AS (SELECT c, max(d) AS d FROM m GROUP BY c),
    e AS (SELECT d, s, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM m JOIN l USING (c, d) GROUP BY d, s)
    SELECT f.conv_id, f.d::BIGINT AS depth, f.up AS parent_conv_id, f.n AS n_convs, f.k AS n_children, a.leaves::BIGINT AS n_leaves,
           a.saved::BIGINT AS saved_tokens, coalesce(e.e, sha256('')) AS ends_sha256
    FROM f JOIN a ON a.d = f.d AND a.conv_id = f.conv_id LEFT JOIN e ON e.d = f.d AND e.s = f.s"""
