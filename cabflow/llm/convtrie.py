"""Conversation prefix trie and its rollup by centroid decomposition.

Every distinct sequence of the first d turns is a node of depth d.  A node is
named by (conv_id, depth), conv_id the smallest conversation that starts with
it; its parent is the node of the same conversation one turn earlier.  So the
ancestor of a node at any depth is one lookup in the table of all (conversation,
depth) -> node, which the trie is made of.

A prefix gets a 128-bit key without holding a conversation in one place: the
hashes of (depth, role, text) are summed as four running sums of 32-bit numbers,
ordered scans that spread a long conversation over tasks.

Sums over subtrees (``rollup``), on the forest of parent edges:

* ``size`` is the number of nodes of a subtree inside its component, at first the
  whole tree (counted by doubling the distance looked up).
* The nodes with ``2 * size >= total`` of a component are the path from its
  centroid up to its top, as two disjoint subtrees cannot both hold half.
* The sum of the centroid's subtree is aggregated over the component and added to
  every node of that path, whose sizes shrink by the centroid's; the subtrees of
  its children become components of their own.  Every component is at most half
  of the one it came from, so a chain of a billion turns takes 30 rounds, and a
  root with a billion children one.
* Components of at most ``LOCAL`` nodes are summed bottom-up, many to a task.

Defined cases: a null conv_id takes no part; null role or text is empty; turns
are ordered null first, equal ones by role and text, and repeated rows stay
repeated turns; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import prepare, require, stored
from cabflow.operators.scan import Agg, keyed_scan

#: Components up to this many nodes are summed in one task.
LOCAL = 4_096
#: Conversations whose ids are joined to one text, in parallel, before a node's ends are hashed.
ENDS = 4_096
MASK = 0xFFFFFFFF


def turns(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns in order: ``c``, ``pos`` from 1, two 64-bit hashes of (role, text)
    and the text's bytes."""
    require(convs, conv_id=conv_id, turn=turn, role=role, text=text)
    t = convs.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"),
                                                       F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = keyed_scan(t, ["c"], ["turn", "role", "text"], [Agg("pos", "count")])
    return t.select("c", "pos", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), F.octet_length("text").cast("long").alias("bytes"))


def branched(t: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt as branches: the first h = crc32(c) % ``most`` turns
    of conversation c - c % ``group``, then c's own turns after its first h.
    Columns of ``turns`` with ``pos`` replaced by ``o``, whose order counts."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % most
    own = t.where(F.col("pos") > h).select("c", (F.col("pos") + most).alias("o"), "h1", "h2", "bytes")
    convs = t.select("c").distinct().select("c", (F.col("c") - F.col("c") % group).alias("base"), h.alias("h"))
    first = t.where(F.col("pos") < most).select(F.col("c").alias("base"), F.col("pos").alias("o"), "h1", "h2", "bytes")
    given = first.join(convs, "base").where(F.col("o") <= F.col("h")).select("c", "o", "h1", "h2", "bytes")
    return own.unionByName(given)


def paths(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(``c``, ``d``) -> node for every conversation of ``convs`` (``c``) and depth
    from 0: ``owner`` (the node's smallest conversation), ``n_convs``, ``bytes``
    of its last text, and ``next``, ``next_n``, ``next_bytes`` of the node after."""
    d = keyed_scan(rows, ["c"], ["o"], [Agg("d", "count")])
    a, b = F.xxhash64("d", "h1"), F.xxhash64("h2", "d")
    d = d.select("c", "d", "bytes", *[(x.bitwiseAND(F.lit(MASK))).alias(n) for x, n in ((a, "w0"), (F.shiftrightunsigned(a, 32), "w1"), (b, "w2"), (F.shiftrightunsigned(b, 32), "w3"))])
    d = keyed_scan(d, ["c"], ["d"], [Agg(f"s{i}", "sum", f"w{i}") for i in range(4)])
    low = [F.col(f"s{i}").bitwiseAND(F.lit(MASK)) for i in range(4)]
    d = stored(d.select("c", "d", "bytes", low[0].bitwiseOR(F.shiftleft(low[1], 32)).alias("p"), low[2].bitwiseOR(F.shiftleft(low[3], 32)).alias("q")))
    named = d.groupBy("d", "p", "q").agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs"))
    at = d.join(named, ["d", "p", "q"]).select("c", "d", "owner", "n_convs", "bytes")
    top = convs.agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    at = stored(at.unionByName(convs.crossJoin(F.broadcast(top)).select("c", F.lit(0).cast("long").alias("d"), "owner", "n_convs", F.lit(0).cast("long").alias("bytes"))))
    after = at.select("c", (F.col("d") - 1).alias("d"), F.col("owner").alias("next"), F.col("n_convs").alias("next_n"), F.col("bytes").alias("next_bytes"))
    return at.join(after, ["c", "d"], "left")


def subtree_sizes(nodes: DataFrame, at: DataFrame) -> DataFrame:
    """Nodes of every subtree: the count within a distance doubles each round."""
    deepest = nodes.agg(F.max("depth")).head()[0]
    s = nodes.select("conv", "depth", F.lit(1).cast("long").alias("size"))
    up = at.select(F.col("c").alias("conv"), F.col("d").alias("at"), "owner")
    step = 1
    while deepest is not None and step <= deepest:
        far = s.where(F.col("depth") >= step).withColumn("at", F.col("depth") - step).join(up, ["conv", "at"])
        more = far.groupBy(F.col("owner").alias("conv"), F.col("at").alias("depth")).agg(F.sum("size").alias("more"))
        s = stored(s.join(more, ["conv", "depth"], "left").select("conv", "depth", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
        step *= 2
    return s


def _bottom_up(values: list[str]):
    """Rows sorted by component: sums over the subtrees left in each."""
    names = ["conv", "depth", "parent", "top", "top_depth", *values, *[f"sum_{v}" for v in values]]

    def solve(t):
        import numpy as np
        import pyarrow as pa
        col = {n: t.column(n).to_numpy() for n in names}
        order = np.lexsort((col["conv"], col["depth"]))
        conv, depth, parent = (col[n][order] for n in ("conv", "depth", "parent"))
        inner = (conv != col["top"][order]) | (depth != col["top_depth"][order])
        below = [col[v][order].copy() for v in values]
        edges = np.flatnonzero(np.diff(depth)) + 1
        levels = list(zip([0, *edges.tolist()], [*edges.tolist(), len(conv)]))
        for (s, e), (ps, pe) in zip(levels[::-1], levels[-2::-1]):
            of = s + np.flatnonzero(inner[s:e])
            if len(of):
                to = ps + np.searchsorted(conv[ps:pe], parent[of])
                for x in below:
                    np.add.at(x, to, x[of])
        out = [conv, depth] + [x + col[f"sum_{v}"][order] for v, x in zip(values, below)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["conv", "depth", *values])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < 4 * LOCAL:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            same = np.logical_and(*(t.column(c).to_numpy() == t.column(c)[-1].as_py() for c in ("top", "top_depth")))
            cut = int(np.argmax(same))
            if cut:
                yield solve(t.slice(0, cut))
                held, n = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())
    return run


def rollup(nodes: DataFrame, at: DataFrame, values: list[str], local: int | None = None) -> DataFrame:
    """Sums of ``values`` (longs) over every node's subtree.

    ``nodes``: conv, depth, parent (conv of the parent; null for the root) and the
    values; ``at``: (c, d) -> owner, next, as ``paths`` makes it."""
    spark = nodes.sparkSession
    prepare(spark)
    local = LOCAL if local is None else local
    sums = [f"sum_{v}" for v in values]
    columns = ["conv", "depth", "parent", "top", "top_depth", "size", *values, *sums]
    root = nodes.where("parent is null").select(F.col("conv").alias("top"), F.col("depth").alias("top_depth"))
    live = nodes.join(subtree_sizes(nodes, at), ["conv", "depth"]).crossJoin(F.broadcast(root))
    live = stored(live.select("conv", "depth", F.coalesce("parent", F.lit(-1)).alias("parent"), "top", "top_depth", "size", *values, *[F.lit(0).cast("long").alias(s) for s in sums]))
    # All ancestors at the centroid's depth: (conversation, depth) -> node and the one after it.
    lookup = at.select(F.col("c").alias("conv"), F.col("d").alias("cut_depth"), F.col("owner").alias("over"), F.col("next"))
    ended, small = [], []
    while True:
        tops = live.where("conv = top and depth = top_depth").select("top", "top_depth", F.col("size").alias("total"))
        big = tops.where(F.col("total") > local)
        rest = live.join(tops.where(F.col("total") <= local), ["top", "top_depth"], "left_semi").select(*columns)
        small.append(rest)
        held = live.join(big, ["top", "top_depth"])
        middle = held.where(2 * F.col("size") >= F.col("total")).groupBy("top", "top_depth", "total").agg(
            F.max("depth").alias("cut_depth"), F.max_by("conv", "depth").alias("cut"), F.max_by("size", "depth").alias("cut_size"))
        middle = stored(middle)
        if not middle.limit(1).count():
            break
        marked = live.join(middle, ["top", "top_depth"]).join(lookup, ["conv", "cut_depth"], "left")
        centre = (F.col("conv") == F.col("cut")) & (F.col("depth") == F.col("cut_depth"))
        inside = F.coalesce(F.col("over") == F.col("cut"), F.lit(False)) & (F.col("depth") > F.col("cut_depth"))
        marked = stored(marked.withColumns({"centre": centre, "inside": inside}).drop("over"))
        totals = marked.where("centre or inside").groupBy("top", "top_depth").agg(*[F.sum(v).alias(f"all_{v}") for v in values])
        path = 2 * F.col("size") >= F.col("total")
        step = marked.join(totals, ["top", "top_depth"]).select(
            "conv", "depth", "parent", F.when(F.col("inside"), F.col("next")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("inside"), F.col("cut_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            F.when(path, F.col("size") - F.col("cut_size")).otherwise(F.col("size")).alias("size"), *values,
            *[F.when(path, F.col(s) + F.col(f"all_{v}")).otherwise(F.col(s)).alias(s) for v, s in zip(values, sums)], "centre")
        step = stored(step)
        ended.append(step.where("centre").select("conv", "depth", *[F.col(s).alias(v) for v, s in zip(values, sums)]))
        live = step.where("not centre").drop("centre")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = small[0]
    for s in small[1:]:
        pieces = pieces.unionByName(s)
    pieces = pieces.drop("size").repartition(n, "top", "top_depth").sortWithinPartitions("top", "top_depth")
    out = pieces.mapInArrow(_bottom_up(values), "conv long, depth long, " + ", ".join(f"{v} long" for v in values))
    for e in ended:
        out = out.unionByName(e)
    return out


def _hash_ends(batches):
    """SHA-256 of the texts of each node, in order, as they stream by."""
    import hashlib

    import pyarrow as pa
    now, digest, out = None, None, []
    for batch in batches:
        for conv, depth, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "text"))):
            if (conv, depth) != now:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (conv, depth), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))], ["conv", "depth", "ends"])
            out = []
    if now is not None:
        out.append((*now, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))], ["conv", "depth", "ends"])


def ends(at: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conversations that end at a node.  Blocks of ids
    are joined to texts in parallel; only the hash itself, which is sequential
    by its nature, runs over a node's blocks in one stream."""
    prepare(at.sparkSession)
    e = at.where("next is null").select(F.col("owner").alias("conv"), F.col("d").alias("depth"), "c", F.floor(F.col("c") / ENDS).alias("block"))
    e = e.groupBy("conv", "depth", "block").agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("text"))
    n = int(at.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return e.repartition(n, "conv", "depth").sortWithinPartitions("conv", "depth", "block").mapInArrow(_hash_ends, "conv long, depth long, ends string")


def trie(convs: DataFrame, rows: DataFrame, local: int | None = None) -> DataFrame:
    """Nodes of the trie of the sequences ``rows`` (c, o, h1, h2, bytes) of the
    conversations ``convs`` (c): one row per node."""
    at = stored(paths(convs, rows))
    nodes = at.where("next = c").select(F.col("c").alias("conv"), (F.col("d") + 1).alias("depth"), F.col("owner").alias("parent"), F.col("next_n").alias("n_convs"), F.col("next_bytes").alias("bytes"))
    root = at.where("d = 0 and c = owner").select(F.col("c").alias("conv"), F.col("d").alias("depth"), F.lit(None).cast("long").alias("parent"), "n_convs", "bytes")
    nodes = stored(nodes.unionByName(root))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    valued = nodes.select("conv", "depth", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    sums = rollup(valued, at, ["n_leaves", "saved_tokens"], local)
    none = F.sha2(F.lit("").cast("binary"), 256)
    out = nodes.join(sums, ["conv", "depth"]).join(ends(at), ["conv", "depth"], "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", none).alias("ends_sha256"))


def conversation_trie(convs: DataFrame, local: int | None = None, branch: bool = True, **names: str) -> DataFrame:
    """The trie of a table of conversations; ``branch`` rebuilds them first (see
    ``branched``), otherwise they are taken as they are."""
    t = stored(turns(convs, **names))
    rows = branched(t) if branch else t.withColumnRenamed("pos", "o")
    return trie(t.select("c").distinct(), rows, local)


ORACLE = """
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, xor(list_reduce(range(length(b) // 2), lambda x, i: xor(x >> 8, t[(xor(x & 255, ('0x' || substr(b, 2 * i + 1, 2))::INT) + 1)]), 4294967295), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT c, hex(encode(c::VARCHAR)) AS b FROM t), crc),
r AS (SELECT k.c, t.pos AS o, role, txt FROM k JOIN t ON t.c = k.c - k.c % 5 AND t.pos <= k.h
    UNION ALL SELECT k.c, 9 + t.pos, role, txt FROM k JOIN t ON t.c = k.c AND t.pos > k.h),
p AS (SELECT c, row_number() OVER w AS d, list(struct_pack(a := role, b := txt)) OVER w AS seq, strlen(txt) AS bytes FROM r WINDOW w AS (PARTITION BY c ORDER BY o)),
n AS (SELECT seq, d, min(c) AS conv, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY seq, d),
a AS (SELECT p.c, p.d, n.conv FROM p JOIN n USING (seq, d) UNION ALL SELECT c, 0, min(c) OVER () FROM k),
nodes AS (SELECT conv, d, n_convs, bytes FROM n UNION ALL SELECT min(c), 0, count(*), 0 FROM k HAVING count(*) > 0),
linked AS (SELECT nodes.*, a.conv AS parent FROM nodes LEFT JOIN a ON a.c = nodes.conv AND a.d = nodes.d - 1),
kids AS (SELECT parent AS conv, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids USING (conv, d)),
sums AS (SELECT a.conv, a.d, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM full_ u JOIN a ON a.c = u.conv AND a.d <= u.d GROUP BY a.conv, a.d),
e AS (SELECT conv, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, max(d) AS d, arg_max(conv, d) AS conv FROM a GROUP BY c) GROUP BY conv, d)
SELECT conv AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
    saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_ JOIN sums USING (conv, d) LEFT JOIN e USING (conv, d)
"""
