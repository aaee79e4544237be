"""A trie of conversation prefixes, rolled up by centroid decomposition.

Conversations are rebuilt so that neighbours share openings; a node stands for a distinct sequence of first
turns, and is named by its smallest member conversation and its depth. Prefixes are told apart by 128 bits:
running sums of two 64-bit hashes of (place, role, text) in halves of 32 bits.

Totals over subtrees come from a centroid decomposition of the forest of parent edges. Each component has one
centroid, a node below which lies at least half of the component, while below each of its children lies less
(the nodes with half of the component below them are the path from its top to the centroid). Each round
finds all centroids, adds up the component's nodes at and below its centroid, adds that total along
the path from the centroid to the top, and splits the component: the parts under the centroid's
children and the part above go on alone. Components halve, so the rounds grow with the logarithm of
the nodes whatever the depth. Components of at most ``LOCAL_NODES`` nodes are finished inside tasks by the same rounds.

The node under which a node hangs at a given depth is read from the table of rebuilt turns (its smallest member's
node at that depth); no path is walked."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rolling import positions
from tidemark.session import materialize

#: components of at most so many nodes are finished in one task
LOCAL_NODES = 20_000
#: turns of a conversation summed in one window; longer ones are summed by chunks first
CHUNK_TURNS = 1_000_000
#: conversation ids joined to one string before a node's digest
CHUNK_IDS = 4096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_HALVES = ("s1", "s2", "s3", "s4")


def _halves(*of: Column) -> dict[str, Column]:
    """Two hashes as four numbers below 2^32, whose sums do not overflow."""
    out = {}
    for k, (high, low) in enumerate((("s1", "s2"), ("s3", "s4"))):
        h = F.xxhash64(F.lit(k), *of)
        out[high], out[low] = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return out


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), role, text; ties of ``turn`` in the order of role and text. Rows without a conv_id are of no conversation."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return positions(rows, ["conv_id"], ["turn", "role", "text"]).select("conv_id", F.col("_rn").cast("long").alias("place"), "role", "text")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id; their rebuilt turns: conv_id, depth, the hash halves of the turn, n_bytes of its text)."""
    turns = materialize(turns.select("conv_id", "place", F.octet_length("text").cast("long").alias("n_bytes"),
                                     F.xxhash64(F.lit(0), "role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2")), "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    c = F.col("conv_id")
    convs = sizes.select(c, "n", F.pmod(F.crc32(c.cast("string")), F.lit(9)).alias("h"), (c - c % 5).alias("base"))
    bases = sizes.select(c.alias("base"), F.col("n").alias("n_base"))
    convs = materialize(convs.join(bases, "base", "left")
                        .withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0)))), "conversations")
    first = turns.where("place <= 8").withColumnRenamed("conv_id", "base")
    opening = (convs.where("shared > 0").select("conv_id", "base", "shared").join(first, "base").where("place <= shared")
               .select("conv_id", F.col("place").alias("depth"), "t1", "t2", "n_bytes"))
    own = (turns.join(convs.where("n > h").select("conv_id", "h", "shared"), "conv_id").where("place > h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("shared")).alias("depth"), "t1", "t2", "n_bytes"))
    rebuilt = opening.unionByName(own)
    return convs.select("conv_id"), rebuilt.select("conv_id", "depth", "n_bytes", *[v.alias(k) for k, v in _halves(F.col("depth"), F.col("t1"), F.col("t2")).items()])


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, n_bytes, and k1, k2: the prefix up to the turn."""
    chunk = F.floor(F.col("depth") / F.lit(CHUNK_TURNS)).cast("long")
    rows = rebuilt.withColumn("chunk", chunk)
    run = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({h: F.sum(h).over(run) for h in _HALVES})
    long = rebuilt.groupBy("conv_id").agg(F.max("depth").alias("most")).where(F.col("most") >= CHUNK_TURNS).select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rebuilt.withColumn("chunk", chunk).join(long, "conv_id", "left_semi").groupBy("conv_id", "chunk").agg(*[F.sum(h).alias(h) for h in _HALVES])
               .select("conv_id", "chunk", *[F.sum(h).over(before).alias("o" + h) for h in _HALVES]))
    rows = rows.join(offsets, ["conv_id", "chunk"], "left")
    s = {h: F.pmod(F.col(h) + F.coalesce(F.col("o" + h), F.lit(0)), F.lit(1 << 32)) for h in _HALVES}
    return rows.select("conv_id", "depth", "n_bytes", *[
        F.shiftleft(s[a], 32).bitwiseOR(s[b]).alias(k) for k, a, b in (("k1", "s1", "s2"), ("k2", "s3", "s4"))])


def build(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paths, nodes, ends) of the trie.

    paths: conv_id, depth, node: every rebuilt turn with the smallest member of its node (depth 1 on).
    nodes: node, depth, parent (both smallest members; the root's null), n_convs, n_children, n_bytes, size (nodes in the subtree).
    ends: node, depth, conv_id: where each conversation ends."""
    convs, rebuilt = rebuild(turns_of(conversations))
    prefixes = materialize(_prefixes(rebuilt), "prefixes")
    key = ["depth", "k1", "k2"]
    named = prefixes.groupBy(*key).agg(F.min("conv_id").alias("node"))
    paths = materialize(prefixes.join(named, key).select("conv_id", "depth", "node", "n_bytes"), "paths")
    # each conversation brings the nodes it is the smallest member of: its depths from ``new`` to ``most``
    spans = paths.groupBy("conv_id").agg(F.max("depth").alias("most"), F.min(F.when(F.col("node") == F.col("conv_id"), F.col("depth"))).alias("new"))
    brought = F.when(F.col("new").isNotNull(), F.col("most") - F.greatest("new", "depth") + 1).otherwise(0)
    inner = paths.join(spans, "conv_id").groupBy("node", "depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.sum(brought).alias("size"))
    all_convs = convs.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n"))
    up = paths.select(F.col("conv_id").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    first = all_convs.first()
    root = F.lit(first["root"]).cast("long")
    inner = materialize(inner.join(up, ["node", "depth"], "left").withColumn("parent", F.coalesce("parent", root)), "nodes")
    top = inner.agg((F.count(F.lit(1)) + 1).alias("size")).where(root.isNotNull()).select(
        root.alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(first["n"]).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("n_bytes"), "size", F.lit(None).cast("long").alias("parent"))
    children = inner.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = inner.unionByName(top).join(children, ["node", "depth"], "left").fillna(0, "n_children")
    last = spans.select("conv_id", F.col("most").alias("depth")).join(paths.select("conv_id", "depth", "node"), ["conv_id", "depth"])
    ends = last.unionByName(convs.join(spans.select("conv_id"), "conv_id", "left_anti")
                            .select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node")))
    return paths.select("conv_id", "depth", "node"), materialize(nodes, "nodes"), ends


# --- rollup -----------------------------------------------------------------

_STATE = "node long, depth long, parent long, top long, top_depth long, size long, {}"


def _finish(values: list[str]):
    """The rounds over whole components inside a task: an Arrow table of nodes in, (node, depth, totals) out."""

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_pylist() for c in table.column_names}
        order = sorted(range(table.num_rows), key=col["depth"].__getitem__)
        place = {(col["node"][v], col["depth"][v]): v for v in order}
        comp = [(a, b) for a, b in zip(col["top"], col["top_depth"])]
        parent = [place.get((col["parent"][v], col["depth"][v] - 1), -1) if comp[v] != (col["node"][v], col["depth"][v]) else -1
                  for v in range(len(comp))]
        size, sums, own = col["size"], [col["sum_" + c] for c in values], [col[c] for c in values]
        active, done = order, []
        while active:
            total: dict = {}
            for v in active:
                total[comp[v]] = max(total.get(comp[v], 0), size[v])
            centre: dict = {}
            for v in active:
                at = centre.get(comp[v])
                if 2 * size[v] >= total[comp[v]] and (at is None or size[v] < size[at]):
                    centre[comp[v]] = v
            cut = {c: size[v] for c, v in centre.items()}
            below: dict = {}
            found = {c: [0] * len(values) for c in centre}
            above, rest = [], []
            for v in active:  # parents come before their children
                c = comp[v]
                at = centre[c]
                if 2 * size[v] >= total[c]:
                    above.append((v, c))
                    if v == at:
                        below[v] = None
                    else:
                        rest.append(v)
                elif parent[v] in below and (parent[v] == at or below[parent[v]] is not None):
                    below[v] = (col["node"][v], col["depth"][v]) if parent[v] == at else below[parent[v]]
                    rest.append(v)
                else:
                    rest.append(v)
                if v in below:
                    for k, o in enumerate(own):
                        found[c][k] += o[v]
            for v, c in above:
                for k, s in enumerate(sums):
                    s[v] += found[c][k]
                if v == centre[c]:
                    done.append(v)
                else:
                    size[v] -= cut[c]
            for v in rest:
                if v in below:
                    comp[v] = below[v]
                    if comp[v] == (col["node"][v], col["depth"][v]):
                        parent[v] = -1
            active = rest
        out = [pa.array([col[c][v] for v in done], pa.int64()) for c in ("node", "depth")]
        return pa.table(out + [pa.array([s[v] for v in done], pa.int64()) for s in sums], names=["node", "depth", *values])

    return run


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], local_nodes: int | None = None) -> DataFrame:
    """(node, depth, values summed over the subtree, its top included) of every node. ``nodes`` holds node, depth, parent, size and the values (long)."""
    local_nodes = LOCAL_NODES if local_nodes is None else local_nodes
    comp = ["top", "top_depth"]
    root = nodes.where("depth = 0").select("node").first()
    state = nodes.select("node", "depth", "parent", F.lit(root[0] if root else None).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"),
                         "size", *values, *[F.lit(0).cast("long").alias("sum_" + c) for c in values])
    schema = _STATE.format(", ".join(f"{c} long, sum_{c} long" for c in values))
    columns = [f.split(" ")[0] for f in schema.split(", ")]
    below = paths.select(F.col("conv_id").alias("node"), (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("child"))
    parents = nodes.select(F.col("node").alias("child"), (F.col("depth") - 1).alias("c_depth"), F.col("parent").alias("c_node"))
    below = materialize(below.join(parents, ["child", "c_depth"]), "below") if local_nodes < _count(nodes) else None
    done, small = [], []
    while True:
        totals = state.groupBy(*comp).agg(F.max("size").alias("total"))
        state = state.join(totals, comp)
        small.append(state.where(F.col("total") <= local_nodes).select(*columns))
        state = state.where(F.col("total") > local_nodes)
        if below is None or state.isEmpty():
            break
        on_path = 2 * F.col("size") >= F.col("total")
        centres = (state.where(on_path).groupBy(*comp).agg(F.min(F.struct("size", "node", "depth")).alias("c"))
                   .select(*comp, F.col("c.size").alias("c_size"), F.col("c.node").alias("c_node"), F.col("c.depth").alias("at")))
        state = state.join(centres, comp)
        looked = state.withColumn("c_depth", F.when(~on_path & (F.col("depth") > F.col("at")), F.col("at")))
        looked = looked.join(below, ["node", "c_depth", "c_node"], "left")
        is_centre = (F.col("node") == F.col("c_node")) & (F.col("depth") == F.col("at"))
        looked = materialize(looked.withColumn("kind", F.when(is_centre, "centre").when(on_path, "above")
                                               .when(F.col("child").isNotNull(), "below").otherwise("rest")), "centroids")
        found = (looked.where("kind in ('centre', 'below')").groupBy(*comp).agg(*[F.sum(c).alias("found_" + c) for c in values]))
        summed = looked.join(found, comp)
        add = F.col("kind").isin("centre", "above")
        summed = summed.withColumns({"sum_" + c: F.when(add, F.col("sum_" + c) + F.col("found_" + c)).otherwise(F.col("sum_" + c)) for c in values})
        done.append(summed.where("kind = 'centre'").select("node", "depth", *[F.col("sum_" + c).alias(c) for c in values]))
        under = F.col("kind") == "below"
        state = materialize(summed.where("kind <> 'centre'").withColumns({
            "top": F.when(under, F.col("child")).otherwise(F.col("top")), "top_depth": F.when(under, F.col("at") + 1).otherwise(F.col("top_depth")),
            "size": F.when(F.col("kind") == "above", F.col("size") - F.col("c_size")).otherwise(F.col("size"))}).select(*columns), "components")
    for part in small:
        n = part.groupBy(*comp).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n")).first()[0] or 0
        if n:
            buckets = F.pmod(F.xxhash64(*comp), F.lit(1 + n // max(1, local_nodes)))
            done.append(part.groupBy(buckets.alias("bucket")).applyInArrow(_finish(values), "node long, depth long, " + ", ".join(f"{c} long" for c in values)))
    out = done[0] if done else nodes.select("node", "depth", *values)
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _count(df: DataFrame) -> int:
    return df.count()


def end_digests(ends: DataFrame) -> DataFrame:
    """node, depth, ends_sha256: the digest of the decimal conv_ids that end at a node, ascending, comma-joined. A node's
    ids are joined by chunks of the id range first; the digest reads the chunks in order, in constant memory."""
    joined = (ends.groupBy("node", "depth", F.floor(F.col("conv_id") / F.lit(CHUNK_IDS)).cast("long").alias("chunk"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    joined = joined.repartition("node", "depth").sortWithinPartitions("node", "depth", "chunk")

    def digest(batches):
        key, sha, out = None, None, []
        for batch in batches:
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids"))):
                if (node, depth) == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (node, depth), hashlib.sha256(ids.encode())
            if out:
                yield _rows(out)
                out = []
        if key is not None:
            yield _rows([(*key, sha.hexdigest())])

    return joined.mapInArrow(digest, "node long, depth long, ends_sha256 string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["node", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame, local_nodes: int | None = None) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty, null turns come first, repeated rows are turns of their own, rows without a
    conv_id are left out, extra columns are not read; an empty table gives an empty table."""
    paths, nodes, ends = build(conversations)
    own = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    totals = rollup(own.select("node", "depth", "parent", "size", "n_leaves", "saved_tokens"), paths, ["n_leaves", "saved_tokens"], local_nodes)
    out = nodes.join(totals, ["node", "depth"]).join(end_digests(ends), ["node", "depth"], "left")
    return out.select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
