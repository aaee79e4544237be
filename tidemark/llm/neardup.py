"""Near-duplicates by BagMinHash: weighted-Jaccard signatures of shingle multisets,
banding, verification of the multiset overlap, classes as connected components."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import GOLDEN, Memo, doc_texts, let_go, mix, slices, with_ids
from .components import connected_components

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 32, 6
#: counters that order the elements of bags by how often they occur; elements that share one only share their place
COUNTERS = 1 << 21
#: counters that travel together
BLOCK = 1 << 12
#: rows of keys after which a batch ends
KEY_ROWS = 100_000
#: elements of bags that are signed together, and counters sent together, about
SIGN_ELEMENTS, COUNT_ROWS = 1 << 16, 1 << 16


# --- inside a task ----------------------------------------------------------

def shingles(texts: list[list[str]], size: int, word_hash: Memo) -> list[np.ndarray]:
    """For each list of words the 64-bit hashes of its ``size``-word windows, with repeats;
    a shorter text is one window, a text without words has none."""
    out = []
    for words in texts:
        h = np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - size + 1) if words else 0
        acc = np.zeros(n, np.uint64)
        for k in range(min(size, len(words))):
            acc = mix(acc * GOLDEN + h[k:k + n])
        out.append(acc)
    return out


def multiset(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    s = np.sort(s)
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """BagMinHash: a (documents, m) array of doubles; two entries of a column are equal with the
    probability of the weighted Jaccard similarity of the two bags. Every bag holds an element.

    The weight axis is discretised at the integers and cut into dyadic levels [0,1), [1,2), [2,4),
    [4,8), ... Each element has on each level its own Poisson process, of a rate in proportion to
    the level's length for each of the m registers; a point carries a register and a weight
    position, and counts only where that position is below the element's weight. A level above the
    weight is never opened, so an element costs the logarithm of its count. A register keeps its
    earliest point. Points come in order of time and generation stops at a horizon by which
    registers are filled; where one is still empty the horizon moves on, so signatures are exact."""
    docs = len(bags)
    elem = np.concatenate([e for e, _ in bags])
    weight = np.concatenate([w for _, w in bags]).astype(np.int64)
    doc = np.repeat(np.arange(docs), [len(e) for e, _ in bags])
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    unit = np.repeat(np.arange(len(elem)), levels)
    level = np.arange(len(unit)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    span = np.maximum(low, 1)
    doc, weight = doc[unit], weight[unit]
    state = mix(elem[unit] + mix(level.astype(np.uint64) + GOLDEN))
    total = np.bincount(doc, weights=None if not len(unit) else np.minimum(weight - low, span), minlength=docs)
    step = (math.log(m) + 4) / total
    horizon = step.copy()
    sig = np.full(docs * m, np.inf)

    def wait(s, spans):
        u = ((mix(s) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        return -np.log(u) / (m * spans)

    state = state + GOLDEN
    time = wait(state, span)
    parked: list[tuple] = []
    while True:
        while len(time):
            late = time > horizon[doc]
            if late.any():
                parked.append((time[late], doc[late], weight[late], low[late], span[late], state[late]))
                on = ~late
                time, doc, weight, low, span, state = (x[on] for x in (time, doc, weight, low, span, state))
                if not len(time):
                    break
            draw = mix(state ^ np.uint64(0x5851F42D4C957F2D))
            register = ((draw >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            position = low + ((draw & np.uint64(0xFFFFFFFF)).astype(np.int64) & (span - 1))
            ok = position < weight
            np.minimum.at(sig, doc[ok] * m + register[ok], time[ok])
            state = state + GOLDEN
            time = time + wait(state, span)
        empty = np.isinf(sig.reshape(docs, m)).any(axis=1)
        if not empty.any():
            return sig.reshape(docs, m)
        horizon[empty] += step[empty]
        time, doc, weight, low, span, state = (np.concatenate(x) for x in zip(*parked))
        again = empty[doc]
        time, doc, weight, low, span, state = (x[again] for x in (time, doc, weight, low, span, state))
        parked = []


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each document and band."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    acc = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN), bits.shape[:2]).copy()
    for k in range(rows):
        acc = mix(acc * GOLDEN + bits[:, :, k])
    return acc.view(np.int64)


def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def _content(words: list[str]) -> bytes:
    return hashlib.md5("\n".join(words).encode("utf-8", "surrogatepass")).digest()


def _sign(bands: int, rows: int, size: int):
    def run(batches):
        let_go()
        word_hash, seen = Memo(_word_hash), set()
        for ids, texts in slices(batches):
            words = [t.split() for t in texts]
            nodes = [_content(w) for w in words]
            new = []
            for i, node in enumerate(nodes):  # copies within a task are signed once
                if node not in seen:
                    seen.add(node)
                    if words[i]:
                        new.append(i)
            found: list = [None] * len(ids)
            if new:
                bags = [multiset(s) for s in shingles([words[i] for i in new], size, word_hash)]
                part = np.cumsum([len(e) for e, _ in bags]) // SIGN_ELEMENTS
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(bags)]
                for a, b in zip(cuts, cuts[1:]):
                    for i, h in zip(new[a:b], band_hashes(bag_signatures(bags[a:b], bands * rows), bands, rows)):
                        found[i] = h
            if len(seen) > 500_000:
                seen.clear()
            word_hash.trim()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(nodes, pa.binary()),
                                   pa.array(found, pa.list_(pa.int64()))], ["doc_id", "node", "bands"])
    return run


def _bags(size: int):
    def run(batches):
        let_go()
        word_hash = Memo(_word_hash)
        for _, texts in slices(batches):
            words = [t.split() for t in texts]
            bags = []
            for s in shingles(words, size, word_hash):
                e, w = multiset(s)
                # the j-th copy of a shingle is an element of its own: overlaps of multisets are overlaps of sets
                copy = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                bags.append(np.sort(mix(np.repeat(e, w) + copy.astype(np.uint64) * GOLDEN)).tobytes())
            word_hash.trim()
            yield pa.record_batch([pa.array([_content(w) for w in words], pa.binary()),
                                   pa.array(bags, pa.binary())], ["words", "bag"])
    return run


def _slot(bag: np.ndarray) -> np.ndarray:
    return (bag % np.uint64(COUNTERS)).astype(np.int64)


def _count_elements(batches):
    n = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for x in batch.column(1):
            np.add.at(n, _slot(np.frombuffer(x.as_buffer(), np.uint64)), 1)
    at = np.flatnonzero(n)
    for first in range(0, len(at), COUNT_ROWS):
        part = at[first:first + COUNT_ROWS]
        yield pa.record_batch([pa.array(part, pa.int64()), pa.array(n[part], pa.int64())], ["slot", "n"])


def _often(bags: DataFrame) -> bytes:
    """How often each counter's elements occur, as one byte each: four steps for every doubling, so that the order by
    it is near enough that by the counts. The driver gets COUNTERS bytes, block by block, and no table of counts."""
    counts = bags.mapInArrow(_count_elements, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    step = F.least(F.floor(4 * F.log2(F.col("n").cast("double"))) + 1, F.lit(255)).cast("int")
    place = F.struct((F.col("slot") % BLOCK).cast("int").alias("at"), step.alias("step"))
    blocks = counts.groupBy(F.floor(F.col("slot") / F.lit(BLOCK)).cast("int").alias("block")).agg(F.collect_list(place).alias("places"))

    def pack(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                places = batch.column(1)[k].values
                block = np.zeros(BLOCK, np.uint8)
                block[places.field("at").to_numpy()] = places.field("step").to_numpy()
                out.append(block.tobytes())
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["block", "steps"])

    often = np.zeros((COUNTERS // BLOCK, BLOCK), np.uint8)
    for r in blocks.mapInArrow(pack, "block int, steps binary").toLocalIterator():
        often[r["block"]] = np.frombuffer(r["steps"], np.uint8)
    return often.tobytes()


def prefix(bag: np.ndarray, often: np.ndarray, similarity: float) -> np.ndarray:
    """The first elements of a bag in one order for all bags, rare ones first: so many that two bags of ``similarity``
    or more have one of them in common, whatever the order."""
    order = np.lexsort((bag, often[_slot(bag)]))
    return bag[order[:int(len(bag) * (1 - similarity) + 1e-9) + 1]]


def _prefixes(often, similarity: float):
    """A row for each element of a bag's prefix: its place there and the size of the bag."""
    def run(batches):
        order = np.frombuffer(often.value, np.uint8)

        def rows():
            size = [len(k) for k in keys]
            at = np.concatenate([np.arange(n) for n in size])
            return pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(nodes, size), pa.int64()),
                                    pa.array(at, pa.int64()), pa.array(np.repeat(sizes, size), pa.int64())],
                                   ["band", "node", "at", "size"])

        for batch in batches:
            nodes, sizes, keys, n = [], [], [], 0
            for node, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                bag = np.frombuffer(x.as_buffer(), np.uint64)
                nodes.append(node)
                sizes.append(len(bag))
                keys.append(prefix(bag, order, similarity))
                n += len(keys[-1])
                if n >= KEY_ROWS:
                    yield rows()
                    nodes, sizes, keys, n = [], [], [], 0
            if keys:
                yield rows()
    return run


def _overlap(similarity: float):
    def run(batches):
        let_go()
        for batch in batches:
            keep, shared = [], []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= similarity * (len(x) + len(y) - both) - 1e-9:
                    keep.append(i)
                    shared.append(both / (len(x) + len(y) - both))
            out = batch.select([0, 1]).take(pa.array(keep, pa.int64()))
            yield pa.record_batch([*out.columns, pa.array(shared, pa.float64())], ["a", "b", "similarity"])
    return run


# --- the Spark job ----------------------------------------------------------

def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Of ``pairs(a, b)`` those whose multisets overlap enough. A leader meets many members: its
    join is one of two sorted sides, which adaptive execution splits."""
    left = pairs.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("y")), "b")
    full = left.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("x")), "a").select("a", "b", "x", "y")
    return full.mapInArrow(_overlap(similarity), "a long, b long, similarity double")


def _met(buckets: DataFrame, name: str) -> DataFrame:
    """The rows of ``buckets(band, node, ...)`` that share their bucket, with ``n, central``: n its size, central the
    sum of the sizes of all of the node's buckets."""
    cols = buckets.columns
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(buckets.join(sizes, "band"), name)
    central = met.groupBy("node").agg(F.sum("n").alias("central"))
    return materialize(met.join(central, "node").select(*cols, "n", "central"), name)


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1))).select("a", "b")


def _split(met: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows of ``met``, with their component, whose bucket holds several components."""
    placed = met.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("band")
    return placed.join(split, "band")


def _second_meeting(bags: DataFrame, links: DataFrame, comps: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(links, components) with all pairs of ``bags`` compared that are not in one component yet. Buckets are the elements of
    prefixes, which every pair of ``similarity`` shares; a pair whose sizes, or the rests of whose bags from a common
    element on, are too small for the overlap is left out. The first common element of a similar pair always passes."""
    held = bags.sparkSession.sparkContext.broadcast(_often(bags))
    met = _met(materialize(bags.mapInArrow(_prefixes(held, similarity), "band long, node long, at long, size long"), "fine"), "fine")
    largest, done, upto = met.agg(F.max("n")).first()[0] or 0, 0, 1
    order = Window.partitionBy("band").orderBy(F.col("central").desc(), F.col("node").desc())
    enough = (F.least(F.col("size") - F.col("at"), F.col("lead_size") - F.col("lead_at")) * (1 + similarity)
              >= similarity * (F.col("size") + F.col("lead_size")) - 1e-6)
    placed = materialize(_split(met, comps), "placed")
    while done < largest and not placed.isEmpty():
        leads = (placed.withColumn("r", F.row_number().over(order)).where(f"r <= {upto}").where(f"r > {done}")
                 .select("band", F.col("node").alias("a"), F.col("comp").alias("of"), F.struct("central", "node").alias("place"),
                         F.col("at").alias("lead_at"), F.col("size").alias("lead_size")))
        # whoever comes before a leader in the order has met it as a leader
        pairs = (placed.join(leads, "band").where((F.col("comp") != F.col("of")) & enough & (F.struct("central", "node") < F.col("place")))
                 .select("a", F.col("node").alias("b")))
        more = materialize(_verified(_distinct(pairs), bags, similarity), "links")
        if not more.isEmpty():
            links = materialize(links.union(more).groupBy("a", "b").agg(F.max("similarity").alias("similarity")), "links")
            comps = connected_components(links)
            placed = materialize(_split(placed.drop("comp"), comps), "placed")  # what is one by now stays one
        done, upto = upto, upto * 4
    return links, comps


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = WORDS,
                    bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links) of ``docs(doc_id, text)``.

    members: a row per input row: ``doc_id, words, node, class_node, class_id, class_size, n_joining_links, is_first``;
    links: verified pairs of different texts ``(a, b, similarity)`` by node. ``node`` numbers the
    sequences of words (``words``, an MD5): texts that differ in white space only are copies. ``class_id`` is the
    least doc_id of the connected component, ``class_size`` counts rows, ``n_joining_links`` counts those
    of its links that joined the row's text to its class (members of one class are not all compared), ``is_first`` marks the rows with doc_id = class_id.

    Similarity is Σmin/Σmax over the multisets of ``size``-word windows; a shorter text is one
    window. Null and empty texts have no words and form one class of copies. Repeated rows are
    copies of each other. A null doc_id sorts before all others, so a class that holds one has a
    null class_id. Empty input gives empty results. Extra columns are not read.

    Each distinct text is signed (bands x rows registers) and meets others in equal bands. With 32
    bands of 6 rows a pair at similarity 0.8 is met with probability 1 - 6e-5, one at 0.9 with
    1 - 1e-10. In a bucket, members are compared with its most central member (the one whose bands
    meet most others) instead of all with all, so a large group of copies of one text takes one
    comparison a member. What is not linked by that meets again: members of buckets that still hold several
    components meet by the elements of their prefixes (see ``prefix``), which loses no pair, and there
    each is compared with the most central, then the next 4, 16, 64, ... members of other components until all have led.
    So what can be missed are pairs that met in no band."""
    texts = doc_texts(docs)
    signed = materialize(texts.mapInArrow(_sign(bands, rows, size),
                                          "doc_id long, node binary, bands array<long>"), "signed")
    nodes = (signed.groupBy(F.col("node").alias("words"))
             .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
                  F.max(F.col("doc_id").isNull()).alias("null_id"), F.max("bands").alias("bands")))
    # a number for each distinct text, fixed by the table it is written into
    nodes = materialize(nodes.select("words", F.monotonically_increasing_id().alias("node"), "least", "copies", "null_id", "bands"),
                        "nodes")
    met = _met(nodes.select("node", F.explode("bands").alias("band")).select("band", "node"), "bands")
    # the texts of nodes that meet others, once each, by a doc_id that holds them
    meets = met.groupBy("node").agg(F.count(F.lit(1))).select("node")
    wanted = materialize(meets.join(nodes.select("node", "words", "least"), "node"), "wanted")
    read = (with_ids(texts, wanted.select("least").distinct(), "left_semi").mapInArrow(_bags(size), "words binary, bag binary"))
    bags = materialize(read.join(wanted.select("node", "words"), "words").groupBy("node").agg(F.max("bag").alias("bag")), "bags")

    lead = met.groupBy("band").agg(F.max(F.struct("central", "node")).alias("lead"))
    pairs = met.join(lead, "band").select(F.col("lead.node").alias("a"), F.col("node").alias("b")).where("a <> b")
    links = materialize(_verified(_distinct(pairs), bags, similarity), "links")
    comps = connected_components(links)
    # a second meeting, of those whose buckets hold several components
    left = materialize(_split(met, comps).select("node").distinct(), "left")
    if not left.isEmpty():
        again = materialize(bags.join(left, "node").select("node", "bag"), "again")
        links, comps = _second_meeting(again, links, comps, similarity)

    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_joining_links"))
    placed = (nodes.drop("bands").withColumn("rep", F.when(~F.col("null_id"), F.col("least")))
              .join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    classes = placed.groupBy("comp").agg(F.sum("copies").alias("class_size"), F.min("rep").alias("first"),
                                         F.max("null_id").alias("has_null"))
    of_node = (placed.join(classes, "comp").join(degree, "node", "left")
               .select("words", "node", F.col("comp").alias("class_node"),
                       F.when(~F.col("has_null"), F.col("first")).alias("class_id"), "class_size",
                       F.coalesce("n_joining_links", F.lit(0)).alias("n_joining_links")))
    members = (signed.select("doc_id", F.col("node").alias("words")).join(of_node, "words")
               .withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("class_id")))
               .select("doc_id", "words", "node", "class_node", "class_id", "class_size", "n_joining_links", "is_first"))
    return members, links


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``: the one with the least doc_id (a
    null counts as least). Of several rows of a class with that very doc_id the least row stays, so
    repeated rows go as well. All columns of ``docs`` are kept as they are, whatever their names."""
    members, _ = near_duplicates(docs, **options)
    members = materialize(members, "members")
    repeated = materialize(members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                           .select("doc_id"), "repeated")
    first = members.where("is_first")
    if repeated.isEmpty():
        return with_ids(docs, first.select("doc_id"), "left_semi")
    once = with_ids(docs, with_ids(first, repeated, "left_anti").select("doc_id"), "left_semi")
    # rows that share a doc_id are told apart by their words
    rest = with_ids(docs, repeated, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rest = rest.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), row)
    schema = f"doc_id long, node binary, row {rest.schema['row'].dataType.simpleString()}"
    rest = rest.mapInArrow(_nodes, schema)
    lead = first.select(F.col("doc_id").alias("id"), F.col("words").alias("of"), "class_node").distinct()
    one = (rest.join(lead, rest["doc_id"].eqNullSafe(lead["id"]) & (rest["node"] == lead["of"]))
           .groupBy("id", "class_node").agg(F.min("row").alias("row")).select("row.*"))
    return once.unionByName(one)


def _nodes(batches):
    for batch in batches:
        nodes = [_content(t.split()) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(nodes, pa.binary()), batch.column(2)],
                              ["doc_id", "node", "row"])
