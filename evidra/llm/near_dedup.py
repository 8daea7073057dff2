"""Near-duplicates by an LSH forest over min-hash signatures.

A document is the set of its distinct shingles (WIDTH words, A-Z lower-cased, words parted by ASCII
white space; with fewer words the whole sequence). Documents with equal sets are one node. Each of
TREES trees orders the nodes by their label, DEPTH min-hash values; all trees are sorted in one
range-partitioned pass. Runs of nodes with a common prefix of LEAST values are regions. A region of
at most SMALL nodes compares all of them by 128-bit sketches; a larger one ties its nodes to the node
nearest to the region's majority sketch and looks again one value deeper, so depth adapts to how
crowded a region is; at full depth next neighbours are compared. Only pairs whose sketches agree
reach the exact check on full sets, and verified links are joined to components. Then the nodes of a
larger region that are not in its largest component are compared with all its nodes of other
components, block by block, so that a text which is alike no hub keeps its links to other members.

Defined results: null and wordless texts have no shingles and no links; of a group the smallest
doc_id stays (of rows with this id the least hash of the text, and one of repeated rows), null ids
last; an empty table gives an empty one; other columns pass through keep_one().
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import Scratch, frequent, fresh, sized
from .components import components

WIDTH, SIMILARITY = 5, 80
TREES, DEPTH, LEAST, SMALL = 24, 8, 3, 24
#: Of 128 sketch bits, so many must agree: at similarity 0.8 they do but for one pair in ten million.
AGREE, SURE = 97, 125
_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 2**64, TREES * DEPTH, np.uint64)
_MUL = _rng.integers(0, 2**63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
#: Sort rows in a partition; nodes of a crowded region in a block; hashes compared at once.
ROWS, BLOCK, HELD = 400_000, 256, 1 << 21
#: Bytes of a key that name its tree and the LEAST first values.
PREFIX = 1 + 2 * LEAST


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and where each begins."""
    starts, ends, first = W.split(data, bounds)
    x, begin = W.shingles(W.hashes(data, starts, ends), first, width)
    sets = [np.unique(x[i:j]) for i, j in zip(begin[:-1].tolist(), begin[1:].tolist())]
    return (np.concatenate(sets) if sets else x), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """id, text_hash, n, node (128 bits of the set), keys (a tree's number and label each), sketch."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for lo, hi, data, bounds in W.texts(b.column(1)):
                x, begin = shingle_sets(data, bounds, width)
                n = np.diff(begin)
                some = np.flatnonzero(n)
                node = np.zeros((hi - lo, 2), ">u8")
                keys = np.zeros((hi - lo, TREES, 1 + 2 * DEPTH), np.uint8)
                keys[:, :, 0] = np.arange(TREES)
                sketch = np.zeros((hi - lo, 16), np.uint8)
                if len(some):
                    at = begin[some]
                    node[some, 0] = np.add.reduceat(W.mix(x), at)
                    node[some, 1] = np.add.reduceat(W.mix(x ^ _XOR[0]), at)
                    least = np.empty((len(some), TREES * DEPTH), np.uint64)
                    for k in range(TREES * DEPTH):
                        least[:, k] = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], at)
                    least = W.mix(least)
                    label = (least >> np.uint64(48)).astype(">u2").reshape(len(some), TREES, DEPTH)
                    keys[some, :, 1:] = label.view(np.uint8).reshape(len(some), TREES, 2 * DEPTH)
                    sketch[some] = np.packbits((least[:, :128] & np.uint64(1)).astype(np.uint8), axis=1)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(1 + 2 * DEPTH), (hi - lo) * TREES, [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo) * TREES + 1, TREES, dtype=np.int32)), flat)
                fixed = lambda a, size: pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), hi - lo, [None, pa.py_buffer(a.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array(n), fixed(node, 16), listed, fixed(sketch, 16)], ["id", "text_hash", "n", "node", "keys", "sketch"])

    return docs.mapInArrow(run, "id bigint, text_hash bigint, n bigint, node binary, keys array<binary>, sketch binary")


def _bits(sketch: np.ndarray) -> np.ndarray:
    return np.unpackbits(sketch, axis=-1)


def _agree(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return 128 - np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)


def region_pairs(label: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (places) of rows sorted by label: a tree's number and DEPTH values. sketch: rows of 2 64-bit words."""
    m = len(label)
    same = np.cumprod(label[1:] == label[:-1], axis=1)
    prefix = np.concatenate([[0], np.where(same[:, 0] == 1, same[:, 1:].sum(axis=1), -1), [-1]])  # shared with the row before
    prefix[0] = -1
    out: list[tuple[np.ndarray, np.ndarray]] = []
    todo = np.arange(m)
    open_ = np.ones(m, bool)
    for depth in range(LEAST, DEPTH + 1):
        edges = np.flatnonzero(prefix < depth)
        a, b = edges[:-1], edges[1:]
        ok = (b - a > 1) & open_[np.minimum(a, m - 1)]
        for i, j in zip(a[ok].tolist(), b[ok].tolist()):
            size = j - i
            if size == 2:
                out.append((np.array([i]), np.array([i + 1])))
                open_[i:j] = False
                continue
            here = np.arange(i, j)
            bits = _bits(sketch[i:j].view(np.uint8).reshape(size, 16))
            major = 2 * bits.sum(axis=0) >= size
            hub = i + int(np.argmax((bits == major).sum(axis=1)))
            if size <= SMALL:
                p, q = np.triu_indices(size, 1)
                near = _agree(sketch, here, np.full(size, hub)) >= SURE
                pick = ~(near[p] & near[q]) | (p + i == hub) | (q + i == hub)
                out.append((p[pick] + i, q[pick] + i))
                open_[i:j] = False
            else:
                rest = here[here != hub]
                out.append((np.full(len(rest), hub), rest))
                if depth == DEPTH:
                    out.append((here[:-1], here[1:]))
    if not out:
        return todo[:0], todo[:0]
    i, j = (np.concatenate(x) for x in zip(*out))
    ok = _agree(sketch, i, j) >= AGREE
    return i[ok], j[ok]


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs a < b of nodes whose sketches agree, met in a region of a tree."""

    def run(batches):
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        key = np.frombuffer(b"".join(t.column("key").to_pylist()), np.uint8).reshape(t.num_rows, 1 + 2 * DEPTH)
        label = np.concatenate([key[:, :1].astype(np.uint16), key[:, 1:].copy().view(">u2").astype(np.uint16)], axis=1)
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(-1, 2)
        node = np.array(t.column("node").to_pylist(), object)
        i, j = region_pairs(label, sketch)
        pairs = {(x, y) if x < y else (y, x) for x, y in zip(node[i], node[j]) if x != y}
        a, b = zip(*pairs) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    rows = nodes.select("node", "sketch", F.explode("keys").alias("key"))
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() * TREES // ROWS))
    return rows.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node").mapInArrow(run, "a binary, b binary").distinct()


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """node and its full set, sorted 64-bit hashes. docs: node, text."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for lo, hi, data, bounds in W.texts(b.column(1)):
                x, begin = shingle_sets(data, bounds, width)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array([x[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:])], pa.binary())], ["node", "members"])

    return docs.mapInArrow(run, "node binary, members binary")


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs with 100 * intersection >= similarity * union, on full sets."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ok = []
            last = x = None
            for p, q in zip(b.column("set_a"), b.column("set_b")):
                p, q = p.as_buffer(), q.as_buffer()
                if last is None or last != p:
                    last, x = p, np.frombuffer(p, np.uint64)
                y = np.frombuffer(q, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                n = int((both[1:] == both[:-1]).sum())
                ok.append(100 * n >= similarity * (len(both) - n))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
    two = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def crowded(nodes: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame | None:
    """node, sketch, root, prefixes (its crowded regions of several components), places (prefix, query block i, block j, is a query, is outside the largest component)."""
    rows = nodes.select("node", F.explode(F.transform("keys", lambda k: F.substring(k, 1, PREFIX))).alias("prefix"))
    large = scratch.save(rows.groupBy("prefix").count().where(F.col("count") > SMALL).select("prefix"), "large")
    n = large.count()
    if not n:
        return None
    inside = scratch.save(rows.join(sized(large, 32, n), "prefix").join(found, "node", "left").select("prefix", "node", F.coalesce("root", "node").alias("root")), "inside")
    sizes = inside.groupBy("prefix", "root").agg(F.count("*").alias("k")).groupBy("prefix")
    open_ = scratch.save(sizes.agg(F.max(F.struct("k", "root")).alias("top"), F.sum("k").alias("n"), F.count("*").alias("roots")).where("roots > 1").select("prefix", F.col("top.root").alias("top"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nj"), F.ceil((F.col("n") - F.col("top.k")) / BLOCK).cast("int").alias("ni")), "open")
    n = open_.count()
    if not n:
        return None
    placed = inside.join(sized(open_, 64, n), "prefix").withColumn("outside", F.col("root") != F.col("top"))
    block = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    place = lambda i, j, query: F.struct("prefix", i.alias("i"), j.alias("j"), F.lit(query).alias("query"), "outside")
    held = F.transform(F.sequence(F.lit(0), F.col("ni") - 1), lambda i: place(i, block("nj"), False))
    asked = F.when(F.col("outside"), F.transform(F.sequence(F.lit(0), F.col("nj") - 1), lambda j: place(block("ni"), j, True))).otherwise(F.slice(held, 1, 0))
    by_node = placed.groupBy("node", "root").agg(F.collect_list("prefix").alias("prefixes"), F.flatten(F.collect_list(F.concat(held, asked))).alias("places"))
    return scratch.save(by_node.join(nodes.select("node", "sketch"), "node"), "crowded")


def crowded_links(inside: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Verified links (a, b) between components of a region; one for each query and component. inside: as crowded() gives."""

    def compare(t):
        import pyarrow as pa

        size = t.num_rows
        node, root = t.column("node").to_pylist(), t.column("root").to_pylist()
        code = {r: i for i, r in enumerate(dict.fromkeys(root))}
        comp = np.array([code[r] for r in root])
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(size, 2)
        shared = np.zeros((size, TREES), np.int64)  # a region's values by tree, 0 where the node's is not open
        for i, ps in enumerate(t.column("prefixes").to_pylist()):
            for p in ps:
                shared[i, p[0]] = int.from_bytes(p[1:], "big") + 1
        tree = t.column("prefix")[0].as_py()[0]
        members = [np.frombuffer(m, np.uint64) for m in t.column("members").to_pylist()]
        n = np.array([len(m) for m in members])
        query = np.array(t.column("query").to_pylist(), bool)
        outside = np.array(t.column("outside").to_pylist(), bool)
        rank = np.empty(size, np.int64)
        rank[sorted(range(size), key=node.__getitem__)] = np.arange(size)
        held = np.flatnonzero(~query)
        out = []
        for q in np.flatnonzero(query).tolist():
            m = held[comp[held] != comp[q]]
            m = m[~outside[m] | (rank[m] > rank[q])]  # of two queries one asks
            agree = _agree(sketch, np.full(len(m), q), m)
            m = m[agree >= AGREE][np.argsort(-agree[agree >= AGREE], kind="stable")]
            same = (shared[m] == shared[q]) & (shared[q] != 0)
            m = m[same.argmax(axis=1) == tree]  # the pair's first common region compares it
            while len(m):
                some = max(1, int(np.searchsorted(np.cumsum(n[m]), HELD, "right")))
                now, m = m[:some], m[some:]
                x = np.concatenate([members[i] for i in now.tolist()])
                at = np.minimum(np.searchsorted(members[q], x), n[q] - 1)
                both = np.add.reduceat((members[q][at] == x).astype(np.int64), np.cumsum(n[now]) - n[now])
                for i in now[100 * both >= similarity * (n[now] + n[q] - both)].tolist():
                    if comp[i] != comp[q]:
                        out.append((min(node[q], node[i]), max(node[q], node[i])))
                        comp[comp == comp[i]] = comp[q]
                m = m[comp[m] != comp[q]]
        a, b = zip(*out) if out else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    rows = inside.join(sets, "node").select("node", "root", "sketch", "prefixes", "members", F.inline("places"))
    return rows.groupBy("prefix", "i", "j").applyInArrow(compare, "a binary, b binary")


def _texts(src: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the wanted nodes, each text read once."""
    n = wanted.count()
    origin = sized(nodes.join(sized(wanted, 40, n), "node", "left_semi").select("node", F.col("id").alias("from"), F.col("text_hash").alias("from_hash")), 64, n)
    return src.join(origin, src.id.eqNullSafe(F.col("from")) & (src.text_hash == F.col("from_hash"))).select("node", "text")


def groups(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """id, text_hash, n, node, component_id (the smallest id of the document's group) of each row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    every = scratch.save(signatures(src, width), "signatures")
    rows = every.select("id", "text_hash", "n", "node")
    nodes = scratch.save(every.where("n > 0").groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")).select("node", "first.id", "first.text_hash", "keys", "sketch"), "nodes")
    pairs = scratch.save(candidates(nodes), "pairs")
    met = scratch.save(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "met")
    sets = scratch.save(sets_of(_texts(src, nodes, met), width), "sets")
    links = scratch.save(verified(pairs, sets, similarity).distinct(), "links")
    scratch.drop("sets", "met")
    found = scratch.save(components(links, scratch), "found")
    inside = crowded(nodes, found, scratch)
    if inside is not None:
        sets = scratch.save(sets_of(_texts(src, nodes, inside.select("node")), width), "crowded_sets")
        more = scratch.save(crowded_links(inside, sets, similarity).distinct(), "crowded_links")
        scratch.drop("crowded_sets", "crowded")
        if not more.isEmpty():
            found = components(links.unionByName(more), Scratch(docs.sparkSession))
    scratch.drop("large", "inside", "open")
    members = scratch.save(nodes.select("node", "id").join(found, "node").select("node", "id", "root"), "members")
    least = scratch.save(members.groupBy("root").agg(F.min("id").alias("component")), "least")  # written, so that a large group is a skewed join side that Spark splits
    named = scratch.save(nodes.select("node", "id").join(members.join(least, "root").select("node", "component"), "node", "left").select("node", F.coalesce("component", "id").alias("component_id")), "named")
    often = scratch.save(frequent(rows.where("n > 0"), "node").select("node"), "often")
    heavy = scratch.save(named.join(F.broadcast(often), "node", "left_semi"), "heavy")
    light = rows.where("n > 0").join(F.broadcast(often), "node", "left_anti")
    out = light.join(named, "node").unionByName(rows.where("n > 0").join(F.broadcast(heavy), "node"))
    return out.unionByName(rows.where("n = 0").withColumn("component_id", F.col("id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each group, all columns kept."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.save(groups(docs, scratch, id_col, text_col, width, similarity), "groups")
    first = found.where("n > 0 and id <=> component_id").groupBy(F.col("id").alias("first_id")).agg(F.min("text_hash").alias("first_hash"))
    return _drop_others(docs, found, first, scratch, id_col, text_col)


def _drop_others(docs: DataFrame, found: DataFrame, first: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    stays = (F.col("n") == 0) | F.col("first_id").isNotNull()
    marked = found.join(first, found.id.eqNullSafe(first.first_id) & (found.text_hash == first.first_hash), "left").withColumn("stays", stays)
    pairs = scratch.save(marked.groupBy("id", "text_hash").agg(F.max("stays").alias("stays"), F.max("n").alias("n"), F.count("*").alias("rows")).where("not stays or (rows > 1 and n > 0)"), "others")
    i, h = fresh(docs, "other_id", "other_hash")

    def match(base: DataFrame, which: str, how: str) -> DataFrame:
        side = sized(pairs.where(which).select(F.col("id").alias(i), F.col("text_hash").alias(h)), 64)
        return base.join(side, base[id_col].cast("long").eqNullSafe(side[i]) & (F.xxhash64(F.coalesce(base[text_col], F.lit(""))) == side[h]), how)

    if pairs.where("stays").isEmpty():
        return match(docs, "not stays", "left_anti")
    return match(docs, "true", "left_anti").unionByName(match(docs, "stays", "left_semi").dropDuplicates([id_col, text_col]))
