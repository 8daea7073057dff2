"""Blocked, band, suffix and containment joins: every one has an equi key, none compares all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as X

#: Characters of a left table that every task holds as grams (8 bytes each) and as tables of at most 16 MB.
HELD = 4_000_000
#: How often the rarest three-grams of two texts must meet before the texts are compared.
MEETINGS = 8


def band_join(left: DataFrame, right: DataFrame, keys: list[str], order: str, width: int) -> DataFrame:
    """left rows (columns l_*) with right rows (r_*) of the same key at most `width` orders away.

    Orders are cut into cells of the width; a left row looks into its cell and the two beside it.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(max(1, width)))
    near = left.select(*keys, *(F.col(c).alias(f"l_{c}") for c in left.columns if c not in keys), F.explode(F.array(*(cell(order) + d for d in (-1, 0, 1)))).alias("__cell"))
    far = right.select(*keys, *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys), cell(order).alias("__cell"))
    return near.join(far, [*keys, "__cell"]).where(F.abs(F.col(f"l_{order}") - F.col(f"r_{order}")) <= width).drop("__cell")


def pad_hits(rows: DataFrame, keys: list[str], order: str, hit: Column, padding: int) -> DataFrame:
    """rows within `padding` places of a hit."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-padding, padding)
    return rows.withColumn("__near", F.bool_or(hit).over(w)).where("__near").drop("__near")


def spread(rows: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """At most k rows of each key, evenly spread over its order, first and last among them (places round half to even)."""
    w = Window.partitionBy(*keys)
    placed = rows.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    # Place i is taken if some j < k has bround(j (n-1) / (k-1)) = i; such a j lies next to i (k-1) / (n-1).
    step = (F.col("__n") - 1) / F.lit(max(1, k - 1))
    guess = F.floor(F.col("__i") / step)
    hit = F.lit(False)
    for d in (-1, 0, 1, 2):
        j = guess + d
        hit = hit | ((j >= 0) & (j < k) & (F.bround(j * (F.col("__n") - 1) / F.lit(max(1, k - 1))) == F.col("__i")))
    keep = (F.col("__n") <= k) | (hit if k > 1 else F.col("__i") == 0)
    return placed.where(keep).drop("__i", "__n")


def blocked_neighbours(rows: DataFrame, keys: list[str], id_col: str, blocks: str, order: list[str], posting: int = 32, most: int = 128) -> DataFrame:
    """(keys, id, neighbour): rows that share a block key, each posting list thinned to `posting`, each row's neighbours to `most`, evenly over the order.

    Thinned postings bound what a common block key can produce: at most `posting` neighbours a row.
    """
    ent = rows.select(*keys, id_col, *[o for o in order if o != id_col], F.explode(F.array_distinct(blocks)).alias("block"))
    thin = spread(ent, [*keys, "block"], order, posting)
    n = thin.select(*keys, "block", F.col(id_col).alias("neighbour"), *(F.col(o).alias(f"n_{o}") for o in order))
    met = ent.select(*keys, "block", id_col).join(n, [*keys, "block"]).where(F.col(id_col) != F.col("neighbour")).drop("block").distinct()
    return spread(met, [*keys, id_col], [f"n_{o}" for o in order], most).select(*keys, id_col, "neighbour")


def contained_pairs(left: DataFrame, right: DataFrame, text: str, scratch, threshold: float = 0.78, l_keep: list[str] | None = None, r_keep: list[str] | None = None) -> DataFrame:
    """(l_*, r_*) of rows whose texts' three-grams have an overlap coefficient of the threshold or more; left is the smaller table.

    The kept columns are the texts if none are named. A left table of at most HELD characters goes to every task,
    which counts what a right text shares with each of its rows: exact, and no gram is shuffled.
    """
    l_keep, r_keep = l_keep or [text], r_keep or [text]
    norm = X.normalized(F.col(text)).alias("__t")
    a, b = scratch.save(left.select(*l_keep, norm).where("__t <> ''"), "left"), right.select(*r_keep, norm).where("__t <> ''")
    if (a.agg(F.sum(F.length("__t"))).head()[0] or 0) > HELD:
        return _contained_by_rarest(a, b, scratch, threshold, l_keep, r_keep)
    held = a.toArrow()
    names = [f"l_{c}" for c in l_keep] + [f"r_{c}" for c in r_keep]
    shape = a.select(*(F.col(c).alias(f"l_{c}") for c in l_keep)).schema.fields + b.select(*(F.col(c).alias(f"r_{c}") for c in r_keep)).schema.fields
    known = a.sparkSession.sparkContext.broadcast((held.select(l_keep), grams_of(held.column("__t").to_pylist())))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rows, grams = known.value
        parts, seen = gram_tables(grams), {}
        for batch in batches:
            at, hit = [], []
            for i, t in enumerate(batch.column("__t").to_pylist()):
                found = seen.get(t)
                if found is None:
                    if len(seen) >= 20_000:
                        seen.clear()
                    found = seen[t] = containing(grams_of([t])[0], parts, threshold)
                if found.size:
                    at.append(np.full(found.size, i))
                    hit.append(found)
            if at:
                l, r = rows.take(pa.array(np.concatenate(hit))).combine_chunks(), batch.select(r_keep).take(pa.array(np.concatenate(at)))
                for b in pa.Table.from_arrays([*l.columns, *r.columns], names).to_batches(50_000):
                    yield b

    return b.mapInArrow(run, StructType(shape))


def grams_of(texts: list[str]) -> list:
    """The distinct three-grams of each text as sorted integers of three code points; a shorter text is its own."""
    import numpy as np

    out = []
    for t in texts:
        c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        c = c if c.size >= 3 else np.concatenate([c, np.zeros(3 - c.size, np.int64)])
        out.append(np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:]))
    return out


def gram_tables(grams: list, rows: int = 512, cells: int = 16_000_000) -> list:
    """(place of the first row, sizes, grams, table of gram by row) of slices of at most `rows` rows and, of several rows, `cells` cells."""
    import numpy as np

    out, i = [], 0
    while i < len(grams):
        n, total = 0, 0
        while i + n < len(grams) and n < rows and (n == 0 or (total + grams[i + n].size) * (n + 1) <= cells):
            total += grams[i + n].size
            n += 1
        some = grams[i : i + n]
        vocabulary = np.unique(np.concatenate(some))
        has = np.zeros((vocabulary.size, n), np.uint8)
        for j, g in enumerate(some):
            has[np.searchsorted(vocabulary, g), j] = 1
        out.append((i, np.array([g.size for g in some]), vocabulary, has))
        i += n
    return out


def containing(grams, parts: list, threshold: float):
    """Places of the rows that share the threshold or more of the smaller set's grams."""
    import numpy as np

    out = []
    for first, sizes, vocabulary, has in parts:
        at = np.searchsorted(vocabulary, grams)
        at[at == vocabulary.size] = 0
        at = at[vocabulary[at] == grams]
        both = np.zeros(sizes.size, np.int64)
        for i in range(0, at.size, 255):  # sums of so many ones fit a byte
            both += np.add.reduce(has[at[i : i + 255]], axis=0, dtype=np.uint8)
        out.append(first + np.flatnonzero(both / np.minimum(sizes, grams.size) >= threshold))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _contained_by_rarest(left: DataFrame, right: DataFrame, scratch, threshold: float, l_keep: list[str], r_keep: list[str]) -> DataFrame:
    """contained_pairs of two large tables (kept columns, __t).

    The smaller of two sets of n grams shares m = ceil(threshold * n) of them with the larger, so k at least
    of its n - m + k rarest. Each side's rarest grams look for the other's sets that are as large, and pairs
    that meet k times are compared: equi joins of few, rare keys, exact for every pair.
    """
    ngrams = lambda df, s, keep: scratch.save(df.select(F.monotonically_increasing_id().alias(f"__{s}_id"), *(F.col(c).alias(f"{s}_{c}") for c in keep), X.ngrams(F.col("__t")).alias(f"__{s}")), f"grams_{s}")
    a, b = ngrams(left, "l", l_keep), ngrams(right, "r", r_keep)
    common = scratch.save(b.select(F.explode("__r").alias("g")).groupBy("g").agg(F.count("*").alias("n")), "gram_counts")

    def rarest(df: DataFrame, s: str) -> DataFrame:
        rows = df.select(f"__{s}_id", F.size(f"__{s}").alias("__size"), F.explode(f"__{s}").alias("g")).join(common, "g", "left")
        by = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")))
        both = F.ceil(F.lit(threshold) * F.col("__size") - F.lit(1e-9)).cast("int")
        k = F.least(F.lit(MEETINGS), both)
        return rows.groupBy(f"__{s}_id", "__size").agg(by.alias("by")).select(f"__{s}_id", F.col("__size").alias(f"__{s}_size"), k.alias("k"), F.explode(F.slice("by", F.lit(1), F.col("__size") - both + k)["g"]).alias("g"))

    every = lambda df, s: df.select(f"__{s}_id", F.size(f"__{s}").alias(f"__{s}_size"), F.explode(f"__{s}").alias("g"))
    met = rarest(a, "l").join(every(b, "r"), "g").where("__l_size <= __r_size").unionByName(rarest(b, "r").join(every(a, "l"), "g").where("__r_size < __l_size"))
    met = scratch.save(met.groupBy("__l_id", "__r_id").agg(F.count("*").alias("n"), F.first("k").alias("k")).where("n >= k").select("__l_id", "__r_id"), "met")
    both = met.join(a, "__l_id").join(b, "__r_id")
    return both.where(X.overlap_coefficient(F.col("__l"), F.col("__r")) >= threshold).select(*(f"l_{c}" for c in l_keep), *(f"r_{c}" for c in r_keep))


def suffix_join(left: DataFrame, right: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Pairs of paths that are equal or of which one ends with / and the other."""
    ends = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.split(c, "/"))), lambda i: F.array_join(F.slice(F.split(c, "/"), i, F.size(F.split(c, "/"))), "/"))
    a = left.select(*keys, F.col(path).alias("l_path"), F.explode(ends(F.col(path))).alias("__end"))
    b = right.select(*keys, F.col(path).alias("r_path"), F.explode(ends(F.col(path))).alias("__end"))
    whole = lambda side: F.col("__end") == F.col(side)
    return a.join(b, [*keys, "__end"]).where(whole("l_path") | whole("r_path")).drop("__end").distinct()


def contained(items: Column, allowed: Column) -> Column:
    """Whether items is not empty, has no repeats, and lies within allowed."""
    return (F.size(items) > 0) & (F.size(F.array_distinct(items)) == F.size(items)) & (F.size(F.array_except(items, allowed)) == 0)


def source_aliases(records: DataFrame) -> DataFrame:
    """(session_id, alias, material): a record's own id and, for a fragment, its parent's."""
    both = F.array_distinct(F.array_compact(F.array("id", "parent_id")))
    return records.select("session_id", F.explode(both).alias("alias"), F.col("id").alias("material"))


def direct_links(records: DataFrame, versions: DataFrame, paired: DataFrame) -> DataFrame:
    """(session_id, src, dst, relation), one hop both ways: version and source, version and previous, call and result, fragment and parent."""
    edge = lambda df, a, b, r: df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select("session_id", F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(r).alias("relation"))
    out = edge(versions, "version_id", "source", "version_source").unionByName(edge(versions, "version_id", "previous", "version_previous")).unionByName(edge(paired, "id", "call_source", "call_result"))
    if "parent_id" in records.columns:
        out = out.unionByName(edge(records, "id", "parent_id", "fragment"))
    return out.unionByName(out.select("session_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "relation")).distinct()
