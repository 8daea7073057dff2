"""Bounded graph search: k-hop scopes, 0/1 shortest paths, difficulty, components, beam search."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch


def khop(edges: DataFrame, seeds: DataFrame, hops: int, scratch: Scratch | None = None, keys: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """(keys, node, depth) within `hops` undirected steps of the seeds (keys, node). Each step joins the newest layer only."""
    scratch = scratch or Scratch(edges.sparkSession)
    k = list(keys)
    both = edges.select(*k, "src", "dst").unionByName(edges.select(*k, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    both = scratch.save(both.repartition(*k, "src"), "edges")  # each step joins it again
    seen = layer = seeds.select(*k, "node").distinct().withColumn("depth", F.lit(0))
    for depth in range(1, hops + 1):
        new = layer.select(*k, F.col("node").alias("src")).join(both, [*k, "src"]).select(*k, F.col("dst").alias("node")).distinct()
        layer = scratch.save(new.join(seen, [*k, "node"], "left_anti").withColumn("depth", F.lit(depth)), f"layer{depth}")
        seen = seen.unionByName(layer)
    return seen


def khop_adaptive(edges: DataFrame, seeds: DataFrame, size: DataFrame, initial: int, most: int, budget: int, min_gain: int = 1) -> tuple[DataFrame, list[dict]]:
    """Deepens from `initial` to `most` hops while the members' sizes (node, size) stay within the budget and a layer adds min_gain nodes."""
    scratch = Scratch(edges.sparkSession)
    log, kept, before = [], None, 0
    for hops in range(initial, most + 1):
        scope = scratch.save(khop(edges, seeds, hops, scratch), f"scope{hops}")
        n, total = scope.join(size, "node", "left").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).head()
        log.append({"hops": hops, "nodes": n, "size": total, "gain": n - before, "over_budget": total > budget})
        if kept is not None and (total > budget or n - before < min_gain):
            break
        kept, before = scope, n
    return kept, log


def distances(edges: DataFrame, seeds: DataFrame, most: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """(session_id, start, node, distance): least total weight over edges (src, dst, weight 0 or 1), undirected, up to `most` if given.

    Nodes tied by weight-0 edges are one: they are contracted first, then each step of weight 1 joins the newest layer.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    zero = edges.where("weight = 0").select("session_id", F.col("src").alias("a"), F.col("dst").alias("b"))
    tied = components(zero, scratch)
    root = lambda df, c: df.join(tied.select("session_id", F.col("node").alias(c), F.col("root").alias(f"{c}_root")), ["session_id", c], "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    one = root(root(edges.where("weight = 1").select("session_id", "src", "dst"), "src"), "dst").select("session_id", F.col("src_root").alias("src"), F.col("dst_root").alias("dst"))
    one = scratch.save(one.unionByName(one.select("session_id", F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct(), "one")
    s = root(seeds.select("session_id", F.col("node").alias("start")), "start")
    found = layer = s.select("session_id", "start", F.col("start_root").alias("at"), F.lit(0).alias("distance"))
    for d in count(1):
        if most is not None and d > most:
            break
        new = layer.select("session_id", "start", F.col("at").alias("src")).join(one, ["session_id", "src"]).select("session_id", "start", F.col("dst").alias("at")).distinct()
        layer = scratch.save(new.join(found, ["session_id", "start", "at"], "left_anti").withColumn("distance", F.lit(d)), f"reach{d}")
        if layer.isEmpty():
            break
        found = found.unionByName(layer)
    members = tied.select("session_id", F.col("root").alias("at"), "node")
    alone = found.join(members, ["session_id", "at"], "left")
    return alone.select("session_id", "start", F.coalesce("node", "at").alias("node"), "distance").distinct()


def difficulty(needed: DataFrame, dist: DataFrame) -> DataFrame:
    """needed (session_id, item, start, node) with the largest distance, and easy (<= 1), medium (2), hard (>= 3) or unknown if a node is out of reach."""
    j = needed.join(dist, ["session_id", "start", "node"], "left").groupBy("session_id", "item").agg(F.max("distance").alias("far"), F.bool_and(F.col("distance").isNotNull()).alias("whole"))
    d = F.when(F.col("whole"), F.col("far"))
    return j.select("session_id", "item", d.alias("max_distance"), F.when(d <= 1, "easy").when(d == 2, "medium").when(d >= 3, "hard").otherwise("unknown").alias("difficulty"))


def components(links: DataFrame, scratch: Scratch, rounds: int = 40) -> DataFrame:
    """(session_id, node, root) of nodes in links (session_id, a, b): least labels spread, each round also to the label's own label."""
    both = links.select("session_id", F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select("session_id", F.col("b").alias("u"), F.col("a").alias("v"))).distinct()
    both = scratch.save(both, "links")
    label = scratch.save(both.groupBy("session_id", F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")), "label0")
    for i in range(1, rounds):
        near = both.join(label.select("session_id", F.col("node").alias("v"), "root"), ["session_id", "v"]).groupBy("session_id", F.col("u").alias("node")).agg(F.min("root").alias("near"))
        jump = label.select("session_id", F.col("node").alias("root"), F.col("root").alias("far"))
        new = label.join(near, ["session_id", "node"]).join(jump, ["session_id", "root"]).select("session_id", "node", F.least("root", "near", "far").alias("root"))
        new = scratch.save(new, f"label{i}")
        same = new.join(label, ["session_id", "node", "root"], "left_anti").isEmpty()
        label = new
        if same:
            return label
    raise RuntimeError("components did not settle")


def event_index(records: DataFrame, events: DataFrame, labels, width: int = 6) -> DataFrame:
    """Patch, observation and result events with the labels and ids of records at most `width` orders away."""
    from .joins import band_join

    e = events.where(F.col("kind").isin("patch", "observation", "result")).select("session_id", "id", "ord", "kind", "success", "affected_paths")
    r = records.select("session_id", "id", "ord", labels.alias("labels"))
    near = band_join(e.select("session_id", "id", "ord"), r, ["session_id"], "ord", width).groupBy("session_id", F.col("l_id").alias("id")).agg(F.array_distinct(F.flatten(F.collect_set("r_labels"))).alias("near"), F.collect_set("r_id").alias("source_ids"))
    own = F.array_compact(F.array(F.when(F.col("kind") == "patch", F.lit("change")), F.when(~F.col("success"), F.lit("failure"))))
    return e.join(near, ["session_id", "id"], "left").select("session_id", "id", "ord", "kind", F.col("affected_paths").alias("paths"), F.array_sort(F.array_union(F.coalesce("near", F.array().cast("array<string>")), own)).alias("labels"), F.array_sort(F.array_union(F.coalesce("source_ids", F.array().cast("array<string>")), F.array("id"))).alias("source_ids"))


def structural_score(labels: Column, versions: Column, paths: Column, events: Column, sources: Column):
    has = lambda *xs: F.arrays_overlap(labels, F.array(*map(F.lit, xs)))
    part = lambda c, n: F.when(c, n).otherwise(0)
    return part(has("change"), 2) + part(versions >= 2, 3) + part(has("feedback", "failure", "validation"), 2) + part(paths > 1, 2) + part(events >= 2, 2) + part(sources >= 1, 1)


def beam(index: DataFrame, scratch: Scratch, width: int = 3, depth: int = 5, min_score: int = 8, near: int = 30, each: int = 4) -> DataFrame:
    """(session_id, root, event_ids, score): chains of events grown from the roots, the best `width` of a root kept at each depth.

    index: session_id, id, ord, paths, labels, versions (number). A successor is later and shares a path or a useful
    label, or lies within `near` orders; the best `each` go on.
    """
    useful = F.array(*map(F.lit, ("change", "failure", "feedback", "validation")))
    ev = index.select("session_id", "id", "ord", "paths", "labels", "versions")
    w = Window.partitionBy("session_id").orderBy(F.desc(3 * F.size(F.array_intersect("labels", F.array(*map(F.lit, ("feedback", "failure", "validation"))))) + 2 * F.array_contains("labels", "change").cast("int") + F.least(F.size("paths"), F.lit(3))), "ord", "id")
    front = scratch.save(ev.withColumn("n", F.row_number().over(w)).where(F.col("n") <= width).select("session_id", F.col("id").alias("root"), F.array("id").alias("event_ids"), F.col("ord").alias("last"), "paths", "labels", "versions"), "beam0")
    done = front
    step = ev.select("session_id", F.col("id").alias("next"), F.col("ord").alias("next_ord"), F.col("paths").alias("next_paths"), F.col("labels").alias("next_labels"), F.col("versions").alias("next_versions"))
    for i in range(1, depth):
        # A successor is looked for by shared path, shared useful label or order cell, so every join has an equi key.
        keys = lambda p, lab, o, spread: F.array_union(F.array_union(F.transform(p, lambda x: F.concat(F.lit("p"), x)), F.transform(F.array_intersect(lab, useful), lambda x: F.concat(F.lit("l"), x))), F.transform(F.array(*(F.floor(o / near) + d for d in spread)), lambda x: F.concat(F.lit("c"), x.cast("string"))))
        a = front.withColumn("k", F.explode(keys(F.col("paths"), F.col("labels"), F.col("last"), (0, 1))))
        b = step.withColumn("k", F.explode(keys(F.col("next_paths"), F.col("next_labels"), F.col("next_ord"), (0,))))
        met = a.join(b, ["session_id", "k"]).where("next_ord > last").where(~F.col("k").startswith("c") | (F.col("next_ord") - F.col("last") <= near)).drop("k").distinct()
        gain = F.size(F.array_intersect("labels", "next_labels")) + 2 * F.size(F.array_intersect("paths", "next_paths"))
        per = Window.partitionBy("session_id", "root", "event_ids").orderBy(F.desc(gain), "next_ord", "next")
        grown = met.withColumn("n", F.row_number().over(per)).where(F.col("n") <= each).select("session_id", "root", F.concat("event_ids", F.array("next")).alias("event_ids"), F.col("next_ord").alias("last"), F.array_union("paths", "next_paths").alias("paths"), F.array_union("labels", "next_labels").alias("labels"), (F.col("versions") + F.col("next_versions")).alias("versions"))
        best = Window.partitionBy("session_id", "root").orderBy(F.desc(_score()), "event_ids")
        front = scratch.save(grown.withColumn("n", F.row_number().over(best)).where(F.col("n") <= width).drop("n"), f"beam{i}")
        if front.isEmpty():
            break
        done = done.unionByName(front)
    one = Window.partitionBy("session_id", F.array_sort("event_ids")).orderBy(F.desc("score"), "root")
    return done.withColumn("score", _score()).where(F.col("score") >= min_score).withColumn("n", F.row_number().over(one)).where("n = 1").select("session_id", "root", "event_ids", "score")


def _score():
    return structural_score(F.col("labels"), F.col("versions"), F.size("paths"), F.size("event_ids"), F.size("event_ids"))
