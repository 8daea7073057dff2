"""The pipeline, stage by stage against a brute-force version, and as a whole."""

import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from evidra.llm.common import Scratch

from .conftest import WORDS, prose
from .test_dedup import brute, last, norm
from .test_text_models import check_packing


def tables(spark, path):
    r = random.Random(3)
    good = [prose(2000 + i, 50 + i) for i in range(50)]
    near = [t + " one more end here now" for t in good[:8]]
    junk = [" | ".join(r.choice(WORDS) + "***" for _ in range(40)) for _ in range(20)]
    texts = good + good[:10] + [good[3].replace(" ", "  ")] + near + junk
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "de", "s", len(t)) for i, t in enumerate(texts)] + [(500, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.coalesce(1).write.parquet(f"{path}/documents.parquet")
    bad = range(len(texts) - 20, len(texts))
    spark.createDataFrame([(i, int(i not in bad), 0) for i in range(0, len(texts), 2)], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    return set(range(len(texts))) - set(bad), set(bad)


def test_stages_and_run(spark, tmp_path):
    good, bad = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        out = spark.read.parquet(f"{tmp_path}/out/{name}")
        rows, before = out.collect(), docs.collect()
        assert name == "packing" or out.columns == columns
        if name == "quality":
            ids = {r.doc_id for r in rows}
            assert len(ids & good) >= len(good) - 2 and len(ids & bad) <= 1
        elif name == "exact_dedup":
            first = {}
            for r in sorted(before, key=lambda r: last(r.doc_id)):
                first.setdefault(norm(r.text), r.doc_id)
            assert sorted(map(last, first.values())) == sorted(last(r.doc_id) for r in rows)
        elif name == "near_dedup":
            want = {k[2] for k in brute([(r.doc_id, r.text) for r in before], 5, 80)}
            assert Counter(r.doc_id for r in rows) == Counter(want)
        elif name == "mixing":
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before} and all(r.text == next(b.text for b in before if b.doc_id == r.doc_id) for r in rows)
        else:
            check_packing(rows, [(r.doc_id, r.text) for r in before])
        docs, seen[name] = out, rows
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, whole)) == Counter(map(key, seen["packing"]))


def test_edge_rows_and_empty_tables(spark, tmp_path, edge, edge_rows, empty):
    labels = spark.createDataFrame([(13, 1, 0), (15, 1, 0), (7, 0, 0), (None, 1, None)], "doc_id bigint, quality int, toxic int")
    for name, docs in (("edge", edge), ("empty", empty)):
        path = f"{tmp_path}/{name}"
        docs.coalesce(1).write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        rows = corpus_pipeline.run(spark, path).collect()
        if name == "empty":
            assert rows == []
            continue
        assert {r.doc_id for r in rows} <= {r[0] for r in edge_rows} and any(r.doc_id == 13 for r in rows)
        by = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == by.get(r.sequence_id, 0)
            by[r.sequence_id] = r.offset + r.length
        assert max(by.values()) <= 2048


def test_workers_get_few_bytes_at_once(spark):
    def look(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    Scratch(spark)
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("some words "), 1000).alias("text"))
    sizes = [r.n for r in docs.mapInArrow(look, "n bigint").collect()]
    assert max(sizes) < 6 << 20 and sum(sizes) >= 33_000_000
