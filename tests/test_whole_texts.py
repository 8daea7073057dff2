"""Queries that read texts read all of them."""

import pytest

from evidra.plans import corpus_queries  # noqa: F401
from evidra.plans.registry import QUERIES

FILLER = "it is so and " * 60


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def test_tagged_parse_reads_the_end_of_a_text(spark, folder):
    sf = folder([(10, "x" * 80 + "\nSOURCES: s1\nEND_FACT", "en", "s", 100)])
    row = QUERIES["tagged_parse"](spark, sf).head()
    assert (row.error, row.blocks, row.sources) == (None, 1, "s1")


def test_fact_groups_share_late_and_many_entities(spark, folder):
    many = " ".join(f"pkg_{i}.mod_{i}" for i in range(20))
    rows = [(1, FILLER + "retry_queue.flush_all", "en", "s", 1), (2, FILLER + "retry_queue.flush_all", "en", "s", 1)]
    rows += [(3, f"{many} cache_store.evict_one", "en", "t", 1), (4, "cache_store.evict_one", "en", "t", 1)]
    got = {frozenset(int(f) for f in r.facts.split(",")) for r in QUERIES["fact_groups"](spark, folder(rows)).collect()}
    assert {frozenset({1, 2}), frozenset({3, 4})} <= got
