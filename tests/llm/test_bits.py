"""Bit tables: nothing of the set is missed, little else passes, splits lose no row."""

import numpy as np
from pyspark.sql import functions as F

from streambed.llm import bits, common
from tests.llm.fixtures import documents


def test_every_hash_is_found_and_few_others(spark):
    rng = np.random.default_rng(1)
    known, others = (rng.integers(-(2**63), 2**63, n, dtype=np.int64) for n in (5000, 100_000))
    table = bits.table(spark.createDataFrame([(int(h),) for h in known] + [(None,)], "h long"))
    assert len(bits.places(table, known.view(np.uint64))) == len(known)
    assert len(bits.places(table, others.view(np.uint64))) < 5
    assert len(bits.places(np.zeros_like(table), known.view(np.uint64))) == 0
    full = np.full_like(table, np.iinfo(np.uint64).max)
    assert len(bits.places(full, others.view(np.uint64))) == len(others)


def test_split_gives_every_row_once(spark):
    docs = documents(spark, [(k, f"text {k}") for k in range(50)] + [(None, "null id"), (3, None), (3, "text 3")])
    keys = common.keyed(docs, "doc_id", "text").where("doc_id % 2 = 0 or doc_id is null")
    keys = keys.select(F.col(common.OWN_ID).alias(common.KEY_ID), F.col(common.OWN_HASH).alias(common.KEY_HASH))
    rest, known = common.split(docs, keys, "doc_id", "text")
    assert rest.count() + known.count() == docs.count()
    assert known.join(keys, common.same_document(), "left_semi").count() == keys.count() == 26
    assert rest.join(keys, common.same_document(), "left_semi").count() == 0
    none, empty = common.split(docs, keys.limit(0), "doc_id", "text")
    assert none.count() == docs.count() and empty.count() == 0
