"""The pipeline: each stage on what the one before it kept."""

import corpus_pipeline
from streambed.llm import common
from tests.llm.fixtures import TINY
from tests.llm.test_decontaminate import plain_overlaps
from tests.llm.test_line_dedup import plain_kept, plain_lines
from tests.llm.test_simhash import plain_fingerprint, plain_groups

ORDER = ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_stages_take_effect_on_their_own_input(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER
    docs, kept = common.table(spark, TINY, "documents"), {}
    schema = docs.schema.simpleString()
    kept["documents"] = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TINY).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.schema.simpleString() == schema
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
            assert len(kept[name]) == docs.count()
    labels = {r.doc_id: r.toxic for r in common.table(spark, TINY, "labels").collect()}
    clean = [k for k in kept["documents"] if labels.get(k) == 0]
    assert len([k for k in clean if k in kept["toxicity"]]) >= 0.97 * len(clean)
    assert all(kept["documents"][k] == t for k, t in kept["toxicity"].items())

    before = sorted(kept["toxicity"].items())
    assert [plain_lines(kept["line_dedup"][k]) for k, _ in before] == plain_kept(before, 50)

    before = sorted(kept["line_dedup"].items())
    least = plain_groups([(k, plain_fingerprint(t)) for k, t in before], 2)
    assert set(kept["near_duplicates"]) == {k for (k, _), c in zip(before, least) if k == c}

    items = [tuple(r) for r in common.table(spark, TINY, "benchmark").collect()]
    some = sorted(kept["near_duplicates"].items())
    gone = {k for k, _ in plain_overlaps(some, items)}
    assert [k for k, _ in some if k in kept["decontamination"]] == [k for k, _ in some if k not in gone]
    assert all(kept["line_dedup"][k] == t for k, t in kept["decontamination"].items())

    packed = docs.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in packed} == set(kept["decontamination"])
    assert corpus_pipeline.run(spark, TINY).count() == docs.count()


