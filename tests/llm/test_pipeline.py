import os
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from weftline.llm import queries
from weftline.llm.decontaminate import Block, matches
from weftline.llm.toxicity import train

from .test_near import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]

    def run(name, df):
        stages[name](spark, df, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        return out, [(r.doc_id, r.text) for r in out.collect()] if "text" in out.columns else out.collect()

    first, kept = run("toxicity", docs)
    assert first.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in queries.op4_toxicity(spark, SF).collect()}
    assert {i for i, _ in kept} == {i for i, p in scores.items() if not p}

    by_text = defaultdict(list)
    for i, t in kept:
        by_text[t].append(i)
    second, kept = run("exact_dedup", first)
    assert sorted(i for i, _ in kept) == sorted(max(v) for v in by_text.values())

    want = sorted(k for k, _, _, stays in brute(kept) if stays)
    third, kept = run("near_dedup", second)
    assert sorted(i for i, _ in kept) == want and third.columns == docs.columns

    items = Block.of([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()], 5)
    leaks = {kept[t][0] for t, *_ in matches([t or "" for _, t in kept], items, 5, 0.8)}
    fourth, kept = run("decontamination", third)
    assert {i for i, _ in kept} == set(want) - leaks

    _, mixed = run("mixing", fourth)
    assert mixed and {r.doc_id for r in mixed} <= {i for i, _ in kept}
    assert sorted(map(tuple, mixed), key=str) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=str)


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_a_model_of_one_text():
    assert train([("bad words", 1)]).slope == 0.0


def test_scratch_tables_are_deleted(spark):
    from weftline.llm.common import _TABLES, clean_up, saved, scratch

    clean_up(spark)
    with scratch(spark) as kept:
        gone = saved(spark.range(3), "gone")
        with scratch(spark) as inner:
            saved(spark.range(3), "gone")
            stays = kept(inner(saved(spark.range(4), "stays")))
    assert stays.count() == 4 and _TABLES == [stays._saved_at]
    with pytest.raises(Exception, match="exist"):
        gone.count()
    clean_up(spark)
    assert _TABLES == []


def test_threads_do_not_delete_each_others_tables(spark):
    from weftline.llm.common import saved, scratch

    with scratch(spark), ThreadPoolExecutor(1) as other:
        mine = saved(spark.range(3), "mine")

        def work():
            with scratch(spark):
                saved(spark.range(5), "other")

        other.submit(work).result()
        assert mine.count() == 3
