"""The stages of the pipeline on the small documents."""

import importlib.util
import os
import sys

import pytest
from pyspark.sql import functions as F

from test_text_operators import brute_components, check_packing, plain_spans

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("no pipeline here", allow_module_level=True)

import corpus_pipeline  # noqa: E402

from millrace.session import materialize  # noqa: E402


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_small), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert len(kept["language_id"]) == 200

    first = {}
    for i, text in sorted(kept["language_id"].items(), key=lambda x: (-len(x[1]), x[0])):
        first.setdefault("".join(text.split()), i)
    assert set(kept["exact_dedup"]) == set(first.values())

    groups = brute_components(kept["exact_dedup"])
    assert set(kept["jaccard_join"]) == {component for _, component in groups.values()}

    assert set(kept["secret_scan"]) == set(kept["jaccard_join"])
    for i, text in kept["secret_scan"].items():
        changed = bool(plain_spans(kept["jaccard_join"][i]))
        assert ("[SECRET]" in text) == changed
        assert changed or text == kept["jaccard_join"][i]

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()
    assert check_packing(packed, kept["secret_scan"]) < 0.05


def test_the_model_decides_a_missing_language(spark, sf_small):
    """Where `lang` is missing, later stages see what the classifier says of the text."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    stated = {r.doc_id: r.lang for r in docs.collect()}
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    found = corpus_pipeline.STAGES[0][1](spark, hidden, sf_small)
    assert found.columns == docs.columns
    found = {r.doc_id: r.lang for r in found.collect()}
    assert all(found[i] == stated[i] for i in found if i % 3)
    asked = [i for i in found if i % 3 == 0]
    assert {found[i] for i in asked} == {stated[i] for i in asked} and len({found[i] for i in asked}) > 2
    assert sum(found[i] == stated[i] for i in asked) >= 0.9 * len(asked)


def test_run_is_registered(spark, sf_small):
    import __spark_entry__ as registry

    assert registry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, sf_small).count() >= 150


def test_empty_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_small), name)
        assert docs.count() == 0
