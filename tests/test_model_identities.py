"""Exact identities of the model operators, checked by brute force."""

from pyspark.sql import functions as F

from umpire.plans import model as MD
from umpire.plans.training import trained
from umpire.sources.testdata import DOC_FEATURES

from conftest import SF_CHECK


def test_shapley_values_sum_to_the_score_gap(spark):
    t = trained(spark, SF_CHECK)
    rows = t.test.orderBy("doc_id").limit(5).cache()
    z = t.train.orderBy("doc_id").limit(1).select(*DOC_FEATURES).cache()
    phi = MD.shapley(t.model, rows, z, "doc_id", DOC_FEATURES, samples=3, seed=7)
    sums = {r["doc_id"]: r["s"] for r in phi.groupBy("doc_id").agg(F.sum("phi").alias("s")).collect()}
    px = {r["doc_id"]: r["p"] for r in MD.score(t.model, rows).collect()}
    pz = MD.score(t.model, z).first()["p"]
    assert set(sums) == set(px)
    for k, s in sums.items():
        assert abs(s - (px[k] - pz)) < 1e-9


def test_split_weight_counts_internal_nodes(spark):
    t = trained(spark, SF_CHECK)
    weight = MD.tree_importance(t.model.nodes(spark), DOC_FEATURES, "weight").agg(F.sum("importance")).first()[0]
    assert weight == sum((len(tree.feature) - 1) // 2 for tree in t.model.trees) > 0


def test_best_prefix_model_has_kept_rounds(spark):
    t = trained(spark, SF_CHECK)
    assert len(t.model.trees) == t.kept
    assert t.kept == MD.best_prefix(t.losses, 25)
