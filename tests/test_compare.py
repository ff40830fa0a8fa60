"""compare() against clouds with one thing changed."""

import pytest
from pyspark.sql import functions as F

from splatframe.operators import clouds as C
from splatframe.plans.cloud import decode, raw_from_embeddings

DATA = "/root/testdata/sf0.001"


def grown(t, by):
    return t.withColumn("scale", F.struct(*[(F.col(f"scale.{a}") + by).alias(a) for a in "xyz"]))


@pytest.mark.parametrize(("change", "want"), [
    (lambda t: t, set()),
    (lambda t: t.withColumn("rest", F.transform("rest", lambda c: c.withField("g", c["g"] + 1e-5))), {"rest"}),
    (lambda t: t.withColumn("rest", F.slice("rest", 1, 8)), {"rest"}),
    (lambda t: t.withColumn("rest", F.transform("rest", lambda c: c.withField("g", F.lit(float("nan"))))), {"rest"}),
    (lambda t: grown(t, 8e-6), {"scale", "extent"}),
    (lambda t: grown(t, 1e-7), set()),
    (lambda t: grown(t, 1e39), {"scale", "extent"}),
])
def test_compare(spark, change, want):
    a = decode(raw_from_embeddings(spark, DATA)).filter("asset_id = (0)").limit(50).localCheckpoint()
    assert {r.field for r in C.compare(a, change(a)).collect()} == want
