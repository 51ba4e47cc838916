import json

import pytest
from pyspark.sql import functions as F

from grantlake.functions.masking import mask_payload
from grantlake.functions.scoring import remediation, score

# Statement, score, subject type, a part of the reasons.
CASES = [
    ("allow group Admins to manage all-resources in tenancy", 5, "group", "High score"),
    ("allow group A to read buckets in compartment c", 0, "group", ""),
    ("allow group A to read buckets in compartment c where request.user.id = 'x'", 1, "group", "Restrictive"),
    ("Allow  ANY-USER\tto  read buckets\nin compartment c", 4, "any-user", "Any-user subject"),
    ("allow any-user to manage all-resources in tenancy where all { request.user.id = '' }", 4, "any-user", "Restrictive"),
    ("allow any-group to {KEY_READ, KEY_USE} in compartment c", 5, "any-group", "service-defined actions"),
    ("allow dynamic-group d to manage log-family in compartment c", 5, "dynamic-group", "Dynamic group"),
    ("allow dynamic-group d to use log-family in compartment c", 3, "dynamic-group", ""),
    ("allow service s to manage buckets in tenancy where target.name != 'x'", 5, "service", "Broad or negative"),
    ("endorse group g to read buckets in any-tenancy", 2, "group", ""),
    ("admit group g of tenancy other to read buckets in compartment c", 4, "group", "Admit cross-tenancy trust"),
    ("admit any-user of any-tenancy to read buckets in compartment c", 5, "any-user", "Admit of any-user/any-tenancy"),
    ("allow resource app to tend the garden", 0, "resource-principal", "Nonstandard action phrase"),
    ("allow group g to { KEY_READ", 0, "group", ""),
    ("deny group g to read buckets", 0, "unknown", None),
    ("   ", 0, "unknown", None),
]


def test_scores(spark):
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, statement string")
    got = {r["i"]: r for r in score(frame).collect()}
    for i, (statement, points, subject, part) in enumerate(CASES):
        row = got[i]
        assert (row["permissive_score"], row["subject_type"]) == (points, subject), statement
        assert (row["reasons"] is None) if part is None else (part in row["reasons"]), statement
    assert got[13]["actions_in_braces"] == "KEY_READ" and got[5]["actions_in_braces"] == "KEY_READ;KEY_USE"


def test_remediation(spark):
    frame = spark.createDataFrame([("allow any-user to manage all-resources in tenancy",), ("allow group g to read x",), ("allow group g to x y",)], "statement string")
    texts = [r[0] for r in score(frame).select(remediation("ACME")).collect()]
    assert texts[0].count(" | ") == 1 and texts[0].startswith("Replace any-user")
    assert texts[1] == "Review for least privilege and proper scoping"
    assert "against ACME policy reference" in texts[2]


def _masked(spark, payload):
    frame = spark.createDataFrame([(payload if isinstance(payload, str) else json.dumps(payload),)], "p string")
    return json.loads(frame.select(mask_payload(F.col("p"))).first()[0])


@pytest.mark.parametrize("word", ["Password", "clientSECRET", "myPrivateKey", "credentials2"])
def test_masks_at_any_depth(spark, word):
    secret = {"selection": word, "value": ["s3cret"], "x": [{"selection": word, "value": 1}]}
    got = _masked(spark, {"a": [{"b": secret}], "value": "kept"})
    inner = got["a"][0]["b"]
    assert inner["value"] == ["***"] and inner["x"][0]["value"] == ["***"] and got["value"] == "kept"


def test_masks_escaped_words_and_leaves_the_rest(spark):
    assert _masked(spark, '{"selection": "pass\\u0077ord", "value": "v"}')["value"] == ["***"]
    assert _masked(spark, '{"sel\\u0065ction": "password", "value": "v"}')["value"] == ["***"]
    plain = {"selection": "colour", "value": "password"}
    assert _masked(spark, plain) == plain
    assert _masked(spark, {"selection": ["password"], "value": "v"})["value"] == "v"
    assert "value" not in _masked(spark, {"selection": "password"})
    frame = spark.createDataFrame([("{broken password selection",), (None,)], "p string")
    assert [r[0] for r in frame.select(mask_payload(F.col("p"))).collect()] == ["{broken password selection", None]


def test_masks_deep_payloads(spark):
    def nested(depth):
        return '{"a":' * depth + '{"selection":"password","value":"s3cret"}' + "}" * depth

    frame = spark.createDataFrame([(nested(2000),), (nested(200_000),)], "p string")
    deep, deeper = [r[0] for r in frame.select(mask_payload(F.col("p"))).collect()]
    assert deep == nested(2000).replace('"s3cret"', '["***"]') and deeper == '["***"]'
