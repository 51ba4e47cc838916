import json

from grantlake.entities import AUDIT, ENTITIES
from grantlake.operators.flatten import flatten, is_malformed
from tests.events import decoded


def rows(spark, name, *events, history=False):
    frame = flatten(decoded(spark, *[(name, *e) for e in events]), name, history=history)
    return [r.asDict(recursive=True) for r in frame.orderBy("_seq").collect()]


def test_every_entity_yields_its_declared_columns_with_defaults(spark):
    for entity in [*ENTITIES.values(), AUDIT]:
        raw = {"globalIdentity": {}} if entity.name == "IDENTITY" else {"unknown": 1}
        if entity.name == "PERMISSION_ASSIGNMENT":
            got = rows(spark, entity.name, (raw, "DELETE"))
        else:
            got = rows(spark, entity.name, (raw,))
        assert len(got) == 1, entity.name
        row = got[0]
        assert list(row)[: len(entity.columns)] == entity.column_names
        header = {"tenancy_id", "service_instance_id", "event_object_type", "operation_type", "event_timestamp"}
        scored = {"attributes"} if entity.name == "CLOUD_POLICY" else set()
        for column in entity.columns:
            if column.name in header | scored:
                continue
            expected = {"text": "", "json": "{}"}.get(column.kind)
            assert row[column.name] == expected, (entity.name, column.name)
        assert (row["tenancy_id"], row["service_instance_id"], row["event_object_type"]) == ("T", "S", entity.name)


def test_empty_lists_keep_one_base_row(spark):
    assert [r["access_bundle_id"] for r in rows(spark, "ROLE", ({"id": "r", "accessBundleIds": []},))] == [""]
    assert [r["policy_rule_id"] for r in rows(spark, "POLICY", ({"id": "p", "policyRules": []},))] == [""]
    got = rows(spark, "CLOUD_GROUP", ({"id": "group.X.1", "add": {"identities": []}, "remove": {"identities": []}},))
    assert [(r["id"], r["identity_operation_type"], r["group_membership_type"]) for r in got] == [("group.X.1", "", "X")]


def test_broken_events_are_left_out_and_counted(spark):
    events = decoded(
        spark, ("ROLE", {"id": "a"}), ("ROLE", '{"id": "b"'), ("ROLE", "17"), ("ROLE", "[]"), ("ROLE", "  {\"id\": \"c\"}")
    )
    assert sorted(r["id"] for r in flatten(events, "ROLE").collect()) == ["a", "c"]
    assert events.filter(is_malformed()).count() == 3


def test_identity_rules(spark):
    got = rows(
        spark,
        "IDENTITY",
        (
            {
                "globalIdentity": {
                    "id": "globalId.ICF.1",
                    "identity": {
                        "agRisk": {"value": 3, "customAttributes": {"k": 1}},
                        "userName": "u",
                        "name": {"familyName": "F", "givenName": "G"},
                    },
                    "targetIdentities": [
                        {"id": "targetId.account.9", "targetId": "t", "identity": {"status": "A", "name": {"x": 1}}},
                        {"id": None, "externalId": "e"},
                    ],
                }
            },
            "UPDATE",
        ),
        ({"globalIdentity": {"id": "nodots", "targetIdentities": []}},),
        ({"globalIdentity": {"identity": {"agRisk": {}}}},),
        ({"other": 1},),
    )
    assert [(r["id"], r["ti_id"]) for r in got] == [
        ("globalId.ICF.1", "targetId.account.9"),
        ("globalId.ICF.1", None),
        ("nodots", ""),
    ]
    account, other, bare = got
    assert account["identity_attributes"] == "{}" and json.loads(other["identity_attributes"])["userName"] == "u"
    assert (account["risk"], account["ag_risk_attributes"], account["last_name"]) == (3, '{"k":1}', "F")
    assert (account["ti_identity_status"], account["ti_identity_name"]) == ("A", '{"x":1}')
    assert account["identity_type"] == "ICF" and bare["identity_type"] == ""
    assert account["ti_operation_type"] == "UPDATE" and account["ti_event_timestamp"] is not None
    assert bare["ti_operation_type"] == "CREATE" and bare["ti_event_timestamp"] is None


def test_collection_rules(spark):
    got = rows(
        spark,
        "GLOBAL_IDENTITY_COLLECTION",
        ({"id": "a", "tags": ["x", "y"], "ownerUids": ["u"], "agRisk": {"value": 2}, "agManaged": False,
          "add": {"members": [{"globalIdentityId": "m", "membershipType": "D"}, {"membershipType": "no id"}]},
          "remove": {"members": [{"globalIdentityId": "n"}]}},),
        ({"id": "b", "tags": "one", "ownerUids": ["u"], "ownerUIDs": ["w"]},),
        ({"id": "c", "tags": []},),
        ({"id": "d", "tags": None},),
    )
    assert [(r["id"], r["member_operation_type"], r["member_global_id"]) for r in got] == [
        ("a", "", ""), ("a", "add", "m"), ("a", "remove", "n"), ("b", "", ""), ("c", "", ""), ("d", "", "")
    ]
    assert [r["tags"] for r in got[2:]] == ["x,y", '"one"', "[]", "null"]
    assert (got[0]["owner_uids"], got[3]["owner_uids"]) == ('["u"]', '["w"]')
    assert (got[0]["risk"], got[0]["ag_managed"]) == (2, "False")


def test_an_explicit_null_member_is_not_a_missing_member(spark):
    got = rows(
        spark,
        "CLOUD_GROUP",
        ({"id": "g.1", "remove": {"identities": [{"id": None}, {"targetIdentityId": "t"}]}}, "UPDATE"),
    )
    assert [r["identity_global_id"] for r in got] == [None, ""]


def test_cloud_policy_rules(spark):
    got = rows(
        spark,
        "CLOUD_POLICY",
        ({"id": "p", "policyStatementId": "s", "location": {"compartment": "c"}, "resourceTypes": "r", "resourceType": "no",
          "statement": "allow group g to manage key-family in tenancy", "customAttributes": {"a": {"b": [1, None]}, "reasons": 1}},),
        ({"id": "q", "policyStatementId": "s", "location": "here", "subjects": "none"}, "DELETE"),
        ({"id": "x", "customAttributes": "text", "statement": "whatever"},),
    )
    assert [(r["id"], r["policy_statement_id"], r["location"], r["resource_type"]) for r in got] == [
        ("p", "s", "c", "r"), ("", "q", "here", ""), ("x", "", "", "")
    ]
    first, second, third = (json.loads(r["attributes"]) for r in got)
    assert first["a"] == {"b": [1, None]} and first["permissive_score"] == 5
    assert first["reasons"].startswith("High score from action/resource/scope (action=manage,resource=\"key-family\"")
    assert second == third == {"permissive_score": 0, "reasons": []}


def test_assignment_rules(spark):
    v1 = {
        "targetIdentityId": "p", "globalIdentityId": "g", "additionalProperties": {"from": "parent"},
        "add": [{"id": "a1", "targetIdentityId": "", "validFrom": "0", "validTo": 7, "customAttributes": {"c": 1}},
                {"id": "a2", "targetIdentityId": "own", "customAttributes": {"c": 1}, "additionalProperties": {"p": 1}},
                {"id": ""}, {"name": "no id"}, 5],
        "remove": [{"id": "r1", "created": 9}],
    }
    state = rows(spark, "PERMISSION_ASSIGNMENT", (v1, "UPDATE"))
    assert [(r["assignment_id"], r["identity_operation_type"], r["target_identity_id"]) for r in state] == [
        ("a1", "add", "p"), ("a2", "add", "own"), ("r1", "remove", "p")
    ]
    assert [r["assignment_attributes"] for r in state] == ['{"c":1}', '{"p":1}', '{"from":"parent"}']
    assert (state[0]["valid_from"], state[0]["valid_to"], state[2]["created_on"]) == (None, 7, None)
    assert len(rows(spark, "PERMISSION_ASSIGNMENT", (v1, "UPDATE"), history=True)) == 5
    assert rows(spark, "PERMISSION_ASSIGNMENT", ({"targetIdentityId": "p"}, "UPDATE")) == []
    deleted = rows(spark, "PERMISSION_ASSIGNMENT", ({"targetIdentityId": "p", "ids": ["x", "y"]}, "DELETE"), ({"targetIdentityId": "p"}, "DELETE"))
    assert [(r["permission_id"], r["assignment_id"], r["identity_operation_type"]) for r in deleted] == [
        ("x", "", ""), ("y", "", ""), ("", "", "")
    ]
    v2 = rows(
        spark,
        "PERMISSION_ASSIGNMENT",
        ([{"id": "a", "created": 0, "lastModified": 4, "targetIdentityId": "t"}, {"id": "b"}], "DELETE", "2.0"),
        ({"id": "c"}, "CREATE", "2.0"),
    )
    assert [(r["assignment_id"], r["identity_operation_type"]) for r in v2] == [("a", "remove"), ("b", "remove"), ("c", "add")]
    assert (v2[0]["created_on"], v2[0]["updated_on"], v2[0]["target_identity_id"]) == (None, 4, "t")


def test_flags_and_numbers(spark):
    got = rows(
        spark,
        "ROLE",
        ({"id": "a", "agManaged": True, "createdOn": 5.0},),
        ({"id": "b", "agManaged": "true", "createdOn": "12"},),
        ({"id": "c", "createdOn": "soon"},),
        ({"id": "d", "createdOn": 1735689600000.9},),
        ({"id": "e", "createdOn": 1735689600000},),
    )
    assert [(r["ag_managed"], r["created_on"], r["_bad"]) for r in got] == [
        ("True", 5, ""), ("true", 12, ""), ("", None, "created_on"), ("", None, "created_on"), ("", 1735689600000, "")
    ]


def test_assignments_inside_json_text(spark):
    listed = [{"id": "a", "targetIdentityId": "t"}, {"id": "b"}]
    got = rows(spark, "PERMISSION_ASSIGNMENT", (json.dumps(listed), "CREATE", "2.0"), (json.dumps({"id": "c"}), "CREATE", "2.0"))
    assert [r["assignment_id"] for r in got] == ["a", "b", "c"]


def test_resource_tenant_and_ownership_id(spark):
    got = rows(spark, "RESOURCE", ({"id": "a", "tenancyId": "own"},), ({"id": "b"},))
    assert [r["tenancy_id"] for r in got] == ["own", "T"]
    got = rows(
        spark,
        "OWNERSHIP_COLLECTION",
        ({"id": "i", "ownershipCollectionId": "o"}, "UPDATE"),
        ({"id": "i", "ownershipCollectionId": "o"}, "DELETE"),
    )
    assert [r["id"] for r in got] == ["o", "i"]


def test_event_columns_are_worked_out_before_the_children_get_rows(spark):
    name = "GLOBAL_IDENTITY_COLLECTION"
    event = {"id": "a", "agRisk": {"value": "2.0"}, "createdOn": "x", "add": {"members": [{"globalIdentityId": "m"}, {"globalIdentityId": None}]}}
    frame = flatten(decoded(spark, (name, event), (name, "{broken")), name)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    generated = next(line for line in plan.splitlines() if "Generate posexplode" in line)
    assert "from_json" not in generated and "transform" not in generated
    assert [(r["id"], r["member_global_id"], r["risk"], r["_bad"]) for r in frame.orderBy("_seq").collect()] == [
        ("a", "", 2, "created_on"), ("a", "m", 2, "created_on"), ("a", None, 2, "created_on")
    ]
