"""One flattening query per entity: table rows become raw JSON events, events become rows.

Every event is built from one table row, so the feed grows with the table and
no nested list grows with a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, ENTITIES, Entity
from grantlake.operators.flatten import flatten
from grantlake.plans.registry import feed, json_of, plain_time, query, spread_table, table, text


def _objects(*items: Column) -> Column:
    return F.array(*items)


def _object(**fields: Column | str) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


@query(
    "flatten_role",
    """select cast(l_orderkey as varchar) as id, case when l_returnflag = 'N' then '' else cast(b as varchar) end as access_bundle_id,
              l_linestatus as status, 'w' || l_suppkey as approval_workflow_id, epoch_ms(l_shipdate) as created_on,
              case when l_tax > 0.04 then 'True' else 'False' end as ag_managed, l_shipdate as event_timestamp, 'CREATE' as operation_type
       from lineitem, unnest(case when l_returnflag = 'N' then [0] else [l_partkey, l_suppkey] end) as u(b)""",
)
def flatten_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-15, PRJ-0: a row per bundle; a role without bundles keeps one row."""
    lines = spread_table(spark, sf_dir, "lineitem")
    bundles = F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(
        F.array(text("l_partkey"), text("l_suppkey"))
    )
    raw = json_of(
        id=text("l_orderkey"),
        accessBundleIds=bundles,
        status="l_linestatus",
        approvalWorkflow=_object(id=F.concat(F.lit("w"), text("l_suppkey"))),
        createdOn=F.unix_millis(F.col("l_shipdate").cast("timestamp")),
        agManaged=F.col("l_tax") > 0.04,
    )
    rows = flatten(feed(lines, "ROLE", raw, "l_shipdate", "l_linenumber"), "ROLE")
    return rows.select(
        "id",
        "access_bundle_id",
        "status",
        "approval_workflow_id",
        "created_on",
        "ag_managed",
        "operation_type",
        plain_time("event_timestamp").alias("event_timestamp"),
    )


@query(
    "flatten_policy",
    """select cast(o_orderkey as varchar) as id, o_orderpriority as name,
              case when o_orderstatus = 'O' then '' else o_orderkey || '-' || r end as policy_rule_id,
              case when o_orderstatus = 'O' then '' else 'RULE ' || r end as policy_rule_statement,
              case when o_orderstatus = 'O' then null else cast(epoch_ms(o_orderdate) as varchar) end as policy_rule_created_on,
              o_custkey % 7 as ag_risk, 'c' || o_custkey as created_by_value
       from orders, unnest(case when o_orderstatus = 'O' then ['x'] else ['a', 'b'] end) as u(r)""",
)
def flatten_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12: a row per policy rule."""
    orders = spread_table(spark, sf_dir, "orders")

    def rule(mark: str) -> Column:
        return _object(
            id=F.concat(text("o_orderkey"), F.lit(f"-{mark}")),
            ruleStatement=F.lit(f"RULE {mark}"),
            createdOn=F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        )

    raw = json_of(
        id=text("o_orderkey"),
        name="o_orderpriority",
        policyRules=F.when(F.col("o_orderstatus") != "O", _objects(rule("a"), rule("b"))),
        agRisk=_object(value=F.col("o_custkey") % 7),
        createdByRef=_object(value=F.concat(F.lit("c"), text("o_custkey"))),
    )
    rows = flatten(feed(orders, "POLICY", raw, "o_orderdate", "o_orderkey"), "POLICY")
    return rows.select(
        "id",
        "name",
        "policy_rule_id",
        "policy_rule_statement",
        text("policy_rule_created_on").alias("policy_rule_created_on"),
        "ag_risk",
        "created_by_value",
    )


@query(
    "flatten_resource_mapping",
    """select cast(l_orderkey as varchar) as id, 'st' || l_linenumber as policy_statement_id,
              case when l_returnflag = 'N' then '' else r || k end as resource_id,
              case when l_returnflag = 'N' then '' else 'x' || k end as resource_external_id, 'e' || l_orderkey as policy_external_id
       from lineitem, unnest(case when l_returnflag = 'N' then [{'r': '', 'k': 0}]
                                  else [{'r': 'p', 'k': l_partkey}, {'r': 's', 'k': l_suppkey}] end) as u(c),
            lateral (select c.r as r, c.k as k) as v""",
)
def flatten_resource_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-13: a row per mapped resource."""
    lines = spread_table(spark, sf_dir, "lineitem")

    def resource(mark: str, key: str) -> Column:
        return _object(id=F.concat(F.lit(mark), text(key)), externalId=F.concat(F.lit("x"), text(key)))

    resources = F.when(
        F.col("l_returnflag") != "N", _objects(resource("p", "l_partkey"), resource("s", "l_suppkey"))
    )
    raw = json_of(
        id=text("l_orderkey"),
        policyStatementId=F.concat(F.lit("st"), text("l_linenumber")),
        externalId=F.concat(F.lit("e"), text("l_orderkey")),
        resources=resources,
    )
    name = "POLICY_STATEMENT_RESOURCE_MAPPING"
    rows = flatten(feed(lines, name, raw, "l_shipdate", "l_linenumber"), name)
    return rows.select("id", "policy_statement_id", "resource_id", "resource_external_id", "policy_external_id")


@query(
    "flatten_collection",
    """with base as (select cast(l_orderkey as varchar) as id, l_returnflag, l_partkey, l_suppkey, l_linestatus from lineitem)
       select id, '' as member_operation_type, '' as member_global_id,
              case l_linestatus when 'O' then l_returnflag || ',' || l_linestatus else '[]' end as tags from base
       union all
       select id, 'add', 'm' || l_partkey, case l_linestatus when 'O' then l_returnflag || ',' || l_linestatus else '[]' end
       from base where l_returnflag <> 'R'
       union all
       select id, 'remove', 'm' || l_suppkey, case l_linestatus when 'O' then l_returnflag || ',' || l_linestatus else '[]' end
       from base where l_returnflag <> 'A'""",
)
def flatten_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4: the collection's own row, then a row per member that has an id."""
    lines = spread_table(spark, sf_dir, "lineitem")

    def member(key: str) -> Column:
        known = _object(globalIdentityId=F.concat(F.lit("m"), text(key)), membershipType=F.lit("DIRECT"))
        nameless = _object(globalIdentityId=F.lit(None).cast("string"), membershipType=F.lit("DIRECT"))
        return _object(members=_objects(known, nameless))

    raw = json_of(
        id=text("l_orderkey"),
        tags=F.when(F.col("l_linestatus") == "O", F.array("l_returnflag", "l_linestatus")).otherwise(
            F.array().cast("array<string>")
        ),
        add=F.when(F.col("l_returnflag") != "R", member("l_partkey")),
        remove=F.when(F.col("l_returnflag") != "A", member("l_suppkey")),
    )
    name = "GLOBAL_IDENTITY_COLLECTION"
    rows = flatten(feed(lines, name, raw, "l_shipdate", "l_linenumber"), name)
    return rows.select("id", "member_operation_type", "member_global_id", "tags")


@query(
    "flatten_group",
    """with base as (select 'group.' || l_linestatus || '.' || l_orderkey as id, l_linestatus, l_returnflag, l_partkey, l_suppkey from lineitem)
       select id, l_linestatus as group_membership_type, 'add' as identity_operation_type, 'i' || l_partkey as identity_global_id,
              't' || l_partkey as identity_target_identity_id from base where l_returnflag <> 'R'
       union all
       select id, l_linestatus, 'remove', 'i' || l_suppkey, 't' || l_suppkey from base where l_returnflag = 'A'
       union all
       select id, l_linestatus, '', '', '' from base where l_returnflag = 'R'""",
)
def flatten_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2: added and removed identities, one base row if there are none."""
    lines = spread_table(spark, sf_dir, "lineitem")

    def identities(key: str) -> Column:
        return _object(
            identities=_objects(
                _object(id=F.concat(F.lit("i"), text(key)), targetIdentityId=F.concat(F.lit("t"), text(key)))
            )
        )

    raw = json_of(
        id=F.concat(F.lit("group."), F.col("l_linestatus"), F.lit("."), text("l_orderkey")),
        add=F.when(F.col("l_returnflag") != "R", identities("l_partkey")),
        remove=F.when(F.col("l_returnflag") == "A", identities("l_suppkey")),
    )
    rows = flatten(feed(lines, "CLOUD_GROUP", raw, "l_shipdate", "l_linenumber"), "CLOUD_GROUP")
    return rows.select(
        "id", "group_membership_type", "identity_operation_type", "identity_global_id", "identity_target_identity_id"
    )


@query(
    "flatten_identity",
    """with base as (select *, 'globalId.' || c_mktsegment || '.' || c_custkey as gid from customer where c_mktsegment <> 'FURNITURE')
       select gid as id, c_mktsegment as identity_type, c_name as display_name, c_nationkey as risk, 'F' || c_custkey as last_name,
              kind || c_custkey as ti_id, 'CREATE' as ti_operation_type, 'ACTIVE' as ti_identity_status,
              timestamp '2020-01-01 00:00:00' as ti_event_timestamp, kind = 'targetId.account.' as without_attributes
       from base, unnest(['targetId.account.', 'targetId.person.']) as u(kind) where c_acctbal >= 0 and c_mktsegment <> 'BUILDING'
       union all
       select gid, c_mktsegment, c_name, c_nationkey, 'F' || c_custkey, '',
              case when c_mktsegment = 'BUILDING' then '' else 'CREATE' end, '', null, false
       from base where c_acctbal < 0 or c_mktsegment = 'BUILDING'""",
)
def flatten_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: a row per target identity, else one; events without the root object yield none."""
    customers = spread_table(spark, sf_dir, "customer").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))

    def target(kind: str) -> Column:
        return _object(
            id=F.concat(F.lit(f"targetId.{kind}."), text("c_custkey")),
            identity=_object(status=F.lit("ACTIVE"), name=F.col("c_name")),
        )

    targets = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(
        F.when(F.col("c_acctbal") < 0, F.filter(_objects(target("account")), lambda _: F.lit(False))).otherwise(
            _objects(target("account"), target("person"))
        )
    )
    root = _object(
        id=F.concat(F.lit("globalId."), F.col("c_mktsegment"), F.lit("."), text("c_custkey")),
        identity=_object(
            displayName="c_name",
            agRisk=_object(value="c_nationkey"),
            name=_object(familyName=F.concat(F.lit("F"), text("c_custkey"))),
        ),
        targetIdentities=targets,
    )
    raw = json_of(globalIdentity=F.when(F.col("c_mktsegment") != "FURNITURE", root))
    rows = flatten(feed(customers, "IDENTITY", raw, "_at", "c_custkey"), "IDENTITY")
    return rows.select(
        "id",
        "identity_type",
        "display_name",
        "risk",
        "last_name",
        "ti_id",
        "ti_operation_type",
        "ti_identity_status",
        plain_time("ti_event_timestamp").alias("ti_event_timestamp"),
        (F.col("identity_attributes") == "{}").alias("without_attributes"),
    )


@query(
    "flatten_assignment_v1",
    """select 't' || l_orderkey as target_identity_id, 'add' as identity_operation_type,
              'a' || l_partkey as assignment_id, '' as permission_id,
              case when l_linenumber % 2 = 0 then null else cast(l_linenumber as varchar) end as valid_from, 'UPDATE' as operation_type
       from lineitem where l_returnflag <> 'R'
       union all
       select case when l_linestatus = 'O' then 's' || l_suppkey else 't' || l_orderkey end, 'remove', 'a' || l_suppkey, '', null, 'UPDATE'
       from lineitem where l_returnflag = 'A'
       union all
       select 't' || l_orderkey, '', '', p, null, 'DELETE'
       from lineitem, unnest(case when l_linenumber = 1 then [''] else ['p' || l_partkey, 'p' || l_suppkey] end) as u(p)
       where l_returnflag = 'R'""",
)
def flatten_assignment_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-9, PRJ-11: lists to add and remove, ids to delete; rows without an id are skipped."""
    lines = spread_table(spark, sf_dir, "lineitem")
    deleting = F.col("l_returnflag") == "R"

    def assignment(key: str, **more: Column) -> Column:
        return _object(id=F.concat(F.lit("a"), text(key)), **more)

    add = _objects(
        assignment("l_partkey", validFrom=F.when(F.col("l_linenumber") % 2 == 0, 0).otherwise(F.col("l_linenumber"))),
        _object(id=F.lit("").cast("string"), validFrom=F.lit(3)),
    )
    remove = _objects(
        assignment(
            "l_suppkey",
            targetIdentityId=F.when(F.col("l_linestatus") == "O", F.concat(F.lit("s"), text("l_suppkey"))).otherwise(""),
        )
    )
    ids = F.when(
        F.col("l_linenumber") != 1,
        F.array(F.concat(F.lit("p"), text("l_partkey")), F.concat(F.lit("p"), text("l_suppkey"))),
    )
    raw = json_of(
        targetIdentityId=F.concat(F.lit("t"), text("l_orderkey")),
        add=F.when(~deleting, add),
        remove=F.when(F.col("l_returnflag") == "A", remove),
        ids=F.when(deleting, ids),
    )
    name = "PERMISSION_ASSIGNMENT"
    decoded = feed(
        lines, name, raw, "l_shipdate", "l_linenumber", operation=F.when(deleting, "DELETE").otherwise("UPDATE")
    )
    return flatten(decoded, name).select(
        "target_identity_id",
        "identity_operation_type",
        "assignment_id",
        "permission_id",
        text("valid_from").alias("valid_from"),
        "operation_type",
    )


@query(
    "flatten_assignment_v2",
    """select cast(o_orderkey as varchar) || s as assignment_id, 'c' || o_custkey as target_identity_id,
              case when o_orderstatus = 'F' then 'remove' else 'add' end as identity_operation_type,
              cast(nullif(o_custkey % 5, 0) as varchar) as created_on, o_orderpriority as permission_name
       from orders, unnest(case when o_orderstatus = 'O' then ['a'] else ['a', 'b'] end) as u(s)""",
)
def flatten_assignment_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10: an assignment or a list of them; zero times count as missing."""
    orders = spread_table(spark, sf_dir, "orders")

    def assignment(mark: str) -> Column:
        return _object(
            id=F.concat(text("o_orderkey"), F.lit(mark)),
            targetIdentityId=F.concat(F.lit("c"), text("o_custkey")),
            created=F.col("o_custkey") % 5,
            permissionName="o_orderpriority",
        )

    raw = F.when(F.col("o_orderstatus") == "O", F.to_json(assignment("a"))).otherwise(
        F.to_json(_objects(assignment("a"), assignment("b")))
    )
    name = "PERMISSION_ASSIGNMENT"
    decoded = feed(
        orders,
        name,
        raw,
        "o_orderdate",
        "o_orderkey",
        operation=F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("CREATE"),
        version="2.0",
    )
    return flatten(decoded, name).select(
        "assignment_id",
        "target_identity_id",
        "identity_operation_type",
        text("created_on").alias("created_on"),
        "permission_name",
    )


@query(
    "flatten_bundle",
    """select cast(p_partkey as varchar) as id, p_name as name, p_type as access_bundle_type, p_size as expiration_time,
              '["' || p_brand || '"]' as permission_ids, 'w' || p_size as extension_approval_workflow_id,
              case when p_size > 25 then 'True' else 'False' end as account_profile_exists, 'oc' || p_size as ownership_collection_id
       from part""",
)
def flatten_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5: nested references, id lists as JSON."""
    raw = json_of(
        id=text("p_partkey"),
        name="p_name",
        accessBundleType="p_type",
        expirationTime="p_size",
        permissionIds=F.array("p_brand"),
        extensionApprovalWorkflow=_object(id=F.concat(F.lit("w"), text("p_size"))),
        isAccountProfileExists=F.col("p_size") > 25,
        ownerShipCollectionId=F.concat(F.lit("oc"), text("p_size")),
    )
    parts = spread_table(spark, sf_dir, "part").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    return flatten(feed(parts, "ACCESS_BUNDLE", raw, "_at", "p_partkey"), "ACCESS_BUNDLE").select(
        "id",
        "name",
        "access_bundle_type",
        "expiration_time",
        "permission_ids",
        "extension_approval_workflow_id",
        "account_profile_exists",
        "ownership_collection_id",
    )


@query(
    "flatten_permission",
    """select cast(p_partkey as varchar) as id, p_name as name, p_type as permission_type_id,
              '{"brand":"' || p_brand || '"}' as user_defined_tags, p_brand as owner_display_name, '{}' as attributes from part""",
)
def flatten_permission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8."""
    raw = json_of(
        id=text("p_partkey"),
        name="p_name",
        permissionTypeId="p_type",
        userDefinedTags=_object(brand="p_brand"),
        owner=_object(displayName="p_brand"),
    )
    parts = spread_table(spark, sf_dir, "part").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    return flatten(feed(parts, "PERMISSION", raw, "_at", "p_partkey"), "PERMISSION").select(
        "id", "name", "permission_type_id", "user_defined_tags", "owner_display_name", "attributes"
    )


@query(
    "flatten_resource",
    """select cast(p_partkey as varchar) as id, p_name as resource_name, p_type as resource_type,
              case when p_size > 25 then 'tenant' || p_size else 'T' end as tenancy_id from part""",
)
def flatten_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-14: the event's own tenant overrides the header's."""
    raw = json_of(
        id=text("p_partkey"),
        resourceName="p_name",
        resourceType="p_type",
        tenancyId=F.when(F.col("p_size") > 25, F.concat(F.lit("tenant"), text("p_size"))),
    )
    parts = spread_table(spark, sf_dir, "part").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    return flatten(feed(parts, "RESOURCE", raw, "_at", "p_partkey"), "RESOURCE").select(
        "id", "resource_name", "resource_type", "tenancy_id"
    )


@query(
    "flatten_guardrail",
    """select cast(s_suppkey as varchar) as id, s_name as name, s_nationkey as action_on_failure_revoke_after_number_of_days,
              case when s_acctbal > 0 then 'True' else 'False' end as action_on_failure_should_user_manager_be_notified,
              '[{"id":"' || s_suppkey || '"}]' as rules, s_name as updated_by_display_name from supplier""",
)
def flatten_guardrail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6: booleans as text, rules as JSON."""
    raw = json_of(
        id=text("s_suppkey"),
        name="s_name",
        actionOnFailure=_object(
            revokeLaterAfterNumberOfDays="s_nationkey", shouldUserManagerBeNotified=F.col("s_acctbal") > 0
        ),
        rules=F.array(_object(id=text("s_suppkey"))),
        updatedByRef=_object(displayName="s_name"),
    )
    suppliers = spread_table(spark, sf_dir, "supplier").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    return flatten(feed(suppliers, "ACCESS_GUARDRAIL", raw, "_at", "s_suppkey"), "ACCESS_GUARDRAIL").select(
        "id",
        "name",
        "action_on_failure_revoke_after_number_of_days",
        "action_on_failure_should_user_manager_be_notified",
        "rules",
        "updated_by_display_name",
    )


@query(
    "flatten_workflow",
    """select cast(o_orderkey as varchar) as id, o_orderpriority as name, o_custkey as version, o_orderstatus as status,
              epoch_ms(o_orderdate) as updated_on from orders""",
)
def flatten_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-7."""
    raw = json_of(
        id=text("o_orderkey"),
        name="o_orderpriority",
        version="o_custkey",
        status="o_orderstatus",
        updatedOn=F.unix_millis(F.col("o_orderdate").cast("timestamp")),
    )
    orders = spread_table(spark, sf_dir, "orders")
    return flatten(feed(orders, "APPROVAL_WORKFLOW", raw, "o_orderdate", "o_orderkey"), "APPROVAL_WORKFLOW").select(
        "id", "name", "version", "status", "updated_on"
    )


@query(
    "flatten_ownership",
    """select case when o_orderstatus = 'F' then 'd' || o_orderkey else 'c' || o_custkey end as id, o_orderpriority as resource_name,
              epoch_ms(o_orderdate) as created_on, case when o_orderstatus = 'F' then 'DELETE' else 'UPDATE' end as operation_type
       from orders""",
)
def flatten_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-16: deletes name the id field, other events the collection id."""
    raw = json_of(
        id=F.concat(F.lit("d"), text("o_orderkey")),
        ownershipCollectionId=F.concat(F.lit("c"), text("o_custkey")),
        usageName="o_orderpriority",
        timeCreated=F.unix_millis(F.col("o_orderdate").cast("timestamp")),
    )
    decoded = feed(
        spread_table(spark, sf_dir, "orders"),
        "OWNERSHIP_COLLECTION",
        raw,
        "o_orderdate",
        "o_orderkey",
        operation=F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("UPDATE"),
    )
    return flatten(decoded, "OWNERSHIP_COLLECTION").select("id", "resource_name", "created_on", "operation_type")


@query(
    "flatten_system",
    """select cast(s_suppkey as varchar) as id, s_name as name, s_nationkey as created_on, s_suppkey as updated_on, 'T' as tenancy_id
       from supplier""",
)
def flatten_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-17."""
    raw = json_of(id=text("s_suppkey"), name="s_name", timeCreated="s_nationkey", timeUpdated="s_suppkey")
    suppliers = spread_table(spark, sf_dir, "supplier").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    return flatten(feed(suppliers, "ORCHESTRATED_SYSTEM", raw, "_at", "s_suppkey"), "ORCHESTRATED_SYSTEM").select(
        "id", "name", "created_on", "updated_on", "tenancy_id"
    )


@query(
    "flatten_cloud_policy",
    """select case when o_orderstatus = 'F' then '' else cast(o_orderkey as varchar) end as id,
              case when o_orderstatus = 'F' then cast(o_orderkey as varchar) else 'st' || o_custkey end as policy_statement_id,
              'loc' || (o_custkey % 9) as location,
              case when o_orderstatus = 'O' then '' else s end as subject_id,
              case when o_custkey % 2 = 0 then 5 else 3 end as permissive_score, o_custkey as custom
       from orders, unnest(case when o_orderstatus = 'O' then ['x'] else ['u1', 'u2'] end) as u(s)""",
)
def flatten_cloud_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3, SCO-4: subjects exploded, score merged into the attributes."""
    orders = spread_table(spark, sf_dir, "orders")
    place = F.concat(F.lit("loc"), text(F.col("o_custkey") % 9))
    statement = F.when(F.col("o_custkey") % 2 == 0, "allow group g to manage key-family in tenancy").otherwise(
        "Allow  group g to manage buckets in compartment c"
    )
    common = {
        "id": text("o_orderkey"),
        "policyStatementId": F.concat(F.lit("st"), text("o_custkey")),
        "statement": statement,
        "customAttributes": _object(custom="o_custkey", permissive_score=F.lit(99)),
        "subjects": F.when(F.col("o_orderstatus") != "O", F.array(_object(id=F.lit("u1")), _object(id=F.lit("u2")))),
    }
    # The location is an object in some feeds and plain text in others.
    raw = F.when(
        F.col("o_orderstatus") == "P", json_of(**common, location=_object(compartment=place))
    ).otherwise(json_of(**common, location=place))
    decoded = feed(
        orders,
        "CLOUD_POLICY",
        raw,
        "o_orderdate",
        "o_orderkey",
        operation=F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("CREATE"),
    )
    return flatten(decoded, "CLOUD_POLICY").select(
        "id",
        "policy_statement_id",
        "location",
        "subject_id",
        F.get_json_object("attributes", "$.permissive_score").cast("int").alias("permissive_score"),
        F.get_json_object("attributes", "$.custom").cast("long").alias("custom"),
    )


_SENSITIVE = "turn % 3 = 0"


@query(
    "audit_masked",
    f"""select cast(conv_id as varchar) as request_id, turn as request_time, role as identity_host,
               case when {_SENSITIVE} then '["***"]' else text end as outer_value,
               case when turn % 2 = 0 then '["***"]' else role end as inner_value,
               '{{}}' as response_payload, 'audit' as source
        from conversations""",
)
def audit_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-18, MSK-1: audit events from conversations; values beside a sensitive selection are masked at any depth."""
    turns = spread_table(spark, sf_dir, "conversations").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    inner = _object(
        selection=F.when(F.col("turn") % 2 == 0, "Client SECRET").otherwise("title"), value="role"
    )
    payload = _object(
        selection=F.when(F.expr(_SENSITIVE), "new-Password").otherwise("plain"), value="text", items=F.array(inner)
    )
    raw = json_of(
        source=F.lit("audit"),
        identity=_object(host="role"),
        request=_object(id=text("conv_id"), requestTime="turn", payload=payload),
    )
    rows = flatten(feed(turns, "AUDIT_EVENTS", raw, "_at", "turn"), "AUDIT_EVENTS")
    return rows.select(
        "request_id",
        "request_time",
        "identity_host",
        F.get_json_object("request_payload", "$.value").alias("outer_value"),
        F.get_json_object("request_payload", "$.items[0].value").alias("inner_value"),
        "response_payload",
        "source",
    )


# What events with nothing but an id leave in the columns of every entity; columns that are not named take the default of their kind.
_BARE_DEFAULTS = {"text": "''", "json": "'{}'", "number": "null", "integer": "null", "time": "null"}
_BARE_HEADER = {
    "id": "'own'", "tenancy_id": "'T'", "service_instance_id": "'S'", "operation_type": "'CREATE'", "event_timestamp": "'2024-01-02 03:04:05'",
}
_BARE_OWN = {
    "CLOUD_POLICY": {"attributes": """'{"permissive_score":0,"reasons":[]}'"""},  # every statement is scored, also none
    "OWNERSHIP_COLLECTION": {"id": "''"},  # its id is that of the collection it names
}
_BARE_ENTITIES = [e for e in (*ENTITIES.values(), AUDIT) if e.name not in ("PERMISSION_ASSIGNMENT", "IDENTITY")]


def _bare_value(entity: Entity, column: str, kind: str) -> str:
    own = {**_BARE_HEADER, "event_object_type": f"'{entity.name}'", **_BARE_OWN.get(entity.name, {})}
    return own.get(column, _BARE_DEFAULTS[kind])


_BARE_SQL = " union all ".join(
    f"select '{e.name}' as entity, '{c.name}' as name, {_bare_value(e, c.name, c.kind)}::varchar as value" for e in _BARE_ENTITIES for c in e.columns
)


@query("flatten_every_column", f"with c as ({_BARE_SQL}) select entity, name, value, count(*) as n_rows from c, supplier group by 1, 2, 3")
def flatten_every_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-0: all columns of all entities but identities and assignments, for events that hold an id and nothing else."""
    suppliers = table(spark, sf_dir, "supplier").withColumn("_at", F.expr("timestamp_ntz'2024-01-02 03:04:05'"))
    out = None
    for entity in _BARE_ENTITIES:
        rows = flatten(feed(suppliers, entity.name, json_of(id=text("s_suppkey")), "_at", "s_suppkey"), entity.name)
        rows = rows.withColumn("id", F.when(F.col("id").try_cast("int") >= 0, "own").otherwise(F.col("id"))) if "id" in rows.columns else rows
        named = F.map_from_arrays(
            F.array(*[F.lit(c) for c in entity.column_names]), F.array(*[F.col(c).cast("string") for c in entity.column_names])
        )
        cells = rows.select(F.explode(named).alias("name", "value")).select(F.lit(entity.name).alias("entity"), "name", "value")
        out = cells if out is None else out.unionByName(cells)
    return out.groupBy("entity", "name", "value").agg(F.count("*").alias("n_rows"))
