"""Flattening of raw events to table rows, one projection per entity.

Most columns follow one rule: the JSON field is the camelCase form of the column
name. ``_PATHS`` states the exceptions, ``_FLAGS`` the fields that may be JSON
booleans, and ``_CHILDREN`` which nested list yields several rows. Missing text
becomes "", missing JSON becomes "{}", anything else NULL.

Input: the event frame of ``grantlake.sources``. Output: the entity's columns
plus ``_route`` (operation to apply), ``_step`` and ``_seq`` (arrival order) and
``_bad`` (names of the columns whose value did not fit the column type).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake import entities as ent
from grantlake.functions.masking import mask_payload
from grantlake.functions.scoring import score, with_score
from grantlake.sources.payload import elements, is_object

# JSON paths that do not follow the camelCase rule.
_REF = {
    f"{who}_{part}": f"{field}.{name}"
    for who, field in (("created_by", "createdByRef"), ("updated_by", "updatedByRef"), ("owner", "owner"))
    for part, name in (("display_name", "displayName"), ("value", "value"), ("resource_type", "resourceType"))
}
_WORKFLOW = {
    f"{prefix}_{part}": f"{field}.{part}"
    for prefix, field in (
        ("approval_workflow", "approvalWorkflow"),
        ("extension_approval_workflow", "extensionApprovalWorkflow"),
    )
    for part in ("id", "name", "description")
}
_COMMON = {
    "attributes": "customAttributes",
    "owner_uids": "ownerUIDs",
    **_REF,
    **_WORKFLOW,
}
_OWNERSHIP = {"ownership_collection_id": "ownerShipCollectionId"}
_PATHS = {
    "CLOUD_POLICY": {"resource_type": "resourceTypes"},
    "POLICY_STATEMENT_RESOURCE_MAPPING": {"policy_external_id": "externalId"},
    "GLOBAL_IDENTITY_COLLECTION": {"risk": "agRisk.value", **_OWNERSHIP},
    "ACCESS_BUNDLE": {
        "account_profile_exists": "isAccountProfileExists",
        "auto_approval_if_no_violation": "autoApproveIfNoViolation",
        **_OWNERSHIP,
    },
    "POLICY": {"ag_risk": "agRisk.value", **_OWNERSHIP},
    "ROLE": _OWNERSHIP,
    "ACCESS_GUARDRAIL": {
        "action_on_failure_action_type": "actionOnFailure.actionType",
        "action_on_failure_revoke_after_number_of_days": "actionOnFailure.revokeLaterAfterNumberOfDays",
        "action_on_failure_risk": "actionOnFailure.risk",
        "action_on_failure_should_user_manager_be_notified": "actionOnFailure.shouldUserManagerBeNotified",
        **_OWNERSHIP,
    },
    "OWNERSHIP_COLLECTION": {
        "resource_name": "usageName",
        "created_on": "timeCreated",
        "updated_on": "lastModified",
    },
    "ORCHESTRATED_SYSTEM": {"created_on": "timeCreated", "updated_on": "timeUpdated"},
    "PERMISSION_ASSIGNMENT": {
        "assignment_id": "id",
        "grant_type": "granttype",
        "created_on": "created",
        "updated_on": "lastModified",
        "assignment_attributes": "customAttributes",
    },
    "AUDIT_EVENTS": {
        "audit_event_type": "eventType",
        "audit_event_type_version": "eventTypeVersion",
        "identity_host": "identity.host",
        "identity_user_agent": "identity.userAgent",
        "identity_principal_id": "identity.principalId",
        "request_time": "request.requestTime",
        "response_time": "response.responseTime",
        **{f"request_{p}": f"request.{p}" for p in ("id", "path", "action", "parameters", "headers", "payload")},
        **{f"response_{p}": f"response.{p}" for p in ("status", "headers", "payload")},
    },
}

# Text columns whose field may be a JSON boolean, written as True or False.
_FLAGS = {
    "ag_managed",
    "is_transformed_policy",
    "account_profile_exists",
    "auto_approval_if_no_violation",
    "action_on_failure_should_user_manager_be_notified",
    "is_detective_violation_check_enabled",
}


def camel_case(column: str) -> str:
    head, *rest = column.split("_")
    return head + "".join(word.capitalize() for word in rest)


# -- values ------------------------------------------------------------------------


def _variant_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _key_text(value: Column) -> Column:
    """Text of a field that routes deletes: an explicit null stays NULL, a missing field is empty."""
    return F.when(F.is_variant_null(value), F.lit(None)).otherwise(F.coalesce(_variant_text(value), F.lit("")))


def _flag_text(value: Column) -> Column:
    text = F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(_variant_text(value))).otherwise(
        _variant_text(value)
    )
    return F.coalesce(text, F.lit(""))


def _json_text(value: Column) -> Column:
    return F.coalesce(F.to_json(value), F.lit("{}"))


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _number(value: Column, kind: str) -> Column:
    """A whole number, 5.0 being 5; with a fraction (to six places) it doesn't fit and the row is rejected, never cut.

    The value stands here once, as each further mention would double in every later projection.
    """
    whole = F.regexp_extract(value.try_cast("decimal(38,6)").cast("string"), r"^(-?\d+)\.0+$", 1).try_cast("bigint")
    return whole.try_cast("int") if kind == ent.INTEGER else whole


# -- input schema ------------------------------------------------------------------


class _Fields:
    """Collects the fields a projection reads and builds the input schema from them."""

    def __init__(self) -> None:
        self._tree: dict = {}

    def add(self, path: str, leaf: str) -> None:
        *parents, name = path.split(".")
        node = self._tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[name] = leaf

    def ddl(self) -> str:
        return self._struct(self._tree, top=True)

    def _struct(self, node: dict, top: bool = False) -> str:
        sep = " " if top else ": "
        parts = [f"`{n}`{sep}{v if isinstance(v, str) else self._struct(v)}" for n, v in node.items()]
        return ", ".join(parts) if top else f"struct<{', '.join(parts)}>"


def _leaf(column: ent.Column, keys: tuple[str, ...]) -> str:
    if column.kind == ent.JSON or column.name in _FLAGS or column.name in keys:
        return "variant"
    return "string"


def _value(column: ent.Column, field: Column, keys: tuple[str, ...]) -> Column:
    if column.kind == ent.JSON:
        return _json_text(field)
    if column.kind in (ent.NUMBER, ent.INTEGER):
        return _number(field, column.kind)
    if column.name in _FLAGS:
        return _flag_text(field)
    if column.name in keys:
        return _key_text(field)
    return _text(field)


def _routing_columns(entity: ent.Entity) -> tuple[str, ...]:
    return tuple(r.when_set for r in entity.routes if r.when_set) + (("ti_id",) if entity.name == "IDENTITY" else ())


# -- children ----------------------------------------------------------------------


@dataclass(frozen=True)
class _Children:
    """How one event becomes several rows.

    ``lists`` are the paths of the nested lists with the label their rows get,
    ``columns`` maps output columns to fields of the list's objects, ``scalar`` is the
    column of lists of plain values, ``needs`` a field without which a child is
    skipped, and ``base_row`` adds the event itself as a row beside its children.
    """

    lists: dict[str, str | None]
    columns: dict[str, str]
    base_row: bool = False
    label: str | None = None
    scalar: str | None = None
    needs: str | None = None


def _labelled(array: Column, label: str | None, element: str = "string") -> Column:
    """The list as (label, child) pairs; a missing list is empty."""
    items = F.coalesce(array, F.array().cast(f"array<{element}>"))
    return F.transform(items, lambda item: F.struct(F.lit(label).cast("string").alias("label"), item.alias("child")))


_CHILDREN = {
    "ROLE": _Children({"accessBundleIds": None}, {}, scalar="access_bundle_id"),
    "CLOUD_GROUP": _Children(
        {"add.identities": "add", "remove.identities": "remove"},
        {
            "identity_global_id": "id",
            "identity_target_identity_id": "targetIdentityId",
            "identity_external_id": "externalId",
        },
        label="identity_operation_type",
    ),
    "CLOUD_POLICY": _Children(
        {"subjects": None}, {"subject_id": "id", "subject_name": "name", "subject_type": "type"}
    ),
    "POLICY_STATEMENT_RESOURCE_MAPPING": _Children(
        {"resources": None}, {"resource_id": "id", "resource_external_id": "externalId"}
    ),
    "GLOBAL_IDENTITY_COLLECTION": _Children(
        {"add.members": "add", "remove.members": "remove"},
        {"member_global_id": "globalIdentityId", "membership_type": "membershipType"},
        base_row=True,
        label="member_operation_type",
        needs="globalIdentityId",
    ),
    "POLICY": _Children(
        {"policyRules": None},
        {
            "policy_rule_id": "id",
            "policy_rule_version": "policyRuleVersion",
            "policy_rule_action": "ruleAction",
            "policy_rule_statement": "ruleStatement",
            "policy_rule_status": "ruleStatus",
            "policy_rule_type": "ruleType",
            **{
                f"policy_rule_{c}": camel_case(c)
                for c in (
                    "assignment_id",
                    "identity_group_id",
                    "parsed_on",
                    "created_by",
                    "created_on",
                    "updated_by",
                    "updated_on",
                )
            },
        },
    ),
}


def _explode(
    df: DataFrame,
    children: Column | None = None,
    element: str = "string",
    base_row: bool = False,
    usable: Column | None = None,
    kept: list[Column | str] | None = None,
) -> DataFrame:
    """One row per child, and exactly one for an event without any; broken or unusable events yield none.

    Broken events are told apart through the exploded array rather than by a filter
    on the parsed event, because Spark would push that filter below the projection
    and parse every event twice. With ``kept``, these columns alone go along with the children; the parsed event stays behind.
    """
    none = F.struct(F.lit(None).cast("string").alias("label"), F.lit(None).cast(element).alias("child"))
    base = F.array(none)
    if children is None:
        rows = base
    else:
        rows = F.concat(base, children) if base_row else F.when(F.size(children) > 0, children).otherwise(base)
    whole = F.when(_whole() if usable is None else _whole() & usable, rows)
    if kept is not None:
        df, whole = df.select(*kept, whole.alias("_children")), F.col("_children")
    return (
        df.select(*(c for c in df.columns if c != "_children"), F.posexplode_outer(whole).alias("_child_pos", "_child"))
        .filter(F.col("_child").isNotNull())
        .withColumns({"_label": F.col("_child.label"), "_item": F.col("_child.child")})
    )


def _whole() -> Column:
    # A field of an unexpected type also marks the record; only text that is no JSON is broken.
    readable = F.when(F.col("e._corrupt").isNull(), True).otherwise(F.try_parse_json("_text").isNotNull())
    return is_object(F.col("_text")) & readable


# -- assembly ----------------------------------------------------------------------


def _parse(events: DataFrame, ddl: str, source: str = "raw") -> DataFrame:
    """Parse the JSON text into ``e``; ``_explode`` leaves out what is no JSON object."""
    parsed = F.from_json(source, f"{ddl}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return events.withColumns({"_text": F.col(source), "e": parsed})


def is_malformed(raw: str = "raw") -> Column:
    """Whether the event is left out of the projections because its text is not a JSON object."""
    # try_parse_json turns broken text into NULL.
    return ~F.coalesce(F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT"), F.lit(False))


def _header_values(tenancy: Column | None = None) -> dict[str, Column]:
    header_tenancy = _text(F.col("tenancy_id"))
    return {
        "tenancy_id": header_tenancy if tenancy is None else F.coalesce(tenancy, header_tenancy),
        "service_instance_id": _text(F.col("service_instance_id")),
        "event_timestamp": F.col("event_timestamp"),
        "event_object_type": F.col("message_type"),
        "operation_type": F.col("operation_type"),
    }


def _assemble(df: DataFrame, entity: ent.Entity, values: dict[str, Column], sources: dict[str, Column]) -> DataFrame:
    """Project to the table's columns, with defaults for whatever has no value."""
    defaults = {ent.TEXT: F.lit(""), ent.JSON: F.lit("{}")}
    out = [
        values.get(c.name, defaults.get(c.kind, F.lit(None))).cast(c.spark_type).alias(c.name) for c in entity.columns
    ]
    bad = [
        F.when((_text(sources[c.name]) != "") & values[c.name].isNull(), F.lit(c.name))
        for c in entity.columns
        if c.kind in (ent.NUMBER, ent.INTEGER) and c.name in sources
    ]
    seq = F.struct(F.col("_seq").alias("event"), F.col("_child_pos").alias("child"))
    return df.select(
        *out,
        F.col("operation").alias("_route"),
        "_step",
        seq.alias("_seq"),
        (F.concat_ws(",", *bad) if bad else F.lit("")).alias("_bad"),
    )


def _flatten_generic(events: DataFrame, entity: ent.Entity) -> DataFrame:
    keys = _routing_columns(entity)
    children = _CHILDREN.get(entity.name)
    child_columns = children.columns if children else {}
    special = {"event_object_type", "operation_type", "event_timestamp", "service_instance_id"}
    paths = {**_COMMON, **_PATHS.get(entity.name, {})}
    fields = _Fields()
    own: dict[str, str] = {}
    for column in entity.columns:
        if column.name in special or column.name in child_columns:
            continue
        if column.name == "tenancy_id" and entity.name != "RESOURCE":
            continue
        if children and column.name in (children.label, children.scalar):
            continue
        if column.name in ("identity_type", "group_membership_type"):
            continue
        own[column.name] = paths.get(column.name, camel_case(column.name))
        fields.add(own[column.name], _leaf(column, keys))
    element = "string"
    if child_columns:
        child_fields = _Fields()
        for name, path in child_columns.items():
            child_fields.add(path, _leaf(entity.column(name), keys))
        element = f"struct<{child_fields.ddl()}>"
    for path in children.lists if children else ():
        fields.add(path, f"array<{element}>")
    for path, leaf in _EXTRA_FIELDS.get(entity.name, {}).items():
        fields.add(path, leaf)

    df = _parse(events, fields.ddl())
    sources = {name: F.col("e." + path) for name, path in own.items()}
    values = {name: _value(entity.column(name), field, keys) for name, field in sources.items()}
    values.update(_header_values(F.col("e.tenancyId") if entity.name == "RESOURCE" else None))

    adjust = _ADJUST.get(entity.name)
    if adjust:
        df = adjust(df, values)
    if not children:
        return _assemble(_explode(df), entity, values, sources)

    # What belongs to the event is worked out once, before its children get a row each.
    lists = []
    for path, label in children.lists.items():
        items = F.col("e." + path)
        if children.needs:
            items = F.filter(items, lambda child: child[children.needs].isNotNull())
        lists.append(_labelled(items, label, element))
    ahead = {f"_v_{name}": value for name, value in values.items()}
    ahead |= {f"_s_{name}": field for name, field in sources.items()}
    passed = [c for c in events.columns if c != "raw"]
    kept = [*passed, *(value.alias(name) for name, value in ahead.items())]
    df = _explode(df, F.concat(*lists) if len(lists) > 1 else lists[0], element, children.base_row, kept=kept)
    values = {name: F.col(f"_v_{name}") for name in values}
    sources = {name: F.col(f"_s_{name}") for name in sources}
    child_sources = {name: F.col("_item." + path) for name, path in child_columns.items()}
    sources.update(child_sources)
    values.update({n: _value(entity.column(n), f, keys) for n, f in child_sources.items()})
    if children.label:
        values[children.label] = _text(F.col("_label"))
    if children.scalar:
        values[children.scalar] = _text(F.col("_item"))
    return _assemble(df, entity, values, sources)


# -- entity rules ------------------------------------------------------------------

_EXTRA_FIELDS = {
    "GLOBAL_IDENTITY_COLLECTION": {"tags": "variant"},
    "OWNERSHIP_COLLECTION": {"ownershipCollectionId": "string"},
    "CLOUD_POLICY": {"location": "variant"},
}


def _second_part(text: Column) -> Column:
    return F.get(F.split(text, r"\."), F.lit(1))


def _cloud_group(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    values["group_membership_type"] = _text(_second_part(F.col("e.id")))
    return df


def _cloud_policy(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    deleting = F.col("operation") == "DELETE"
    statement_id = values["policy_statement_id"]
    values["policy_statement_id"] = F.when(deleting, values["id"]).otherwise(statement_id)
    values["id"] = F.when(deleting, F.lit("")).otherwise(values["id"])
    location = F.col("e.location")
    values["location"] = _text(
        F.coalesce(
            F.try_variant_get(location, "$.compartment", "string"),
            F.when(F.schema_of_variant(location) == "STRING", _variant_text(location)),
        )
    )
    scored = score(df.withColumn("_statement", F.col("e.statement")), "_statement")
    values["attributes"] = with_score(values["attributes"], F.col("permissive_score"), F.col("reasons"))
    return scored


def _collection(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    tags = F.col("e.tags")
    words = F.from_json(F.to_json(tags), "array<string>")
    values["tags"] = F.coalesce(
        F.when(F.schema_of_variant(tags).startswith("ARRAY") & (F.size(words) > 0), F.array_join(words, ",")),
        F.to_json(tags),
        F.lit(""),
    )
    # The two spellings differ only in case, so they cannot be fields of one struct.
    other = F.when(
        F.col("raw").contains('"ownerUids"'), F.to_json(F.from_json("raw", "ownerUids variant").ownerUids)
    )
    values["owner_uids"] = F.coalesce(F.to_json("e.ownerUIDs"), other, F.lit("{}"))
    return df


def _ownership(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    values["id"] = _text(
        F.when(F.col("operation") == "DELETE", F.col("e.id")).otherwise(F.col("e.ownershipCollectionId"))
    )
    return df


def _audit(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    for column in ("request_payload", "response_payload"):
        values[column] = mask_payload(values[column])
    return df


_ADJUST = {
    "CLOUD_GROUP": _cloud_group,
    "CLOUD_POLICY": _cloud_policy,
    "GLOBAL_IDENTITY_COLLECTION": _collection,
    "OWNERSHIP_COLLECTION": _ownership,
    "AUDIT_EVENTS": _audit,
}


_TARGET = "struct<externalId: string, id: variant, targetId: string, identity: variant>"


def _flatten_identity(events: DataFrame, entity: ent.Entity) -> DataFrame:
    """One row per target identity, or one for the identity itself; events without the root are dropped."""
    parsed = _parse(
        events, f"globalIdentity struct<id: variant, identity: variant, targetIdentities: array<{_TARGET}>>"
    )
    top = parsed.withColumns(
        {"g": F.col("e.globalIdentity"), "_identity_json": F.to_json("e.globalIdentity.identity")}
    )
    identity = F.col("g.identity")

    def part(path: str, kind: str = "string", of: Column = identity) -> Column:
        return F.try_variant_get(of, f"$.{path}", kind)

    # A risk without a value makes the event unusable.
    usable = F.col("g").isNotNull() & (
        part("agRisk", "variant").isNull() | part("agRisk.value", "variant").isNotNull()
    )
    df = _explode(top, _labelled(F.col("g.targetIdentities"), None, _TARGET), _TARGET, usable=usable)
    has_target = F.col("_item").isNotNull()
    target_account = F.coalesce(_variant_text(F.col("_item.id")).startswith("targetId.account"), F.lit(False))
    global_id = _key_text(F.col("g.id"))
    sources = {"risk": part("agRisk.value")}
    values = {
        **_header_values(),
        "id": global_id,
        "identity_type": _text(_second_part(global_id)),
        **{
            column: _text(part(path))
            for column, path in (
                ("ag_status", "agStatus"),
                ("ag_sub_type", "agSubType"),
                ("display_name", "displayName"),
                ("location", "location"),
                ("status", "status"),
                ("username", "userName"),
                ("last_name", "name.familyName"),
                ("first_name", "name.givenName"),
            )
        },
        "risk": _number(sources["risk"], ent.NUMBER),
        "ag_risk_attributes": _json_text(part("agRisk.customAttributes", "variant")),
        "identity_attributes": F.when(target_account, F.lit("{}")).otherwise(
            F.coalesce(F.col("_identity_json"), F.lit("{}"))
        ),
        "ti_operation_type": F.when(F.col("g.targetIdentities").isNotNull(), F.col("operation")).otherwise(""),
        "ti_event_timestamp": F.when(has_target, F.col("event_timestamp")),
        "ti_external_id": _text(F.col("_item.externalId")),
        "ti_id": F.when(has_target, _key_text(F.col("_item.id"))).otherwise(""),
        "ti_target_id": _text(F.col("_item.targetId")),
        "ti_attributes": _json_text(F.col("_item.identity")),
        "ti_identity_status": _text(part("status", of=F.col("_item.identity"))),
        "ti_identity_name": _text(F.to_json(part("name", "variant", of=F.col("_item.identity")))),
    }
    return _assemble(df, entity, values, sources)


# Assignment columns that take the child's value as it is.
_ASSIGNMENT_PLAIN = (
    "external_id target_id target_type grant_type permission_type permission_name access_bundle_id "
    "access_bundle_name role_id role_name identity_group_id identity_group_name resource_id "
    "resource_display_name policy_id policy_name policy_rule_id user_login status account_status"
).split()


def _flatten_assignment(events: DataFrame, entity: ent.Entity, history: bool) -> DataFrame:
    """Assignments of both payload versions.

    Version 1 carries lists to add and to remove, or the ids to delete; version 2
    carries the assignments themselves. State rows need an id, history rows do not.
    """
    v1 = F.col("event_type_version") == "1.0"
    deleting = F.col("operation") == "DELETE"
    # A payload element may itself be a list, which is taken apart once more.
    opened = events.select("*", F.posexplode(elements(F.col("raw"))).alias("_inner_pos", "_one"))
    parent_ddl = """targetIdentityId string, globalIdentityId string, additionalProperties variant,
        ids array<string>, add array<string>, remove array<string>"""
    df = _parse(opened, parent_ddl, source="_one")

    ids = _labelled(F.col("e.ids"), "id")
    v1_rows = F.when(deleting, ids).otherwise(
        F.concat(_labelled(F.col("e.add"), "add"), _labelled(F.col("e.remove"), "remove"))
    )
    v2_rows = F.array(
        F.struct(F.when(deleting, F.lit("remove")).otherwise("add").alias("label"), F.col("_one").alias("child"))
    )
    df = _explode(df, F.when(v1, v1_rows).otherwise(v2_rows))
    # Only a delete without ids stands for itself.
    df = df.filter(F.col("_item").isNotNull() | (v1 & deleting))

    paths = {c: _PATHS[entity.name].get(c, camel_case(c)) for c in _ASSIGNMENT_PLAIN}
    child = _Fields()
    for path in paths.values():
        child.add(path, "string")
    for path in ("targetIdentityId", "globalIdentityId", "validFrom", "validTo", "created", "lastModified"):
        child.add(path, "string")
    for path in ("id", "permissionId", "customAttributes", "additionalProperties"):
        child.add(path, "variant")
    is_assignment = F.coalesce(F.col("_label").isin("add", "remove"), F.lit(False))
    df = df.withColumn("c", F.when(is_assignment, F.from_json("_item", child.ddl())))
    # Rows that are no object are skipped; state rows also need an id.
    usable = is_object(F.col("_item"))
    if not history:
        usable = usable & (F.coalesce(_variant_text(F.col("c.id")), F.lit("")) != "")
    df = df.filter(~is_assignment | F.coalesce(usable, F.lit(False)))

    def stamp(field: str, only_v2: bool = False) -> Column:
        value = F.nullif(F.col(f"c.{field}"), F.lit("0"))
        return F.when(~v1, value) if only_v2 else value

    def inherited(field: str) -> Column:
        parent = F.when(v1, F.col(f"e.{field}"))
        return _text(F.coalesce(F.nullif(F.col(f"c.{field}"), F.lit("")), parent))

    sources = {
        "valid_from": stamp("validFrom"),
        "valid_to": stamp("validTo"),
        "created_on": stamp("created", only_v2=True),
        "updated_on": stamp("lastModified", only_v2=True),
    }
    values = {
        **_header_values(),
        **{name: _text(F.col("c." + path)) for name, path in paths.items()},
        **{name: _number(value, ent.NUMBER) for name, value in sources.items()},
        "target_identity_id": inherited("targetIdentityId"),
        "global_identity_id": inherited("globalIdentityId"),
        "identity_operation_type": F.when(is_assignment, F.col("_label")).otherwise(""),
        "assignment_id": F.when(is_assignment, _key_text(F.col("c.id"))).otherwise(""),
        "permission_id": F.when(F.col("_label") == "id", F.col("_item")).otherwise(
            F.when(is_assignment, _key_text(F.col("c.permissionId"))).otherwise("")
        ),
        "assignment_attributes": F.coalesce(
            F.to_json("c.additionalProperties"),
            F.to_json("c.customAttributes"),
            F.when(v1, F.to_json("e.additionalProperties")),
            F.lit("{}"),
        ),
    }
    ordered = df.withColumn("_seq", F.struct("_seq", "_inner_pos"))
    return _assemble(ordered, entity, values, sources)


def flatten(events: DataFrame, name: str, history: bool = False) -> DataFrame:
    """Rows of entity ``name`` from the events of that type; other events are ignored.

    ``history`` keeps what only the append-only tables accept (assignments without an id).
    """
    entity = ent.entity(name)
    mine = events.filter(F.col("message_type") == name)
    if name == "IDENTITY":
        return _flatten_identity(mine, entity)
    if name == "PERMISSION_ASSIGNMENT":
        return _flatten_assignment(mine, entity, history)
    return _flatten_generic(mine, entity)
