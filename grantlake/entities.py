"""The fifteen governed entities and the audit log, as configuration.

Everything entity-specific that is not a projection rule lives here: the
columns of the output table, the key of the state table, which delete key
applies to which delete event, and which column labels membership changes.
Operators and jobs read this table, so adding an entity means adding a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, NUMBER, INTEGER, JSON, TIME = "text", "number", "integer", "json", "time"

# Every state key and every delete key also carries the scope.
SCOPE = ("service_instance_id", "tenancy_id")

_SPARK_TYPE = {
    TEXT: T.StringType(),
    JSON: T.StringType(),
    NUMBER: T.LongType(),
    INTEGER: T.IntegerType(),
    TIME: T.TimestampType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    max_bytes: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPE[self.kind]


@dataclass(frozen=True)
class DeleteRoute:
    """A delete key; the event takes the first route whose ``when_set`` column is set.

    ``null_is_set`` tells how an explicit JSON null in ``when_set`` routes: as a
    value (which then matches no row) or as an absent one (next route).
    """

    keys: tuple[str, ...]
    when_set: str | None = None
    null_is_set: bool = True


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    routes: tuple[DeleteRoute, ...] = ()
    label: str | None = None
    newer_only_delete: bool = False
    required: tuple[str, ...] = ()
    versions: tuple[str, ...] = ("1.0",)

    @property
    def state_key(self) -> tuple[str, ...]:
        return self.key + SCOPE

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


# The columns of each table, in table order. A bare name is text of
# up to 4000 bytes; "/n" is a number, "/i" an integer, "/j" JSON text, "/t" a
# timestamp and "/256" text of up to 256 bytes. {tail} is the closing block.
_TAIL = "event_object_type operation_type event_timestamp/t attributes/j"
_COLUMNS = {
    "IDENTITY": """
        id ag_status ag_sub_type display_name location risk/n ag_risk_attributes/j status
        username last_name first_name identity_attributes/j ti_external_id ti_id ti_target_id
        ti_domain_id ti_identity_name ti_identity_status ti_operation_type ti_event_timestamp/t
        ti_attributes/j identity_type event_object_type operation_type event_timestamp/t
        tenancy_id service_instance_id""",
    "CLOUD_GROUP": f"""
        id external_id target_id compartment_id name domain_id identity_operation_type
        identity_external_id identity_global_id identity_target_identity_id
        group_membership_type {_TAIL} tenancy_id service_instance_id""",
    "CLOUD_POLICY": f"""
        id compartment_id description external_id location name policy_statement_id
        resource_type statement subject_id subject_name subject_type target_id verb
        {_TAIL} tenancy_id service_instance_id""",
    "RESOURCE": f"""
        id description external_id resource_name resource_type target_id tenancy_id
        {_TAIL} service_instance_id""",
    "POLICY_STATEMENT_RESOURCE_MAPPING": f"""
        id compartment_id policy_external_id policy_statement_id resource_id
        resource_external_id target_id {_TAIL} tenancy_id service_instance_id""",
    "GLOBAL_IDENTITY_COLLECTION": f"""
        id name display_name member_operation_type member_global_id membership_type
        external_id target_id identity_collection_description risk/n
        identity_collection_type is_managed_at_target status created_by
        created_by_display_name created_by_value created_by_resource_type created_on/n
        updated_by updated_by_display_name updated_by_value updated_by_resource_type
        updated_on/n ag_managed owner_display_name owner_value ownership_collection_id tags
        managed_by_ids/j owner_uids/j access_guardrail_ids/j
        {_TAIL} tenancy_id service_instance_id""",
    "ACCESS_BUNDLE": f"""
        id external_id name description display_name requestable_by status
        approval_workflow_id approval_workflow_name approval_workflow_description
        access_guardrail_ids/j target_id tags access_bundle_type permission_ids/j created_by
        created_by_display_name created_by_value created_by_resource_type created_on/n
        updated_by updated_by_display_name updated_by_value updated_by_resource_type
        updated_on/n ag_managed owner_display_name owner_value ownership_collection_id
        managed_by_ids/j owner_uids/j account_profile_exists account_profile_id
        account_profile_name auto_approval_if_no_violation access_limit_type
        expiration_time/n notification_time/n extension_time/n
        extension_approval_workflow_id extension_approval_workflow_name
        extension_approval_workflow_description {_TAIL} tenancy_id service_instance_id""",
    "PERMISSION": f"""
        id external_id name description display_name permission_type_id resource_id
        resource_name risk_level status target_id user_defined_tags/j owner_display_name
        owner_value {_TAIL} tenancy_id service_instance_id""",
    "PERMISSION_ASSIGNMENT": f"""
        target_identity_id global_identity_id identity_operation_type assignment_id
        external_id target_id target_type grant_type permission_type permission_id
        permission_name access_bundle_id access_bundle_name role_id role_name
        identity_group_id identity_group_name resource_id resource_display_name policy_id
        policy_name policy_rule_id user_login valid_from/n valid_to/n created_on/n
        updated_on/n status/256 account_status/256 assignment_attributes/j
        {_TAIL} tenancy_id service_instance_id""",
    "POLICY": f"""
        id name external_id description display_name status is_transformed_policy
        constraints tags policy_type policy_version target_id target_policy_id
        policy_rule_id policy_rule_assignment_id policy_rule_identity_group_id
        policy_rule_parsed_on/n policy_rule_version policy_rule_action
        policy_rule_statement policy_rule_status policy_rule_type policy_rule_created_by
        policy_rule_created_on/n policy_rule_updated_by policy_rule_updated_on/n created_by
        created_by_display_name created_by_resource_type created_by_value created_on/n
        updated_by updated_by_display_name updated_by_resource_type updated_by_value
        updated_on/n ag_risk/n ag_managed owner_display_name owner_value
        ownership_collection_id managed_by_ids/j owner_uids/j
        {_TAIL} tenancy_id service_instance_id""",
    "ROLE": f"""
        id external_id name description requestable_by status approval_workflow_id
        approval_workflow_name approval_workflow_description access_bundle_id created_by
        created_on/n updated_by updated_on/n ag_managed owner_display_name owner_value
        ownership_collection_id managed_by_ids/j owner_uids/j tags
        {_TAIL} tenancy_id service_instance_id""",
    "ACCESS_GUARDRAIL": f"""
        id external_id name description action_on_failure_action_type
        action_on_failure_revoke_after_number_of_days/i action_on_failure_risk
        action_on_failure_should_user_manager_be_notified created_by_display_name
        created_by_resource_type created_by_value created_on/n etag
        is_detective_violation_check_enabled lifecycle_state owner_display_name owner_value
        ownership_collection_id rules/j tags updated_by_display_name
        updated_by_resource_type updated_by_value updated_on/n
        {_TAIL} tenancy_id service_instance_id""",
    "APPROVAL_WORKFLOW": f"""
        id name description status created_by created_on/n updated_by updated_on/n
        version/n etag_version/n tags summary ownership_collection_id
        {_TAIL} tenancy_id service_instance_id""",
    "OWNERSHIP_COLLECTION": f"""
        id entity_id entity_name is_primary external_id resource_name created_on/n
        updated_on/n tenancy_id {_TAIL} service_instance_id""",
    "ORCHESTRATED_SYSTEM": f"""
        id external_id name type state schedule created_by updated_by created_on/n
        updated_on/n target_mode ownership_collection_id primary_owner tenancy_id
        {_TAIL} service_instance_id""",
    "AUDIT_EVENTS": f"""
        source audit_event_type audit_event_type_version content_type region
        availability_domain identity_host identity_user_agent identity_principal_id
        request_time/n request_id request_path request_action request_parameters/j
        request_headers/j request_payload/j response_time/n response_status
        response_headers/j response_payload/j state_change/j
        {_TAIL} tenancy_id service_instance_id""",
}

_KINDS = {"n": NUMBER, "i": INTEGER, "j": JSON, "t": TIME}


def _columns(text: str) -> tuple[Column, ...]:
    out = []
    for word in text.split():
        name, _, mark = word.partition("/")
        if mark in _KINDS:
            out.append(Column(name, _KINDS[mark]))
        else:
            out.append(Column(name, TEXT, int(mark) if mark else 4000))
    return tuple(out)


def _entity(name: str, key: tuple[str, ...], routes: tuple[DeleteRoute, ...] | None = None, **options) -> Entity:
    routes = (DeleteRoute(("id",)),) if routes is None else routes
    return Entity(name, _columns(_COLUMNS[name]), key, routes, **options)


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        _entity(
            "IDENTITY",
            ("id", "ti_id"),
            (DeleteRoute(("id",), when_set="id", null_is_set=False), DeleteRoute(("ti_id",))),
        ),
        _entity(
            "CLOUD_GROUP",
            ("id", "identity_global_id", "identity_target_identity_id", "target_id"),
            (DeleteRoute(("id", "identity_global_id"), when_set="identity_global_id"), DeleteRoute(("id",))),
            label="identity_operation_type",
        ),
        _entity(
            "CLOUD_POLICY",
            ("id", "policy_statement_id", "subject_id"),
            (DeleteRoute(("policy_statement_id",)),),
        ),
        _entity("RESOURCE", ("id",)),
        _entity(
            "POLICY_STATEMENT_RESOURCE_MAPPING",
            ("id", "policy_statement_id", "resource_id"),
            (DeleteRoute(("policy_statement_id", "resource_id")),),
        ),
        _entity(
            "GLOBAL_IDENTITY_COLLECTION",
            ("id", "member_global_id"),
            (DeleteRoute(("id", "member_global_id"), when_set="member_global_id"), DeleteRoute(("id",))),
            label="member_operation_type",
        ),
        _entity("ACCESS_BUNDLE", ("id",)),
        _entity("PERMISSION", ("id",)),
        _entity(
            "PERMISSION_ASSIGNMENT",
            ("assignment_id",),
            (
                DeleteRoute(("assignment_id",), when_set="assignment_id"),
                DeleteRoute(("target_identity_id", "permission_id"), when_set="permission_id"),
                DeleteRoute(("target_identity_id",)),
            ),
            label="identity_operation_type",
            newer_only_delete=True,
            required=("assignment_id",),
            versions=("1.0", "2.0"),
        ),
        _entity("POLICY", ("id", "policy_rule_id")),
        _entity("ROLE", ("id", "access_bundle_id")),
        _entity("ACCESS_GUARDRAIL", ("id",)),
        _entity("APPROVAL_WORKFLOW", ("id",)),
        _entity("OWNERSHIP_COLLECTION", ("id", "entity_id")),
        _entity("ORCHESTRATED_SYSTEM", ("id",)),
    )
}

AUDIT = Entity("AUDIT_EVENTS", _columns(_COLUMNS["AUDIT_EVENTS"]))

STATE_TYPES = tuple(ENTITIES)
OPERATIONS = ("CREATE", "UPDATE", "DELETE")


def entity(name: str) -> Entity:
    if name == AUDIT.name:
        return AUDIT
    if name not in ENTITIES:
        raise ValueError(f"Unknown entity {name!r}; known: {', '.join([*ENTITIES, AUDIT.name])}")
    return ENTITIES[name]
