"""Small builders for decoded events and feed files."""

import datetime as dt
import json

DDL = (
    "message_type string, operation string, operation_type string, event_type_version string, tenancy_id string, "
    "service_instance_id string, event_timestamp timestamp, raw string, _step long, _seq long"
)


def decoded(spark, *events):
    """Events as (type, raw) or (type, raw, operation) or (type, raw, operation, version)."""
    rows = []
    for at, (kind, raw, *rest) in enumerate(events):
        operation = rest[0] if rest else "CREATE"
        version = rest[1] if len(rest) > 1 else "1.0"
        text = raw if isinstance(raw, str) else json.dumps(raw)
        rows.append((kind, operation, operation, version, "T", "S", dt.datetime(2025, 1, 1), text, 1, at))
    return spark.createDataFrame(rows, DDL)


def header(kind, operation="CREATE", time="2025-01-01T00:00:00Z", **more):
    return {
        "messageType": kind,
        "operation": operation,
        "eventTime": time,
        "eventTypeVersion": "1.0",
        "tenancyId": "T",
        "serviceInstanceId": "S",
        **more,
    }


def lines(head, *data):
    return "\n".join([json.dumps({"headers": head}), *[json.dumps(d) for d in data]])
