"""A plain sequential model of the state tables, as the oracle for the set-oriented plans.

Events are applied one by one: group after group, inside a group the removes first.
"""

from collections import defaultdict

from grantlake.entities import SCOPE


def _key(row, names):
    return tuple(row[n] or None for n in names)


def _upsert(state, row, key_names):
    key = _key(row, key_names)
    held = state.get(key)
    if held is None:
        state[key] = row
    elif held["event_timestamp"] is not None and row["event_timestamp"] is not None:
        if held["event_timestamp"] < row["event_timestamp"]:
            state[key] = row


def _delete(state, event, names, newer_only):
    wanted = _key(event, names)
    if None in wanted:
        return
    for key, row in list(state.items()):
        if _key(row, names) != wanted:
            continue
        if newer_only:
            if row["event_timestamp"] is None or event["event_timestamp"] is None:
                continue
            if not row["event_timestamp"] < event["event_timestamp"]:
                continue
        del state[key]


def _route(event, entity):
    for route in entity.routes:
        if route.when_set is None:
            return route
        value = event[route.when_set]
        if (route.null_is_set if value is None else value != ""):
            return route
    return None


def apply(state, changes, entity):
    """``state`` maps key to row; ``changes`` are dicts with _route, _step, _seq."""
    groups = defaultdict(list)
    for change in changes:
        groups[change["_step"]].append(change)
    for step in sorted(groups):
        events = sorted(groups[step], key=lambda e: e["_seq"])
        removal = lambda e: e["_route"] == "DELETE" or (entity.label and e[entity.label] == "remove")
        for event in filter(removal, events):
            route = _route(event, entity)
            if route:
                _delete(state, event, [*route.keys, *SCOPE], entity.newer_only_delete)
        for event in events:
            if not removal(event):
                _upsert(state, event, entity.state_key)
    return state
