"""Permissiveness score of access-policy statements, as column expressions.

``decompose`` splits a statement into its parts, ``score`` adds the 0-5 score
with its reasons, ``remediation`` the advice text. Each stage is one projection,
so a table of statements is scored in a single pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Python's notion of white space is Unicode's plus the four separator controls.
_SPACE = r"(?U)[\s\x1c-\x1f]+"

_STATEMENT = r"(?iu)^(allow|admit|endorse)\s+(.*?)\s+to\s+(.+)$"
_VERB = r"(?iu)^(manage|use|read|inspect)\s+(.*)$"

# The reason texts.
REASON_BASE = 'High score from action/resource/scope (action=%s,resource="%s", scope="%s")'
REASON_ANY_TENANCY = "Any-user/group of any-tenancy"
REASON_ANY_ACTIONS = "Any-user/group with service-defined actions"
REASON_ANY_USER = "Any-user subject"
REASON_DYNAMIC_GROUP = "Dynamic group with broad resource and manage verb"
REASON_ORG_ANY = "%s of any-user/any-tenancy"
REASON_ORG_CROSS = "%s cross-tenancy trust"
REASON_BROAD = "Broad or negative match in conditions"
REASON_RESTRICTIVE = "Restrictive conditions present"
REASON_UNKNOWN_ACTION = "Nonstandard action phrase (outside braces)"

# The condition texts that count as broad, as one pattern.
BROAD_CONDITIONS = r"!=| any \{| regex|\*|request\.principal\.type"

# Subject classes in the order they are tried, with the pattern that tells them.
SUBJECT_TYPES = (
    ("any-user", "^any-user| any-user"),
    ("any-group", "^any-group| any-group"),
    ("group", """^['"]?group| group """),
    ("dynamic-group", "^dynamic-group| dynamic-group "),
    ("service", "^service"),
    ("resource-principal", "^resource"),
)

# The advice texts. %s is the name of the platform whose policy reference applies.
ADVICE_SUBJECT = (
    "Replace any-user/any-group with specific group; "
    "add networkSource or tag conditions; scope to specific compartments"
)
ADVICE_MANAGE_ALL = "Replace manage all-resources with least-privilege resource types; scope to compartments"
ADVICE_SERVICE = "Constrain service principal to compartments and minimal verbs (read/inspect)"
ADVICE_CROSS = "Review cross-tenancy trust; restrict actions/resources; enforce conditions; document business need"
ADVICE_BROAD = "Avoid wildcards/negative matches; enumerate explicit resources/operations"
ADVICE_UNKNOWN = "Verify action against %s policy reference; use standard verbs or service-defined actions in braces"
ADVICE_DEFAULT = "Review for least privilege and proper scoping"


def normalized(statement: Column) -> Column:
    """White space collapsed to single blanks; NULL reads as empty."""
    return F.trim(F.regexp_replace(F.coalesce(statement, F.lit("")), _SPACE, " "))


# The text is normalised before it is taken apart, so no part has blanks at its ends.


def _before(text: Column, pattern: str) -> Column:
    return F.get(F.split(text, pattern, 2), F.lit(0))


def _after(text: Column, pattern: str) -> Column:
    return F.coalesce(F.get(F.split(text, pattern, 2), F.lit(1)), F.lit(""))


def subject_type(lowered: Column) -> Column:
    """First class whose pattern is found in the lower-case subject."""
    classes = F.when(F.lit(False), "")
    for name, pattern in SUBJECT_TYPES:
        classes = classes.when(lowered.rlike(pattern), name)
    return classes.otherwise("unknown")


def decompose(df: DataFrame, statement: str = "statement") -> DataFrame:
    """Add the parts of the statement; unreadable ones get ``parsed`` false and empty parts."""
    norm = df.withColumn("_norm", normalized(F.col(statement)))
    heads = norm.withColumns(
        {
            "relation": F.lower(F.regexp_extract("_norm", _STATEMENT, 1)),
            "subject": F.regexp_extract("_norm", _STATEMENT, 2),
            "_tail": F.regexp_extract("_norm", _STATEMENT, 3),
        }
    ).withColumn("parsed", F.col("relation") != "")
    split = heads.withColumns(
        {"_subject": F.lower("subject"), "_action": _before(F.col("_tail"), r"(?iu)\s+in\s+"), "_rest": _after(F.col("_tail"), r"(?iu)\s+in\s+")}
    )
    braces = F.col("_action").startswith("{")
    inside = F.regexp_extract("_action", r"^\{([^}]*)", 1)
    names = F.filter(F.split(inside, r"[\s,]+"), lambda a: a != "")
    verb = F.lower(F.regexp_extract("_action", _VERB, 1))
    return split.withColumns(
        {
            "subject_type": subject_type(F.col("_subject")),
            "cross_tenancy": F.col("subject").rlike(r"(?iuU)\bof\s+(any-)?tenancy\b"),
            "actions_in_braces": F.when(braces, F.array_join(names, ";")).otherwise(""),
            "verb": F.when(~F.col("parsed"), "")
            .when(braces, "service-defined-actions")
            .when(verb != "", verb)
            .otherwise("unknown"),
            "resource": F.when(braces, "")
            .when(verb != "", F.regexp_extract("_action", _VERB, 2))
            .otherwise(F.col("_action")),
            "scope": _before(F.col("_rest"), r"(?iu)\s+where\s+"),
            "conditions": _after(F.col("_rest"), r"(?iu)\s+where\s+"),
        }
    ).drop("_norm", "_tail", "_action", "_rest", "_subject")


def _scored(df: DataFrame) -> DataFrame:
    resource, subject = F.col("resource"), F.lower("subject")
    breadth = F.when(resource.rlike("(?iu)all-resources"), 2).when(resource.rlike("(?iu)-family"), 1).otherwise(0)
    scope = F.when(F.col("scope").rlike(r"(?iuU)\btenancy\b"), 2).otherwise(0)
    action = F.when(F.col("verb") == "use", 2).when(F.col("verb") == "manage", 3).otherwise(0)
    facts = df.withColumns(
        {
            "_breadth": breadth,
            "_scope": scope,
            "_base": F.least(F.lit(5), action + breadth + scope),
            "_any": F.col("subject_type").isin("any-user", "any-group"),
            "_any_tenancy": subject.contains("any-tenancy"),
            "_org": F.col("relation").isin("admit", "endorse"),
            "_broad": F.lower("conditions").rlike(BROAD_CONDITIONS),
        }
    )
    # Subject, then relation, then conditions: each step starts from the score before it.
    dynamic = (
        (F.col("subject_type") == "dynamic-group")
        & ((F.col("_breadth") > 0) | (F.col("_scope") > 0))
        & (F.col("verb") == "manage")
    )
    any_five = F.col("_any") & (F.col("_any_tenancy") | (F.col("verb") == "service-defined-actions"))
    by_subject = facts.withColumns(
        {
            "_dynamic": dynamic,
            "_s1": F.when(any_five | dynamic, 5)
            .when(F.col("_any"), F.greatest("_base", F.lit(4)))
            .otherwise(F.col("_base")),
        }
    )
    org_any = F.col("_org") & ((F.col("subject_type") == "any-user") | F.col("_any_tenancy"))
    by_relation = by_subject.withColumns(
        {
            "_org_any": org_any,
            "_s2": F.when(org_any, 5)
            .when(
                F.col("_org") & F.col("cross_tenancy"),
                F.least(F.greatest("_s1", F.lit(3)) + 1, F.lit(5)),
            )
            .otherwise(F.col("_s1")),
        }
    )
    by_conditions = (
        F.when(F.col("_broad"), F.least(F.col("_s2") + 1, F.lit(5)))
        .when(F.col("conditions") != "", F.greatest(F.col("_s2") - 1, F.lit(1)))
        .otherwise(F.col("_s2"))
    )
    return by_relation.withColumn("permissive_score", F.when(F.col("parsed"), by_conditions).otherwise(0))


def _reasons() -> Column:
    title = F.initcap("relation")
    return F.concat_ws(
        "; ",
        F.when(F.col("_base") >= 4, F.format_string(REASON_BASE, "verb", "resource", "scope")),
        F.when(F.col("_any") & F.col("_any_tenancy"), REASON_ANY_TENANCY)
        .when(F.col("_any") & (F.col("verb") == "service-defined-actions"), REASON_ANY_ACTIONS)
        .when(F.col("_any"), REASON_ANY_USER)
        .when(F.col("_dynamic"), REASON_DYNAMIC_GROUP),
        F.when(F.col("_org_any"), F.format_string(REASON_ORG_ANY, title)).when(
            F.col("_org") & F.col("cross_tenancy"), F.format_string(REASON_ORG_CROSS, title)
        ),
        F.when(F.col("_broad"), REASON_BROAD).when(F.col("conditions") != "", REASON_RESTRICTIVE),
        F.when(F.col("verb") == "unknown", REASON_UNKNOWN_ACTION),
    )


def score(df: DataFrame, statement: str = "statement") -> DataFrame:
    """Add the parts, ``permissive_score`` and ``reasons`` (NULL when the statement is unreadable)."""
    scored = _scored(decompose(df, statement)).withColumn("reasons", F.when(F.col("parsed"), _reasons()))
    return scored.drop(
        "_breadth", "_scope", "_base", "_any", "_any_tenancy", "_org", "_broad", "_dynamic", "_s1", "_org_any", "_s2"
    )


def with_score(attributes: Column, permissive_score: Column, reasons: Column) -> Column:
    """The attributes object with the score merged in; anything but an object counts as empty.

    An unreadable statement has no reasons, which is written as an empty list.
    """
    kept = F.map_filter(
        F.coalesce(
            F.when(F.ltrim(attributes).startswith("{"), F.from_json(attributes, "map<string, variant>")),
            F.expr("cast(map() as map<string, variant>)"),
        ),
        lambda name, _: ~name.isin("permissive_score", "reasons"),
    )
    reason_json = F.when(reasons.isNull(), F.parse_json(F.lit("[]"))).otherwise(reasons.cast("variant"))
    added = F.create_map(
        F.lit("permissive_score"), permissive_score.cast("variant"), F.lit("reasons"), reason_json
    )
    return F.to_json(F.map_concat(kept, added))


def remediation(platform: str = "platform") -> Column:
    """Advice for a scored row, parts joined by `` | ``."""
    reasons = F.coalesce(F.col("reasons"), F.lit(""))
    lowered = F.lower(reasons)
    parts = F.concat_ws(
        " | ",
        F.when(F.col("subject_type").isin("any-user", "any-group"), ADVICE_SUBJECT),
        F.when(
            lowered.contains("manage all-resources")
            | ((F.col("verb") == "manage") & F.lower("resource").contains("all-resources")),
            ADVICE_MANAGE_ALL,
        ),
        F.when(reasons.contains("Service principal manage all-resources"), ADVICE_SERVICE),
        F.when(lowered.contains("cross-tenancy") | F.col("relation").isin("admit", "endorse"), ADVICE_CROSS),
        F.when(reasons.contains("Broad or negative match"), ADVICE_BROAD),
        F.when(F.col("verb") == "unknown", ADVICE_UNKNOWN % platform),
    )
    return F.when(parts == "", ADVICE_DEFAULT).otherwise(parts)
