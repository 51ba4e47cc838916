"""Policy statements scored over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.entities import ENTITIES
from grantlake.functions.scoring import remediation, score
from grantlake.operators.flatten import flatten
from grantlake.operators.state import apply_changes
from grantlake.plans.registry import feed, json_of, plain_time, query, spread_table, text
from grantlake.session import stage

# One statement per order, put together from its columns; readable by both engines.
STATEMENT_SQL = """
  case when o_orderkey % 11 = 0 then 'policy ' || o_orderkey || ' has no grammar' else
    case o_orderstatus when 'O' then 'allow' when 'F' then '  Allow ' else case when o_custkey % 2 = 0 then 'endorse' else 'ADMIT' end end
    || ' ' ||
    case o_orderpriority
      when '1-URGENT' then case when o_custkey % 3 = 0 then 'any-user  from any-tenancy' else 'any-user' end
      when '2-HIGH' then case when o_custkey % 3 = 0 then 'group admins of tenancy Acme' else 'group  admins' end
      when '3-MEDIUM' then 'dynamic-group builders'
      when '4-NOT SPECIFIED' then case when o_custkey % 3 = 0 then 'resource app' else 'service mailer' end
      else 'any-group' end
    || ' to ' ||
    case o_custkey % 6
      when 0 then 'manage all-resources'
      when 1 then 'USE key-family'
      when 2 then 'read buckets'
      when 3 then '{ KEY_READ, KEY_USE  KEY_LIST }'
      when 4 then 'frobnicate things'
      else 'manage  volume-family' end
    || case o_orderkey % 3 when 0 then ' in tenancy' when 1 then ' in compartment Dev' else '' end
    || case when o_orderkey % 3 = 2 then '' else
       case o_orderkey % 7
         when 0 then ' where request.user.id = ''x'''
         when 1 then ' WHERE target.id != ''y'''
         when 2 then ' where any { tag = ''*'' }'
         when 3 then ' where all { request.principal.type = ''w'' }'
         else '' end end
  end"""

_SCORED_SQL = f"""
  s0 as (select o_orderkey, trim(regexp_replace({STATEMENT_SQL}, '\\s+', ' ', 'g')) as norm from orders),
  s1 as (select *, regexp_extract(norm, '^(allow|admit|endorse)\\s+(.*?)\\s+to\\s+(.+)$', ['relation', 'subject', 'tail'], 'i') as m from s0),
  s2 as (select o_orderkey, lower(m.relation) as relation, trim(m.subject) as subject, trim(m.tail) as tail, m.relation <> '' as parsed from s1),
  s3 as (select *, case when regexp_matches(tail, '\\s+in\\s+', 'i') then regexp_extract(tail, '^(.*?)\\s+in\\s+(.*)$', 1, 'i') else tail end as action_text,
                   regexp_extract(tail, '^(.*?)\\s+in\\s+(.*)$', 2, 'i') as rest from s2),
  s4 as (select *, starts_with(action_text, '{{') as braces,
                   lower(regexp_extract(action_text, '^(manage|use|read|inspect)\\s+(.*)$', 1, 'i')) as v,
                   regexp_extract(action_text, '^(manage|use|read|inspect)\\s+(.*)$', 2, 'i') as r,
                   case when regexp_matches(rest, '\\s+where\\s+', 'i') then regexp_extract(rest, '^(.*?)\\s+where\\s+(.*)$', 1, 'i') else rest end as scope,
                   regexp_extract(rest, '^(.*?)\\s+where\\s+(.*)$', 2, 'i') as conditions,
                   lower(subject) as subj from s3),
  s5 as (select *,
           case when not parsed then '' when braces then 'service-defined-actions' when v <> '' then v else 'unknown' end as verb,
           case when braces then '' when v <> '' then r else action_text end as resource,
           case when subj like 'any-user%' or subj like '% any-user%' then 'any-user'
                when subj like 'any-group%' or subj like '% any-group%' then 'any-group'
                when subj like 'group%' or subj like '''group%' or subj like '"group%' or subj like '% group %' then 'group'
                when subj like 'dynamic-group%' or subj like '% dynamic-group %' then 'dynamic-group'
                when subj like 'service%' then 'service'
                when subj like 'resource%' then 'resource-principal' else 'unknown' end as subject_type,
           regexp_matches(subject, '\\bof\\s+(any-)?tenancy\\b', 'i') as cross_tenancy,
           case when braces then array_to_string([a for a in regexp_split_to_array(regexp_extract(action_text, '^\\{{([^}}]*)', 1), '[\\s,]+') if a <> ''], ';') else '' end as actions_in_braces
         from s4),
  s6 as (select *, lower(resource) like '%all-resources%' as every, lower(resource) like '%-family%' as family,
                   regexp_matches(lower(scope), '\\btenancy\\b') as tenancy,
                   subject_type in ('any-user', 'any-group') as anyone, subj like '%any-tenancy%' as any_tenancy,
                   relation in ('admit', 'endorse') as org,
                   lower(conditions) like '%!=%' or lower(conditions) like '% any {{%' or lower(conditions) like '% regex%'
                     or conditions like '%*%' or lower(conditions) like '%request.principal.type%' as broad from s5),
  s7 as (select *, least(5, case verb when 'use' then 2 when 'manage' then 3 else 0 end
                            + case when every then 2 when family then 1 else 0 end + case when tenancy then 2 else 0 end) as base from s6),
  s8 as (select *, case when anyone and (any_tenancy or verb = 'service-defined-actions') then 5
                        when anyone then greatest(base, 4)
                        when subject_type = 'dynamic-group' and (every or family or tenancy) and verb = 'manage' then 5
                        else base end as by_subject from s7),
  s9 as (select *, case when org and (subject_type = 'any-user' or any_tenancy) then 5
                        when org and cross_tenancy then least(greatest(by_subject, 3) + 1, 5) else by_subject end as by_org from s8),
  scored as (select *, case when not parsed then 0 when broad then least(by_org + 1, 5)
                            when conditions <> '' then greatest(by_org - 1, 1) else by_org end as permissive_score,
      case when parsed then concat_ws('; ',
        case when base >= 4 then 'High score from action/resource/scope (action=' || verb || ',resource="' || resource || '", scope="' || scope || '")' end,
        case when anyone and any_tenancy then 'Any-user/group of any-tenancy'
             when anyone and verb = 'service-defined-actions' then 'Any-user/group with service-defined actions'
             when anyone then 'Any-user subject'
             when subject_type = 'dynamic-group' and (every or family or tenancy) and verb = 'manage' then 'Dynamic group with broad resource and manage verb' end,
        case when org and (subject_type = 'any-user' or any_tenancy) then upper(relation[1]) || relation[2:] || ' of any-user/any-tenancy'
             when org and cross_tenancy then upper(relation[1]) || relation[2:] || ' cross-tenancy trust' end,
        case when broad then 'Broad or negative match in conditions' when conditions <> '' then 'Restrictive conditions present' end,
        case when verb = 'unknown' then 'Nonstandard action phrase (outside braces)' end) end as reasons
    from s9)"""


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(spark, sf_dir, "orders").select("o_orderkey", F.expr(STATEMENT_SQL).alias("statement"))


@query(
    "score_decompose",
    f"""with {_SCORED_SQL}
        select o_orderkey, parsed, relation, subject, subject_type, cross_tenancy, verb, resource, actions_in_braces,
               scope, conditions from scored""",
)
def score_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCO-1, SCO-2: statements taken apart."""
    return score(_statements(spark, sf_dir)).select(
        "o_orderkey",
        "parsed",
        "relation",
        "subject",
        "subject_type",
        "cross_tenancy",
        "verb",
        "resource",
        "actions_in_braces",
        "scope",
        "conditions",
    )


@query(
    "score_statements",
    f"with {_SCORED_SQL} select o_orderkey, permissive_score, reasons from scored",
)
def score_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCO-3, SCO-4: score and reasons."""
    return score(_statements(spark, sf_dir)).select("o_orderkey", "permissive_score", "reasons")


@query(
    "score_remediation",
    f"""with {_SCORED_SQL},
         advice as (select o_orderkey, concat_ws(' | ',
           case when anyone then 'Replace any-user/any-group with specific group; add networkSource or tag conditions; scope to specific compartments' end,
           case when lower(coalesce(reasons, '')) like '%manage all-resources%' or (verb = 'manage' and lower(resource) like '%all-resources%')
                then 'Replace manage all-resources with least-privilege resource types; scope to compartments' end,
           case when lower(coalesce(reasons, '')) like '%cross-tenancy%' or org
                then 'Review cross-tenancy trust; restrict actions/resources; enforce conditions; document business need' end,
           case when reasons like '%Broad or negative match%' then 'Avoid wildcards/negative matches; enumerate explicit resources/operations' end,
           case when verb = 'unknown' then 'Verify action against platform policy reference; use standard verbs or service-defined actions in braces' end) as a
         from scored)
        select o_orderkey, case when a = '' then 'Review for least privilege and proper scoping' else a end as remediation from advice""",
)
def score_remediation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCO-5: advice text."""
    return score(_statements(spark, sf_dir)).select("o_orderkey", remediation().alias("remediation"))


@query(
    "score_distribution",
    f"""with {_SCORED_SQL}
        select subject_type, permissive_score, count(*) as n_statements from scored group by subject_type, permissive_score""",
)
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCO-3 as a report: statements by subject and score."""
    scored = score(_statements(spark, sf_dir))
    return scored.groupBy("subject_type", "permissive_score").agg(F.count("*").alias("n_statements"))


@query(
    "policy_state_scored",
    f"""with {_SCORED_SQL},
         e as (select o.*, s.permissive_score from orders o join scored s using (o_orderkey)),
         dels as (select o_custkey, max(cast(o_orderdate as date)) as last_d from e where o_orderstatus = 'F' group by o_custkey),
         kept as (select e.*, row_number() over (partition by e.o_custkey order by o_orderdate desc, o_orderkey) as rn
                  from e left join dels using (o_custkey)
                  where o_orderstatus <> 'F' and (last_d is null or last_d <= cast(o_orderdate as date)))
        select 'p' || o_custkey as id, 'st' || o_custkey as policy_statement_id, permissive_score,
               cast(o_orderkey as varchar) as external_id, o_orderdate as event_timestamp from kept where rn = 1""",
)
def policy_state_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw policy events flattened, scored, and applied in daily groups to the current state."""
    entity = ENTITIES["CLOUD_POLICY"]
    orders = spread_table(spark, sf_dir, "orders").withColumn(
        "_group", F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long")
    )
    deleting = F.col("o_orderstatus") == "F"
    statement_id = F.concat(F.lit("st"), text("o_custkey"))
    raw = json_of(
        id=F.when(deleting, statement_id).otherwise(F.concat(F.lit("p"), text("o_custkey"))),
        policyStatementId=statement_id,
        externalId=text("o_orderkey"),
        statement=F.expr(STATEMENT_SQL),
    )
    decoded = feed(
        orders,
        entity.name,
        raw,
        "o_orderdate",
        "o_orderkey",
        operation=F.when(deleting, "DELETE").otherwise("UPDATE"),
        step=F.col("_group"),
    )
    changes = stage(flatten(decoded, entity.name), "changes")
    state = apply_changes(spark.createDataFrame([], entity.schema), changes, entity)
    return state.select(
        "id",
        "policy_statement_id",
        F.get_json_object("attributes", "$.permissive_score").cast("int").alias("permissive_score"),
        "external_id",
        plain_time("event_timestamp").alias("event_timestamp"),
    )
