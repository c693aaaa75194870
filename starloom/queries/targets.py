"""All 25 star-schema targets, built from source tables that are derived from the given ones.

A derivation is one SELECT that Spark and DuckDB both run; the target itself is built by
the library on one side and by a hand-written SELECT on the other. Source rows carry
faults on purpose: missing matches, NULL keys, empty texts, 0/1 and text booleans.
"""

from __future__ import annotations

from starloom.operators.load import conform
from starloom.operators.sets import DATABASE
from starloom.plans.build import build_target
from starloom.plans.spec import LOAD_TIME
from starloom.plans.targets import TARGETS
from starloom.queries.registry import query, table


def _ms(key: str) -> str:
    return f"1600000000000 + {key} * 1000"


DATES = f"{_ms('{key}')} AS created_date, {_ms('{key}')} + 500 AS updated_date"


def _dates(key: str) -> str:
    return DATES.format(key=key)


ORDER_DB = "'tenant_' || lower(o_orderstatus) AS _database"
FLAG = "CASE o_orderstatus WHEN 'F' THEN {no} WHEN 'O' THEN {yes} END"
LINE_POS = "l_partkey * 10000000000 + l_suppkey * 10000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT)"
LINE_ID = "l_orderkey * 100 + l_linenumber"
# Keys that leave most related rows without one, so that some main rows find no match.
URGENT, HIGH = (f"CASE WHEN o_orderpriority = '{p}' THEN o_custkey END" for p in ("1-URGENT", "2-HIGH"))

# Source table -> its SELECT over the given tables.
SOURCES = {
    "users": f"""SELECT c_custkey AS id, c_custkey AS user_id, c_nationkey AS organization_tsid, c_name AS first_name,
        c_mktsegment AS last_name, lower(c_name) AS email, CASE WHEN c_acctbal > 0 THEN 'active' ELSE '' END AS status,
        {_dates('c_custkey')} FROM customer""",
    "user_preferences": f"""SELECT {URGENT} AS user_id, o_orderkey AS _pos, {FLAG.format(no=0, yes=1)} AS is_2fa_enabled
        FROM orders""",
    "user_accounts": f"""SELECT {HIGH} AS user_id, o_orderkey AS id,
        o_orderkey AS _pos, o_custkey + 1000 AS account_id, {FLAG.format(no="'false'", yes="'True'")} AS account_owner,
        o_orderstatus AS status FROM orders""",
    "organizations": f"""SELECT s_suppkey AS tsid, 'org-' || s_suppkey AS uuid, s_name AS name,
        s_nationkey AS created_by_id, {_dates('s_suppkey')} FROM supplier""",
    "accounts": f"""SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS account_id,
        c_name AS name, {_dates('c_custkey')} FROM customer""",
    "authentication_modules": f"""SELECT {URGENT} AS account_id, o_orderkey AS _pos, o_orderpriority AS type, {FLAG.format(no=0, yes=2)} AS enabled FROM orders""",
    "smtp_configuration": f"""SELECT {HIGH} AS account_id, o_orderkey AS _pos, o_orderstatus AS type
        FROM orders""",
    "tenants": f"""SELECT c_custkey AS id, c_custkey AS tenant_id, c_custkey * 10 AS tsid, c_name AS company,
        '555-' || c_custkey AS phone, lower(c_name) AS email, {_dates('c_custkey')} FROM customer""",
    "subscriptions": f"""SELECT {URGENT} AS tenant_id, o_orderkey AS _pos, o_orderpriority AS plan,
        o_orderstatus AS status_enum, o_orderkey AS allowed_users, o_orderkey + 1 AS no_of_projects,
        '12' AS total_parallel_runs, {_ms('o_orderkey')} AS next_renewal_at FROM orders""",
    "billing_addresses": f"""SELECT {HIGH} AS tenant_id, o_orderkey AS _pos, o_orderstatus AS country,
        CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS state, 'city' || o_orderkey AS city,
        o_orderkey AS zip_code FROM orders""",
    "tenant_features": f"""SELECT l_suppkey AS tenant_id, {LINE_ID} AS id, 'f' || l_linenumber AS name,
        CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END AS is_add_on, {_dates('l_partkey')} FROM lineitem""",
    "data_generators": f"""SELECT p_partkey AS id, p_name AS name, p_brand AS display_name, p_type AS description,
        {_ms('p_partkey')} AS created_at_epoch, p_partkey AS updated_at_epoch FROM part""",
    "data_generator_files": """SELECT s_suppkey AS _pos, s_name AS class_package, 'class' || s_suppkey AS class_name,
        CASE WHEN s_acctbal < 0 THEN 'debt' END AS lib_type_enum FROM supplier""",
    "nlp_test_case_step_templates": f"""SELECT doc_id AS id, source AS display_name, text AS content, lang AS language,
        CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS is_active, 'false' AS deprecated,
        CASE WHEN n_chars > 1000 THEN '1' ELSE '0' END AS is_actionable, true AS api_supported, lang AS type,
        {_ms('doc_id')} AS created_at_epoch, {_ms('doc_id')} AS updated_at_epoch FROM documents""",
    "object_types": f"""SELECT p_partkey AS id, p_name AS object_display_name, p_brand AS object_class_name,
        p_type AS technology, p_brand AS package_name, {_ms('p_partkey')} AS created_at_epoch,
        {_ms('p_partkey')} AS updated_at__epoch FROM part""",
    "project": f"""SELECT 'tenant_' || p_size AS _database, p_partkey AS id, p_partkey * 10 AS tsid, p_name AS name,
        CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END AS description, p_size AS tenant_tsid,
        p_size AS created_by_id, {_dates('p_partkey')} FROM part""",
    "application": f"""SELECT 'tenant_' || p_size AS _database, p_partkey AS id, 'app-' || p_partkey AS tsid,
        p_name AS name, p_size AS tenant_tsid, p_type AS type_enum, p_size AS updated_by_id, {_dates('p_partkey')}
        FROM part""",
    "test_case": f"""SELECT {ORDER_DB}, o_orderkey AS id, o_custkey AS application_id, o_orderkey * 10 AS tsid,
        'case ' || o_orderkey AS name, o_custkey AS tenant_tsid, o_orderstatus AS status_enum,
        CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS is_manual, {_dates('o_orderkey')} FROM orders""",
    "test_case_priorities": f"""SELECT {ORDER_DB}, o_orderkey AS _pos, 'p' || o_orderkey AS name FROM orders""",
    "application_version": f"""SELECT {ORDER_DB}, o_orderkey AS _pos, {URGENT} AS application_id FROM orders""",
    "nlp_test_case_step": f"""SELECT 'tenant_' || lower(l_linestatus) AS _database, {LINE_ID} AS id,
        l_orderkey AS test_case_id, l_suppkey AS tenant_tsid, l_partkey AS created_by_id, l_linenumber AS template_id,
        l_returnflag AS teststep_key, 'act ' || l_linenumber AS action, {_dates('l_orderkey')} FROM lineitem""",
    "execution": f"""SELECT o_orderkey AS id, o_orderkey AS execution_id, o_orderkey * 10 AS tsid,
        o_custkey AS tenant_tsid, o_custkey AS created_by_id, o_orderpriority AS execution_type_enum,
        {_dates('o_orderkey')} FROM orders""",
    "execution_result": f"""SELECT CASE WHEN l_returnflag = 'A' THEN l_orderkey END AS execution_id, {LINE_POS} AS _pos, l_returnflag AS result_enum,
        {_ms('l_partkey')} AS start_time, {_ms('l_partkey')} + 250 AS end_time, l_linenumber AS duration,
        l_linestatus AS triggered_type, l_suppkey AS executed_by, {_dates('l_suppkey')} FROM lineitem""",
    "test_case_result": f"""SELECT 'tenant_' || lower(l_linestatus) AS _database, {LINE_ID} AS id,
        l_orderkey AS execution_result_id, l_partkey AS test_case_id, l_suppkey AS tenant_tsid,
        l_returnflag AS result_enum, {_ms('l_partkey')} AS start_time, l_linenumber AS duration,
        l_returnflag AS message, l_linenumber AS retry_count, CASE l_returnflag WHEN 'A' THEN '1' ELSE 'False' END AS is_flaky,
        {_dates('l_orderkey')} FROM lineitem""",
    "element_locators": f"""SELECT page_id AS id, 'el-' || page_id AS tsid, html AS value, page_id AS application_version_id,
        page_id AS tenant_tsid, url AS locator_type, {_dates('page_id')} FROM pages""",
    "test_data": f"""SELECT conv_id * 1000 + turn AS id, 'td-' || conv_id AS tsid, role AS test_data_name, text AS columns,
        turn AS version_id, conv_id AS tenant_tsid, {_dates('conv_id')} FROM conversations""",
    "agents": f"""SELECT event_id AS id, 'ag-' || event_id AS tsid, event_type AS unique_id, props AS browser_list,
        CASE WHEN event_type = 'error' THEN '' ELSE 'up' END AS status, user_id AS tenant_tsid,
        CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN '0' END AS is_active,
        {_ms('event_id')} AS last_pinged_at, {_dates('event_id')} FROM events""",
    "api_steps": f"""SELECT page_id AS id, page_id + 1 AS step_id, page_id AS tenant_tsid, 'GET' AS request_type, url,
        {_dates('page_id')} FROM pages""",
    "accessibility_page_metrics": f"""SELECT page_id AS id, page_id + 1 AS test_case_result_id, page_id AS tenant_tsid,
        'page' AS entity_type, 'open' AS status, url AS page_url, length(url) AS critical_issues_count,
        0 AS minor_issues_count, {_dates('page_id')} FROM pages""",
    "test_case_group": f"""SELECT 'tenant_' || CASE WHEN p_size > 25 THEN 'f' ELSE 'o' END AS _database, p_partkey AS id,
        p_partkey * 10 AS tsid, p_partkey AS application_id, p_name AS name, p_size AS tenant_tsid,
        p_type AS entity_type, {_dates('p_partkey')} FROM part""",
    "test_plan_result_metrics": f"""SELECT o_orderkey AS id, o_custkey AS tenant_tsid, o_orderkey + 7 AS test_plan_result_id,
        o_orderstatus AS result, o_orderpriority AS latest_result, o_custkey AS total_count, 1 AS failed_count,
        2 AS passed_count, o_custkey AS duration, {_dates('o_orderkey')} FROM orders""",
    "ai_agent_activity_log": f"""SELECT event_id AS id, user_id AS ai_agent_workflow_id, user_id AS tenant_tsid,
        event_type AS agent_type, props AS message, 'ok' AS status, {_ms('event_id')} AS start_time,
        {_dates('event_id')} FROM events""",
    "audit_history": f"""SELECT event_id AS id, 'au-' || event_id AS uuid, event_type AS entity_tag, user_id AS entity_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS organization_tsid, user_id AS actor_id,
        props AS new_entity_data, {_ms('event_id')} AS action_date, event_type AS entity_action,
        {_dates('event_id')} FROM events""",
}

GIVEN = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


def source_tables(spark, sf_dir, names):
    """The named source tables that exist, as Spark derives them."""
    frames = {}
    for name in names:
        if name in SOURCES:
            text = SOURCES[name]
            given = {g: table(spark, sf_dir, g) for g in GIVEN if f"FROM {g}" in text}
            for g in given:
                text = text.replace(f"FROM {g}", f"FROM {{{g}}}")
            frames[name] = spark.sql(text, **given)
    return frames


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({SOURCES[name]})" for name in names)


def _first(name: str, *keys: str) -> str:
    """A CTE with the first row of each key, or of all."""
    over = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER ({over}ORDER BY _pos) = 1)"


def _time(expression: str) -> str:
    return f"make_timestamp(({expression}) * 1000)"


def _null(*names: str, type: str = "VARCHAR") -> str:
    return ", ".join(f"CAST(NULL AS {type}) AS {name}" for name in names)


CREATED = f"{_time('m.created_date')} AS created_at, {_time('m.updated_date')} AS updated_at"


def _hit(match: str, fallback: str, column: str) -> str:
    return f"CASE WHEN {match}._pos IS NULL THEN {fallback}.{column} ELSE {match}.{column} END"


def target(name: str, sql: str) -> None:
    mapping = TARGETS[name]

    @query(f"target_{name}", sql)
    def build(spark, sf_dir):
        built = build_target(mapping, source_tables(spark, sf_dir, mapping.sources), stamped=False)
        typed = conform(built, mapping.schema).drop(LOAD_TIME)
        if DATABASE in built.columns:
            # The database stays beside the target's own columns.
            schema = mapping.schema.add(DATABASE, "string")
            typed = conform(built, schema).drop(LOAD_TIME)
        return typed


target(
    "dim_users",
    f"""{_with('users', 'user_preferences', 'user_accounts')}
    SELECT m.id AS user_id, CAST(m.organization_tsid AS BIGINT) AS organization_id, m.first_name, m.last_name, m.email,
           m.status, {_null('last_logged_in_at', type='TIMESTAMP')}, {CREATED},
           {_hit('p', 'pa', 'is_2fa_enabled')} = 1 AS is_2fa_enabled, {_hit('u', 'ua', 'id')} AS user_account_id,
           {_hit('u', 'ua', 'account_id')} AS account_id, {_hit('u', 'ua', 'account_owner')} = 'True' AS is_account_owner,
           {_hit('u', 'ua', 'status')} AS account_status
    FROM users m LEFT JOIN {_first('user_preferences', 'user_id')} p ON m.user_id IS NOT DISTINCT FROM p.user_id
         LEFT JOIN {_first('user_accounts', 'user_id')} u ON m.user_id IS NOT DISTINCT FROM u.user_id
         CROSS JOIN {_first('user_preferences')} pa CROSS JOIN {_first('user_accounts')} ua
    """,
)
target(
    "dim_organizations",
    f"""{_with('organizations')}
    SELECT tsid AS organization_id, uuid AS organization_uuid, name, CAST(created_by_id AS BIGINT) AS created_by_id,
           {_null('updated_by_id', type='BIGINT')}, {CREATED} FROM organizations m
    """,
)
target(
    "dim_accounts",
    f"""{_with('accounts', 'authentication_modules', 'smtp_configuration')}
    SELECT m.id AS account_id, m.name, {_hit('s', 'sa', 'type')} AS smtp_type,
           {_hit('u', 'ua', 'type')} AS auth_module_type, {_hit('u', 'ua', 'enabled')} <> 0 AS auth_enabled, {CREATED}
    FROM accounts m
         LEFT JOIN {_first('authentication_modules', 'account_id')} u ON m.account_id IS NOT DISTINCT FROM u.account_id
         LEFT JOIN {_first('smtp_configuration', 'account_id')} s ON m.account_id IS NOT DISTINCT FROM s.account_id
         CROSS JOIN {_first('authentication_modules')} ua CROSS JOIN {_first('smtp_configuration')} sa
    """,
)
target(
    "dim_tenants",
    f"""{_with('tenants', 'subscriptions', 'billing_addresses')}
    SELECT m.id AS tenant_id, m.tsid AS tenant_tsid, m.company AS name, {_hit('b', 'ba', 'country')} AS billing_country,
           {_hit('b', 'ba', 'state')} AS billing_state, {_hit('b', 'ba', 'city')} AS billing_city,
           CAST({_hit('b', 'ba', 'zip_code')} AS VARCHAR) AS billing_zip, m.phone AS billing_phone,
           m.email AS billing_email, {CREATED}, {_hit('s', 'sa', 'plan')} AS plan_type,
           {_hit('s', 'sa', 'status_enum')} AS subscription_status, {_hit('s', 'sa', 'allowed_users')} AS allowed_users,
           {_hit('s', 'sa', 'no_of_projects')} AS max_projects, CAST(12 AS BIGINT) AS total_parallel_runs,
           {_time(_hit('s', 'sa', 'next_renewal_at'))} AS next_renewal_at
    FROM tenants m LEFT JOIN {_first('subscriptions', 'tenant_id')} s ON m.tenant_id IS NOT DISTINCT FROM s.tenant_id
         LEFT JOIN {_first('billing_addresses', 'tenant_id')} b ON m.tenant_id IS NOT DISTINCT FROM b.tenant_id
         CROSS JOIN {_first('subscriptions')} sa CROSS JOIN {_first('billing_addresses')} ba
    """,
)
target(
    "brg_tenant_features",
    f"""{_with('tenant_features')}
    SELECT tenant_id, id AS feature_id, {CREATED}, id AS tenant_feature_id, name AS feature_name, is_add_on = 1 AS is_add_on
    FROM tenant_features m
    """,
)
target(
    "dim_features",
    f"""{_with('tenant_features')}
    SELECT id AS feature_id, name, is_add_on = 1 AS is_premium, tenant_id, {CREATED} FROM tenant_features m
    """,
)
target(
    "dim_data_generators",
    f"""{_with('data_generators', 'data_generator_files')}
    SELECT m.id AS generator_id, m.name, m.display_name, m.description, {_time('m.created_at_epoch')} AS created_at,
           {_null('updated_at', type='TIMESTAMP')}, f.class_package, f.class_name, f.lib_type_enum AS lib_type
    FROM data_generators m CROSS JOIN {_first('data_generator_files')} f
    """,
)
target(
    "dim_nlp_templates",
    f"""{_with('nlp_test_case_step_templates')}
    SELECT id AS template_id, display_name AS name, content, language, {_null('category')}, is_active = 1 AS is_active,
           {_time('created_at_epoch')} AS created_at, {_time('updated_at_epoch')} AS updated_at,
           {_null('keyword', 'application_type')}, false AS is_deprecated, is_actionable = '1' AS is_actionable,
           {_null('is_verifiable', type='BOOLEAN')}, type, api_supported FROM nlp_test_case_step_templates
    """,
)
target(
    "dim_object_types",
    f"""{_with('object_types')}
    SELECT id AS object_type_id, object_display_name AS name, object_display_name AS display_name,
           object_class_name AS class_name, technology, package_name, {_time('created_at_epoch')} AS created_at,
           {_time('updated_at__epoch')} AS updated_at FROM object_types
    """,
)
target(
    "dim_projects",
    f"""{_with('project')}
    SELECT _database, id AS project_id, tsid AS project_uuid, name, description, CAST(tenant_tsid AS BIGINT) AS tenant_id,
           CAST(created_by_id AS BIGINT) AS created_by_id, {_null('updated_by_id', type='BIGINT')}, {CREATED} FROM project m
    """,
)
target(
    "dim_applications",
    f"""{_with('application')}
    SELECT _database, id AS app_id, tsid AS app_uuid, name, {_null('description')}, CAST(tenant_tsid AS BIGINT) AS tenant_id,
           type_enum AS status, {_null('created_by_id', type='BIGINT')}, CAST(updated_by_id AS BIGINT) AS updated_by_id,
           {CREATED} FROM application m
    """,
)
target(
    "dim_test_cases",
    f"""{_with('test_case', 'test_case_priorities', 'application_version')}
    SELECT m._database, m.id AS test_case_id, m.tsid AS test_case_uuid, m.name, {_null('description')},
           {_hit('a', 'aa', 'application_id')} AS app_id, m.tenant_tsid AS tenant_id, m.status_enum AS status,
           p.name AS priority, {_null('created_by_id', 'updated_by_id', type='BIGINT')}, {CREATED}, {_null('creation_type')},
           m.is_manual = 1 AS is_manual, {_null('is_ai_generated', 'is_data_driven', 'is_step_group', type='BOOLEAN')}
    FROM test_case m
         LEFT JOIN {_first('application_version', '_database', 'application_id')} a
              ON m._database = a._database AND m.application_id IS NOT DISTINCT FROM a.application_id
         LEFT JOIN {_first('application_version', '_database')} aa ON m._database = aa._database
         LEFT JOIN {_first('test_case_priorities', '_database')} p ON m._database = p._database
    """,
)
target(
    "fct_test_steps",
    f"""{_with('nlp_test_case_step')}
    SELECT _database, id AS step_id, test_case_id, tenant_tsid AS tenant_id, created_by_id AS user_id,
           CAST(template_id AS BIGINT) AS step_order, teststep_key AS step_type, action AS step_data,
           {_null('expected_result')}, {CREATED}, {_null('element_id', type='BIGINT')} FROM nlp_test_case_step m
    """,
)


def _executions(spark, sf_dir):
    mapping = TARGETS["fct_executions"]
    sources = source_tables(spark, sf_dir, mapping.sources)
    sources["application_version"] = sources["application_version"].drop(DATABASE)
    return conform(build_target(mapping, sources, stamped=False), mapping.schema).drop(LOAD_TIME)


query(
    "target_fct_executions",
    f"""{_with('execution', 'execution_result', 'application_version')}
    SELECT m.id AS execution_id, m.tsid AS execution_uuid, m.tenant_tsid AS tenant_id, m.created_by_id AS user_id,
           v.application_id AS app_id, m.id AS test_suite_id, {_hit('r', 'ra', 'result_enum')} AS status,
           {_time(_hit('r', 'ra', 'start_time'))} AS start_time, {_time(_hit('r', 'ra', 'end_time'))} AS end_time,
           CAST({_hit('r', 'ra', 'duration')} AS BIGINT) AS duration_seconds,
           {_hit('r', 'ra', 'triggered_type')} AS triggered_by, {_hit('r', 'ra', 'triggered_type')} AS trigger_type,
           m.execution_type_enum AS environment_type, {CREATED}
    FROM execution m LEFT JOIN {_first('execution_result', 'execution_id')} r ON m.execution_id IS NOT DISTINCT FROM r.execution_id
         CROSS JOIN {_first('execution_result')} ra CROSS JOIN {_first('application_version')} v
    """,
)(_executions)

target(
    "fct_test_results",
    f"""{_with('test_case_result')}
    SELECT _database, id AS result_id, execution_result_id AS execution_id, test_case_id, tenant_tsid AS tenant_id,
           {_null('user_id', type='BIGINT')}, result_enum AS status, {_time('start_time')} AS start_time,
           {_null('end_time', type='TIMESTAMP')}, CAST(duration AS BIGINT) AS duration_seconds, message AS error_message,
           CAST(retry_count AS BIGINT) AS retry_count, is_flaky = '1' AS is_flaky, {CREATED} FROM test_case_result m
    """,
)
target(
    "dim_elements",
    f"""{_with('element_locators')}
    SELECT id AS element_id, tsid AS element_uuid, value AS locator, application_version_id AS app_id,
           tenant_tsid AS tenant_id, {_null('created_by_id', 'updated_by_id', type='BIGINT')}, {CREATED}, locator_type
    FROM element_locators m
    """,
)
target(
    "dim_test_data",
    f"""{_with('test_data')}
    SELECT id AS test_data_id, tsid AS test_data_uuid, test_data_name AS name, columns AS data_json, version_id AS app_id,
           tenant_tsid AS tenant_id, {_null('created_by_id', 'updated_by_id', type='BIGINT')}, {CREATED}, id AS data_id
    FROM test_data m
    """,
)
target(
    "dim_agents",
    f"""{_with('agents')}
    SELECT id AS agent_id, tsid AS agent_uuid, unique_id AS name, browser_list AS config_json, status,
           tenant_tsid AS tenant_id, {_null('created_by_id', 'updated_by_id', type='BIGINT')}, {CREATED}, {_null('version')},
           is_active = 'true' AS is_active, {_time('last_pinged_at')} AS last_pinged_at FROM agents m
    """,
)
target(
    "fct_api_steps",
    f"""{_with('api_steps')}
    SELECT id AS api_step_id, step_id AS test_step_id, tenant_tsid AS tenant_id, {_null('user_id', type='BIGINT')},
           request_type AS method, url, {_null('api_type', 'authentication_type', 'body_type')}, {CREATED} FROM api_steps m
    """,
)
target(
    "fct_accessibility_results",
    f"""{_with('accessibility_page_metrics')}
    SELECT id AS result_id, test_case_result_id AS test_case_id, {_null('execution_id', type='BIGINT')},
           tenant_tsid AS tenant_id, {_null('user_id', type='BIGINT')}, entity_type AS check_type, status,
           {_null('message')}, status AS severity, {CREATED}, page_url, critical_issues_count AS critical_issues,
           CAST(minor_issues_count AS BIGINT) AS minor_issues, {_null('serious_issues', 'moderate_issues', type='BIGINT')}
    FROM accessibility_page_metrics m
    """,
)
target(
    "dim_test_suites",
    f"""{_with('test_case_group', 'application_version')}
    SELECT m._database, m.id AS test_suite_id, m.tsid AS test_suite_uuid, m.name, {_null('description')},
           {_hit('a', 'aa', 'application_id')} AS app_id, CAST(m.tenant_tsid AS BIGINT) AS tenant_id,
           m.entity_type AS status, {_null('created_by_id', 'updated_by_id', type='BIGINT')}, {CREATED}, m.id AS suite_id
    FROM test_case_group m
         LEFT JOIN {_first('application_version', '_database', 'application_id')} a
              ON m._database = a._database AND m.application_id IS NOT DISTINCT FROM a.application_id
         LEFT JOIN {_first('application_version', '_database')} aa ON m._database = aa._database
    UNION ALL
    SELECT _database, {_null('a1', 'a2', type='BIGINT')}, {_null('a3', 'a4')}, application_id, NULL, NULL, NULL, NULL,
           NULL, NULL, NULL FROM application_version
    WHERE _database NOT IN (SELECT _database FROM test_case_group) AND application_id IS NOT NULL -- empty rows go
    """,
)
target(
    "fct_cross_tenant_metrics",
    f"""{_with('test_plan_result_metrics')}
    SELECT id AS metric_id, tenant_tsid AS tenant_id, test_plan_result_id, result, latest_result, total_count,
           CAST(failed_count AS BIGINT) AS failed_count, CAST(passed_count AS BIGINT) AS passed_count,
           {_null('stopped_count', 'not_executed_count', 'running_count', 'queued_count', type='BIGINT')}, duration,
           {_null('consolidated_duration', type='BIGINT')}, {CREATED} FROM test_plan_result_metrics m
    """,
)
target(
    "fct_test_plan_results",
    f"""{_with('test_plan_result_metrics', 'execution_result')}
    SELECT m.test_plan_result_id, r.execution_id AS test_plan_id, m.tenant_tsid AS tenant_id, r.executed_by AS user_id,
           m.result AS status, m.latest_result AS latest_status, {_time('r.start_time')} AS start_time,
           {_time('r.end_time')} AS end_time, CAST(r.duration AS BIGINT) AS duration_seconds, m.total_count,
           CAST(m.passed_count AS BIGINT) AS passed_count, CAST(m.failed_count AS BIGINT) AS failed_count,
           r.triggered_type AS trigger_type, {_time('r.created_date')} AS created_at, {_time('r.updated_date')} AS updated_at
    FROM test_plan_result_metrics m CROSS JOIN {_first('execution_result')} r
    """,
)
target(
    "fct_agent_activity",
    f"""{_with('ai_agent_activity_log')}
    SELECT id AS activity_id, ai_agent_workflow_id AS agent_id, tenant_tsid AS tenant_id, {_null('user_id', type='BIGINT')},
           agent_type AS activity_type, message AS description, status, {_time('start_time')} AS start_time,
           {_null('end_time', type='TIMESTAMP')}, {CREATED} FROM ai_agent_activity_log m
    """,
)
target(
    "fct_audit_events",
    f"""{_with('audit_history')}
    SELECT id AS event_id, uuid AS event_uuid, entity_tag AS event_type, {_null('entity_type')}, entity_id, actor_id AS user_id,
           coalesce(organization_tsid, 0) AS tenant_id, new_entity_data AS changes_json, {_null('ip_address')},
           {_time('action_date')} AS timestamp, {CREATED}, actor_id, entity_action AS action,
           {_time('action_date')} AS event_time, {_null('status')} FROM audit_history m
    """,
)
