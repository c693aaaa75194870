from collections import Counter

import pytest

from fixtures import source_columns
from starloom.operators.quality import mapping_spec, validate_mappings
from starloom.plans.spec import LOAD_TIME, MappingSet, TargetMapping
from starloom.plans.targets import JOIN_KEYS, SKIP_TABLES, TARGETS
from starloom.sources.catalog import jdbc_options, keep_name, keywords, source_role, tables_to_extract


def test_size_of_the_star():
    assert len(TARGETS) == 25
    assert sum(len(m.columns) for m in TARGETS) == 297
    assert len(TARGETS.required_tables()) == 36
    assert {g: len(TARGETS.in_group(g)) for g in ("identity", "master", "tenant")} == {"identity": 3, "master": 6, "tenant": 16}
    assert TARGETS.in_group("Identity") == TARGETS.in_group("identity") and TARGETS.in_group("other") == []
    assert Counter(m.name.split("_")[0] for m in TARGETS) == {"dim": 15, "brg": 1, "fct": 9}


def test_types():
    types = Counter(f.dataType.simpleString() for m in TARGETS for f in m.schema)
    assert types == {"bigint": 120, "string": 98, "timestamp": 88, "boolean": 16}
    assert all(m.schema.names[-1] == LOAD_TIME for m in TARGETS)
    assert sum(1 for m in TARGETS for f in m.schema if f.metadata.get("max_length")) == 81


def test_declarations_name_existing_columns():
    for m in TARGETS:
        for name in (*m.primary_key, *m.key, *m.required, *m.defaults, *m.cluster_by, *m.bit_columns, *m.null_defaults):
            assert name in m.columns, (m.name, name)
    assert sum(bool(m.cluster_by) for m in TARGETS) == 15


@pytest.mark.parametrize(
    "target, column, source",
    [
        ("dim_users", "user_id", "users.id"),
        ("dim_users", "account_status", "user_accounts.status"),
        ("dim_tenants", "tenant_id", "tenants.id"),
        ("dim_projects", "tenant_id", "project.tenant_tsid"),
        ("dim_projects", "project_uuid", "project.tsid"),
        ("dim_object_types", "updated_at", "object_types.updated_at__epoch"),
        ("brg_tenant_features", "tenant_id", "tenant_features.tenant_id"),
        ("brg_tenant_features", "feature_id", "tenant_features.id"),
        ("fct_executions", "user_id", "execution.created_by_id"),
        ("fct_executions", "test_suite_id", "execution.id"),
        ("fct_test_plan_results", "user_id", "execution_result.executed_by"),
        ("fct_test_plan_results", "created_at", "execution_result.created_date"),
        ("fct_test_steps", "expected_result", "nlp_test_case_step.excepted_result"),
        ("fct_audit_events", "tenant_id", "audit_history.organization_tsid"),
        ("fct_audit_events", "event_uuid", "audit_history.uuid"),
    ],
)
def test_mapped_fields(target, column, source):
    assert TARGETS[target].columns[column] == source


def test_lengths():
    length = lambda target, column: TARGETS[target].length_of(column)
    assert length("dim_test_cases", "name") == 500 and length("dim_users", "email") == 255
    assert length("dim_tenants", "billing_zip") == 20 and length("fct_api_steps", "url") == 0


def test_types_of_undeclared_columns():
    mapping = TargetMapping("t", ("s",), ("a_id",), {c: f"s.{c}" for c in ("a_id", "is_on", "created_at", "note")})
    assert [f.dataType.simpleString() for f in mapping.schema] == ["bigint", "boolean", "timestamp", "string", "timestamp"]
    assert {f.name: f.metadata.get("max_length") for f in mapping.schema if f.metadata} == {"note": 255}


def test_lookup_by_name():
    assert TARGETS.get("none") is None and TARGETS.sources_of("none") == [] and TARGETS.columns_of("none") == {}
    assert TARGETS.key_of("none") is None and TARGETS.key_of("brg_tenant_features") == ("tenant_id", "feature_id")
    assert [m.name for m in TARGETS.fed_by("tenant_features")] == ["brg_tenant_features", "dim_features"]
    assert len(JOIN_KEYS) == 10 and len(SKIP_TABLES) == 9 and len(source_columns()) == 36


def test_validate(spark):
    assert validate_mappings(mapping_spec(spark, TARGETS)).isEmpty()
    broken = MappingSet([TargetMapping("t", (), (), {})])
    errors = {r["error"] for r in validate_mappings(mapping_spec(spark, broken)).collect()}
    assert errors == {"no_sources:t", "no_key:t", "columns_empty:t"}


def test_names_on_the_driver():
    assert keywords(" A, ,b ") == ["a", "b"] and keywords(None) == []
    assert keep_name("Tenant_Prod", "prod", "test") and not keep_name("tenant_test_prod", "prod", "test")
    assert keep_name("any") and not keep_name("any", "other")
    assert tables_to_extract(["users", "SPRING_SESSION", "unknown"]) == ["users", "unknown"]
    assert tables_to_extract(["users", "unknown"], only=["users"]) == ["users"]


def test_source_routing():
    urls = {"identity": "mysql://u:p%40w@id-host:3307/x", "master": "mysql://m-host", "tenant": "mysql://t-host/default"}
    assert [source_role(d) for d in ("Identity", "MASTER", "tenant_1", "other", None)] == [
        "identity", "master", "tenant", "tenant", "tenant"]
    options = jdbc_options(urls, "identity")
    assert options["url"] == "jdbc:mysql://id-host:3307/identity"
    assert (options["user"], options["password"]) == ("u", "p@w")
    assert jdbc_options(urls, "tenant_9")["url"] == "jdbc:mysql://t-host:3306/tenant_9"
    assert jdbc_options(urls)["url"].endswith("/default")
    with pytest.raises(ValueError):
        jdbc_options({}, "master")
