"""Small source tables for every target, with the faults that matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans.targets import JOIN_KEYS, TARGETS

GROUP_DATABASES = {"identity": ["identity"], "master": ["master"], "tenant": ["tenant_a", "tenant_b"]}


def source_columns() -> dict[str, dict[str, str]]:
    """Source table -> column -> type, implied by the target columns it feeds and by the shared keys."""
    return {
        table: {f.name: f.dataType.simpleString() for f in TARGETS.source_schema(table, JOIN_KEYS)}
        for table in sorted(TARGETS.required_tables())
    }


def source_tables(spark, rows: int = 5):
    """Each table with ``rows`` rows per database of its group, filled by type."""
    groups = {table: mapping.group for mapping in TARGETS for table in mapping.sources}
    frames = {}
    for table, columns in source_columns().items():
        databases = F.array(*[F.lit(d) for d in GROUP_DATABASES[groups[table]]])
        base = spark.range(rows).select(F.explode(databases).alias("_database"), F.col("id").alias("_pos"))
        made = {
            "bigint": F.col("_pos"),
            "string": F.concat(F.lit(f"{table}-"), "_pos"),
            "boolean": F.col("_pos") % 2 == 0,
            "timestamp": F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("_pos")),
        }
        frames[table] = base.select("*", *[made[t].alias(c) for c, t in columns.items()])
    return frames
