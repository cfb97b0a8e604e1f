"""The test-table flows laid out as full flow files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.schema import flow_schema

# SQL that both engines read alike; fields not named here are 0.
FIELDS = {
    "duration": "duration",
    "protocol_type": "protocol_type",
    "service": "service",
    "flag": "flag",
    "src_bytes": "floor(src_bytes)",
    "dst_bytes": "floor(dst_bytes)",
    "hot": "CAST(cnt AS BIGINT) % 7",
    "logged_in": "CASE WHEN protocol_type = 'tcp' THEN 1 ELSE 0 END",
    "count": "cnt",
    "srv_count": "cnt * 2",
    "serror_rate": "serror_rate",
    "same_srv_rate": "same_srv_rate",
    "label": "label",
    "difficulty": "CAST(cnt AS BIGINT) % 21",
}


def expressions(with_difficulty: bool = False) -> list[tuple[str, str]]:
    """(column, SQL) in file order, cast to the field's type."""
    return [(f.name, f"CAST({FIELDS.get(f.name, '0')} AS {f.dataType.simpleString()})")
            for f in flow_schema(with_difficulty)]


def flow_rows(flows: DataFrame, with_difficulty: bool = False) -> DataFrame:
    return flows.select(*[F.expr(sql).alias(name) for name, sql in expressions(with_difficulty)])
