"""Inputs of the registered queries, derived from the driver tables.

Every input is computed by Spark from whole tables: edge records around ``events``, address
blocks from ``nation``, logins from ``customer``.  Literals that exercise a converter are
picked by ``event_id`` so that all of them occur all over the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick_sql(literals: list[str], index: str) -> str:
    """CASE expression choosing one of the texts; the same text works in both engines."""
    quoted = [x if x.startswith("$") else "'" + x.replace("'", "''") + "'" for x in literals]
    arms = " ".join(
        f"WHEN {i} THEN {q[1:] if q.startswith('$') else q}" for i, q in enumerate(quoted)
    )
    return f"CASE {index} % {len(literals)} {arms} END"


# JSON literals per converter; a leading $ marks an SQL expression over the row.
INT_LITERALS = [
    "8", '"-350"', '"2147483647"', '"-2147483648"', '"2147483648"', '"-60000000017"', "6.75", "null",
    '"seven"', '"7up"', '"+31"', '" 8"', '"9223372036854775807"', '"9223372036854775808"', "false",
    "$CAST(event_id * 1000003 AS VARCHAR(30))", "$concat('\"', CAST(0 - event_id AS VARCHAR(30)), '\"')",
]
FLOAT_LITERALS = [
    "2.5", "640.0", "-0.75", "7e-330", "6e400", '"6e400"', '"-7e-330"', '"33.50"', '"-.5"', "null",
    '"nan"', '"2f"', '"north"', '" 1"', "true", "$CAST(value AS VARCHAR(30))",
    "$concat('\"', CAST(value AS VARCHAR(30)), '\"')",
]
BOOL_LITERALS = ["true", "false", "1", "0", "3", '"false"', '"0"', "null", "0.5"]
VARCHAR_LITERALS = [
    '"oak"', "$concat('\"left', chr(92), 'tright', chr(92), 'nbelow\"')", '""', "2.50", "null", "false", "[]", '{"k":"v"}',
    "$concat('\"', event_type, '\"')",
]


def edge_line(
    payload: Column, *, uuid: Column | None = None, client_ip: Column | None = None,
    edge_type: Column | None = None, user_agent: Column | None = None,
) -> Column:
    """JSON edge record around a payload text."""
    return F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("receivedAt"),
            (client_ip if client_ip is not None else F.lit("10.0.0.1")).alias("clientIp"),
            (uuid if uuid is not None else F.col("event_id").cast("string")).alias("uuid"),
            F.base64(payload.cast("binary")).alias("data"),
            F.lit(3).alias("recordversion"),
            (user_agent if user_agent is not None else F.lit("")).alias("userAgent"),
            (edge_type if edge_type is not None else F.lit("internal")).alias("edgeType"),
        )
    )


def payload(properties: Column, event: Column | None = None) -> Column:
    event = event if event is not None else F.col("event_type")
    return F.concat(F.lit('{"event":"'), event, F.lit('","properties":'), properties, F.lit("}"))


def event_lines(events: DataFrame, properties: str, event: str = "event_type", **fields) -> DataFrame:
    """Edge-record lines of all events, properties given as an SQL text expression."""
    return events.select(edge_line(payload(F.expr(properties), F.expr(event)), **fields).alias("value"))


ADDRESS_SQL = "(user_id * 2654435761) % 4294967296"


def dotted_address() -> Column:
    a = F.expr("CAST(" + ADDRESS_SQL + " AS BIGINT)")
    quads = [F.shiftright(a, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *quads)


# One block per nation: 160 million addresses from each multiple of 171,798,691.
BLOCKS_SQL = """
SELECT CAST(n_nationkey AS BIGINT) * 171798691 AS start_ip,
       CAST(n_nationkey AS BIGINT) * 171798691 + 159999999 AS end_ip,
       n_name AS city, concat('R', CAST(n_regionkey AS VARCHAR(3))) AS region,
       concat('C', CAST(n_nationkey AS VARCHAR(3))) AS country,
       CASE WHEN n_nationkey % 5 = 4 THEN 'none'
            WHEN n_nationkey % 2 = 0 THEN concat('AS', CAST(4000 + n_nationkey AS VARCHAR(10)), ' ', n_name)
            ELSE concat('AS', CAST(4000 + n_nationkey AS VARCHAR(10))) END AS asn
FROM nation
"""


def address_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BLOCKS_SQL.replace("FROM nation", "FROM {nation}"), nation=table(spark, sf_dir, "nation"))


def login_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as logins; every tenth is a negative entry (no id)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("login"),
        F.expr("CASE WHEN c_custkey % 10 <> 9 THEN c_custkey END").alias("user_id"),
    )
