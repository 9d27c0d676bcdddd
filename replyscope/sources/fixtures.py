"""The support-desk model laid over the shared test tables.

Every order is a ticket, every part a canned reply and every order line one use of a reply. Lines of
every twentieth part go to the part before it, and nine in ten lines of the next part to the part
after it, so replies without any or with few uses exist while no line is dropped.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.sources.tables import spread

TICKETS = {
    "ticket_id": "o_orderkey",
    "created_at": "o_orderdate",
    "resolved_at": (
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR "
        "* CAST(1 + o_orderkey % 72 AS INT) END"
    ),
    "status": "CASE o_orderstatus WHEN 'F' THEN 'solved' WHEN 'O' THEN 'open' ELSE 'pending' END",
    "channel": (
        "CASE o_orderkey % 4 WHEN 0 THEN 'email' WHEN 1 THEN 'chat' WHEN 2 THEN 'phone' "
        "ELSE 'webform' END"
    ),
    "priority": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' "
        "WHEN '3-MEDIUM' THEN 'normal' ELSE 'low' END"
    ),
    "contact_driver": "lower(c_mktsegment)",
    "first_response_time_minutes": "CAST(1 + o_orderkey % 60 AS DOUBLE)",
    "total_handle_time_minutes": "5.0E0 + o_totalprice / 5000.0E0",
    "reopens_count": "CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END",
    "csat_score": (
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL "
        "ELSE CAST(1 + (o_orderkey * 7 + o_custkey) % 5 AS INT) END"
    ),
    "macro_sequence": (
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL "
        "ELSE concat('M', o_orderkey % 97, ',M', o_orderkey % 89) END"
    ),
    "final_macro_id": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('M', o_orderkey % 89) END",
    "agent_id": "o_custkey % 50",
}

MACROS = {
    "macro_id": "p_partkey",
    "macro_name": "p_name",
    "category": "lower(p_type)",
    "macro_body": "concat(p_name, ' ', p_type, ' ', p_brand, ' size ', p_size)",
    "is_active": "p_size > 5",
    "is_internal_only": "p_size % 7 = 0",
    "owner_team": "lower(p_brand)",
    "created_at": "DATE '1995-01-01' + CAST(p_partkey % 300 AS INT)",
    "updated_at": "DATE '1996-01-01' + CAST(p_partkey % 60 AS INT)",
}

USAGE = {
    "ticket_id": "l_orderkey",
    "macro_id": (
        "CASE WHEN l_partkey % 20 = 0 THEN abs(l_partkey - 1) "
        "WHEN l_partkey % 20 = 1 AND l_orderkey % 10 <> 0 THEN l_partkey + 1 ELSE l_partkey END"
    ),
    "applied_at": "l_shipdate",
    "position_in_thread": "l_linenumber",
    "agent_id": "o_custkey % 50",
}


def _select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in mapping.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Library:
    """Lazy DataFrames of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def tickets(self) -> DataFrame:
        orders, customer = self.table("orders"), self.table("customer")
        return _select(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), TICKETS)

    @property
    def macros(self) -> DataFrame:
        return _select(self.table("part"), MACROS)

    @property
    def usage(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders").select("o_orderkey", "o_custkey")
        return _select(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), USAGE)

    @property
    def usage_only(self) -> DataFrame:
        """Uses without the agent: no join with orders."""
        return _select(self.table("lineitem"), {k: v for k, v in USAGE.items() if k != "agent_id"})

    @property
    def fact_tickets(self) -> DataFrame:
        return self.tickets.select(
            "ticket_id", "created_at", "resolved_at", "csat_score",
            (F.col("total_handle_time_minutes") * 60.0).alias("handle_time_seconds"),
            "contact_driver", "priority", "channel", "agent_id",
            (F.col("reopens_count") > 0).alias("was_reopened"),
        )

    @property
    def reply_texts(self) -> DataFrame:
        """Canned replies whose bodies are the document texts, named and grouped like parts."""
        docs = spread(self.table("documents").select("doc_id", "text", "source"))
        part = self.table("part").select("p_partkey", "p_name", "p_type")
        return docs.join(part, F.col("doc_id") == F.col("p_partkey"), "left").select(
            F.col("doc_id").alias("macro_id"),
            F.col("p_name").alias("macro_name"),
            F.lower("p_type").alias("category"),
            F.col("text").alias("macro_body"),
            "source",
        )
