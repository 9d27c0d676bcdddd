import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def desk_tables(spark):
    """Four tickets, four macros and five uses."""
    tickets = spark.sql(
        """SELECT * FROM VALUES
        ('T1', timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-01 12:30:00', 'solved', 'email', 'high',
         'billing_issue', 5.0D, 20.0D, 0, 4, 'A1', 'M1,M2', 'M2'),
        ('T2', timestamp_ntz'2024-01-02 09:00:00', timestamp_ntz'2024-01-03 09:00:00', 'open', 'chat', 'low',
         'login_problem', 8.0D, 40.0D, 2, 2, 'A1', CAST(NULL AS STRING), CAST(NULL AS STRING)),
        ('T3', timestamp_ntz'2024-01-02 11:00:00', CAST(NULL AS timestamp_ntz), 'pending', 'phone', 'urgent',
         'billing_issue', 1.0D, 10.0D, 0, CAST(NULL AS INT), 'A2', 'M1', 'M1'),
        ('T4', timestamp_ntz'2024-01-05 11:00:00', timestamp_ntz'2024-01-05 11:30:00', 'solved', 'email', 'normal',
         'login_problem', 2.0D, 30.0D, 1, 5, 'A2', 'M3', 'M3')
        AS t(ticket_id, created_at, resolved_at, status, channel, priority, contact_driver,
         first_response_time_minutes, total_handle_time_minutes, reopens_count, csat_score, agent_id,
         macro_sequence, final_macro_id)"""
    )
    macros = spark.sql(
        """SELECT * FROM VALUES ('M1', 'Refund steps', 'billing', '  Dear customer, your refund is on its way  ', true),
        ('M2', 'Refund delay', 'billing', 'Your refund is late', true), ('M3', 'Reset', 'technical', 'Reset it', true),
        ('M4', 'Idle', 'technical', 'Never used', false) AS t(macro_id, macro_name, category, macro_body, is_active)"""
    )
    usage = spark.sql(
        """SELECT * FROM VALUES ('T1', 'M1', timestamp_ntz'2024-01-01 10:05:00', 1),
        ('T1', 'M2', timestamp_ntz'2024-01-01 10:06:00', 2), ('T3', 'M1', timestamp_ntz'2024-01-02 11:05:00', 1),
        ('T4', 'M3', timestamp_ntz'2024-01-05 11:05:00', 1), ('T9', 'M1', timestamp_ntz'2024-01-06 11:05:00', 1)
        AS t(ticket_id, macro_id, applied_at, position_in_thread)"""
    )
    return tickets, macros, usage
