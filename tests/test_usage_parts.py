"""Uses per macro: parts of a set number of rows; repeated and unknown tickets, agents and macros."""

import random

from replyscope.operators import features


def test_counts_by_hand_and_parts_by_rows(spark, monkeypatch):
    r = random.Random(2)
    some = lambda n: r.choice([None, *range(n)])
    uses = [(some(30), some(5), r.choice([None, 1, 2, 3])) for _ in range(900)]
    tickets = [(some(25), some(4)) for _ in range(60)]  # tickets with several agents, with none, twice with one
    macros = [(k, f"m{k}", "c") for k in [*range(7), None]]
    monkeypatch.setattr(features, "PART_ROWS", 20)
    found = features.macro_usage_stats(
        spark.createDataFrame(macros, "macro_id long, macro_name string, category string"),
        spark.createDataFrame(uses, "ticket_id long, macro_id long, applied_at long"),
        spark.createDataFrame(tickets, "ticket_id long, agent_id long"),
    )
    assert "hashpartitioning(ticket_id" in (plan := found._jdf.queryExecution().toString()) and ", 45)" in plan
    want = set()
    for macro, name, category in macros:
        mine = [u for u in uses if macro is not None and u[1] == macro]
        known = {u[0] for u in mine} - {None}
        agents = {a for t, a in tickets if t in known} - {None}
        times = [u[2] for u in mine if u[2] is not None]
        want.add((macro, name, category, len(known), len(agents), min(times, default=None), max(times, default=None)))
    assert {tuple(row) for row in found.collect()} == want
