"""Queries that take every row, on planted rows."""

from tallyforge.plans.cleaning import safe_parsing_whole
from tallyforge.plans.orderings import round_robin_whole


def test_safe_parsing_whole(spark):
    rows = [(1, 2.5), (7, 4.0), (13, None), (19, float("nan")), (25, 1.0e9), (2, 9.0), (5, 9.0), (6, 9.0), (None, 9.0)]
    events = spark.createDataFrame(rows, "event_id long, value double")
    found = {tuple(r) for r in safe_parsing_whole(lambda name: events).select("kind", "rows", "parsed", "total", "whole_sum").collect()}
    assert found == {(1, 5, 3, 1000000006.5, 1000000004), (2, 1, 1, 2.0, 2), (5, 1, 1, -5.5, None), (0, 1, 0, None, None), (None, 1, 0, None, None)}


def test_round_robin_whole(spark):
    rows = [("a", 1, i) for i in range(60)] + [("a", 2, 100), ("a", 2, 101), ("b", 1, 200), (None, None, 300)]
    events = spark.createDataFrame(rows, "event_type string, user_id long, event_id long")
    found = {r.event_id: (r.turn, r.type_turn) for r in round_robin_whole(lambda name: events).collect()}
    users = {0: (1, 1), 100: (1, 2), 1: (2, 3), 101: (2, 4)}
    assert found == {i: (i + 1, i + 3) for i in range(2, 60)} | users | {200: (1, 1), 300: (1, 1)}
