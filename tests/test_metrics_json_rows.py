"""Customer metrics in one shuffle and JSON documents as rows."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from ledgerlake.operators.json_rows import json_entries
from ledgerlake.plans import marts

SCHEMA = ("customer_key string, transaction_key string, source_system string, amount decimal(28,9), "
          "revenue_amount decimal(28,9), transaction_date date")
D = dt.date


def _fct(spark, rows):
    return spark.createDataFrame([(c, t, s, None if a is None else Decimal(a), None, d) for c, t, s, a, d in rows], SCHEMA)


ROWS = [("a", "t1", "stripe", 5, D(2024, 1, 2)), ("a", "t2", "plaid", 7, D(2024, 1, 1)), ("a", "t3", "plaid", None, None),
        ("b", "t1", "stripe", 1, D(2024, 2, 1)), (None, "t9", "stripe", 1, D(2024, 2, 1)), ("c", "t4", None, 1, None)]


def _got(df):
    return {r.customer_key: (r.lifetime_transaction_count, r.lifetime_transaction_value, r.first_transaction_date,
                             r.last_transaction_date, r.source_system_count) for r in df.collect()}


WANT = {"a": (3, 12, D(2024, 1, 1), D(2024, 1, 2), 2), "b": (1, 1, D(2024, 2, 1), D(2024, 2, 1), 1), "c": (1, 1, None, None, 0)}


def test_one_row_each_is_found_and_shuffles_once(spark):
    fct = _fct(spark, ROWS)
    assert not marts.repeats(fct, ["customer_key", "transaction_key"])
    metrics = marts.customer_metrics(fct)
    assert _got(metrics) == WANT
    plan = metrics._jdf.queryExecution().sparkPlan().toString() + marts.customer_metrics(fct, True)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and "Expand" not in plan


def test_repeated_transactions_count_once_but_their_amounts_add(spark):
    rows = ROWS + [("a", "t2", "stripe", 1, D(2024, 3, 1)), ("b", None, "plaid", 2, D(2024, 1, 1)), ("b", None, "plaid", 2, None)]
    fct = _fct(spark, rows)
    assert marts.repeats(fct, ["customer_key", "transaction_key"])
    got = _got(marts.customer_metrics(fct))
    assert got["a"] == (3, 13, D(2024, 1, 1), D(2024, 3, 1), 2)
    assert got["b"] == (1, 5, D(2024, 1, 1), D(2024, 2, 1), 2)


def test_both_ways_agree(spark):
    fct = _fct(spark, ROWS)
    assert _got(marts.customer_metrics(fct, True)) == _got(marts.customer_metrics(fct, False)) == WANT


def test_unknown_source_is_an_error_not_a_lost_count(spark):
    with pytest.raises(Exception, match="unknown source system: elsewhere"):
        marts.customer_metrics(_fct(spark, [("a", "t", "elsewhere", 1, None)]), True).collect()


def test_no_rows(spark):
    assert marts.customer_metrics(_fct(spark, [])).collect() == []


def test_json_entries(spark):
    docs = [(1, '{"a": "x", "b": 2, "c": null, "d": {"e": [1]}, "f": [1, "y"], "g": true, "a.b \'c": "odd"}'), (2, '{"a": '), (3, None),
            (4, "[1, 2]"), (5, '"text"'), (6, "{}"), (7, '{"a": "{}"}'), (8, '{"a": 1, "a": 2}'), (9, ""), (10, '{"n": 12345678901234567890, "m": 1.50}')]
    df = spark.createDataFrame(docs, "id int, doc string")
    got = {(r.id, r.field): (r.value, r.is_nested) for r in json_entries(df, "doc", ["id"]).collect()}
    assert got == {
        (1, "a"): ("x", False), (1, "b"): ("2", False), (1, "c"): (None, False), (1, "d"): ('{"e":[1]}', True),
        (1, "f"): ('[1,"y"]', True), (1, "g"): ("true", False), (1, "a.b 'c"): ("odd", False), (7, "a"): ("{}", False),
        (10, "n"): ("12345678901234567890", False), (10, "m"): ("1.5", False)}


def test_json_entries_keep_clashing_names(spark):
    df = spark.createDataFrame([("k", '{"x": 1}')], "key string, doc string")
    assert [tuple(r) for r in json_entries(df, "doc", ["key"]).collect()] == [("k", "x", "1", False)]
