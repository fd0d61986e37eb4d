"""The reference's two documented end-to-end examples, as goldens."""

from tessera.checks.report import summary_line, summarize
from tessera.checks.rules import LEFT_JOIN_SUFFIX, select_checks, suggest_checks
from tessera.checks.run import auto_check, run_checks
from tessera.plans.reports import session_stats, user_order_summary

UOS_EXPECTED = [
    ("table__row_count_positive", "table_level", 0),
    ("table__no_duplicate_rows", "table_level", 1),
    ("user_id__not_null", "not_null", 0),
    ("user_id__unique", "unique", 1),
    ("email__not_null", "not_null", 1),
    ("email__email_format", "format", 0),
    ("country_code__not_null", "not_null", 0),
    ("country_code__country_code_length", "format", 0),
    ("user_created_at__not_null", "not_null", 0),
    ("total_orders__non_negative", "range", 0),
    ("total_spent__non_negative", "range", 0),
    ("last_order_date__not_null", "not_null", 1),
    ("first_order_date__not_null", "not_null", 1),
    ("order_tenure_days__non_negative", "range", 0),
]

SS_EXPECTED = [
    ("table__row_count_positive", "table_level", 0),
    ("table__no_duplicate_rows", "table_level", 0),
    ("country_code__not_null", "not_null", 1),
    ("country_code__country_code_length", "format", 0),
    ("total_sessions__non_negative", "range", 0),
    ("total_duration_seconds__non_negative", "range", 1),
    ("last_session_date__not_null", "not_null", 0),
]


def _triples(results):
    return [(r["name"], r["test_type"], r["failing_rows"]) for r in results.orderBy("position").collect()]


def test_user_order_summary_suggestions(users, orders):
    uos = user_order_summary(users, orders)
    checks = suggest_checks(uos)
    assert [(c.name, c.test_type) for c in checks] == [(n, t) for n, t, _ in UOS_EXPECTED]
    by_name = {c.name: c for c in checks}
    # COALESCE-protected measures get no NOT NULL check, but keep the range check.
    assert "total_orders__not_null" not in by_name and "total_orders__non_negative" in by_name
    # The left-join warning is appended for columns of the nullable side only.
    assert by_name["last_order_date__not_null"].reason.endswith(LEFT_JOIN_SUFFIX)
    assert by_name["first_order_date__not_null"].reason.endswith(LEFT_JOIN_SUFFIX)
    assert not by_name["email__not_null"].reason.endswith(LEFT_JOIN_SUFFIX)


def test_user_order_summary_golden(users, orders):
    results = auto_check(user_order_summary(users, orders))
    assert _triples(results) == UOS_EXPECTED


def test_example_one_with_skip(users, orders):
    uos = user_order_summary(users, orders)
    chosen, msg = select_checks(suggest_checks(uos), skip=["first_order_date__not_null"])
    assert msg == "Running 13 of 14 tests  (1 skipped)"
    results = run_checks(uos, chosen)
    s = summarize(results).first()
    assert (s["passed"], s["failed"], s["errors"]) == (9, 4, 0)
    assert summary_line(results) == "9 passed  ·  4 failed"


def test_session_stats_golden(sessions):
    ss = session_stats(sessions)
    results = auto_check(ss)
    assert _triples(results) == SS_EXPECTED
    s = summarize(results).first()
    assert (s["passed"], s["failed"], s["errors"]) == (5, 2, 0)
    ca = ss.filter("country_code = 'CA'").first()
    assert ca["total_duration_seconds"] == -320 and ca["total_sessions"] == 2


def test_user_order_summary_values(users, orders):
    rows = {r["user_id"]: r for r in user_order_summary(users, orders).collect()}
    assert 8 not in rows  # inactive
    assert rows[4]["total_orders"] == 0 and rows[4]["total_spent"] == 0.0 and rows[4]["last_order_date"] is None
    assert rows[1]["order_tenure_days"] == 106
    assert abs(rows[9]["total_spent"] - 238.88) < 1e-9


def test_empty_selection_stops(users, orders):
    import pytest

    uos = user_order_summary(users, orders)
    with pytest.raises(ValueError):
        select_checks(suggest_checks(uos), only=[])
