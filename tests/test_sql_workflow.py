"""The reference workflow with SQL text: CSV files as views, the query run by
``spark.sql``, checks suggested from the result, selected, run and exported."""

import pytest

from tessera.checks.report import export_checks, summary_line, write_checks_sql
from tessera.checks.rules import select_checks, suggest_checks
from tessera.checks.run import run_checks
from tessera.sources.csv import write_csv
from tessera.sources.tables import register_views

from conftest import ORDERS_SCHEMA, SESSIONS_SCHEMA, USERS_SCHEMA

# Own queries over the sample tables; the names of the result columns decide which checks are suggested.
ACTIVE_USER_ORDERS = """
SELECT user_id, first(email) AS email, first(country_code) AS country_code, first(u.created_at) AS user_created_at,
       count(order_id) AS total_orders, coalesce(sum(amount), 0.0) AS total_spent,
       max(o.created_at) AS last_order_date, min(o.created_at) AS first_order_date,
       max(o.created_at) - min(o.created_at) AS order_tenure_days
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY email) AS copy
      FROM users WHERE is_active) u
LEFT JOIN orders o USING (user_id)
GROUP BY user_id, copy
"""

COUNTRY_SESSIONS = """
SELECT s.country_code, s.total_sessions, s.total_duration_seconds,
       s.total_duration_seconds / s.total_sessions AS avg_duration_seconds, s.unique_users, s.last_session_date
FROM (SELECT country_code, count(*) AS total_sessions, sum(duration_seconds) AS total_duration_seconds,
             size(collect_set(user_id)) AS unique_users, max(started_at) AS last_session_date
      FROM sessions GROUP BY country_code) s
"""


@pytest.fixture(scope="module")
def sample_dir(spark, users, orders, sessions, tmp_path_factory):
    d = tmp_path_factory.mktemp("sample_data")
    for name, df in (("users", users), ("orders", orders), ("sessions", sessions)):
        write_csv(df.coalesce(1), str(d / f"{name}.csv"))
    return str(d)


def test_missing_directory_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        register_views(spark, "/nonexistent/sample_data")


def test_sql_text_workflow(spark, sample_dir, tmp_path):
    views = register_views(spark, sample_dir, csv_schemas={
        "users": USERS_SCHEMA, "orders": ORDERS_SCHEMA, "sessions": SESSIONS_SCHEMA})
    assert set(views) == {"users", "orders", "sessions"}
    uos = spark.sql(ACTIVE_USER_ORDERS)
    assert uos.schema["order_tenure_days"].dataType.simpleString().startswith("interval day")
    checks = suggest_checks(uos)
    assert len(checks) == 14
    chosen, msg = select_checks(checks, skip=["first_order_date__not_null"])
    assert msg == "Running 13 of 14 tests  (1 skipped)"
    results = run_checks(uos, chosen)
    got = {r["name"]: r["failing_rows"] for r in results.collect()}
    assert got["table__no_duplicate_rows"] == 1 and got["user_id__unique"] == 1
    assert got["email__not_null"] == 1 and got["last_order_date__not_null"] == 1
    assert got["order_tenure_days__non_negative"] == 0          # interval compared with an interval zero
    assert summary_line(results) == "9 passed  ·  4 failed"
    uos.createOrReplaceTempView("user_order_summary")
    exported = export_checks(spark, chosen, results, "user_order_summary", uos)
    assert spark.read.text(write_checks_sql(exported, str(tmp_path / "tests_sql"), "user_order_summary")).count() > 13


def test_sql_text_session_stats(spark, sample_dir):
    register_views(spark, sample_dir, csv_schemas={"sessions": SESSIONS_SCHEMA})
    ss = spark.sql(COUNTRY_SESSIONS)
    results = run_checks(ss, suggest_checks(ss))
    assert summary_line(results) == "5 passed  ·  2 failed"


def test_register_views_dataset_folders(spark, tmp_path):
    d = tmp_path / "warehouse"
    spark.range(5).write.parquet(str(d / "numbers"))
    spark.range(3).write.json(str(d / "small.json"))
    views = register_views(spark, str(d))
    assert set(views) == {"numbers", "small"}
    assert spark.sql("SELECT COUNT(*) FROM numbers").first()[0] == 5


def test_check_table_job(spark, sample_dir, tmp_path):
    from tessera.checks.job import check_table
    from tessera.checks.report import summary_by_run

    register_views(spark, sample_dir, csv_schemas={"users": USERS_SCHEMA, "orders": ORDERS_SCHEMA})
    uos = spark.sql(ACTIVE_USER_ORDERS)
    hist, sql = str(tmp_path / "history"), str(tmp_path / "sql")
    results, msg = check_table(spark, uos, "user_order_summary", history_path=hist, sql_path=sql,
                               skip=["first_order_date__not_null"], run_id="r1")
    assert msg == "Running 13 of 14 tests  (1 skipped)"
    counts = {r["status"]: r["checks"] for r in summary_by_run(spark.read.parquet(hist)).collect()}
    assert counts == {"PASS": 9, "FAIL": 4}
    text = "\n".join(r[0] for r in spark.read.text(sql).collect())
    assert "INTERVAL '0' SECOND" in text                      # tenure is an interval in SQL text
    statements = [line.rstrip().rstrip(";") for line in text.splitlines() if line.startswith("SELECT")]
    assert len(statements) == 13
    for stmt in statements:
        spark.sql(stmt).collect()                             # every exported statement runs


def test_exported_text_runs_without_the_views_of_the_session(spark, sample_dir, tmp_path):
    from tessera.checks.job import check_table
    from tessera.checks.report import run_sql_text

    register_views(spark, sample_dir, csv_schemas={"users": USERS_SCHEMA, "orders": ORDERS_SCHEMA})
    sql = str(tmp_path / "sql")
    results, _ = check_table(spark, spark.sql(ACTIVE_USER_ORDERS), "exported_summary", sql_path=sql, definition=ACTIVE_USER_ORDERS)
    spark.catalog.dropTempView("exported_summary")
    text = "\n".join(r[0] for r in spark.read.text(sql, wholetext=True).collect())
    assert run_sql_text(spark, text) == [r["failing_rows"] for r in results.orderBy("position").collect()]


def test_colliding_or_bad_file_names_are_rejected(spark, tmp_path):
    d = tmp_path / "double"
    spark.range(3).write.parquet(str(d / "users.parquet"))
    spark.range(7).write.csv(str(d / "users.csv"), header=True)
    spark.range(7).write.parquet(str(d / "my-file.parquet"))
    with pytest.raises(ValueError, match="users.*my-file"):
        register_views(spark, str(d))


def test_exported_text_of_awkward_definitions(spark, tmp_path):
    """Semicolons in literals and comments, and a comment at the end, neither cut nor swallow a statement."""
    from tessera.checks import model as M
    from tessera.checks.report import run_sql_text, statements

    definition = "SELECT id, 'a;\\n' AS note, \"b;\" AS `odd;name` /* no; end */ FROM range(5) -- last; one"
    df = spark.sql(definition)
    exported = export_checks(spark, [M.not_null("note"), M.row_count_positive()], None, "awkward", df)
    path = write_checks_sql(exported, str(tmp_path / "sql"), "awkward", definition)
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert len(statements(text)) == 3
    assert run_sql_text(spark, text) == [0, 0]
    spark.catalog.dropTempView("awkward")
