import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators import checks
from ledgerlake.operators.checks import Check, run_model_checks
from ledgerlake.sources import landing
from ledgerlake.streaming import land_stream


def test_column_checks_fold_into_one_result_per_check(spark):
    df = spark.createDataFrame([("a", "x@y.z", 5), ("a", "bad", -1), (None, None, 3)], "id string, email string, n int")
    parent = spark.createDataFrame([("a",)], "id string")
    res = run_model_checks(spark, "m", df, [
        Check("not_null", "id"), Check("unique", "id"), Check("accepted_values", "id", {"values": ["a"]}),
        Check("between", "n", {"min": 0, "max": 4}), Check("regex", "email", {"regex": r"^[^@]+@[^@]+\.[^@]+$",
                                                                              "where": "email is not null"}),
        Check("row_count", None, {"min": 5}, severity="warn"),
        Check("relationships", "id", {"to": "p", "field": "id"}),
        Check("unique_combination", None, {"columns": ["id", "n"]}),
    ], {"p": parent})
    got = {(r.check, r.column): (r.status, r.failures) for r in res.collect()}
    assert got[("not_null", "id")] == ("fail", 1)
    assert got[("unique", "id")] == ("fail", 1)
    assert got[("accepted_values", "id")] == ("pass", 0)  # NULL passes
    assert got[("between", "n")] == ("fail", 2)
    assert got[("regex", "email")] == ("fail", 1)
    assert got[("row_count", None)] == ("warn", 1)
    assert got[("relationships", "id")] == ("pass", 0)
    assert got[("unique_combination", None)] == ("pass", 0)
    t = checks.tally(res).first()
    assert (t.passed, t.failed, t.warnings, t.errors, t.skipped) == (3, 4, 1, 0, 0)


def test_balanced_debits_credits_and_orphans(spark):
    lines = spark.createDataFrame([("t1", Decimal(5), None), ("t1", None, Decimal(5)), ("t2", Decimal(5), None),
                                   ("t2", None, Decimal("4.98"))], "t string, d decimal(18,4), c decimal(18,4)")
    assert [r.t for r in checks.balanced_debits_credits(lines, "d", "c", "t").collect()] == ["t2"]
    fct = spark.createDataFrame([("customer", None), ("customer", "k"), ("bank_account", None)],
                                "entity_type string, customer_key string")
    r = checks.orphan_rate(fct).first()
    assert (r.total_rows, r.orphan_rows, r.orphan_rate, r.is_failing) == (2, 1, 0.5, True)


def test_revenue_reconciliation_full_outer_and_completed_quarters(spark):
    rows = [("recognized", 2023, 1, Decimal(100)), ("booked", 2023, 1, Decimal(120)),   # 16.7 % off -> fails
            ("recognized", 2023, 2, Decimal(100)), ("booked", 2023, 2, Decimal(105)),   # within 10 %
            ("recognized", 2023, 3, Decimal(50)),                                        # recognized only
            ("booked", 2023, 4, Decimal(10)),                                            # booked only -> fails
            ("booked", 2024, 1, Decimal(10))]                                            # current quarter
    rev = spark.createDataFrame(rows, "revenue_stage string, revenue_year int, revenue_quarter int, "
                                      "revenue_amount decimal(28,9)")
    got = sorted((r.year, r.quarter) for r in checks.revenue_reconciliation(rev, dt.date(2024, 1, 31)).collect())
    assert got == [(2023, 1), (2023, 4)]


def test_land_json_flatten_and_lookback(spark, tmp):
    for acct in ("a1", "a2"):  # two linked accounts, one extract file each (S7)
        with open(os.path.join(tmp, f"{acct}.json"), "w") as f:
            f.write(json.dumps({"account_id": acct, "balances": {"current": 10.5, "available": 9.0, "limit": None,
                                                                "iso_currency_code": "USD"}}) + "\n")
    raw = landing.read_landed_json(spark, [os.path.join(tmp, "a1.json"), os.path.join(tmp, "a2.json")])
    flat = landing.stamp(landing.flatten_balances(raw, "2024-01-31 06:00:00"), "2024-01-31 06:00:00", "plaid")
    rows = sorted(flat.collect())
    assert [r.account_id for r in rows] == ["a1", "a2"]
    assert rows[0].snapshot_date == dt.date(2024, 1, 31) and rows[0]._source_system == "plaid"
    assert rows[0]._loaded_at == dt.datetime(2024, 1, 31, 6)
    tx = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 31)] + [(dt.date(2023, 12, 31),)], "date date")
    kept = sorted(r.date for r in landing.lookback(tx, "date", dt.date(2024, 1, 31), 30).collect())
    assert kept == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 31)]


def test_stream_landing_is_incremental_and_exactly_once(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/ckpt"
    os.makedirs(src)
    schema = "id string, amount double"

    def drop(name, rows):
        with open(f"{src}/{name}.json", "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")

    drop("b1", [{"id": "1", "amount": 1.0}, {"id": "2", "amount": 2.0}])
    assert land_stream(spark, src, target, spark.createDataFrame([], schema).schema, "stripe", "charges", ckpt) == 1
    assert land_stream(spark, src, target, spark.createDataFrame([], schema).schema, "stripe", "charges", ckpt) == 0
    drop("b2", [{"id": "3", "amount": 3.0}])
    assert land_stream(spark, src, target, spark.createDataFrame([], schema).schema, "stripe", "charges", ckpt) == 1
    out = spark.read.parquet(target)
    assert sorted(r.id for r in out.collect()) == ["1", "2", "3"]
    # one _loaded_at per batch
    per_batch = out.groupBy("batch_id").agg(F.countDistinct("_loaded_at").alias("n")).collect()
    assert all(r.n == 1 for r in per_batch) and len(per_batch) == 2


def test_seed_csv_with_pinned_types_and_views(spark, tmp):
    from ledgerlake import sinks
    from ledgerlake.sources import seeds

    path = os.path.join(tmp, "seed_chart_of_accounts.csv")
    with open(path, "w") as f:
        f.write("account_code,source_system,canonical_classification,canonical_category,financial_statement_line,"
                "is_balance_sheet,is_income_statement\n")
        for r in seeds.CHART_OF_ACCOUNTS:
            f.write(",".join(str(v).lower() if isinstance(v, bool) else v for v in r) + "\n")
    from_csv = seeds.chart_of_accounts(spark, path)
    assert dict(from_csv.dtypes)["account_code"] == "string"  # pinned: '1000' stays text
    assert sorted(from_csv.collect()) == sorted(seeds.chart_of_accounts(spark).collect())
    sinks.view(from_csv, "seed_coa")
    assert spark.sql("select count(*) from seed_coa where is_balance_sheet").first()[0] == sum(
        1 for r in seeds.CHART_OF_ACCOUNTS if r[5])
    assert seeds.currency_codes(spark).filter("decimal_places = 0").first().currency_code == "JPY"


def test_staging_reads_landed_json_with_text_stamps(spark, tmp):
    """A raw table landed as JSON (nested metadata kept as text, _loaded_at as
    ISO text) stages like the parquet raw tables."""
    from ledgerlake.plans.staging import stg_stripe_customers

    rec = {"id": "cus_1", "name": "Ann Lee", "email": "a@x.io", "phone": None,
           "address": json.dumps({"line1": "1 Main", "city": {"n": 1}}), "currency": None, "delinquent": False,
           "metadata": json.dumps({"qb_customer_id": "QB-1"}), "created": 1704067200,
           "_loaded_at": "2024-01-31T06:00:00+00:00", "_source_system": "stripe"}
    path = os.path.join(tmp, "customers.json")
    with open(path, "w") as f:
        f.write(json.dumps(rec) + "\n")
    schema = ("id string, name string, email string, phone string, address string, currency string, "
              "delinquent boolean, metadata string, created bigint, _loaded_at string, _source_system string")
    r = stg_stripe_customers(landing.read_landed_json(spark, path, schema)).first()
    assert r.address_line1 == "1 Main" and r.city is None and r.quickbooks_customer_id == "QB-1"
    assert r._loaded_at == dt.datetime(2024, 1, 31, 6) and r.currency_code == "USD"
    assert r.created_at == dt.datetime(2024, 1, 1)


def test_landed_json_through_the_registry_stages_like_the_derived_tables(spark, tmp):
    from ledgerlake.plans import intermediate
    from ledgerlake.plans.staging import Staging
    from ledgerlake.sources.driver_tables import DriverRaw
    from ledgerlake.sources.raw_schemas import RAW_SCHEMAS

    derived = DriverRaw(spark, "/root/testdata/sf0.001")
    reg = landing.SourceRegistry(spark, tmp, fmt="json")
    for name in RAW_SCHEMAS:  # land every raw table as newline-delimited JSON
        derived(name).withColumn("_loaded_at", F.date_format("_loaded_at", "yyyy-MM-dd'T'HH:mm:ssXXX")) \
            .write.mode("overwrite").json(reg.path(name))
    a, b = Staging(derived), Staging(reg)
    for n in ["qb_invoices", "stripe_customers", "ns_transactions", "plaid_transactions", "sf_opportunities"]:
        x, y = getattr(a, n)(), getattr(b, n)()
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, n
    ga = intermediate.golden_customers(a.stripe_customers(), a.qb_customers(), a.sf_accounts())
    gb = intermediate.golden_customers(b.stripe_customers(), b.qb_customers(), b.sf_accounts())
    assert ga.exceptAll(gb).count() == 0 and gb.count() == ga.count()


def test_suite_holds_every_declaration():
    """Counts of the declarations by kind; the two on quickbooks.bills, which no job reads, are not in the suite."""
    from collections import Counter

    from ledgerlake.plans.checks_suite import suite

    kinds = Counter(c.kind for checks in suite().values() for c in checks)
    assert kinds == {"not_null": 51, "unique": 25, "accepted_values": 12, "between": 8, "regex": 2, "row_count": 2,
                     "relationships": 1, "unique_combination": 1}


def test_foldable_checks_share_one_scan(spark, tmp_path):
    from ledgerlake.operators.checks import Check, run_model_checks

    spark.createDataFrame([(1, "a"), (None, "b")], "id int, kind string").write.parquet(str(tmp_path / "t"))
    checks = [Check("not_null", "id"), Check("accepted_values", "kind", {"values": ["a"]}), Check("between", "id", {"min": 0})]
    found = run_model_checks(spark, "t", spark.read.parquet(str(tmp_path / "t")), checks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert [(r["check"], r["failures"]) for r in found.collect()] == [("not_null", 1), ("accepted_values", 1), ("between", 0)]


LAND_SCHEMA = "id string, amount decimal(18,4), day date"


def land(spark, folder, files, target, at):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.writelines(x + "\n" for x in lines)
    return landing.land_files(spark, [os.path.join(folder, f) for f in files], LAND_SCHEMA, target, at, "plaid")


def test_landing_keeps_broken_lines_apart_with_their_file(spark, tmp):
    target, at = tmp + "/raw", [dt.datetime(2024, 1, d, 6) for d in (1, 2, 3)]
    ok = lambda i: json.dumps({"id": i, "amount": 1.25, "day": "2024-01-01"})
    got = land(spark, tmp + "/b0", {"a1.json": [ok("x"), '{"id": "cut', ok("y")], "a2.json": ['{"id": "t", "amount": "many"}', "", ok("z")]}, target, at[0])
    assert got == {"landed": 3, "quarantined": 2}
    rows = landing.read_landed(spark, target, LAND_SCHEMA).collect()
    assert sorted((r.id, os.path.basename(r._source_file)) for r in rows) == [("x", "a1.json"), ("y", "a1.json"), ("z", "a2.json")]
    assert {(r.amount, r._loaded_at, r._source_system) for r in rows} == {(Decimal("1.25"), at[0], "plaid")}
    bad = landing.read_quarantine(spark, target).collect()
    assert sorted((r._corrupt_record, os.path.basename(r._source_file)) for r in bad) == [
        ('{"id": "cut', "a1.json"), ('{"id": "t", "amount": "many"}', "a2.json")]
    # a batch of nothing changes nothing
    assert land(spark, tmp + "/b1", {"a1.json": []}, target, at[1]) == {"landed": 0, "quarantined": 0}
    # the next batch adds, and landing it again takes the place of the first try
    land(spark, tmp + "/b2", {"a1.json": [ok("p"), ok("q")]}, target, at[2])
    land(spark, tmp + "/b3", {"a1.json": [ok("p"), ok("q"), ok("r")]}, target, at[2])
    assert sorted(r.id for r in landing.read_landed(spark, target, LAND_SCHEMA).collect()) == ["p", "q", "r", "x", "y", "z"]
    assert landing.read_quarantine(spark, target).count() == 2


def test_a_batch_cut_off_leaves_no_half_of_itself(spark, tmp, monkeypatch):
    import pytest
    target, at = tmp + "/raw", dt.datetime(2024, 1, 1, 6)
    monkeypatch.setattr(landing, "publish_folders", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError):
        land(spark, tmp + "/b0", {"a.json": ['{"id": "x"}', "{"]}, target, at)
    monkeypatch.undo()
    assert land(spark, tmp + "/b1", {"a.json": ['{"id": "y"}']}, target, at) == {"landed": 1, "quarantined": 0}
    assert [r.id for r in landing.read_landed(spark, target, LAND_SCHEMA).collect()] == ["y"]
    assert landing.read_quarantine(spark, target).collect() == []


def test_suite_stores_only_what_several_scans_read(spark, monkeypatch):
    from ledgerlake.plans import checks_suite as cs
    from ledgerlake.plans.model import Model

    m, kept, real = Model.from_driver(spark, "/root/testdata/sf0.001", fresh=True), [], cs.cut
    monkeypatch.setattr(cs, "cut", lambda df: kept.append(df.columns) or real(df))
    got = cs.stored(m, cs.suite(m.p))
    assert kept == [["cash_flow_id", "cash_flow_date"], ["invoice_id", "aging_bucket", "total_amount", "balance_due"]]
    assert "fct_revenue" not in got.__dict__ and "utx_by_month" not in got.__dict__
    assert cs.columns_of(cs.suite(m.p)["fct_revenue"]) is None  # its conditions name other columns
