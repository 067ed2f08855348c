"""Entity resolution (M14) on the sample entity map plus edge rows."""

import datetime as dt

from ledgerlake.plans import intermediate

T0 = dt.datetime(2024, 1, 1)

STRIPE = ("stripe_customer_id string, quickbooks_customer_id string, netsuite_customer_id string, "
          "salesforce_account_id string, customer_name string, email string, phone string, address_line1 string, "
          "city string, state string, postal_code string, country string, is_delinquent boolean, "
          "created_at timestamp")
QB = ("customer_id string, company_name string, first_name string, last_name string, email string, phone string, "
      "billing_address_line1 string, billing_city string, billing_state string, billing_postal_code string, "
      "billing_country string, is_active boolean, created_at timestamp, updated_at timestamp")
SF = ("sf_account_id string, company_name string, phone string, website string, billing_street string, "
      "billing_city string, billing_state string, billing_postal_code string, billing_country string, "
      "industry string, annual_revenue decimal(18,4), employee_count bigint, account_type string, "
      "created_at timestamp, updated_at timestamp")


def s_row(sid, qb=None, sf=None, name=None, email=None, created=T0):
    return (sid, qb, None, sf, name, email, None, None, None, None, None, None, False, created)


def q_row(cid, email=None, first=None, company=None):
    return (cid, company, first, None, email, "555", None, "QBCity", None, None, None, True, T0, T0)


def f_row(sid, company):
    return (sid, company, None, None, None, "SFCity", None, None, None, "Tech", None, None, "Direct", T0, T0)


def build(spark, stripe, qb, sf, **kw):
    return intermediate.golden_customers(spark.createDataFrame(stripe, STRIPE), spark.createDataFrame(qb, QB),
                                         spark.createDataFrame(sf, SF), **kw).collect()


def test_sample_entity_map(spark):
    stripe = [s_row("cus_stripe_001", "QB-CUST-1001", "001SF00000A001", "Acme Corporation"),
              s_row("cus_stripe_004", None, "001SF00000A004", "Umbrella Corp")]
    qb = [q_row("QB-CUST-1001", company="Acme QB")]
    sf = [f_row("001SF00000A001", "Acme Corporation (SF)"), f_row("001SF00000A004", "Umbrella")]
    out = {r.stripe_customer_id: r for r in build(spark, stripe, qb, sf)}
    acme = out["cus_stripe_001"]
    assert acme.company_name == "Acme Corporation (SF)"  # Salesforce first
    assert acme.primary_source == "salesforce" and acme.is_multi_source_match
    assert acme.billing_city == "SFCity" and acme.phone == "555"  # phone: QB before SF
    assert out["cus_stripe_004"].quickbooks_customer_id is None
    assert out["cus_stripe_004"].is_active_accounting  # no QB row -> true


def test_email_match_fans_out_and_normalises(spark):
    stripe = [s_row("cus_1", name="Ann Lee Park", email="ann@ex.com"),      # not cross-referenced
              s_row("cus_2", qb="QB-2", name="Mono", email="mono@ex.com")]
    qb = [q_row("QB-1", email="  ANN@EX.COM "),       # case and space variant -> matches cus_1
          q_row("QB-3", email="ann@ex.com"),           # second QB customer with the same email
          q_row("QB-2", email="mono@ex.com"),          # referenced by Stripe metadata -> excluded (NOT IN)
          q_row(None, email="ann@ex.com"),             # NULL id: NOT IN drops it
          q_row("QB-4", email=None)]
    rows = build(spark, stripe, qb, [])
    by_stripe = {}
    for r in rows:
        by_stripe.setdefault(r.stripe_customer_id, []).append(r)
    # cus_1: its own cross-ref row + two email matches (fan-out kept, as in the reference)
    assert sorted(r.quickbooks_customer_id or "-" for r in by_stripe["cus_1"]) == ["-", "QB-1", "QB-3"]
    assert len({r.customer_golden_id for r in by_stripe["cus_1"]}) == 3
    assert [r.quickbooks_customer_id for r in by_stripe["cus_2"]] == ["QB-2"]
    matched = [r for r in by_stripe["cus_1"] if r.quickbooks_customer_id == "QB-1"][0]
    assert matched.email == "ann@ex.com"               # lower(trim()) of the QB email
    lone = [r for r in by_stripe["cus_1"] if r.quickbooks_customer_id is None][0]
    assert (lone.first_name, lone.last_name) == ("Ann", "Lee")
    assert lone.primary_source == "stripe" and not lone.is_multi_source_match


def test_blank_emails_match_like_others_unless_asked(spark):
    stripe = [s_row("cus_a", email="  "), s_row("cus_b", email="")]
    qb = [q_row("QB-a", email=" "), q_row("QB-b", email="")]
    assert len(build(spark, stripe, qb, [], match_blank_emails=False)) == 2
    assert len(build(spark, stripe, qb, [])) == 2 + 4  # every blank pairs with every blank


def test_one_word_name_and_sentinel_timestamps(spark):
    rows = build(spark, [s_row("cus_m", name="Mono", created=None)], [], [])
    r = rows[0]
    assert (r.first_name, r.last_name) == ("Mono", None)
    assert r.first_seen_at == dt.datetime(2099, 1, 1) and r.updated_at == dt.datetime(2000, 1, 1)
