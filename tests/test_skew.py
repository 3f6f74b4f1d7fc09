"""Hot keys: one client / policy holding a third of all rows."""

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from lapsewise.operators.dedup import first_wins
from lapsewise.plans import models


def test_claims_summary_with_hot_client_and_policy(spark):
    rnd = random.Random(1)
    policies = [(p, 1 if p < 40 else 2 + p % 50, f"prod_{p % 7}") for p in range(400)]
    facts = []
    for i in range(30000):
        # a third of all rows belong to policy 0 (client 1); client 1 owns 40 policies
        p = 0 if i % 3 == 0 else rnd.randrange(400)
        facts.append((p, dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(100)),
                      Decimal(rnd.randrange(1, 10**6)).scaleb(-2), rnd.choice(["Lapsed", "Active", "Pending"])))
    fact = spark.createDataFrame(facts, "policy_id long, lapse_date date, premium_amount decimal(10,2), status string").repartition(8)
    policy = spark.createDataFrame(policies, "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame([(c, float(c), False, "X") for c in range(1, 60)],
                                     "client_id long, income double, income_was_imputed boolean, province string")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.client_id: r for r in models.patient_claims_summary(fact, policy, patients).collect()}
    finally:
        for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    owner = {p: (c, prod) for p, c, prod in policies}
    agg = defaultdict(list)
    for p, d, amt, s in facts:
        agg[owner[p][0]].append((p, d, amt, s, owner[p][1]))
    assert set(got) == set(agg)
    for c, rows in agg.items():
        r = got[c]
        total = sum(x[2] for x in rows)
        assert r.total_claims == len(rows) and r.total_premiums == total
        assert r.total_policies == len({x[0] for x in rows})
        assert r.distinct_products == len({x[4] for x in rows})
        assert r.avg_premium == (total / len(rows)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        lapsed = sum(x[3] == "Lapsed" for x in rows)
        assert r.lapsed_count == lapsed
        assert r.lapse_rate_pct == (Decimal(100 * lapsed) / len(rows)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.min_premium == min(x[2] for x in rows) and r.latest_claim_date == max(x[1] for x in rows)


def test_summary_aggregates_fact_before_the_join(spark):
    fact = spark.createDataFrame([(1, dt.date(2024, 1, 1), Decimal("1.00"), "Active")],
                                 "policy_id long, lapse_date date, premium_amount decimal(10,2), status string")
    policy = spark.createDataFrame([(1, 1, "p")], "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame([(1, 1.0, False, "X")], "client_id long, income double, income_was_imputed boolean, province string")
    plan = models.patient_claims_summary(fact, policy, patients)._jdf.queryExecution().optimizedPlan().toString()
    # the first join below the top one consumes an Aggregate over the fact, not raw fact rows
    joins = plan.split("Join Inner")
    assert len(joins) >= 3
    assert "Aggregate [policy_id" in plan


def test_first_wins_hot_key_equals_reference(spark):
    rnd = random.Random(9)
    rows = [(0 if i % 3 == 0 else rnd.randrange(1000), rnd.randrange(10**6), i) for i in range(30000)]
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(8)
    got = {r.k: (r.o, r.v) for r in first_wins(df, ["k"], ["o", "v"]).collect()}
    best = {}
    for k, o, v in rows:
        if k not in best or (o, v) < best[k]:
            best[k] = (o, v)
    assert got == best
