"""Gold: hourly join and daily averages over folded feeds."""

from __future__ import annotations

from shedlake.operators.activity import aggregate_activity, join_activity
from shedlake.plans.oracle import gold
from shedlake.plans.queries.inputs import silver_of
from shedlake.plans.registry import query


@query(gold("SELECT * FROM hourly"))
def gold_hourly(spark, sf_dir):
    return join_activity(silver_of(spark, sf_dir, "environmental"), silver_of(spark, sf_dir, "camera"))


@query(gold("SELECT * FROM daily"))
def gold_daily(spark, sf_dir):
    """Flagship: two feeds folded by key, joined per hour, averaged per day."""
    return aggregate_activity(gold_hourly(spark, sf_dir))
