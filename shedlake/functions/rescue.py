"""Rescue: keep whatever a contract cannot hold, as JSON beside the row it came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.contracts import OPERATIONAL, RESCUED, FeedContract
from shedlake.functions.columns import fit, quoted

CORRUPT = "_corrupt_record"
FIT = "__fit_"


def rescue(df: DataFrame, contract: FeedContract) -> DataFrame:
    """Narrow text columns to the contract and fold everything else into the rescue column.

    Rescued are: a value that its contract type cannot represent, every value of a column that
    the contract neither knows nor passes through, and the full line of a record with more fields than its header.
    The schema therefore never widens and no input value is lost. Rows with nothing to rescue
    get null, and only rows with something to rescue pay for building the JSON.
    """
    rule_of = {}
    for rule in contract.columns:
        source = rule.pick(df.columns)
        if source is not None:
            rule_of[source] = rule

    # Casts are done once, in a projection of their own; what follows only compares with null.
    fits = {
        FIT + name: F.when(fit(df, name, rule.type).isNotNull(), F.col(quoted(name))) for name, rule in rule_of.items()
    }
    by_lower = {c.lower(): c for c in df.columns if c not in rule_of}
    passing = {name: by_lower.get(name.lower()) for name in contract.pass_through}
    checked = df.select("*", *(value.alias(name) for name, value in fits.items()))
    rescued = []
    for name in df.columns:
        value = F.col(quoted(name))
        if name in rule_of:
            rescued.append(F.when(F.col(quoted(FIT + name)).isNull(), value).alias(name))
        elif name not in OPERATIONAL and name not in passing.values():
            rescued.append(value.alias(name))

    if rescued:
        found = reduce(lambda a, b: a | b, (c.isNotNull() for c in rescued))
        payload = F.when(found, F.to_json(F.struct(*rescued)))
    else:
        payload = F.lit(None).cast("string")
    source_of = {rule.name: name for name, rule in rule_of.items()}
    kept = [
        (F.col(quoted(FIT + source_of[r.name])) if r.name in source_of else F.lit(None).cast("string")).alias(r.raw_name)
        for r in contract.columns
    ]
    kept += [
        (F.lit(None).cast("string") if source is None else F.col(quoted(source))).alias(name)
        for name, source in passing.items()
    ]
    stamps = [F.col(c) for c in OPERATIONAL if c in df.columns and c != RESCUED]
    return checked.select(*kept, *stamps, payload.alias(RESCUED))
