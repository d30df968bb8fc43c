"""Client ranking by number of devices (J13, A1, W2, O1, O2) and top talkers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import lookup_join, running_totals
from opstelemetry.operators.filters import between_open


def client_rollup(customer: DataFrame, bus_parent: DataFrame) -> DataFrame:
    """Devices under the client that stands for them: the parent if there is one.

    A client with several parents takes the first in order of id.
    """
    parents = bus_parent.groupBy("HIER_BUS_ID").agg(F.min("PARENT_BUS_ID").alias("PARENT_BUS_ID"))
    rows = lookup_join(customer, parents, {"BUS_ID": "HIER_BUS_ID"}, "left")
    return rows.select(
        F.coalesce("PARENT_BUS_ID", "BUS_ID").alias("NEW_BUS_ID"), "RECONCILIATION_ID"
    )


def device_count(
    df: DataFrame, client: str = "NEW_BUS_ID", device: str = "RECONCILIATION_ID"
) -> DataFrame:
    """A1: known devices per known client."""
    return (
        df.where(F.col(client).isNotNull())
        .groupBy(F.col(client).alias("NEW_BUS_ID"))
        .agg(F.count(device).alias("RECONCILIATION_NUM"))
    )


def client_rank(counts: DataFrame) -> DataFrame:
    """Share, cumulative share and rank of clients, most devices first.

    Clients with equal counts come in order of the MD5 of their id. One running total over the range-sorted
    clients gives all three, whatever their number and however many have equal counts.
    """
    spread = F.md5(F.col("NEW_BUS_ID").cast("string"))
    ranked = running_totals(
        counts,
        {"__rank": F.lit(1), "__upto": F.col("RECONCILIATION_NUM")},
        order=[F.desc("RECONCILIATION_NUM"), spread, F.col("NEW_BUS_ID")],
    )
    return ranked.select(
        "NEW_BUS_ID",
        "RECONCILIATION_NUM",
        (F.lit(100.0) * F.col("RECONCILIATION_NUM") / F.col("__upto_all")).alias("PERCENT"),
        (F.lit(100.0) * F.col("__upto") / F.col("__upto_all")).alias("CUMULATIVE_PERCENT"),
        F.col("__rank").alias("RANK"),
    )


def top_clients(ranked: DataFrame, n: int = 150) -> DataFrame:
    """O2: the n clients with most devices."""
    return ranked.where(F.col("RANK") <= n)


def top_talkers(
    incidents: DataFrame,
    start: int,
    end: int,
    n: int = 20,
    device: str = "RECON_ID_INC",
    submitted: str = "SUBMIT_DATE_NUM",
) -> DataFrame:
    """Devices with most incidents strictly inside the window; ties by id."""
    return (
        incidents.where(between_open(submitted, start, end))
        .groupBy(F.col(device).alias("recon_id"))
        .agg(F.count(F.lit(1)).alias("incident_count"))
        .orderBy(F.desc("incident_count"), "recon_id")
        .limit(n)
    )
