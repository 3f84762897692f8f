"""Import every plan module so the registry is complete."""

from __future__ import annotations

from fleetlens.plans import (  # noqa: F401
    admin_queries,
    artifact_queries,
    audit_queries,
    chain_queries,
    contract_queries,
    document_queries,
    mac_queries,
    metric_queries,
    output_queries,
    queue_queries,
    registry_queries,
    scalar_queries,
    schedule_queries,
    signal_queries,
    series_queries,
    sink_queries,
    stream_queries,
    timeseries_queries,
    verify_queries,
    weekly_queries,
)
from fleetlens.plans.registry import ORACLE, QUERIES
from fleetlens.plans.schedule_queries import FIRED_SQL

ORACLE["_fired_slot_keys"] = "WITH " + FIRED_SQL + " SELECT schedule_name, slot_key FROM fired"
stream_queries.register_shared_oracles()
del ORACLE["_fired_slot_keys"]

__all__ = ["ORACLE", "QUERIES"]
