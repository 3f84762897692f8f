"""The handler registry, re-aimed at data. The reference maps an action name to a function that
runs a host tool; here each audit domain maps to the DataFrame functions that analyse its records:
a parser (text or snapshot -> facts), the ordered checks, and the gauge families."""

from __future__ import annotations

from fleetlens.operators import admin as AD
from fleetlens.operators import audits as AU
from fleetlens.operators import mac as MAC

AUDITS = {
    "vps_host_audit": {"analyze": lambda logs: AU.analyze(logs, AU.vps_findings), "gauges": AU.vps_gauges},
    "monitoring_stack_audit": {"analyze": lambda logs: AU.analyze(logs, AU.stack_findings),
                               "gauges": AU.stack_gauges},
    "admin_host_audit": {"analyze": AD.analyze_admin, "gauges": AD.admin_gauges},
    "mac_host_audit": {"analyze": MAC.analyze_snapshots, "gauges": MAC.mac_gauges},
}


def analyze(domain: str, records):
    """Run a domain's analysis over a DataFrame of its records (logs or snapshots)."""
    return AUDITS[domain]["analyze"](records)
