from reportmill.sources.curated import scan_curated, scan_partitions
from reportmill.sources.delimited import (
    first_file,
    report_path,
    scan_delimited,
    scan_delimited_groups,
    stream_delimited,
)
from reportmill.sources.payloads import checked_payload, parse_payloads, scan_payloads

__all__ = [
    "checked_payload",
    "first_file",
    "parse_payloads",
    "report_path",
    "scan_curated",
    "scan_partitions",
    "scan_delimited",
    "scan_delimited_groups",
    "scan_payloads",
    "stream_delimited",
]
