"""Curation of marketing and event reports with Spark DataFrames."""

from reportmill.plans.curate import curate_frame, curate_report
from reportmill.plans.family import run_family, run_report
from reportmill.plans.spend import spend_summary, summarize_spend
from reportmill.plans.warehouse import load_report
from reportmill.session import build_session, session_conf
from reportmill.spec import REPORTS, ReportSpec
from reportmill.streaming.incremental import curate_new_files

__all__ = [
    "REPORTS",
    "ReportSpec",
    "build_session",
    "curate_frame",
    "curate_new_files",
    "curate_report",
    "load_report",
    "run_family",
    "run_report",
    "session_conf",
    "spend_summary",
    "summarize_spend",
]
