from eventmart.plans.flow import Layout, Masters, read_masters, run
from eventmart.plans.intake import Intake, check_files, stage, staged_rows, take_in
from eventmart.plans.landing import fresh_rows, gate_feeds, land, landed, rebuild
from eventmart.plans.normalize import (
    normalize_events,
    normalize_expenses,
    normalize_participants,
)
from eventmart.plans.outbound import export_latest
from eventmart.plans.summarize import MART_DIMENSIONS, build_marts

__all__ = [
    "Intake",
    "Layout",
    "MART_DIMENSIONS",
    "Masters",
    "build_marts",
    "check_files",
    "export_latest",
    "fresh_rows",
    "gate_feeds",
    "land",
    "landed",
    "normalize_events",
    "normalize_expenses",
    "normalize_participants",
    "read_masters",
    "rebuild",
    "run",
    "stage",
    "staged_rows",
    "take_in",
]
