"""Wavelane: many-channel signal monitoring on Spark DataFrames."""

from wavelane.params import MonitorParams
from wavelane.session import build_session, configure

__all__ = ["MonitorParams", "build_session", "configure"]
