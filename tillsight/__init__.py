"""Merchant behaviour analytics on Spark: three detection rules over card transactions."""

from tillsight.plans.detect import detect
from tillsight.settings import Clock, Options, Thresholds
from tillsight.workspace import Workspace

__all__ = ["Clock", "Options", "Thresholds", "Workspace", "detect"]
