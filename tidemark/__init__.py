"""Tidemark: daily-panel analytics as Spark DataFrame operators."""

from pyspark import cloudpickle

from tidemark.functions import peaks, tdist
from tidemark.spec import EPIDEMIC, PanelSpec

# The few functions that run in Python workers travel with the task, so executors need no install.
for module in (peaks, tdist):
    cloudpickle.register_pickle_by_value(module)

__all__ = ["EPIDEMIC", "PanelSpec"]
