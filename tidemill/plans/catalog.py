"""Imports every module that registers queries."""

from . import boards, continuous, layers, prices, realtime, text  # noqa: F401
