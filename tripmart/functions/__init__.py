"""Scalar column expressions (built-in Spark functions only)."""

from tripmart.functions.exprs import *  # noqa: F401,F403
