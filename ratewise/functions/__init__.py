"""Scalar expressions."""

from ratewise.functions.scalars import *  # noqa: F401,F403
