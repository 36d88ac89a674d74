"""Business reports for service chains, written as PySpark DataFrame jobs."""

from tallyward.period import Period, period_for

__all__ = ["Period", "period_for"]
