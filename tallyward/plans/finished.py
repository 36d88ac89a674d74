"""Finished sheets: every report under its display names, ready for ``write_report``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyward.functions.labels import (
    ACTIVITY_NAMES,
    CHARGE_NAMES,
    DENSE_THRESHOLD_NAMES,
    DETAIL_NAMES,
    INDICATOR_NAMES,
    INQUIRY_NAMES,
    ONLINE_NAMES,
    PAYMENT_NAMES,
    THRESHOLD_NAMES,
)
from tallyward.operators.frames import fill_nulls, with_display_names
from tallyward.plans.orders import INQUIRY_GROUP, ONLINE_GROUP, order_sheets
from tallyward.plans.threshold import Threshold, threshold_sheets
from tallyward.sources.reports import Sheet


def finished(sheets: Mapping[str, Sheet], names: Mapping[str, Mapping[str, str]], parity_nulls: bool = False) -> dict[str, Sheet]:
    """The sheets with display names; sheets made of others still see those under the engine's names.

    With ``parity_nulls`` null texts read ``0`` and null numbers are 0; null times stay null.
    """

    def finish(name: str, frame: DataFrame) -> DataFrame:
        return with_display_names(fill_nulls(frame, "0") if parity_nulls else frame, names[name])

    def derived(name: str, build) -> Sheet:
        def of_written(written: dict[str, DataFrame]) -> DataFrame:
            plain = {n: with_display_names(f, {shown: c for c, shown in names[n].items()}) for n, f in written.items()}
            return finish(name, build(plain))

        return of_written

    return {
        name: finish(name, sheet) if isinstance(sheet, DataFrame) else derived(name, sheet) for name, sheet in sheets.items()
    }


def payment_sheets(report: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``payment_methods`` or ``sheet_by_method``."""
    return finished({"payments": report}, {"payments": PAYMENT_NAMES}, parity_nulls)


def charge_sheets(report: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``charge_categories``."""
    return finished({"charges": report}, {"charges": CHARGE_NAMES}, parity_nulls)


def indicator_sheets(reports: Mapping[str, DataFrame], parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``summary_sheets``: one per role."""
    return finished(reports, dict.fromkeys(reports, INDICATOR_NAMES), parity_nulls)


def inquiry_sheets(listed: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``inquiry_orders``: the list and its sums."""
    sheets = order_sheets(listed, INQUIRY_GROUP)
    return finished(sheets, dict.fromkeys(sheets, INQUIRY_NAMES), parity_nulls)


def online_sheets(listed: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``online_orders``: the list and its sums."""
    sheets = order_sheets(listed, ONLINE_GROUP)
    return finished(sheets, dict.fromkeys(sheets, ONLINE_NAMES), parity_nulls)


def activity_sheets(report: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``doctor_activity``."""
    return finished({"activity": report}, {"activity": ACTIVITY_NAMES}, parity_nulls)


def reached_sheets(
    tables: Mapping[str, DataFrame], wanted: Threshold, *, parity: bool = False, parity_nulls: bool = False
) -> dict[str, Sheet]:
    """Of ``threshold_sheets``: who reached the threshold, the summary without ids, and the patients."""
    names = {"reached": THRESHOLD_NAMES, "summary": THRESHOLD_NAMES, "detail": DETAIL_NAMES}
    return finished(threshold_sheets(tables, wanted, parity=parity), names, parity_nulls)


def dense_sheets(report: DataFrame, parity_nulls: bool = False) -> dict[str, Sheet]:
    """Of ``dense_nth_registration``."""
    return finished({"reached": report}, {"reached": DENSE_THRESHOLD_NAMES}, parity_nulls)
