"""Right-closed bands: a label and a sort position per value."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..specs import INSTALLMENT_BANDS

Bands = list[tuple[float | None, str]]


def _pick(x: Column, bands: Bands, outcomes: list) -> Column:
    out = None
    for (upper, _), value in zip(bands, outcomes):
        hit = x.isNotNull() if upper is None else x <= upper
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def band_label(x: Column, bands: Bands) -> Column:
    return _pick(x, bands, [label for _, label in bands])


def band_order(x: Column, bands: Bands) -> Column:
    return _pick(x, bands, list(range(1, len(bands) + 1)))


def installment_band(installments: Column, method: Column, card: str = "credit_card") -> tuple[Column, Column]:
    """Label and order of the installment band.

    Other methods than a card share one label sorted last.  Without a method both are NULL.  A card order whose
    installments are unknown (or below one) has no label and sorts first, at 0.
    """
    known = F.when(installments > 0, installments)
    label = F.when(method == card, band_label(known, INSTALLMENT_BANDS)) \
        .when(method.isNotNull(), F.lit("Not credit card"))
    order = F.when(method == card, F.coalesce(band_order(known, INSTALLMENT_BANDS), F.lit(0))) \
        .when(method.isNotNull(), F.lit(9))
    return label, order
