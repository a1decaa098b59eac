from __future__ import annotations

from pyspark.sql import Column, functions as F

from cartwheel.schemas import GBP_TO_KRW, KRW_STEP


def to_step(amount: Column, step: int = KRW_STEP) -> Column:
    """Nearest multiple of ``step``; a tie goes to the even multiple (``rint``)."""
    return (F.rint(amount / step) * step).cast("long")


def gbp_to_krw(price: Column) -> Column:
    return (F.rint(price * GBP_TO_KRW / KRW_STEP) * KRW_STEP).cast("long")


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def purchase_price(event_type: Column, price: Column) -> Column:
    """Price of a purchase, 0.0 for any other event; sums to revenue."""
    return F.when(event_type == "purchase", price).otherwise(F.lit(0.0))
