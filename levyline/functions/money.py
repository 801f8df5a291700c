"""Money aggregates that do not depend on the order in which partial sums arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from levyline.functions.text import col

CENTS = "decimal(28,6)"  # 22 digits before the point; sums of it are exact, too


def money_sum(amount) -> Column:
    """Exact sum. A double sum would change with the number of tasks. What is no number counts as missing."""
    return F.sum(col(amount).try_cast(CENTS))


def exact_mean(total, n) -> Column:
    """Mean from an exact sum and a count; NULL for an empty group."""
    return F.try_divide(col(total).cast("double"), col(n).cast("double"))


def money_mean(amount) -> Column:
    return exact_mean(money_sum(amount), F.count(col(amount).try_cast(CENTS)))


def ratio_rounded(part, whole, digits: int) -> Column:
    """part / whole rounded half up on the decimal quotient, so that binary ties cannot differ."""
    quotient = F.try_divide(col(part).cast("decimal(28,2)"), col(whole).cast("decimal(18,0)"))
    return F.round(quotient, digits).cast("double")


def fraud_rows(flag="is_fraud") -> Column:
    return F.count_if(F.coalesce(col(flag), F.lit(False)))
