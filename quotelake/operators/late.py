"""Quotes that a stream left behind its watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.silver import to_silver
from quotelake.schema import SILVER_KEY


def lost_quotes(bronze: DataFrame, silver: DataFrame, clock: Column | None = None) -> DataFrame:
    """Silver rows that the stored Bronze asks for and the stored Silver lacks.

    Both tables are batches, and the Silver stream has read all of these Bronze rows. They
    are accepted and reduced as in ``to_silver``; what has no Silver row of its key was late.
    A null price or time is never accepted, so plain equality of the keys is enough.
    """
    return to_silver(bronze, clock=clock).join(
        silver.select(*SILVER_KEY), list(SILVER_KEY), "left_anti")
