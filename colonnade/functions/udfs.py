"""User-defined functions, built when called because they need a running session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


def decade_udf():
    @F.pandas_udf("int")
    def decade(s: pd.Series) -> pd.Series:
        return (10 * (s // 10)).astype("int32")

    return decade


def damped_wave_udf():
    @F.pandas_udf("double")
    def damped_wave(distance: pd.Series, phase: pd.Series) -> pd.Series:
        import numpy as np

        return np.exp(-distance / 20) * np.sin(distance / 3 + phase)

    return damped_wave


def windows_udtf():
    @F.udtf(returnType="start int, stop int")
    class Windows:
        """Overlapping windows of a length over a sequence of ``n`` items."""

        def eval(self, n: int, width: int, step: int):
            for start in range(0, max(n - width, 0) + 1, step):
                yield start, min(start + width, n)

    return Windows
