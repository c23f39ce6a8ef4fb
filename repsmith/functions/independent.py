"""Independent second implementations, for reconciliation only.

The native paths are Catalyst expressions (``scalars.to_local``, ``scalars.weight_lb``).
These recompute the same values with pandas / NumPy inside Arrow-batched pandas UDFs
(local time through the IANA database via ``zoneinfo``), so a wrong zone rule, session
setting or rounding rule in one path shows up as a difference. They never sit on a
production path.
"""

from __future__ import annotations

from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repsmith.functions._util import as_col, ColumnOrName


def local_parts_udf(tz: str):
    zone = ZoneInfo(tz)

    @F.pandas_udf("local_date date, local_hour long")
    def local_parts(ts: pd.Series) -> pd.DataFrame:
        t = pd.to_datetime(ts).dt.tz_localize("UTC").dt.tz_convert(zone)
        return pd.DataFrame({"local_date": t.dt.date, "local_hour": t.dt.hour.astype("Int64")})

    return local_parts


def local_parts_independent(ts_utc: ColumnOrName, tz: str) -> Column:
    """struct(local_date, local_hour) of a UTC instant (TIMESTAMP_NTZ read as UTC)."""
    return local_parts_udf(tz)(as_col(ts_utc).cast("timestamp_ntz"))


@F.pandas_udf(T.DoubleType())   # a type object: importing needs no active session
def weight_lb_independent(kg: pd.Series) -> pd.Series:
    """``round(kg * 2.20462, 2)`` half away from zero, computed by NumPy."""
    x = kg.to_numpy(dtype="float64", na_value=np.nan) * 2.20462
    return pd.Series(np.sign(x) * np.floor(np.abs(x) * 100.0 + 0.5) / 100.0)
