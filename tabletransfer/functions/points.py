"""Points as EWKB hex text and as display text. Arrow batches in, NumPy inside.

Spark has no function for the bits of a double, so these two are vectorised UDFs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

SRID = 4326

# Big-endian mark, type word of a 2D point with SRID.
_HEADER = "00" + "20000001"


def _hex_doubles(values: pd.Series) -> np.ndarray:
    """16 upper-case hex digits per double, big-endian."""
    raw = np.ascontiguousarray(values.to_numpy(dtype="float64", na_value=np.nan)).astype(">f8").tobytes()
    return np.frombuffer(raw.hex().upper().encode(), "S16").astype("U16").astype(object)


@F.pandas_udf(T.StringType())
def point_to_ewkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """EWKB hex (big-endian, SRID 4326) of a point; null if a coordinate is null."""
    text = pd.Series(f"{_HEADER}{SRID:08X}" + _hex_doubles(x) + _hex_doubles(y), dtype=object)
    text[(x.isna() | y.isna()).to_numpy()] = None
    return text


def _number(value: float) -> str:
    return str(int(value)) if value.is_integer() else repr(value)


def _point_text(code: str | None) -> str | None:
    """Display text of one EWKB or WKB point of either byte order; null if it is none."""
    try:
        raw = bytes.fromhex(code)
        order = ">" if raw[0] == 0 else "<"
        kind = int(np.frombuffer(raw, order + "u4", 1, 1)[0])
        body = 9 if kind & 0x20000000 else 5
        if kind & 0xFF != 1 or len(raw) < body + 16:
            return None
        x, y = np.frombuffer(raw, order + "f8", 2, body).tolist()
    except (TypeError, ValueError, IndexError):
        return None
    return f"POINT({_number(x)} {_number(y)})"


@F.pandas_udf(T.StringType())
def ewkb_to_text(code: pd.Series) -> pd.Series:
    """``POINT(x y)`` of EWKB hex."""
    return code.map(_point_text)
