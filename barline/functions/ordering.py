"""Order keys for "value at the latest (ts, tie)" aggregates.

``max_by(v, struct(ts, tie))`` is exact but its struct buffer forces
sort-based aggregation.  When the tie-breaker is integral the pair packs into
one DECIMAL(38,0) that orders identically — micros(ts)·10^20 + (tie + 2^63) —
and DECIMAL buffers are fixed-width, so the partial/final aggregate runs as a
hash aggregate.  micros(ts) is exact with the UTC session zone the library sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
KEY_TYPE = "decimal(38,0)"


def order_key(df: DataFrame, ts: str, tie: str | None) -> Column:
    """A single comparable key for (ts, tie) in ``df`` (packed when types allow)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if tie is None:
        return F.col(ts)
    if isinstance(types.get(ts), _TIMES) and isinstance(types.get(tie), _INTEGRAL):
        micros = F.unix_micros(F.col(ts).cast(T.TimestampType())).cast(KEY_TYPE)
        shifted = F.col(tie).cast(KEY_TYPE) + F.lit(str(2 ** 63)).cast(KEY_TYPE)
        return micros * F.lit(str(10 ** 20)).cast(KEY_TYPE) + shifted
    return F.struct(ts, tie)
