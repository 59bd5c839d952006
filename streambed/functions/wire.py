"""The framed message format of the change topics.

A frame is one zero byte, four big-endian bytes of schema id, then the payload.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: bytes before the payload.
HEADER_BYTES = 5


def frame_payload(value: Column) -> Column:
    """The bytes after the header; empty for a frame too short to hold one."""
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.greatest(F.length(value) - HEADER_BYTES, F.lit(0)))


def frame_schema_id(value: Column) -> Column:
    """Schema id of a whole frame, null for a short one."""
    return F.when(
        F.length(value) >= HEADER_BYTES,
        F.conv(F.hex(F.substring(value, F.lit(2), F.lit(4))), 16, 10).try_cast("int"),
    )


def frame(schema_id: int, payload: Column) -> Column:
    """Wrap a text payload; used to write test topics and to feed the stream from tables."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), F.encode(payload, "UTF-8"))
