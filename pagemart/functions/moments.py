"""(time, id) pairs as one sortable number.

Aggregates over numbers are hashed, those over structs sort all rows by the group key first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# More than the number of bigint values, so ids of one time never reach into the next.
_WIDTH = "cast(20000000000000000000 as decimal(20,0))"
_LOWEST_ID = "cast(-9223372036854775808 as decimal(19,0))"


def moment(time: Column, row_id: Column) -> Column:
    """Sorts as (time, id) does; a NULL time comes first."""
    micros = F.coalesce(F.unix_micros(time), F.lit(-62135596800000000)).cast("decimal(17,0)")
    return (micros * F.expr(_WIDTH) + (row_id.cast("decimal(19,0)") - F.expr(_LOWEST_ID))).cast("decimal(38,0)")


def id_of(moment_: Column) -> Column:
    return (F.pmod(moment_, F.expr(_WIDTH)) + F.expr(_LOWEST_ID)).cast("bigint")
