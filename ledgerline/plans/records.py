"""Energy records: numbered list, append, delete, long form (survey P3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import relational as RL

MEASURES = ("consumption_eur", "consumption_sib", "price_eur", "price_sib")
STORED_ORDER = ("timestep",) + MEASURES


def with_ids(records: DataFrame) -> DataFrame:
    """ids 1..n in stored order."""
    return RL.with_row_id(records, list(STORED_ORDER), out="id")


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The new records get ids after the existing ones."""
    return RL.append_records(existing, new, list(STORED_ORDER))


def delete(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Delete by id (unknown id -> error), then renumber in stored order."""
    return RL.delete_records(records, ids)


def long_form(records: DataFrame, measures=MEASURES) -> DataFrame:
    """(timestep, variable, value) for the charts."""
    return RL.to_long(records, ["timestep"], list(measures), "variable", "value")


def minute_text(records: DataFrame) -> DataFrame:
    """The form's date and time fields combined to ``yyyy-MM-dd HH:mm``."""
    d = F.to_date("timestep").cast("string")
    t = F.date_format("timestep", "HH:mm")
    return records.select("timestep", S.combine_dt(d, t).alias("combined"))
