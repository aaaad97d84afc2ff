"""Daily snapshots of operational tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from rosterlake.operators.clean import snapshot_predicate
from rosterlake.operators.joins import member_rows
from rosterlake.operators.store import Change
from rosterlake.operators.writes import daily_slice

# Columns of the snapshots.
CONTRACT_COLUMNS = (
    "id", "type", "courier_id", "entity_id", "project_id", "region_id", "speciality_id", "start", "stop",
    "termin_date", "is_active", "is_handed_out", "created", "created_by", "changed", "changed_by",
    "client_doer_id",
)
COURIER_COLUMNS = (
    "id", "state", "paycard", "bank_acc", "corr_acc", "bic", "bank_name", "inn", "snils", "med_book",
    "med_book_checked", "medbook_expired", "dmr_card", "dmr_card_expired", "cant_be_selfempl",
    "salary_blocked", "is_in_fzhero", "qr_code_vac_checked",
)
WORKING = 1


def contract_slice(contracts: DataFrame, as_of: date, columns=CONTRACT_COLUMNS) -> DataFrame:
    """Active contracts, and inactive ones changed on the day before ``as_of``."""
    day = F.lit(as_of)
    kept = snapshot_predicate(F.col("is_active").cast("boolean"), F.col("changed"), F.date_sub(day, 1))
    return daily_slice(contracts.filter(kept), columns, day)


def courier_slice(couriers: DataFrame, states: DataFrame, as_of: date, columns=COURIER_COLUMNS) -> DataFrame:
    """Couriers whose state belongs to the working global state (``states``: id, global_id)."""
    working = states.filter(F.col("global_id") == WORKING).select(F.col("id").alias("state"))
    return daily_slice(member_rows(couriers, working, ["state"]), columns, F.lit(as_of))


def store_slice(change: Change, name: str, rows: DataFrame, as_of: date) -> int:
    """Put a day's slice into the stored slices, a partition per day; storing the day again replaces it, also by nothing."""
    change.create(name, rows.schema, "fix_date")
    return change.replace(name, rows, [str(as_of - timedelta(days=1))])["rows"]
