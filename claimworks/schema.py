"""Column roles of a claims table.

Every operator takes its columns from a :class:`TableSpec`, so the cleaning, quality, publish and
reconcile jobs work on any monthly table; ``CLAIMS`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: column names, code lists and formats of the source files -----------------
CODES = (
    "FLX_ANN_MOI", "BEN_RES_REG", "AGE_BEN_SNDS", "BEN_SEX_COD", "PRS_NAT",
    "PRS_REM_TYP", "SOI_ANN", "SOI_MOI", "TOP_PS5_TRG",
)
MONEY = (
    "PRS_DEP_MNT", "PRS_PAI_MNT", "PRS_REM_BSE", "PRS_REM_MNT",
    "FLT_PAI_MNT", "FLT_DEP_MNT", "FLT_REM_MNT",
)
VOLUMES = (
    "PRS_ACT_COG", "PRS_ACT_NBR", "PRS_ACT_QTE", "FLT_ACT_COG", "FLT_ACT_NBR", "FLT_ACT_QTE",
)
RATES = ("PRS_REM_TAU",)
KNOWN_REIMBURSEMENT_TYPES = ("0", "1", "2", "3", "4", "5", "6", "7", "10", "11", "12", "13")
LEGAL_PART_TYPES = ("0", "1")
UNKNOWN_CODE = "99"
RESERVED_BLANK_NAME = "__empty_column__"
# Names the package gives to columns of its own; a source column called so is refused.
RESERVED_NAMES = (RESERVED_BLANK_NAME, "_malformed", "_defects", "month", "run", "unreadable")
FIRST_SUPPORTED_YEAR = 2015
AMOUNT_TYPE = "decimal(24,6)"
TOTAL_TYPE = "decimal(38,6)"
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Roles the columns of a monthly table play."""

    month: str = "FLX_ANN_MOI"
    codes: tuple[str, ...] = CODES
    money: tuple[str, ...] = MONEY
    volumes: tuple[str, ...] = VOLUMES
    rates: tuple[str, ...] = RATES
    never_null: tuple[str, ...] = ("FLT_REM_MNT", "FLT_PAI_MNT", "PRS_NAT", "BEN_RES_REG")

    @property
    def numeric(self) -> tuple[str, ...]:
        return (*self.money, *self.volumes, *self.rates)

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.codes, *self.numeric)


CLAIMS = TableSpec()


class StructureError(ValueError):
    """The layout of a file or table breaks the input contract."""


def check_required(columns: list[str], spec: TableSpec = CLAIMS) -> None:
    """Raise when a required column is absent, naming all absent ones in order."""
    missing = sorted(set(spec.required) - set(columns))
    if missing:
        raise StructureError(f"required columns missing: {', '.join(missing)}")
