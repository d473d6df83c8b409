"""Business parameters of the casework jobs.

Every threshold, code list and account number is data held here, so a job can
be re-parameterised without touching an operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
PLATFORM_NEW = "E1"
PLATFORM_LEGACY = "AS400"
PLATFORM_LEGACY_ADDRESS = "EC"

TEAM_CONTRACT = "CCT"
TEAM_POOL = "STRAT"
TEAM_VENDOR = "NM"

PREFIX_CONTRACT = "1"
PREFIX_POOL = "3"
PREFIX_VENDOR = "4"

COOL_DOWN_DAYS = {"CCT": 25, "NM": 90, "STRAT": 25}
COST_INCREASE_TYPES = ("CCI", "CCI/LM")
ACQUISITION_TYPES = ("CI", "CI/LM")
LOW_MARGIN_TYPES = ("LM",)
VARIABLE_COST_TYPES = ("VC",)

NEGATIVE_LOAD_CONTRACT = "MCKB-NEG-LD"
COST_INCREASE_LABEL = "CONTRACT -> ACQUISITION"
POOL_TYPES = ("3", "4", "5", "6", "7")
PLACEHOLDER_CONTRACTS = ("0", "/*", "*")
PLACEHOLDER_CONTRACTS_V2 = ("0", "/*")
ELIGIBLE_CUSTOMER_TYPES = ("S", "X", "B")
EXCLUDED_CODE = "E"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Parameters of the case batch."""

    top_contracts: int = 100
    top_customer_vendors: int = 10
    annual_factor: int = 4
    pool_cool_down_days: int = 25
    cool_down_days: dict[str, int] = field(default_factory=lambda: dict(COOL_DOWN_DAYS))
    cost_increase_types: tuple[str, ...] = COST_INCREASE_TYPES
    negative_load_contract: str = NEGATIVE_LOAD_CONTRACT
    pool_types: tuple[str, ...] = POOL_TYPES
    placeholder_contracts: tuple[str, ...] = PLACEHOLDER_CONTRACTS
    legacy_address_platform: str = PLATFORM_LEGACY_ADDRESS
    #: optional minimum summed impact per business platform, e.g. {"PC": 25000, "EC": 10000}
    min_case_impact: dict[str, float] | None = None
    #: False keeps SQL ``NOT IN`` semantics: one null pool in the cool-down
    #: window suppresses every pool case.
    ignore_null_pools: bool = False
    #: False formats membership dates as MM/DD/YYYY text before taking the
    #: maximum (text order); True takes the maximum of the dates.
    true_dates: bool = False
    #: False takes team, pool and case number from the price lines, so case
    #: lines without a price line carry nulls; True takes them from the case.
    assignment_from_cases: bool = False
    #: True adds the columns some reports read but the history list lacks.
    report_extras: bool = False
    #: True compares ship-to and item of the exclusion list one by one; False
    #: compares their joined text, in which 12 and 345 equal 123 and 45.
    composite_exclusion_keys: bool = False
    #: True takes the alternative price lines: minima over the case lines only,
    #: contract -1 on the older platform, customers of every platform.
    alternative_price_lines: bool = False
    #: True reads contract ids that are no number as 0 instead of failing.
    lenient: bool = False


@dataclass(frozen=True)
class ExceptionSettings:
    """Account, supplier and purchasing-group numbers of the category rules."""

    # --- fixed values -------------------------------------------------------
    amr_ship_tos: tuple[int, ...] = (184722, 187615, 207024, 207025, 472039, 583349)
    amr_gpo_nums: tuple[int, ...] = (4235270, 56376375)
    amr_gpo_name: str = "VIZIENT"
    focus_gpo_num: int = 4814241
    hierarchy_suppliers: tuple[int, ...] = (3885248, 3885225, 3885325, 3885330, 4047596)
    reverse_hierarchy_supplier: int = 4972445
    ranked_supplier: int = 487832
    single_source_suppliers: tuple[int, ...] = (
        54783837, 487869, 3743722, 3884423, 488167, 1637149, 488246, 4098908, 3884389, 4155201,
        487995, 3884679, 488212, 4852147, 1614270, 3884906, 3932524, 3884909, 3885097, 488061,
        4972445, 488074, 488189, 55804098, 488193, 3883899, 3884091, 488026, 487756, 4301677,
        3884226, 488179, 488180, 57696895, 487778, 3885325, 3885328, 3885327, 3885330,
    )
    negative_load_contract: str = NEGATIVE_LOAD_CONTRACT
    loaded_margin_cut: float = 0.10
    # ------------------------------------------------------------------------
