"""Domain constants and typed configuration.

Values in the FIXED VALUES block must equal the source system's for results
to agree; they are written out plainly, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source system)
# ---------------------------------------------------------------------------

# Subcategory dimension: id -> (category, module, label).
SUBCATEGORIES: list[tuple[int, str, str, str]] = [
    (1, "NADI4U", "Entrepreneur", "NADI4U-Entrepreneur"),
    (2, "NADI4U", "LifelongLearning", "NADI4U-LifelongLearning"),
    (3, "NADI4U", "Wellbeing", "NADI4U-Wellbeing"),
    (4, "NADI4U", "Awareness", "NADI4U-Awareness"),
    (5, "NADI4U", "GovInit", "NADI4U-GovInit"),
    (6, "NADI2U", "Entrepreneur", "NADI2U-Entrepreneur"),
    (7, "NADI2U", "LifelongLearning", "NADI2U-LifelongLearning"),
    (8, "NADI2U", "Wellbeing", "NADI2U-Wellbeing"),
    (9, "NADI2U", "Awareness", "NADI2U-Awareness"),
    (10, "NADI2U", "GovInit", "NADI2U-GovInit"),
    (11, "OTHERS", "Activity", "OTHERS-Activity"),
    (12, "OTHERS", "Training", "OTHERS-Training"),
    (13, "OTHERS", "Services", "OTHERS-Services"),
]

# Subcategories the dashboard serves by default.
ACTIVE_SUBCATEGORIES: tuple[int, ...] = (1, 2, 3, 4, 8)

# Event statuses excluded from every extract (default of the three variants).
EXCLUDED_STATUSES: tuple = (1, 7, 10)

# Lifelong-learning keyword classifier: ordered (pattern, label), first match
# wins, matched against the lower-cased text; anything else gets the default.
LL_RULES: list[tuple[str, str]] = [
    ("skillforge|skill", "ESPORT"),
    ("cyber|siber|security", "CYBERSECURITY"),
    ("ekelas|e-kelas", "EKELAS"),
    ("tuisyen|tuition|guidance", "TUISYEN RAKYAT"),
    ("mahir", "MAHIR"),
    ("esport", "ESPORT"),
    ("tiny|techie", "TINYTECHIES"),
]
LL_DEFAULT = "CYBERSECURITY"
LL_GROUPS: list[str] = ["CYBERSECURITY", "EKELAS", "TUISYEN RAKYAT", "ESPORT", "MAHIR", "TINYTECHIES"]

# States of the state x month report, in report row order.
REPORT_STATES: list[str] = [
    "JOHOR", "KEDAH", "KELANTAN", "MELAKA", "NEGERI SEMBILAN",
    "PAHANG", "PERAK", "PERLIS", "PULAU PINANG", "SABAH",
    "SARAWAK", "SELANGOR", "TERENGGANU", "W.P KUALA LUMPUR",
    "W.P LABUAN", "W.P PUTRAJAYA",
]

# Gender value counted as "women"; text values read as true.
WOMEN_VALUE = "Perempuan"
TRUTHY_VALUES: tuple[str, ...] = ("true", "1", "t", "yes")

# Age bands (inclusive youth band, strict upper bound for children).
YOUTH_MIN, YOUTH_MAX, CHILD_MAX = 15, 24, 12

# Week-of-month bins: (0,7] (7,14] (14,21] (21,31].
WEEK_OF_MONTH_EDGES: list[tuple[int, str]] = [(7, "W1"), (14, "W2"), (21, "W3"), (31, "W4")]
WEEK_LABELS: list[str] = ["W1", "W2", "W3", "W4"]
WEEKLY_SHEET_MONTHS = 3

# Control characters stripped from text (tab, LF and CR are kept).
CONTROL_CHARS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]"

# Identity masking: pad to 12 with '0', keep 8, then four asterisks.
MASK_WIDTH, MASK_KEEP, MASK_SUFFIX = 12, 8, "****"

# Display truncation of event name / sub-program.
EVENT_NAME_CHARS, SUB_PROGRAM_CHARS = 60, 40

# Monthly heat bands: (lower bound, label); 0 is its own band.
HEAT_BANDS: list[tuple[int, str]] = [(0, "0"), (1, "1-5"), (6, "6-20"), (21, "21-99"), (100, "100+")]

# Explorer: column priority, facet columns, search fields, preview size.
PRIORITY_COLUMNS: list[str] = [
    "category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar", "program_name",
    "participant_name", "identity_no", "gender_name", "participant_type",
    "site_state", "site_name", "site_tp", "site_dusp", "site_phase",
    "event_startdate", "event_year", "event_quarter", "event_month_name",
    "event_duration_hours", "attendance",
]
FACET_COLUMNS: list[str] = [
    "category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar",
    "site_tp", "site_dusp", "site_phase", "site_state", "gender_name", "participant_type",
]
CASCADE_ORDER: list[str] = ["category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar"]
SEARCH_FIELDS: list[str] = ["participant_name", "site_name", "program_name", "sub_pillar_name", "deeper_sub_pillar"]
PREVIEW_ROWS = 200

# Participant type labels.
MEMBER, UNDER_12, UNKNOWN = "Member", "Under 12", "Unknown"

# ---------------------------------------------------------------------------
# Typed configuration
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Demographics:
    """How the demographic block reads the fact."""

    participant: str = "participant_id"
    gender: str = "gender"
    women_value: str = WOMEN_VALUE
    age: str = "age"
    oku: str = "oku_status"


@dataclass(frozen=True)
class Classifier:
    """Ordered keyword rules; first match wins."""

    rules: tuple[tuple[str, str], ...] = tuple(LL_RULES)
    default: str = LL_DEFAULT


@dataclass(frozen=True)
class PillarSpec:
    """A pillar's pivot: its group column, the classifier that labels it and
    the labels that stay (all, if none are given)."""

    name: str
    group_col: str
    classifier: Classifier | None = None
    groups: tuple[str, ...] | None = None


@dataclass(frozen=True)
class FilterSpec:
    """Explorer filter: facet equality, inclusive date range, free text."""

    facets: dict = field(default_factory=dict)
    date_from: str | None = None
    date_to: str | None = None
    search: str | None = None
    date_col: str = "event_startdate"
    search_fields: tuple[str, ...] = tuple(SEARCH_FIELDS)


# The dashboard's pillars.
PILLARS: tuple[PillarSpec, ...] = (
    PillarSpec("Entrepreneur", "sub_pillar_name"),
    PillarSpec("Lifelong Learning", "program_name", Classifier(), tuple(LL_GROUPS)),
    PillarSpec("Wellbeing", "sub_pillar_name"),
    PillarSpec("Awareness", "sub_pillar_name"),
    PillarSpec("Government Initiatives", "sub_pillar_name"),
)

# The subcategory whose programs are labelled by the classifier.
CLASSIFIED_SUBCATEGORY = 2
