"""Facts about one reporting domain that the plans need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Names and codes of the reporting entities.
ENTITY_CODES = {
    "Newfoundland and Labrador": "NL",
    "Prince Edward Island": "PE",
    "Nova Scotia": "NS",
    "New Brunswick": "NB",
    "Quebec": "QC",
    "Ontario": "ON",
    "Manitoba": "MB",
    "Saskatchewan": "SK",
    "Alberta": "AB",
    "British Columbia": "BC",
    "Yukon": "YT",
    "Northwest Territories": "NT",
    "Nunavut": "NU",
}

# Further spellings of the names, as map files use them.
ENTITY_ALIASES = {
    "Newfoundland": "NL",
    "Québec": "QC",
    "Yukon Territory": "YT",
}

# Region groups of the entities.
REGION_GROUPS = {
    "Territories": ("YT", "NT", "NU"),
    "Western": ("BC", "AB", "SK", "MB"),
    "Central": ("ON", "QC"),
    "Atlantic": ("NB", "NS", "PE", "NL"),
}

# Regions below entity level that the harms table also lists.
SUB_REGIONS = (
    "Whitehorse, Yukon",
    "Yellowknife, Northwest Territories",
    "Northern and rural Manitoba",
    "Winnipeg, Manitoba",
    "Territories",
)

# Report labels of the harm types.
HARM_LABELS = {
    "Deaths": "Apparent Toxicity Deaths",
    "Emergency Department (ED) Visits": "ED Visits",
    "Hospitalizations": "Hospitalizations",
    "Emergency Medical Services (EMS)": "EMS Responses",
}

# Disease names that differ between the two sources, and groups.
DISEASE_NAMES = {"Syphilis": "Infectious Syphilis"}
DISEASE_GROUPS = {
    "Sexually Transmitted Infection": ("Chlamydia", "Gonorrhea", "Infectious Syphilis"),
    "Enteric / Foodborne": ("Giardiasis", "Salmonellosis"),
}

# The caveats printed beside flagged rows.
EVENT_NOTE = (
    "Post-emergency declaration period (Yukon Substance Use Health Emergency, Jan 2022). "
    "MH readmission rates may be partly influenced by substance use comorbidity. "
    "Interpret alongside opioid and stimulant harm indicators."
)
ACCESS_NOTE = (
    "Yukon diabetes rate may underestimate true prevalence. "
    "Remote community residents have lower rates of physician contact "
    "and fewer administrative records, which can suppress CCDSS detection. "
    "Interpret as a floor estimate, not a confirmed lower burden. "
    "Source: Ng et al. (2010), CCDSS 20-year review (2019)."
)


@dataclass(frozen=True)
class Domain:
    """Entities, benchmark, focus entity, event dates and labels of one domain."""

    codes: Mapping[str, str] = field(default_factory=lambda: ENTITY_CODES)
    benchmark: str = "CA"
    benchmark_name: str = "Canada"
    benchmark_label: str = "Canada (National)"
    focus: str = "YT"
    focus_name: str = "Yukon"
    territories: Sequence[str] = ("YT", "NT", "NU")
    regions: Mapping[str, Sequence[str]] = field(default_factory=lambda: REGION_GROUPS)
    members: int = 13
    first_period: int = 2000
    event_pre: tuple[int, int] = (2019, 2021)
    event_from: int = 2022
    event_note: str = EVENT_NOTE
    access_note: str = ACCESS_NOTE
    indicators: tuple[str, str, str] = ("ACSC Hospitalizations", "Mental Health Readmissions", "Diabetes Incidence")
    sub_regions: Sequence[str] = SUB_REGIONS
    harm_labels: Mapping[str, str] = field(default_factory=lambda: HARM_LABELS)
    headline_harm: tuple[str, str] = ("Opioids", "Apparent Toxicity Deaths")
    headline_name: str = "Substance Use (Opioid Deaths)"
    disease_names: Mapping[str, str] = field(default_factory=lambda: DISEASE_NAMES)
    disease_groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: DISEASE_GROUPS)

    @property
    def peers(self) -> list[str]:
        return [*self.territories, self.benchmark]

    def names_with(self, benchmark_spelling: str) -> dict[str, str]:
        """Name to code, with the source's own spelling of the benchmark."""
        return {**self.codes, benchmark_spelling: self.benchmark}


DEFAULT = Domain()
