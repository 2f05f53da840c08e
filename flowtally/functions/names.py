"""Name rules. These are fixed values: published figures depend on every entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, matches
from .text import apply_rules, remove_all, remove_first, replace_patterns, title_case, trimmed

# Destination spellings in the newer deliveries, after title case.
DESTINATIONS = [
    ("(?s)(?=.*Congo)(?=.*Democratic)", "Congo DR"),
    ("Moldova", "Moldova"),
    ("Syria", "Syria"),
    ("Russia", "Russia"),
]
DESTINATIONS_EXACT = {"Bosnia And Herzegovina": "Bosnia and Herzegovina"}

# Destination spellings in the 2019-21 tables.
DESTINATIONS_2019 = [
    ("erzegovina", "Bosnia and Herzegovina"),
    ("Gambia", "Gambia"),
    ("Dominican", "Dominican Republic"),
    ("Kosovo", "Kosovo"),
]

# Destination spellings in the 2006-18 sheets; a lone x means no destination.
DESTINATIONS_2006 = [
    ("erzegovina", "Bosnia and Herzegovina"),
    ("Congo", "Congo DR"),
    ("Gambia", "Gambia"),
    ("Dominican", "Dominican Republic"),
    ("Kosovo", "Kosovo"),
]
DESTINATIONS_2006_EXACT = {"x": None}

# Words in the payee column of the ledgers that are no part of the name.
PAYEE_AGENCY = {"Fx Missions|Fx Mission": "Frontex"}
PAYEE_NOISE = r"Observers|Observer|Obs|\(|\)|_observers|_cancelled|_ombudsman|_stopover|Cancelled|_no Costs|_jcc With At|Cancellation|_cancellation|_observer|_monitor|_rf"
PAYEE_NOISE_2016 = r"Observers|Observer|Obs|\(|\)|_observers|_cancelled|_ombudsman|_stopover|Cancelled|_no Costs|_jcc With At|Cancellation|_cancellation|_observer|_monitors|_monitor|_rf"
PAYEES = [("Netherland", "Netherlands"), ("Frontex", "Frontex")]
PAYEES_EXACT = {"Uk": "United Kingdom", "Geramny": "Germany"}
PAYEES_2016 = [
    ("Netherland", "Netherlands"),
    ("Frontex", "Frontex"),
    ("Macedonia", "North Macedonia"),
    ("Germany", "Germany"),
]
PAYEES_2016_EXACT = {"Uk": "United Kingdom", "Gr": "Greece", "Geramny": "Germany"}

# Rows of the ledgers that are totals or name several payees at once.
TOTAL_LABELS = ["TOTAL COST", "Sum"]
UNUSABLE_PAYEES = ["Be, Ro,Si"]
UNUSABLE_PAYEES_2016 = ["Ro Nigeria"]
UNUSABLE_PAYEE_PATTERN_2016 = "Ro To"

# The agency has no country code.
AGENCY, AGENCY_CODE = "Frontex", "FX"

# Country-list spellings against the names used here.
COUNTRY_SYNONYMS_2021 = {"Slovak Republic": "Slovakia"}
COUNTRY_SYNONYMS = {"Czechia": "Czech Republic", "Slovak Republic": "Slovakia"}
RANKING_SYNONYMS_2021 = {
    r"Congo, Dem\. Rep\.": "Congo DR",
    "Gambia, The": "Gambia",
    r"Egypt, Arab Rep\.": "Egypt",
    "Russian Federation": "Russia",
}
RANKING_SYNONYMS = {
    r"Congo, Dem\. Rep\.": "Congo DR",
    "Gambia, The": "Gambia",
    "Vietnam": "Viet Nam",
    "Turkiye": "Turkey",
    r"Egypt, Arab Rep\.": "Egypt",
    "Russian Federation": "Russia",
}

# Long destination names shortened in the ranking.
RANKING_RELABELS = {"Congo, The Democratic Republic Of The": "Congo DR"}

# Operation types in display order.
TYPE_LEVELS = ["JRO", "JRO (FRONTEX-RO)", "FRONTEX-RO", "NRO", "CRO", "VRD", "Humanitarian VR", "VDO"]

# State spellings in the 2006-18 sheets (case-insensitive but for UK and N/A).
STATES_2006 = [("(?i)fronte", "Frontex"), ("UK", "United Kingdom"), ("(?i)taly", "Italy"), ("(?i)embourg", "Luxembourg")]
STATE_SUFFIXES_2006 = [("(?i)observer", r" \(observer\)"), ("(?i)ombudsman", r" \(Ombudsman\)")]
STATE_MISSING_2006 = "N/A"


def destination(c: Column | str) -> Column:
    """Destination of the newer deliveries: footnote stars out, title case, known names."""
    return apply_rules(title_case(remove_all(c, r"\*")), DESTINATIONS, DESTINATIONS_EXACT)


def destination_2019(c: Column | str) -> Column:
    return apply_rules(c, DESTINATIONS_2019)


def destination_2006(c: Column | str) -> Column:
    return apply_rules(c, DESTINATIONS_2006, DESTINATIONS_2006_EXACT)


def state_2006(c: Column | str) -> Column:
    """Member state of the 2006-18 sheets; roles in brackets go, 'N/A' becomes NULL."""
    c = as_col(c)
    out = c
    # built from the last rule to the first, so that the first one wins
    out = F.when(matches(c, STATE_MISSING_2006), F.lit(None).cast("string")).otherwise(out)
    for pattern, suffix in reversed(STATE_SUFFIXES_2006):
        out = F.when(matches(c, pattern), remove_first(c, suffix)).otherwise(out)
    for pattern, name in reversed(STATES_2006):
        out = F.when(matches(c, pattern), F.lit(name)).otherwise(out)
    return out


def payee(c: Column | str) -> Column:
    """Payee of the ledgers up to 2015."""
    return _payee(c, PAYEE_NOISE, PAYEES, PAYEES_EXACT)


def payee_2016(c: Column | str) -> Column:
    return _payee(c, PAYEE_NOISE_2016, PAYEES_2016, PAYEES_2016_EXACT)


def _payee(c, noise, rules, exact) -> Column:
    text = replace_patterns(title_case(c), PAYEE_AGENCY)
    return apply_rules(trimmed(remove_all(text, noise)), rules, exact)


def operation_type(op_type: Column | str, op_id: Column | str) -> Column:
    """A missing type is 'VRD' if the id says so, else 'unknown'; others are trimmed."""
    op_type = as_col(op_type)
    return (
        F.when(op_type.isNotNull(), trimmed(op_type))
        .when(matches(op_id, "VRD"), F.lit("VRD"))
        .otherwise(F.lit("unknown"))
    )


def operation_type_2022(op_type: Column | str, op_id: Column | str | None = None) -> Column:
    """Older rule: any missing type is 'unknown', others stay as delivered."""
    return F.coalesce(as_col(op_type), F.lit("unknown"))
