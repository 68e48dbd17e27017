"""Retention status, outcomes and programme indicators as Column builders.

All predicates follow SQL three-valued logic: a ``when`` branch is taken only
when its condition is TRUE, so a NULL input usually falls through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.functions.clinical import _chain, yes_if
from cohortkit.functions.coerce import col_, days_between


def in_care(days_missed, days_away, days_away_dispense) -> Column:
    """Seen, due or dispensed recently enough to count as still in care.

    Any of the three gaps within 30 days; or no dispensation date and either
    the last visit within 90 days or no appointment date; or no appointment
    date and either the last visit or the dispensation within 90 days.
    """
    m, a, d = col_(days_missed), col_(days_away), col_(days_away_dispense)
    return ((m <= 30) | (a <= 30) | (d <= 30)
            | (d.isNull() & ((a <= 90) | m.isNull()))
            | (m.isNull() & ((a <= 90) | (d <= 90))))


def status_vocabulary(name: str = "reference") -> list[tuple[str, str]]:
    """Raw-code -> label table for a current status.

    ``"reference"`` keeps the source system's spellings as the reference
    rules match them; ``"fixed"`` spells them like the stale-status codes.
    """
    if name == "reference":
        return vocab.STATUS_CURRENT_LABELS
    if name == "fixed":
        return vocab.STATUS_CURRENT_LABELS_FIXED
    raise ValueError(f"unknown status vocabulary {name!r}")


def patient_status(raw_status, status_date, last_visit, in_care_flag,
                   vocabulary: str = "reference") -> Column:
    """Recode the raw status.

    Active: no status, or a stale status (recorded before the last visit or
    undated), and still in care. Otherwise a status recorded on or after the
    last visit maps to its label. Anything else is NULL.
    """
    raw, sd, last = col_(raw_status), col_(status_date), col_(last_visit)
    stale = (sd < last) | sd.isNull()
    active = (raw.isNull() | (raw.isin(vocab.STATUS_STALE_CODES) & stale)) & in_care_flag
    current = sd >= last
    cases = [(active, vocab.ACTIVE)]
    cases += [((raw == code) & current, label) for code, label in status_vocabulary(vocabulary)]
    return _chain(cases)


def clinical_outcome(status, in_care_flag) -> Column:
    s = col_(status)
    retained = (s == vocab.ACTIVE) | (
        s.isin(vocab.REACTIVATED, vocab.TRANSFERRED_OUT) & in_care_flag)
    return F.when(retained, vocab.RETENTION).otherwise(vocab.ATTRITION)


def outcome_1(outcome, status, status_date, last_visit, in_care_flag,
              art_quarter, report_quarter, art_year, report_year) -> Column:
    """PEPFAR-style outcome; first matching rule wins.

    Some rules can never fire given the earlier ones (a dated status before
    the last visit is already 'Active on ART'; every attrition row is
    already TX_ML). They are kept so the rule list reads as specified.
    """
    o, s, sd, last = col_(outcome), col_(status), col_(status_date), col_(last_visit)
    retained, lost = o == vocab.RETENTION, o == vocab.ATTRITION
    lost_status = s.isin(vocab.DIED, vocab.STOPPED_ART, vocab.TRANSFERRED_OUT,
                         vocab.MADE_INACTIVE) | s.isNull()
    return _chain([
        (retained & sd.isNotNull(), vocab.OUTCOME1_ACTIVE),
        (retained & (sd < last), vocab.OUTCOME1_RTT),
        (lost | (lost_status & (sd < last)), vocab.OUTCOME1_ML),
        (lost & (s == vocab.TRANSFERRED_OUT) & in_care_flag, vocab.OUTCOME1_IIT),
        (retained & (col_(art_quarter) == col_(report_quarter))
         & (col_(art_year) == col_(report_year)), vocab.OUTCOME1_NEW),
    ])


def vl_eligibility(months_on_art, anc_visit, report, delivery_date) -> Column:
    """Due a viral load: 6+ months on ART, 3+ months if seen at ANC, or a
    delivery date no more than 27 months before the report date (any
    future delivery date qualifies)."""
    m, anc = col_(months_on_art), col_(anc_visit)
    months_since_delivery = days_between(report, delivery_date) / F.lit(vocab.DAYS_PER_MONTH)
    return yes_if(((m >= 6) & anc.isNull()) | ((m >= 3) & anc.isNotNull())
                  | (months_since_delivery <= 27))


def vl_coverage(outcome, vl_eligible, report, vl_date) -> Column:
    months_since_vl = days_between(report, vl_date) / F.lit(vocab.DAYS_PER_MONTH)
    return yes_if((col_(outcome) == vocab.RETENTION) & (col_(vl_eligible) == vocab.YES)
                  & (months_since_vl <= 12))


def hiv_cascade(on_art_flag, hiv_results, outcome, vl_eligible, vl_covered, vl_cat) -> Column:
    """Deepest cascade step reached, checked from the deepest step down."""
    L = vocab.CASCADE_LABELS
    on_art = col_(on_art_flag) == vocab.YES
    retained = on_art & (col_(outcome) == vocab.RETENTION)
    covered = retained & (col_(vl_covered) == vocab.YES)
    return _chain([
        (covered & (col_(vl_cat) == vocab.VL_LOW), L["suppression"]),
        (covered, L["coverage"]),
        (retained & (col_(vl_eligible) == vocab.YES), L["eligible"]),
        (retained, L["active"]),
        (on_art & col_(hiv_results).isin(*vocab.HIV_RESULTS_KEPT, vocab.HIV_RESULT_MISSING),
         L["positive"]),
    ])


def tx_ml(status, outcome, months_on_art) -> Column:
    s, o, m = col_(status), col_(outcome), col_(months_on_art)
    L = vocab.TX_ML_LABELS
    lost = o == vocab.ATTRITION
    interrupted = lost & ~s.isin(vocab.DIED, vocab.STOPPED_ART)
    return _chain([
        (s == vocab.DIED, L["died"]),
        (interrupted & (m < 3), L["iit_short"]),
        (interrupted & (m >= 3), L["iit_long"]),
        (lost & (s == vocab.STOPPED_ART), L["stopped"]),
        (o == vocab.RETENTION, L["curr"]),
    ])


def silent_transfer(art_facility, facility, status) -> Column:
    a, f = col_(art_facility), col_(facility)
    return yes_if((a != f) & (a != "") & (f != "") & (col_(status) != vocab.TRANSFERRED_OUT))


def re_initiated(last_visit, art_start, silent) -> Column:
    return yes_if((col_(last_visit) == col_(art_start)) & (col_(silent) == vocab.YES))


def mms(mmd_months, dsd_code_col) -> Column:
    """Multi-month scripting class from dispensing months and the numeric
    DSD code: 6 months (or code 6) is MMS6, 3 months (or code 3) is MMS3,
    else the DSD label for the code."""
    m, code = col_(mmd_months), col_(dsd_code_col)
    cases = [((m == 6) | (code == 6), vocab.MMS6), ((m == 3) | (code == 3), vocab.MMS3)]
    # Code 3 can never reach its own label (MMS3 comes first); it stays listed.
    cases += [(code == i, label) for i, label in enumerate(vocab.DSD_LABELS, start=1) if i != 6]
    return _chain(cases)
