"""Per-row clinical recodes and buckets as Column builders.

Inputs may be raw text: every comparison with a literal reads the text in
the type an implicit comparison with that literal would use
(see ``coerce.Numeric``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.functions.coerce import Numeric, as_double, as_int, col_, days_between


def _chain(cases, otherwise=None) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... [ELSE otherwise] END."""
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if otherwise is not None:
        out = out.otherwise(otherwise)
    return out


def _between(x: Numeric, lo, hi) -> Column:
    """``x BETWEEN lo AND hi`` with each bound read in its own literal type."""
    return (x.for_(lo) >= lo) & (x.for_(hi) <= hi)


# ---------------------------------------------------------------- normalise
def height_m(height_cm) -> Column:
    return F.try_divide(as_double(height_cm), F.lit(100))


def bmi_value(weight_kg, height_in_m) -> Column:
    h = col_(height_in_m)
    return F.try_divide(as_double(weight_kg), h * h)


def bmi_text(weight_kg, height_in_m) -> Column:
    """BMI rounded half-even to one decimal, as text with thousands commas."""
    return F.format_number(bmi_value(weight_kg, height_in_m), 1)


def hivtest_results(result) -> Column:
    r = col_(result)
    return F.when(~r.isin(vocab.HIV_RESULTS_KEPT), vocab.HIV_RESULT_MISSING).otherwise(r)


def sex_recode(sex) -> Column:
    s = col_(sex)
    return _chain([(s == code, label) for code, label in vocab.SEX_CODES], vocab.SEX_OTHER)


def yes_if(cond: Column) -> Column:
    return F.when(cond, vocab.YES).otherwise(vocab.NO)


def pmtct_tx(anc_visit_date) -> Column:
    return yes_if(col_(anc_visit_date).isNotNull())


def on_art(art_number, art_start, regimen) -> Column:
    return yes_if(col_(art_number).isNotNull() | col_(art_start).isNotNull()
                  | col_(regimen).isNotNull())


# ------------------------------------------------------------------ buckets
def age_group(age) -> Column:
    a = col_(age)
    lo, hi, infant = vocab.AGE_INFANT
    top, top_label = vocab.AGE_TOP
    bif_lo, bif_hi, bif = vocab.AGE_BEFORE_BIRTH
    cases = [((a > lo) & (a <= hi), infant)]
    cases += [((a >= b_lo) & (a <= b_hi), label) for b_lo, b_hi, label in vocab.AGE_BANDS]
    cases += [(a >= top, top_label), ((a >= bif_lo) & (a <= bif_hi), bif)]
    return _chain(cases)


def weight_category(weight) -> Column:
    w = Numeric(col_(weight))
    top, top_label = vocab.WEIGHT_TOP
    cases = [(_between(w, lo, hi), label) for lo, hi, label in vocab.WEIGHT_BANDS]
    cases.append((w.for_(top) >= top, top_label))
    return _chain(cases)


def bmi_category(bmi) -> Column:
    b = Numeric(col_(bmi))
    cases = []
    for lo, hi, label in vocab.BMI_BANDS:
        cond = None
        if lo is not None:
            cond = b.for_(lo) >= lo
        if hi is not None:
            upper = b.for_(hi) < hi
            cond = upper if cond is None else cond & upper
        cases.append((cond, label))
    return _chain(cases)


def linkage_category(art_start, hiv_test) -> Column:
    days = days_between(art_start, hiv_test)
    cases = []
    for lo, hi, label in vocab.LINKAGE_BANDS:
        cond = days >= lo if hi is None else (days >= lo) & (days <= hi)
        cases.append((cond, label))
    return _chain(cases)


def months_since(report, start) -> Column:
    """Whole 30.437-day months from ``start`` to ``report`` (BIGINT, floored)."""
    return F.floor(days_between(report, start) / F.lit(vocab.DAYS_PER_MONTH))


def art_cohort(months) -> Column:
    m = col_(months)
    return _chain([((m >= lo) & (m <= hi), label) for lo, hi, label in vocab.ART_COHORT_BANDS],
                  vocab.ART_COHORT_REST)


def cd4_group(cd4) -> Column:
    x = as_int(cd4)
    cases = []
    for lo, hi, label in vocab.CD4_BANDS:
        cond = None
        if lo is not None:
            cond = x > lo
        if hi is not None:
            cond = (x <= hi) if cond is None else cond & (x <= hi)
        cases.append((cond, label))
    return _chain(cases)


def cd4_percentage(perc) -> Column:
    x = as_int(perc)
    return _chain([(x < 15, vocab.CD4_PERC_LOW), ((x >= 15) & (x <= 24), vocab.CD4_PERC_MID)],
                  vocab.CD4_PERC_REST)


def vl_category(copies) -> Column:
    x = as_int(copies)
    return _chain([(x < 1000, vocab.VL_LOW), ((x >= 1000) & (x <= 2500), vocab.VL_MID),
                   (x > 2500, vocab.VL_HIGH)])


def mmd_proxy_months(next_appt, dispensed, last_visit) -> Column:
    """Months of drugs dispensed: next appointment minus dispensation date,
    or minus the last visit when no dispensation date is known; truncated INT."""
    n, d, v = col_(next_appt), col_(dispensed), col_(last_visit)
    months = _chain([
        (n.isNotNull() & d.isNotNull(), days_between(n, d) / F.lit(vocab.DAYS_PER_MONTH_MMD)),
        (d.isNull(), days_between(n, v) / F.lit(vocab.DAYS_PER_MONTH_MMD)),
    ])
    return months.try_cast("int")


def mmd_type(mmd_months) -> Column:
    m = col_(mmd_months)
    L = vocab.MMD_LABELS
    return _chain([
        ((m > 0) & (m < 3), L["lt3"]),
        ((m >= 3) & (m <= 5), L["3to5"]),
        (m == 6, L["6"]),
        ((m >= 7) & (m <= 11), L["7to11"]),
        (m >= 12, L["12plus"]),
    ])


def dsd_new(dsd) -> Column:
    """Known labels pass through; the raw spelling variants are fixed."""
    x = col_(dsd)
    return _chain([(x == raw, fixed) for raw, fixed in vocab.DSD_RAW_FIXES.items()], x)


def dsd_code(dsd_label) -> Column:
    """1-based position of a cleaned DSD label in the code list; else NULL."""
    x = col_(dsd_label)
    return _chain([(x == label, i) for i, label in enumerate(vocab.DSD_LABELS, start=1)])
