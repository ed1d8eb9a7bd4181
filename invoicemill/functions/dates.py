"""Labelled dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.text import ascii_digits, rx


def _valid(day: Column) -> Column:
    return F.when(F.year(day) >= 1, day)


def labelled_date(text: Column, label: str) -> Column:
    """First date after ``label``. Of each written form only its first match counts;
    an impossible date passes the turn to the next form. Texts without the label are left after two looks."""
    def found(form: str) -> Column:
        return ascii_digits(F.regexp_extract(text, rx(label + fv.DATE_LABEL_GAP + form, ignore_case=True), 1))

    (first_form, first_format), *other_forms = fv.DATE_NUMERIC_FORMS
    numeric = [_valid(F.try_to_date(found(form), fmt)) for form, fmt in other_forms]
    spelled = F.array(F.regexp_replace(found(fv.DATE_MONTH_NAME_FORM), rx(r"\s+"), " "))
    named = F.get(F.transform(spelled, lambda day: F.coalesce(
        *[_valid(F.try_to_date(day, fmt)) for fmt in fv.DATE_MONTH_NAME_FORMATS])), F.lit(0))
    return F.coalesce(
        _valid(F.try_to_date(found(first_form), first_format)),
        F.when(text.rlike(rx(label, ignore_case=True)), F.coalesce(*numeric, named)))
