"""User profile labels."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.dates import ColumnOrName, _c

# Labels must equal the reference's output text.
AGE_INFANT = "婴幼儿"      # age 1-6
AGE_CHILD = "少儿"         # age <= 12 (also age <= 0)
AGE_TEEN = "青少年"        # age <= 17
AGE_YOUTH = "青年"         # age <= 45
AGE_MIDDLE = "中年"        # age <= 69
AGE_SENIOR = "老年"        # otherwise
GENDER_FEMALE = "女"       # code F
GENDER_MALE = "男"         # code M


def age(birthday: ColumnOrName, as_of_year: int | None = None) -> Column:
    """``as_of_year`` minus the year in the first four characters of the birthday.

    The reference uses the wall clock; the year is a parameter here (SURVEY Q16).
    A birthday whose year does not parse gives null.
    """
    year = as_of_year if as_of_year is not None else _dt.date.today().year
    birth_year = F.substring(_c(birthday), 1, 4).try_cast("int")
    return F.lit(year) - birth_year


def age_group(age_col: ColumnOrName) -> Column:
    """Age band label; ages <= 0 fall in the child band as in the reference."""
    a = _c(age_col)
    return (
        F.when(a.isNull(), F.lit(None).cast("string"))
        .when((a > 0) & (a <= 6), F.lit(AGE_INFANT))
        .when(a <= 12, F.lit(AGE_CHILD))
        .when(a <= 17, F.lit(AGE_TEEN))
        .when(a <= 45, F.lit(AGE_YOUTH))
        .when(a <= 69, F.lit(AGE_MIDDLE))
        .otherwise(F.lit(AGE_SENIOR))
    )


def gender_label(code: ColumnOrName) -> Column:
    """F -> female label, M -> male label, anything else -> null."""
    g = _c(code)
    return F.when(g == "F", F.lit(GENDER_FEMALE)).when(g == "M", F.lit(GENDER_MALE))
