"""Calendar features and public holidays as pure date expressions (no calendar join needed)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def season(month: Column) -> Column:
    # (month % 12) div 3 numbers the quarters from December on.
    names = F.array(*[F.lit(n) for n in ("winter", "spring", "summer", "fall")])
    return F.get(names, F.floor((month % 12) / 3).cast("int"))


# United States public holidays.
# (month, day, first year): a date, also observed on Friday / Monday when on Saturday / Sunday.
US_FIXED_DAYS = [(1, 1, 1871), (6, 19, 2021), (7, 4, 1871), (11, 11, 1938), (12, 25, 1871)]
# (month, weekday with Monday = 0, nth, first year); nth = -1 is the last one of the month.
US_FLOATING_DAYS = [
    (1, 0, 3, 1986), (2, 0, 3, 1971), (5, 0, -1, 1971),
    (9, 0, 1, 1894), (10, 0, 2, 1970), (11, 3, 4, 1942),
]
HOLIDAY_RULES = {"US": (US_FIXED_DAYS, US_FLOATING_DAYS)}


def holiday(day: Column, country: str = "US") -> Column:
    """True on a public holiday or its observed weekday."""
    if country not in HOLIDAY_RULES:
        raise ValueError(f"no holiday rules for {country!r}; pass a calendar of dates instead")
    dated, floating = HOLIDAY_RULES[country]
    weekday = F.weekday(day)

    def on(d: Column, month: int, dom: int, since: int) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == dom) & (F.year(d) >= since)

    found = F.lit(False)
    for month, dom, since in dated:
        found = (
            found
            | on(day, month, dom, since)
            | ((weekday == 4) & on(F.date_add(day, 1), month, dom, since))
            | ((weekday == 0) & on(F.date_sub(day, 1), month, dom, since))
        )
    for month, wanted, nth, since in floating:
        dom = F.dayofmonth(day)
        if nth > 0:
            week = dom.between(7 * nth - 6, 7 * nth)
        else:
            week = dom > F.dayofmonth(F.last_day(day)) - 7
        found = found | ((F.month(day) == month) & (weekday == wanted) & week & (F.year(day) >= since))
    return found
