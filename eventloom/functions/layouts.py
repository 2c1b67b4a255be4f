"""Reference-time layouts ("2006-01-02 15:04:05" style) as one regular expression.

A layout is compiled on the driver to a pattern with one group per date part; the parts
are cut out with ``regexp_extract`` and put together by ``try_make_timestamp_ntz``.  The
result is the wall clock as written, independent of the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from eventloom.functions.variants import let

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Layout element -> (date part, pattern).  Parts named None are only checked.
ELEMENTS = {
    "January": ("month_name", "|".join(MONTHS)),
    "Jan": ("month_abbr", "|".join(m[:3] for m in MONTHS)),
    "Monday": (None, "|".join(DAYS)),
    "Mon": (None, "|".join(d[:3] for d in DAYS)),
    "MST": (None, "[A-Z]{3,4}"),
    "2006": ("year", "[0-9]{4}"),
    "06": ("short_year", "[0-9]{2}"),
    "01": ("month", "[0-9]{2}"),
    "02": ("day", "[0-9]{2}"),
    "_2": ("day", " ?[0-9]{1,2}"),
    "03": ("hour12", "[0-9]{2}"),
    "04": ("minute", "[0-9]{2}"),
    "05": ("second", "[0-9]{2}"),
    "15": ("hour", "[0-9]{1,2}"),
    "PM": ("half", "AM|PM"),
    "pm": ("half", "am|pm"),
    "Z07:00": (None, "Z|[+-][0-9]{2}:[0-9]{2}"),
    "Z0700": (None, "Z|[+-][0-9]{4}"),
    "-07:00": (None, "[+-][0-9]{2}:[0-9]{2}"),
    "-0700": (None, "[+-][0-9]{4}"),
    "-07": (None, "[+-][0-9]{2}"),
    "1": ("month", "[0-9]{1,2}"),
    "2": ("day", "[0-9]{1,2}"),
    "3": ("hour12", "[0-9]{1,2}"),
    "4": ("minute", "[0-9]{1,2}"),
    "5": ("second", "[0-9]{1,2}"),
}
# A fraction may follow the seconds whether or not the layout has one; milliseconds are kept.
FRACTION = "(?:([.,][0-9]{1,3})[0-9]*)?"
NUMERIC_PARTS = {"year", "month", "day", "hour", "minute", "second", "fraction"}

_TOKEN = re.compile(
    r"[.,](?:0+|9+)(?![0-9])|" + "|".join(re.escape(k) for k in sorted(ELEMENTS, key=len, reverse=True))
)


def compile_layout(layout: str) -> tuple[str, dict[str, int]]:
    """(anchored regular expression, date part -> group number)."""
    pattern, groups, at, n = "", {}, 0, 0
    seconds_open = False
    for found in _TOKEN.finditer(layout):
        literal = layout[at:found.start()]
        token = found.group()
        is_fraction = token[0] in ".,"
        if seconds_open and not (is_fraction and not literal):
            n += 1
            groups["fraction"] = n
            pattern += FRACTION
        seconds_open = False
        pattern += re.escape(literal)
        if is_fraction:
            n += 1
            groups["fraction"] = n
            width = len(token) - 1
            cut = min(width, 3)
            fixed = f"([.,][0-9]{{{cut}}})[0-9]{{{width - cut}}}"
            pattern += fixed if token[1] == "0" else FRACTION
        else:
            part, body = ELEMENTS[token]
            n += 1
            pattern += f"({body})"
            if part:
                groups[part] = n
                seconds_open = part == "second"
        at = found.end()
    if seconds_open:
        n += 1
        groups["fraction"] = n
        pattern += FRACTION
    return "^" + pattern + re.escape(layout[at:]) + "$", groups


def _parse_numeric(value: Column, pattern: str, groups: dict[str, int]) -> Column:
    """All-numeric layouts: reorder the parts to ISO form in one replace, then cast."""
    at = lambda name, default: f"${groups[name]}" if name in groups else default
    iso = (
        f"{at('year', '')}-{at('month', '1')}-{at('day', '1')} "
        f"{at('hour', '0')}:{at('minute', '0')}:{at('second', '0')}{at('fraction', '')}"
    )
    reordered = F.translate(F.regexp_replace(value, pattern, iso), ",", ".")
    return F.when(value.rlike(pattern), reordered.try_cast("timestamp_ntz"))


def parse(value: Column, layout: str) -> Column:
    """TIMESTAMP_NTZ of ``value`` in ``layout`` cut to milliseconds, NULL if it does not fit."""
    pattern, groups = compile_layout(layout)
    if "year" in groups and set(groups) <= NUMERIC_PARTS:
        return _parse_numeric(value, pattern, groups)

    names = list(groups)
    cut = F.split(F.regexp_replace(value, pattern, "\x01".join(f"${groups[n]}" for n in names)), "\x01")
    return F.when(value.rlike(pattern), let(cut, lambda parts: _assemble(parts, names)))


def _assemble(parts: Column, names: list[str]) -> Column:
    """Timestamp from the cut-out date parts, for layouts with names, halves or short years."""
    def word(name: str) -> Column:
        return F.get(parts, F.lit(names.index(name)))

    def part(name: str, default: int) -> Column:
        return F.trim(word(name)).try_cast("int") if name in names else F.lit(default)

    def position(known: list[str], name: str) -> Column:
        return F.array_position(F.array(*[F.lit(k) for k in known]), word(name)).cast("int")

    year = part("year", 0)
    if "short_year" in names:
        yy = part("short_year", 0)
        year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    month = part("month", 1)
    if "month_name" in names:
        month = position(MONTHS, "month_name")
    elif "month_abbr" in names:
        month = position([m[:3] for m in MONTHS], "month_abbr")
    hour = part("hour", 0)
    if "hour12" in names:
        twelve = part("hour12", 0)
        hour = F.when(twelve <= 12, twelve)
        if "half" in names:
            afternoon = word("half").isin("PM", "pm")
            hour = F.when(twelve <= 12, twelve % 12 + F.when(afternoon, F.lit(12)).otherwise(F.lit(0)))
    second = part("second", 0)
    second = F.when(second < 60, second).cast("decimal(16,6)")
    if "fraction" in names:
        millis = F.rpad(F.substring(word("fraction"), 2, 3), 3, "0").try_cast("int")
        second = (second + millis * F.lit(0.001).cast("decimal(8,6)")).cast("decimal(16,6)")
    return F.try_make_timestamp_ntz(year, month, part("day", 1), hour, part("minute", 0), second)
