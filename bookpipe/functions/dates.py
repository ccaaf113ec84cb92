"""Date parsing and timestamp precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookpipe.functions.text import WHITESPACE

# The words of a posted date: weekday, month, day, time, offset, year; more may follow.
_GAP, _WORD = f"[{WHITESPACE}]++", f"[^{WHITESPACE}]++"
_POSTED = _GAP.join([f"(?Us)^[{WHITESPACE}]*+{_WORD}", f"({_WORD})", "([0-9]++)", "([0-9]++:[0-9]++:[0-9]++)",
                     _WORD, f"([0-9]++)(?![^{WHITESPACE}]).*$|^.*$"])
# Other text matches the last branch and leaves all parts empty, which does not parse.
_ORDERED, _ORDERED_FORMAT = "$4 $1 $2 $3 Z", "y MMM d H:m:s X"

# The usual form, with every part in its place; values such as the 30th of February are left to the cast.
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_USUAL = (r"^[A-Z][a-z]{2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) [0-9]{2} (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9] "
          r"[+-][0-9]{4} [1-9][0-9]{3}\z")
_EPOCH, _MICROSECOND = "TIMESTAMP_NTZ'1970-01-01 00:00:00'", "INTERVAL '0.000001' SECOND"


def _usual(text: Column) -> Column:
    """The usual form, by the places of its parts."""
    def part(start: int, length: int) -> Column:
        return F.substr(text, F.lit(start), F.lit(length))

    month = F.substr(F.lit("".join(f"{m:02}-" for m in range(1, 13))), F.position(part(5, 3), F.lit(_MONTHS)), F.lit(3))
    return F.concat(part(27, 4), F.lit("-"), month, part(9, 2), F.lit(" "), part(12, 8)).try_cast("timestamp_ntz")


def parse_posted_date(text: Column) -> Column:
    """``Wed Nov 20 10:31:35 -0800 2013`` as the zone-free timestamp 2013-11-20 10:31:35.

    The weekday and the offset are ignored: the result is the wall clock that was written down.
    Anything else, such as missing words or an unknown month, gives null. The words are put in
    order first, because weekday names cannot be parsed, and read as UTC, so that the session zone
    does not matter. Text in the usual form is cut by place, which is several times faster.
    """
    moment = F.try_to_timestamp(F.regexp_replace(text, _POSTED, _ORDERED), F.lit(_ORDERED_FORMAT))
    other = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_seconds(moment))
    return F.when(text.rlike(_USUAL), _usual(text)).otherwise(other)


def cut_to_millis(moment: Column) -> Column:
    """Drop what is finer than a millisecond, without passing through the session zone."""
    # Whole microseconds: decimal seconds take several times as long.
    micros = F.call_function("div", moment - F.expr(_EPOCH), F.expr(_MICROSECOND))
    return moment - F.expr(_MICROSECOND) * F.pmod(micros, F.lit(1000))
