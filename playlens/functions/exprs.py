"""Column -> Column rules. Everything here is a built-in expression, so it stays in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------
SKIP_REASON = "fwdbtn"
DONE_REASON = "trackdone"
DEFAULT_SKIP_RATE = 0.104
REASON_RISK = {"trackdone": 0.025, "clickrow": 0.120, "fwdbtn": 0.604, "backbtn": 0.400, "playbtn": 0.050}
NO_SKIP_SECONDS = 10000.0
COLD_START_PROB = 0.35
EARLY_SKIP_SECONDS = 45.0
MB_PER_PREFETCH = 1.0
MB_PER_TRACK = 4.3
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEASONS = ["Summer", "Monsoon", "Winter"]
SEASON_MONTHS = {"Summer": 3, "Monsoon": 4, "Winter": 5}
DAYPARTS = ["Morning", "Afternoon", "Evening", "Night", "Midnight"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Half-even rounding by scale, rint, unscale: the rule NumPy uses, so ties agree with it."""
    if digits == 0:
        return F.rint(col(c))
    scale = float(10**digits)
    return F.rint(col(c) * scale) / scale


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_even(F.when(whole > 0, part / whole * 100).otherwise(0.0), digits)


# --- labels and cleaning --------------------------------------------------------------------
def is_skip(reason_end: Column | str = "reason_end") -> Column:
    return F.coalesce((col(reason_end) == SKIP_REASON).cast("int"), F.lit(0))


def ms_to_seconds(ms: Column | str) -> Column:
    return (col(ms) / 1000).cast("int")


def flag(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("int"), F.lit(0))


def platform_family(c: Column | str) -> Column:
    v = F.lower(col(c))
    has = v.contains
    return (
        F.when(v.isNull() | (F.trim(v) == ""), "unknown")
        .when(has("android"), "android")
        .when(has("window"), "windows")
        .when(has("ios") | has("iphone") | has("ipad"), "ios")
        .when(has("mac") | has("darwin") | has("osx"), "macos")
        .when(has("linux"), "linux")
        .when(has("web"), "web")
        .when(has("unknown"), "unknown")
        .otherwise("other")
    )


def platform_coarse(c: Column | str) -> Column:
    """Six classes; Linux is tested before iOS."""
    v = F.lower(col(c))
    has = v.contains
    return (
        F.when(has("android"), "android")
        .when(has("windows"), "windows")
        .when(has("linux"), "linux")
        .when(has("ios") | has("iphone"), "ios")
        .when(has("mac"), "mac")
        .otherwise("other")
    )


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def platform_token(c: Column | str) -> Column:
    """First blank-separated token, capitalised; a missing platform reads as the text 'None'."""
    return capitalize(F.element_at(F.split(F.coalesce(col(c), F.lit("None")), " "), 1))


# --- calendar -------------------------------------------------------------------------------
def localize(ts: Column | str, zone: str) -> Column:
    """Wall-clock time in ``zone`` for a UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(ts).cast("timestamp_ntz"))


def day_name(ts: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(col(ts)) + 1)


def month_start(ts: Column | str) -> Column:
    return F.trunc(col(ts), "MM")


def abs_month(ts: Column | str) -> Column:
    return F.year(col(ts)) * 12 + F.month(col(ts))


def quarter_label(ts: Column | str) -> Column:
    return F.concat(F.year(col(ts)).cast("string"), F.lit("-Q"), F.quarter(col(ts)).cast("string"))


def decimal_hour(ts: Column | str) -> Column:
    return F.hour(col(ts)) + F.minute(col(ts)) / 60


def season(ts: Column | str) -> Column:
    m = F.month(col(ts))
    return F.when(m.between(3, 5), "Summer").when(m.between(6, 9), "Monsoon").otherwise("Winter")


def daypart(hours: Column) -> Column:
    return (
        F.when((hours >= 5) & (hours < 12), "Morning")
        .when((hours >= 12) & (hours < 17), "Afternoon")
        .when((hours >= 17) & (hours < 19.5), "Evening")
        .when((hours >= 19.5) & (hours < 24), "Night")
        .otherwise("Midnight")
    )


def ordinal(c: Column, names: list[str]) -> Column:
    """Position of a category in its fixed order, for sorting."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), c).cast("int")


def hour_sin(hour: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * hour / 24.0)


def hour_cos(hour: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * hour / 24.0)


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts))


# --- formatting -----------------------------------------------------------------------------
def duration_text(seconds: Column | str) -> Column:
    """Duration as text, 30-day months and 12-month years. The day form writes hours with an 'm'."""
    s = col(seconds).cast("bigint")

    def part(unit: int, modulo: int | None = None) -> Column:
        whole = F.floor(s / unit)
        return (whole if modulo is None else whole % modulo).cast("string")

    minute, hour, day = 60, 3600, 86400
    month, year = 30 * day, 360 * day
    return (
        F.when(s < minute, F.concat(part(1), F.lit("s")))
        .when(s < hour, F.concat(part(minute), F.lit("m "), part(1, 60), F.lit("s")))
        .when(s < day, F.concat(part(hour), F.lit("h "), part(minute, 60), F.lit("m "), part(1, 60), F.lit("s")))
        .when(s < month, F.concat(part(day), F.lit("d "), part(hour, 24), F.lit("m")))
        .when(s < year, F.concat(part(month), F.lit("mo "), part(day, 30), F.lit("d "), part(hour, 24), F.lit("h")))
        .otherwise(F.concat(part(year), F.lit("y "), part(month, 12), F.lit("m "), part(day, 30), F.lit("d")))
    )


def hours(seconds: Column | str, digits: int = 1) -> Column:
    return round_even(col(seconds) / 3600, digits)


# --- outcomes, tiers, policies ----------------------------------------------------------------
def outcome(reason_end: Column | str = "reason_end") -> Column:
    r = col(reason_end)
    return F.when(r == SKIP_REASON, "Skipped").when(r == DONE_REASON, "Completed").otherwise("Other")


def control_mode(reason_start: Column | str = "reason_start") -> Column:
    return F.when(col(reason_start) == DONE_REASON, "Passive").otherwise("Active")


def offline_label(c: Column | str = "offline") -> Column:
    v = col(c).cast("int")
    return F.when(v == 0, "Online").when(v == 1, "Offline")


def reason_risk(reason_start: Column | str, default: float = DEFAULT_SKIP_RATE) -> Column:
    table = F.create_map(*[F.lit(x) for kv in REASON_RISK.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.coalesce(F.lower(col(reason_start)), F.lit(""))), F.lit(default))


def risk_tier_4(prob: Column | str) -> Column:
    p = col(prob)
    return F.when(p >= 0.776, "CRITICAL").when(p >= 0.45, "HIGH").when(p >= 0.35, "MODERATE").otherwise("SAFE")


def risk_tier_3(prob: Column | str, threshold: Column | float) -> Column:
    p = col(prob)
    return F.when(p >= threshold, "CRITICAL").when(p < 0.35, "LOW").otherwise("MODERATE")


def grade(predicted: Column | str, actual: Column | str) -> Column:
    p, a = col(predicted), col(actual)
    return (
        F.when((p == 1) & (a == 1), "TRUE_POSITIVE")
        .when((p == 0) & (a == 0), "TRUE_NEGATIVE")
        .when((p == 1) & (a == 0), "FALSE_POSITIVE")
        .otherwise("FALSE_NEGATIVE")
    )


def mb_saved(predicted: Column | str, actual: Column | str, played: Column | str) -> Column:
    hit = (col(predicted) == 1) & (col(actual) == 1) & (col(played) < EARLY_SKIP_SECONDS)
    return F.when(hit, F.lit(MB_PER_PREFETCH)).otherwise(F.lit(0.0))


def completion_cutoff(duration: Column | str, short_track: str = "duration") -> Column:
    """Seconds below which a play counts as skipped. Tracks of 15 s or less follow ``short_track``:
    their own duration (``'duration'``) or a flat 30 s (``'flat30'``)."""
    d = col(duration)
    short = d if short_track == "duration" else F.lit(30.0)
    return F.when(d > 15.0, F.greatest(F.lit(10.0), d - 10.0)).otherwise(short)


def lookup_key(c: Column | str) -> Column:
    return F.trim(F.lower(col(c)))
