"""Scalar ``Column -> Column`` functions.

All of these compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen. The traps that make a naive translation disagree with the
SQL semantics the pipeline was defined in are handled here, once:

* rounding is half-away-from-zero on the binary double (``round(x * 10^d) / 10^d``),
  not Spark's decimal HALF_UP ``round`` (trap 5);
* the Brzycki constants are double literals, not decimals (trap 4);
* minute differences count minute *boundaries* crossed (trap 3);
* the weekday name is the full English name (trap 2);
* text -> integer casts round instead of failing or truncating (trap 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName

# Fixed values that define results (must stay exactly as written).
LB_PER_KG = 2.20462
E1RM_MAX_REPS = 12
BRZYCKI_NUMERATOR = 36.0
BRZYCKI_DENOMINATOR = 37.0
PART_OF_DAY_BOUNDS = [(5, "night"), (11, "morning"), (14, "midday"), (18, "afternoon")]
PART_OF_DAY_ELSE = "evening"
SET_TYPES = ["normal", "warmup", "dropset", "failure"]
EXERCISE_TYPES = [
    "weight_reps", "reps_only", "bodyweight_weighted", "bodyweight_assisted", "duration",
    "distance_duration", "weight_duration", "floors_duration", "steps_duration",
]
WEIGHT_SEMANTICS = {
    "reps_only": "none",
    "bodyweight_weighted": "added_to_bodyweight",
    "bodyweight_assisted": "assistance_not_convertible",
}
WEIGHT_SEMANTICS_ELSE = "external_load"
BODYWEIGHT_TYPES = ["bodyweight_weighted", "bodyweight_assisted", "reps_only"]
LOAD_METRIC_TYPES = ["weight_reps", "bodyweight_weighted"]
DEFAULT_LOCAL_TZ = "America/New_York"


def round_half_away(c: ColumnOrName, digits: int) -> Column:
    """``round(x, d)`` as a binary-double operation: sign(x) * floor(|x| * 10^d + 0.5) / 10^d.

    Spark's own ``round`` rounds the exact decimal expansion HALF_UP, which differs
    on values such as 1.005 (stored as 1.00499999...). Null stays null. From 2**53 on, the
    scaled value has no fraction left and x is returned as it is.
    """
    x = as_col(c).cast("double")
    scale = float(10 ** digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) >= F.lit(float(1 << 53)), x).otherwise(rounded)


def weight_lb(kg: ColumnOrName) -> Column:
    """Pounds as typed: ``round(kg * 2.20462, 2)``. Source weights are lb / 2.20462 with float noise."""
    return round_half_away(as_col(kg).cast("double") * F.lit(LB_PER_KG), 2)


def weight_kg_canonical(kg: ColumnOrName) -> Column:
    """Kilograms rounded to 3 dp, enough to separate real increments from noise."""
    return round_half_away(as_col(kg).cast("double"), 3)


def e1rm(weight: ColumnOrName, reps: ColumnOrName) -> Column:
    """Estimated one-rep max, Brzycki: ``w * (36 / (37 - reps))``.

    Null when reps > 12, reps <= 0, reps null or weight null. Double literals keep
    the arithmetic in binary floating point (a decimal 36.0/37.0 gives different
    last digits for 8 of the 12 rep counts).
    """
    w, r = as_col(weight).cast("double"), as_col(reps)
    return (F.when(r > E1RM_MAX_REPS, F.lit(None).cast("double"))
            .when(r <= 0, F.lit(None).cast("double"))
            .when(w.isNull(), F.lit(None).cast("double"))
            .otherwise(w * (F.lit(BRZYCKI_NUMERATOR) / (F.lit(BRZYCKI_DENOMINATOR) - r.cast("double")))))


def epley(weight: ColumnOrName, reps: ColumnOrName) -> Column:
    """Epley alternative ``w * (1 + reps / 30)`` (designed, G5); same validity gate as Brzycki."""
    w, r = as_col(weight).cast("double"), as_col(reps)
    return (F.when((r > E1RM_MAX_REPS) | (r <= 0) | w.isNull(), F.lit(None).cast("double"))
            .otherwise(w * (F.lit(1.0) + r.cast("double") / F.lit(30.0))))


def effective_load(weight_kg: ColumnOrName, semantics: ColumnOrName, bodyweight_kg: float | Column) -> Column:
    """Load actually moved (designed, G4): external load as is; added to bodyweight ->
    bodyweight + weight; assistance -> bodyweight - weight; no weight -> bodyweight."""
    w, s = as_col(weight_kg).cast("double"), as_col(semantics)
    bw = bodyweight_kg if isinstance(bodyweight_kg, Column) else F.lit(float(bodyweight_kg))
    return (F.when(s == "added_to_bodyweight", bw + F.coalesce(w, F.lit(0.0)))
            .when(s == "assistance_not_convertible", bw - F.coalesce(w, F.lit(0.0)))
            .when(s == "none", bw)
            .otherwise(w))


def to_local(ts_utc: ColumnOrName, tz: str = DEFAULT_LOCAL_TZ) -> Column:
    """UTC instant (TIMESTAMP, or TIMESTAMP_NTZ read as UTC) -> naive local wall time (TIMESTAMP_NTZ).

    Requires the session time zone to be UTC (see ``repsmith.session``): the NTZ input is
    read as a UTC instant and the shifted result is read back as wall time. Equal to
    ``convert_timezone('UTC', tz, ts)`` including both DST transitions, and cheaper."""
    return F.from_utc_timestamp(as_col(ts_utc).cast("timestamp"), tz).cast("timestamp_ntz")


def utc_instant(text_or_ts: ColumnOrName) -> Column:
    """ISO text with offset (or naive text read as UTC) -> TIMESTAMP (session tz must be UTC)."""
    return as_col(text_or_ts).cast("timestamp")


def local_hour(local_ts: ColumnOrName) -> Column:
    return F.hour(as_col(local_ts)).cast("long")


def iso_day_of_week(local_ts: ColumnOrName) -> Column:
    """ISO day number, 1 = Monday .. 7 = Sunday."""
    return (F.weekday(as_col(local_ts)) + F.lit(1)).cast("long")


def day_name(local_ts: ColumnOrName) -> Column:
    """Full English weekday name (``Monday``); Spark's ``dayname`` gives ``Mon``."""
    return F.date_format(as_col(local_ts), "EEEE")


def is_weekend(local_ts: ColumnOrName) -> Column:
    return iso_day_of_week(local_ts) >= 6


def part_of_day(hour: ColumnOrName, match_reference: bool = True) -> Column:
    """Five coarse buckets of the local hour. A null hour falls to ``evening`` like the
    SQL CASE it mirrors, unless ``match_reference=False``."""
    h = as_col(hour)
    expr = None
    for bound, label in PART_OF_DAY_BOUNDS:
        expr = F.when(h < bound, F.lit(label)) if expr is None else expr.when(h < bound, F.lit(label))
    if not match_reference:
        expr = expr.when(h.isNull(), F.lit(None).cast("string"))
    return expr.otherwise(F.lit(PART_OF_DAY_ELSE))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (10:00:59 -> 10:01:01 is 1)."""
    s = F.date_trunc("minute", as_col(start).cast("timestamp"))
    e = F.date_trunc("minute", as_col(end).cast("timestamp"))
    return F.timestamp_diff("MINUTE", s, e).cast("long")


def days_between(start_date: ColumnOrName, end_date: ColumnOrName) -> Column:
    return F.datediff(as_col(end_date), as_col(start_date)).cast("long")


def nullif_blank(s: ColumnOrName) -> Column:
    """``nullif(trim(s), '')``: blank or space-only text becomes null."""
    return F.nullif(F.trim(as_col(s)), F.lit(""))


def positional_key(*parts: ColumnOrName, sep: str = "-") -> Column:
    """``a-b-c`` composite key; null in any part gives null (SQL ``||`` semantics)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(as_col(p).cast("string"))
    return F.concat(*cols)


def lenient_int(text: ColumnOrName) -> Column:
    """Text -> INT rounding half away from zero ('5.0' -> 5, '5.7' -> 6); junk -> null."""
    d = as_col(text).cast("string").try_cast("double")
    return round_half_away(d, 0).try_cast("int")


def lenient_double(text: ColumnOrName) -> Column:
    return as_col(text).cast("string").try_cast("double")


def lenient_bool(text: ColumnOrName) -> Column:
    return as_col(text).cast("string").try_cast("boolean")


def weight_semantics(exercise_type: ColumnOrName) -> Column:
    """What the weight column means for an exercise type (simple CASE; null -> external_load)."""
    t = as_col(exercise_type)
    expr = None
    for k, v in WEIGHT_SEMANTICS.items():
        expr = F.when(t == k, F.lit(v)) if expr is None else expr.when(t == k, F.lit(v))
    return expr.otherwise(F.lit(WEIGHT_SEMANTICS_ELSE))


def is_bodyweight(exercise_type: ColumnOrName) -> Column:
    return as_col(exercise_type).isin(*BODYWEIGHT_TYPES)


def supports_load_metrics(exercise_type: ColumnOrName) -> Column:
    """Keyed off the exercise type, not weight semantics (duration/distance types have no load)."""
    return as_col(exercise_type).isin(*LOAD_METRIC_TYPES)


def has_estimated_load(exercise_type: ColumnOrName) -> Column:
    return weight_semantics(exercise_type) == F.lit("added_to_bodyweight")


def set_flags(set_type: ColumnOrName) -> dict[str, Column]:
    """Three-valued flags from the set type (null type -> null flags)."""
    t = as_col(set_type)
    return {
        "is_working_set": t != F.lit("warmup"),
        "is_warmup": t == F.lit("warmup"),
        "is_to_failure": t == F.lit("failure"),
        "is_dropset": t == F.lit("dropset"),
    }


def near_step(value: ColumnOrName, step: float, tol: float = 0.01) -> Column:
    """``|v/step - round_half_even(v/step)| * step < tol``: is v on a gym increment?"""
    q = as_col(value).cast("double") / F.lit(float(step))
    return F.abs(q - F.rint(q)) * F.lit(float(step)) < F.lit(tol)


def rest_bucket(days: ColumnOrName, cap: int = 7) -> Column:
    """Rest-day bucket: ``'7+'`` at or above the cap, else the integer as text; null stays null."""
    d = as_col(days)
    return F.when(d >= cap, F.lit(f"{cap}+")).otherwise(d.cast("long").cast("string"))


def rest_bucket_designed(days: ColumnOrName) -> Column:
    """Designed buckets 1, 2, 3, 4-6, 7+ (G7); 0 (same day) stays '0'."""
    d = as_col(days)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d >= 7, F.lit("7+"))
            .when(d >= 4, F.lit("4-6"))
            .otherwise(d.cast("long").cast("string")))


def run_stamp(ts: ColumnOrName | None = None) -> Column:
    """Run id text ``yyyyMMddTHHmmssZ`` of an instant (default: now)."""
    c = F.current_timestamp() if ts is None else as_col(ts)
    return F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")


def iso_utc_text(ts: ColumnOrName) -> Column:
    """Instant -> ``yyyy-MM-ddTHH:mm:ss.SSSSSSZ`` text (UTC session)."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def bump_millisecond(ts: ColumnOrName) -> Column:
    """Inclusive ``since`` bound -> exclusive: add one millisecond."""
    return as_col(ts) + F.expr("INTERVAL '0.001' SECOND")
