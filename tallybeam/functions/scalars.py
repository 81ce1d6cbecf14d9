"""Scalar functions of the ranking and reporting steps, as Column expressions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_S, YEAR_S = 86_400.0, 365.25 * 86_400.0
CHISQ_DOF = 30.0
EARTH_RADIUS_M, LIGHT_M_S = 6_371_000.0, 299_792_458.0
#: Seconds from the Unix epoch to the GPS epoch, less the leap seconds since then (fixed at 18).
GPS_TO_UNIX_S = 315_964_800 - 18


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def new_snr(snr: Column, chisq: Column) -> Column:
    """Signal-to-noise ratio down-weighted by chi-square; a ratio under 1 raises it. Broken snr gives 0, broken chisq leaves snr alone."""
    r = F.least(chisq / CHISQ_DOF, F.lit(1000.0))
    weighted = snr / F.pow((1.0 + r * r * r) / 2.0, F.lit(1.0 / 6.0))
    return F.when(~finite(snr) | (snr <= 0), 0.0).when(~finite(chisq) | (chisq < 0), snr).otherwise(weighted)


def reduced_chisq(chisq: Column) -> Column:
    return F.greatest(F.lit(0.0), chisq) / CHISQ_DOF


def zero_if_broken(x: Column) -> Column:
    return F.when(finite(x), x).otherwise(0.0)


def network_stat(*snrs: Column) -> Column:
    """Root of the sum of squares, broken values counting as 0."""
    squares = [zero_if_broken(s) * zero_if_broken(s) for s in snrs]
    total = squares[0]
    for s in squares[1:]:
        total = total + s
    return F.sqrt(total)


def rounded(x: Column, digits: int) -> Column:
    """x to a number of decimals, halves away from zero, as the SQL engine rounds: by doubles. Spark's own round goes by decimal text, which costs more than making the pairs whose statistic it rounds."""
    scaled = x * F.lit(10.0**digits)
    whole = F.rint(scaled)
    half = F.when((scaled - whole == 0.5) & (scaled > 0), 1.0).when((scaled - whole == -0.5) & (scaled < 0), -1.0).otherwise(0.0)
    return (whole + half) / F.lit(10.0**digits)


def chirp_mass(m1: Column, m2: Column) -> Column:
    return (m1 + m2) * F.pow(mass_ratio_symmetric(m1, m2), F.lit(0.6))


def mass_ratio_symmetric(m1: Column, m2: Column) -> Column:
    return m1 * m2 / ((m1 + m2) * (m1 + m2))


def template_distance(mc1: Column, eta1: Column, mc2: Column, eta2: Column) -> Column:
    """Spacing of two templates by chirp mass (relative to the second) and ten times the symmetric mass ratio."""
    dm = F.when(mc2 > 0, F.abs(mc1 - mc2) / mc2).otherwise(0.0)
    de = F.abs(eta1 - eta2) * 10.0
    return F.sqrt(dm * dm + de * de)


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance on a sphere, in metres."""
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b))


def far_hz(louder: Column, trials_s: Column, base: Column | None = None) -> Column:
    """(louder + 1) / trials; the base rate where there is no background."""
    rate = F.try_divide(louder + 1, trials_s)
    return F.coalesce(rate, base) if base is not None else rate


def ifar_days(far: Column) -> Column:
    """Null for a null or zero rate."""
    return F.try_divide(F.try_divide(F.lit(1.0), far), F.lit(DAY_S))


def empirical_p(louder: Column, n: Column) -> Column:
    return F.when(n == 0, 1.0).otherwise((louder + 1) / (n + 1))


def poisson_p(far: Column, observed_s: Column) -> Column:
    return 1.0 - F.exp(-observed_s * far)


def mean_rchisq(per_sensor: Column) -> Column:
    """Mean of a map from sensors to reduced chi-squares; a sensor without one counts as 1, no sensors as 1."""
    values = F.map_values(per_sensor)
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(1.0)))
    return F.coalesce(F.try_divide(total, F.size(values)), F.lit(1.0))


def detchar_rank(stat: Column, mean_rchisq: Column) -> Column:
    """Down-weighted by the mean reduced chi-square; 1 where there is none."""
    return stat / (1.0 + F.coalesce(mean_rchisq, F.lit(1.0)))


def pair_window_us(a: Column, b: Column, windows: dict[tuple[str, str], int]) -> Column:
    """The window of two sensors in either order; the widest of all for a pair without one."""
    low, high = F.least(a, b), F.greatest(a, b)
    out = F.lit(max(windows.values()))
    for (x, y), w in windows.items():
        out = F.when((low == min(x, y)) & (high == max(x, y)), w).otherwise(out)
    return out.cast("long")


def best_stat(new_snr: Column, snr: Column) -> Column:
    """The re-weighted ratio, else the plain one, else 0."""
    return F.coalesce(new_snr, snr, F.lit(0.0))


def template_duration_s(f_lower: Column) -> Column:
    """An upper estimate of how long a template lasts."""
    return F.try_divide(F.lit(100.0), f_lower)


def progress(share: Column) -> Column:
    """Overall progress while a share of the templates is done: from 0.2 to 0.7."""
    return 0.2 + 0.5 * F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))


def gps_to_utc(gps_s: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """UTC text; a dash for null or 0."""
    when = F.timestamp_micros(((gps_s.cast("double") + GPS_TO_UNIX_S) * 1e6).cast("long"))
    return F.when(gps_s.isNull() | (gps_s == 0), "-").otherwise(F.concat(F.date_format(when, pattern), F.lit(" UTC")))


def fixed(x: Column, digits: int) -> Column:
    """Text of a number with one or two decimal digits, rounded by its exact binary value, exact halves to even, as C's printf does; format_string rounds the shortest decimal up instead.

    The exact fraction counts in steps of 2^-52 if the number is 1 or more, and in steps of 2^-62 from 2^-10 on. Numbers below that, negative ones and those of 2^45 or more are left to format_string.
    """
    scale, whole = 10**digits, F.floor(x)

    def text(bits: int) -> Column:
        steps = ((x - whole) * F.lit(float(1 << bits))).cast("long").cast("decimal(20,0)") * F.lit(scale).cast("decimal(4,0)")  # all exact
        one = F.lit(str(1 << bits)).cast("decimal(20,0)")
        down = ((steps - steps % one) / one).cast("long")
        twice = (steps % one) * F.lit(2).cast("decimal(1,0)")
        units = whole * scale + down + F.when((twice > one) | ((twice == one) & (down % 2 == 1)), 1).otherwise(0)
        return F.concat(F.floor(units / scale).cast("string"), F.lit("."), F.lpad((units % scale).cast("string"), digits, "0"))

    return F.when((x >= 1) & (x < float(1 << 45)), text(52)).when((x >= 2.0**-10) & (x < 1), text(62)).otherwise(F.format_string(f"%.{digits}f", x))


def ifar_text(days: Column) -> Column:
    return (
        F.when(days.isNull(), "-")
        .when(days > 365, F.concat(fixed(days / 365, 1), F.lit(" yr")))
        .when(days > 30, F.concat(fixed(days, 1), F.lit(" days")))
        .when(days > 1, F.concat(fixed(days, 2), F.lit(" days")))
        .otherwise(F.concat(fixed(days * 24, 2), F.lit(" hr")))
    )


def assessment(days: Column) -> Column:
    return F.when(days.isNull(), "unknown").when(days > 36_500, "confident").when(days > 365, "marginal").otherwise("noise")


def template_number(text: Column) -> Column:
    """The template id as a number, 0 if it is none."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def escape_html(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def colour_log(line: Column) -> Column:
    """A log line, escaped, in a span of its level's class."""
    level = F.lit("INFO")
    for name in ("DEBUG", "WARNING", "ERROR"):
        level = F.when(line.contains(f" {name} "), name).otherwise(level)
    return F.concat(F.lit('<span class="log-'), level, F.lit('">'), escape_html(line), F.lit("</span>"))


def join_ifos(ifos: Column) -> Column:
    return F.array_join(ifos, ",")


def split_ifos(text: Column) -> Column:
    """Names of sensors; null gives one empty name."""
    return F.split(F.coalesce(text, F.lit("")), ",")


def parse_json_or_text(text: Column) -> Column:
    """A variant: the parsed JSON, or the text itself where it is none."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def error_kind(message: Column) -> Column:
    """gap for messages about missing data, else error."""
    m = F.lower(message)
    return F.when(m.contains("data gap") | m.contains("detector was off") | m.contains("rms"), "gap").otherwise("error")


def sigma(p: Column) -> Column:
    """Two-sided normal significance |inverse normal(1 - p)|; no built-in exists, so Arrow batches go through the standard library."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def inverse(values):
        from statistics import NormalDist

        inv = NormalDist().inv_cdf
        return values.clip(1e-15, 1 - 1e-15).map(lambda x: abs(inv(1 - x)), na_action="ignore")

    return inverse(p)
