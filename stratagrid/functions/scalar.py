"""Column functions: rounding, masks, scaling, labels, dates, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_MAX = 3.4028234663852886e38


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_mantissa(value: Column | str, bits: int) -> Column:
    """A float with `bits` of its 23 mantissa bits, ties to even; beyond the largest float it is infinite."""
    if not 0 <= bits <= 23:
        raise ValueError("0 to 23 bits")
    x = _c(value).cast("float").cast("double")
    if bits == 23:
        return x.cast("float")
    e = F.floor(F.log2(F.abs(x))).cast("double")
    e = F.when(F.pow(F.lit(2.0), e) > F.abs(x), e - 1).when(F.pow(F.lit(2.0), e + 1) <= F.abs(x), e + 1).otherwise(e)
    ulp = F.pow(F.lit(2.0), F.greatest(e, F.lit(-126.0)) - bits)
    y = F.rint(x / ulp) * ulp
    y = F.when(F.abs(y) > FLOAT_MAX, F.signum(y) * float("inf")).otherwise(y)
    plain = (x == 0) | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(plain, x).otherwise(y).cast("float")


def round_half_even(value: Column | str, places: int) -> Column:
    return F.bround(_c(value), places)


def mask_sentinel(value: Column | str, sentinel: float) -> Column:
    """NULL where the float equals the sentinel as a float."""
    return F.when(_c(value).cast("float") != F.lit(sentinel).cast("float"), _c(value))


def mask_any_bit(value: Column | str, flags: Column | str, mask: int, fill: int | None = None) -> Column:
    """NULL where any bit of `mask` is set or the flags are the fill value."""
    f = _c(flags).cast("long")
    bad = f.bitwiseAND(F.lit(mask)) != 0
    return F.when(~(bad | (f == fill) if fill is not None else bad), _c(value))


def mask_unless_bits(value: Column | str, flags: Column | str, mask: int, wanted: int, fill: int | None = None) -> Column:
    """NULL unless the bits of `mask` are exactly `wanted`."""
    f = _c(flags).cast("long")
    good = f.bitwiseAND(F.lit(mask)) == wanted
    return F.when(good & (f != fill) if fill is not None else good, _c(value))


def era(position: Column | str, cut, before: Column, since: Column) -> Column:
    return F.when(_c(position) < F.lit(cut), before).otherwise(since)


def scale(value: Column | str, factor: float = 1.0, offset: float = 0.0) -> Column:
    return _c(value) * factor + offset


def unpack(value: Column | str, factor: float, offset: float, sentinel: int) -> Column:
    """Packed integers: the sentinel is missing, others are factor * v + offset."""
    return F.when(_c(value) != sentinel, _c(value) * factor + offset)


def window_label(start_hours: Column | str, end_hours: Column | str, kind: str = "acc") -> Column:
    """anl, N hour fcst, A-B hour KIND fcst, or 0-D day KIND fcst for whole days from 0."""
    a, b = _c(start_hours).cast("long"), _c(end_hours).cast("long")
    days = (a == 0) & (b % 24 == 0) & (b > 0)
    span = F.when(days, F.concat(F.lit("0-"), (b / 24).cast("long").cast("string"), F.lit(f" day {kind} fcst"))).otherwise(F.concat(a.cast("string"), F.lit("-"), b.cast("string"), F.lit(f" hour {kind} fcst")))
    return F.when((a == b) & (b == 0), "anl").when(a == b, F.concat(b.cast("string"), F.lit(" hour fcst"))).otherwise(span)


def water_year(year: Column, month: Column) -> Column:
    return year + F.when(month >= 10, 1).otherwise(0)


def whole_hours(seconds: Column | str) -> Column:
    """Hours; NULL where the seconds are not whole hours."""
    s = _c(seconds)
    return F.when(s % 3600 == 0, (s / 3600).cast("long"))


def floor_to(seconds: Column | str, every: int) -> Column:
    return (F.floor(_c(seconds) / every) * every).cast("long")


def previous_fire(now_minutes: Column | str, minute: int, hours: list[int]) -> Column:
    """Minutes since 1970 of the last daily fire at `minute` of one of `hours`, at or before `now_minutes`."""
    now = _c(now_minutes)
    day = F.floor(now / 1440) * 1440
    fires = F.array(*(F.lit(h * 60 + minute - 1440 if back else h * 60 + minute) for back in (True, False) for h in sorted(hours)))
    return (day + F.array_max(F.filter(fires, lambda f: day + f <= now))).cast("long")


def init_from_name(name: Column | str) -> Column:
    """The one run of ten digits between underscores; NULL if there is none or more."""
    found = F.regexp_extract_all(_c(name), F.lit(r"_(\d{10})(?=_)"), F.lit(1))
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def date_first_path(path: Column | str, date: Column | str) -> Column:
    """var/file as date/var/file."""
    return F.concat_ws("/", _c(date), _c(path))


def split_var_path(path: Column | str) -> tuple[Column, Column]:
    """(group, name), parted at the last slash; a bare name has the group ''."""
    p = _c(path)
    cut = F.length(p) - F.length(F.substring_index(p, "/", -1))
    return F.when(cut > 0, F.substring(p, F.lit(1), cut - 1)).otherwise(""), F.substring_index(p, "/", -1)


def dataset_and_version(url: Column | str, suffix: str = ".zarr") -> tuple[Column, Column]:
    """The last two path parts of a URL, without the suffix."""
    parts = F.split(F.regexp_replace(_c(url), "/+$", ""), "/")
    last = F.element_at(parts, -1)
    return F.element_at(parts, -2), F.when(last.endswith(suffix), F.substring(last, F.lit(1), F.length(last) - len(suffix))).otherwise(last)


def slug(name: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(name)), "[^a-z0-9]+", "-"), F.lit("-"))


def template_url(template: str, **parts: Column) -> Column:
    """A URL from a printf-like template and columns, in order of their names' first use ({name:format})."""
    import re

    names = re.findall(r"\{(\w+)(?::([^}]*))?\}", template)
    fmt = re.sub(r"\{\w+(?::([^}]*))?\}", lambda m: "%" + (m[1] or "s"), template)
    return F.format_string(fmt, *(parts[n] for n, _ in names))


def signed_magnitude(value: Column | str, bits: int) -> Column:
    """An integer whose highest of `bits` bits is the sign."""
    v, top = _c(value).cast("long"), 1 << (bits - 1)
    return F.when(v.bitwiseAND(F.lit(top)) != 0, -(v.bitwiseAND(F.lit(top - 1)))).otherwise(v)


def planar_distance(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Squared equirectangular distance in degrees, with the cosine of the target's latitude."""
    return F.pow(lat - to_lat, F.lit(2)) + F.pow((lon - to_lon) * F.cos(F.radians(to_lat)), F.lit(2))


def digest8(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 8)


def rename(value: Column | str, names: dict[str, str]) -> Column:
    """The mapped name; a value without one stays."""
    pairs = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.coalesce(pairs[_c(value)], _c(value))


def join_var_path(group: Column | str, name: Column | str) -> Column:
    """group/name; a variable of no group is its bare name."""
    return F.when(F.coalesce(_c(group), F.lit("")) == "", _c(name)).otherwise(F.concat_ws("/", _c(group), _c(name)))


def pascal_case(name: Column | str) -> Column:
    return F.regexp_replace(F.initcap(F.regexp_replace(F.lower(_c(name)), "[^a-z0-9]+", " ")), " ", "")


def shortened(items: Column | str, ends: int = 3) -> Column:
    """A list for messages: all of it, or the first and last few around an ellipsis."""
    a = _c(items)
    short = F.concat(F.slice(a, 1, ends), F.array(F.lit("...")), F.slice(a, -ends, ends))
    return F.array_join(F.when(F.size(a) > 2 * ends, short).otherwise(a), ", ")


def tagged(kind: str, value: Column) -> Column:
    """JSON that says what a value was: {"kind": value}."""
    return F.to_json(F.struct(value.alias(kind)))


def coordinate_text(value: Column | str, places: int = 4) -> Column:
    return F.format_string(f"%.{places}f", _c(value).cast("double"))


def _iso_span(seconds: Column) -> Column:
    return F.concat(F.when(seconds < 0, F.lit("-")).otherwise(F.lit("")), F.lit("PT"), F.abs(seconds).cast("string"), F.lit("S"))


def tagged_place(place: dict[str, tuple[str, Column]]) -> Column:
    """A place (name to kind and value) as JSON text in which times and spans are tagged, so that they come back as what they were.

    Kinds: "ts" (a timestamp without zone), "td" (seconds), or "plain" (numbers, strings,
    truths). A time is {"__t": "ts", "v": ISO text}. NULLs are left out, as in JSON they
    are nothing.
    """
    out = []
    for name, (kind, value) in place.items():
        if kind == "ts":
            text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif kind == "td":
            text = _iso_span(value)
        elif kind == "plain":
            out.append(value.alias(name))
            continue
        else:
            raise ValueError(f"unknown kind {kind}")
        out.append(F.when(value.isNotNull(), F.struct(F.lit(kind).alias("__t"), text.alias("v"))).alias(name))
    return F.to_json(F.struct(*out))


def untagged(json: Column | str, kinds: dict[str, str]) -> list[Column]:
    """The values of a place by name: "ts" a timestamp without zone, "td" seconds as long, else the SQL type named.

    Values of another tag than asked for, unknown tags, absent names and text that is no
    JSON are NULL; an untagged value of a name that should have a tag too.
    """
    v = F.try_parse_json(_c(json))
    out = []
    for name, kind in kinds.items():
        at = f"$['{name}']"
        if kind in ("ts", "td"):
            tag, text = (F.try_variant_get(v, f"{at}.{part}", "string") for part in ("__t", "v"))
            seconds = F.regexp_extract(text, "^-?PT([0-9]+)S$", 1).try_cast("long")
            value = text.try_cast("timestamp_ntz") if kind == "ts" else F.when(text.startswith("-"), -seconds).otherwise(seconds)
            out.append(F.when(tag == kind, value).alias(name))
        else:
            out.append(F.try_variant_get(v, at, kind).alias(name))
    return out
