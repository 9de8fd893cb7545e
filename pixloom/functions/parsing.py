"""Parsing of stored texts into values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def list_string(c: Column | str) -> Column:
    """A list stored in printed form with single quotes; null when it is none."""
    return F.from_json(F.translate(as_col(c), "'", '"'), "array<string>")


def metadata(c: Column | str, schema: str) -> Column:
    """A record stored in printed form with single quotes."""
    return F.from_json(F.translate(as_col(c), "'", '"'), schema)


def first_object(c: Column | str, schema: str) -> Column:
    """The first flat JSON object in free text; null when there is none."""
    return F.from_json(F.nullif(F.regexp_extract(as_col(c), r"(\{[^{}]*\})", 1), F.lit("")), schema)


def last_boxed(c: Column | str) -> Column:
    r"""Content of the last ``\boxed{...}`` without braces inside; null when there is none."""
    found = F.regexp_extract_all(as_col(c), F.lit(r"\\boxed\{([^{}]*)\}"), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def last_braced(c: Column | str) -> Column:
    """Content of the last ``{...}`` without braces inside; null when there is none."""
    found = F.regexp_extract_all(as_col(c), F.lit(r"\{([^{}]*)\}"), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def tagged(c: Column | str, tag: str) -> Column:
    """Trimmed content of the first ``<tag>...</tag>``, over lines; null when there is none."""
    inner = F.regexp_extract(as_col(c), rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(as_col(c).rlike(rf"(?s)<{tag}>.*?</{tag}>"), F.trim(inner))


def score_pair(c: Column | str) -> Column:
    """Two numbers at the head of a judgement, by blank or comma; (-1, -1) when they can't be read."""
    parts = F.split(F.trim(F.translate(F.split(as_col(c), "\n")[0], ",", " ")), " +")
    a = F.element_at(parts, 1).try_cast("double")
    b = F.when(F.size(parts) == 2, F.element_at(parts, 2).try_cast("double"))
    good = a.isNotNull() & b.isNotNull()
    return F.struct(F.when(good, a).otherwise(-1.0).alias("a"), F.when(good, b).otherwise(-1.0).alias("b"))


def section(c: Column | str, begin: str, end: str) -> Column:
    """Trimmed text between two markers; empty when one is missing."""
    t = as_col(c)
    rest = F.substring_index(t, begin, -1)
    return F.when(F.contains(t, F.lit(begin)) & F.contains(rest, F.lit(end)), F.trim(F.substring_index(rest, end, 1))).otherwise("")


def locator_kind(c: Column | str) -> Column:
    """What a stored string points at: data, url, path or text, with its media type."""
    t = F.lower(as_col(c))
    suffix = F.regexp_extract(t, r"\.([a-z0-9]{1,5})$", 1)
    image = suffix.isin("jpg", "jpeg", "png", "gif", "webp", "pgm")
    kind = F.when(t.startswith("data:"), "data").when(t.rlike("^https?://"), "url").when(suffix != "", "path").otherwise("text")
    media = (
        F.when(t.startswith("data:"), F.regexp_extract(t, "^data:([a-z]+/[a-z0-9.+-]+)", 1))
        .when(image, F.concat(F.lit("image/"), F.when(suffix == "jpg", "jpeg").otherwise(suffix)))
        .when(suffix == "json", "application/json").when(suffix == "txt", "text/plain").otherwise("unknown")
    )
    return F.struct(kind.alias("kind"), media.alias("media"))


def seconds(c: Column | str) -> Column:
    """``h:m:s``, ``m:s`` or plain seconds; null for anything else."""
    parts = F.transform(F.split(as_col(c), ":"), lambda p: p.try_cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc * 60 + x)
    return F.when((F.size(parts) <= 3) & ~F.exists(parts, lambda p: p.isNull()), total)
