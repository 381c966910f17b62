"""Cleaning functions: Column to Column, all inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that mean "not applicable". nil and none are information and stay.
NA_PATTERN = r"^(na|n\.a\.?|n/a|not applicable|-+)$"


def strip_ns_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"^[^:]+:", "")


def is_na_text(c: Column) -> Column:
    """A null is not an answer at all, so it is not "not applicable" either."""
    return F.coalesce(F.lower(F.trim(c)).rlike(NA_PATTERN), F.lit(False))


def fiscal_year_start(d: Column) -> Column:
    """The April in which the financial year of a date began."""
    return F.year(d) - F.when(F.month(d) < 4, 1).otherwise(0)


def fiscal_year_label(d: Column) -> Column:
    start = fiscal_year_start(d)
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def iso_duration_days(c: Column) -> Column:
    """P59D is 59.0; anything else is null."""
    return F.nullif(F.regexp_extract(c, r"^P([0-9]+(?:\.[0-9]+)?)D$", 1), F.lit("")).try_cast("double")


def number_from_text(c: Column) -> Column:
    return F.regexp_replace(c, r"[,\s ]", "").try_cast("double")


def normalise_text_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def dimension_axes(c: Column) -> Column:
    """AxisA=x|AxisB=y has the axes AxisA and AxisB; an empty key has none."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, r"\|"), lambda d: F.split_part(d, F.lit("="), F.lit(1))))


def mapped(c: Column, values: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """A small constant map as one expression."""
    found = F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    return F.coalesce(F.try_element_at(found, c), otherwise if otherwise is not None else F.lit(None).cast("string"))


def round_sig(c: Column, digits: int = 15) -> Column:
    """Rounded to so many significant digits; zero and null stay."""
    return F.when(c == 0, c).otherwise(F.format_string(f"%.{digits - 1}e", c).try_cast("double"))


def first_containing(c: Column, labels: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first substring that c holds."""
    out = None
    for part, label in labels:
        hit = c.contains(part)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def is_scale_error(ratio: Column, is_percent: Column) -> Column:
    far = F.when(is_percent, (ratio >= 10) | (ratio <= 0.1)).otherwise((ratio > 100) | (ratio < 0.01))
    return F.coalesce(far, F.lit(False))


def nearest_power_basis(ratio: Column, powers: Sequence[float] = (1.0, 1e5, 1e6, 1e7), share: float = 0.25) -> Column:
    """The power that the ratio lies within a share of, else null."""
    return F.coalesce(*(F.when(ratio.between(p * (1 - share), p * (1 + share)), F.lit(p)) for p in powers))


def reweighted_mean(values: Sequence[Column], weights: Sequence[Column | float], least: int = 2) -> Column:
    """Weighted mean of the values that are there, their weights made up to 1; null if fewer than `least` are."""
    weights = [w if isinstance(w, Column) else F.lit(float(w)) for w in weights]
    there = [F.when(v.isNotNull(), 1).otherwise(0) for v in values]
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in zip(values, weights)), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in zip(values, weights)), F.lit(0.0))
    return F.when(sum(there, F.lit(0)) >= least, total / F.nullif(weight, F.lit(0.0)))


def clean_name(c: Column) -> Column:
    """Without broken characters, curly quotes and bracketed text; Ltd written out."""
    c = F.translate(F.regexp_replace(c, "�", ""), "‘’“”", "''\"\"")
    c = F.regexp_replace(c, r"\([^)]*\)", " ")
    c = F.regexp_replace(c, r"\b[Ll][Tt][Dd]\b\.?", "Limited")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def title_case_if_upper(c: Column) -> Column:
    """ALL CAPITALS become Title Case, word by word; other spellings stay."""
    return F.when((c == F.upper(c)) & (c != F.lower(c)), F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), " ")).otherwise(c)


def valid_code(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


#: Accented letters and their plain forms.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def name_key(c: Column) -> Column:
    """Lower case, no accents, "and" for &, everything else than letters and digits an underscore."""
    c = F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), "&", " and ")
    return F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9]+", "_"), r"^_|_$", "")


def strip_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>|&nbsp;", " "), r"\s+", " "))


#: RE2's word ends and white space, which Java's \b and \s aren't: Java knows more letters, and the vertical tab.
_EDGE, _DARK = r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))", r"[^\t\n\f\r ]"


def keyword_snippet(c: Column, words: str, before: int = 120, after: int = 170, most: int = 300) -> Column:
    """The leftmost match of at most `before` characters, one of `words` (plain words, parted by |) as a whole word and at most
    `after` characters, links masked; null where nothing matches. As in a regular expression that takes what it can, a text with
    several of the words near its start goes on after the last that begins within `before` characters. Characters are code points."""
    word = _EDGE + "(?:" + re.sub(r"(?<!\\)[ksKS]", lambda m: "[s\u017f]" if m[0] in "sS" else "[k\u212a]", words) + ")" + _EDGE
    head = F.split(c, f"(?i){word}", 2)  # what stands before the first word: its length counts code points, regexp_instr doesn't
    start = F.greatest(F.length(F.get(head, F.lit(0))) + 1 - before, F.lit(1))
    found = F.when(F.size(head) > 1, F.regexp_extract(F.substr(c, start), f"(?si)^.{{0,{before}}}{word}.{{0,{after}}}", 0))
    return F.left(F.regexp_replace(found, rf"https?://{_DARK}+", "[link]"), F.lit(most))


def pack_flags(flags: Sequence[tuple[Column, str]]) -> Column:
    """Labels of the conditions that hold, joined by |; null if none does."""
    return F.nullif(F.concat_ws("|", *(F.when(cond, label) for cond, label in flags)), F.lit(""))


def unpack_flags(df: DataFrame, flags: str, out: str = "flag") -> DataFrame:
    """One row for each packed label; rows without any go."""
    return df.where(F.col(flags).isNotNull()).withColumn(out, F.explode(F.split(flags, r"\|")))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero or missing."""
    return numerator / F.nullif(denominator, F.lit(0))


def select_except(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def select_replace(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def null_implausible_zeros(df: DataFrame, rules: Mapping[str, Column], flag: str = "zeros_dropped") -> DataFrame:
    """Zeros that a rule on other columns makes implausible become null; the flag lists their columns."""
    hits = {c: (F.col(c) == 0) & rule for c, rule in rules.items()}
    flagged = df.withColumn(flag, pack_flags([(hit, c) for c, hit in hits.items()]))
    return flagged.withColumns({c: F.when(~F.coalesce(hit, F.lit(False)), F.col(c)) for c, hit in hits.items()})


def stable_row_id(*columns: str) -> Column:
    """The same for the same values; a null counts as an empty text in its place."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256), 1, 32)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as declared types, trimmed; what doesn't fit is null."""
    return df.withColumns({c: F.trim(c).try_cast(t) for c, t in types.items()})
