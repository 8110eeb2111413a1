"""Column cleaners for dirty text extracts (dates, numbers, strings, ids).

All are built-in expressions, so they run inside whole-stage codegen and
work unchanged on streaming DataFrames.  ANSI mode is on in Spark 4, so only
``try_*`` conversions are used on dirty text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts in strptime notation, in the order in
# which they are tried (for SQL oracles / DuckDB).
DATE_PATTERNS_STRPTIME = ["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y", "%Y%m%d", "%Y-%m",
                          "%Y/%m", "%m/%d/%Y"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Layouts by the first separator and its place, with the shape that each can parse: a
# row is only tried against the few layouts of its kind, so none pays for failed
# parses.  After the fixed list come day-first layouts that a lenient parser also reads.
_YEAR, _DAY = (5,), (2, 3)
_DATE_KINDS = [
    ("-", _YEAR, [(r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}-\d{1,2}$", "yyyy-M"),
                  (r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$", "yyyy-M-d")]),
    ("/", _YEAR, [(r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{4}/\d{1,2}$", "yyyy/M")]),
    ("/", _DAY, [(r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
                 (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy")]),
    ("-", _DAY, [(r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
                 (r"^\d{1,2}-\d{1,2}-\d{2}$", "d-M-yy")]),
    (".", _DAY, [(r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy")]),
    (" ", _DAY, [(r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy")]),
]


def parse_date(c) -> Column:
    """First layout that parses wins, day first before month first; a time of day
    is passed over; unparsable or null -> null."""
    s = F.trim(_c(c).cast("string"))
    day = F.substring_index(F.substring_index(s, " ", 1), "T", 1)
    out = None
    for sign, places, layouts in _DATE_KINDS:
        tried = F.coalesce(*[F.when(s.rlike(shape), F.try_to_date(day if ":" in shape else s, layout)) for shape, layout in layouts])
        kind = F.instr(s, sign).isin(*places)
        out = F.when(kind, tried) if out is None else out.when(kind, tried)
    return out.otherwise(F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd")))


def parse_date_sql(c: str) -> str:
    s = f"trim(CAST({c} AS VARCHAR))"
    return "COALESCE(" + ", ".join(
        f"CAST(try_strptime({s}, '{p}') AS DATE)" for p in DATE_PATTERNS_STRPTIME) + ")"


def clean_number(c) -> Column:
    """Money/number text -> double.

    Strip ``$`` and ``ARS``; with both separators the last one is the decimal
    mark; a lone comma is a decimal comma; unparsable or null -> 0.0."""
    s = F.trim(F.replace(F.replace(F.trim(_c(c).cast("string")), F.lit("$"), F.lit("")),
                         F.lit("ARS"), F.lit("")))
    has_dot = F.instr(s, ".") > 0
    has_comma = F.instr(s, ",") > 0
    last_comma_after_dot = F.length(s) - F.locate(",", F.reverse(s)) > F.length(s) - F.locate(".", F.reverse(s))
    both = F.when(last_comma_after_dot,
                  F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))\
        .otherwise(F.replace(s, F.lit(","), F.lit("")))
    norm = (F.when(has_dot & has_comma, both)
             .when(has_comma, F.replace(s, F.lit(","), F.lit(".")))
             .otherwise(s))
    return F.coalesce(F.when(norm.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), norm.try_cast("double")), F.lit(0.0))


def clean_number_sql(c: str) -> str:
    s = f"trim(replace(replace(trim(CAST({c} AS VARCHAR)), '$', ''), 'ARS', ''))"
    last_comma = f"(length({s}) - strpos(reverse({s}), ','))"
    last_dot = f"(length({s}) - strpos(reverse({s}), '.'))"
    return (f"COALESCE(TRY_CAST(CASE WHEN strpos({s}, '.') > 0 AND strpos({s}, ',') > 0 THEN "
            f"(CASE WHEN {last_comma} > {last_dot} THEN replace(replace({s}, '.', ''), ',', '.') "
            f"ELSE replace({s}, ',', '') END) "
            f"WHEN strpos({s}, ',') > 0 THEN replace({s}, ',', '.') ELSE {s} END AS DOUBLE), 0.0)")


def title_case(c) -> Column:
    """Python ``str.title``: upper after any non-letter, lower elsewhere."""
    low = F.lower(_c(c))
    chars = F.split(low, "")
    return F.array_join(F.transform(
        chars, lambda ch, i: F.when((i == 0) | ~F.element_at(chars, i).rlike(r"^\p{L}$"), F.upper(ch))
        .otherwise(ch)), "")


def clean_string(c, case: str = "none") -> Column:
    """null -> '', trim, collapse inner whitespace, optional case."""
    s = F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    uneven = F.contains(s, F.lit("  "))  # few texts have anything to collapse
    for sign in "\t\n\r\f\v":
        uneven = uneven | F.contains(s, F.lit(sign))
    s = F.when(uneven, F.regexp_replace(s, r"\s+", " ")).otherwise(s)
    if case == "upper":
        return F.upper(s)
    if case == "lower":
        return F.lower(s)
    if case == "title":
        return title_case(s)
    return s


def clean_string_sql(c: str, case: str = "none") -> str:
    s = f"regexp_replace(trim(COALESCE(CAST({c} AS VARCHAR), '')), '\\s+', ' ', 'g')"
    return {"upper": f"upper({s})", "lower": f"lower({s})"}.get(case, s)


def map_values(c, mapping: dict, default=None) -> Column:
    """Code -> label through a literal dictionary with a default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    d = F.lit(default) if default is not None else _c(c)
    return F.coalesce(F.element_at(m, _c(c)), d)


def map_values_sql(c: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in mapping.items())
    d = f"'{default}'" if default is not None else c
    return f"CASE {whens} ELSE {d} END"


def replace_values(c, values: list, replacement) -> Column:
    col = _c(c)
    return F.when(col.isNull() | col.isin(*values), F.lit(replacement)).otherwise(col)


def normalise_id(c, prefix: str, width: int = 5, numeric_prefix: str | None = None) -> Column:
    """Delimiters ``[ /_]`` -> ``-``; numeric last token -> ``numeric_prefix``
    (``prefix`` if not given) + zero padded number, otherwise prefix + the text."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"[ /_]", "-")
    last = F.element_at(F.split(s, "-"), -1)
    return F.when(last.rlike(r"^\d+$"), F.concat(F.lit(numeric_prefix or prefix), F.lpad(last, width, "0")))\
        .otherwise(F.concat(F.lit(prefix), s))


def impute_from_expr(value, fallback) -> Column:
    """null or <= 0 -> fallback expression (net weight = gross - tare)."""
    v = _c(value)
    return F.when(v.isNull() | (v <= 0), _c(fallback)).otherwise(v)


def changed(raw, clean) -> Column:
    """1 when the cleaned cell differs from the raw one (null vs '' counts)."""
    return F.when(_c(raw).cast("string").eqNullSafe(_c(clean).cast("string")), 0).otherwise(1)
