"""Scalar text functions as native column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that count as missing after cleaning.
MISSING_TOKENS = ("nan", "none", "null")
# Fixed value: query prefix for retrieval models of the "bge-" family.
BGE_QUERY_PREFIX = "Represent this sentence for searching relevant passages: "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x, default: str = "Unknown") -> Column:
    """``_`` to blank, collapse and trim whitespace; missing -> default."""
    col = _c(x).cast("string")
    collapsed = F.trim(F.regexp_replace(F.replace(col, F.lit("_"), F.lit(" ")), r"\s+", " "))
    missing = col.isNull() | (collapsed == "") | F.lower(collapsed).isin(*MISSING_TOKENS)
    return F.when(missing, F.lit(default)).otherwise(collapsed)


def title_case(x) -> Column:
    """Python ``str.title``: every run of letters starts upper, continues lower.

    ``initcap`` restarts only after blanks (``mid-century`` -> ``Mid-century``),
    so the string is cut into letter / non-letter runs instead.
    """
    runs = F.regexp_extract_all(_c(x), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cap = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    return F.array_join(cap, "")


def normalize_label(x) -> Column:
    """Clean then title case."""
    return title_case(clean_text(x))


def capitalize(x) -> Column:
    """Pandas ``str.capitalize`` -- first letter upper, the rest lower."""
    col = _c(x)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 1 << 30)))


def format_price(x) -> Column:
    """Whole prices print without decimals, others with two."""
    p = _c(x).cast("double")
    return F.when(p == F.floor(p), p.cast("bigint").cast("string")).otherwise(F.format_string("%.2f", p))


def description(style, material, category, color, price) -> Column:
    """``"{style} {material} {category} in {color} color. Price: {p}."``."""
    return F.concat(
        _c(style), F.lit(" "), _c(material), F.lit(" "), _c(category), F.lit(" in "),
        _c(color), F.lit(" color. Price: "), format_price(price), F.lit("."),
    )


def query_text(x, model_name: str | None = None, is_query: bool = False) -> Column:
    """Clean with empty default; ``bge-`` models get a prefix on queries."""
    cleaned = clean_text(x, "")
    if is_query and model_name and "bge-" in model_name.lower():
        return F.concat(F.lit(BGE_QUERY_PREFIX), cleaned)
    return cleaned


def filter_value(x) -> Column:
    """Trim + lower for attribute filter comparison."""
    return F.lower(F.trim(_c(x).cast("string")))
