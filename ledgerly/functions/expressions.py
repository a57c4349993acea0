"""Column builders: every row-level rule as a Catalyst expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Contract

#: Fixed value: the white space that collapses; vertical tab stays.
BLANKS = r"[ \t\n\f\r]+"
#: A number as text: no underscores, no type letters.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?|[nN]a[nN])\s*$"

# Codes of rejections with their descriptions, and of flags with severity and column.
ERRORS = {
    "NULL_ID": "id_cliente nulo",
    "EMPTY_ID": "id_cliente vacio tras recortar espacios",
    "NULL_DATE": "date nula",
    "INVALID_DATE": "date no parseable con los formatos aceptados",
    "NULL_PRODUCT": "product nulo",
    "NULL_TYPE": "type nulo",
    "UNKNOWN_TYPE": "type no mapeable a IN/OUT",
    "NULL_FUND": "fund nulo",
    "NULL_AMOUNT": "amount nulo: movimiento no reconciliable financieramente",
    "INVALID_AMOUNT_FORMAT": "amount no se puede convertir al formato numerico canonico",
    "NON_FINITE_AMOUNT": "amount NaN o infinito",
    "AMOUNT_OUT_OF_RANGE": "amount excede la precision decimal configurada",
}
FLAGS = {
    "INVALID_ID_FORMAT": ("WARNING", "id_cliente"),
    "UNKNOWN_PRODUCT": ("WARNING", "product"),
    "UNKNOWN_FUND": ("WARNING", "fund"),
    "DATE_OUT_OF_RANGE": ("WARNING", "date"),
    "AMOUNT_PRECISION_LOSS": ("WARNING", "amount"),
    "NEGATIVE_AMOUNT": ("INFO", "amount"),
    "ZERO_AMOUNT": ("INFO", "amount"),
    "NULL_AMOUNT_KEPT": ("WARNING", "amount"),
    "NULL_DESCRIPTION": ("INFO", "description"),
    "NULL_COMMERCIAL_NAME": ("INFO", "commercial_name"),
    "KEY_AMBIGUOUS": ("WARNING", "movement_key"),
}


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def collapsed(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.trim(c), BLANKS, " "), F.lit(""))


def parsed_date(c: Column, contract: Contract) -> Column:
    """The first format whose pattern the text has decides; no formats: a plain date."""
    text, out = F.trim(c), F.lit(None).cast("date")
    if not contract.date_formats:
        return F.try_to_date(text)
    for pattern, fmt in reversed(contract.date_formats):
        out = F.when(text.rlike(pattern), F.try_to_date(text, fmt)).otherwise(out)
    return out


def direction(c: Column, contract: Contract) -> Column:
    """IN or OUT by synonym; null for others."""
    word = F.lower(F.trim(c))
    return F.coalesce(*[F.when(word.isin(*words), F.lit(name)) for name, words in contract.synonyms.items()])


def canonical(c: Column, catalogue: tuple[str, ...]) -> Column:
    """The catalogue's spelling, whatever the case; other values stay."""
    clean = collapsed(c)
    spelling = F.create_map(*[F.lit(x) for v in catalogue for x in (v.lower(), v)])
    return F.coalesce(F.try_element_at(spelling, F.lower(clean)), clean)


def double_of(c: Column, kind: str) -> Column:
    return F.when(c.rlike(NUMBER), c.try_cast("double")) if kind == "string" else c.try_cast("double")


def non_finite(x: Column) -> Column:
    return F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(False))


def exact(x: Column, contract: Contract) -> Column:
    """A double as a decimal; null where it is not finite or does not fit."""
    return F.when(x.isNotNull() & ~non_finite(x), x.try_cast(contract.amount_type))


def extra_decimals(x: Column, contract: Contract) -> Column:
    scaled = x * F.lit(float(10**contract.scale))
    return F.coalesce(~non_finite(x) & (F.abs(scaled - F.round(scaled)) > 1e-6), F.lit(False))


def first_error(rejects_null_amount: bool) -> Column:
    """The first error of a normalised row, in the order of ERRORS; null if it is fit."""
    c = F.col
    rules = [
        ("NULL_ID", c("id_cliente_raw").isNull()),
        ("EMPTY_ID", c("id_cliente").isNull()),
        ("NULL_DATE", c("date_raw").isNull()),
        ("INVALID_DATE", c("movement_date").isNull()),
        ("NULL_PRODUCT", c("product").isNull()),
        ("NULL_TYPE", c("type_raw").isNull()),
        ("UNKNOWN_TYPE", c("type").isNull()),
        ("NULL_FUND", c("fund").isNull()),
        *([("NULL_AMOUNT", c("amount_text").isNull())] if rejects_null_amount else []),
        ("INVALID_AMOUNT_FORMAT", c("amount_text").isNotNull() & c("amount_raw").isNull()),
        ("NON_FINITE_AMOUNT", non_finite(c("amount_raw"))),
        ("AMOUNT_OUT_OF_RANGE", c("amount_raw").isNotNull() & c("amount").isNull()),
    ]
    return F.coalesce(*[F.when(test, F.lit(code)) for code, test in rules])


def quality_flags(contract: Contract, snapshot_date: Column, rejects_null_amount: bool) -> Column:
    c = F.col
    rules = [
        ("INVALID_ID_FORMAT", ~c("id_cliente").rlike(contract.id_pattern)),
        ("UNKNOWN_PRODUCT", ~c("product").isin(*contract.products)),
        ("UNKNOWN_FUND", ~c("fund").isin(*contract.funds)),
        ("DATE_OUT_OF_RANGE", c("movement_date") > F.date_add(snapshot_date, 1)),
        ("AMOUNT_PRECISION_LOSS", extra_decimals(c("amount_raw"), contract)),
        ("NEGATIVE_AMOUNT", c("amount") < 0),
        ("ZERO_AMOUNT", c("amount") == 0),
        *([] if rejects_null_amount else [("NULL_AMOUNT_KEPT", c("amount").isNull())]),
        ("NULL_DESCRIPTION", c("description").isNull()),
        ("NULL_COMMERCIAL_NAME", c("commercial_name").isNull()),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in rules]))


def lookup(key: Column, values: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def digest(contract: Contract, parts: list[Column]) -> Column:
    """SHA-256 over the version and the parts, nulls by token."""
    return F.sha2(F.concat_ws(contract.separator, F.lit(contract.hash_version), *[F.coalesce(p.cast("string"), F.lit(contract.null_token)) for p in parts]), 256)


def staged_name(column: str) -> str:
    """The staged name of a contract column."""
    return "movement_date" if column == "date" else column


def text_of(column: str) -> Column:
    return F.date_format("movement_date", "yyyy-MM-dd") if column in ("date", "movement_date") else F.col(column).cast("string")


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def share(a: Column, b: Column) -> Column:
    """A ratio as a double; null for a zero denominator."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def mean(c: Column) -> Column:
    """The mean of decimals as a double."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def quantile(c: Column, q: float, scale: int = 2) -> Column:
    """An interpolated quantile of decimals, cut to their scale towards the lower neighbour."""
    units = (c * F.lit(10**scale)).cast("long")
    return (F.floor(F.percentile(units, q)) / F.lit(10**scale)).cast(f"decimal(20,{scale})")


def conjunction(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms, F.lit(True))
