"""JSON message text to typed fields, as VARIANT expressions that never fail a task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numerals accepted inside JSON strings (single underscores may separate digits). The
# loops are possessive, so a long numeral needs no stack.
DIGITS = r"\d++(?:_\d++)*+"
INTEGER_TEXT = rf"^\s*[+-]?{DIGITS}\s*\z"
FLOAT_TEXT = (
    rf"(?i)^\s*[+-]?(?:nan|inf(?:inity)?|(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:e[+-]?{DIGITS})?)\s*\z"
)
# Fixed value: the bare literals that are valid numbers in a message though not in strict JSON.
BARE_LITERAL = r"(?<=[\s:,\[])(?:NaN|-?Infinity)(?=\s*[,}\]])"
# Whatever lies before the next bare literal outside a string. All loops are possessive, so the
# match needs no stack however long the message is.
UP_TO_BARE_LITERAL = (
    rf'(?s)\G((?:[^"NI\-]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"|(?!{BARE_LITERAL})[NI\-])*+)({BARE_LITERAL})'
)


def _wrapped(text: Column) -> Column:
    # Spark's parser stops after the first JSON value. As the first element of an array with a
    # closing 0, the message only parses when nothing but the one value is in it.
    return F.concat(F.lit("["), text, F.lit(",0]"))


def parse_document(text: Column) -> Column:
    """Message text to VARIANT ``[message, 0]``; null when it is not JSON."""
    quoted = F.regexp_replace(text, UP_TO_BARE_LITERAL, '$1"$2"')
    return F.coalesce(
        F.try_parse_json(_wrapped(text)),
        # A quoted "NaN" is read like the bare one, and is refused like it where no float fits.
        F.when(text.rlike(BARE_LITERAL), F.try_parse_json(_wrapped(quoted))),
    )


def is_single_value(document: str) -> Column:
    """Whether the message was one JSON value and nothing else."""
    return (
        F.variant_get(document, "$[1]", "variant").isNotNull()
        & F.variant_get(document, "$[2]", "variant").isNull()
    )


def is_object(document: str) -> Column:
    """Whether the message was a JSON object."""
    return F.startswith(F.schema_of_variant(F.variant_get(document, "$[0]", "variant")), F.lit("OBJECT"))


def with_kinds(df: DataFrame, document: str, names: list[str]) -> DataFrame:
    """Add ``_<name>_kind`` for top-level fields: the JSON type, null when the key is missing."""
    kinds = {f"_{n}_kind": F.schema_of_variant(F.variant_get(document, f"$[0].{n}", "variant")) for n in names}
    return df.withColumns(kinds)


class Field:
    """A top-level field of a parsed message, with its kind added by :func:`with_kinds`."""

    def __init__(self, document: str, name: str):
        self._document = document
        self._path = f"$[0].{name}"
        self._kind = F.col(f"_{name}_kind")
        self._text = self._as("string")

    def _as(self, data_type: str) -> Column:
        return F.try_variant_get(self._document, self._path, data_type)

    def is_missing(self) -> Column:
        """False also when the value is JSON null."""
        return self._kind.isNull()

    def json_string(self) -> Column:
        """The text of a JSON string; null for any other kind of value."""
        return F.when(self._kind == "STRING", self._text)

    def any_text(self) -> Column:
        """Any value as text; never null when the field is present."""
        return (
            F.when(self._kind == "STRING", self._text)
            .when(self._kind == "VOID", "None")
            .when(self._kind == "BOOLEAN", F.initcap(self._text))
            .otherwise(self._text)
        )

    def integer(self) -> Column:
        """32-bit integer: numbers are cut towards zero, booleans are 0 and 1."""
        numeral = F.regexp_replace(self._text, r"[_\s]", "")
        return F.when(
            self._kind == "STRING", F.when(self._text.rlike(INTEGER_TEXT), numeral.try_cast("int"))
        ).otherwise(self._as("int"))

    def double(self) -> Column:
        """Double, with ``nan`` and ``inf`` spellings accepted in strings."""
        numeral = F.regexp_replace(F.regexp_replace(self._text, r"[_\s]", ""), "(?i)^[+-]nan", "nan")
        return F.when(
            self._kind == "STRING", F.when(self._text.rlike(FLOAT_TEXT), numeral.try_cast("double"))
        ).otherwise(self._as("double"))
