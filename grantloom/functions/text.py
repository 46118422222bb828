"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S

# what Python's ``str.strip`` removes, so that trimmed text equals the source system's
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def strip_or_blank(c: Column) -> Column:
    """Trimmed text, null becomes the empty string."""
    return strip(F.coalesce(c, F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def fold_case(c: Column) -> Column:
    """Key under the ledger's collation: case does not count, trailing blanks do not, accents do."""
    return F.upper(F.rtrim(c))


def contains(c: Column, word: str) -> Column:
    """``c LIKE '%word%'`` without regard to case."""
    return F.upper(c).contains(word.upper())


def has_any(folded: Column, words: Iterable[str]) -> Column:
    """Any of the words occurs in text that is upper case already."""
    first, *rest = [folded.contains(w.upper()) for w in words]
    for test in rest:
        first = first | test
    return first


def has_rule(folded: Column, rules: Sequence[tuple[str, str]]) -> Column:
    return has_any(folded, [word for word, _ in rules])


def first_rule(folded: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Label of the first rule whose word occurs in upper-case text; the order matters."""
    (word, label), *rest = rules
    out = F.when(folded.contains(word.upper()), F.lit(label))
    for word, label in rest:
        out = out.when(folded.contains(word.upper()), F.lit(label))
    return out.otherwise(F.lit(default))


def expense_class(
    c: Column,
    rules: Sequence[tuple[str, str]] = S.EXPENSE_CLASSES,
    default: str = S.OTHER_CLASS,
) -> Column:
    return first_rule(F.upper(c), rules, default)


def tax_id(c: Column) -> Column:
    """Digits only, zero-padded to 11 (person) or 14 (company); longer ids are kept whole."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    size = F.length(digits)
    width = F.greatest(size, F.when(size <= 11, F.lit(11)).otherwise(F.lit(14)))
    return F.lpad(digits, width, F.lit("0"))


def line_code(c: Column) -> Column:
    """Leading digits and dots of an expense type, or the empty string."""
    return F.coalesce(F.regexp_extract(c, r"^([0-9.]+)", 1), F.lit(""))


def clean_id(c: Column) -> Column:
    """``67303.0`` -> ``67303``; text that is no number is only trimmed."""
    text = strip(c.cast("string"))
    number = F.when(text.rlike(_NUMBER), text.try_cast("decimal(38,18)").try_cast("bigint"))
    return F.coalesce(number.cast("string"), text)


def line_key(contract: Column, code: Column) -> Column:
    """``{contract}-{code}``; null in either part gives null."""
    return F.concat(contract.cast("string"), F.lit("-"), code.cast("string"))


def contract_of(key: Column) -> Column:
    """Contract id in front of the first dash of a line key; null when there is no number."""
    return F.when(key.contains("-"), F.substring_index(key, "-", 1).try_cast("int"))


def field(c: Column, index: int, sep: str = ";") -> Column:
    """Field ``index`` (from 0) of delimited text, null when there are fewer."""
    return F.get(F.split(c, sep, -1), F.lit(index))


def days_phrase(c: Column, folded: Column) -> Column:
    """The ``30 DIAS`` part of a vacation text; ``folded`` is the text in upper case."""
    start, end = F.instr(folded, "-"), F.instr(folded, "DIAS")
    return F.when((start > 0) & (end > start), F.trim(c.substr(start + 1, end - start + 4)))


def date_after(folded: Column, marker: str) -> Column:
    """Date written ``dd/MM/yy`` right after ``marker``; null when absent or no date."""
    at = F.instr(folded, marker)
    text = folded.substr(at + F.lit(len(marker)), F.lit(8))
    iso = F.concat(
        F.lit("20"), F.right(text, F.lit(2)), F.lit("-"), F.substring(text, 4, 2), F.lit("-"), F.left(text, F.lit(2))
    )
    return F.when(at > 0, iso.try_cast("date"))
