"""Text expressions: combining fields, counting words, splitting into tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import LABEL

SEPARATOR = " | "

# The characters Python's str.split() treats as white space.
_SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# The general categories that Python's repr() leaves as they are, and the plain space.
# The ASCII range comes first because class members are tried in order.
_PRINTABLE = r"[ -~\p{L}\p{M}\p{N}\p{P}\p{S}]"


def _text(name: str) -> Column:
    return F.col(f"`{name}`")


def combine_flat(*names: str, separator: str = SEPARATOR) -> Column:
    """Join columns into one text; arrays contribute their elements, nulls nothing."""
    return F.concat_ws(separator, *[_text(n) for n in names])


def combine_spaced(*names: str) -> Column:
    return combine_flat(*names, separator=" ")


def _escape_unprintable(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    return (
        F.when(char.rlike(_PRINTABLE), char)
        .when(char == "\n", F.lit("\\n"))
        .when(char == "\r", F.lit("\\r"))
        .when(char == "\t", F.lit("\\t"))
        .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def quoted(text: Column) -> Column:
    """A string as Python prints it inside a list: quotes chosen and characters escaped alike."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    # Character-by-character work only for the rare texts that need it.
    escaped = F.when(text.rlike(rf"\A{_PRINTABLE}*\z"), escaped).otherwise(
        F.array_join(F.transform(F.split(escaped, ""), _escape_unprintable), "")
    )
    double = text.contains("'") & ~text.contains('"')
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return (
        F.when(text.isNull(), F.lit("None"))
        .when(double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(single)
    )


def list_text(items: Column) -> Column:
    """An array of strings as Python prints the list; null stays null."""
    inner = F.array_join(F.transform(items, quoted), ", ")
    return F.when(items.isNotNull(), F.concat(F.lit("["), inner, F.lit("]")))


def combine_listed(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """Join columns of ``df`` into one text with arrays printed as lists; null columns are skipped.

    By default every column but the label takes part, in the order of ``df``.
    """
    names = [c for c in df.columns if c != LABEL] if names is None else list(names)
    parts = []
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            parts.append(list_text(_text(name)))
        elif isinstance(kind, (T.StringType, T.IntegralType)):
            parts.append(_text(name).cast("string"))
        else:
            raise TypeError(f"column {name} of type {kind.simpleString()} has no list text")
    return F.concat_ws(SEPARATOR, *parts)


def word_count(text: Column) -> Column:
    """Number of white-space separated words, as ``len(text.split())`` in Python."""
    return F.regexp_count(text, F.lit(f"[^{_SPACE}]+"))


# Letters and digits; the ASCII ranges come first because class members are tried in order.
_TOKEN = r"[a-z0-9\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(_TOKEN))


# Character classes of the usual uncased word-piece scheme.
_DROPPED = r"[\p{Cc}\p{Cf}\p{Cn}\p{Co}\x{FFFD}&&[^\t\n\r]]"
_ALONE = (
    r"!-/:-@\[-`{-~\p{P}"
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)


def rough_words(text: Column) -> Column:
    """Words to cut into pieces: punctuation and ideographs stand alone, marks-only runs are left out.

    Case and accents are kept; they are folded once per distinct word when pieces are looked up.
    """
    usual = text.rlike(rf"\A[ -~\n\r\t\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{S}}\p{{Z}}]*\z") & ~text.contains("\uFFFD")
    clean = F.when(usual, text).otherwise(F.regexp_replace(text, _DROPPED, ""))
    found = F.regexp_extract_all(
        clean, F.lit(rf"[a-zA-Z0-9[^{_ALONE}\t\n\r\p{{Z}}]]+|[{_ALONE}]"), F.lit(0)
    )
    # Words are looked at one by one only in texts that have a mark at all.
    return F.when(clean.rlike(r"\p{Mn}"), F.filter(found, lambda w: ~w.rlike(r"^\p{Mn}+$"))).otherwise(found)


def fold(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    apart = unicodedata.normalize("NFD", word.lower())
    return "".join(c for c in apart if unicodedata.category(c) != "Mn")


def folded(word: Column) -> Column:
    """Words in lower case without accents, a batch at a time; meant for distinct words."""

    @F.arrow_udf("string")
    def fold_all(words: pa.Array) -> pa.Array:
        return pa.array([w if w is None else fold(w) for w in words.to_pylist()], pa.string())

    return fold_all(word)
