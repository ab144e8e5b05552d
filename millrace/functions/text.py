"""Pre-tokenisation and byte symbols."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The byte-level word pattern and the reserved tokens, in id order.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL_TOKENS = ("<s>", "</s>", "<pad>", "<unk>")


def _byte_symbols() -> list[str]:
    """One printable character per byte: itself if printable, else 256 and up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, spare = [], 256
    for byte in range(256):
        if byte in printable:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


BYTE_SYMBOLS = _byte_symbols()


def required(column: Column, what: str) -> Column:
    """``column``, with a null failing the job instead of vanishing later on."""
    return F.coalesce(column, F.raise_error(F.lit(f"{what} is null")))


def split_words(text: Column, prefix_space: bool = True) -> Column:
    """The words of ``text`` in order, after putting one space before it if ``prefix_space``."""
    if prefix_space:
        text = F.when((text == "") | text.startswith(" "), text).otherwise(F.concat(F.lit(" "), text))
    return F.regexp_extract_all(text, F.lit("(?U)" + WORD_PATTERN), F.lit(0))


def split_words_and_specials(text: Column, specials: Sequence[str], prefix_space: bool = True) -> Column:
    """Like :func:`split_words`, keeping each special token as a word of its own.

    The stretches between special tokens are split separately, each with its own
    leading space. Texts without a special token skip the extra regex passes.
    """
    if not specials:
        return split_words(text, prefix_space)
    pattern = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(
        gaps,
        found,
        lambda gap, special: F.concat(
            split_words(gap, prefix_space),
            F.when(special.isNull(), F.array().cast("array<string>")).otherwise(F.array(special)),
        ),
    )
    has_special = F.contains(text, F.lit(specials[0]))
    for special in specials[1:]:
        has_special = has_special | F.contains(text, F.lit(special))
    return F.when(has_special, F.flatten(pieces)).otherwise(split_words(text, prefix_space))


def utf8_as_latin1(text: Column) -> Column:
    """A string with one character per UTF-8 byte of ``text``."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def byte_symbols(text: Column) -> Column:
    """``text`` spelled with one printable symbol per UTF-8 byte."""
    changed = [byte for byte in range(256) if BYTE_SYMBOLS[byte] != chr(byte)]
    return F.translate(
        utf8_as_latin1(text),
        "".join(chr(byte) for byte in changed),
        "".join(BYTE_SYMBOLS[byte] for byte in changed),
    )


def latin1_as_utf8(bytes_text: Column) -> Column:
    """Inverse of :func:`utf8_as_latin1`; broken sequences become U+FFFD."""
    return F.make_valid_utf8(F.encode(bytes_text, "ISO-8859-1").cast("string"))
