"""Column expressions for prompts, sentences, phonemes and token text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from phonolake.functions import tokens as T

LAST_TOKEN_PATTERN = r"<custom_token_([+-]?[0-9]+)>$"
TEXT_TOKEN_PATTERN = r"[\pL\pM]+|\pN+|[^\x09-\x0D\x20\pL\pM\pN]"
#: The published pattern that cuts a text before the merges of byte-level rank files.
SUBWORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens that a vocabulary is extended with; they are cut out of a text before anything else.
ADDED_PATTERN = r"<custom_token_[0-9]+>|<\|ph_[A-Za-z]+\|>"
PHONEME_PATTERN = r"<\|ph_[A-Za-z]+\|>"


def strip(text: Column) -> Column:
    """Trim all Unicode white space on both ends."""
    return F.btrim(text, F.lit(T.WHITESPACE))


def voice_prompt(speaker: Column, text: Column) -> Column:
    """``speaker: text``, or the text alone without a speaker."""
    return F.when(F.coalesce(speaker, F.lit("")) != "", F.concat(speaker, F.lit(": "), text)).otherwise(text)


def template_prompt(template: str | None, speaker: Column, text: Column) -> Column:
    """Fill ``{speaker_id}`` first and ``{text}`` second; no template gives the text."""
    if not template:
        return text
    filled = F.replace(F.lit(template), F.lit("{speaker_id}"), speaker)
    return F.replace(filled, F.lit("{text}"), text)


def bracket_prompt(voice: Column, text: Column) -> Column:
    """Prompt form of the small model."""
    tag = F.when(F.coalesce(voice, F.lit("")) != "", F.concat(F.lit("["), voice, F.lit("]"))).otherwise("")
    return F.concat(F.lit("<custom_token_3>"), text, tag, F.lit("<custom_token_4><custom_token_5>"))


def marks_of(granularity: str) -> str:
    """Any granularity other than ``sentence`` cuts at clause marks too."""
    return T.SENTENCE_MARKS if granularity == "sentence" else T.CLAUSE_MARKS


def char_class(chars: str) -> str:
    return "".join("\\" + c if c in "]\\^-[" else c for c in chars)


def piece_pattern(granularity: str) -> str:
    """One piece: up to a mark with the closing characters behind it, or the rest without a mark."""
    marks, closing = char_class(marks_of(granularity)), char_class(T.CLOSING_CHARS)
    return f"[^{marks}]*[{marks}][{closing}]*|[^{marks}]+"


def sentences(text: Column, granularity: str = "sentence") -> Column:
    """Trimmed non-empty pieces in text order."""
    pieces = F.regexp_extract_all(text, F.lit(piece_pattern(granularity)), F.lit(0))
    return F.filter(F.transform(pieces, strip), lambda p: p != "")


def ready_pieces(buffer: str, granularity: str) -> tuple[list[str], str]:
    """Pieces whose end is certain, and the rest.

    A piece ends behind a mark and its closing characters once another character follows: until then more closing
    characters may come.
    """
    marks, closing = char_class(marks_of(granularity)), char_class(T.CLOSING_CHARS)
    certain = re.compile(f"[^{marks}]*[{marks}][{closing}]*(?=[^{closing}])")
    pieces, at = [], 0
    while found := certain.match(buffer, at):
        pieces.append(found.group().strip())
        at = found.end()
    return [p for p in pieces if p], buffer[at:]


def rest_pieces(buffer: str, granularity: str) -> list[str]:
    """All pieces of a text that is complete."""
    return [p for p in (m.strip() for m in re.findall(piece_pattern(granularity), buffer)) if p]


def words(text: Column) -> Column:
    """Lower-case letter runs."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-zà-ÿ]+"), F.lit(0))


def text_tokens(text: Column) -> Column:
    """The whole text but for its blanks: letters with their marks, numbers, and every other character alone."""
    return F.regexp_extract_all(text, F.lit(TEXT_TOKEN_PATTERN), F.lit(0))


def subword_pieces(text: Column, added: str | None = None) -> Column:
    """Pieces of a text that subwords do not cross; all of them together are the text. White space is that of Unicode."""

    def cut(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(f"(?U){SUBWORD_PATTERN}"), F.lit(0))

    if added is None:
        return cut(text)
    parts = F.regexp_extract_all(text, F.lit(f"(?s)(?:{added})|(?:(?!{added}).)+"), F.lit(0))
    whole = F.transform(parts, lambda p: F.when(p.rlike(f"\\A(?:{added})\\z"), F.array(p)).otherwise(cut(p)))
    return F.when(text.rlike(added), F.flatten(whole)).otherwise(cut(text))


def ipa_lookup(ipa: Column, table: dict) -> Column:
    """Array of the table's values for the IPA symbols of a text, longest symbol first; other characters are dropped.

    Digraphs are parked on private-use characters, after which every symbol is one character and the text is looked
    up character by character. That is several times faster than a regular expression over all symbols.
    """
    parked = {s: chr(0xE000 + i) for i, s in enumerate(s for s in table if len(s) > 1)}
    private = "".join(parked.values())
    text = F.regexp_replace(F.translate(strip(ipa), private, "?" * len(private)), " +", " ")
    for symbol, park in parked.items():
        text = F.replace(text, F.lit(symbol), F.lit(park))
    # A map is searched from its start: plain letters are the most frequent symbols.
    symbols = sorted(table, key=lambda s: not s.isascii())
    entries = F.create_map(*[F.lit(v) for s in symbols for v in (parked.get(s, s), table[s])])
    found = F.transform(F.split(text, ""), lambda c: F.try_element_at(entries, c))
    return F.filter(found, lambda v: v.isNotNull())


def ipa_to_tokens(ipa: Column) -> Column:
    """Phoneme-token text of an IPA text, without separators."""
    return F.array_join(ipa_lookup(ipa, T.PHONEMES), "")


def phoneme_array(tokens: Column) -> Column:
    """Phoneme tokens of a phoneme-token text."""
    return F.regexp_extract_all(tokens, F.lit(PHONEME_PATTERN), F.lit(0))


def last_token_number(text: Column) -> Column:
    """N of the ``<custom_token_N>`` that ends the text, null if it does not end so."""
    digits = F.regexp_extract(strip(text), LAST_TOKEN_PATTERN, 1)
    return digits.try_cast("long")


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"<custom_token_\d+>"))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
