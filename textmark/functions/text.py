"""Text preparation as column expressions."""

from __future__ import annotations

import json
import zlib
from collections.abc import Collection, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmark.settings import LITERAL_ENTRIES

# A token is a whole word made only of letters.  A word is a run of letters,
# digits, underscores and combining marks; a combining mark belongs to it only
# when it sits on a letter or digit.  The first branch captures pure-letter
# words, the second swallows every other word whole, however many marks it
# holds, so that no part of it matches.  Each branch is possessive and free of
# nested groups: one pass over the text, no backtracking and no recursion however
# long a run is.  The meaning of \b depends on the Java version, so it is not used.
# a-z and A-Z are in \p{L}; named first they are found by a comparison.
_WORDS = r"([a-zA-Z\p{L}]++)(?![\p{Nd}\p{Mn}_])|[\p{L}\p{Nd}_][\p{L}\p{Nd}\p{Mn}_]*+"
# A mark behind an underscore sits on nothing and ends the word: a blank instead
# makes that so.  Such texts are rare and only they are rewritten.
_LOOSE_MARKS = r"(?<=_)\p{Mn}+"


def raw_tokens(text: Column) -> Column:
    """Letter-only words of a text, in order, case kept."""
    loose = text.contains("_") & text.rlike(r"_\p{Mn}")
    text = F.when(loose, F.regexp_replace(text, _LOOSE_MARKS, " ")).otherwise(text)
    return F.array_remove(F.regexp_extract_all(text, F.lit(_WORDS), F.lit(1)), "")


def lower_tokens(words: Column) -> Column:
    """Lower-case every token; always after matching, never before."""
    return F.transform(words, F.lower)


def tokens(text: Column) -> Column:
    return lower_tokens(raw_tokens(text))


def stems(words: Column, lemmas: Mapping[str, str]) -> Column:
    """Replace each word by its stem, words without one stay.

    The lookup table travels as one folded literal: an array of small maps,
    indexed by the word's checksum, so a lookup costs one hash and about one
    comparison.  Larger dictionaries go through ``operators.tokens`` joins.
    """
    if not lemmas:
        return words
    size = len(lemmas)
    if size > LITERAL_ENTRIES:
        raise ValueError(f"{size} lemmas do not fit a literal; pass a table instead")
    buckets: list[dict[str, str]] = [{} for _ in range(size)]
    for word, stem in lemmas.items():
        buckets[zlib.crc32(word.encode("utf-8")) % size][word] = stem
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")

    def stem_of(word: Column) -> Column:
        slot = F.pmod(F.crc32(word.cast("binary")), F.lit(size)).cast("int")
        return F.coalesce(F.try_element_at(F.get(table, slot), word), word)

    return F.transform(words, stem_of)


def without(words: Column, stop_words: Collection[str]) -> Column:
    """Drop stop words; order and duplicates of the others stay."""
    if not stop_words:
        return words
    if len(stop_words) > LITERAL_ENTRIES:
        raise ValueError(f"{len(stop_words)} stop words do not fit a literal; pass a table instead")
    listed = sorted(stop_words)
    return F.filter(words, lambda word: ~word.isin(listed))


def prepared(
    text: Column,
    lemmas: Mapping[str, str],
    stop_words: Collection[str],
    filter_on: str = "stem",
) -> Column:
    """Tokens, stems, stop filter, in this order.

    Stop words are tested on the stem; ``filter_on="token"`` tests the word
    before stemming.
    """
    if filter_on == "stem":
        return without(stems(tokens(text), lemmas), stop_words)
    if filter_on == "token":
        return stems(without(tokens(text), stop_words), lemmas)
    raise ValueError(f"filter_on is 'stem' or 'token', not {filter_on!r}")


def text_length(text: Column) -> Column:
    return F.length(text)


def fingerprint(content: Column) -> Column:
    """MD5 of the content as lower-case hex."""
    return F.md5(content.cast("binary"))


def parsed_rating(raw: Column) -> Column:
    """Text to double; NULL when it is not a number."""
    return F.trim(raw).try_cast("double")
