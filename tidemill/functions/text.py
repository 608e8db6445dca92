"""Post cleaning as native column expressions.

Every step is a ``Column -> Column`` function made of built-in expressions, so
it stays inside whole-stage codegen, runs the same on batch and streaming
frames and never starts a Python worker.

The patterns are written to stay linear on long texts: a run of whitespace or
dots is only entered at its first character, and repeated groups around
alternations (which recurse once per repetition in the JVM matcher, and
overflow its stack on long runs) are avoided.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.columns import as_column

# whitespace as Java's String.trim sees it
_BLANK = r"\x00-\x20"
# start of the text, or just behind a dot
_SENTENCE_START = r"(?<![^.])"


def _char_class(*range_groups) -> str:
    parts = []
    for ranges in range_groups:
        for low, high in ranges:
            parts.append(rf"\x{{{low:X}}}" if low == high else rf"\x{{{low:X}}}-\x{{{high:X}}}")
    return "[" + "".join(parts) + "]"


def _symbol_pattern(*plain_groups) -> str:
    """Symbols to delete.  A cheap look-ahead (a Latin-1 bit set and one range)
    settles nearly every character of a Latin text before the long class."""
    plain = _char_class(*plain_groups)
    selectable = _char_class(fv.EMOJI_SELECTABLE)
    selector = rf"\x{{{fv.VARIATION_SELECTOR:X}}}"
    ranges = [r for group in (*plain_groups, fv.EMOJI_SELECTABLE) for r in group]
    latin = [r for r in ranges if r[1] <= 0xFF]
    first_beyond = min(low for low, _ in ranges if low > 0xFF)
    candidates = _char_class(latin, ((first_beyond, 0x10FFFF),))
    return (
        rf"(?={candidates})(?:{plain}+|{selectable}{selector}?)"
        rf"|{fv.KEYCAP_BASE}{selector}?\x{{{fv.KEYCAP:X}}}"
    )


def _token_pattern(alternatives) -> str:
    """Alternation behind a look-ahead on the possible first characters."""
    first = "".join(dict.fromkeys(r"\n" if a == r"\n" else a[0] for a in alternatives))
    return rf"(?=[{first}])(?:{'|'.join(alternatives)})"


NOISE_PATTERN = _token_pattern((*fv.NOISE_TOKENS, fv.NEWLINE))
NOISE_PATTERN_BASIC = _token_pattern((*fv.NOISE_TOKENS, fv.WEBSITE_BASIC))
SYMBOL_PATTERN = _symbol_pattern(fv.CJK_IDEOGRAPHS, fv.ZERO_WIDTH_JOINER, fv.EMOJI_PLAIN)
EMOJI_PATTERN = _symbol_pattern(fv.EMOJI_PLAIN)

# Blank and comma tidying in one pass.  Only the comma group survives a match.
TIDY_PATTERN = (
    rf"(?=[{_BLANK},])(?:"
    rf"{_SENTENCE_START}[{_BLANK},]++"  # nothing before the first word
    rf"|(?<![{_BLANK}])[{_BLANK}]*+(?:"
    rf"(,)[{_BLANK},]*+"  # one bare comma between words
    rf"|(?=\.|\z)))"  # nothing before the dot
)
MARKED_SENTENCE_PATTERN = rf"{_SENTENCE_START}[^.]*?{fv.WEBSITE_MARK}[^.]*+\."


# -- single steps ----------------------------------------------------------


def remove_noise(c: Column | str) -> Column:
    """Delete hashtags, https links, phone and e-mail labels, newlines."""
    return F.regexp_replace(as_column(c), NOISE_PATTERN, "")


def remove_symbols(c: Column | str) -> Column:
    """Delete CJK ideographs and emoji."""
    return F.regexp_replace(as_column(c), SYMBOL_PATTERN, "")


def remove_emoji(c: Column | str) -> Column:
    """Delete emoji only; ideographs and zero-width joiners stay."""
    return F.regexp_replace(as_column(c), EMOJI_PATTERN, "")


def mark_websites(c: Column | str) -> Column:
    """Replace ``www….com`` / ``www….com.cn`` by the website mark."""
    return _replace_websites(as_column(c), fv.WEBSITE, fv.WEBSITE_MARK)


# Texts with more ``www`` than this take the linear way.
_MANY_WWW = 16


def _failing_run(stop: str = "") -> str:
    """What a website pattern has read in vain from a ``www`` on: its run of
    non-blanks, up to a ``www`` before a blank, which may begin a website in the
    next run, and up to ``stop``."""
    end = rf"www\s|{stop}" if stop else r"www\s"
    return rf"(?!wwwww?\s)www(?:(?!{end})\S)*+"


def _many_www(text: Column) -> Column:
    count = F.char_length(text) - F.char_length(F.replace(text, F.lit("www"), F.lit("")))
    return F.contains(text, F.lit("www")) & (count > 3 * _MANY_WWW)


def _replace_websites(text: Column, pattern: str, mark: str) -> Column:
    """``regexp_replace`` of a website pattern in linear time.

    The pattern fails at a ``www`` only after the rest of its run of non-blanks
    has been read, and would read it again from each further ``www``.  So a
    failing run is consumed once, as a match of its own behind a mark.  It
    begins with ``www``, and nothing else that does follows a mark directly: a
    mark in front of ``www`` is the run's and goes.
    """
    plain = F.regexp_replace(text, pattern, mark)
    found = F.regexp_replace(text, f"{pattern}|({_failing_run()})", f"{mark}$1")
    linear = F.replace(found, F.lit(f"{mark}www"), F.lit("www"))
    return F.when(_many_www(text), linear).otherwise(plain)


_BASIC_LINEAR = _token_pattern((*fv.NOISE_TOKENS, fv.WEBSITE_BASIC, f"({_failing_run('|'.join(fv.NOISE_TOKENS))})"))


def remove_noise_and_websites(c: Column | str) -> Column:
    """Delete the noise tokens and websites of the basic profile, newlines kept.
    A failing run ends before a token, which may stand inside of it."""
    text = as_column(c)
    return F.when(_many_www(text), F.regexp_replace(text, _BASIC_LINEAR, "$1")).otherwise(
        F.regexp_replace(text, NOISE_PATTERN_BASIC, "")
    )


def remove_replacement_chars(c: Column | str) -> Column:
    return F.replace(as_column(c), F.lit(fv.REPLACEMENT_CHAR), F.lit(""))


def trim_blanks(c: Column | str) -> Column:
    """Trim every character up to U+0020, not only spaces."""
    return F.regexp_replace(as_column(c), rf"\A[{_BLANK}]+|(?<![{_BLANK}])[{_BLANK}]+\z", "")


def split_sentences(c: Column | str) -> Column:
    """Sentences as an array, each trimmed and closed by a dot.  Empty parts
    at the end are dropped, others kept; a text of dots gives no sentence."""
    text = as_column(c)
    body = F.rtrim(text, F.lit("."))
    parts = F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, r"\.", -1)
    )
    return F.transform(parts, lambda s: F.concat(trim_blanks(s), F.lit(".")))


def drop_website_sentences(sentences: Column | str) -> Column:
    return F.filter(as_column(sentences), lambda s: ~F.contains(s, F.lit(fv.WEBSITE_MARK)))


def join_sentences(sentences: Column | str) -> Column:
    """Tidy the commas inside each sentence and glue the sentences together;
    the final dot is kept."""

    def tidy(sentence: Column) -> Column:
        parts = F.transform(F.split(sentence, ",", -1), trim_blanks)
        return F.array_join(F.filter(parts, lambda p: p != ""), ",")

    return F.array_join(F.transform(as_column(sentences), tidy), "")


def drop_end_dots(c: Column | str) -> Column:
    return F.rtrim(as_column(c), F.lit("."))


def remove_marked_sentences(c: Column | str) -> Column:
    """Delete the sentences that hold the website mark; the text has no dot at
    its end and gets none.  Few texts are marked, and looking for the mark
    costs far less than going through the sentences."""
    text = as_column(c)
    closed = F.concat(text, F.lit("."))
    kept = F.regexp_replace(F.regexp_replace(closed, MARKED_SENTENCE_PATTERN, ""), r"\.\z", "")
    return F.when(F.contains(text, F.lit(fv.WEBSITE_MARK)), kept).otherwise(text)


def tidy_sentences(c: Column | str) -> Column:
    """Trim the sentences and their comma parts and drop empty parts.

    After :func:`drop_end_dots` and :func:`remove_marked_sentences` this is
    ``join_sentences(drop_website_sentences(split_sentences(c)))`` without the
    final dot, and without arrays.
    """
    return F.regexp_replace(as_column(c), TIDY_PATTERN, "$1")


def remove_unicode_escapes(c: Column | str) -> Column:
    r"""Delete literal ``\uXXXX`` escapes with the word run behind them."""
    return F.regexp_replace(as_column(c), fv.UNICODE_ESCAPE, "")


def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), " {2,}", " ")


def utf16_length(c: Column | str) -> Column:
    """Length in UTF-16 units (an astral character counts twice)."""
    return (F.octet_length(F.encode(as_column(c), "UTF-16BE")) / 2).cast("int")


def length_gate(c: Column | str) -> Column:
    """The text itself within the accepted length, else the empty string."""
    text = as_column(c)
    fits = utf16_length(text).between(fv.MIN_POST_UNITS, fv.MAX_POST_UNITS)
    return F.when(text.isNull() | fits, text).otherwise("")


# -- profiles --------------------------------------------------------------


def _holds(part: str):
    return lambda text: F.contains(text, F.lit(part))


def _not_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


# The steps before the length gate, in order.  A step may have a test that is
# false for texts it cannot change and much cheaper than the step.
STEPS = {
    "full": (
        (remove_noise, None),
        (remove_symbols, _not_ascii),
        (mark_websites, _holds("www")),
        (remove_replacement_chars, None),
        (drop_end_dots, None),
        (remove_marked_sentences, None),
        (tidy_sentences, None),
        (remove_unicode_escapes, _holds("\\u")),
        (collapse_spaces, _holds("  ")),
    ),
    # the older profile: websites are deleted, ideographs, emoji and escapes
    # stay, and so does the final dot
    "basic": (
        (remove_noise_and_websites, None),
        (collapse_spaces, _holds("  ")),
        (drop_end_dots, None),
        (tidy_sentences, None),
        (lambda c: F.concat(as_column(c), F.lit(".")), None),
    ),
}


def strip_post(c: Column | str, profile: str = "full") -> Column:
    """All cleaning steps before the length gate, as one expression."""
    text = as_column(c)
    for step, _ in STEPS[profile]:
        text = step(text)
    return text


def clean_post(c: Column | str, profile: str = "full") -> Column:
    """The whole cleaning chain.  NULL stays NULL; a text that is too short or
    too long after cleaning becomes the empty string."""
    return length_gate(strip_post(c, profile))
