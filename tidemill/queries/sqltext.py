"""The cleaning rules once more, as SQL expressions for the comparison.

Written with list functions and one plain pattern per rule, not with the
single-pass patterns of ``functions.text``.
"""

from __future__ import annotations

from tidemill import fixed_values as fv

# what the JVM's \S excludes; the SQL engine's own \S also matches \x0B
_VISIBLE = r"[^ \t\n\x0B\f\r]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _delete(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {quote(pattern)}, {quote(by)}, 'g')"


def _portable(pattern: str) -> str:
    return pattern.replace(r"\S", _VISIBLE)


def _members(*groups) -> str:
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for group in groups for a, b in group)


def _symbols(*plain) -> str:
    return (
        rf"(?:[{_members(*plain)}]|[{_members(fv.EMOJI_SELECTABLE)}]\x{{FE0F}}?"
        rf"|{fv.KEYCAP_BASE}\x{{FE0F}}?\x{{20E3}})+"
    )


def noise(x: str) -> str:
    return _delete(x, _portable("|".join((*fv.NOISE_TOKENS, fv.NEWLINE))))


def noise_basic(x: str) -> str:
    return _delete(x, _portable("|".join((*fv.NOISE_TOKENS, fv.WEBSITE_BASIC))))


def symbols(x: str) -> str:
    return _delete(x, _symbols(fv.CJK_IDEOGRAPHS, fv.ZERO_WIDTH_JOINER, fv.EMOJI_PLAIN))


def emoji(x: str) -> str:
    return _delete(x, _symbols(fv.EMOJI_PLAIN))


def marked(x: str) -> str:
    return _delete(x, _portable(fv.WEBSITE), fv.WEBSITE_MARK)


def no_replacement(x: str) -> str:
    return f"replace({x}, {quote(fv.REPLACEMENT_CHAR)}, '')"


def trimmed(x: str) -> str:
    return _delete(x, r"^[\x00-\x20]+|[\x00-\x20]+$")


def sentences(x: str) -> str:
    return (
        f"CASE WHEN rtrim({x}, '.') = '' AND {x} <> '' THEN []::VARCHAR[] ELSE "
        f"list_transform(string_split(rtrim({x}, '.'), '.'), lambda s: {trimmed('s')} || '.') END"
    )


def unmarked(x: str) -> str:
    return f"list_filter({x}, lambda s: NOT contains(s, {quote(fv.WEBSITE_MARK)}))"


def joined(x: str) -> str:
    parts = f"list_transform(string_split(s, ','), lambda p: {trimmed('p')})"
    tidy = f"array_to_string(list_filter({parts}, lambda q: q <> ''), ',')"
    return f"array_to_string(list_transform({x}, lambda s: {tidy}), '')"


def no_escapes(x: str) -> str:
    return _delete(x, fv.UNICODE_ESCAPE)


def spaced(x: str) -> str:
    return _delete(x, " {2,}", " ")


def units(x: str) -> str:
    astral = _delete(x, r"[^\x{10000}-\x{10FFFF}]")
    return f"(length({x}) + length({astral}))"


def gated(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {units(x)} BETWEEN {fv.MIN_POST_UNITS} "
        f"AND {fv.MAX_POST_UNITS} THEN {x} ELSE '' END"
    )


def strip_chain(source: str) -> str:
    """WITH clauses from ``source`` (a SELECT with a column ``t``) to ``stripped``."""
    return f"""WITH source AS ({source}),
a AS (SELECT * REPLACE ({noise('t')} AS t) FROM source),
b AS (SELECT * REPLACE ({symbols('t')} AS t) FROM a),
c AS (SELECT * REPLACE ({no_replacement(marked('t'))} AS t) FROM b),
d AS (SELECT * REPLACE ({joined(unmarked(sentences('t')))} AS t) FROM c),
e AS (SELECT * REPLACE (CASE WHEN t = '' THEN '' ELSE left(t, length(t) - 1) END AS t) FROM d),
stripped AS (SELECT * REPLACE ({spaced(no_escapes('t'))} AS t) FROM e)"""


def clean_chain(source: str) -> str:
    return f"""{strip_chain(source)},
cleaned AS (SELECT * REPLACE ({gated('t')} AS t) FROM stripped)"""


def clean_chain_basic(source: str) -> str:
    return f"""WITH source AS ({source}),
a AS (SELECT * REPLACE ({spaced(noise_basic('t'))} AS t) FROM source),
b AS (SELECT * REPLACE ({joined(sentences('t'))} AS t) FROM a),
cleaned AS (SELECT * REPLACE ({gated('t')} AS t) FROM b)"""
