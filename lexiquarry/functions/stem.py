"""Porter stemming as native column expressions.

The published algorithm (Porter, 1980) with the usual extensions: a pool of
irregular words, four-letter -ies/-ied, -y after any consonant but the first
letter, and the -alli, -fulli and -logi rules. A rule is a suffix, its
replacement and a condition on what is left; the first suffix that fits decides,
whether or not its condition holds. Each step is one `transform` over the token
array, so stemming needs no join, no shuffle and no Python worker.

A consonant `y` (first letter, or after a vowel) is written `Y` while the steps
run. That makes "vowel" and "consonant" plain character classes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix and replacement; the rest must have positive measure.
STEP_2 = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
)
# Suffixes dropped when the rest has a measure above one.
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

_V = "[aeiouy]"
_C = "[^aeiouy]"
MEASURE_ABOVE_0 = f"{_C}*{_V}+{_C}.*"
MEASURE_ABOVE_1 = f"{_C}*{_V}+{_C}+{_V}+{_C}.*"
MEASURE_IS_1 = f"^{_C}*{_V}+{_C}+{_V}*$"
SHORT_SYLLABLE = f"({_C}{_V}[^aeiouywxY]$)|(^{_V}{_C}$)"


def _swap(w: Column, measure: str, suffix: str, replacement: str) -> Column:
    """Replace the suffix where the rest has the measure, else the word as is."""
    return F.regexp_replace(w, f"^({measure}){suffix}$", f"$1{replacement}")


def _first_of(w: Column, branches: list[tuple[Column, Column]]) -> Column:
    result = None
    for condition, value in branches:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(w)


def _by_suffix(w: Column, rules: list[tuple[str, Column]]) -> Column:
    """The value of the first rule whose suffix the word has.

    Grouped by the last letter, so that a word is compared with few suffixes;
    the order only matters among suffixes that end alike.
    """
    groups: dict[str, list[tuple[Column, Column]]] = {}
    for suffix, value in rules:
        groups.setdefault(suffix[-1], []).append((w.endswith(suffix), value))
    return _first_of(w, [(w.endswith(last), _first_of(w, group)) for last, group in groups.items()])


def _cut(w: Column, n: int) -> Column:
    return F.substr(w, F.lit(1), F.length(w) - n)


def _mark_y(w: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(w, "(^|[aeiou])y", "$1Y"), "yy", "yY")
    return F.when(w.contains("y"), marked).otherwise(w)


def _step_1a(w: Column) -> Column:
    return _first_of(
        w,
        [
            (w.endswith("sses"), _cut(w, 2)),
            (w.endswith("ies") & (F.length(w) == 4), _cut(w, 1)),
            (w.endswith("ies"), _cut(w, 2)),
            (w.endswith("ss"), w),
            (w.endswith("s"), _cut(w, 1)),
        ],
    )


def _step_1b(w: Column) -> Column:
    """-ied and -eed at once; -ed and -ing leave a `|` so that the tidy-up step
    knows a suffix was removed."""
    return _first_of(
        w,
        [
            (w.endswith("ied") & (F.length(w) == 4), _cut(w, 1)),
            (w.endswith("ied"), _cut(w, 2)),
            (w.endswith("eed"), _swap(w, MEASURE_ABOVE_0, "eed", "ee")),
            (w.endswith("ed"), F.regexp_replace(w, f"^(.*{_V}.*)ed$", "$1|")),
            (w.endswith("ing"), F.regexp_replace(w, f"^(.*{_V}.*)ing$", "$1|")),
        ],
    )


def _tidy_1b(w: Column) -> Column:
    rest = _cut(w, 1)
    last = F.substr(w, F.lit(-2), F.lit(1))
    doubled = (last == F.substr(w, F.lit(-3), F.lit(1))) & last.rlike(_C)
    return _first_of(
        w,
        [
            (~w.endswith("|"), w),
            (w.endswith("at|") | w.endswith("bl|") | w.endswith("iz|"), F.concat(rest, F.lit("e"))),
            (doubled & last.isin("l", "s", "z"), rest),
            (doubled, _cut(w, 2)),
            (rest.rlike(MEASURE_IS_1) & rest.rlike(SHORT_SYLLABLE), F.concat(rest, F.lit("e"))),
            (w.endswith("|"), rest),
        ],
    )


def _step_1c(w: Column) -> Column:
    return F.when(w.endswith("y"), F.regexp_replace(w, f"^(.+{_C})y$", "$1i")).otherwise(w)


def _alli(w: Column) -> Column:
    return F.when(w.endswith("alli"), _swap(w, MEASURE_ABOVE_0, "alli", "al")).otherwise(w)


def _step_2(w: Column) -> Column:
    rules = [(s, _swap(w, MEASURE_ABOVE_0, s, r)) for s, r in STEP_2]
    # The measure is taken with the l of -logi.
    return _by_suffix(w, [*rules, ("logi", _swap(w, MEASURE_ABOVE_0, "ogi", "og"))])


def _step_3(w: Column) -> Column:
    return _by_suffix(w, [(s, _swap(w, MEASURE_ABOVE_0, s, r)) for s, r in STEP_3])


def _step_4(w: Column) -> Column:
    def rule(suffix):
        cut = _swap(w, MEASURE_ABOVE_1, suffix, "")
        if suffix == "ion":
            return F.when(w.endswith("sion") | w.endswith("tion"), cut).otherwise(w)
        return cut

    return _by_suffix(w, [(s, rule(s)) for s in STEP_4])


def _step_5(w: Column) -> Column:
    rest = _cut(w, 1)
    drop = rest.rlike(f"^{MEASURE_ABOVE_1}") | (
        rest.rlike(MEASURE_IS_1) & ~rest.rlike(SHORT_SYLLABLE)
    )
    return _first_of(
        w,
        [
            (w.endswith("e") & drop, rest),
            (w.endswith("ll") & rest.rlike(f"^{MEASURE_ABOVE_1}"), rest),
        ],
    )


_STEPS = (_step_1a, _step_1b, _tidy_1b, _step_1c, _alli, _step_2, _step_3, _step_4, _step_5)


def _guarded(step):
    """Run a step on words the algorithm applies to: three letters or more, not irregular."""

    def apply(w: Column) -> Column:
        return F.when(w.startswith("="), w).otherwise(step(w))

    return apply


def _open(w: Column) -> Column:
    """Words to leave alone get a leading `=`; the others get their consonant y marked."""
    kept = F.concat(F.lit("="), w)
    irregular = _first_of(w, [(w == word, F.lit(f"={stem}")) for word, stem in IRREGULAR.items()])
    return _first_of(_mark_y(w), [(F.length(w) <= 2, kept), (w.isin(*IRREGULAR), irregular)])


def _close(w: Column) -> Column:
    return F.translate(w, "Y=", "y")


def stem_tokens(tokens: Column) -> Column:
    """Stem every token of an array of lower-case, all-letter words."""
    for step in (_open, *map(_guarded, _STEPS), _close):
        tokens = F.transform(tokens, step)
    return tokens
