"""Text analysis as native column expressions.

`tokenize` applies the word-splitting rules one after the other and is the
readable definition. `preprocess` and `typeahead_tokens` give the same result
as `tokenize` + `alpha_only` + `remove_stopwords` from one pattern, because
those two run over every text in the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiquarry.functions.stem import stem_tokens
from lexiquarry.functions.words import STOP_WORDS

# Characters that always stand alone, and the clitics that are
# split off the end of a word.
PUNCTUATION = ";@#$%&*?![](){}<>\"«»“”‘’„`"
CLITICS = ("n't", "'ll", "'re", "'ve", "'s", "'m", "'d", "'")

# What Unicode calls white space, as used by split() and strip().
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_PUNCT_CLASS = r";@#$%&*?!\[\](){}<>\"«»“”‘’„`"

# A run of letters that starts after a separator, may carry one clitic and one
# full stop, and ends before a separator. Group 1 is the word. (The first test
# follows from the second and is cheaper: it settles most places in a text.)
_WORD = (
    r"(?<!\p{L})"
    rf"(?<=^|[\s{_PUNCT_CLASS}]|\.\.)"
    r"(\p{L}+)"
    r"(?:n't|'(?:ll|re|ve|s|m|d)?)?"
    rf"(?:\.(?!\.))?"
    rf"(?=$|[\s{_PUNCT_CLASS}]|[:,]$|\.\.)"
)


def _text(value) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))


def _spaced(text) -> Column:
    """Lower-case text in which all that Unicode calls white space is a plain space."""
    return F.translate(F.lower(_text(text)), WHITE_SPACE, " " * len(WHITE_SPACE))


def tokenize(text) -> Column:
    """Lower-case word tokens; separators are dropped, other tokens kept."""
    c = _spaced(text)
    c = F.regexp_replace(c, r"([:,])([^0-9])", r" $1 $2")
    c = F.regexp_replace(c, r"([:,])$", " ")
    c = F.regexp_replace(c, r"\.\.+", " ")
    c = F.translate(c, PUNCTUATION, " " * len(PUNCTUATION))
    c = F.regexp_replace(c, "--", " ")
    c = F.regexp_replace(c, r"([^.\s])\.(\s|$)", "$1 $2")
    c = F.regexp_replace(c, rf"([^' ])({'|'.join(CLITICS)})(\s|$)", "$1 $3")
    c = F.regexp_replace(c, r"(^|\s)cannot(?=\s|$)", "$1can not")
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def alpha_only(tokens: Column) -> Column:
    """Keep tokens that consist of letters only."""
    return F.filter(tokens, lambda t: t.rlike(r"^\p{L}+$"))


def remove_stopwords(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*STOP_WORDS))


def _words(text, min_length: int) -> Column:
    spaced = F.regexp_replace(_spaced(text), "[:,]([^0-9])", " $1")
    spaced = F.replace(spaced, F.lit("--"), F.lit(" "))
    words = F.regexp_extract_all(spaced, F.lit(_WORD), F.lit(1))
    # "cannot" is two tokens, "can" and "not", and both are stop words.
    dropped = (*STOP_WORDS, "cannot")
    if min_length > 1:
        return F.filter(words, lambda t: (F.length(t) >= min_length) & ~t.isin(*dropped))
    return F.filter(words, lambda t: ~t.isin(*dropped))


def preprocess(text, stem: bool = True) -> Column:
    """Search tokens: letters only, no stop words, stemmed unless told not to."""
    words = _words(text, min_length=1)
    return stem_tokens(words) if stem else words


def typeahead_tokens(text) -> Column:
    """Suggestion tokens: as `preprocess`, unstemmed, two letters or more."""
    return _words(text, min_length=2)


def full_text(title="title", content="content") -> Column:
    return F.concat(_text(title), F.lit(" "), _text(content))


def normalize_term(term) -> Column:
    """Lower-cased term without outer white space; callers drop the empty one."""
    c = F.col(term) if isinstance(term, str) else term
    return F.btrim(F.lower(c), F.lit(WHITE_SPACE))


def word_count(text) -> Column:
    """Number of white-space separated words."""
    blanked = F.translate(_text(text), WHITE_SPACE, " " * len(WHITE_SPACE))
    return F.size(F.filter(F.split(blanked, " "), lambda w: w != "")).cast("bigint")


def snippet(content, length: int = 500) -> Column:
    """The first `length` characters and "..." when there are more."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("..."))).otherwise(c)


def iso_timestamp(ts) -> Column:
    """ISO-8601 text of a timestamp, with micros only when there are any; NULL stays NULL."""
    c = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_trunc("second", c) == c, seconds).otherwise(
        F.concat(seconds, F.date_format(c, ".SSSSSS"))
    )
