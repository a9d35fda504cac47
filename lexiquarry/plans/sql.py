"""Building blocks of the check SQL, written for DuckDB.

They follow the rules of the operators but not their plans: tokens come from
the rule-by-rule chain and everything is plain joins and groupings.
"""

from __future__ import annotations

from lexiquarry.functions.text import WHITE_SPACE
from lexiquarry.functions.words import STOP_WORDS

_RULES = (
    (r"([:,])([^0-9])", r" \1 \2"),
    (r"([:,])$", " "),
    (r"\.\.+", " "),
    (r"[;@#$%&*?!\[\](){}<>\"«»“”‘’„`]", " "),
    ("--", " "),
    (r"([^.\s])\.(\s|$)", r"\1 \2"),
    (r"([^' ])(n't|'ll|'re|'ve|'s|'m|'d|')(\s|$)", r"\1 \3"),
    (r"(^|\s)cannot(\s|$)", r"\1can not\2"),
    (r"(^|\s)cannot(\s|$)", r"\1can not\2"),
)


# Fixed values of the stemming algorithm (Porter, 1980, and its usual extensions), stated here on their own:
# words with a stem of their own, suffixes with what replaces them, and suffixes that are dropped.
_IRREGULAR = dict(
    pair.split("=")
    for pair in (
        "sky=sky skies=sky dying=die lying=lie tying=tie news=news innings=inning inning=inning outings=outing "
        "outing=outing cannings=canning canning=canning howe=howe proceed=proceed exceed=exceed succeed=succeed"
    ).split()
)
_STEP_2 = [
    pair.split("=")
    for pair in (
        "ational=ate tional=tion enci=ence anci=ance izer=ize bli=ble alli=al entli=ent eli=e ousli=ous ization=ize "
        "ation=ate ator=ate alism=al iveness=ive fulness=ful ousness=ous aliti=al iviti=ive biliti=ble fulli=ful"
    ).split()
]
_STEP_3 = [pair.split("=") for pair in "icate=ic ative= alize=al iciti=ic ical=ic ful= ness=".split()]
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_LIST = ", ".join(quoted(word) for word in STOP_WORDS)
WHITE_SQL = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"


def tokens(text: str) -> str:
    """List of tokens of a text expression."""
    e = f"translate(lower({text}), {WHITE_SQL}, repeat(' ', {len(WHITE_SPACE)}))"
    for pattern, replacement in _RULES:
        e = f"regexp_replace({e}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"list_filter(string_split_regex({e}, '\\s+'), lambda t: t <> '')"


def search_word(term: str = "term") -> str:
    return f"regexp_full_match({term}, '\\p{{L}}+') AND {term} NOT IN ({STOP_LIST})"


def suggest_word(term: str = "term") -> str:
    return f"{search_word(term)} AND length({term}) >= 2"


def shard(key: str, n: int) -> str:
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {n} AS INTEGER)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _doc_row(doc_id, title, content, source, seconds) -> str:
    return (
        f"{shard(doc_id, 3)} AS shard_id, {doc_id} AS doc_id, {title} AS title, {content} AS content, "
        f"{source} AS source, TIMESTAMP '2024-01-01' + to_seconds({seconds}) AS created_at"
    )


DOCS = f"docs AS (SELECT {_doc_row('CAST(doc_id AS VARCHAR)', chr(39) * 2, 'text', 'source', 'doc_id')}, lang FROM documents)"
_PAGE_ID = "'page-' || CAST(page_id AS VARCHAR)"
_PAGE_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_PAGE_TEXT = "regexp_replace(html, '<[^>]*>', ' ', 'g')"
PAGE_DOCS = f"page_docs AS (SELECT {_doc_row(_PAGE_ID, _PAGE_TITLE, _PAGE_TEXT, 'url', 'page_id')} FROM pages)"
_CONV_ID = "'conv-' || CAST(conv_id AS VARCHAR)"
TURNS = f"turns AS (SELECT {_doc_row(_CONV_ID, 'role', 'text', quoted('conversations'), 'conv_id')}, turn AS seq FROM conversations)"
_MESSAGE_ID = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"
MESSAGES = f"messages AS (SELECT {_doc_row(_MESSAGE_ID, chr(39) * 2, 'text', 'role', 'conv_id')} FROM conversations)"
MARKS = "marks AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, quality, toxic FROM labels)"
REVIEWED = (
    "reviewed AS (SELECT d.* REPLACE ('quality ' || CAST(quality AS VARCHAR) AS title) "
    "FROM docs d JOIN marks USING (doc_id))"
)
KEPT = "kept AS (SELECT * FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM marks WHERE toxic = 1))"
SUBMISSIONS = (
    "submissions AS (SELECT d.* REPLACE (CASE toxic WHEN 1 THEN '' WHEN 0 THEN content END AS content), "
    "quality, toxic FROM docs d LEFT JOIN marks USING (doc_id))"
)
QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def words(source: str, name: str = "words", keep: str | None = None) -> str:
    """All search tokens of a document CTE, one row each."""
    full = "coalesce(title, '') || ' ' || coalesce(content, '')"
    return (
        f"{name} AS (SELECT * FROM (SELECT shard_id, doc_id, unnest({tokens(full)}) AS term FROM {source}) "
        f"WHERE {keep or search_word()})"
    )


def index(source: str, words_name: str = "words", suffix: str = "") -> tuple[str, ...]:
    """Postings, document and term statistics of a document CTE and its words."""
    return (
        f"postings{suffix} AS (SELECT shard_id, term, doc_id, count(*) AS tf FROM {words_name} GROUP BY ALL)",
        f"doc_stats{suffix} AS (SELECT d.shard_id, d.doc_id, count(w.term) AS doc_len FROM {source} d "
        f"LEFT JOIN {words_name} w USING (shard_id, doc_id) GROUP BY ALL)",
        f"term_stats{suffix} AS (SELECT shard_id, term, count(*) AS df FROM postings{suffix} GROUP BY ALL)",
    )


def term_counts(source: str, name: str) -> str:
    """Suggestion terms of a document CTE with their shard and count."""
    full = "coalesce(title, '') || ' ' || coalesce(content, '')"
    return (
        f"{name} AS (SELECT {shard('term', 2)} AS shard_id, term, count(*) AS frequency FROM "
        f"(SELECT unnest({tokens(full)}) AS term FROM {source}) WHERE {suggest_word()} GROUP BY term)"
    )


STORED = (DOCS, term_counts("docs", "stored"))
_BENCH = "bench AS (SELECT '' AS title, text AS content FROM benchmark)"
COUNTERS = (
    MESSAGES,
    _BENCH,
    term_counts("messages", "counted"),
    term_counts("bench", "bench_terms"),
    "counters AS (SELECT c.* FROM counted c ANTI JOIN bench_terms b USING (shard_id, term) "
    "UNION ALL SELECT shard_id, term, 0 FROM bench_terms)",
)
PREFIXES = (
    f"prefixes AS (SELECT DISTINCT trim(lower(' ' || word), {WHITE_SQL}) AS prefix "
    "FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark))"
)
_EVENT_TERM = "concat_ws('-', event_type, regexp_extract(props, '[0-9]+'))"
UPDATES = (
    f"updates AS (SELECT *, {shard('lower(term)', 2)} AS shard_id FROM (SELECT {_EVENT_TERM} AS term, "
    "CAST(CASE WHEN value >= 40 THEN 1 ELSE -1 END AS BIGINT) AS frequency_delta, "
    "strftime(ts, '%Y-%m-%d') AS batch_id, ts AS created_at, "
    "ts < TIMESTAMP '2024-01-20 00:00:00' AS processed FROM events))"
)
EVENT_TERMS = (
    "event_terms AS (SELECT shard_id, term, count(*) AS frequency FROM updates "
    "WHERE processed AND NOT starts_with(term, 'purchase') GROUP BY ALL)"
)


def _case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in rules) + " ELSE w END"


def _measure(text: str) -> str:
    """How often vowels are followed by consonants."""
    return f"len(regexp_extract_all({text}, '[aeiouy]+[^aeiouy]+'))"


def _swap(least: int, suffix: str, replacement: str) -> str:
    """The suffix replaced where what is left has so large a measure."""
    rest = _cut(len(suffix))
    return f"CASE WHEN {_measure(rest)} >= {least} THEN {rest} || '{replacement}' ELSE w END"


def _ends(suffix: str) -> str:
    return f"ends_with(w, '{suffix}')"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def stems(vocabulary: str) -> tuple[str, ...]:
    """CTEs ending in `stems(term, stem)` for a CTE with distinct words in `term`.

    One select per step of the algorithm.
    """
    vowel = "[aeiouy]"
    rest = _cut(1)
    last, before = "substr(w, length(w) - 1, 1)", "substr(w, length(w) - 2, 1)"
    doubled = f"{last} = {before} AND regexp_matches({last}, '[^aeiouy]')"
    short = (
        f"(regexp_matches({rest}, '[^aeiouy][aeiouy][^aeiouywxY]$') OR regexp_matches({rest}, '^[aeiouy][^aeiouy]$'))"
    )
    one, two = f"{_measure(rest)} = 1", f"{_measure(rest)} >= 2"
    steps = [
        _case(
            [
                (_ends("sses"), _cut(2)),
                (f"{_ends('ies')} AND length(w) = 4", _cut(1)),
                (_ends("ies"), _cut(2)),
                (_ends("ss"), "w"),
                (_ends("s"), _cut(1)),
            ]
        ),
        _case(
            [
                (f"{_ends('ied')} AND length(w) = 4", _cut(1)),
                (_ends("ied"), _cut(2)),
                (_ends("eed"), _swap(1, "eed", "ee")),
                (_ends("ed"), f"regexp_replace(w, '^(.*{vowel}.*)ed$', '\\1|')"),
                (_ends("ing"), f"regexp_replace(w, '^(.*{vowel}.*)ing$', '\\1|')"),
            ]
        ),
        _case(
            [
                (f"NOT {_ends('|')}", "w"),
                (f"{_ends('at|')} OR {_ends('bl|')} OR {_ends('iz|')}", f"{rest} || 'e'"),
                (f"{doubled} AND {last} IN ('l', 's', 'z')", rest),
                (doubled, _cut(2)),
                (f"{one} AND {short}", f"{rest} || 'e'"),
                (_ends("|"), rest),
            ]
        ),
        _case([(_ends("y"), "regexp_replace(w, '^(.+[^aeiouy])y$', '\\1i')")]),
        _case([(_ends("alli"), _swap(1, "alli", "al"))]),
        _case(
            [(_ends(s), _swap(1, s, r)) for s, r in _STEP_2]
            + [(_ends("logi"), _swap(1, "ogi", "og"))]
        ),
        _case([(_ends(s), _swap(1, s, r)) for s, r in _STEP_3]),
        _case(
            [
                (
                    _ends(s),
                    f"CASE WHEN {'TRUE' if s != 'ion' else _ends('sion') + ' OR ' + _ends('tion')} "
                    f"THEN {_swap(2, s, '')} ELSE w END",
                )
                for s in _STEP_4
            ]
        ),
        _case(
            [
                (f"{_ends('e')} AND ({two} OR ({one} AND NOT {short}))", rest),
                (f"{_ends('ll')} AND {two}", rest),
            ]
        ),
    ]
    special = ", ".join(quoted(word) for word in _IRREGULAR)
    marked = "regexp_replace(regexp_replace(term, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')"
    ctes = [
        f"stem0 AS (SELECT term, {marked} AS w FROM {vocabulary} "
        f"WHERE length(term) > 2 AND term NOT IN ({special}))"
    ]
    ctes += [f"stem{i + 1} AS (SELECT term, {step} AS w FROM stem{i})" for i, step in enumerate(steps)]
    irregular = " ".join(f"WHEN {quoted(w)} THEN {quoted(s)}" for w, s in _IRREGULAR.items())
    ctes.append(
        f"stems AS (SELECT term, replace(w, 'Y', 'y') AS stem FROM stem{len(steps)} UNION ALL "
        f"SELECT term, CASE term {irregular} ELSE term END FROM {vocabulary} "
        f"WHERE length(term) <= 2 OR term IN ({special}))"
    )
    return tuple(ctes)
