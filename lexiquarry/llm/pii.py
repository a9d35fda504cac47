"""Format-preserving pseudonyms for personal numbers, dates and names of accounts, in Spark expressions only.

Values are found by patterns and validated (calendar, octets, check digits,
lengths). A valid value is permuted by a keyed Feistel network over exactly the
set its format allows, so the pseudonym is a valid value of the same format,
equal values get equal pseudonyms in every document, and the holder of the key
can go back (`restore`). Two halves take turns: one is shifted by a keyed hash
of the other, modulo the size of its own domain, which need not be a power.

| value | domain |
| --- | --- |
| dates (y-m-d, m/d/y, d/m/y, d.m.y) of 1900 to 2099 | days of the spans 1900-24, 1925-2024, 2025-99, each in itself |
| IPv4 addresses | 65536 x 65536 |
| social security numbers ddd-dd-dddd | 898 areas x 99 groups, 9999 serials |
| card numbers (13 to 19 digits, grouped or not, whose last is their Luhn digit) | all digits but the last, which is made anew |
| phone numbers | the digits after the country code |
| IBANs | the digits of the account; check digits are made anew |
| hexadecimal keys of 32 to 64 digits that are given as a value (behind = or :) | their digits |
| mail addresses | letters and digits before the @, in lower case |

There is no Python on the way: rows are mapped, nothing is shuffled, and texts
without a digit or an @ are passed on as they are.

Defined cases: null stays null, empty stays empty. What fails validation stays.
Repeated rows are treated alike. A column with the name of a result column is
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# First days and sizes of the date spans; each size is the product of the two factors.
DATE_SPANS = (("1900-01-01", 9131, 23, 397), ("1925-01-01", 36525, 75, 487), ("2025-01-01", 27393, 69, 397))

ISO = r"\d{4}-\d{2}-\d{2}"
WRITTEN = r"\d{1,2}([/.])\d{1,2}\1\d{4}"
IP = r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
SSN = r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}"
PHONE = r"(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?|\(\d{3}\)[ .-]?|\d{3}[.-](?=\d{3}[.-]\d{4}))\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}"
HEX = r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})"
NUMBER = r"\d(?:[ -]?\d){12,18}"
# Starts where its first part does and gives nothing back, so that a long run of letters is read once.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"

# No letter or digit may touch a value, nor may it go on behind a point or a hyphen.
_AFTER = r"(?![\w@]|[.-]\w)"
_GIVEN = "(?<=[=:][ \\t]{0,2}[\"']?)"
_FOUND = [ISO, WRITTEN.replace(r"\1", r"[/.]").replace("([/.])", "[/.]"), IP, SSN, PHONE, NUMBER, IBAN, _GIVEN + HEX]
NUMBERS = f"(?:(?<!\\w)(?:{'|'.join(_FOUND)}){_AFTER})"
ALL = f"(?:{MAIL}|{NUMBERS[3:-1]})"


def whole(m: Column, pattern: str) -> Column:
    return m.rlike(f"^(?:{pattern})$")


def keyed(key: str, tweak: Column | str, step: Column, value: Column) -> Column:
    """A 60-bit number of the key, what is permuted, the round and a half."""
    kind = F.lit(tweak) if isinstance(tweak, str) else tweak
    text = F.concat_ws("|", F.lit(key), kind, step.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, m: Column, n: Column, key: str, tweak: Column | str, back: bool) -> Column:
    """(a, b) of [0, m) x [0, n) permuted; `back` undoes it."""
    steps = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    sign = -1 if back else 1

    def turn(now: Column, step: Column) -> Column:
        even = step % 2 == 0
        left = F.pmod(now["a"] + sign * (keyed(key, tweak, step, now["b"]) % m), m)
        right = F.pmod(now["b"] + sign * (keyed(key, tweak, step, now["a"]) % n), n)
        return F.struct(
            F.when(even, left).otherwise(now["a"]).alias("a"), F.when(even, now["b"]).otherwise(right).alias("b")
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*(F.lit(s) for s in steps)), start, turn)


def power(radix: int, n: Column) -> Column:
    return F.round(F.pow(F.lit(float(radix)), n)).cast("long") if radix == 10 else F.element_at(
        F.array(*(F.lit(radix**k) for k in range(12))), n.cast("int") + 1
    )


def permute_digits(digits: Column, radix: int, key: str, tweak: Column | str, back: bool) -> Column:
    """A string of digits of the radix (at most 22, or 30 decimal ones) as another of the same length."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    left, right = digits.substr(F.lit(1), half), digits.substr(half + 1, size)
    number = (lambda s: F.coalesce(s.try_cast("long"), F.lit(0))) if radix == 10 else (
        lambda s: F.coalesce(F.conv(s, radix, 10).cast("long"), F.lit(0))
    )
    kind = F.concat_ws("/", F.lit(tweak) if isinstance(tweak, str) else tweak, size.cast("string"))
    out = feistel(number(left), number(right), power(radix, half), power(radix, size - half), key, kind, back)

    def text(value: Column, n: Column) -> Column:
        shown = value.cast("string") if radix == 10 else F.lower(F.conv(value.cast("string"), 10, radix))
        return F.when(n > 0, F.lpad(shown, n, F.lit("0"))).otherwise("")

    # The pair is worked out once and bound by a one-element transform.
    return F.element_at(
        F.transform(F.array(out), lambda p: F.concat(text(p["a"], half), text(p["b"], size - half))), 1
    )


def permute_long(digits: Column, radix: int, key: str, tweak: str, back: bool) -> Column:
    """Any number of digits, in parts of 20."""
    parts = F.sequence(F.lit(0), F.floor((F.length(digits) - 1) / 20).cast("int"))
    return F.array_join(
        F.transform(
            parts,
            lambda k: permute_digits(
                digits.substr(k * 20 + 1, F.lit(20)), radix, key, F.concat_ws("/", F.lit(tweak), k.cast("string")), back
            ),
        ),
        "",
    )


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def refill(m: Column, digits: Column) -> Column:
    """The value with its digits replaced in turn."""
    return F.element_at(
        F.transform(
            F.array(digits),
            lambda d: F.array_join(
                F.transform(
                    F.sequence(F.lit(1), F.length(m)),
                    lambda i: F.when(
                        m.substr(i, F.lit(1)).rlike("[0-9]"),
                        d.substr(F.length(digits_of(m.substr(F.lit(1), i))), F.lit(1)),
                    ).otherwise(m.substr(i, F.lit(1))),
                ),
                "",
            ),
        ),
        1,
    )


def bound(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def luhn(digits: Column) -> Column:
    """The check digit of a string of digits."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0),
        lambda s, i: s
        + bound(
            digits.substr(i, F.lit(1)).cast("int") * F.when((size - i) % 2 == 0, 2).otherwise(1),
            lambda d: F.when(d > 9, d - 9).otherwise(d),
        ),
    )
    return F.pmod(-total, F.lit(10))


def number(m: Column, key: str, back: bool) -> Column:
    def put(digits: Column) -> Column:
        n = F.length(digits)
        front, check = digits.substr(F.lit(1), n - 1), digits.substr(n, F.lit(1)).cast("int")
        new = bound(
            permute_digits(front, 10, key, "number", back),
            lambda new: refill(m, F.concat(new, luhn(new).cast("string"))),
        )
        return F.when(luhn(front) == check, new).otherwise(m)

    return bound(digits_of(m), put)


def phone(m: Column, key: str, back: bool) -> Column:
    code = F.length(F.regexp_extract(m, r"^\+(\d{1,3})", 1))
    return bound(
        digits_of(m),
        lambda d: refill(
            m,
            F.concat(
                d.substr(F.lit(1), code),
                permute_digits(
                    d.substr(code + 1, F.length(d)), 10, key, F.concat(F.lit("phone"), d.substr(F.lit(1), code)), back
                ),
            ),
        ),
    )


def ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = (m.substr(F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = area - F.when(area > 666, 2).otherwise(1)
    new = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", back)

    def text(p: Column) -> Column:
        at = F.floor(p["a"] / 99)
        shown = at + F.when(at >= 665, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", shown, p["a"] % 99 + 1, p["b"] + 1)

    return bound(new, text)


def address(m: Column, key: str, back: bool) -> Column:
    o = [F.split_part(m, F.lit("."), F.lit(k)).cast("long") for k in (1, 2, 3, 4)]
    new = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip", back)
    return bound(
        new,
        lambda p: F.concat_ws(
            ".", *(x.cast("string") for v in (p["a"], p["b"]) for x in (F.floor(v / 256), F.pmod(v, F.lit(256))))
        ),
    )


def day(date: Column, key: str, back: bool) -> Column:
    """A date as another of its span; null beyond the spans."""

    def within(first: str, size: int, m: int, n: int) -> Column:
        start = F.lit(first).cast("date")
        at = F.datediff(date, start)
        new = feistel(F.floor(at / n), F.pmod(at, F.lit(n)), F.lit(m), F.lit(n), key, first, back)
        shown = bound(new, lambda p: F.date_add(start, (p["a"] * n + p["b"]).cast("int")))
        return F.when((at >= 0) & (at < size), shown)

    return F.coalesce(*(within(*span) for span in DATE_SPANS))


def date(m: Column, key: str, back: bool) -> Column:
    """A written date in the same order and with the same marks; numbers of two places."""
    p = [F.split(m, "[-/.]")[k].cast("int") for k in range(3)]
    iso = m.rlike(f"^{ISO}$")
    month_first = ~iso & m.contains("/") & (p[0] <= 12)

    def made(y: Column, mo: Column, d: Column) -> Column:
        return F.try_to_date(F.format_string("%04d-%02d-%02d", y, mo, d), "yyyy-MM-dd")

    value = F.when(iso, made(p[0], p[1], p[2])).when(month_first, made(p[2], p[0], p[1])).otherwise(made(p[2], p[1], p[0]))
    mark = F.regexp_extract(m, "[-/.]", 0)

    def text(new: Column) -> Column:
        y, mo, d = F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")
        return (
            F.when(iso, F.concat_ws("-", y, mo, d))
            .when(month_first, F.concat_ws("/", mo, d, y))
            .otherwise(F.concat(d, mark, mo, mark, y))
        )

    return bound(day(value, key, back), lambda new: F.when(new.isNotNull(), text(new)).otherwise(m))


def rest97(text: Column) -> Column:
    """The remainder of an IBAN body (letters count 10 to 35) by 97."""
    return F.aggregate(
        F.split(text, "(?!^)(?!$)"),
        F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97
        ),
    )


def iban(m: Column, key: str, back: bool) -> Column:
    plain = F.regexp_replace(m, " ", "")

    def put(t: Column) -> Column:
        country, body = t.substr(F.lit(1), F.lit(2)), t.substr(F.lit(5), F.length(t))
        valid = rest97(F.concat(body, t.substr(F.lit(1), F.lit(4)))) == 1
        new = bound(
            digits_of(body),
            lambda d: F.when(
                F.length(d) > 0, refill(body, permute_digits(d, 10, key, F.concat(F.lit("iban"), country), back))
            ).otherwise(body),
        )
        check = lambda b: F.format_string("%02d", 98 - rest97(F.concat(b, country, F.lit("00"))))
        return F.when(
            valid, bound(new, lambda b: refill(m, F.concat(check(b), digits_of(b))))
        ).otherwise(m)

    return bound(plain, put)


def hexadecimal(m: Column, key: str, back: bool) -> Column:
    new = permute_long(F.lower(m), 16, key, "hex", back)
    return F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


_RUN, _LETTERS, _DIGITS = "[a-z]+|[0-9]+", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def mail(m: Column, key: str, back: bool) -> Column:
    name = F.lower(F.split_part(m, F.lit("@"), F.lit(1)))
    runs, gaps = F.regexp_extract_all(name, F.lit(_RUN), F.lit(0)), F.split(name, _RUN, -1)

    def run(r: Column) -> Column:
        # Letters are digits of radix 26.
        letters = permute_long(F.translate(r, _LETTERS, _DIGITS), 26, key, "mail", back)
        return F.when(r.rlike("[0-9]"), permute_long(r, 10, key, "mail", back)).otherwise(
            F.translate(letters, _DIGITS, _LETTERS)
        )

    return F.concat(joined(gaps, F.transform(runs, run)), m.substr(F.instr(m, "@"), F.length(m)))


def joined(gaps: Column, values: Column) -> Column:
    """Gaps and the values between them as one text."""
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(values, i), F.lit("")))), "")


def pseudonym(m: Column, key: str, back: bool) -> Column:
    """The pseudonym of a found value, or the value if it isn't valid."""
    n = F.length(digits_of(m))
    return (
        F.when(m.contains("@"), mail(m, key, back))
        .when(whole(m, ISO) | whole(m, WRITTEN), date(m, key, back))
        .when(whole(m, IP), address(m, key, back))
        .when(whole(m, SSN), ssn(m, key, back))
        .when(whole(m, IBAN), iban(m, key, back))
        .when(whole(m, PHONE) & n.between(7, 15) & ~whole(m, r"\d+"), phone(m, key, back))
        .when(whole(m, NUMBER), number(m, key, back))
        .when(whole(m, HEX), hexadecimal(m, key, back))
        .otherwise(m)
    )


def _mapped(text: Column, key: str, back: bool) -> tuple[Column, Column]:
    """(text, number of values) with the values of a text replaced; found once, put back between the gaps."""

    def by(pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return bound(
            found,
            lambda values: F.when(
                F.size(values) > 0,
                bound(
                    F.transform(values, lambda m: pseudonym(m, key, back)),
                    lambda new: F.struct(
                        joined(F.split(text, pattern, -1), new).alias("text"),
                        F.size(F.filter(F.arrays_zip(values.alias("a"), new.alias("b")), lambda p: p["a"] != p["b"]))
                        .cast("long")
                        .alias("n"),
                    ),
                ),
            ).otherwise(F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))),
        )

    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    return F.when(text.contains("@"), by(ALL)).when(text.rlike("[0-9]"), by(NUMBERS)).otherwise(plain)


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", keep: list[str] | None = None, back: bool = False
) -> DataFrame:
    """Kept columns (default all) with the text's values replaced, and `n_values`, how many have changed."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "n_values")]
    done = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), _mapped(F.col(f"`{text}`"), key, back).alias("new")
    )
    return done.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)),
        F.col("new.text").alias(text),
        F.col("new.n").alias("n_values"),
    )


def restore(docs: DataFrame, key: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The texts `pseudonymise` was given, under the same key; mail addresses come back in lower case."""
    return pseudonymise(docs, key, text, keep, back=True)
