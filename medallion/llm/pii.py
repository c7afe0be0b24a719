"""Personal data replaced by pseudonyms of the same format, with DataFrame functions only.

Numbers and dates that pass their validation (Luhn digit, octets, calendar, ...) are permuted within the set
of valid values by a keyed Feistel network, so equal values get equal pseudonyms in all documents and
the pseudonym of a valid value is valid again. E-mail addresses and secrets become keyed hashes of their kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_NEW = "__pii_new"
_NOT_DIGIT = "[^0-9]"

# Patterns of the kinds, in order of precedence. A match that fails validation stays as it is.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}"
ASSIGNED = r"(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key)[ \t]*[=:][ \t]*[\"'])[^\s\"']{8,}"
HEX = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"
ACCESS_KEY = r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
)
PHONE = (
    r"(?<![0-9])(?:(?:\+[0-9]{1,3}[ .-]?|1[ .-])?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|(?:1[.-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
)
KINDS = {
    "email": EMAIL, "secret": f"{ASSIGNED}|{HEX}|{ACCESS_KEY}", "ip": IP, "date": DATE, "ssn": SSN, "card": CARD, "phone": PHONE,
}
ANY = "|".join(KINDS.values())
# The same matches as ANY's: where a word goes on no kind begins, and a first letter leaves the kinds that begin with a letter.
SEARCHED = (
    f"(?<![A-Za-z])(?=[A-Za-z])(?:{EMAIL}|{ASSIGNED}|{HEX}|{ACCESS_KEY})"
    f"|(?=[0-9+(._%-])(?:{EMAIL}|{HEX}|{IP}|{DATE}|{SSN}|{CARD}|{PHONE})"
)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``. A column that an expression names twice is worked out twice inside a lambda; this one once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def permute(value: Column, high: Column, low: Column, key: str, kind: str) -> Column:
    """Keyed permutation of the integers below ``high * low``: alternating additions to either part."""

    def moved(given: Column) -> Column:
        value, high, low = given["value"], given["high"], given["low"]

        def turn(state: Column, i: Column) -> Column:
            even = (i % 2) == 0
            seen = F.when(even, state["h"]).otherwise(state["l"])
            return _let(
                F.conv(F.substring(_digest(key, F.lit(kind), i, seen), 1, 15), 16, 10).cast("long"),
                lambda add: F.struct(
                    F.when(even, state["h"]).otherwise((state["h"] + add) % high).alias("h"),
                    F.when(even, (state["l"] + add) % low).otherwise(state["l"]).alias("l"),
                ),
            )

        start = F.struct(((value - value % low) / low).cast("long").alias("h"), F.floor(value % low).cast("long").alias("l"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["h"] * low + s["l"])

    return _let(F.struct(value.alias("value"), high.cast("long").alias("high"), low.cast("long").alias("low")), moved)


def _power_of_ten(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(11)]), n.cast("int") + 1)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, _NOT_DIGIT, "")


def _permute_digits(digits: Column, key: str, kind: str) -> Column:
    def moved(digits: Column) -> Column:
        size = F.length(digits)
        half = F.floor(size / 2)
        new = permute(digits.cast("long"), _power_of_ten(half), _power_of_ten(size - half), key, kind)
        return F.lpad(new.cast("string"), size, "0")

    return _let(digits, moved)


def _in_format(match: Column, digits: Column) -> Column:
    """The digits of ``match`` replaced in order, everything else kept."""

    def written(digits: Column) -> Column:
        def symbol(i: Column) -> Column:
            c = match.substr(i, F.lit(1))
            nth = F.length(_digits(match.substr(F.lit(1), i)))
            return F.when(c.rlike("[0-9]"), digits.substr(nth, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(match)), symbol), "")

    return _let(digits, written)


def luhn_sum(digits: Column) -> Column:
    """Sum whose last digit is 0 for a number with a right check digit."""

    def summed(digits: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int")
            twice = d * 2
            return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)

    return _let(digits, summed)


def _card(match: Column, key: str) -> Column:
    def checked(body: Column) -> Column:
        return F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))

    def replaced(digits: Column) -> Column:
        body = _permute_digits(digits.substr(F.lit(1), F.length(digits) - 1), key, "card")
        return F.when(luhn_sum(digits) % 10 == 0, _in_format(match, _let(body, checked))).otherwise(match)

    return _let(_digits(match), replaced)


def _phone(match: Column, key: str) -> Column:
    """The last ten digits are permuted; digits before them and a country code set apart stay."""

    def replaced(digits: Column) -> Column:
        country = F.regexp_extract(match, r"^\+([0-9]{1,3})[ .(-]", 1)
        kept = F.greatest(F.length(digits) - 10, F.length(country))
        return _in_format(match, F.concat(digits.substr(F.lit(1), kept), _permute_digits(digits.substr(kept + 1, F.lit(10)), key, "phone")))

    return _let(_digits(match), replaced)


def _ssn(match: Column, key: str) -> Column:
    area, group, serial = (match.substr(F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    index = (area - 1 - (area > 666).cast("int")) * 99 + (group - 1)

    def written(moved: Column) -> Column:
        new_area = F.floor(moved / (99 * 9999)) + 1
        new_area = new_area + (new_area >= 666).cast("int")
        return F.concat(
            F.lpad(new_area.cast("string"), 3, "0"), F.lit("-"),
            F.lpad((F.floor(moved / 9999) % 99 + 1).cast("string"), 2, "0"), F.lit("-"),
            F.lpad((moved % 9999 + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, _let(permute(index * 9999 + (serial - 1), F.lit(898 * 99), F.lit(9999), key, "ssn"), written)).otherwise(match)


def _ip(match: Column, key: str) -> Column:
    octets = F.transform(F.split(match, r"\."), lambda o: o.cast("long"))
    value = F.aggregate(octets, F.lit(0).cast("long"), lambda total, o: total * 256 + o)

    def written(moved: Column) -> Column:
        return F.concat_ws(".", *[(F.floor(moved / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)])

    return F.when(F.array_max(octets) < 256, _let(permute(value, F.lit(65536), F.lit(65536), key, "ip"), written)).otherwise(match)


# Days in 400 years of the calendar: 189 * 773.
_CYCLE = 146097


def _date(match: Column, key: str) -> Column:
    """A date moves within its cycle of 400 years. Day and month are told apart as month first after a slash."""
    iso, slash = match.contains("-"), match.contains("/")
    parts = F.split(match, "[-/.]")
    year = F.when(iso, parts[0]).otherwise(parts[2])
    month = F.when(iso, parts[1]).when(slash, parts[0]).otherwise(parts[1])
    day = F.when(iso, parts[2]).when(slash, parts[1]).otherwise(parts[0])
    date = F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")

    def shifted(since: Column) -> Column:
        inside = F.pmod(since, F.lit(_CYCLE))
        days = since - inside + permute(inside, F.lit(189), F.lit(773), key, "date")
        return F.date_add(F.lit("1600-01-01").cast("date"), days.cast("int"))

    def written(moved: Column) -> Column:
        y, m, d = F.lpad(F.year(moved).cast("string"), 4, "0"), F.month(moved).cast("string"), F.dayofmonth(moved).cast("string")
        wide = F.length(match) == 10
        m, d = F.when(wide, F.lpad(m, 2, "0")).otherwise(m), F.when(wide, F.lpad(d, 2, "0")).otherwise(d)
        return F.when(iso, F.concat_ws("-", y, m, d)).when(slash, F.concat_ws("/", m, d, y)).otherwise(F.concat_ws(".", d, m, y))

    def replaced(date: Column) -> Column:
        since = F.datediff(date, F.lit("1600-01-01").cast("date")).cast("long")
        return F.when(date.isNotNull() & (year >= "1600"), _let(_let(since, shifted), written)).otherwise(match)

    return _let(date, replaced)


def _email(match: Column, key: str) -> Column:
    address = F.lower(match)
    domain = F.substring_index(address, "@", -1)
    return F.concat(
        F.lit("user-"), F.substring(_digest(key, F.lit("email"), address), 1, 12), F.lit("@"),
        F.lit("host-"), F.substring(_digest(key, F.lit("domain"), domain), 1, 8), F.lit(".example"),
    )


def _secret(match: Column, key: str) -> Column:
    """The value, after an opening quote if there is one, becomes hex digits of the same length and case."""

    def replaced(value: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.length(value) / 64).cast("int"))
        hexed = F.array_join(F.transform(blocks, lambda i: _digest(key, F.lit("secret"), F.lower(value), i)), "").substr(F.lit(1), F.length(value))
        head = match.substr(F.lit(1), F.length(match) - F.length(value))
        return F.concat(head, F.when(value == F.upper(value), F.upper(hexed)).otherwise(hexed))

    return _let(F.regexp_extract(match, r"([^\s\"']+)$", 1), replaced)


_REPLACE = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: str) -> Column:
    """What replaces a match; equal to the match if it fails the validation of its kind."""
    result = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        result = F.when(match.rlike(f"^(?:{KINDS[kind]})$"), _REPLACE[kind](match, key)).otherwise(result)
    return F.coalesce(result, match)


def mask_text(docs: DataFrame, key: str, counted: str | None = "n_replaced") -> DataFrame:
    """All columns, ``text`` with personal data replaced, and the number of replaced values in ``counted`` unless None.

    A column that has that name already gives way.
    A null text stays null, an empty one empty, both with 0 replaced; texts without a digit or @ are not searched.
    Whole texts of any length are read. If there is a column ``n_chars``, it counts the new text's characters
    where something was replaced. Equal rows stay equal; an empty table gives an empty result.
    """
    text = F.col("text")
    # Told apart in steps, the dear one last: a text without a sign and a quote after it holds no assignment.
    candidate = text.rlike("[0-9@]") | (text.rlike("[=:][ \\t]*[\"']") & text.rlike(ASSIGNED))

    def replaced(found: Column) -> Column:
        return F.when(F.size(found) > 0, _let(F.transform(found, lambda m: pseudonym(m, key)), lambda new: merged(found, new)))

    def merged(found: Column, new: Column) -> Column:
        gaps = F.split("text", SEARCHED, -1)
        parts = F.zip_with(F.concat(F.array(F.lit("")), new), gaps, lambda before, gap: F.concat(before, gap))
        moved = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda differs: differs))
        return F.struct(F.array_join(parts, "").alias("text"), moved.cast("long").alias("moved"))

    found = F.regexp_extract_all("text", F.lit(f"({SEARCHED})"), F.lit(1))
    masked = docs.withColumn(_NEW, F.when(candidate, _let(found, replaced)))
    changed = F.col(_NEW).isNotNull()
    columns = []
    for name in docs.columns:
        if name == counted:
            continue
        column = F.col(f"`{name}`")
        if name == "text":
            column = F.when(changed, F.col(_NEW)["text"]).otherwise(column).alias("text")
        elif name == "n_chars":
            column = F.when(changed, F.length(F.col(_NEW)["text"])).otherwise(column).cast(docs.schema[name].dataType).alias(name)
        columns.append(column)
    if counted:
        columns.append(F.coalesce(F.col(_NEW)["moved"], F.lit(0)).cast("long").alias(counted))
    return masked.select(*columns)
