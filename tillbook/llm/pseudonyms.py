"""Format-preserving pseudonyms for personal data; DataFrame functions only.

Numbers and dates are found by pattern, validated, and replaced by a keyed permutation
of their own format: an alternating Feistel network over the numbers 0 .. a*b-1, whose
halves live modulo a and modulo b. Being a permutation it never maps two values to one,
and being keyed by value alone it maps equal values alike in all documents, so records
stay linked. Without the key the values cannot be recovered.

* cards (13 to 19 digits whose check digit is right, in one group or up to five), and
  account numbers named as such: all digits but the last are permuted; the check digit moves
  along, so Luhn-valid numbers stay valid and others stay invalid
* phone numbers: all digits, a country code before a space, dot or dash kept
* social security numbers: within the valid ranges of area, group and serial
* IPv4 addresses: within the 2**32 addresses
* dates (2020-01-31, 31.01.2020, 31/01/2020, 01/31/2020): valid days of the 400 years
  from 1800, in the style found; a slashed date reads day first where that is valid
* e-mail addresses have no fixed format: a keyed hash takes the place of the name, and
  the domain goes

Separators stay where they are. What does not validate stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: 146,097 days in 400 Gregorian years: 189 * 773.
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773

# The look-behinds let a match start only where a run starts, so a long run of letters or
# digits is read once. Groups repeat possessively: those the matcher takes in a loop, others by
# calling itself, so a domain of thousands of labels would exhaust its stack.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])"
DATE = r"(?<![0-9A-Za-z.+-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
# Groups of digits parted by single spaces or dashes, 13 digits or more; groups that a letter follows end it.
GROUP = r"[0-9]{1,19}+(?![0-9A-Za-z])"
RUN = rf"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){{12}}){GROUP}(?:[ -]{GROUP})*+"
LABEL = r"(?<![A-Za-z])(?i:account|acct)(?i:[ .]{0,2}(?:number|no|num))?[ .:#=]{0,3}"
ACCOUNT = rf"{LABEL}[0-9](?:[ -]?[0-9]){{12,18}}(?![0-9A-Za-z])"
#: Stands for a value that is settled while the others are looked for; one in the text stands for itself.
MARK = "\ue000"
FIRST = "|".join((EMAIL, ACCOUNT, RUN, MARK))
THEN = "|".join((IPV4, DATE, SSN, PHONE))
#: The most groups in which a card is written.
CARD_GROUPS = 5


def _round(key: str, tweak: Column, at: int, value: Column) -> Column:
    """A keyed 60-bit number."""
    text = F.concat_ws("|", F.lit(key), tweak, F.lit(str(at)), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def _turn(at: int, a: Column, b: Column, tweak: Column, key: str):
    """One round: even ones change the left half, odd ones the right."""

    def left(s: Column) -> Column:
        return F.struct(F.pmod(s["l"] + F.pmod(_round(key, tweak, at, s["r"]), a), a).cast("bigint").alias("l"), s["r"].alias("r"))

    def right(s: Column) -> Column:
        return F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(_round(key, tweak, at, s["l"]), b), b).cast("bigint").alias("r"))

    return right if at % 2 else left


def permute(x: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """Keyed permutation of 0 .. a*b-1 (longs; a, b below 2**31)."""
    # The quotient by decimals: a double would round above 2**53.
    left = ((x - F.pmod(x, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("bigint")
    states = F.array(F.struct(left.alias("l"), F.pmod(x, b).cast("bigint").alias("r")))
    for at in range(ROUNDS):
        states = F.transform(states, _turn(at, a, b, tweak, key))
    return F.element_at(F.transform(states, lambda s: s["l"] * b + s["r"]), 1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("bigint")


def _digits(d: Column, kind: str, key: str) -> Column:
    """Permutes a string of 1 to 18 digits among those of its length."""
    n = F.length(d)
    low = F.floor(n / 2)
    x = permute(d.cast("bigint"), _ten(n - low), _ten(low), F.concat(F.lit(kind), n.cast("string")), key)
    return F.lpad(x.cast("string"), n, F.lit("0"))


def _luhn(d: Column) -> Column:
    """The check digit that ``d`` calls for."""
    at = F.sequence(F.lit(1), F.length(d))
    value = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    twice = lambda v: F.when(v > 4, v * 2 - 9).otherwise(v * 2)
    part = F.transform(at, lambda i: F.when((F.length(d) - i) % 2 == 0, twice(value(i))).otherwise(value(i)))
    return F.pmod(-F.aggregate(part, F.lit(0), lambda s, v: s + v), F.lit(10))


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order; separators stay."""
    chars = F.regexp_extract_all(shape, F.lit("(?s)."), F.lit(0))
    held = F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 1).otherwise(0))
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(digits, F.aggregate(F.slice(held, F.lit(1), i + 1), F.lit(0), lambda s, v: s + v), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def _card(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")

    def new(d: Column) -> Column:
        head = F.substring(d, F.lit(1), F.length(d) - 1)
        gap = F.pmod(F.substring(d, -1, 1).cast("int") - _luhn(head), F.lit(10))
        return _let(_digits(head, "card", key), lambda h: F.concat(h, F.pmod(_luhn(h) + gap, F.lit(10)).cast("string")))

    return _refill(m, _let(digits, new))


def _is_card(groups: Column) -> Column:
    """Groups of digits that make up a number of card length with the right check digit."""
    digits = F.array_join(groups, "")
    written = F.forall(F.slice(groups, F.lit(1), F.size(groups) - 1), lambda g: F.length(g) >= 3)
    right = _luhn(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.substring(digits, -1, 1).cast("int")
    return F.length(digits).between(13, 19) & written & right


def _cards(m: Column, key: str) -> Column:
    """A run of digits with its cards marked, and their pseudonyms: from the left, and of the
    fewest groups. Other digits stay for the other rules.

    The walk notes only where cards stand, so a long run without any costs a step a group.
    """
    groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    gaps = F.concat(F.regexp_extract_all(m, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))

    def walk(p: Column) -> Column:
        g, gap = p["g"], p["s"]

        def step(s: Column, i: Column) -> Column:
            fits = F.filter(
                F.sequence(F.lit(1), F.least(F.lit(CARD_GROUPS), F.size(g) - i + 1)), lambda n: _is_card(F.slice(g, i, n))
            )
            put = lambda n: F.struct(
                (i + n - 1).alias("done"), F.concat(s["cards"], F.array(F.struct(i.alias("i"), n.alias("n")))).alias("cards")
            )
            found = _let(F.try_element_at(fits, F.lit(1)), lambda n: F.when(n.isNull(), s).otherwise(put(n)))
            return F.when(i <= s["done"], s).otherwise(found)

        none = F.expr("CAST(array() AS array<struct<i:int,n:int>>)")
        start = F.struct(F.lit(0).alias("done"), none.alias("cards"))
        end = F.aggregate(F.sequence(F.lit(1), F.size(g)), start, step)

        def plain(first: Column, after: Column) -> Column:
            """Groups and gaps as they stand, from one place to before another."""
            n = after - first
            return F.array_join(F.zip_with(F.slice(g, first, n), F.slice(gap, first, n), lambda a, b: F.concat(a, b)), "")

        def card(c: Column) -> Column:
            inner = F.concat(F.slice(gap, c["i"], c["n"] - 1), F.array(F.lit("")))
            return _card(F.array_join(F.zip_with(F.slice(g, c["i"], c["n"]), inner, lambda a, b: F.concat(a, b)), ""), key)

        def told(cards: Column) -> Column:
            after = lambda c: F.coalesce(c["i"] + c["n"], F.lit(1))
            before = lambda k: F.try_element_at(cards, k)  # noqa: E731  the card before the k-th, counted from 0
            pieces = F.transform(
                cards,
                lambda c, k: F.concat(
                    plain(F.when(k > 0, after(before(k))).otherwise(1), c["i"]), F.lit(MARK), F.element_at(gap, c["i"] + c["n"] - 1)
                ),
            )
            rest = plain(after(F.try_element_at(cards, F.lit(-1))), F.size(g) + 1)
            return F.struct(F.concat(F.array_join(pieces, ""), rest).alias("text"), F.transform(cards, card).alias("values"))

        return _let(end["cards"], told)

    return _let(F.struct(groups.alias("g"), gaps.alias("s")), walk)


def _settled(m: Column, key: str) -> Column:
    """What stands for a match of FIRST until the end, and the values behind its marks."""
    label = F.regexp_extract(m, f"^{LABEL}", 0)
    one = lambda before, value: F.struct(F.concat(before, F.lit(MARK)).alias("text"), F.array(value).alias("values"))
    number = F.substring(m, F.length(label) + 1, F.length(m))
    # A card within a named number is the same card elsewhere.
    account = _let(_cards(number, key), lambda c: F.when(F.size(c["values"]) > 0, F.struct(F.concat(label, c["text"]).alias("text"), c["values"].alias("values"))).otherwise(one(label, _card(number, key))))
    return (
        F.when(m == MARK, one(F.lit(""), m))
        .when(m.contains("@"), one(F.lit(""), _email(m, key)))
        .when(m.rlike("^[A-Za-z]"), account)
        .otherwise(_cards(m, key))
    )


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^(\+?[0-9]{1,3}[ .-])(?=.*[0-9]{3}.*[0-9]{3})(?=(?:[^0-9]*[0-9]){10})", 1)
    return _let(
        F.struct(code.alias("c"), F.substring(m, F.length(code) + 1, F.length(m)).alias("n")),
        lambda p: F.concat(p["c"], _refill(p["n"], _digits(F.regexp_replace(p["n"], "[^0-9]", ""), "phone", key))),
    )


def _ssn(m: Column, key: str) -> Column:
    part = lambda i, n: F.substring(m, i, n).cast("bigint")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    x = (place * 99 + group - 1) * 9999 + serial - 1
    y = permute(x, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)
    pad = lambda v, n: F.lpad(v.cast("string"), n, "0")

    def text(v: Column) -> Column:
        left = F.floor(v / 9999)
        a = F.floor(left / 99)
        return F.concat_ws("-", pad(F.when(a > 664, a + 2).otherwise(a + 1), 3), pad(left % 99 + 1, 2), pad(v % 9999 + 1, 4))

    return F.when(valid, _let(y, text)).otherwise(m)


def _ipv4(m: Column, key: str) -> Column:
    parts = F.split(m, r"\.")
    octet = lambda i: F.element_at(parts, i).cast("bigint")
    valid = F.forall(parts, lambda p: p.cast("int") < 256)
    x = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    y = permute(x, F.lit(65536), F.lit(65536), F.lit("ipv4"), key)
    text = lambda v: F.concat_ws(".", *[(F.shiftright(v, s) % 256).cast("string") for s in (24, 16, 8, 0)])
    return F.when(valid, _let(y, text)).otherwise(m)


def _date(m: Column, key: str) -> Column:
    iso = F.when(m.rlike("^[0-9]{4}-"), m)
    day_first = F.when(m.rlike(r"^[0-9]{2}[./]"), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    month_first = F.when(m.rlike("^[0-9]{2}/"), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)))
    reads = [F.try_to_date(c, "yyyy-MM-dd") for c in (iso, day_first, month_first)]
    first = F.lit(FIRST_DAY).cast("date")

    def new(r: Column) -> Column:
        day = F.coalesce(r["i"], r["d"], r["m"])
        x = F.datediff(day, first).cast("bigint")
        y = permute(x, F.lit(DAYS_A), F.lit(DAYS_B), F.lit("date"), key)
        other = F.date_add(first, y.cast("int"))
        text = F.when(r["i"].isNotNull(), F.date_format(other, "yyyy-MM-dd"))
        dots = F.when(m.contains("."), F.date_format(other, "dd.MM.yyyy")).otherwise(F.date_format(other, "dd/MM/yyyy"))
        text = F.coalesce(text, F.when(r["d"].isNotNull(), dots), F.date_format(other, "MM/dd/yyyy"))
        return F.when((x >= 0) & (x < DAYS_A * DAYS_B), text).otherwise(m)

    return _let(F.struct(*[c.alias(n) for c, n in zip(reads, "idm", strict=True)]), new)


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 20), F.lit("@redacted.invalid"))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one found value."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    other = (
        F.when(whole(IPV4), _ipv4(m, key))
        .when(whole(DATE), _date(m, key))
        .when(whole(SSN), _ssn(m, key))
        .otherwise(_phone(m, key))
    )
    return F.coalesce(other, m)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_as: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; all columns and rows stay.

    ``count_as`` adds a column with the number of values found. Null texts stay null and
    empty ones empty; repeated rows change alike; an empty table stays empty. Work is one
    projection: nothing is shuffled, whatever the columns are called.
    """
    text = docs[text_col]
    empty = F.expr("CAST(array() AS array<string>)")
    # Few texts hold a digit or an at sign next to another: the rest is not cut into pieces.
    likely = F.regexp_like(text, F.lit("[0-9][0-9 ()./-]{6}|@"))
    names = {n: f"__{n}_of_{len(docs.columns)}" for n in ("first", "between", "new", "text", "values", "found")}
    col = {n: F.col(c) for n, c in names.items()}

    def known(found: Column, work) -> Column:
        # Each distinct value of a text is worked out once.
        return F.map_from_entries(F.transform(F.array_distinct(found), lambda m: F.struct(m.alias("k"), work(m, key).alias("v"))))

    def joined(between: Column, parts: Column) -> Column:
        return F.array_join(F.zip_with(between, F.concat(parts, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    def on(condition: Column, value: Column, otherwise: Column) -> Column:
        return F.when(condition, value).otherwise(otherwise)

    own = F.col(f"`{text_col}`")
    stepped = docs.withColumn(names["first"], on(likely, F.regexp_extract_all(text, F.lit(FIRST), F.lit(0)), empty))
    some = F.size(col["first"]) > 0
    stepped = stepped.withColumn(names["between"], F.when(some, F.split(own, FIRST, -1))).withColumn(names["new"], F.when(some, known(col["first"], _settled)))
    settled = lambda part: F.transform(col["first"], lambda m: F.element_at(col["new"], m)[part])
    stepped = stepped.withColumn(names["text"], on(some, joined(col["between"], settled("text")), own))
    stepped = stepped.withColumn(names["values"], on(some, F.flatten(settled("values")), empty))
    stepped = stepped.withColumn(names["found"], on(likely, F.regexp_extract_all(col["text"], F.lit(THEN), F.lit(0)), empty))
    more = F.size(col["found"]) > 0
    stepped = stepped.withColumn(names["between"], F.when(more, F.split(col["text"], THEN, -1))).withColumn(names["new"], F.when(more, known(col["found"], pseudonym)))
    stepped = stepped.withColumn(names["text"], on(more, joined(col["between"], F.transform(col["found"], lambda m: F.element_at(F.col(names["new"]), m))), col["text"]))
    # The settled values take their places again.
    new_text = on(F.size(col["values"]) > 0, joined(F.split(col["text"], MARK, -1), col["values"]), col["text"])
    out = [new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if count_as:
        values = F.size(F.filter(col["values"], lambda v: v != MARK)) + F.size(col["found"])
        out.append(F.coalesce(values, F.lit(0)).cast("bigint").alias(count_as))
    return stepped.select(*out)
