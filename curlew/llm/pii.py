"""Format-preserving pseudonyms for personal data, by DataFrame expressions alone.

Candidates are found by one pattern, cards beforehand by their check digit; what passes its kind's validation is replaced by a keyed permutation of its own format:
a card number by a card number with a right check digit, a date by a date, an address by an address. The permutation is an
alternating Feistel network over symbols with their own moduli (digits, letters, octets, the two digits of a day number in
mixed radix): each half is shifted by a hash of key, round and the other half. So equal values get equal pseudonyms in all
documents, different values different ones, and a holder of the key can go back.

Kinds and their validation:
  email  local part with letters or digits before @ and a domain; letters and digits of the local part are permuted, a single one
         is shifted by a number that depends on key and domain
  card   13 to 19 digits, single spaces or hyphens between, Luhn; of the runs from a group of digits on, the longest that passes; all but the check digit are permuted, which follows
  ip     four octets up to 255
  date   a day from 1900-01-01 to 2099-12-31 as yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy
  ssn    three, two and four digits with hyphens, none of a range that isn't issued
  phone  + and 8 to 15 digits (after +1: ten), single separators between; or a national number: area code from 2 up, three and
         four digits, or 0, an area code and six to eight digits; all but the first two digits are permuted
  iban   two letters, check digits, 11 to 30 letters and digits, remainder 1 modulo 97; what follows the check digits is
         permuted, and they follow
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "card", "ip", "date", "ssn", "phone", "iban")

# The candidates' patterns, in the order in which they are tried at a position.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*+\.)*+(?<=\.)[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+(?:1(?:[ .()-]{0,2}[0-9]){10}(?![0-9])|[0-9](?:[ .()-]{0,2}[0-9]){7,14}(?![0-9]))",
    "national": r"(?<![0-9A-Za-z.+/-])(?<![0-9] )(?:(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[-. ])[2-9][0-9]{2}[-. ][0-9]{4}|0[1-9][0-9]{1,3}[ /-][0-9]{6,8})(?![0-9A-Za-z]|[ ./-][0-9])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
PHONE = r"^([+(]|[2-9][0-9]{2}[-. ][0-9]{3}[-. ][0-9]{4}$|0[1-9][0-9]{1,3}[ /-][0-9]{6,8}$)"
CANDIDATE = "|".join(v for k, v in PATTERNS.items() if k != "card")
# Cards are sought from every group of digits, at every group's end: a number beside a card doesn't hide it.
CARD_BEGIN = r"(?:(?<![0-9A-Za-z.+-])|(?<=[0-9]-))"
CARD_END = r"(?![0-9A-Za-z])"
CARD_RUN = rf"{CARD_BEGIN}(?=({PATTERNS['card']}{CARD_END}))"
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1900-01-01", 150, 487  # 73050 days; the last of them is 2100-01-01


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(symbols: Column, moduli: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the arrays symbols with 0 <= symbols[i] < moduli[i]. At least two symbols are needed."""

    def numbers(state: Column, r: Column, half: Column) -> Column:
        other = F.when(r % 2 == 0, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, 1, half))
        said = F.concat_ws(":", F.lit(key), r.cast("string"), F.size(state).cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), "."))
        # sixteen numbers of 32 bits a digest; longer halves use them again
        return let(F.sha2(said, 512), lambda digest: F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substr(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("long")))

    def permuted(m: Column) -> Column:
        half = (F.size(m) / 2).cast("int")

        def one(state: Column, r: Column) -> Column:
            def shifted(stream: Column) -> Column:
                return F.transform(state, lambda s, i: F.when((i < half) == (r % 2 == 0), F.pmod(s + F.element_at(stream, (i % 16 + 1).cast("int")), F.element_at(m, i + 1))).otherwise(s))

            return let(numbers(state, r, half), shifted)

        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), symbols, one)

    return let(moduli, permuted)


def _digits(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda c: c.cast("long"))


def _tens(n: Column) -> Column:
    return F.array_repeat(F.lit(10).cast("long"), n)


def _put(chars: Column, kept: Callable[[Column], Column], symbols: Column) -> Column:
    """The characters with those for which kept is false replaced, in turn, by the symbols (strings)."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def spelled(own: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            return F.struct(F.concat(s["text"], F.when(kept(c), c).otherwise(F.element_at(own, s["at"]))).alias("text"), F.when(kept(c), s["at"]).otherwise(s["at"] + 1).alias("at"))

        return F.aggregate(chars, start, step, lambda s: s["text"])

    return let(symbols, spelled)


def luhn_sum(digits: Column) -> Column:
    """Of an array of digits whose last is the check digit."""
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda a, d: a + d)


def _card(m: Column, key: str) -> Column:
    def checked(body: Column) -> Column:
        check = F.pmod(-luhn_sum(F.concat(body, F.array(F.lit(0).cast("long")))), F.lit(10))
        return F.transform(F.concat(body, F.array(check)), lambda d: d.cast("string"))

    def card(digits: Column) -> Column:
        n = F.size(digits)
        new = let(feistel(F.slice(digits, 1, n - 1), _tens(n - 1), f"{key}:card"), checked)
        return F.when(luhn_sum(digits) % 10 == 0, _put(F.split(m, ""), lambda c: ~c.rlike("[0-9]"), new))

    return let(_digits(m), card)


def cards_in(text: Column) -> Column:
    """The different card numbers of a text, longest first: from each group of digits the longest run that passes."""

    def longest(run: Column) -> Column:
        ends = F.array(*(F.regexp_extract(run, rf"^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])", 0) for n in range(19, 12, -1)))
        return F.get(F.filter(ends, lambda x: (x != "") & (luhn_sum(_digits(x)) % 10 == 0)), F.lit(0))

    found = F.array_distinct(F.array_compact(F.transform(F.regexp_extract_all(text, F.lit(CARD_RUN), F.lit(1)), longest)))
    return F.transform(F.array_sort(F.transform(found, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("card")))), lambda x: x["card"])


def _ip(m: Column, key: str) -> Column:
    def address(octets: Column) -> Column:
        new = feistel(octets, F.array_repeat(F.lit(256).cast("long"), 4), f"{key}:ip")
        fine = F.forall(octets, lambda x: x < 256) & ~m.rlike(r"(^|\.)0[0-9]")
        return F.when(fine, F.array_join(F.transform(new, lambda x: x.cast("string")), "."))

    return let(F.transform(F.split(m, r"\."), lambda c: c.cast("long")), address)


def _date(m: Column, key: str) -> Column:
    mark = F.when(m.rlike("^[0-9]{4}"), F.lit("-")).otherwise(F.substr(m, F.lit(3), F.lit(1)))
    iso = F.when(mark == "-", m).otherwise(F.concat_ws("-", F.substr(m, F.lit(7), F.lit(4)), F.substr(m, F.lit(4), F.lit(2)), F.substr(m, F.lit(1), F.lit(2))))
    day = F.try_to_date(iso, "yyyy-MM-dd")
    number = F.datediff(day, F.to_date(F.lit(FIRST_DAY))).cast("long")
    moduli = F.array(F.lit(DAYS_HIGH).cast("long"), F.lit(DAYS_LOW).cast("long"))

    def once(x: Column) -> Column:
        new = feistel(F.array(F.floor(x / DAYS_LOW).cast("long"), x % DAYS_LOW), moduli, f"{key}:date")
        return let(new, lambda n: F.element_at(n, 1) * DAYS_LOW + F.element_at(n, 2))

    # one number of the network's domain lies past the last day: a day that it stands for takes its image instead
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(2)), number, lambda x, i: F.when((i == 1) | (x == DAYS_HIGH * DAYS_LOW - 1), once(x)).otherwise(x))
    new = F.date_format(F.date_add(F.to_date(F.lit(FIRST_DAY)), walked.cast("int")), "yyyy-MM-dd")

    def written(out: Column) -> Column:
        swapped = F.concat(F.substr(out, F.lit(9), F.lit(2)), mark, F.substr(out, F.lit(6), F.lit(2)), mark, F.substr(out, F.lit(1), F.lit(4)))
        return F.when(mark == "-", out).otherwise(swapped)

    return F.when(day.isNotNull(), let(new, written))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.element_at(F.split(m, "-"), x).cast("long") for x in (1, 2, 3))
    fine = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    symbols = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    new = feistel(symbols, F.array(*(F.lit(x).cast("long") for x in (898, 99, 9999))), f"{key}:ssn")

    def written(n: Column) -> Column:
        high = F.element_at(n, 1) + 1
        parts = (F.lpad(F.when(high >= 666, high + 1).otherwise(high).cast("string"), 3, "0"), F.lpad((F.element_at(n, 2) + 1).cast("string"), 2, "0"), F.lpad((F.element_at(n, 3) + 1).cast("string"), 4, "0"))
        return F.concat_ws("-", *parts)

    return F.when(fine, let(new, written))


def _phone(m: Column, key: str) -> Column:
    def number(digits: Column) -> Column:
        n = F.size(digits)
        rest = feistel(F.slice(digits, 3, n - 2), _tens(n - 2), f"{key}:phone")
        new = F.transform(F.concat(F.slice(digits, 1, 2), rest), lambda d: d.cast("string"))
        return _put(F.split(m, ""), lambda c: ~c.rlike("[0-9]"), new)

    return let(_digits(m), number)


def _letters_and_digits(text: Column, key: str, tweak: Column) -> Column:
    """Lower- and upper-case letters and digits permuted within their class. A single one is shifted within its class by a number
    hashed from key and tweak; without any the result is null."""
    first = lambda c: F.when(c.rlike("[0-9]"), F.lit(48)).when(c.rlike("[A-Z]"), F.lit(65)).otherwise(F.lit(97))

    def moved(own: Column) -> Column:
        moduli = F.transform(own, lambda c: F.when(c.rlike("[0-9]"), F.lit(10)).otherwise(F.lit(26)).cast("long"))
        symbols = F.transform(own, lambda c: (F.ascii(c) - first(c)).cast("long"))
        spelled = F.zip_with(own, feistel(symbols, moduli, key), lambda a, b: F.char(first(a) + b))
        number = F.conv(F.substr(F.sha2(F.concat_ws(":", F.lit(key), F.lit("one"), tweak), 256), F.lit(1), F.lit(8)), 16, 10).cast("long")
        shifted = F.transform(own, lambda c, i: F.char(first(c) + (F.ascii(c) - first(c) + 1 + number % (F.element_at(moduli, i + 1) - 1)) % F.element_at(moduli, i + 1)))
        put = lambda new: _put(F.split(text, ""), lambda c: ~c.rlike("[A-Za-z0-9]"), new)
        return F.when(F.size(own) > 1, put(spelled)).when(F.size(own) == 1, put(shifted))

    return let(F.filter(F.split(text, ""), lambda c: c.rlike("[A-Za-z0-9]")), moved)


def _email(m: Column, key: str) -> Column:
    domain = F.substring_index(m, "@", -1)
    return F.concat(_letters_and_digits(F.substring_index(m, "@", 1), f"{key}:email", domain), F.lit("@"), domain)


def _mod97(text: Column) -> Column:
    """Of an account number with its first four characters moved to the end; letters count as 10 to 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97).cast("int"))


def _iban(m: Column, key: str) -> Column:
    country, body = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(5), F.lit(64))

    def checked(new: Column) -> Column:
        return F.concat(country, F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new)

    return F.when(_mod97(F.concat(body, F.substr(m, F.lit(1), F.lit(4)))) == 1, let(_letters_and_digits(body, f"{key}:iban", country), checked))


MAKERS = {"email": _email, "card": _card, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "iban": _iban}


def kind_of(m: Column) -> Column:
    """The kind whose pattern the candidate has."""
    out = F.when(m.contains("@"), F.lit("email")).when(m.rlike("^[A-Z]"), F.lit("iban")).when(m.rlike(PHONE), F.lit("phone"))
    out = out.when(m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\2[0-9]{4})$"), F.lit("date"))
    return out.when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.lit("ssn")).when(m.contains("."), F.lit("ip")).otherwise(F.lit("card"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_cols: bool = True) -> DataFrame:
    """docs with the text's personal data replaced, and n_<kind>: how many of each kind were.

    Null texts stay null and count 0; candidates that fail their validation stay as they are and aren't counted. Repeated rows
    get equal results. Other columns pass unchanged; a column of docs that is named like a count is replaced by it. The key has
    no default: whoever knows it can go back.
    """
    text = F.col("__text")
    step = docs.withColumn("__text", F.col(f"`{text_col}`").cast("string"))
    step = step.withColumn("__cards", cards_in(text))
    pattern = F.when(F.size("__cards") > 0, F.concat(F.lit(f"{CANDIDATE}|{CARD_BEGIN}(?:"), F.array_join("__cards", "|"), F.lit(f"){CARD_END}"))).otherwise(F.lit(CANDIDATE))
    step = step.withColumn("__pattern", pattern)
    step = step.withColumn("__found", F.regexp_extract_all(text, F.col("__pattern"), F.lit(0)))
    named = F.transform("__found", lambda m: F.struct(m.alias("m"), kind_of(m).alias("k")))

    def image(z: Column) -> Column:
        out = F.lit(None).cast("string")
        for kind in KINDS:
            out = F.when(z["k"] == kind, MAKERS[kind](z["m"], key)).otherwise(out)
        return F.struct(z["m"].alias("m"), z["k"].alias("k"), out.alias("new"))

    step = step.withColumn("__named", F.transform(named, image))
    # between the candidates, the text is cut by the same pattern
    between = F.split(text, F.col("__pattern"), -1)
    joined = F.array_join(
        F.concat(F.transform(F.arrays_zip(F.slice(F.col("__between"), 1, F.size("__named")).alias("b"), F.col("__named").alias("n")), lambda z: F.concat(z["b"], F.coalesce(z["n"]["new"], z["n"]["m"]))), F.slice("__between", -1, 1)), ""
    )
    step = step.withColumn("__between", F.when(F.size("__named") > 0, between))
    step = step.withColumn(text_col, F.when(F.size("__named") > 0, joined).otherwise(text))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("__named", lambda z: (z["k"] == kind) & z["new"].isNotNull())), F.lit(0)).cast("long")

    if count_cols:
        step = step.withColumns({f"n_{kind}": count(kind) for kind in KINDS})
    return step.drop("__text", "__found", "__named", "__between", "__cards", "__pattern")
