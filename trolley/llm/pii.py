"""Format-preserving pseudonyms for personal data, in native expressions.

One pattern finds candidates; those that hold up (card and bank numbers by their
check digits, dates by the calendar, addresses by their ranges) are replaced by a keyed
permutation of the values of the same format, so equal values have equal
pseudonyms in all documents and the key's owner can undo them. A value is split
in two halves of mixed radix that a Feistel network adds keyed digests to, eight
rounds each way; check digits are computed anew, and values that must stay
within a smaller set (dates, social security numbers) walk the permutation until
they fall into it.

Kept as they are: separators, country codes, the first digit of a card, the
domain of a mail address, the name in front of a secret, and candidates that do
not hold up.

Edge cases: a null text stays null, an empty one empty; a text without findings
is returned unchanged; overlapping candidates are taken from the left; a
card's or phone's last groups are left out where the number holds up only without
them. Every
row is treated alone, so repeated rows get equal results, and all columns are kept
whatever their names.
"""

from functools import reduce

from pyspark.sql import functions as F

ROUNDS = 8
CHUNK = 9  # characters permuted together; 26^9 values fit a long

_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*"
# How long a bank number is in each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form(length, countries):
    tail = f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}{tail}"


_KNOWN = "|".join(" ".join(IBAN_LENGTHS.values()).split())
# Other countries' numbers are taken as long as they go, and shortened if they do not hold up.
_IBAN = (
    f"(?:{'|'.join(_iban_form(*form) for form in IBAN_LENGTHS.items())}"
    rf"|(?!{_KNOWN})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"
)
_ACCESS_KEY = r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
_SECRET = r"""(?i:password|passwd|secret|token|api[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?[A-Za-z0-9+/_-]{8,}+"""
_IP = r"\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
_DATE = r"(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?!\d)"
_SSN = r"\d{3}-\d{2}-\d{4}(?!\d)"
_PHONE = (
    r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?!\d)"
    r"|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\+\d{8,15}(?!\d)"
)
# A short group after 16 digits is left alone where it begins a date, an address or a number of its own.
_CARD = (
    r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3}(?![./:-]?\d| \d{3}[-. ]\d{4}|[A-Za-z]))?"
    r"|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
)
# Order decides between kinds that begin at the same place.
KINDS = {
    "email": _EMAIL, "iban": _IBAN, "access_key": _ACCESS_KEY, "secret": _SECRET, "ip": _IP, "date": _DATE,
    "ssn": _SSN, "phone": _PHONE, "card": _CARD,
}
_FIND = (
    rf"(?<![A-Za-z0-9._%+-]){_EMAIL}|(?<![A-Za-z0-9])(?:{_IBAN}|{_ACCESS_KEY}|{_SECRET})"
    rf"|(?<![A-Za-z0-9.+-])(?:{_DATE}(?:(?=[Tt]\d)|(?![A-Za-z]))|(?:{_IP}|{_SSN}|{_PHONE}|{_CARD})(?![A-Za-z]))"
)
# Every candidate holds one of these; texts without them are not searched.
_HINT = r"[0-9@]|[Pp]ass|[Ss]ecret|[Tt]oken|PASS|SECRET|TOKEN|(?i:api.?key)"

FIRST_DAY, DAYS = "1000-01-01", 730_485  # years 1000 to 2999
_SIDE = 855  # 855 * 855 is the smallest square of at least DAYS


def _digest(key, tweak, number, turn):
    """A number below 16^12 from the key, a round and a half."""
    data = F.concat_ws(":", F.lit(key), tweak, turn.cast("string"), number.cast("string"))
    return F.conv(F.substring(F.sha2(data, 256), 1, 12), 16, 10).cast("long")


def _feistel(left, a, right, b, key, tweak):
    """The pair (left below a, right below b) after all rounds, as a struct (l, r)."""
    def turn(halves, n):
        # Odd rounds change the left half by the right one, even rounds the right by the left.
        odd = n % 2 == 1
        mask = _digest(key, tweak, F.when(odd, halves["r"]).otherwise(halves["l"]), n)
        return F.struct(
            F.when(odd, F.pmod(halves["l"] + mask, a)).otherwise(halves["l"]).alias("l"),
            F.when(odd, halves["r"]).otherwise(F.pmod(halves["r"] + mask, b)).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * ROUNDS)), start, turn)


def _radix(c):
    return F.when(c.between("0", "9"), 10).otherwise(26).cast("long")


def _value(c):
    base = F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).otherwise(65)
    return (F.ascii(c) - base).cast("long")


def _letter(like, value):
    base = F.when(like.between("0", "9"), 48).when(like.between("a", "z"), 97).otherwise(65)
    return F.char(value + base)


def _chunk(text, key, tweak):
    """Permute a string of at most CHUNK ASCII letters and digits within its character classes."""
    chars = F.split(text, "")
    half = F.floor(F.length(text) / 2).cast("int")
    first, second = F.slice(chars, F.lit(1), half), F.slice(chars, half + 1, F.length(text))

    def size(part):
        return F.aggregate(part, F.lit(1).cast("long"), lambda n, c: n * _radix(c))

    def number(part):
        return F.aggregate(part, F.lit(0).cast("long"), lambda n, c: n * _radix(c) + _value(c))

    def spelled(part, n):
        done = F.aggregate(
            F.reverse(part), F.struct(F.lit("").alias("out"), n.alias("rest")),
            lambda at, c: F.struct(
                F.concat(_letter(c, F.pmod(at["rest"], _radix(c))), at["out"]).alias("out"),
                F.floor(at["rest"] / _radix(c)).cast("long").alias("rest"),
            ),
        )
        return done["out"]

    moved = F.array(_feistel(number(first), size(first), number(second), size(second), key, tweak))
    # A one-element transform evaluates the network once for both halves.
    return F.transform(moved, lambda h: F.concat(spelled(first, h["l"]), spelled(second, h["r"])))[0]


def permute(text, key, tweak):
    """Permute a string of ASCII letters and digits of any length, chunk by chunk."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(CHUNK))

    def step(done, start):
        part = text.substr(start, F.lit(CHUNK))
        before = text.substr(F.greatest(start - CHUNK, F.lit(1)), F.when(start > 1, CHUNK).otherwise(0))
        return F.concat(done, _chunk(part, key, F.concat_ws("/", F.lit(tweak), start.cast("string"), before)))

    return F.when(F.length(text) > 0, F.aggregate(starts, F.lit(""), step)).otherwise(text)


def _fill(form, payload):
    """``form`` with its letters and digits replaced, in order, by those of ``payload``."""
    done = F.aggregate(
        F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(
            c.rlike("^[A-Za-z0-9]$"),
            F.struct(F.concat(acc["out"], payload.substr(acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
    )
    return done["out"]


def _let(value, body):
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _plain(m):
    return F.regexp_replace(m, "[^A-Za-z0-9]", "")


def _luhn(digits):
    """Sum of the Luhn check over a string of digits."""
    def add(total, at):
        d = digits.substr(at, F.lit(1)).cast("int")
        twice = F.pmod(F.length(digits) - at, F.lit(2)) == 1
        return total + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _own(m, own, replaced):
    """``replaced`` of the part that a finding begins with, and the rest as it is."""
    return _let(own, lambda x: F.concat(replaced(x), m.substr(F.length(x) + 1, F.length(m))))


def _card(m, key):
    def one(m, digits):
        moved = F.concat(digits.substr(1, 1), permute(digits.substr(F.lit(2), F.length(digits) - 2), key, "card"))
        checked = _let(moved, lambda x: F.concat(x, F.pmod(10 - _luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(_luhn(digits) % 10 == 0, _fill(m, checked)).otherwise(m)

    # A short last group belongs to the card only if the longer number holds up.
    own = F.when(_luhn(_plain(m)) % 10 == 0, m).otherwise(F.regexp_replace(m, r"^(\d{4}(?:[ -]\d{4}){3})[ -]\d{1,3}$", "$1"))
    return _own(m, own, lambda m: _let(_plain(m), lambda digits: one(m, digits)))


def _mod97(text):
    """Remainder of a bank number, letters counted from ten."""
    def add(rest, c):
        digit = c.between("0", "9")
        return F.when(digit, rest * 10 + _value(c)).otherwise(rest * 100 + _value(c) + 10) % 97

    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), add)


def _valid_iban(plain):
    return _mod97(F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(1, 4))) == 1


def _iban(m, key):
    def one(m, plain):
        country, account = plain.substr(1, 2), plain.substr(F.lit(5), F.length(plain))
        new = _let(permute(account, key, "iban"), lambda x: F.concat(
            country, F.lpad((98 - _mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x
        ))
        return F.when(_valid_iban(plain), _fill(m, new)).otherwise(m)

    # Of a number of unknown length, the words at the end are dropped until it holds up.
    words = F.split(m, " ")
    shorter = F.transform(
        F.reverse(F.sequence(F.lit(1), F.size(words))), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    )
    holding = F.filter(shorter, lambda x: _valid_iban(_plain(x)) & (F.length(_plain(x)) >= 12))
    own = F.when(m.rlike(f"^(?:{_KNOWN})"), m).otherwise(F.coalesce(F.get(holding, F.lit(0)), m))
    return _own(m, own, lambda m: _let(_plain(m), lambda plain: one(m, plain)))


def _phone(m, key):
    def one(m):
        prefix = F.regexp_extract(m, r"^(\+?1(?=[ .(-])|\+\d{1,2}(?=[ .(-])|\+\d{2})?", 0)
        rest = m.substr(F.length(prefix) + 1, F.length(m))
        digits = F.length(_plain(m))
        return F.when(
            digits.between(9, 15), F.concat(prefix, _let(permute(_plain(rest), key, "phone"), lambda x: _fill(rest, x)))
        ).otherwise(m)

    # Groups beyond 15 digits are not the number's own.
    own = F.when(F.length(_plain(m)) <= 15, m).otherwise(F.regexp_extract(m, r"^\+(?:[ .()-]*\d){9,15}(?=[ .-])|^", 0))
    return _own(m, own, one)


def _walk(start, valid, step, limit=40):
    """Follow the permutation from a valid value until it is valid again."""
    def go(at, _):
        return F.when(at["done"], at).otherwise(
            _let(step(at["x"]), lambda x: F.struct(x.alias("x"), valid(x).alias("done")))
        )

    first = F.struct(start.alias("x"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(limit)), first, go)["x"]


def _ssn(m, key):
    valid = lambda x: x.rlike(r"^(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}$")
    moved = _walk(_plain(m), valid, lambda x: permute(x, key, "ssn"))
    return F.when(valid(_plain(m)), _fill(m, moved)).otherwise(m)


def _ip(m, key):
    parts = F.split(m, r"\.")
    octet = [parts[k].cast("long") for k in range(4)]
    valid = reduce(lambda x, y: x & y, [o <= 255 for o in octet])
    moved = _feistel(octet[0] * 256 + octet[1], F.lit(65536), octet[2] * 256 + octet[3], F.lit(65536), key, F.lit("ip"))
    low = lambda x: F.pmod(x, F.lit(256)).cast("string")
    high = lambda x: F.floor(x / 256).cast("string")
    spelled = _let(moved, lambda h: F.concat_ws(".", high(h["l"]), low(h["l"]), high(h["r"]), low(h["r"])))
    return F.when(valid, spelled).otherwise(m)


def _date(m, key):
    """The year stands first or last; of the other two, the first is the day if that can be."""
    sign = F.regexp_extract(m, r"\d([-/.])", 1)
    numbers = F.split(m, "[-/.]")
    x, y, z = (numbers[k].cast("int") for k in range(3))
    year_first = F.length(numbers[0]) == 4
    padded = ~m.rlike(r"(^|[-/.])\d([-/.]|$)")
    day = lambda y, m, d: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    by_day, by_month = day(z, y, x), day(z, x, y)
    date = F.when(year_first, day(x, y, z)).otherwise(F.coalesce(by_day, by_month))
    day_first = by_day.isNotNull()

    def step(n):
        moved = _feistel(F.floor(n / _SIDE), F.lit(_SIDE), F.pmod(n, F.lit(_SIDE)), F.lit(_SIDE), key, F.lit("date"))
        return _let(moved, lambda h: h["l"] * _SIDE + h["r"])

    def spell(d):
        short = lambda n: F.when(padded, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
        year, month, number = F.lpad(F.year(d).cast("string"), 4, "0"), short(F.month(d)), short(F.dayofmonth(d))
        return F.when(year_first, F.concat(year, sign, month, sign, number)).when(
            day_first, F.concat(number, sign, month, sign, year)
        ).otherwise(F.concat(month, sign, number, sign, year))

    first = F.to_date(F.lit(FIRST_DAY))
    start = F.datediff(date, first).cast("long")
    moved = _walk(start, lambda n: n < DAYS, step, limit=12)
    return F.when(start.between(0, DAYS - 1), _let(moved, lambda n: spell(F.date_add(first, n.cast("int"))))).otherwise(m)


def _email(m, key):
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(_let(permute(_plain(local), key, "email"), lambda x: _fill(local, x)), F.lit("@"), domain)


def _secret(m, key):
    name = F.regexp_extract(m, r"""^([A-Za-z_-]+["']?\s*[=:]\s*["']?|AKIA|ASIA)""", 1)
    rest = m.substr(F.length(name) + 1, F.length(m))
    return F.concat(name, _let(permute(_plain(rest), key, "secret"), lambda x: _fill(rest, x)))


_REPLACE = {
    "email": _email, "iban": _iban, "access_key": _secret, "secret": _secret, "ip": _ip, "date": _date,
    "ssn": _ssn, "phone": _phone, "card": _card,
}


def pseudonym(found, key):
    """The pseudonym of one finding, itself if it does not hold up."""
    chosen = None
    for kind, pattern in KINDS.items():
        test = found.rlike(f"^(?:{pattern})$")
        chosen = F.when(test, _REPLACE[kind](found, key)) if chosen is None else chosen.when(test, _REPLACE[kind](found, key))
    return chosen.otherwise(found)


def pseudonymise(docs, key="first-key", column="text", findings=None):
    """``docs`` with the column's personal data replaced.

    With a name for ``findings``, that column gets the number of replaced values.
    """
    text = docs[column].cast("string")
    hinted = text.rlike(_HINT)
    found = F.when(hinted, F.regexp_extract_all(text, F.lit(_FIND), F.lit(0))).otherwise(F.array().cast("array<string>"))
    new = F.transform(found, lambda m: pseudonym(m, key))
    parts = F.split(text, _FIND, -1)
    pieces = lambda done: F.array_join(
        F.zip_with(parts, done, lambda part, m: F.concat(part, F.coalesce(m, F.lit("")))), ""
    )
    both = _let(F.struct(found.alias("found"), new.alias("new")), lambda s: F.struct(
        F.when(F.size(s["found"]) > 0, pieces(s["new"])).otherwise(text).alias("text"),
        F.size(F.filter(F.zip_with(s["found"], s["new"], lambda x, y: x != y), lambda x: x)).cast("long").alias("n"),
    ))
    if findings is None:
        return docs.withColumn(column, both["text"])
    return docs.withColumns({column: both["text"], findings: F.coalesce(both["n"], F.lit(0))})
