"""Personal data replaced by keyed, format-preserving pseudonyms; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, unlike

ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: IBAN lengths by country (the registry's, and those in partial use).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV LY MZ PT ST GW",
    26: "IR IS TR DZ", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_TAIL = r"(?![A-Za-z0-9])"


def _iban_of(length: int, lands: str) -> str:
    fours, rest = divmod(length - 4, 4)
    return rf"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "") + _TAIL


#: Of a country in the table just its length, so that no following word is taken in; of others any.
_IBAN = ("(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_iban_of(n, lands) for n, lands in IBAN_LENGTHS.items())
         + rf"|(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_TAIL})")
#: So many digits of a phone number stand before (spelt out, as a look-behind needs an obvious length).
_AFTER_8, _AFTER_16 = (r"[0-9]" + r"[ .()-]{0,3}[0-9]" * (n - 1) for n in (8, 16))
#: Shapes of other values that may follow a number; with 8 digits before they are no part of it.
_OTHER = (r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
          r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9])")
#: Numbers of +1 have ten more digits; others 15 digits at most.
_ABROAD = (r"\+(?:1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
           rf"|[0-9]{{1,3}}(?:(?!(?<={_AFTER_8}\)?)[ .-]{_OTHER})[ .-]?\(?[0-9]{{1,4}}\)?){{2,6}}(?![0-9A-Za-z])(?<!{_AFTER_16}\)?))")
#: What is looked for, in order of precedence at a place. Values that fail their check are left alone. The regular-expression
#: engine matches a repeated group by recursion, so every one has an upper bound (a domain has at most 253 characters).
PATTERNS = {
    "email": r"(?<![._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,}",
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_/+.-]{8,}",
    "access_key": r"A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": _IBAN,
    "card": r"(?:[2-6][0-9]{12,18}|[2-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[47][0-9]{2}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9])|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z]))",
    "ip": rf"(?<![0-9]\.){_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}(?!\.?[0-9A-Za-z])",
    "phone": r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "phone_abroad": _ABROAD,
}
#: All of them, where no letter or digit stands before. The two back references are the groups 1 and 2.
ANY = "(?<![A-Za-z0-9])(?:" + "|".join(PATTERNS.values()) + ")"
#: Letters and digits are moved within these, so hexadecimal stays hexadecimal.
ALPHABETS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digest(key: str, tag: Column | str, i: Column, half: Column) -> Column:
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string")).cast("binary"), 256)


def _rounds(invert: bool) -> Column:
    order = range(ROUNDS - 1, -1, -1) if invert else range(ROUNDS)
    return F.array(*[F.lit(i) for i in order])


def permute_number(left: Column, right: Column, a: int, b: int, key: str, tag: Column | str, invert: bool) -> Column:
    """Permutation of the pairs (0..a-1, 0..b-1): Feistel rounds move one half by a keyed hash of
    the other, in turn. Returns struct(l, r)."""
    sign = -1 if invert else 1

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        h = F.conv(F.substring(_digest(key, tag, i, F.when(even, s["r"]).otherwise(s["l"])), 1, 14), 16, 10).cast("long")
        return F.struct(F.when(even, F.pmod(s["l"] + sign * h, F.lit(a))).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * h, F.lit(b))).alias("r"))

    return F.aggregate(_rounds(invert), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def permute_text(s: Column, key: str, tag: Column | str, invert: bool) -> Column:
    """Permutation of the texts of one shape: Feistel rounds move each letter and digit of one half
    within its alphabet by the keyed hash of the other half; other characters stay."""
    sign = -1 if invert else 1

    def moved(half: Column, digest: Column) -> Column:
        def one(c: Column, j: Column, g: Column) -> Column:
            k = F.conv(F.substr(g, (j * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")
            out = c
            for alphabet in ALPHABETS:
                at = F.instr(F.lit(alphabet), c)
                out = F.when(at > 0, F.substr(F.lit(alphabet), F.pmod(at - 1 + sign * k, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
            return out

        # the digest is an array's element, so it is taken once and not for every character
        return F.element_at(F.transform(F.array(digest), lambda g: F.array_join(F.transform(_chars(half), lambda c, j: one(c, j, g)), "")), 1)

    def step(p: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, moved(p["a"], _digest(key, tag, i, p["b"]))).otherwise(p["a"]).alias("a"),
                        F.when(even, p["b"]).otherwise(moved(p["b"], _digest(key, tag, i, p["a"]))).alias("b"))

    half = F.floor(F.length(s) / 2).cast("int")
    ends = F.struct(F.substr(s, F.lit(1), half).alias("a"), F.substr(s, half + 1, F.length(s)).alias("b"))
    return F.aggregate(_rounds(invert), ends, step, lambda p: F.concat(p["a"], p["b"]))


def only(s: Column, chars: str) -> Column:
    return F.regexp_replace(s, f"[^{chars}]", "")


def refill(shape: Column, chars: str, new: Column) -> Column:
    """``shape`` with its characters of the class ``chars`` replaced, in order, by those of ``new``."""
    return F.array_join(F.transform(_chars(shape), lambda c, j: F.when(
        c.rlike(f"[{chars}]"), F.substr(new, F.length(only(F.substr(shape, F.lit(1), j + 1), chars)), F.lit(1))).otherwise(c)), "")


def luhn_sum(digits: Column, shift: int) -> Column:
    """Sum of the digits from the right, every second doubled; ``shift`` 1 if a check digit is still to come."""
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when((i + shift) % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), worth), F.lit(0), lambda x, y: x + y)


def mod97(s: Column) -> Column:
    return F.aggregate(_chars(s), F.lit(0), lambda x, c: F.when(c.rlike("[0-9]"), (x * 10 + F.ascii(c) - 48) % 97)
                       .otherwise((x * 100 + F.ascii(c) - 55) % 97).cast("int"))


def pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


# ------------------------------------------------------------ pseudonyms by kind

def _email(m: Column, key: str, invert: bool) -> Column:
    low = F.lower(m)
    end = F.regexp_extract(low, r"\.[a-z]+$", 0)
    return F.concat(permute_text(F.substr(low, F.lit(1), F.length(low) - F.length(end)), key, "email", invert), end)


def _secret(m: Column, key: str, invert: bool) -> Column:
    head = F.regexp_extract(m, r"^[A-Za-z_-]+[ \t]*[=:][ \t]*[\"']?", 0)
    return F.concat(head, permute_text(F.substr(m, F.length(head) + 1, F.length(m)), key, "secret", invert))


def _access_key(m: Column, key: str, invert: bool) -> Column:
    return F.concat(F.substring(m, 1, 4), permute_text(F.substr(m, F.lit(5), F.lit(16)), key, "access_key", invert))


def _iban(m: Column, key: str, invert: bool) -> Column:
    s = only(m, "A-Z0-9")
    own = F.substr(s, F.lit(5), F.length(s))
    land = F.substring(s, 1, 2)
    new = permute_text(own, key, F.concat(F.lit("iban"), land), invert)
    check = pad(98 - mod97(F.concat(new, land, F.lit("00"))), 2)
    valid = mod97(F.concat(own, F.substring(s, 1, 4))) == 1
    return F.when(valid, refill(m, "A-Z0-9", F.concat(land, check, new))).otherwise(m)


def _card(m: Column, key: str, invert: bool) -> Column:
    """The first two digits (of the issuer) stay, the last is the check digit, those between move."""
    d = only(m, "0-9")
    new = F.concat(F.substring(d, 1, 2), permute_text(F.substr(d, F.lit(3), F.length(d) - 3), key, "card", invert))
    full = F.concat(new, ((10 - luhn_sum(new, 1) % 10) % 10).cast("string"))
    return F.when(luhn_sum(d, 0) % 10 == 0, refill(m, "0-9", full)).otherwise(m)


def _ssn(m: Column, key: str, invert: bool) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    p = permute_number(place * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn", invert)

    def shown(p: Column) -> Column:
        at = F.floor(p["l"] / 99)
        return F.concat_ws("-", pad(F.when(at >= 665, at + 2).otherwise(at + 1), 3), pad(p["l"] % 99 + 1, 2), pad(p["r"] + 1, 4))

    return F.when(valid, F.element_at(F.transform(F.array(p), shown), 1)).otherwise(m)


def _date(m: Column, key: str, invert: bool) -> Column:
    """Days from 1900-01-01 to 2099-12-31 (73,049 = 17 x 4,297) move among each other. Dates with
    slashes or dots have the day first; where only month first is valid, the year moves among the 200 (29 February stays)."""
    sep = F.regexp_extract(m, "[-/.]", 0)
    iso = sep == "-"
    p = [F.element_at(F.split(m, "[-/.]"), i).cast("int") for i in (1, 2, 3)]
    y, mo, d = F.when(iso, p[0]).otherwise(p[2]), p[1], F.when(iso, p[2]).otherwise(p[0])
    day = F.try_make_timestamp(y, mo, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    n = F.datediff(day, F.lit("1900-01-01").cast("date"))
    moved = permute_number(F.floor(n / 4297), n % 4297, 17, 4297, key, "date", invert)

    def shown(q: Column) -> Column:
        new = F.date_add(F.lit("1900-01-01").cast("date"), (q["l"] * 4297 + q["r"]).cast("int"))
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(new, "dd"), sep, F.date_format(new, "MM"), sep, F.date_format(new, "yyyy")))

    swapped = F.try_make_timestamp(y, d, mo, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    year = permute_number(F.floor((y - 1900) / 10), (y - 1900) % 10, 20, 10, key, F.concat(F.lit("year"), F.substring(m, 1, 5)), invert)
    other = F.element_at(F.transform(F.array(year), lambda q: F.concat(F.substring(m, 1, 6), pad(1900 + q["l"] * 10 + q["r"], 4))), 1)
    in_range = y.between(1900, 2099)
    return (F.when(in_range & day.isNotNull(), F.element_at(F.transform(F.array(moved), shown), 1))
            .when(in_range & ~iso & swapped.isNotNull() & ~((d == 2) & (mo == 29)), other).otherwise(m))


def _ip(m: Column, key: str, invert: bool) -> Column:
    o = [F.element_at(F.split(m, "[.]"), i).cast("int") for i in (1, 2, 3, 4)]
    p = permute_number(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip", invert)
    return F.element_at(F.transform(F.array(p), lambda q: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(q[h] / 256), q[h] % 256)])), 1)


def _phone(m: Column, key: str, invert: bool) -> Column:
    """Area code and exchange stay from 200 to 999: 800 * 800 * 10,000 numbers are 80,000 squared."""
    d = only(m, "0-9")
    own = F.right(d, F.lit(10))
    place = ((F.substring(own, 1, 3).cast("long") - 200) * 800 + F.substring(own, 4, 3).cast("long") - 200) * 10000 + F.substring(own, 7, 4).cast("long")
    p = permute_number(F.floor(place / 80000), place % 80000, 80000, 80000, key, "phone", invert)

    def shown(q: Column) -> Column:
        n = q["l"] * 80000 + q["r"]
        return F.concat(pad(F.floor(n / 8000000) + 200, 3), pad(F.floor(n / 10000) % 800 + 200, 3), pad(n % 10000, 4))

    new = F.element_at(F.transform(F.array(p), shown), 1)
    return refill(m, "0-9", F.concat(F.substr(d, F.lit(1), F.length(d) - 10), new))


def _phone_abroad(m: Column, key: str, invert: bool) -> Column:
    """The first two digits (of the country) stay, the others move as digits."""
    d = only(m, "0-9")
    new = F.concat(F.substring(d, 1, 2), permute_text(F.substr(d, F.lit(3), F.length(d)), key, "abroad", invert))
    return F.when(F.length(d).between(8, 15), refill(m, "0-9", new)).otherwise(m)


_MAKE = {"email": _email, "secret": _secret, "access_key": _access_key, "iban": _iban, "card": _card, "ssn": _ssn,
         "date": _date, "ip": _ip, "phone": _phone, "phone_abroad": _phone_abroad}


def pseudonym(m: Column, key: str, invert: bool = False) -> Column:
    """Pseudonym of a found value, by its kind; a value that fails its kind's check stays."""
    out = m
    for kind in reversed(list(_MAKE)):
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), _MAKE[kind](m, key, invert)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", invert: bool = False, count: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all rows and columns stay.

    Found are e-mail addresses, IPv4 addresses, payment cards (Luhn), IBANs (mod 97),
    US social security numbers, phone numbers, dates from 1900 to 2099, and secrets
    (access keys, values after password or token). Each becomes another valid value of its
    format by a keyed permutation, so equal values stay equal over all
    documents, different ones different, and ``invert`` with the same key brings the texts
    back (e-mails in lower case). Spaces and signs of a number's spelling don't matter: its digits map alike.
    ``count``: name of a column to add with the number of values changed (replacing one of that name).

    Whole texts are read, with one regular expression; null stays null, empty texts stay
    empty, repeated rows are treated alike. Nothing is joined or shuffled.
    """
    own = unlike(docs, "_pii_")
    body, old, new = named(text), own + "old", own + "new"
    found = F.regexp_extract_all(body, F.lit(ANY), 0)
    d = docs.withColumn(old, F.when(body.rlike("[0-9@=:]|A[KS]IA"), found))
    d = d.withColumn(new, F.when(F.size(old) > 0, F.transform(old, lambda m: pseudonym(m, key, invert))))
    gaps = F.split(body, ANY, -1)
    joined = F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size(new)), new, lambda g, m: F.concat(g, m)), ""),
                      F.element_at(gaps, -1))
    d = d.withColumn(text, F.when(F.col(new).isNotNull(), joined).otherwise(body))
    if count:
        changed = F.aggregate(F.zip_with(old, new, lambda a, b: F.when(a != b, 1).otherwise(0)), F.lit(0), lambda x, y: x + y)
        d = d.withColumn(count, F.coalesce(F.when(F.col(new).isNotNull(), changed), F.lit(0)))
    return d.drop(old, new)
