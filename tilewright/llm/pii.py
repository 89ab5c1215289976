"""Format-preserving pseudonyms of personal data, with DataFrame functions only.

Found values are permuted within their format by a Feistel network whose round function is SHA-256 of the key, the format, the round
and the other half, so the same value gets the same pseudonym in every document, different values of a format get different
ones, and only the key undoes it.

* card numbers (13 to 19 digits that pass the Luhn check, in any groups between spaces or hyphens, or in groups of four between
  full stops or slashes): all digits but the last are permuted, the last is the check digit. In a longer run of numbers, each
  card that begins like one, whatever its groups of two digits or more, is found;
* phone numbers: the ten digits of a North American number, with or without its ``+1`` or signs, are permuted alike; of others
  all digits; signs and spaces stay. US social security numbers likewise;
* dates (year-month-day, year/month/day, day.month.year, month/day/year, of the years 1800 to 2199, days and months of one digit
  too): the day is permuted among the 146,097 days of that span;
* IPv4 addresses: the 32 bits are permuted; of IPv6 addresses the digits as they stand; IBANs (checked modulo 97): digits of the account are permuted, check digits anew;
* e-mail addresses, in letters of any script: name and domain are permuted letter for letter and digit for digit, and the domain
  is set under ``.example``;
* secrets (``token``, ``key``, ``password``, ``secret`` and the like, quoted or not, followed by a value of 12 or more characters, or
  of 6 or more with a digit, and what follows ``bearer``): values of hexadecimal digits become such values, others stay letters for letters and digits for digits.

Numbers are permuted as two halves of decimal digits in turn, so a number keeps its length; a number of one digit is shifted.
Texts are permuted as two halves of characters, of any length; large and small letters shift alike, so that addresses that
differ only in case stay linked; a letter other than ASCII moves among the 64 of its block. Values may be of any length: no pattern has an upper bound where its format has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

#: Characters of an IBAN by country; other countries' are taken as they stand.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
}
_OF_LENGTH = "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

#: A secret's value: 12 characters or more, or from 6 on with a digit among them.
SECRET = r"(?=[A-Za-z0-9+/_.~\-]{12}|[A-Za-z+/_.~\-]*[0-9])[A-Za-z0-9+/_.~\-]{6,}+"

#: What is looked for, in this order where several could begin.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+\-])[\p{L}\p{M}\p{N}._%+\-]++@(?:[\p{L}\p{M}\p{N}\-]++\.(?=[\p{L}\p{N}]))++(?<=\.)[\p{L}\p{M}\p{N}\-]*+(?<=[\p{L}\p{M}]{2})",
    "secret": rf"(?i:api[_\- ]?key|secret|token|password|passwd|pwd|access[_\- ]?key)[\"']?\s*+[:=]\s*+[\"']?{SECRET}|(?i:(?<![A-Za-z])bearer)\s++{SECRET}",
    "iban": rf"(?<![A-Za-z0-9])(?:{_OF_LENGTH}|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ip6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "date": r"(?<![\d./\-])(?:(?:18|19|20|21)\d\d(?:-\d\d?-|/\d\d?/)\d\d?|\d\d?\.\d\d?\.(?:18|19|20|21)\d\d|\d\d?/\d\d?/(?:18|19|20|21)\d\d)(?!\d|[./\-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)|(?<![\d+.,\-])[2-9]\d\d[2-9]\d{6}(?!\d|[.,\-]\d)",
    "card": r"(?<!\d)(?<!\d[./])(?:\d{4}\.\d{4}\.\d{4}\.\d{1,7}|\d{4}/\d{4}/\d{4}/\d{1,7})(?!\d|[./]\d)|(?<!\d)\d(?:[ \-]?\d){12,}+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _round(value: Column, key: str, tag: Column, r: Column, modulus: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, r.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("long"), modulus)


def _feistel(high: Column, low: Column, of_high: Column, of_low: Column, key: str, tag: Column) -> Column:
    """struct(h, l): a keyed permutation of the pairs (high, low) with 0 <= high < of_high and 0 <= low < of_low. A fold over the
    rounds, whose even ones move the high half and whose odd ones the low half."""
    def step(s, r):
        odd = r % 2 == 1
        moved = _round(F.when(odd, s["h"]).otherwise(s["l"]), key, tag, r, F.when(odd, of_low).otherwise(of_high))
        return F.struct(F.when(odd, s["h"]).otherwise(F.pmod(s["h"] + moved, of_high)).cast("long").alias("h"), F.when(odd, F.pmod(s["l"] + moved, of_low)).otherwise(s["l"]).cast("long").alias("l"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(high.cast("long").alias("h"), low.cast("long").alias("l")), step)


def feistel(high: Column, low: Column, of_high: Column, of_low: Column, key: str, tag: Column) -> tuple[Column, Column]:
    """Both halves of that permutation."""
    s = _feistel(high, low, of_high, of_low, key, tag)
    return s["h"], s["l"]


def _held(values: dict[str, Column], then) -> Column:
    """``then`` of the values, each computed once: a lambda over one struct."""
    s = F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), lambda x: then(x))
    return F.get(s, F.lit(0))


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permuted_digits(digits: Column, key: str, tag: str) -> Column:
    """A string of 1 to 36 digits, permuted among those of its length, in rounds that are each computed once."""
    n = F.length(digits)
    halves = _held({"n": n, "u": F.floor(n / 2).cast("int"), "d": digits}, lambda s: F.struct(
        s["n"].alias("n"), s["u"].alias("u"), F.coalesce(F.substr(s["d"], F.lit(1), s["u"]).try_cast("long"), F.lit(0)).alias("h"), F.substr(s["d"], s["u"] + 1, s["n"]).cast("long").alias("l")))

    def of(v):
        s = v["s"]
        bounds = {"s": s, "x": _power(s["u"]), "y": _power(s["n"] - s["u"]), "mark": F.concat(F.lit(tag), s["n"].cast("string"))}
        moved = lambda w: F.struct(w["s"].alias("s"), _feistel(w["s"]["h"], w["s"]["l"], w["x"], w["y"], key, w["mark"]).alias("p"))
        return _held({"m": _held(bounds, moved)}, lambda w: F.concat(F.when(w["m"]["s"]["u"] > 0, F.lpad(w["m"]["p"]["h"].cast("string"), w["m"]["s"]["u"], "0")).otherwise(F.lit("")), F.lpad(w["m"]["p"]["l"].cast("string"), w["m"]["s"]["n"] - w["m"]["s"]["u"], "0")))

    return _held({"s": halves}, of)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _laid_into(template: Column, digits: Column, kind: str = "[0-9]") -> Column:
    """The template with its digits replaced, one after the other, by ``digits``."""
    chars = F.split(template, "")
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("t"))
    put = lambda a, c: F.when(F.regexp_like(c, F.lit(kind)), F.struct((a["i"] + 1).alias("i"), F.concat(a["t"], F.substr(digits, a["i"] + 1, F.lit(1))).alias("t"))).otherwise(F.struct(a["i"].alias("i"), F.concat(a["t"], c).alias("t")))
    return F.aggregate(chars, start, put, lambda a: a["t"])


def luhn_sum(digits: Column, from_check: bool) -> Column:
    """The Luhn sum; with ``from_check`` the last digit is the check digit, else it is the one before it."""
    n = F.length(digits)
    def add(a, i):
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = (i % 2 == 1) if from_check else (i % 2 == 0)
        return a + F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


#: Groups of digits that may be a card where several numbers stand one after the other: any of two digits or more.
GROUPED = r"^(?:[2-9]|1\d)(?:,(?:[2-9]|1\d)){0,8}$"
#: First digits of cards' numbers: those of payment, travel and merchandising.
FIRST = r"^[2-6]"


def _card(text: Column, key: str) -> Column:
    def of(s):
        body = permuted_digits(F.substr(s["d"], F.lit(1), F.length(s["d"]) - 1), key, "card")
        return _held({"b": body, "t": s["t"]}, lambda v: _laid_into(v["t"], F.concat(v["b"], F.pmod(10 - luhn_sum(v["b"], False) % 10, F.lit(10)).cast("string"))))

    valid = lambda d: F.length(d).between(13, 19) & (luhn_sum(d, True) % 10 == 0)
    one = lambda t: _held({"d": _digits(t), "t": t}, of)

    def several(s):
        """Cards among groups of digits (``g``: digits and signs in turn), the longest first at each place."""
        def step(a, i):
            last = lambda j: F.slice(s["g"], i + 1, j - i + 1)
            digits = lambda j: F.array_join(F.filter(last(j), lambda x: x.between("0", ":")), "")
            shape = lambda j: F.array_join(F.transform(F.filter(last(j), lambda x: x.between("0", ":")), lambda x: F.length(x).cast("string")), ",")
            ends = F.filter(F.sequence(i, F.least(i + 16, F.size(s["g"]) - 1)), lambda j: (j % 2 == 0) & F.regexp_like(shape(j), F.lit(GROUPED)) & F.regexp_like(digits(j), F.lit(FIRST)) & valid(digits(j)))
            found = lambda v: F.when(v["e"].isNull(), F.struct((v["i"] + 1).alias("next"), F.concat(v["out"], F.get(s["g"], v["i"])).alias("out"))).otherwise(
                F.struct((v["e"] + 1).alias("next"), F.concat(v["out"], one(F.array_join(F.slice(s["g"], v["i"] + 1, v["e"] - v["i"] + 1), ""))).alias("out")))
            return F.when(i < a["next"], a).otherwise(_held({"e": F.when(i % 2 == 0, F.array_max(ends)), "i": i, "out": a["out"]}, found))

        return F.aggregate(F.sequence(F.lit(0), F.size(s["g"]) - 1), F.struct(F.lit(0).alias("next"), F.lit("").alias("out")), step, lambda a: a["out"])

    groups = lambda t: _held({"g": F.regexp_extract_all(t, F.lit(r"[0-9]+|[ \-]"), F.lit(0))}, several)
    return _held({"d": _digits(text), "t": text}, lambda s: F.when(valid(s["d"]), of(s)).when(F.regexp_like(s["t"], F.lit("[ -]")), groups(s["t"])).otherwise(s["t"]))


def _number(text: Column, key: str, tag: str) -> Column:
    return _held({"p": permuted_digits(_digits(text), key, tag), "t": text}, lambda s: _laid_into(s["t"], s["p"]))


def _phone(text: Column, key: str) -> Column:
    def of(s):
        national = F.startswith(s["t"], F.lit("+1")) & (F.length(s["d"]) == 11)
        own = F.when(national, F.substr(s["d"], F.lit(2))).otherwise(s["d"])
        return _held({"p": permuted_digits(own, key, "phone"), "t": s["t"], "n": national}, lambda v: _laid_into(v["t"], F.concat(F.when(v["n"], "1").otherwise(""), v["p"])))
    return _held({"d": _digits(text), "t": text}, of)


#: Days from 1800-01-01 to 2199-12-31: 27 * 5411.
DAY_HIGH, DAY_LOW, DAY_ZERO = 27, 5411, "1800-01-01"


#: (what tells the form, how it is read, how it is written, how it is written where the day or month has one digit)
_FORMS = ((r"^\d{4}-", "yyyy-M-d", "yyyy-MM-dd", "yyyy-M-d"), (r"^\d{4}/", "yyyy/M/d", "yyyy/MM/dd", "yyyy/M/d"), (r"\.", "d.M.yyyy", "dd.MM.yyyy", "d.M.yyyy"), (r"/", "M/d/yyyy", "MM/dd/yyyy", "M/d/yyyy"))


def _date(text: Column, key: str) -> Column:
    def pick(at: int) -> Column:
        out = F.lit(_FORMS[-1][at])
        for form in _FORMS[-2::-1]:
            out = F.when(F.regexp_like(text, F.lit(form[0])), F.lit(form[at])).otherwise(out)
        return out

    def moved(s):
        n = s["n"]
        return _held({"p": _feistel(F.floor(n / DAY_LOW), F.pmod(n, F.lit(DAY_LOW)), F.lit(DAY_HIGH), F.lit(DAY_LOW), key, F.lit("date")), "t": s["t"], "f": s["f"]},
                     lambda v: F.call_function("date_format", F.date_add(F.lit(DAY_ZERO).cast("date"), (v["p"]["h"] * DAY_LOW + v["p"]["l"]).cast("int")), v["f"]))

    n = F.datediff(F.try_to_timestamp(text, pick(1)).cast("date"), F.lit(DAY_ZERO).cast("date"))
    form = F.when(F.regexp_like(text, F.lit(r"(?<!\d)\d(?!\d)")), pick(3)).otherwise(pick(2))
    return _held({"n": n, "t": text, "f": form}, lambda s: F.when(s["n"].isNull(), s["t"]).otherwise(moved(s)))


def _ip(text: Column, key: str) -> Column:
    def of(s):
        part = lambda i: F.get(s["p"], F.lit(i)).cast("long")
        return F.struct((part(0) * 256 + part(1)).alias("h"), (part(2) * 256 + part(3)).alias("l"))
    moved = lambda v: _feistel(v["s"]["h"], v["s"]["l"], F.lit(65536), F.lit(65536), key, F.lit("ip"))
    state = _held({"s": _held({"p": F.split(text, r"\.")}, of)}, moved)
    return _held({"s": state}, lambda s: F.concat_ws(".", F.shiftright(s["s"]["h"], 8), s["s"]["h"] % 256, F.shiftright(s["s"]["l"], 8), s["s"]["l"] % 256))


def _ip6(text: Column, key: str) -> Column:
    hexed = F.lower(F.regexp_replace(text, "[^0-9A-Fa-f]", ""))
    return _held({"p": permuted_text(hexed, key, "ip6"), "t": text}, lambda s: _laid_into(s["t"], s["p"], "[0-9A-Fa-f]"))


def _mod97(text: Column) -> Column:
    """The IBAN remainder of a string of digits and capitals."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("long")).otherwise(F.ascii(c).cast("long") - 55)
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda a, c: F.pmod(F.when(c == "", a).otherwise(a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)), F.lit(97)))


def _iban(text: Column, key: str) -> Column:
    def of(s):
        body = F.substr(s["c"], F.lit(5))
        new = _held({"b": body, "d": permuted_digits(_digits(body), key, "iban")}, lambda v: _laid_into(v["b"], v["d"]))
        whole = _held({"n": new, "c": s["c"]}, lambda v: F.concat(F.substr(v["c"], F.lit(1), F.lit(2)), F.lpad((98 - _mod97(F.concat(v["n"], F.substr(v["c"], F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0"), v["n"]))
        return _held({"w": whole, "t": s["t"]}, lambda v: _laid_into(v["t"], _digits(v["w"])))
    valid = lambda s: (F.length(_digits(F.substr(s["c"], F.lit(5)))).between(1, 30)) & (_mod97(F.concat(F.substr(s["c"], F.lit(5)), F.substr(s["c"], F.lit(1), F.lit(4)))) == 1)
    return _held({"c": F.replace(text, F.lit(" "), F.lit("")), "t": text}, lambda s: F.when(valid(s), of(s)).otherwise(s["t"]))


HEX = "0123456789abcdef"


def permuted_text(value: Column, key: str, tag: str) -> Column:
    """As many characters, permuted: hexadecimal digits if all are, else letters for letters and digits for digits of the
    same kind; signs stay. The halves are shifted in turn by a stream made of the digest of the other half. A value with
    other letters that would become hexadecimal digits alone is permuted again, so that it meets no value of that format."""
    hexed = lambda v: F.regexp_like(v, F.lit("^[0-9a-f]+$"))

    def again(v):
        return F.aggregate(F.sequence(F.lit(1), F.lit(64)), v["v"], lambda a, i: F.when((i == 1) | (hexed(a) & ~v["x"]), _shuffled(a, v["x"], key, tag)).otherwise(a))

    return _held({"v": value, "x": hexed(value)}, again)


def _within_block(c: Column, byte: Column) -> Column:
    """A character other than ASCII, moved among the 64 that differ from it in the last byte of their UTF-8 alone."""
    coded = F.hex(c)
    last = F.conv(F.right(coded, F.lit(2)), 16, 10).cast("int")
    return F.decode(F.unhex(F.concat(F.substr(coded, F.lit(1), F.length(coded) - 2), F.hex(128 + (last - 128 + byte) % 64))), "UTF-8")


def _shuffled(value: Column, hexed: Column, key: str, tag: str) -> Column:
    def shifted(half: Column, other: Column, hexed: Column, r: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), r.cast("string"), F.lower(F.array_join(other, ""))), 256)
        def by_stream(s):
            def put(c, i):
                byte = F.conv(F.substr(F.get(s["stream"], F.floor(i / 32).cast("int")), i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
                moved = lambda first, n: F.chr((F.lit(ord(first)) + (F.ascii(c) - ord(first) + byte) % n).cast("long"))
                in_hex = F.substr(F.lit(HEX), (F.instr(F.lit(HEX), c) - 1 + byte) % 16 + 1, F.lit(1))
                return F.when(s["x"], in_hex).when(c.between("0", "9"), moved("0", 10)).when(c.between("A", "Z"), moved("A", 26)).when(c.between("a", "z"), moved("a", 26)).when(F.octet_length(c) > 1, _within_block(c, byte)).otherwise(c)
            return F.transform(s["half"], put)
        stream = lambda s: _held({"stream": F.transform(F.sequence(F.lit(0), F.floor(F.size(s["half"]) / 32).cast("int")), lambda b: F.sha2(F.concat(s["seed"], b.cast("string")), 256)), "half": s["half"], "x": s["x"]}, by_stream)
        return _held({"seed": seed, "half": half, "x": hexed}, stream)

    def cut(s):
        h = F.floor(F.size(s["c"]) / 2).cast("int")
        return F.struct(F.slice(s["c"], F.lit(1), h).alias("half"), F.slice(s["c"], h + 1, F.size(s["c"])).alias("other"))

    # each round shifts one half and turns the halves about; their number is even, so the first half is first again
    first = _held({"c": F.filter(F.split(value, ""), lambda c: c != "")}, cut)
    last = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, lambda s, r: F.struct(s["other"].alias("half"), shifted(s["half"], s["other"], hexed, r).alias("other")))
    return _held({"s": last}, lambda v: F.concat(F.array_join(v["s"]["half"], ""), F.array_join(v["s"]["other"], "")))


def _email(text: Column, key: str) -> Column:
    return F.concat(permuted_text(F.substring_index(text, "@", 1), key, "mail"), F.lit("@"), permuted_text(F.substring_index(text, "@", -1), key, "host"), F.lit(".example"))


def _secret(text: Column, key: str) -> Column:
    value = r"[A-Za-z0-9+/_.~\-]{6,}+$"
    return _held({"v": F.regexp_extract(text, value, 0), "t": text}, lambda s: F.concat(F.substr(s["t"], F.lit(1), F.length(s["t"]) - F.length(s["v"])), permuted_text(s["v"], key, "secret")))


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, new) of a found value; ``new`` is the value itself where it fails its format's check."""
    start = lambda kind: F.regexp_like(value, F.lit(f"^(?:{PATTERNS[kind]})$"))
    made = {"email": _email(value, key), "secret": _secret(value, key), "iban": _iban(value, key), "ip": _ip(value, key), "ip6": _ip6(value, key), "date": _date(value, key),
            "ssn": _number(value, key, "ssn"), "phone": _phone(value, key), "card": _card(value, key)}
    out = F.struct(F.lit("none").alias("kind"), value.alias("new"))
    for kind in reversed(made):
        out = F.when(start(kind), F.struct(F.lit(kind).alias("kind"), made[kind].alias("new"))).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the found values of ``text_col`` replaced, and ``pii``: array of (kind, value pseudonym) in their order.

    ``key`` is the secret of the permutations; with the same key, equal values get equal pseudonyms in all tables.
    A null text stays null with an empty array; an empty text, and one without such values, stays as it is. All other
    columns and rows are kept; an empty table stays empty. A column named ``pii`` is replaced.
    """
    text = F.col(text_col)
    found = F.when(F.regexp_like(text, F.lit(r"[0-9@]|(?i:secret|token|passw|pwd|key|bearer)|::")), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    docs = docs.withColumn("pii", found)
    between = F.split(text, ANY)
    new = F.transform("pii", lambda v: pseudonym(v, key))
    docs = docs.withColumn("pii", F.when(F.size("pii") > 0, F.zip_with(new, "pii", lambda n, v: F.struct(n["kind"].alias("kind"), n["new"].alias("new"), (n["new"] != v).alias("changed")))))
    joined = F.array_join(F.zip_with(between, "pii", lambda t, n: F.concat(t, F.coalesce(n["new"], F.lit("")))), "")
    docs = docs.withColumn(text_col, F.when(F.col("pii").isNotNull(), joined).otherwise(text))
    kept = F.transform(F.filter("pii", lambda v: v["changed"]), lambda v: F.struct(v["kind"].alias("kind"), v["new"].alias("pseudonym")))
    return docs.withColumn("pii", F.coalesce(kept, F.array().cast("array<struct<kind:string,pseudonym:string>>")))
