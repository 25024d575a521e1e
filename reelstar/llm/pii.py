"""Pseudonyms for personal data by format-preserving Feistel permutations.

Values that pass their kind's check are replaced by other valid values of the
same format:

* card: 13 to 19 digits with a valid Luhn digit; all digits but the last are
  permuted, the last is worked out anew; account (only with ``accounts=True``, since
  nothing tells them from time stamps and counters): such numbers whose last digit is
  off, which stays off by as much;
* phone: international numbers, and U.S. ones with an area and an exchange from 200 on, in the forms
  (415) 555-2671, 415-555-2671 and 415.555.2671; the last ten digits, so that a number with and without
  its country code stays linked (the area of a pseudonym may start with 0 or 1);
* iban: account numbers with valid check digits (mod 97); digits and letters after them are permuted in
  their places, the check digits worked out anew, the country stays;
* ip6: IPv6 addresses, whole or with one "::" (and a digit somewhere), among all 2^128; written whole;
* ssn: U.S. numbers with a valid area, group and serial, among all valid ones;
* ip: dotted IPv4 addresses, among all 2^32;
* date: calendar dates from 1900-01-01 to 2100-01-01, among these days
  (2004-02-29, 02/29/2004 and 29.02.2004 forms);
* email: letters and digits of the local part; the domain stays;
* hex: secrets of 32 or more hexadecimal digits; those of decimal digits alone stay such.

A value is a number below a*b, held as two halves (l below a, r below b). In each
round a keyed hash of one half is added to the other, modulo its size: a
permutation of the format's values. The permutation depends on the key and the kind
only, so equal values get equal pseudonyms in all documents, whatever their
separators, and different values different ones.

The plan holds a digest of the key, not the key, and the session's ``spark.sql.redaction.string.regex``
is widened to hide that digest, too, where plans are explained.

Everything is a built-in SQL expression. ``let`` binds a part of an expression
to a name, so that each is worked out once for a value.

Defined results: a null text stays null with no finds; null ids and repeated rows
pass through, one row out for each row in; values that fail their check stay
as they are (with whatever else might stand inside); other columns are ignored here.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "ip", "ip6", "hex", "iban", "phone", "ssn", "date", "card")
#: What marks the digest of a key in a plan, for redaction.
KEY_MARK = "pseudonym-key-"
REDACTION = "spark.sql.redaction.string.regex"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What each kind looks like. Quantifiers before a required mark don't backtrack, so long runs cost linear time.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]{0,34}[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}"
           r"(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "hex": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?![0-9])"
             r"|(?<![0-9+.-])(?:\([2-9]\d\d\) ?|[2-9]\d\d[.-])[2-9]\d\d[.-]\d{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "date": r"(?<![0-9])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![0-9])",
    "card": r"(?<![0-9])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![0-9])",
}
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
#: The forms of a whole match, to tell kinds apart without the context.
FORMS = {
    "email": "@", "ip": rf"^{_OCTET}(?:\\.{_OCTET}){{3}}$", "ip6": ":", "iban": r"^[A-Z]{2}\\d{2}[0-9A-Z ]{8,}$",
    "phone": r"^\\+|^\\(?\\d{3}[).-] ?\\d{3}[.-]\\d{4}$", "ssn": r"^\\d{3}-\\d{2}-\\d{4}$",
    "date": r"^(?:\\d{4}-\\d{2}-\\d{2}|\\d{2}/\\d{2}/\\d{4}|\\d{2}[.]\\d{2}[.]\\d{4})$", "hex": "^[0-9A-Fa-f]{32,}$",
}
FORMS["ip"] = FORMS["ip"].replace(r"\d", r"\\d")
DIGITS, LETTERS, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
#: Symbols taken together as one number below 2^63.
CHUNK = {DIGITS: 18, LETTERS: 12, HEX: 14}
#: Days from 1900-01-01 to 2100-01-01, and the valid U.S. numbers, as a product of two sizes.
DAYS = (150, 487)
SSN = (898 * 99, 9999)


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def feistel(x: str, a: str, b: str, tweak: str, key: str) -> str:
    """The permutation of the numbers below a*b for a key and a tweak, at x."""
    def added(half: str) -> str:
        digest = f"sha2(concat_ws('|', '{key}', {tweak}, _i, {half}), 256)"
        return f"CAST(conv(substr({digest}, 1, 14), 16, 10) AS BIGINT)"
    rounds = (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', _x DIV _b, 'r', _x % _b), (_s, _i) -> "
              f"if(_i % 2 = 1, named_struct('l', pmod(_s.l + {added('_s.r')}, _a), 'r', _s.r), "
              f"named_struct('l', _s.l, 'r', pmod(_s.r + {added('_s.l')}, _b))), _s -> _s.l * _b + _s.r)")
    return let("_x", f"CAST({x} AS BIGINT)", let("_a", f"CAST({a} AS BIGINT)", let("_b", f"CAST({b} AS BIGINT)", rounds)))


def permuted(symbols: str, alphabet: str, kind: str, key: str) -> str:
    """A string over an alphabet, permuted among all of its length."""
    k, size = len(alphabet), CHUNK[alphabet]
    number = f"aggregate(split(_c, ''), 0L, (_t, _d) -> _t * {k} + locate(_d, '{alphabet}') - 1)"
    tweak = f"concat_ws(',', '{kind}', _j, length(_w))"
    moved = feistel(number, f"power({k}, length(_c) DIV 2)", f"power({k}, length(_c) - length(_c) DIV 2)", tweak, key)
    back = (f"aggregate(sequence(1, length(_c)), named_struct('o', '', 'v', _v), (_s, _i) -> named_struct("
            f"'o', concat(substr('{alphabet}', CAST(_s.v % {k} AS INT) + 1, 1), _s.o), 'v', _s.v DIV {k}), _s -> _s.o)")
    chunk = let("_c", f"substr(_w, _j * {size} + 1, {size})", let("_v", moved, back))
    whole = f"array_join(transform(sequence(0, (length(_w) - 1) DIV {size}), _j -> {chunk}), '')"
    return let("_w", symbols, f"if(length(_w) = 0, '', {whole})")


def refilled(form: str, digits: str, letters: str = "''") -> str:
    """``form`` with its digits and letters replaced in turn; case and marks stay."""
    step = ("CASE WHEN _h rlike '[0-9]' THEN named_struct('o', concat(_s.o, substr(_n, _s.d, 1)), 'd', _s.d + 1, 'l', _s.l) "
            "WHEN _h rlike '[a-z]' THEN named_struct('o', concat(_s.o, substr(_l, _s.l, 1)), 'd', _s.d, 'l', _s.l + 1) "
            "WHEN _h rlike '[A-Z]' THEN named_struct('o', concat(_s.o, upper(substr(_l, _s.l, 1))), 'd', _s.d, 'l', _s.l + 1) "
            "ELSE named_struct('o', concat(_s.o, _h), 'd', _s.d, 'l', _s.l) END")
    return let("_n", digits, let("_l", letters,
               f"aggregate(split({form}, ''), named_struct('o', '', 'd', 1, 'l', 1), (_s, _h) -> {step}, _s -> _s.o)"))


def _only(kind: str, value: str) -> str:
    return f"regexp_replace({value}, '[^{kind}]', '')"


def luhn_sum(digits: str, doubled_first: int) -> str:
    """Sum of the Luhn digits from the right; every second is doubled, the
    first from the right if ``doubled_first`` is 1."""
    d = f"CAST(substr({digits}, length({digits}) - _p + 1, 1) AS INT)"
    return (f"aggregate(sequence(1, length({digits})), 0, (_t, _p) -> _t + "
            f"if(_p % 2 = {doubled_first}, {d} * 2 - if({d} > 4, 9, 0), {d}))")


def _replacement(kind: str, key: str) -> str:
    """SQL for the pseudonym of a match ``m`` of a kind; NULL if its check fails."""
    digits = _only("0-9", "m")
    if kind == "email":
        local = "substring_index(m, '@', 1)"
        moved = refilled("_q", permuted(_only("0-9", "_q"), DIGITS, "email-d", key),
                         permuted(f"lower({_only('A-Za-z', '_q')})", LETTERS, "email-l", key))
        return f"concat({let('_q', local, moved)}, '@', substring_index(m, '@', -1))"
    if kind == "ip":
        number = "aggregate(split(m, '[.]'), 0L, (_t, _d) -> _t * 256 + CAST(_d AS BIGINT))"
        parts = ", ".join(f"shiftright(_v, {s}) % 256" for s in (24, 16, 8, 0))
        return let("_v", feistel(number, "65536", "65536", "'ip'", key), f"concat_ws('.', {parts})")
    if kind == "hex":
        moved = permuted("lower(m)", HEX, "hex", key)
        return f"CASE WHEN NOT m rlike '[A-Fa-f]' THEN {permuted('m', DIGITS, 'hex-d', key)} WHEN m rlike '[A-F]' THEN upper({moved}) ELSE {moved} END"
    if kind == "ip6":
        # the groups that "::" stands for, then all eight with their zeros
        groups = lambda part: f"filter(split({part}, ':'), _g -> _g <> '')"
        left, right = groups("split_part(lower(m), '::', 1)"), groups("split_part(lower(m), '::', 2)")
        zeros = "array_repeat('0', 8 - size(_l) - size(_r))"
        digits = f"array_join(transform(concat(_l, {zeros}, _r), _g -> lpad(_g, 4, '0')), '')"
        written = "array_join(transform(sequence(0, 7), _p -> regexp_replace(substr(_v, _p * 4 + 1, 4), '^0{1,3}', '')), ':')"
        fits = "size(_l) + size(_r) <= if(m LIKE '%::%', 7, 8)"
        moved = let("_v", permuted(digits, HEX, "ip6", key), f"if(m rlike '[A-F]', upper({written}), {written})")
        return let("_l", left, let("_r", right, f"if({fits}, {moved}, NULL)"))
    if kind == "iban":
        # both as one number: letters count from 10, country and check digits last
        rest = lambda text: (f"aggregate(split({text}, ''), 0, (_t, _d) -> if(_d rlike '[0-9]', "  # noqa: E731
                             "_t * 10 + CAST(_d AS INT), _t * 100 + ascii(_d) - 55) % 97)")
        digits_of, letters_of = _only("0-9", "_b"), f"lower({_only('A-Z', '_b')})"
        moved = refilled("_b", permuted(digits_of, DIGITS, "iban-d", key), permuted(letters_of, LETTERS, "iban-l", key))
        unchecked = "concat(_u, left(_z, 2), '00')"
        check = f"lpad(CAST(98 - {rest(unchecked)} AS STRING), 2, '0')"
        whole = f"concat(left(_z, 2), {check}, _u)"
        back = let("_q", whole, refilled("m", _only("0-9", "_q"), f"lower({_only('A-Z', '_q')})"))
        valid = f"length(_z) BETWEEN 15 AND 34 AND {rest('concat(substr(_z, 5), left(_z, 4))')} = 1"
        inner = let("_b", "substr(_z, 5)", let("_u", moved, back))
        return let("_z", "replace(m, ' ', '')", f"if({valid}, {inner}, NULL)")
    if kind == "phone":
        # the country code is what stands before the last ten digits
        return let("_z", digits, refilled("m", f"concat(substr(_z, 1, length(_z) - 10), {permuted('right(_z, 10)', DIGITS, 'phone', key)})"))
    if kind == "ssn":
        a, g, s = (f"CAST(substr(_z, {i}, {n}) AS BIGINT)" for i, n in ((1, 3), (4, 2), (6, 4)))
        valid = f"{a} BETWEEN 1 AND 899 AND {a} <> 666 AND {g} > 0 AND {s} > 0"
        number = f"(({a} - if({a} > 666, 2, 1)) * 99 + {g} - 1) * 9999 + {s} - 1"
        area = "_v DIV (99 * 9999) + 1"
        back = (f"concat_ws('-', lpad(CAST({area} + if({area} >= 666, 1, 0) AS STRING), 3, '0'), "
                "lpad(CAST(_v DIV 9999 % 99 + 1 AS STRING), 2, '0'), lpad(CAST(_v % 9999 + 1 AS STRING), 4, '0'))")
        return let("_z", digits, f"if({valid}, {let('_v', feistel(number, str(SSN[0]), str(SSN[1]), chr(39) + 'ssn' + chr(39), key), back)}, NULL)")
    if kind == "date":
        form = "CASE WHEN m LIKE '%-%' THEN 'yyyy-MM-dd' WHEN m LIKE '%/%' THEN 'MM/dd/yyyy' ELSE 'dd.MM.yyyy' END"
        out = ("CASE WHEN m LIKE '%-%' THEN date_format(_v, 'yyyy-MM-dd') WHEN m LIKE '%/%' THEN date_format(_v, 'MM/dd/yyyy') "
               "ELSE date_format(_v, 'dd.MM.yyyy') END")
        moved = feistel("_n", str(DAYS[0]), str(DAYS[1]), "'date'", key)
        day = let("_v", f"date_add(DATE'1900-01-01', CAST({moved} AS INT))", out)
        count = f"datediff(CAST(try_to_timestamp(m, {form}) AS DATE), DATE'1900-01-01')"
        return let("_n", count, f"if(_n BETWEEN 0 AND {DAYS[0] * DAYS[1] - 1}, {day}, NULL)")
    moved = permuted("substr(_z, 1, length(_z) - 1)", DIGITS, "card", key)
    check = f"CAST(pmod({luhn_sum('_z', 0)} - {luhn_sum('_y', 1)}, 10) AS STRING)"
    return let("_z", digits, refilled("m", let("_y", moved, f"concat(_y, {check})")))


def _hidden(spark: SparkSession, key: str) -> str:
    """What stands for a key in plans; explained plans don't show it."""
    pattern = f"{KEY_MARK}[0-9a-f]{{64}}"
    before = spark.conf.get(REDACTION, None)
    if pattern not in (before or ""):
        spark.conf.set(REDACTION, f"{before}|{pattern}" if before else pattern)
    return KEY_MARK + hashlib.sha256(key.encode()).hexdigest()


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                 accounts: bool = False) -> DataFrame:
    """``(id, text, n_replaced, kinds)``: the text with pseudonyms, how many, and
    the kind of each in order of occurrence. ``accounts`` also replaces numbers of 13 to 19 digits that
    nothing validates."""
    if not key or not key.isalnum():
        raise ValueError("the key is a string of letters and digits")
    key = _hidden(docs.sparkSession, key)
    number = let("_z", _only("0-9", "m"), f"if({luhn_sum('_z', 0)} % 10 = 0, 'card', '{'account' if accounts else 'number'}')")
    kind = "CASE " + " ".join(f"WHEN m rlike '{FORMS[k]}' THEN '{k}'" for k in FORMS) + f" ELSE {number} END"
    new = ("CASE _k " + " ".join(f"WHEN '{k}' THEN {_replacement(k, key)}" for k in FORMS)
           + f" WHEN 'number' THEN NULL ELSE {_replacement('card', key)} END")
    replaced = f"transform(_m, m -> {let('_k', kind, f'named_struct({chr(39)}kind{chr(39)}, _k, {chr(39)}old{chr(39)}, m, {chr(39)}new{chr(39)}, {new})')})"
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    # texts without a digit or an @ hold nothing and skip the search
    found = rows.withColumn("_m", F.when(F.col("_t").rlike("[0-9@]"), F.regexp_extract_all("_t", F.lit(ANY), F.lit(0))))
    found = found.withColumn("_f", F.expr(f"if(size(_m) > 0, {replaced}, NULL)"))
    pieces = F.split("_t", ANY, -1)
    joined = F.array_join(F.zip_with(pieces, "_f", lambda p, f: F.concat(p, F.coalesce(f["new"], f["old"], F.lit("")))), "")
    hits = F.filter("_f", lambda f: f["new"].isNotNull())
    return found.select(
        F.col("_id").alias(id_col), F.when(F.col("_f").isNull(), F.col("_t")).otherwise(joined).alias("text"),
        F.coalesce(F.size(hits), F.lit(0)).cast("long").alias("n_replaced"),
        F.coalesce(F.transform(hits, lambda f: f["kind"]), F.array().cast("array<string>")).alias("kinds"))
