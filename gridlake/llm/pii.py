"""Format-preserving pseudonyms for personal data, with SQL expressions only.

One regular expression finds all values, from every place on where one may begin; going through them in
order, each that validates is replaced where it stands, and one that begins inside a replaced value
or does not validate stays. Numbers and dates are validated and then permuted within their own format
by a keyed Feistel network over ``Z_a x Z_b``: each round adds a keyed hash of one half to the other
half, which is a permutation of all pairs, so distinct values stay distinct and equal values stay
linked across documents. Card numbers and account numbers get new check digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import free_name

ROUNDS = 10
KEY_SETTING = "spark.gridlake.pii.key"

_OPEN, _CLOSE = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
SECRET = (
    _OPEN + r"(?i:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd)[\x22']? ?[:=] ?[\x22']?[A-Za-z0-9_/+.-]{8,}"
)
#: Length of the account numbers of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    """An account number of ``length`` characters, in one piece or in groups of four."""
    groups, rest = divmod(length - 4, 4)
    last = f" [A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{last})" + _CLOSE


#: The length of the country first; any length for what is none of these.
IBAN = (
    _OPEN + r"(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _CLOSE + ")"
)
IPV4 = r"(?<![\p{L}\p{N}.])" + rf"{_OCTET}(?:\.{_OCTET}){{3}}" + r"(?![\p{L}\p{N}]|\.[0-9])"
DATE = _OPEN + r"(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})" + _CLOSE
SSN = _OPEN + r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}" + _CLOSE
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _CLOSE
)
CARD = (
    _OPEN + r"(?:[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})" + _CLOSE
)
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "ipv4": IPV4, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(KINDS.values())
MAYBE = "[0-9@=:]"  # a text without any of these has no match
#: 1900-01-01 to 2099-12-31 has 73049 days, 17 times 4297.
DAYS, DAYS_A, DAYS_B = 73049, 17, 4297
#: 44249 of them are later than the 12th of a month, which is 61 fewer than 211 times 210.
LATE, LATE_A, LATE_B = 44249, 211, 210
GROUP = 128  # pieces that are joined at once


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(a: str, b: str, left: str, right: str, tweak: str, key: str) -> str:
    """SQL of ``struct<l, r>``: ``(left, right)`` of ``Z_a x Z_b`` permuted under ``key`` and ``tweak``."""

    def keyed(half: str) -> str:
        said = f"concat_ws('|', {_quoted(key)}, {tweak}, i, {half})"
        return f"CAST(conv(substr(sha2({said}, 256), 1, 15), 16, 10) AS BIGINT)"

    return f"""aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)),
        (s, i) -> IF(i % 2 = 0,
            named_struct('l', pmod(s.l + pmod({keyed('s.r')}, {a}), {a}), 'r', s.r),
            named_struct('l', s.l, 'r', pmod(s.r + pmod({keyed('s.l')}, {b}), {b}))))"""


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _power(n: str) -> str:
    return f"CAST(rpad('1', CAST({n} AS INT) + 1, '0') AS BIGINT)"


def permuted_digits(digits: str, kind: str, key: str) -> str:
    """SQL: a string of 2 to 18 digits as another one of its length."""
    half = f"(length({digits}) DIV 2)"
    rest = f"(length({digits}) - {half})"
    tweak = f"concat('{kind}', length({digits}))"
    pair = feistel(_power(half), _power(rest), f"substr({digits}, 1, {half})", f"substr({digits}, {half} + 1)", tweak, key)
    return _let("p", pair, f"concat(lpad(p.l, CAST({half} AS INT), '0'), lpad(p.r, CAST({rest} AS INT), '0'))")


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _restored(value: str, digits: str) -> str:
    """SQL: ``value`` with its digits replaced, in order, by ``digits``."""
    nth = f"length(regexp_replace(substr({value}, 1, k), '[^0-9]', ''))"
    char = f"substr({value}, k, 1)"
    return f"array_join(transform(sequence(1, length({value})), k -> IF({char} BETWEEN '0' AND '9', substr({digits}, {nth}, 1), {char})), '')"


def luhn_digit(payload: str) -> str:
    """SQL: the check digit of a string of digits."""
    digit = f"CAST(substr({payload}, length({payload}) + 1 - k, 1) AS INT)"
    doubled = f"IF(k % 2 = 0, {digit}, IF({digit} > 4, 2 * {digit} - 9, 2 * {digit}))"
    return f"CAST(pmod(-aggregate(sequence(1, length({payload})), 0, (z, k) -> z + {doubled}), 10) AS STRING)"


def iban_digits(country: str, rest: str) -> str:
    """SQL: the two check digits of an account number."""
    char = "substr(w, k, 1)"
    value = f"IF({char} BETWEEN '0' AND '9', CAST({char} AS INT), ascii({char}) - 55)"
    left = f"aggregate(sequence(1, length(w)), 0, (z, k) -> (z * IF({value} > 9, 100, 10) + {value}) % 97)"
    return _let("w", f"concat({rest}, {country}, '00')", f"lpad(CAST(98 - {left} AS STRING), 2, '0')")


def _email(m: str, key: str) -> str:
    return f"concat('u', substr(sha2(concat_ws('|', {_quoted(key)}, 'email', lower({m})), 256), 1, 16), '@example.com')"


def _secret(m: str, key: str) -> str:
    """The value after the sign, character by character: hex digits by the keyed hash of the whole value."""
    value = f"regexp_extract({m}, '([A-Za-z0-9_/+.-]{{8,}})$', 1)"
    drawn = f"substr(sha2(concat_ws('|', {_quoted(key)}, 'secret', (k - 1) DIV 64, v), 256), 1 + (k - 1) % 64, 1)"
    cased = f"IF(rlike(v, '[a-z]'), {drawn}, upper({drawn}))"
    made = f"array_join(transform(sequence(1, length(v)), k -> {cased}), '')"
    return _let("v", value, f"concat(substr({m}, 1, length({m}) - length(v)), {made})")


def _ipv4(m: str, key: str) -> str:
    octet = [f"CAST(split({m}, '[.]')[{i}] AS INT)" for i in range(4)]
    pair = feistel("65536L", "65536L", f"{octet[0]} * 256 + {octet[1]}", f"{octet[2]} * 256 + {octet[3]}", "'ipv4'", key)
    return _let("p", pair, "concat_ws('.', p.l DIV 256, p.l % 256, p.r DIV 256, p.r % 256)")


def _date(m: str, key: str) -> str:
    """Days of 1900 to 2099; a date that does not exist stays.

    With slashes the month comes first where that makes a date; a day above 12 that comes first is
    permuted among its like, so no two strings become one.
    """
    fmt = f"CASE WHEN {m} LIKE '____-%' THEN 'yyyy-MM-dd' WHEN {m} LIKE '__/%' THEN 'MM/dd/yyyy' ELSE 'dd.MM.yyyy' END"
    day = f"CAST(try_to_timestamp({m}, g) AS DATE)"
    n = f"datediff(d, DATE'1900-01-01')"
    pair = feistel(f"{DAYS_A}L", f"{DAYS_B}L", f"{n} DIV {DAYS_B}", f"{n} % {DAYS_B}", "'date'", key)
    new = _let("p", pair, f"date_format(date_add(DATE'1900-01-01', CAST(p.l * {DAYS_B} + p.r AS INT)), g)")
    tried = _let("g", fmt, _let("d", day, f"IF(d IS NULL, NULL, {new})"))
    other = _let("d", f"CAST(try_to_timestamp({m}, 'dd/MM/yyyy') AS DATE)", f"IF(d IS NULL, {m}, {_late_date('d', key)})")
    return f"coalesce({tried}, IF({m} LIKE '__/%', {other}, {m}))"


def _late_date(d: str, key: str) -> str:
    """SQL: a date later than the 12th of its month as another one, day first.

    The permutation of ``LATE_A * LATE_B`` numbers is repeated until it is back below ``LATE``; numbers above
    are passed at most once each, so the number of repetitions is bounded.
    """

    def once(n: str) -> str:
        pair = feistel(f"{LATE_A}L", f"{LATE_B}L", f"{n} DIV {LATE_B}", f"{n} % {LATE_B}", "'late date'", key)
        return _let("p", pair, f"p.l * {LATE_B} + p.r")

    def first(month: str) -> str:  # late dates before a month
        return f"(datediff(add_months(DATE'1900-01-01', {month}), DATE'1900-01-01') - 12 * ({month}))"

    n = f"CAST(datediff({d}, DATE'1900-01-01') - 12 * ((year({d}) - 1900) * 12 + month({d})) AS BIGINT)"
    walked = f"aggregate(sequence(1, {LATE_A * LATE_B - LATE}), {once('x')}, (w, j) -> IF(w < {LATE}, w, {once('w')}))"
    month = f"h - IF({first('h')} > r, 1, 0) - IF({first('h - 1')} > r, 1, 0)"  # h is right or at most two too large
    made = f"date_format(date_add(add_months(DATE'1900-01-01', y), CAST(12 + r - {first('y')} AS INT)), 'dd/MM/yyyy')"
    found = _let("h", f"CAST(floor(r * 2400D / {LATE}D) AS INT) + 1", _let("y", month, made))
    return _let("x", n, _let("r", walked, found))


def _ssn(m: str, key: str) -> str:
    """898 areas (none of 000, 666, 900 and more), 99 groups, 9999 serial numbers."""
    area = f"CAST(substr({m}, 1, 3) AS INT)"
    pair = feistel("898L", "989901L", f"{area} - IF({area} > 666, 2, 1)", f"(CAST(substr({m}, 5, 2) AS INT) - 1) * 9999 + CAST(substr({m}, 8) AS INT) - 1", "'ssn'", key)
    new = "concat(lpad(p.l + IF(p.l > 664, 2, 1), 3, '0'), '-', lpad(p.r DIV 9999 + 1, 2, '0'), '-', lpad(p.r % 9999 + 1, 4, '0'))"
    return _let("p", pair, new)


def _phone(m: str, key: str) -> str:
    """The last ten digits; what is before them (the country) stays."""
    new = f"concat(substr(v, 1, greatest(length(v) - 10, 0)), {_let('t', 'right(v, 10)', permuted_digits('t', 'phone', key))})"
    return _let("v", _digits(m), _let("n", new, _restored(m, "n")))


def _card(m: str, key: str) -> str:
    """Only where the check digit is right; the new number has a right one too."""
    payload = "substr(v, 1, length(v) - 1)"
    new = _let("q", permuted_digits("t", "card", key), f"concat(q, {luhn_digit('q')})")
    made = _let("n", new, _restored(m, "n"))
    return _let("v", _digits(m), _let("t", payload, f"IF(right(v, 1) = {luhn_digit('t')}, {made}, {m})"))


def _iban(m: str, key: str) -> str:
    """Digits after the check digits move, letters stay; only where the check digits are right."""
    old = "substr(v, 5)"
    digits = _digits(old)
    moved = _let("t", f"right({digits}, 18)", permuted_digits("t", "iban", key))
    body = _let("n", f"concat(substr({digits}, 1, greatest(length({digits}) - 18, 0)), {moved})", _restored(old, "n"))
    solid = _let("b", body, f"concat(substr(v, 1, 2), {iban_digits('substr(v, 1, 2)', 'b')}, b)")
    spaced = f"IF(instr({m}, ' ') = 0, u, rtrim(regexp_replace(u, '(.{{4}})', '$1 ')))"
    right_ = f"substr(v, 3, 2) = {iban_digits('substr(v, 1, 2)', old)} AND length({digits}) > 1"
    return _let("v", f"replace({m}, ' ', '')", f"IF({right_}, {_let('u', solid, spaced)}, {m})")


def pseudonym(m: str, key: str) -> str:
    """SQL: the pseudonym of one match; a number or date that does not validate stays as it is."""
    makers = {"email": _email, "secret": _secret, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    cases = " ".join(f"WHEN rlike({m}, {_quoted(f'^(?:{KINDS[k]})$')}) THEN {makers[k](m, key)}" for k in KINDS)
    return f"CASE {cases} ELSE {m} END"


def pseudonymise(docs: DataFrame, text: str = "text", key: str | None = None, found: str = "n_replaced") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and in ``found`` the number of values replaced.

    ``key`` is by default the session's setting ``KEY_SETTING``; there is none built in. Whoever has it can
    turn numbers and dates back. It stands in the expressions, so set ``spark.sql.redaction.string.regex`` to a
    pattern that it matches where plans are shown to others.

    A null text stays null with 0 values; an empty text and an empty table stay empty; repeated rows are treated
    alike. All other columns are kept; one that is called ``found`` is replaced. No shuffle: each text is
    read once and written once, in time about in proportion to its matches.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"pseudonyms need a key: give one, or set {KEY_SETTING}")
    c = f"`{text}`"
    # a line break in front, so that no value begins at 0, where split would leave out the empty piece
    led, ahead = f"concat('\\n', {c})", f"(?=({ANY}))"
    pieces = f"split({led}, {_quoted(ahead)}, -1)"
    matches = f"concat(array(CAST(NULL AS STRING)), regexp_extract_all({led}, {_quoted(ahead)}, 1))"
    zipped = f"""zip_with({pieces}, {matches}, (w, m) -> named_struct('w', w, 'm', m, 'n', IF(m IS NULL, '', {pseudonym('m', key)})))"""
    # each piece begins with its match, which may reach into the next pieces: ``over`` counts what of it is left there
    step = """CASE WHEN s.over > 0 THEN named_struct('over', greatest(s.over - length(x.w), 0), 'n', s.n,
            'of', concat(s.of, array(substr(x.w, s.over + 1))))
        WHEN x.m IS NULL OR x.m = x.n THEN named_struct('over', 0, 'n', s.n, 'of', concat(s.of, array(x.w)))
        ELSE named_struct('over', greatest(length(x.m) - length(x.w), 0), 'n', s.n + 1L,
            'of', concat(s.of, array(x.n, substr(x.w, length(x.m) + 1)))) END"""
    start = "named_struct('over', 0, 'n', 0L, 'of', CAST(array() AS ARRAY<STRING>))"
    # groups of pieces are joined one by one: an array that grows with the text would be copied for every piece
    begun = "named_struct('over', t.over, 'n', t.n, 'of', CAST(array() AS ARRAY<STRING>))"
    group = f"aggregate(slice(z, CAST(k * {GROUP} + 1 AS INT), {GROUP}), {begun}, (s, x) -> {step})"
    joined = _let("u", group, "named_struct('over', u.over, 'n', u.n, 'of', concat(t.of, array(array_join(u.of, ''))))")
    done = f"""aggregate(sequence(0, (size(z) - 1) DIV {GROUP}), {start}, (t, k) -> {joined},
        t -> named_struct('text', substr(array_join(t.of, ''), 2), 'n', t.n))"""
    done = _let("z", zipped, done)
    whole = f"named_struct('text', {c}, 'n', 0L)"
    own = free_name("_pii_cut", [*docs.columns, found])
    cut = docs.withColumn(own, F.expr(f"IF(rlike({c}, '{MAYBE}'), {done}, {whole})"))
    made = cut.withColumn(text, F.when(F.col(text).isNotNull(), F.col(f"{own}.text")))
    count = F.when(F.col(f"{own}.text").isNull(), F.lit(0)).otherwise(F.col(f"{own}.n"))
    return made.withColumn(found, count.cast("long")).drop(own)
