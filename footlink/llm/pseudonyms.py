"""Format-preserving pseudonyms for personal data.

Card numbers (Luhn), IPv4 addresses, IBANs (mod 97), telephone numbers,
social security numbers and calendar dates are found, validated, and
replaced by a keyed Feistel permutation of all values of the same format; e-mail
addresses, access keys and assigned secrets are permuted letter for letter and
digit for digit. The replacement is valid in its format again, always differs
from the value, and depends on the key and the value alone: equal values stay
linked across documents, and the key holder can invert it.

What stays: punctuation and spacing, a card's first digit, a telephone
number's country code (by the table of calling codes, so spacing does not
matter) and trunk zero, an IBAN's country and letter case, the last two labels
of an e-mail domain, the century range 1900-2099 of dates and the width of
their days and months. ``recover`` gives the values back.

The key is ``spark.footlink.pseudonymKey`` of the session, if set.

Edge cases: a null text stays null, an empty one empty; where a match took
words or numbers that follow, shorter ends are tried; long secrets are permuted
in chained blocks of 256 characters, in time linear in their length; numbers that fail
validation at every end stay as they are; rows repeat as they come; columns other than
``text`` and ``n_chars`` pass through untouched.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm.feistel import replace
from footlink.llm.frames import map_batches, table

#: For tests and samples; a production run sets its own secret in the session.
DEFAULT_KEY = b"footlink pseudonym key"
KEY_CONF = "spark.footlink.pseudonymKey"

BLOCK = 256

KINDS = ["email", "iban", "card", "ip", "phone", "ssn", "date", "secret"]

# Every finding starts at a word or at a run of digits.
PATTERN = re.compile(r"""
 (?:(?<![A-Za-z0-9])|(?<!\d)(?=\d))(?:
  (?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
 |(?P<secret>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])
   |(?<![A-Za-z0-9])(?:sk|pk|ghp|gho|xox[bap])[-_][A-Za-z0-9_-]{16,}
   |(?<=[=:\s"'])(?<![A-Za-z0-9])[0-9a-fA-F]{32,}(?![A-Za-z0-9]))
 |(?P<assign>(?i:\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?)
   )(?P<value>[A-Za-z0-9_+/.-]{6,}={0,2})
 |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])
   |(?<![A-Za-z0-9])[a-z]{2}\d{2}(?:[ ]?[a-z0-9]{4}){2,7}(?:[ ]?[a-z0-9]{1,3})?(?![A-Za-z0-9]))
 |(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d))
 |(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
 |(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))
 |(?P<phone>(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)
   |(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)
   |(?<![\w+])(?:\(\d{3}\)[ ]?|\d{3}[-.])\d{3}[-.]\d{4}(?!\d))
 |(?P<card>(?<!\d)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,3}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}
   |\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d))
 )""", re.VERBOSE)

# Characters at which a finding that took too much can end sooner.
_BORDERS = {"iban": " ", "card": " -", "phone": " .-"}

_IBAN_LENGTHS = {int(n): c.split() for n, c in (x.split(":") for x in (
    "15:NO", "16:BE", "18:DK FI FO GL NL SD FK", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV",
    "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ DZ ES MD PK RO SA SE SK TN VG",
    "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB NI PL SV",
    "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "33:RU"))}
IBAN_LENGTH = {country: n for n, some in _IBAN_LENGTHS.items() for country in some}

# Calling codes of one and two digits; all others have three.
CALLING_CODES = {*"1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98".split()}

_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _DAY0 + 1
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def luhn_sum(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _alphabet(c: str) -> str:
    if c.isascii():
        for a in ("0123456789", _LOWER, _UPPER):
            if c in a:
                return a
    return c


def _shuffle_block(text: str, key: bytes, tweak: bytes, alphabets: list[str], inverse: bool) -> str:
    n, x = 1, 0
    for a, c in zip(alphabets, text, strict=True):
        n, x = n * len(a), x * len(a) + a.index(c)
    tweak += bytes(ord(a[0]) & 127 for a in alphabets)
    if len(tweak) > 1000:
        tweak = hashlib.blake2b(tweak).digest()
    y = replace(x, n, key, tweak, inverse) if n > 1 else x
    out = []
    for a in reversed(alphabets):
        y, d = divmod(y, len(a))
        out.append(a[d])
    return "".join(reversed(out))


def shuffle_characters(text: str, key: bytes, tweak: bytes, alphabet=_alphabet, inverse: bool = False) -> str:
    """Permute all texts of the same shape (digits, small letters, capitals
    in the same places); characters outside those stay. Beyond ``BLOCK``
    characters each block's permutation depends on the plain text before it."""
    out = []
    for at in range(0, max(len(text), 1), BLOCK):
        block = text[at:at + BLOCK]
        new = _shuffle_block(block, key, tweak, [alphabet(c) for c in block], inverse)
        out.append(new)
        tweak = b"block" + hashlib.blake2b(tweak + (new if inverse else block).encode()).digest()
    return "".join(out)


def _card(text: str, key: bytes, inverse: bool = False) -> str | None:
    digits = _digits(text)
    if luhn_sum(digits) or len(set(digits)) == 1:
        return None
    body = digits[1:-1]
    new = digits[0] + str(replace(int(body), 10 ** len(body), key, b"card%d" % len(digits), inverse)).zfill(len(body))
    return _refill(text, new + str((10 - luhn_sum(new + "0")) % 10))


def _ip(text: str, key: bytes, inverse: bool = False) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    x = replace(int.from_bytes(bytes(parts), "big"), 1 << 32, key, b"ip", inverse)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _phone(text: str, key: bytes, inverse: bool = False) -> str | None:
    """The digits behind the country code are permuted among those with a
    leading zero or not, as here; area and exchange of a North American number
    begin with 2-9 again if they did. A number without a code is read as one."""
    digits = _digits(text)
    if not 8 <= len(digits) <= 15:
        return None
    code = ""
    if text[0] == "+":
        code = next((digits[:n] for n in (1, 2) if digits[:n] in CALLING_CODES), digits[:3])
    local = digits[len(code):]
    trunk = re.match(r"\+[\d .-]*?\(0\)", text) is not None and local[0] == "0"
    local = local[trunk:]
    if len(local) < 5:
        return None
    alphabets = ["0" if local[0] == "0" else "123456789"] + ["0123456789"] * (len(local) - 1)
    if code in ("", "1") and len(local) == 10:
        alphabets[0] = next(some for some in ("0", "1", "23456789") if local[0] in some)
        alphabets[3] = next(some for some in ("01", "23456789") if local[3] in some)
    new = _shuffle_block(local, key, b"phone" + (code or "1").encode(), alphabets, inverse)
    return _refill(text, code + "0" * trunk + new)


def _ssn(text: str, key: bytes, inverse: bool = False) -> str | None:
    a, b, c = (int(p) for p in text.split("-"))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    area = a - 1 - (a > 666)
    x = replace((area * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, key, b"ssn", inverse)
    x, c = divmod(x, 9999)
    area, b = divmod(x, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{b + 1:02d}-{c + 1:04d}"


def _same_width(number: int, written: str, other: str) -> bool:
    """One digit stays one digit. Two may begin with zero, but beside a
    number of one digit only if they did."""
    if len(written) == len(other) == 2:
        return True
    return (number < 10) == (len(written) == 1 or written[0] == "0")


def _date(text: str, key: bytes, inverse: bool = False) -> str | None:
    """Day and month are read in the order that is valid; if both are, day
    first (and written back in the same order and width)."""
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    orders = [(0, 1, 2)] if sep == "-" else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        try:
            day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d])).toordinal() - _DAY0
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            return None
        # The permutation is over the dates that read the same way again and
        # fit the width.
        while True:
            day = replace(day, _DAYS, key, b"date" + sep.encode() + bytes((m,)), inverse)
            new = datetime.date.fromordinal(day + _DAY0)
            fits = _same_width(new.day, parts[d], parts[m]) and _same_width(new.month, parts[m], parts[d])
            if fits and (sep == "-" or (y, m, d) == (2, 1, 0) or new.day > 12):
                break
        out = [""] * 3
        out[y], out[m], out[d] = f"{new.year:04d}", str(new.month).zfill(len(parts[m])), str(new.day).zfill(len(parts[d]))
        return sep.join(out)
    return None


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _iban(text: str, key: bytes, inverse: bool = False) -> str | None:
    plain = text.replace(" ", "").upper()
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = shuffle_characters(plain[4:], key, b"iban" + plain[:2].encode(), inverse=inverse)
    new = plain[:2] + f"{98 - _mod97(plain[:2] + '00' + body):02d}" + body
    at = iter(new.lower() if text[0].islower() else new)
    return "".join(c if c == " " else next(at) for c in text)


def _secret(text: str, key: bytes, inverse: bool = False) -> str:
    if re.fullmatch("[0-9a-f]+", text):
        return shuffle_characters(text, key, b"hex", lambda c: "0123456789abcdef", inverse)
    prefix = re.match(r"AKIA|ASIA|(?:sk|pk|ghp|gho|xox[bap])[-_]|", text)[0]
    return prefix + shuffle_characters(text[len(prefix):], key, b"secret" + prefix.encode(), inverse=inverse)


def _email(text: str, key: bytes, inverse: bool = False) -> str:
    labels = text.split("@")[1].split(".")
    kept = ("." if len(labels) > 2 else "@") + ".".join(labels[-2:])
    return shuffle_characters(text[:-len(kept)], key, b"email" + kept.lower().encode(), inverse=inverse) + kept


_BY_KIND = {"card": _card, "ip": _ip, "phone": _phone, "ssn": _ssn, "date": _date, "iban": _iban, "email": _email,
            "secret": _secret}


def _ends(kind: str, value: str) -> list[int]:
    """Where a finding may end, best first: an IBAN at its country's length;
    then all of the match, then less of it, down to each border."""
    ends = [len(value)]
    if kind == "iban" and (length := IBAN_LENGTH.get(value[:2].upper())):
        at = [i + 1 for i, c in enumerate(value) if c != " "][:length]
        own = at[-1] < len(value) and len(at) == length and value[at[-1]] == " "
        return [at[-1], *ends] if own else ends
    borders = _BORDERS.get(kind, "")
    return ends + [i for i in range(len(value) - 1, 0, -1) if value[i] in borders]


def pseudonymise(text: str, key: bytes, known: dict | None = None,
                 inverse: bool = False) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The text with its personal data replaced, and the findings: (kind,
    start, end in the input, replacement). ``known`` holds what was found
    before, with one key and one direction."""
    known = {} if known is None else known
    out, spans, last, at = [], [], 0, 0
    while m := PATTERN.search(text, at):
        kind, (lo, hi) = m.lastgroup, m.span()
        if kind == "value":
            kind, lo = "secret", m.start("value")
        value = text[lo:hi]
        new = known.get((kind, value), "")
        if new == "":
            new = None
            for end in _ends(kind, value):
                part = PATTERN.match(text, m.start(), lo + end) if end < len(value) else m
                if part and part.lastgroup == m.lastgroup and part.end() == lo + end:
                    new = _BY_KIND[kind](value[:end], key, inverse)
                if new is not None:
                    break
            new = None if new is None else (new, end)
            if len(known) > 200_000:
                known.clear()
            known[kind, value] = new
        if new is None:                      # not valid: look again behind its first run of characters
            at = m.start() + max(1, len(re.match(r"\w*", text[m.start():hi])[0]))
            continue
        new, end = new
        hi = lo + end
        out += [text[last:lo], new]
        spans.append((kind, lo, hi, new))
        last = at = hi
    return "".join(out) + text[last:], spans


def recover(kind: str, value: str, key: bytes) -> str | None:
    """The value that a pseudonym of this kind stands for."""
    return _BY_KIND[kind](value, key, inverse=True)


def session_key(spark: SparkSession) -> bytes:
    own = spark.conf.get(KEY_CONF, None)
    return hashlib.blake2b(own.encode()).digest() if own else DEFAULT_KEY


def _rewrite(texts: pa.Array, key: bytes, known: dict) -> tuple[pa.Array, np.ndarray]:
    counts = np.zeros((len(texts), len(KINDS)), np.int64)
    if len(texts) == 0:
        return texts.cast(pa.string()), counts
    # Only texts with a digit, @, = or a key prefix can hold a finding.
    some = pc.match_substring_regex(texts, r"[0-9@=:]|AKIA|ASIA|sk[-_]|pk[-_]|gh[po][-_]|xox").fill_null(False)
    out = texts.cast(pa.large_string()).to_pylist()
    for i in np.flatnonzero(some.to_numpy(zero_copy_only=False)).tolist():
        out[i], spans = pseudonymise(out[i], key, known)
        for kind, n in Counter(s[0] for s in spans).items():
            counts[i, KINDS.index(kind)] = n
    return pa.array(out, pa.string()), counts


def rewrite(docs: DataFrame, key: bytes | None = None, counts: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` (``n_chars``, if there, follows);
    ``counts`` adds one ``n_<kind>`` column per kind. Without ``key`` it is
    the session's. No shuffle."""
    key = key or session_key(docs.sparkSession)
    names = docs.columns
    known: dict = {}

    def of(batch):
        text, found = _rewrite(batch.column("text"), key, known)
        columns = [text if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
        if counts:
            columns += [pa.array(found[:, i]) for i in range(len(KINDS))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *([f"n_{k}" for k in KINDS] if counts else [])])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema += "".join(f", n_{k} long" for k in KINDS) if counts else ""
    out = map_batches(docs, of, schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rewrite(docs, counts=True)
