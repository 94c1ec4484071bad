"""Detection and pseudonymization of sensitive values."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is detected, in order of priority. Java and Python read these patterns alike.
DETECTORS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\b",
    "uuid": r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",
    "object_id": r"\b[0-9a-f]{24}\b",
    "phone": r"\+(?:[0-9][\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000-]?){7,14}[0-9]\b",
    "card_number": r"(?<![0-9.])[0-9]{13,19}(?![0-9.])",
    "account_number": r"(?<![0-9.])[0-9]{8}(?![0-9.])",
}
#: Words and formats of stand-ins, keys whose values are names, financial keys and their kinds, values that
#: mean nothing, keys of money, and the forms of a key with its value and of a profile line.
FIRST = "Alex Sam Jordan Taylor Morgan Casey Riley Jamie Avery Quinn Rowan Harper Ellis Finley Sky Drew".split()
LAST = "Walker Reed Hayes Brooks Marsh Bennett Cole Dale Ford Gray Hale Lane Nash Page Stone Wells".split()
NAME_KEYS = (
    "name first_name last_name full_name payee_name account_name account_holder account_holder_name beneficiary beneficiary_name company_name display_name "
    "legal_name trading_name customer_name payer_name payee recipient recipient_name holder_name business_name"
).split()
FINANCIAL_KEYS = {"account_number": "account_number", "iban": "iban", "bic_swift": "bic", "bic": "bic", "swift": "bic"}
MEANINGLESS = ("-", "n/a", "none", "not set", "unknown", "null", "true", "false")
MONEY_KEY = r"amount|price|total|balance|fee|cents|minorunits"
KEY_VALUE = r'"(?P<key>[A-Za-z][A-Za-z0-9_-]*)"(?P<sep>\s*:\s*)"(?P<value>[^"]{2,120})"'
PROFILE_LINE = r"(?m)^\s*-\s*\*\*(?P<label>[^*]+)\*\*\s*:\s*(?P<value>.+?)\s*$"
STAND_INS = {
    "name": lambda n, h: f"{FIRST[n % 16]} {LAST[n // 16 % 16]}",
    "email": lambda n, h: f"{FIRST[n % 16].lower()}.{LAST[n // 16 % 16].lower()}.{h[:4]}@example.com",
    "phone": lambda n, h: f"+99 900 {n % 1_000_000:06d}",
    "account_number": lambda n, h: f"{n % 100_000_000:08d}",
    "card_number": lambda n, h: f"4111{n % 10**12:012d}",
    "iban": lambda n, h: f"XX00TEST{n % 10**14:014d}",
    "bic": lambda n, h: f"TESTXX{h[:2].upper()}",
    "date_of_birth": lambda n, h: f"{1 + n % 28} January 199{n % 10}",
    "address": lambda n, h: f"{1 + n % 99} Example Street",
    "uuid": lambda n, h: f"{h[0:8]}-{h[8:12]}-4{h[13:16]}-a{h[17:20]}-{h[20:32]}",
    "object_id": lambda n, h: h[:24],
}


def key_identity(key: str) -> str:
    """Keys are the same whatever their case, underscores and hyphens."""
    return key.lower().translate({ord("_"): None, ord("-"): None})


_NAME_KEYS = frozenset(map(key_identity, NAME_KEYS))
_FINANCIAL = {key_identity(k): v for k, v in FINANCIAL_KEYS.items()}


def meaningful(value: str) -> bool:
    core = value.strip()
    return len(core) > 2 and core.lower() not in MEANINGLESS and (core[0], core[-1]) != ("<", ">")


def numeric_like(value: str) -> bool:
    return re.fullmatch(r"[0-9.,\- ]+", value.strip()) is not None


def is_money(key: str, value: str) -> bool:
    """Whether a value is an amount, which stays as it is."""
    return re.search(MONEY_KEY, key_identity(key)) is not None and numeric_like(value)


def detected(text: Column) -> Column:
    """map<kind, count> of what the detectors see."""
    signs = {"email": "@", "uuid": "-", "phone": "+"}  # without these characters the pattern need not run

    def count(kind, pattern):
        found = F.regexp_count(text, F.lit(pattern))
        return F.when(F.contains(text, F.lit(signs[kind])), found).when(text.isNotNull(), 0) if kind in signs else found

    return F.map_from_arrays(F.array(*map(F.lit, DETECTORS)), F.array(*[count(k, p) for k, p in DETECTORS.items()]))


def fake_number(kind: str, value: Column, salt: str) -> Column:
    """48 bits of SHA-256 of salt:kind:value in lower case."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:{kind}:"), F.lower(value)), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def fake(kind: str, value: str, salt: str) -> str:
    """A stable stand-in for a value, whatever its case."""
    if kind not in STAND_INS:
        raise ValueError(f"unknown kind {kind!r}")
    digest = hashlib.sha256(f"{salt}:{kind}:{value.lower()}".encode()).hexdigest()
    return STAND_INS[kind](int(digest[:12], 16), digest)


Terms = list[tuple[str, str]]


def _argument_values(value, key: str | None):
    """(key, string) of all strings in a JSON value; items of a list go by the key of the list."""
    stack = [(key, value)]
    while stack:
        key, value = stack.pop()
        if isinstance(value, dict):
            stack += [(str(k), v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            stack += [(key, v) for v in reversed(value)]
        elif isinstance(value, str) and key is not None:
            yield key, value


def _profile_kind(label: str) -> str | None:
    label = label.strip().lower()
    return next((kind for sign, kind in (("date of birth", "date_of_birth"), ("address", "address"), ("name", "name")) if sign in label), None)


def harvested(messages: list[dict]) -> Terms:
    """(kind, term) that a dialogue's call arguments, tool payloads and profile lines give away, in order."""
    out = []
    for m in messages:
        for call in m["tool_calls"]:
            out += [("name", v.strip()) for k, v in _argument_values(call["arguments"], None) if key_identity(k) in _NAME_KEYS and meaningful(v)]
        if m["role"] == "tool":
            out += [("name", x["value"]) for x in re.finditer(KEY_VALUE, m["content"]) if key_identity(x["key"]) in _NAME_KEYS and meaningful(x["value"])]
        if m["role"] == "system":
            lines = [(_profile_kind(x["label"]), x["value"].strip()) for x in re.finditer(PROFILE_LINE, m["content"])]
            out += [(kind, value) for kind, value in lines if kind and meaningful(value)]
    return out


def ordered_terms(found: Terms, extra: list[str] | None = None) -> Terms:
    """Terms once each whatever their case, in the first form seen, the caller's own first; the longest first."""
    own = [("name", t.strip()) for t in extra or [] if len(t.strip()) >= 3]
    first: dict[str, tuple[str, str]] = {t.lower(): (k, t) for k, t in own}  # of the caller's own the last form
    for kind, term in found:
        first.setdefault(term.lower(), (kind, term))
    return sorted(first.values(), key=lambda x: len(x[1]), reverse=True)


class _Claims:
    """Spans that do not overlap, in order, with what replaces them (None keeps the text)."""

    def __init__(self):
        self.spans: list[tuple[int, int, str | None]] = []

    def take(self, start: int, end: int, new: str | None) -> bool:
        at = bisect_left(self.spans, (start,))
        before, after = self.spans[at - 1 : at], self.spans[at : at + 1]
        if (at and before[0][1] > start) or (after and after[0][0] < end):
            return False
        self.spans.insert(at, (start, end, new))
        return True

    def applied(self, text: str) -> str:
        out, at = [], 0
        for a, b, new in self.spans:
            out += [text[at:a], text[a:b] if new is None else new]
            at = b
        return "".join(out) + text[at:]


def scrub_terms(text: str, terms: Terms, salt: str) -> tuple[str, dict[str, int]]:
    """text with keyed financial values, terms and detected values replaced. What comes earlier claims its spans first:
    keyed values (amounts claim theirs to stay), terms other than names, detectors in order, names."""
    claims, counts = _Claims(), {}

    def claim(kind, span, value):
        if claims.take(*span, fake(kind, value, salt)):
            counts[kind] = counts.get(kind, 0) + 1

    def claim_terms(names: bool):
        for kind, term in terms:
            if (kind == "name") == names:
                for m in re.finditer(rf"(?<!\w){re.escape(term)}(?!\w)", text, re.IGNORECASE):
                    claim(kind, m.span(), term)

    for m in re.finditer(KEY_VALUE, text):
        kind = _FINANCIAL.get(key_identity(m["key"]))
        if kind and meaningful(m["value"]):
            claim(kind, m.span("value"), m["value"])
        elif is_money(m["key"], m["value"]):
            claims.take(*m.span("value"), None)
    claim_terms(names=False)
    for kind, pattern in DETECTORS.items():
        for m in re.finditer(pattern, text):
            claim(kind, m.span(), m.group())
    claim_terms(names=True)
    return claims.applied(text), counts


def scrub(text: str, terms: list[str], salt: str) -> tuple[str, dict[str, int]]:
    """text with detected values and whole-word names replaced."""
    return scrub_terms(text, ordered_terms([], terms), salt)


def scrub_value(value, key: str | None, terms: Terms, salt: str, counts: dict[str, int]):
    """A JSON value scrubbed: keys, numbers of other keys, booleans and nulls stay; items of a list go by its key."""
    if isinstance(value, dict):
        return {str(k): scrub_value(v, str(k), terms, salt, counts) for k, v in value.items()}
    if isinstance(value, list):
        return [scrub_value(v, key, terms, salt, counts) for v in value]
    kind = _FINANCIAL.get(key_identity(key)) if key is not None else None
    if type(value) is int and kind or isinstance(value, str) and kind and meaningful(value):
        counts[kind] = counts.get(kind, 0) + 1
        new = fake(kind, str(value), salt)
        return int(new) if type(value) is int and new.isdigit() else new
    if not isinstance(value, str) or (key is not None and is_money(key, value)):
        return value
    new, more = scrub_terms(value, terms, salt)
    for k, n in more.items():
        counts[k] = counts.get(k, 0) + n
    return new


def scrub_dialogue(messages: list[dict], salt: str, extra: list[str] | None = None) -> tuple[list[dict], dict[str, int]]:
    """Messages with contents and call arguments scrubbed by the terms of the whole dialogue, and counts by kind."""
    terms, counts, out = ordered_terms(harvested(messages), extra), {}, []
    for m in messages:
        content, more = scrub_terms(m["content"], terms, salt)
        calls = [c | {"arguments": scrub_value(c["arguments"], None, terms, salt, counts)} for c in m["tool_calls"]]
        for k, n in more.items():
            counts[k] = counts.get(k, 0) + n
        out.append(m | {"content": content, "tool_calls": calls})
    return out, dict(sorted(counts.items()))


def pseudonymize(df: DataFrame, text_col: str, salt: str, terms: list[str] | None = None) -> DataFrame:
    """df with the text scrubbed, and ``replaced``, a count for each kind; one pass, no shuffle."""

    @F.pandas_udf("text string, replaced map<string,long>")
    def scrubbed(s: pd.Series) -> pd.DataFrame:
        own = ordered_terms([], terms)
        return pd.DataFrame([scrub_terms(t or "", own, salt) for t in s], columns=["text", "replaced"])

    out = df.withColumn("__s", scrubbed(F.col(text_col)))
    return out.withColumn(text_col, F.col("__s.text")).withColumn("replaced", F.col("__s.replaced")).drop("__s")
