"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Base kinds: ``email``, ``ip`` (parts at most 255), ``card`` (13 to 19 digits, Luhn) and
``phone`` (a plus sign, 9 to 15 digits).  Matches are leftmost and non-overlapping within
a kind; a match that fails its check is dropped and not tried again in part.

Added kinds, never over a base span: ``iban`` (country length and mod-97) and
``local_phone`` and ``national_id``, which have no checksum and are taken only if a context
word stands nearby.

Every span has a score: a start by kind, more for a passed checksum, more for a context
word within ``NEAR`` characters.  Base spans stay whatever their score.

The patterns give up nothing they have taken (possessive) and start only where a run
starts, so a text of one long run of digits or letters takes linear time.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.words import append_result, free_name, results, text_bytes

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "local_phone", "national_id")
NEAR = 40
ACCEPT = 0.6

# Words that make a kind likelier, and the length of an IBAN by country.
CONTEXT = {
    "email": "mail email contact write courriel correo",
    "ip": "ip address host server addr adresse",
    "card": "card visa mastercard credit payment pay carte tarjeta karte",
    "phone": "phone tel call mobile fax telefon telefono",
    "iban": "iban account bank transfer konto compte cuenta",
    "local_phone": "phone tel call mobile fax telefon telefono",
    "national_id": "ssn social security insurance passport",
}
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18"
    " DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23"
    " IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27"
    " MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SE24 SI19 SK24 SM27 TN24"
    " TR26 UA29 VA22 VG24 XK20"
)

LENGTHS = {x[:2]: int(x[2:]) for x in IBAN_LENGTHS.split()}
NEARBY = {
    kind: re.compile(rf"\b(?:{'|'.join(words.split())})\b", re.IGNORECASE)
    for kind, words in CONTEXT.items()
}
START = {"email": 0.7, "ip": 0.5, "card": 0.4, "phone": 0.5}
START |= {"iban": 0.4, "local_phone": 0.4, "national_id": 0.4}

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

Span = tuple[int, int, float]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    """True if the digits pass the Luhn checksum."""
    odd = sum(map(int, number[-1::-2]))
    even = sum((2 * int(c)) // 10 + (2 * int(c)) % 10 for c in number[-2::-2])
    return (odd + even) % 10 == 0


def mod97(code: str) -> bool:
    """True if an IBAN without spaces passes its check digits."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with what can stand before and after it, from left to right."""
    found, low, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > low and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        low = domain.end() if domain else at + 1
        if domain:
            found.append((begin, low))
        at = text.find("@", low)
    return found


def ibans(text: str) -> list[tuple[int, int]]:
    """Candidates cut to their country's length, with valid check digits.

    The search goes on at the end of what is confirmed, or behind the start of what is not.
    """
    found, at = [], 0
    while m := IBAN.search(text, at):
        at = m.start() + 1
        size, plain = LENGTHS.get(m[0][:2], 99), m[0].replace(" ", "")
        if len(plain) >= size and mod97(plain[:size]):
            end, left = m.start(), size
            while left:
                left -= text[end] != " "
                end += 1
            if end == len(text) or not text[end].isalnum():
                found.append((m.start(), end))
                at = end
    return found


def scored(text: str, kind: str, start: int, end: int, checked: bool) -> float:
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    near = NEARBY[kind].search(around) is not None
    return min(1.0, START[kind] + 0.3 * checked + 0.2 * near)


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places as ranges that do not overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def meets(ranges: list[tuple[int, int]], starts: list[int], a: int, b: int) -> bool:
    """Whether any of the ordered ranges overlaps (a, b): if so, the last one that begins before b."""
    at = bisect_left(starts, b) - 1
    return at >= 0 and ranges[at][1] > a


def spans(text: str) -> dict[str, list[Span]]:
    """The spans of each kind in one text, in order of start."""
    plain: dict[str, list[tuple[int, int]]] = {"email": emails(text)}
    plain["ip"] = [
        m.span()
        for m in IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    ]
    plain["card"] = [
        m.span()
        for m in CARD.finditer(text)
        if 13 <= len(d := digits(m[0])) <= 19 and luhn(d)
    ]
    plain["phone"] = [
        m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15
    ]
    taken = merged([x for found in plain.values() for x in found])
    plain["iban"] = ibans(text)
    for kind, pattern in (("local_phone", LOCAL_PHONE), ("national_id", NATIONAL_ID)):
        plain[kind] = [m.span() for m in pattern.finditer(text)]
    out: dict[str, list[Span]] = {}
    for kind in KINDS:
        checked = kind in ("card", "iban")
        out[kind] = [(a, b, scored(text, kind, a, b, checked)) for a, b in plain[kind]]
        if kind not in BASE:
            starts = [a for a, _ in taken]
            free = [x for x in out[kind] if not meets(taken, starts, x[0], x[1])]
            out[kind] = [x for x in free if x[2] >= ACCEPT]
            taken = merged([*taken, *[x[:2] for x in out[kind]]])
    return out


def candidates(texts: pa.Array) -> list[bool]:
    """Which texts can hold anything: an ``@`` or four digits, counted on the bytes."""
    data, at = text_bytes(texts)
    digit = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39))])
    sign = np.concatenate([[0], np.cumsum(data == 0x40)])
    return ((np.diff(digit[at]) >= 4) | (np.diff(sign[at]) > 0)).tolist()


NONE: dict[str, list[Span]] = {kind: [] for kind in KINDS}


def found_in(texts: pa.Array) -> list[dict[str, list[Span]]]:
    use = candidates(texts)
    return [
        spans(t.as_py()) if live else NONE for t, live in zip(texts, use, strict=True)
    ]




def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans``: every span with kind, code points (end exclusive) and score.

    One row per row of ``docs``; null and empty texts have an empty array.  Spans are in
    the order of their kinds, then of their starts.
    """

    def make():
        def run(texts):
            rows = [
                [
                    {"kind": kind, "start": a, "end": b, "score": s}
                    for kind in KINDS
                    for a, b, s in found[kind]
                ]
                for found in found_in(texts)
            ]
            kind = pa.list_(
                pa.struct(
                    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
                    + [("score", pa.float64())]
                )
            )
            return [pa.array(rows, kind)]

        return run

    return results(
        docs, key, text, make, "spans array<struct<kind:string,start:long,end:long,score:double>>"
    )


def mask_personal(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets.

    Where spans overlap, their union is replaced under the name of the first.  Texts
    without spans, null texts and all other columns stay; ``length`` names a column that
    holds the text's characters and is set anew where the text changed.
    """
    name = free_name("masked", docs.columns)

    def make():
        def run(texts):
            rows = []
            for value, found in zip(texts, found_in(texts), strict=True):
                every = sorted((a, b, kind) for kind in KINDS for a, b, _ in found[kind])
                if not every:
                    rows.append(None)
                    continue
                whole, out, low = value.as_py(), [], 0
                for a, b, kind in every:
                    if a >= low:
                        out += [whole[low:a], f"<{kind.upper()}>"]
                    low = max(low, b)
                rows.append("".join(out) + whole[low:])
            return [pa.array(rows, pa.string())]

        return run

    done = append_result(docs, text, make, "text string", name)
    new = {text: F.coalesce(F.col(name)["text"], F.col(text))}
    if length:
        changed = F.col(name)["text"].isNotNull()
        size = F.length(F.col(name)["text"]).cast(docs.schema[length].dataType)
        new[length] = F.when(changed, size).otherwise(F.col(length))
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def personal_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, counts of the base kinds, SHA-256 of the base spans, and all spans as text."""
    found = find_personal(docs, key, text)
    as_text = F.transform(
        "spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    )
    base = F.transform(
        F.filter("spans", lambda s: s["kind"].isin(*BASE)),
        lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]),
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE]
    return found.select(
        key,
        *counts,
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", as_text).alias("spans"),
    )
