r"""Personal data: regular expressions propose, checksum validators confirm, context words adjust.

Kinds: email, ip (parts up to 255), card (12 to 19 digits, Luhn), phone (9 to 15 digits) and, beyond
these, iban (mod 97 is 1). Matches are leftmost and do not overlap within a kind; one that fails its
check goes without a retry, but for ibans, which may end at an earlier space. A span's score starts with its kind's prior and moves with the words
within 40 characters before and 20 after it; a score never removes a span, redact() takes a least one.

Defined results: a null text is an empty one, without spans; ties in start go by kind as listed;
repeated rows are rows of their own; an empty table gives an empty one; in scan() other columns are
left out, in redact() all columns pass through. Rows are handled one by one, whole.
"""

from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # begins at a run of digits only and never goes back, for linear time
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
#: Prior of each kind, and context words with what they add.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": (r"e-?mail|contact|write|reach|kontakt|correo|courriel", 0.1),
    "ip": (r"\bip\b|address|server|host|login|adresse", 0.3),
    "card": (r"card|visa|payment|paid|credit|karte|tarjeta|carte", 0.2),
    "phone": (r"phone|\btel\b|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone", 0.3),
    "iban": (r"iban|account|bank|konto|cuenta|compte", 0.1),
}
AGAINST = re.compile(r"version|\bv[0-9]|order|invoice|isbn|serial|build", re.I)
_NEAR = {k: re.compile(p, re.I) for k, (p, _) in CONTEXT.items()}
_WORD = frozenset(map(ord, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"))


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str):
    """EMAIL's matches, sought around each @ only: its first part is all the word characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        i = at
        while i > done and ord(text[i - 1]) in _WORD:
            i -= 1
        m = EMAIL.match(text, i) if i < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _byte(digits: str) -> bool:
    """Whether the number, without zeros in front, is at most 255."""
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def _ibans(text: str):
    """IBAN's matches, cut back to an earlier space where the whole fails: a word in capitals may follow."""
    m = IBAN.search(text)
    while m:
        a, ends = m.start(), [m.end(), *(i for i in range(m.end() - 1, m.start() + 14, -1) if text[i] == " ")]
        end = next((b for b in ends if mod97(text[a:b])), None)
        if end:
            yield a, end
        m = IBAN.search(text, end or a + 1)


def spans(text: str) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, score) of each span, sorted by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(_byte(p.lstrip("0")) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    found += [(a, 4, b) for a, b in _ibans(text)]
    out = []
    for a, k, b in sorted(found):
        kind, near = KINDS[k], text[max(0, a - 40) : a] + " " + text[b : b + 20]
        score = PRIOR[kind] + CONTEXT[kind][1] * bool(_NEAR[kind].search(near)) - 0.3 * bool(AGAINST.search(near))
        out.append((a, kind, b, round(min(1.0, max(0.0, score)), 3)))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


@F.pandas_udf(SPANS)
def find(text):
    import pandas as pd

    return pd.Series([[] if t is None else [{"start": a, "kind": k, "end": b, "score": s} for a, k, b, s in spans(t)] for t in text])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans, an array of (start, kind, end, score)."""
    return docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """docs with each span of at least this score replaced by <kind>; of overlapping spans the first goes."""

    @F.pandas_udf("string")
    def cover(text):
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for a, k, b, s in spans(t):
                if s >= least and a >= at:
                    out += [t[at:a], f"<{k}>"]
                    at = b
            return "".join([*out, t[at:]])

        return text.map(one)

    return docs.withColumn(text_col, cover(F.col(text_col)))
