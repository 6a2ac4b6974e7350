"""Personal data by anchor expansion.

One Aho-Corasick scan of a whole text finds the anchors: at-signs, plus signs,
digits, scheme endings and identifier cues.  A deterministic local parser
expands each anchor to its boundaries and validates it: addresses around an
at-sign, dotted quads, card and phone numbers around digits, links after a
scheme, and accounts after a cue.

Base kinds are the leftmost non-overlapping matches of these expressions, per
kind; a match that fails its test is dropped and still spends its text:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 14 to 19 digits, Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 10 to 15 digits

Added kinds: url (after ``://``), iban (two capitals and two digits, checksum
97) and secret (a quoted or bare value of 16 or more characters after a cue).
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "secret")
CUES = ("token", "secret", "password", "api_key", "apikey", "access_key", "iban", "IBAN", "account", "Account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_REST = re.compile(r"://[^\s<>\"']+")
_SECRET = re.compile(r"""["']?\s{0,3}[:=]\s{0,3}["']?([A-Za-z0-9_\-/+]{16,})""")
_IBAN = re.compile(r"[\s:]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick
    found = ahocorasick.Automaton()
    for word in ("@", "+", "://", *"0123456789", *CUES):
        found.add_word(word, word)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a whole text, by start, then kind as listed."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    done = dict.fromkeys(KINDS, 0)  # where the last match of each kind ended
    run = -1  # end of the digit run the scan is in
    for end, what in _anchors().iter(text):
        at = end - len(what) + 1
        if what == "@":
            left = at
            while left > done["email"] and text[left - 1] in _LOCAL:
                left -= 1
            m = _DOMAIN.match(text, at) if left < at else None
            if m:
                out.append((left, m.end(), "email"))
                done["email"] = m.end()
        elif what == "+":
            m = _PHONE.match(text, at) if at >= done["phone"] else None
            if m:
                done["phone"] = m.end()
                if 10 <= len(_digits(m.group())) <= 15:
                    out.append((at, m.end(), "phone"))
        elif what == "://":
            left = at
            while left > done["url"] and text[left - 1].isascii() and text[left - 1].isalpha():
                left -= 1
            m = _REST.match(text, at) if left < at else None
            if m:
                out.append((left, m.end(), "url"))
                done["url"] = m.end()
        elif len(what) == 1:
            # a match begins at the first digit of a run, or where the last match of its kind ended inside one
            if at != run or at == done["ip"]:
                m = _QUAD.match(text, at) if at >= done["ip"] else None
                if m:
                    done["ip"] = m.end()
                    if all(len(p := g.lstrip("0")) <= 3 and int(p or "0") <= 255 for g in m.groups()):
                        out.append((at, m.end(), "ip"))
            if at >= done["card"]:
                m = _CARD.match(text, at)
                if m:
                    done["card"] = m.end()
                    number = _digits(m.group())
                    if 14 <= len(number) <= 19 and luhn(number):
                        out.append((at, m.end(), "card"))
            run = at + 1
        else:
            m = _SECRET.match(text, end + 1) if what[0] not in "iIA" and what != "account" else _IBAN.match(text, end + 1)
            kind = "secret" if m and m.re is _SECRET else "iban"
            if m and m.start(1) >= done[kind] and (kind == "secret" or _iban(m.group(1))):
                out.append((m.start(1), m.end(1), kind))
                done[kind] = m.end(1)
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[0], rank[s[2]], s[1]))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): per row the spans as structs (kind, start, end) in code
    points, end exclusive.  A null or empty text has none; rows with a null or
    repeated id each give a row; extra columns are ignored."""
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                spans = [[{"kind": k, "start": s, "end": e} for s, e, k in find(t.as_py())] for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["doc_id", "found"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, "
                             "found array<struct<kind: string, start: long, end: long>>"))


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span replaced by its kind; overlaps give one mark."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
        at = max(at, end)
    return "".join(out) + text[at:]


def digest(found: DataFrame) -> DataFrame:
    """The counts and span lists of ``personal_data``."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", name), ",").alias("spans"))
