"""Personal data in texts: anchors from an Aho-Corasick automaton, widened and checked by local parsers."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import small_batches
from loomstep.schema import free_names

#: Kinds in the order in which they are listed; the last three are found besides the base patterns.
KINDS = ("email", "ip", "card", "phone", "account", "iban", "login")
BASE = KINDS[:4]
#: Cues after which an account number may stand: in lower case, title case and capitals.
CUES = ("account", "acct", "a/c", "konto", "compte", "cuenta", "conto", "passport", "reisepass", "ssn", "social security", "tax id", "customer", "kunde", "client", "member")
#: Characters of an international account number by country: fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may stand between a cue and the number, and the number: groups behind a blank hold digits only.
_BETWEEN = re.compile(r"\x20?(?:nummer|number|num\b\.?|no\b\.?|nr\b\.?|n[°º]|id\b|#)?(?:\x20?[:=#]|\x20is\b)?\x20?", re.IGNORECASE)
_ACCOUNT = re.compile(r"[A-Z]{0,3}[0-9][0-9A-Z]*(?:-[0-9A-Z]+|/[0-9]+|\x20[0-9]{2,}(?![0-9A-Za-z]))*(?![0-9A-Za-z])")
_GROUP = re.compile(r"\x20?([A-Z0-9])")
_LOGIN = re.compile(r"[^\s/?#@:]++:[^\s/?#@]++(?=@)")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def iban_end(text: str, at: int) -> int | None:
    """Where the international account number that begins at a country code ends, blanks between its groups allowed; or None."""
    size, end, found = IBAN_LENGTHS[text[at : at + 2]], at, []
    while len(found) < size and (m := _GROUP.match(text, end)):
        found.append(m[1])
        end = m.end()
    if len(found) < size or not "".join(found[2:4]).isdecimal() or text[end : end + 1].isalnum():
        return None
    return end if int("".join(str(int(c, 36)) for c in found[4:] + found[:4])) % 97 == 1 else None


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    a.add_word("@", "at")
    a.add_word("+", "plus")
    a.add_word("://", "scheme")
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.title(), cue.upper()):
            a.add_word(form, f"cue{len(form)}")
    for country in IBAN_LENGTHS:
        a.add_word(country, "country")
    a.make_automaton()
    return a


def find(text: str, anchors) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; the spans of one kind do not overlap.

    An account number follows a cue, with 6 digits and more: blanks join it only to groups of digits. An iban
    begins at a country code that no letter or digit precedes, has that country's length and right check digits.
    Each anchor is widened at most once for each kind: a parser goes on from the end of its last match, kept
    or not, as a scan from left to right would.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "digits"), 0)
    for end, what in anchors.iter(text):
        if what == "digit":
            if end >= done["ip"] and end >= done["digits"]:
                # The first digit of a run, or of what the last address left of it.
                if m := _IP.match(text, end):
                    done["ip"] = m.end()
                    if all(map(_small, m.groups())):
                        found["ip"].append(m.span())
                else:
                    done["digits"] = _run_end(text, end)
            if end >= done["card"] and (m := _CARD.match(text, end)):
                done["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
        elif what == "at":
            at, start = end, end
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                found["email"].append((start, m.end()))
        elif what == "plus":
            if end >= done["phone"] and (m := _PHONE.match(text, end)):
                done["phone"] = m.end()
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    found["phone"].append(m.span())
        elif what == "scheme":
            if end + 1 >= done["login"] and (m := _LOGIN.match(text, end + 1)):
                done["login"] = m.end()
                found["login"].append(m.span())
        elif what == "country":
            start = end - 1
            if start >= done["iban"] and not text[start - 1 : start].isalnum() and (to := iban_end(text, start)):
                done["iban"] = to
                found["iban"].append((start, to))
        elif end + 1 >= done["account"] and not text[end - int(what[3:]) : end - int(what[3:]) + 1].isalnum():
            m = _ACCOUNT.match(text, _BETWEEN.match(text, end + 1).end())
            if m and 6 <= len(_DIGIT.findall(m[0])):
                done["account"] = m.end()
                found["account"].append(m.span())
    return [(k, a, b) for k in KINDS for a, b in found[k]]


_DIGIT, _DIGITS = re.compile("[0-9]"), re.compile("[0-9]+")


def _run_end(text: str, at: int) -> int:
    return _DIGITS.match(text, at).end()


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def pii_spans(docs: DataFrame, *, text_col: str = "text", out: str = "pii") -> DataFrame:
    """docs with an array of struct(kind, start, end) for each whole text, in code points, end exclusive.

    Null and empty texts have an empty array. Other columns and repeated rows stay as they are, whatever their
    names; one named like out is replaced. An empty table gives no rows.
    """
    [held] = free_names(docs, "text")
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        anchors = automaton()
        for batch in small_batches(batches):
            made = [
                [{"kind": k, "start": a, "end": b} for k, a, b in (find(t, anchors) if t else ())]
                for t in batch.column(batch.num_columns - 1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, span)], names=[*keep, out])

    keep = [c for c in docs.columns if c != out]
    kept = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").alias(held))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, `{out}` array<struct<kind: string, start: long, end: long>>")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
