"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and the words
that announce an identifier. From each anchor a local parser walks to both ends of the candidate and
validates it; what lies between anchors is never looked at again. Every walk is bounded by the end
of the former one of its kind, so a text takes time in proportion to its length.

Base kinds, leftmost and without overlaps inside a kind: ``email``, ``ip`` (parts of at most 255),
``card`` (13 to 19 digits that pass Luhn's test) and ``phone`` (9 to 15 digits). A candidate that
fails its test is dropped as a whole. The anchors give these further kinds, which may overlap others:

* ``login``: user and password before the host of an address with a scheme
* ``wide_email``: an e-mail address with letters beyond ASCII
* ``hidden_email``: one written with (at) or [at]
* ``ipv6``: an address of hexadecimal groups, checked in full
* ``iban``: an account number behind its cue, modulo 97 equal to 1
* ``ssn``: nine digits behind their cue, without unused areas
* ``account``: a sign with at least four digits behind the cue for an account, customer or passport
* ``secret``: a value of eight signs or more that is assigned to a password, token or key
* ``street``: house number and name before a word for a street

Offsets are code points, ends exclusive. Texts that are null or empty have no spans. Rows stand for
themselves: repeated ids and null ids stay as they are, one result row per input row. An empty table
gives an empty result. Columns beyond id and text are left out by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import documents, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "wide_email", "hidden_email", "ipv6", "iban", "ssn", "account", "secret", "street")
SPANS = "array<struct<kind:string,start:int,end:int>>"

#: Words that announce an identifier, by the parser that reads what follows them.
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security number", "social security no"),
    "account": ("account", "acct", "konto", "kontonummer", "cuenta", "compte", "passport", "reisepass", "pasaporte",
                "passeport", "customer id", "license", "licence"),
    "secret": ("password", "passwd", "passwort", "token", "secret", "api_key", "apikey", "api key", "access_key"),
    "street": ("street", "st.", "avenue", "ave.", "road", "rd.", "boulevard", "lane", "drive"),
}
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
STEP = 64

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBER = re.compile(r"[0-9](?:[ .-]?[0-9])*+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
LOGIN = re.compile(r"://([^\s/?#@:]+:[^\s/?#@]+)@[^\s/?#@]")
WIDE_DOMAIN = re.compile(r"[\w-]++(?:\.[\w-]++)++")
HIDDEN = re.compile(r"\s?[(\[]at[)\]]\s?([A-Za-z0-9-]+(?:\s?[(\[]dot[)\]]\s?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)+)", re.IGNORECASE)
SIX = re.compile(r"[0-9A-Fa-f:]+")
ACCOUNT_SIGNS = r"\s?(?:no\.?|number|nr\.?|nummer|id|#)?\s?[:=#]?\s?"
IBAN = re.compile(r"\s?(?:no\.?|number|nr\.?)?\s?[:=#]?\s?([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})")
SSN = re.compile(r"\s?[:=#]?\s?([0-9]{3})([ -]?)([0-9]{2})\2([0-9]{4})(?![0-9])")
ACCOUNT = re.compile(ACCOUNT_SIGNS + r"([A-Za-z0-9](?:-?[A-Za-z0-9]){4,23})(?![A-Za-z0-9])", re.IGNORECASE)
SECRET = re.compile(r"\s?[:=]\s?(\"([^\"\s]{8,})\"|'([^'\s]{8,})'|([^\"'\s]{8,}))")
HOUSE = re.compile(r"[0-9]{1,5}[A-Za-z]? (?:[^\W\d_][\w'-]* ){1,4}\Z")


def leftmost(text: str, end: int, floor: int, signs: str) -> int:
    """Beginning of the run of ``signs`` before ``end``, not before ``floor``."""
    while end > floor:
        begin = max(floor, end - STEP)
        kept = len(text[begin:end].rstrip(signs))
        if kept:
            return begin + kept
        end = begin
    return floor


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def is_iban(sign: str) -> bool:
    moved = sign[4:] + sign[:4]
    return 15 <= len(sign) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    begin = leftmost(text, at, floor, LOCAL)
    found = DOMAIN.match(text, at + 1) if begin < at else None
    return (begin, found.end()) if found else None


def _wide_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    begin = at
    while begin > floor and (text[begin - 1].isalnum() or text[begin - 1] in LOCAL):
        begin -= 1
    found = WIDE_DOMAIN.match(text, at + 1) if begin < at else None
    return (begin, found.end()) if found and not text[begin : found.end()].isascii() else None


def _hidden_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """``at`` is the place of the bracket."""
    gap = at - 1 if at > floor and text[at - 1].isspace() else at
    found = HIDDEN.match(text, gap)
    begin = leftmost(text, gap, floor, LOCAL)
    return (begin, found.end()) if found and begin < gap else None


def _phone(text: str, at: int) -> tuple[int, int] | None:
    found = PHONE.match(text, at)
    if not found:
        return None
    end = at + len(found.group().rstrip(" ().-"))
    return (at, end) if end >= at + 4 and 9 <= sum(map(str.isdigit, text[at:end])) <= 15 else None


def _ipv6(text: str, at: int, floor: int) -> tuple[int, int, bool]:
    """The run of groups around a colon, and whether it is an address."""
    begin = leftmost(text, at, floor, "0123456789abcdefABCDEF:")
    end = SIX.match(text, at).end()
    whole = 3 <= end - begin <= 39 and not (begin and text[begin - 1].isalnum()) and not text[end : end + 1].isalnum()
    if whole and any(c.isalnum() for c in text[begin:end]):
        try:
            ipaddress.IPv6Address(text[begin:end])
        except ValueError:
            whole = False
    else:
        whole = False
    return begin, end, whole


def _iban(text: str, at: int) -> tuple[int, int] | None:
    found = IBAN.match(text, at)
    if not found:
        return None
    begin, end = found.span(1)
    # The groups may run on into the next word: the longest valid beginning counts.
    while end > begin:
        sign = text[begin:end].replace(" ", "")
        if not text[end : end + 1].isalnum() and text[end - 1] != " " and is_iban(sign):
            return begin, end
        end -= 1
    return None


def _ssn(text: str, at: int) -> tuple[int, int] | None:
    found = SSN.match(text, at)
    if not found or found[1] in ("000", "666") or found[1] >= "900" or found[3] == "00" or found[4] == "0000":
        return None
    return found.start(1), found.end(4)


def _account(text: str, at: int) -> tuple[int, int] | None:
    found = ACCOUNT.match(text, at)
    return found.span(1) if found and sum(c.isdigit() for c in found[1]) >= 4 else None


def _secret(text: str, at: int) -> tuple[int, int] | None:
    found = SECRET.match(text, at)
    return next((found.span(i) for i in (2, 3, 4) if found[i]), None) if found else None


def _street(text: str, begin: int, end: int) -> tuple[int, int] | None:
    from_ = max(0, begin - 80)
    found = HOUSE.search(text[from_:begin])
    return (from_ + found.start(), end) if found else None


BEHIND: dict[str, Callable[[str, int], tuple[int, int] | None]] = {"iban": _iban, "ssn": _ssn, "account": _account, "secret": _secret}


def anchors():
    """The automaton of all anchors; its values are (kind of anchor, length)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for sign in "@+:":
        automaton.add_word(sign, (sign, 1))
    for digit in range(10):
        automaton.add_word(str(digit), ("digit", 1))
    for word in ("://", "(at)", "[at]", "(AT)", "[AT]"):
        automaton.add_word(word, ("scheme" if word == "://" else "hidden", len(word)))
    for kind, words in CUES.items():
        for word in words:
            for form in {word, word.upper(), word.capitalize(), word.title()}:
                automaton.add_word(form, (kind, len(form)))
    automaton.make_automaton()
    return automaton


def spans(text: str, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data, by kind as in ``KINDS``, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "number"), 0)

    def keep(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= done[kind]:
            found[kind].append(span)
            done[kind] = span[1]

    for last, (anchor, length) in automaton.iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at < done["number"]:
                continue
            end = NUMBER.match(text, at).end()
            done["number"] = end
            if end - at < 7:
                continue
            for m in IP.finditer(text, at, end):
                if all(map(small, m.group().split("."))):
                    found["ip"].append(m.span())
            for m in CARD.finditer(text, at, end):
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
        elif anchor == "@":
            if at >= done["email"]:
                keep("email", _email(text, at, done["email"]))
            if at >= done["wide_email"]:
                keep("wide_email", _wide_email(text, at, done["wide_email"]))
        elif anchor == "+":
            keep("phone", _phone(text, at))
        elif anchor == ":":
            if at >= done["ipv6"]:
                begin, end, valid = _ipv6(text, at, done["ipv6"])
                if valid:
                    found["ipv6"].append((begin, end))
                done["ipv6"] = end
        elif anchor == "scheme":
            login = LOGIN.match(text, at) if at >= done["login"] else None
            keep("login", login.span(1) if login else None)
        elif anchor == "hidden":
            keep("hidden_email", _hidden_email(text, at, done["hidden_email"]))
        else:
            # A cue stands for itself, not inside a word or a span found before.
            if at < done[anchor] or (at and text[at - 1].isalnum()) or (text[last].isalnum() and text[last + 1 : last + 2].isalnum()):
                continue
            keep(anchor, _street(text, at, last + 1) if anchor == "street" else BEHIND[anchor](text, last + 1))
    return [(k, *s) for k in KINDS for s in sorted(found[k])]


def masked(text: str, marks: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans share the widest one's kind."""
    out, at = [], 0
    for kind, begin, end in sorted(marks, key=lambda x: (x[1], -x[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _finder(mask: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches, "_text"):
            texts = part.column("_text").to_pylist()
            marks = [spans(t, automaton) if t else [] for t in texts]
            held = pa.array([[{"kind": k, "start": b, "end": e} for k, b, e in row] for row in marks], kind)
            kept = part.drop_columns(["_text"])
            new = [held, pa.array([masked(t, m) if m else t for t, m in zip(texts, marks)], part.column("_text").type)] if mask else [held]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*kept.schema.names, "_spans", "_masked"][: len(kept.columns) + len(new)])

    return find


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): the personal data of each document, as structs of kind, start and end."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_spans", T._parse_datatype_string(SPANS))])
    return rows.mapInArrow(_finder(False), schema).select(F.col("_id").alias(id_col), F.col("_spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", kinds: str = "spans") -> DataFrame:
    """The documents with personal data replaced in the text, and the spans of the old text in column ``kinds``."""
    columns = [c for c in docs.columns if c != kinds]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)], F.col(f"`{text_col}`").alias("_text"))
    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    schema = T.StructType([*fields, T.StructField("_spans", T._parse_datatype_string(SPANS)), T.StructField("_masked", T.StringType())])
    found = rows.mapInArrow(_finder(True), schema)
    return found.select(*[F.col("_masked" if c == text_col else f"_{i}").alias(c) for i, c in enumerate(columns)], F.col("_spans").alias(kinds))


def joined(marks: Column) -> Column:
    return F.array_join(F.transform(marks, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(marks: Column, kind: str) -> Column:
    return F.size(F.filter(marks, lambda s: s["kind"] == kind)).cast("long")


def op12_personal_data(spark, folder: str) -> DataFrame:
    """Counts, digest of the base kinds and all spans of every document."""
    found = find(documents(spark, folder))
    marks = F.col("spans")
    counts = [counted(marks, k).alias(f"n_{k}") for k in BASE]
    digest = F.sha2(joined(F.filter(marks, lambda s: s["kind"].isin(*BASE))).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), joined(marks).alias("spans"))
