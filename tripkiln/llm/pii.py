"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over a text once and finds the anchors: at
signs, plus signs, digits, schemes (``mailto:``, ``tel:``, ...) and the words
that announce an identifier (``IBAN``, ``account``, ...). From each anchor a
parser for what may stand there expands to the boundaries of the address or
number and validates it. Text without anchors costs one pass of the automaton
and nothing else; every parser reads a stretch once, so the work is linear in
the text whatever it holds.

Base kinds, leftmost and without overlaps within a kind: ``email``, ``ip``,
``card``, ``phone``. The parsers add two kinds:

* ``address``: an e-mail address whose local part or domain has letters beyond
  ASCII or a quoted local part, from end to end (where the base span, if any,
  holds only a part of it); and the address behind ``mailto:``, ``sip:``,
  ``sips:``, ``xmpp:``, ``tel:``, ``sms:``, and the user part and host behind
  ``http://``, ``https://`` and ``ftp://``, if no base span is the same.
* ``account``: an IBAN whose check digits are right, with or without a word
  before it that announces it, and the number of 5 to 20 digits (with single
  letters, spaces or hyphens between) behind a word for an account or identity paper.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkiln.llm.common import table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
DIGITS = "0123456789"
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: Schemes whose address is a person's, and schemes of a host that may follow a user part.
CONTACT_SCHEMES = ("mailto:", "sip:", "sips:", "xmpp:", "tel:", "sms:")
HOST_SCHEMES = ("http://", "https://", "ftp://")
#: Words before an account or identity number; also found capitalised and in upper case.
CUES = (
    "account", "acct", "a/c", "iban", "konto", "kontonummer", "cuenta", "compte", "passport", "ssn", "social security", "tax id",
    "reisepass", "pasaporte", "passeport", "steuer-id",
)
#: Scripts written without spaces begin here; expansion over letters stops before them.
_NO_SPACES = "⺀"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE_DOMAIN = re.compile(rf"(?:(?!_)[^\W{_NO_SPACES}-\U0010ffff]|-)+(?:\.(?:(?!_)[^\W{_NO_SPACES}-\U0010ffff]|-)+)*")
_USER = re.compile(r"[^\s/?#@<>\"'()]{1,254}@")
_HOST = re.compile(r"\[[0-9A-Fa-f:.]{2,45}\]|[^\s/?#@<>\"'(),;:!]{1,253}")
_CALL = re.compile(r"\+?[0-9](?:[().-]?[0-9]){4,19}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_LINK = re.compile(
    r"(?:\x20?(?:no\.?|nr\.?|number|num\.?|numbers?|nummer|número|numéro|n°|nº|#|is|id)(?![A-Za-z0-9]))?\x20?[:#=]?\x20?", re.IGNORECASE
)
_NUMBER = re.compile(r"(?:[A-Z]{1,2}\x20?)?[0-9](?:[\x20-]?[0-9]){4,19}(?![0-9])")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in DIGITS:
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for kind, words in (("contact", CONTACT_SCHEMES), ("host", HOST_SCHEMES), ("cue", CUES)):
        for word in words:
            for w in {word, word.upper(), word.capitalize()}:
                found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


_ANCHORS = None


def _anchors() -> ahocorasick.Automaton:
    global _ANCHORS  # one automaton a worker
    if _ANCHORS is None:
        _ANCHORS = _automaton()
    return _ANCHORS


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    d = [int(c) for c in reversed(digits)]
    return sum(d[0::2] + [2 * x - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def iban(text: str) -> bool:
    """The check digits of an account number: 1 modulo 97, letters as 10 to 35."""
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and sum(c in DIGITS for c in s) >= 8 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _parts_of_ip(chain: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in chain.split("."))


def _letter(c: str) -> bool:
    return c < _NO_SPACES and (c.isalnum() or c in "._%+-")


class _Text:
    """The parsers over one text; each keeps the end of what it has read."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int, int]] = []
        self.email_end = self.last_at = self.ip_end = self.card_end = self.phone_end = self.wide_end = self.account_end = 0

    def add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((KINDS.index(kind), start, end))

    def digit(self, at: int, end: int) -> None:
        text = self.text
        if at >= self.ip_end:
            chain = _CHAIN.match(text, at)
            self.ip_end = chain.end()
            if text.find(".", at, chain.end()) >= 0:
                self._ips(at, chain.group())
        if at >= self.card_end:
            card = _CARD.match(text, at)
            if card:
                self.card_end = card.end()
                if card.end() - at >= 16:
                    number = re.sub(r"[\x20-]", "", card.group())
                    if 16 <= len(number) <= 19 and luhn(number):
                        self.add("card", at, card.end())
        if at - 2 >= self.account_end and "A" <= text[at - 1] <= "Z" and "A" <= text[at - 2] <= "Z":
            self._iban(at - 2)

    def _ips(self, at: int, chain: str) -> None:
        parts = chain.split(".")
        for k in range(0, len(parts) - 3, 4):  # a match takes four parts, the next begins behind it
            four = ".".join(parts[k : k + 4])
            if _parts_of_ip(four):
                self.add("ip", at, at + len(four))
            at += len(four) + 1

    def _iban(self, at: int) -> bool:
        """An account number with right check digits, from its country letters on."""
        text = self.text
        if at and text[at - 1].isalnum():
            return False
        found = _IBAN.match(text, at)
        end = found.end() if found else at
        while end - at >= 15:  # a word behind the number may look like its rest
            if not (end < len(text) and text[end].isalnum()) and iban(text[at:end]):
                self.add("account", at, end)
                self.account_end = end
                return True
            end = text.rfind(" ", at, end)
        return False

    def plus(self, at: int, end: int) -> None:
        if at < self.phone_end:
            return
        phone = _PHONE.match(self.text, at)
        if phone:
            self.phone_end = phone.end()
            if 8 <= sum(c in DIGITS for c in phone.group()) <= 15:
                self.add("phone", at, phone.end())

    def at(self, at: int, end: int) -> None:
        text = self.text
        low = max(self.email_end, self.last_at)
        base = None
        start = low + len(text[low:at].rstrip(LOCAL))
        domain = _DOMAIN.match(text, end) if start < at else None
        if domain:
            base = (start, domain.end())
            self.email_end = domain.end()
            self.add("email", *base)
        self._wide(at, max(self.wide_end, self.last_at), base)
        self.last_at = end

    def _wide(self, at: int, low: int, base: tuple[int, int] | None) -> None:
        """The address around an at sign with letters of any alphabet, or a quoted local part."""
        text = self.text
        start = at
        if at > low and text[at - 1] == '"':
            quote = text.rfind('"', max(low, at - 66), at - 1)
            if quote >= 0 and "\n" not in text[quote:at] and at - quote > 2:
                start = quote
        else:
            while start > low and _letter(text[start - 1]):
                start -= 1
            while start < at and text[start] in ".%+-_":
                start += 1
        domain = _WIDE_DOMAIN.match(text, at + 1) if start < at else None
        if not domain or text[at - 1] in ".":
            return
        end = domain.end()
        if base and start >= base[0] and end <= base[1]:
            return  # nothing beyond the base span
        labels = text[at + 1 : end].split(".")
        if len(labels) > 1 and len(labels[-1]) > 1 and labels[-1].isalpha() and all(x[:1] != "-" and x[-1:] != "-" for x in labels):
            self.wide_end = end
            self.add("address", start, end)

    def contact(self, at: int, end: int) -> None:
        text = self.text
        if at and text[at - 1].isalnum():
            return
        user = _USER.match(text, end)
        if user:
            host = _HOST.match(text, user.end())
            if host:
                stop = user.end() + len(host.group().rstrip("."))
                if stop > user.end():
                    self.add("address", end, stop)
        elif text[at:end].lower() in ("tel:", "sms:", "sip:", "sips:"):
            call = _CALL.match(text, end)
            if call:
                self.add("address", end, call.end())

    def host(self, at: int, end: int) -> None:
        text = self.text
        if at and text[at - 1].isalnum():
            return
        user = _USER.match(text, end)
        host = _HOST.match(text, user.end()) if user else None
        if host and host.group().rstrip("."):
            self.add("address", end, user.end() + len(host.group().rstrip(".")))

    def cue(self, at: int, end: int) -> None:
        text = self.text
        if (at and text[at - 1].isalnum()) or (end < len(text) and text[end].isalpha()):
            return
        start = _LINK.match(text, end).end()
        if start < self.account_end or self._iban(start):
            return
        number = _NUMBER.match(text, start)
        if number and not text[start - 1].isalnum():
            self.account_end = number.end()
            self.add("account", number.start(), number.end())


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, begin, end in code points) by kind, then begin."""
    found = _Text(text)
    for last, (kind, size) in _anchors().iter(text):
        getattr(found, kind)(last + 1 - size, last + 1)
    base = {(start, end) for kind, start, end in found.spans if kind < len(BASE)}
    out: list[tuple[str, int, int]] = []
    for kind, start, end in sorted(set(found.spans), key=lambda s: (s[0], s[1], -s[2])):
        if kind >= len(BASE):  # added spans: none that is a base span, leftmost and longest first
            if (start, end) in base or (out and out[-1][0] == KINDS[kind] and start < out[-1][2]):
                continue
        out.append((KINDS[kind], start, end))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))
def _spans(texts: pa.Array) -> pa.Array:
    rows = [find_spans(t.as_py() or "") for t in texts]
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in rows], pa.list_(_SPAN))


def personal_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: the spans of personal data in the whole text
    (``kind``, ``start``, ``end``; code points, end exclusive), by kind in the
    order of ``KINDS``, then start; a column of this name is replaced.

    A null or empty text has none. Rows stand for themselves, so ids, ties and
    repeated rows do not matter; a text is in a worker's memory as a whole."""
    return docs.select(*[c for c in docs.columns if c.lower() != "pii"], _spans(F.col(text)).alias("pii"))


def masked(text: str, spans: list) -> str:
    """The text with every stretch of spans replaced by the kind of its first, widest span."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _masked(texts: pa.Array) -> pa.Array:
    return pa.array([None if (s := t.as_py()) is None else masked(s, find_spans(s)) for t in texts], pa.string())


def mask_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans in ``text`` replaced by ``<KIND>``; null stays null."""
    return docs.select(*[_masked(F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """All spans of all documents."""
    out = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return out.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"),
        *[count(k) for k in KINDS[len(BASE) :]],
    )
