"""Personal data by anchor expansion: Aho-Corasick finds cues, local parsers find the bounds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.worker import release

#: Kinds in the order of listings. The first four are the base; the method adds the others.
#: `tel` and `pan` are phones and cards that the base patterns run past or into something else.
KINDS = ("email", "ip", "card", "phone", "url", "account", "tel", "pan", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOST = re.compile(r"(?:[^\s/@<>\"']*@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
_ACCOUNT = re.compile(r"[\s:#=.]{0,3}(?:(?:number|no|nr|num)\b[\s:#=.]{0,3})?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8}|[0-9][0-9-]{5,}[0-9])")

_GROUP = re.compile(r"[0-9]+")
_SECRET = re.compile(r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_./+-]{8,}=*)")

#: Cues of credentials, of accounts (fixed values, in lower case) and of addresses with a scheme.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey")
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte")
SCHEMES = ("http://", "https://", "ftp://")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def iban(text: str) -> bool:
    """Whether the check digits of an international account number hold."""
    text = text.replace(" ", "")
    if not 15 <= len(text) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def card_groups(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Cards inside a stretch of digit groups that is none as a whole: a group of 16 to 19
    digits, or four groups of four with equal separators."""
    groups, found, i = [m.span() for m in _GROUP.finditer(text, start, end)], [], 0
    while i < len(groups):
        a, b = groups[i]
        four = groups[i:i + 4]
        if 16 <= b - a <= 19 and luhn(text[a:b]):
            found.append((a, b))
        elif (len(four) == 4 and all(y - x == 4 for x, y in four)
              and len({text[y] for _, y in four[:3]}) == 1 and luhn("".join(text[x:y] for x, y in four))):
            found.append((a, four[-1][1]))
            i += 3
        i += 1
    return found


def phone_prefix(text: str) -> int:
    """Length of the longest start of a phone match, up to a space, that has 8 to 15 digits; 0 if none."""
    best = digits = 0
    for i, c in enumerate(text):
        if c == " " and 8 <= digits <= 15 and "0" <= text[i - 1] <= "9":
            best = i
        digits += "0" <= c <= "9"
        if digits > 15:
            break
    return best


def automaton():
    import ahocorasick
    words = ahocorasick.Automaton()
    for anchor in ("@", "+", *"0123456789"):
        words.add_word(anchor, (anchor if anchor in "@+" else "0", len(anchor)))
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for anchor in cues:
            for form in {anchor, anchor.upper(), anchor.capitalize()}:
                words.add_word(form, (kind, len(form)))
    for anchor in SCHEMES:
        words.add_word(anchor, ("url", len(anchor)))
    words.make_automaton()
    return words


def find(text: str, anchors) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start.

    Each kind is what its pattern finds from left to right without overlap: a parser starts
    at an anchor, never before the end of the last match of its kind, whether that was
    kept or dropped.
    """
    found = {k: [] for k in KINDS}
    end_of = dict.fromkeys(KINDS, 0)
    digits_done = ip_done = 0
    n = len(text)
    for last, (kind, length) in anchors.iter(text):
        at = last - length + 1
        if kind == "0":
            if at >= ip_done:
                # A run of digits and dots; addresses lie within one run.
                to = at
                while to < n and (text[to] == "." or "0" <= text[to] <= "9"):
                    to += 1
                for m in _IP.finditer(text, at, to):
                    parts = [p.lstrip("0") for p in m[0].split(".")]
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                        found["ip"].append(m.span())
                ip_done = to
            if at >= digits_done:
                m = _CARD.match(text, at)
                digits_done = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
                    elif len(digits) > 16:
                        found["pan"] += card_groups(text, *m.span())
        elif kind == "@":
            start = at
            while start > end_of["email"] and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                found["email"].append((start, m.end()))
                end_of["email"] = m.end()
        elif kind == "+":
            m = _PHONE.match(text, at) if at >= end_of["phone"] else None
            if m:
                end_of["phone"] = m.end()
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found["phone"].append(m.span())
                elif size := phone_prefix(m[0]):
                    found["tel"].append((at, at + size))
        elif kind == "secret" and at >= end_of["secret"]:
            m = _SECRET.match(text, last + 1)
            if m and any("0" <= c <= "9" for c in m[1]):
                found["secret"].append(m.span(1))
                end_of["secret"] = m.end()
        elif kind == "url" and at >= end_of["url"]:
            m = _HOST.match(text, last + 1)
            if m and m.end() > last + 1:
                stop = last + 1 + len(m[0].rstrip(".,;:!?)"))
                if stop > last + 1:
                    found["url"].append((at, stop))
                    end_of["url"] = stop
        elif kind == "account" and at >= end_of["account"] and not (at and text[at - 1].isalpha()):
            m = _ACCOUNT.match(text, last + 1)
            if m and (iban(m[1]) if m[1][0].isalpha() else True):
                found["account"].append(m.span(1))
                end_of["account"] = m.end()
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by the name of its kind; overlapping spans are one,
    named by that which begins first (the longer, then the earlier kind)."""
    out, at = [], 0
    for start, end, kind in sorted(((s, e, k) for k, s, e in spans),
                                   key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = "array<struct<kind:string, start:long, end:long>>"


def find_spans(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans",
               redact: bool = False) -> DataFrame:
    """`docs` with the spans found in its text, or with the text redacted and no spans column.

    Whole texts are read; null counts as empty (and stays null when redacting). Spans are
    listed by kind, then start. Rows, order of columns and other values stay as they are;
    an existing column named `spans_col` is replaced.
    """
    fields = [f for f in docs.schema.fields if redact or f.name != spans_col]
    names = [f.name for f in fields]
    place = names.index(text_col)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        anchors = automaton()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(place).to_pylist()
                spans = [find(t, anchors) if t else [] for t in texts]
                columns = list(part.columns)
                if redact:
                    columns[place] = pa.array([t and redacted(t, s) for t, s in zip(texts, spans)], pa.string())
                else:
                    columns.append(pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in spans], kind))
                yield pa.RecordBatch.from_arrays(columns, names=names if redact else [*names, spans_col])

    kept = docs.select(*(F.col(f"`{n}`") for n in names))
    return kept.mapInArrow(run, ddl if redact else f"{ddl}, `{spans_col}` {_SPANS}")


def digest(found: DataFrame, spans_col: str = "pii_spans") -> DataFrame:
    """Counts and listings of the spans."""
    spans = F.col(spans_col)
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS[:4]))
    return found.select("doc_id", *(count(k) for k in KINDS[:4]),
                        F.sha2(F.array_join(F.transform(base, told), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform(spans, told), ",").alias("spans"))
