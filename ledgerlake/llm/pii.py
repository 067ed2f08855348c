"""Personal data, also in disguise, with spans in the source text.

Base identifiers are found in the text as it stands. A second pass runs a
transducer over texts that show a disguise: homoglyphs and wide forms become
their plain letters and digits, zero-width marks vanish, runs of spelled
digits become digits, bracketed or spelled "at" and "dot", in the corpus's
four languages, become signs. Runs of fewer spelled digits count beside
numerals; they are read in a pass of their own, so they never spoil an
identifier that stands beside a number word. The
transducer keeps, for each character it writes, the source span it came
from; identifiers found in its output are mapped back through these spans.
A span is added if it holds something the transducer changed and is not
contained in a base span of its kind; base spans stay, so an added span may
extend one.

Each text is looked at whole, in one task and on its own; nothing is
shuffled. Spans count code points, the end being exclusive.

Defined results: a null or empty text has no spans; repeated rows each get
their row; an empty table gives an empty result; other columns are not
looked at. n_email, n_ip, n_card and n_phone count base spans, n_added the
spans that only the transducer shows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, text_of

KINDS = ("email", "ip", "card", "phone")
#: fixed values: the base patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: fixed values: letters of other scripts that look like Latin ones, in pairs
HOMOGLYPHS = dict(zip("аеорсухіѕјԁһԛԝВАЕКМНОРСТХІЈЅαοενιρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxisjdhqwBAEKMHOPCTXIJSaoeviptukABEZHIKMNOPTYX".replace(" ", "")))
ZERO_WIDTH = "​‌‍⁠﻿­"
#: spelled digits of the four languages of the corpus
DIGITS = {w: str(d) for words in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
) for d, w in enumerate(words.split())} | {"oh": "0"}
WIDE = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {chr(base + d): str(d) for base in (0x0660, 0x06F0, 0x0966) for d in range(10)}
ONE = WIDE | HOMOGLYPHS | dict.fromkeys(ZERO_WIDTH, "")
#: this many spelled digits in a row, at least, are read as a number
LEAST_SPELLED = 4
_WORD = "(?:" + "|".join(sorted(DIGITS, key=len, reverse=True)) + ")"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: words for the signs in English, German, French and Spanish; those of _SIGN mean nothing else
_SIGN = "(?:ät|klammeraffe|arr?obase|arroba)"
_AT, _DOT = f"(?:at|{_SIGN})", "(?:dot|punkt|point|punto)"
_DISGUISE = (
    rf"(?P<spelled>(?<!\w){_WORD}(?:[\x20,-]{{1,2}}{_WORD}){{{LEAST_SPELLED - 1},}}(?!\w))"
    rf"|(?P<at>\x20?{_OPEN}\x20?{_AT}\x20?{_CLOSE}\x20?)"
    rf"|(?P<dot>\x20?{_OPEN}\x20?{_DOT}\x20?{_CLOSE}\x20?)"
    rf"|(?P<pair>(?<=[A-Za-z0-9])\x20{_AT}\x20(?=[A-Za-z0-9-]+(?:\x20{_DOT}\x20[A-Za-z0-9-]+)+))"
    rf"|(?P<sign>(?<=[A-Za-z0-9])\x20{_SIGN}\x20(?=[A-Za-z0-9-]+\.[A-Za-z0-9-]))"
    rf"|(?P<plain>(?<=[A-Za-z0-9])\x20{_DOT}\x20(?=[A-Za-z0-9]))"
    rf"|(?P<one>[{re.escape(''.join(ONE))}])")
DISGUISE = re.compile(_DISGUISE, re.IGNORECASE)
_RUN = rf"{_WORD}(?:[\x20,-]{{1,2}}{_WORD})*"
#: a run of any length that stands beside a numeral, with what parts the two
BESIDE = re.compile(rf"(?P<beside>(?<=[0-9)])[\x20,-]{{1,2}}{_RUN}(?!\w)(?:[\x20,-]{{1,2}}(?=[0-9(]))?"
                    rf"|(?<!\w){_RUN}[\x20,-]{{1,2}}(?=[0-9(]))|" + _DISGUISE, re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_AT_LABEL = re.compile(r"@[A-Za-z0-9-]+$")
_MARK = re.compile(f"[{re.escape(''.join(ONE))}]")
_BRACKETED = re.compile(rf"{_OPEN}\x20?{_AT}\x20?{_CLOSE}|\x20{_SIGN}\x20|{_DOT}")
_NEAR = re.compile(rf"[0-9)][\x20,-]{{1,2}}{_WORD}(?!\w)|(?<!\w){_WORD}[\x20,-]{{1,2}}[0-9(]")
_SPELLED = re.compile(rf"{_WORD}[\x20,-]{{1,2}}{_WORD}[\x20,-]")
HAS_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base identifiers of ``text``, in order."""
    found = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def hinted(text: str) -> bool:
    """Whether ``text`` holds what every disguise needs: a cheap look before the transducer."""
    low = text.lower()
    return bool(not text.isascii() and _MARK.search(text) or _BRACKETED.search(low) or _SPELLED.search(low) or _NEAR.search(low))


def transduce(text: str, disguise: re.Pattern = DISGUISE) -> tuple[str, list[int], list[int], list[tuple[int, int]]]:
    """(plain text, source start and source end of each of its characters, changed source spans)."""
    out, starts, ends, changed, at, dot_end = [], [], [], [], 0, -1

    def write(s: str, a: int, b: int) -> None:
        out.append(s)
        starts.extend([a] * len(s))
        ends.extend([b] * len(s))

    def keep(a: int, b: int) -> None:
        out.append(text[a:b])
        starts.extend(range(a, b))
        ends.extend(range(a + 1, b + 1))

    for m in disguise.finditer(text):
        kind = m.lastgroup
        keep(at, m.start())
        at = m.end()
        if kind == "plain":
            # outside English the word is common in prose: it must follow the first label of an address or a spelled dot's label
            if m[0].strip().lower() != "dot" and not (_AT_LABEL.search("".join(out[-3:])) or dot_end >= 0 and _LABEL.fullmatch(text, dot_end, m.start())):
                keep(m.start(), m.end())
                continue
            dot_end = m.end()
        changed.append(m.span())
        if kind == "beside":
            words = [w.span() for w in re.finditer(r"\w+", m[0])]
            if words[0][0]:
                write(" ", m.start(), m.start() + words[0][0])
            for a, b in words:
                write(DIGITS[m[0][a:b].lower()], m.start() + a, m.start() + b)
            if words[-1][1] < len(m[0]):
                write(" ", m.start() + words[-1][1], m.end())
        elif kind == "spelled":
            for w in re.finditer(r"\w+", m[0]):
                write(DIGITS[w[0].lower()], m.start() + w.start(), m.start() + w.end())
        elif kind in ("at", "pair", "sign"):
            write("@", *m.span())
        elif kind in ("dot", "plain"):
            write(".", *m.span())
        else:
            write(ONE[m[0]], *m.span())
    keep(at, len(text))
    return "".join(out), starts, ends, changed


def _mapped(text: str, disguise: re.Pattern) -> list[tuple[int, int, int]]:
    """The spans that hold something the transducer changed, in the source text."""
    plain, starts, ends, changed = transduce(text, disguise)
    if not changed:
        return []
    found, begin = [], [a for a, _ in changed]
    for a, kind, b in find(plain):
        s, e = starts[a], ends[b - 1]
        i = bisect_left(begin, s)
        if (i < len(changed) and changed[i][0] < e) or (i > 0 and changed[i - 1][1] > s):
            found.append((s, kind, e))
    return found


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of the transducer's output that no base span of their kind holds whole."""
    if not hinted(text):
        return []
    found = _mapped(text, DISGUISE)
    if _NEAR.search(text.lower()):
        found += _mapped(text, BESIDE)
    out: list[tuple[int, int, int]] = []
    for kind in range(len(KINDS)):
        # from the left, base spans and wider ones first: a span that ends within the reach of those before it is held by one
        own = sorted([(a, -b, 0) for a, k, b in base if k == kind] + [(a, -b, 1) for a, k, b in set(found) if k == kind])
        reach = -1
        for s, e, new in own:
            if new and -e > reach:
                out.append((s, kind, -e))
            reach = max(reach, -e)
    return sorted(out)


def hidden(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of the added spans that stand apart from every base span of their kind."""
    return [(s, k, e) for s, k, e in added(text, base) if not any(kind == k and a < e and s < b for a, kind, b in base)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


SCHEMA = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("n_added", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(batches):
    for batch in batches:
        for part in slices(batch, 1):
            rows = []
            for d, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                base = find(text)
                more = added(text, base)
                rows.append((d, *[sum(k == i for _, k, _ in base) for i in range(len(KINDS))], len(more),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string")


def query(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
